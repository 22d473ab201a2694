"""Queries that go through the table store, the control log and the inbox, with their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.config import Settings
from wayledger.contracts import SOURCE_COLUMNS
from wayledger.operators import bad_rows
from wayledger.plans import ingest, modes, serve
from wayledger.plans import layer_queries as lq
from wayledger.plans.data_queries import BLANK, LINES
from wayledger.plans.layer_queries import DIM, IDB, QUALITY, TEL
from wayledger.plans.pipeline import run_pipeline
from wayledger.plans.scope_queries import affected_partitions
from wayledger.session import scratch_path, table
from wayledger.sources.csv_files import write_bytes
from wayledger.store import TableStore


def schema_widening(spark: SparkSession, d: str) -> DataFrame:
    """Identity rows appended in two loads, the later with a column more."""
    ids, told = table(spark, d, "device_identity_events"), F.coalesce("has_valid_imsi_format", F.lit(False))
    store = TableStore(spark, scratch_path(spark, "widening"), "event_date")
    store.append(ids.where(~told).select("event_date", "row_id", "imei"))
    store.append(ids.where(told).select("imsi", "row_id", "event_date", "imei"))
    return store.read()


def partition_replace(spark: SparkSession, d: str) -> DataFrame:
    """Days with untyped messages keep only those; the undated partition is replaced by nothing."""
    rows = table(spark, d, "rejected_logs").select("rejection_date", "row_id", "rejection_reason")
    store = TableStore(spark, scratch_path(spark, "replace"), "rejection_date")
    store.overwrite(rows)
    untyped = rows.where("rejection_reason = 'MISSING_MESSAGE_TYPE' and rejection_date <> 'unknown'")
    days = [r.rejection_date for r in untyped.select("rejection_date").distinct().collect()]
    store.replace_partitions(untyped, [*days, "unknown"])
    return store.read()


def control_append(spark: SparkSession, d: str) -> DataFrame:
    """The control log written status by status, then compacted."""
    events = table(spark, d, "ingestion_files")
    store = TableStore(spark, scratch_path(spark, "control"))
    for status in ingest.STATUSES:
        store.append(events.where(F.col("status") == status))
    store.append(events.where(~F.coalesce(F.col("status").isin(*ingest.STATUSES), F.lit(False))))
    store.compact(2)
    return store.read().select("control_event_id", "batch_id", "source_file", "source_file_hash", "status", "stage", "row_count", "inserted_row_count", "duplicate_row_count", "status_reason")


def key_violations(spark: SparkSession, d: str) -> DataFrame:
    """File hashes that no key could be made of: null or seen in several control events."""
    return modes.key_violations(table(spark, d, "ingestion_files"), "source_file_hash")


def find_device(spark: SparkSession, d: str) -> DataFrame:
    """The dimension row of one device."""
    return lq.dim_device(spark, d).where(serve.filters("180000000001H"))


def replace_entities(spark: SparkSession, d: str) -> DataFrame:
    """Devices of the late days built anew from their other days; those without any vanish."""
    t = table(spark, d, "telemetry_events").where("device_serial is not null")
    days = affected_partitions(spark, d).select(F.col("event_day").alias("event_date"))
    entity = lambda rows: rows.groupBy("device_serial").agg(F.max("event_timestamp").alias("last_at"), F.count(F.lit(1)).alias("n"))
    touched = modes.affected_devices(days, t)
    fresh = entity(t.join(touched, "device_serial", "left_semi").join(days, "event_date", "left_anti"))
    return modes.replace_entities(entity(t), touched, fresh)


def pending_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of the logs of which no row was rejected, as if rejections were the ledger."""
    return modes.pending_batches(table(spark, d, "tracker_logs"), table(spark, d, "rejected_logs"))


def _writer(folder: str):
    def write(f: pd.DataFrame) -> pd.DataFrame:
        name = f.source_file.iloc[0]
        text = "\n".join(f.sort_values("line_number").raw_line) + "\n"
        write_bytes(f"{folder}/{name.rsplit('/', 1)[-1]}", text.encode())
        return pd.DataFrame({"source_file": [name]})

    return write


def _readable(spark: SparkSession, d: str) -> DataFrame:
    """The raw lines but blank ones and those whose quoting is broken, which would swallow the next."""
    lines = table(spark, d, "tracker_raw_lines").where(bad_rows.stripped("raw_line") != "")
    broken = bad_rows.read_lines(lines, SOURCE_COLUMNS).where(F.col("reason") == bad_rows.QUOTING).select("raw_id")
    return lines.join(broken, "raw_id", "left_anti")


def _to_inbox(lines: DataFrame, home: str) -> None:
    files = lines.groupBy("source_file").applyInPandas(_writer(f"{home}/raw/inbox"), "source_file string")
    files.write.format("noop").mode("overwrite").save()


def inbox_load(spark: SparkSession, d: str) -> DataFrame:
    """The raw lines put as files into an inbox and loaded to bronze; records that are too long are
    set aside."""
    home = scratch_path(spark, "inbox")
    _to_inbox(_readable(spark, d), home)
    bronze = ingest.Bronze(spark, Settings(home, salvage=True))
    bronze.load()
    return bronze.table.read().select("source_file", "source_row_number", *[F.col(f"`{c}`").alias(c.lower()) for c in SOURCE_COLUMNS])


def pipeline_quality(spark: SparkSession, d: str) -> DataFrame:
    """The same files through the whole pipeline in two runs, a full build and an increment; the
    quality summary must be that of all rows at once."""
    home = scratch_path(spark, "pipeline")
    lines, settings = _readable(spark, d), Settings(home, salvage=True)
    for turn in (0, 1):
        _to_inbox(lines.where(F.pmod(F.xxhash64("source_file"), F.lit(2)) == turn), home)
        run_pipeline(spark, settings)
    return modes.Gold(spark, settings).quality_summary.read()


QUERIES = {f.__name__: f for f in (schema_widening, partition_replace, control_append, key_violations, find_device, replace_entities, pending_batches, inbox_load, pipeline_quality)}

_LATE_DAYS = """d0 as (select batch_id, ingestion_date, coalesce(strftime(coalesce(try_cast(tm_stamp as timestamp), try_cast(data_servidor as timestamp)), '%Y-%m-%d'), 'unknown') event_day from tracker_logs),
days as (select distinct event_day from d0 where batch_id in (select batch_id from tracker_logs where ingestion_date = (select max(ingestion_date) from tracker_logs)))"""

# What the inbox's files hold: records that are no longer than their header, short ones filled up.
_FIELDS = ", ".join(f"""case when list_position(h, '{c.upper()}') > len(f) then '' else c{n} end as "{c.lower()}\"""" for n, c in enumerate(SOURCE_COLUMNS))
_LOADED = (
    LINES + "k as (select *, row_number() over (partition by source_file order by line_number) source_row_number from rec where not broken), "
    f"loaded as (select regexp_extract(source_file, '[^/]*$') as source_file, source_row_number, {_FIELDS} from k where len(f) <= len(h)), "
)

SQL = {
    "schema_widening": "select event_date, row_id, imei, case when has_valid_imsi_format then imsi end as imsi from device_identity_events",
    "partition_replace": "select rejection_date, row_id, rejection_reason from rejected_logs where rejection_date <> 'unknown' and (rejection_reason = 'MISSING_MESSAGE_TYPE' or rejection_date not in (select rejection_date from rejected_logs where rejection_reason = 'MISSING_MESSAGE_TYPE'))",
    "control_append": "select control_event_id, batch_id, source_file, source_file_hash, status, stage, row_count, inserted_row_count, duplicate_row_count, status_reason from ingestion_files",
    "key_violations": "select source_file_hash as key, count(*) as n from ingestion_files group by 1 having count(*) > 1 or source_file_hash is null",
    "find_device": f"with {TEL}, {IDB}, {DIM} select * from dim where device_serial = '180000000001H'",
    "replace_entities": f"""with {_LATE_DAYS}, touched as (select distinct device_serial from telemetry_events where event_date in (select event_day from days)),
kept as (select * from telemetry_events where device_serial is not null and (device_serial not in (select device_serial from touched where device_serial is not null) or event_date not in (select event_day from days)))
select device_serial, max(event_timestamp) as last_at, count(*) as n from kept group by 1""",
    "pending_batches": "select distinct batch_id from tracker_logs where batch_id not in (select batch_id from rejected_logs where batch_id is not null)",
    "inbox_load": _LOADED.removesuffix(", ") + " select * from loaded",
    "pipeline_quality": _LOADED
    + f"""tracker_logs as (select *, '' source_file_hash, source_file || source_row_number row_id, '' batch_id, '2020-01-01' ingestion_date from loaded), {lq.WITH_C.removeprefix('with ')},
telemetry_events as (select strftime(event_timestamp, '%Y-%m-%d') event_date from c where rejection_reason is null and message_type <> 'T1'),
device_identity_events as (select strftime(event_timestamp, '%Y-%m-%d') event_date from c where rejection_reason is null and message_type = 'T1'),
rejected_logs as (select coalesce(strftime(event_timestamp, '%Y-%m-%d'), 'unknown') rejection_date, rejection_reason from c where rejection_reason is not null), {QUALITY} select * from q1""",
}
