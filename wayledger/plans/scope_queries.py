"""Queries of incremental scopes, merges, control and pages, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.plans import gold, ingest, modes, serve
from wayledger.plans import layer_queries as lq
from wayledger.plans.layer_queries import DAILY, DIM, IDB, LASTPOS, QUALITY, ROUTE, TEL
from wayledger.session import scratch_path, table
from wayledger.store import TableStore


def _last_batches(logs: DataFrame) -> DataFrame:
    """The batches of the last day of ingestion: what an incremental run would be given."""
    last = logs.agg(F.max("ingestion_date").alias("ingestion_date"))
    return logs.join(F.broadcast(last), "ingestion_date", "left_semi").select("batch_id").distinct()


def affected_partitions(spark: SparkSession, d: str) -> DataFrame:
    logs = table(spark, d, "tracker_logs")
    return modes.affected_partitions(logs, _last_batches(logs))


def incremental_scope(spark: SparkSession, d: str) -> DataFrame:
    logs = table(spark, d, "tracker_logs")
    return modes.incremental_scope(logs, affected_partitions(spark, d)).select("row_id", "batch_id")


def affected_devices(spark: SparkSession, d: str) -> DataFrame:
    dates = affected_partitions(spark, d).select(F.col("event_day").alias("event_date"))
    return modes.affected_devices(dates, table(spark, d, "telemetry_events"), table(spark, d, "device_identity_events"))


def merge_insert_only(spark: SparkSession, d: str) -> DataFrame:
    """Telemetry rows that are not in the log sample, as a re-load of everything would add them."""
    new = table(spark, d, "telemetry_events").select("row_id", "device_serial", "message_type")
    return ingest.insert_only(table(spark, d, "tracker_logs"), new)


def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Last positions over the device dimension's serials, by key."""
    last = lq.device_last_position(spark, d).select("device_serial", F.col("protocol_version").alias("version"), F.lit("position").alias("origin"))
    dim = lq.dim_device(spark, d).select("device_serial", F.col("current_protocol_version").alias("version"), F.lit("dimension").alias("origin"))
    return ingest.upsert(dim, last, "device_serial")


def successful_hashes(spark: SparkSession, d: str) -> DataFrame:
    return ingest.successful_hashes(table(spark, d, "ingestion_files"))


def full_equals_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The daily summary built from the rows ingested up to the middle day, then brought up to date
    by replacing the days that later rows touch. Must equal a full build."""
    t = table(spark, d, "telemetry_events")
    store = TableStore(spark, scratch_path(spark, "daily"), "event_date")
    middle = F.lit(t.select(F.percentile_approx(F.unix_micros("ingested_at"), 0.5)).first()[0])
    late = F.coalesce(F.unix_micros("ingested_at") > middle, F.lit(True))
    store.overwrite(gold.daily_summary(t.where(~late)))
    days = [r.event_date for r in t.where(late & F.col("event_date").isNotNull()).select("event_date").distinct().collect()]
    store.replace_partitions(gold.daily_summary(t, days), days)
    return store.read()


def silver_partition_invariant(spark: SparkSession, d: str) -> DataFrame:
    """Rows per table of the typed layer: together all of bronze."""
    from wayledger.plans import silver

    s = silver.build_silver(table(spark, d, "tracker_logs"))
    n = lambda df, name: df.select(F.lit(name).alias("table_name")).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    return n(s.telemetry, "telemetry_events").unionByName(n(s.identity, "device_identity_events")).unionByName(n(s.rejected, "rejected_logs"))


def page_devices(spark: SparkSession, d: str) -> DataFrame:
    return serve.page_of(lq.dim_device(spark, d), "dim_device", serve.filters(), 20, 10)


def page_last_positions(spark: SparkSession, d: str) -> DataFrame:
    return serve.page_of(lq.device_last_position(spark, d), "last_position", serve.filters(), 25, 5)


def page_route(spark: SparkSession, d: str) -> DataFrame:
    where = serve.filters("180000000001H", "2015-02-01", "2015-03-31")
    return serve.page_of(lq.device_route_points(spark, d), "route_points", where, 100, 20)


def page_daily(spark: SparkSession, d: str) -> DataFrame:
    return serve.page_of(lq.device_daily_summary(spark, d), "daily_summary", serve.filters(None, "2015-02-01", "2015-02-28"), 100, 10)


def page_quality(spark: SparkSession, d: str) -> DataFrame:
    return serve.page_of(lq.data_quality_summary(spark, d), "quality_summary", serve.filters(start="2015-01-01", date_column="metric_date"), 50, 0)


def count_filtered(spark: SparkSession, d: str) -> DataFrame:
    days = lq.device_daily_summary(spark, d).where(serve.filters(None, "2015-02-10", "2015-02-20"))
    return days.agg(F.count(F.lit(1)).alias("total_count"))


QUERIES = {
    f.__name__: f
    for f in (
        affected_partitions, incremental_scope, affected_devices, merge_insert_only, merge_upsert, successful_hashes, full_equals_incremental, silver_partition_invariant,
        page_devices, page_last_positions, page_route, page_daily, page_quality, count_filtered,
    )
}

_DAYS = """d0 as (select row_id, batch_id, ingestion_date, coalesce(strftime(coalesce(try_cast(tm_stamp as timestamp), try_cast(data_servidor as timestamp)), '%Y-%m-%d'), 'unknown') event_day from tracker_logs),
d1 as (select distinct event_day from d0 where batch_id in (select batch_id from tracker_logs where ingestion_date = (select max(ingestion_date) from tracker_logs)))"""

SQL = {
    "affected_partitions": f"with {_DAYS} select event_day from d1",
    "incremental_scope": f"with {_DAYS} select row_id, batch_id from d0 where event_day in (select event_day from d1)",
    "affected_devices": f"with {_DAYS} select device_serial from telemetry_events where device_serial is not null and event_date in (select event_day from d1) union select device_serial from device_identity_events where device_serial is not null and event_date in (select event_day from d1)",
    "merge_insert_only": "select row_id, device_serial, message_type from telemetry_events t where not exists (select 1 from tracker_logs l where l.row_id = t.row_id)",
    "merge_upsert": f"with {TEL}, {IDB}, {DIM}, {LASTPOS} select device_serial, protocol_version as version, 'position' as origin from lp union all select device_serial, current_protocol_version, 'dimension' from dim where device_serial not in (select device_serial from lp)",
    "successful_hashes": "select distinct source_file_hash from ingestion_files where status = 'SUCCESS' and trim(coalesce(source_file_hash, '')) <> ''",
    "full_equals_incremental": f"with {TEL}, {DAILY} select * from ds",
    "silver_partition_invariant": f"{lq.WITH_C} select case when rejection_reason is not null then 'rejected_logs' when message_type = 'T1' then 'device_identity_events' else 'telemetry_events' end as table_name, count(*) as n from c group by 1",
    "page_devices": f"with {TEL}, {IDB}, {DIM} select * from dim order by device_serial limit 20 offset 10",
    "page_last_positions": f"with {TEL}, {LASTPOS} select * from lp order by last_position_at desc nulls last, device_serial limit 25 offset 5",
    "page_route": f"with {TEL}, {ROUTE} select * from rp where device_serial = '180000000001H' and event_date >= '2015-02-01' and event_date <= '2015-03-31' order by event_timestamp, point_sequence limit 100 offset 20",
    "page_daily": f"with {TEL}, {DAILY} select * from ds where event_date >= '2015-02-01' and event_date <= '2015-02-28' order by event_date desc, device_serial limit 100 offset 10",
    "page_quality": f"with {QUALITY} select * from q1 where metric_date >= '2015-01-01' order by metric_date desc limit 50",
    "count_filtered": f"with {TEL}, {DAILY} select count(*) as total_count from ds where event_date >= '2015-02-10' and event_date <= '2015-02-20'",
}
