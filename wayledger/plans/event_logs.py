"""Tracker logs derived from the ``events`` stream: every branch of the typed layer in one table.

The rules give legacy rows that resolve and that don't, ambiguous serials and files, every
rejection reason, odd coordinates, half values and repeated rows. Each rule is one expression
that Spark SQL and DuckDB read alike; only time formats and hashes are named per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.contracts import LINEAGE_COLUMNS, SOURCE_COLUMNS
from wayledger.plans import gold, silver
from wayledger.plans import layer_queries as lq
from wayledger.session import table

# Made-up values of the fields that are the same in every row.
_CONSTANT = {
    "TIPO_LOG": "stream", "REPT_TYPE": "7", "DIR": "42", "INT_BATT": "3.7", "ODO_TRIP": "8.25", "HORIMETER": "61", "RX_LEVEL": "-88", "RPM": "910", "TACHO_SPD": "33", "TACHO_ODO": "7001",
    "TEMP_1": "-4", "TEMP_2": "0", "TEMP_3": "11.5", "TEMP_4": "3e1",
}
_T = "event_type = 'signup'"
_RULES = {
    "TM_STAMP": "case when event_id % 53 = 0 or event_id % 11 = 5 then '' else ts_text end",
    "DATA_SERVIDOR": "case when event_id % 53 = 0 then 'value' when dup = 1 then ts_60 else ts_5 end",
    "MESS_TYPE": f"case when {_T} then 'T1' when event_type = 'view' then 'T2' when event_type = 'click' then 'T3' when event_type = 'purchase' then 'T14' when event_id % 3 = 0 then '' when event_id % 3 = 1 then 'INVALID' else ' T27 ' end",
    "PRT_VER": "case when user_id % 3 = 0 then 'V14.06.111' else 'V14.06.117' end",
    "S/N ou IMEI": "case when (user_id % 3 = 0 and event_id % 2 = 0) or (user_id % 5 = 1 and event_id % 19 = 0) then '' else 'M' || cast(user_id as string) end",
    "BAT_VOLT": f"case when {_T} then '89' || lpad(cast(event_id as string), 17, '3') else cast(20 + k % 9 as string) || '.75' end",
    "LOC_STATUS": f"case when {_T} then 'extra' else 'fix' end",
    "LAT": f"case when {_T} then '26' || lpad(cast(user_id as string), 13, '4') when k = 0 then '' when k = 1 then '95.5' when k in (2, 3) then '0' else cast(k - 50 as string) || '.25' end",
    "LONT": f"case when {_T} and event_id % 23 = 0 then '123' when {_T} and user_id % 10 = 5 then '862222222222220' when {_T} and user_id % 9 = 6 then '86' || lpad(cast(user_id * 10 + event_id % 4 as string), 13, '0') when {_T} then '86' || lpad(cast(user_id as string), 13, '0') when k in (2, 3) then '0' else cast(user_id % 180 as string) || '.5' end",
    "SPEED": "case when k % 13 = 0 then '' when k % 13 = 1 then 'abc' else cast(value as string) end",
    "HDOP": "cast(k % 8 as string) || '.5'",
    "ODO_TOTAL": "case when k = 7 then '' when user_id % 4 = 0 then cast(1000000 - event_id as string) else cast(event_id * 10 as string) end",
    "SER_COUNT": "cast(event_id % 1000 as string) || '.5'",
    "source_file": "'log_' || cast(user_id as string) || '.csv'",
    "source_file_hash": "'h' || cast(user_id as string)",
    "source_row_number": "event_id + 1",
    "batch_id": "'b' || cast(user_id % 4 as string)",
    "ingestion_date": "'2024-02-01'",
}
_KEY = "'h' || cast(user_id as string) || ':' || cast(event_id + 1 as string) || ':' || cast(dup as string)"


def _rule(c: str) -> str:
    return _RULES.get(c) or f"'{_CONSTANT.get(c, 'value')}'"


def event_logs(events: DataFrame) -> DataFrame:
    """Bronze rows of the events; every seventeenth twice."""
    text = lambda s: F.date_format(F.col("ts") + F.make_dt_interval(secs=F.lit(s)), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    e = events.withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "k": F.regexp_extract("props", "[0-9]+", 0).cast("int"), "dup": F.explode(F.when(F.col("event_id") % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))})
    e = e.withColumns({"ts_text": text(0), "ts_5": text(5), "ts_60": text(60)})
    more = {"row_id": f"sha2({_KEY}, 256)", "ingested_at": "timestamp '2024-02-01 00:00:00'"}
    return e.select(*[F.expr(more.get(c) or _rule(c)).alias(c) for c in [*SOURCE_COLUMNS, *LINEAGE_COLUMNS]])


def _text_sql(s: int) -> str:
    return f"strftime(ts + interval {s} second, '%Y-%m-%d %H:%M:%S.%f')"


LOGS = (
    f"tracker_logs as (select {', '.join(f'{_rule(c)} as {chr(34)}{c.lower()}{chr(34)}' for c in [*SOURCE_COLUMNS, *LINEAGE_COLUMNS] if c not in ('row_id', 'ingested_at'))}, sha256({_KEY}) as row_id "
    f"from (select *, cast(regexp_extract(props, '[0-9]+', 0) as int) k, {_text_sql(0)} ts_text, {_text_sql(5)} ts_5, {_text_sql(60)} ts_60 from events, (select unnest([0, 1]) dup) where dup = 0 or event_id % 17 = 0))"
)


def _tables(spark: SparkSession, d: str) -> silver.SilverTables:
    return silver.build_silver(event_logs(table(spark, d, "events")))


def events_resolved(spark: SparkSession, d: str) -> DataFrame:
    c = silver.classify(silver.resolve_identity(silver.normalize(event_logs(table(spark, d, "events")))))
    return c.select("row_id", "device_serial", "device_resolution_method", "rejection_reason", "event_timestamp")


def events_silver_telemetry(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).telemetry.drop("ingested_at")


def events_silver_identity(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).identity.drop("ingested_at")


def events_silver_rejected(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).rejected.drop("ingested_at")


def events_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.daily_summary(_tables(spark, d).telemetry)


def events_dim_device(spark: SparkSession, d: str) -> DataFrame:
    s = _tables(spark, d)
    return gold.dim_device(s.telemetry, s.identity)


def events_quality_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _tables(spark, d)
    return gold.quality_summary(s.telemetry, s.identity, s.rejected)


QUERIES = {f.__name__: f for f in (events_resolved, events_silver_telemetry, events_silver_identity, events_silver_rejected, events_daily_summary, events_dim_device, events_quality_summary)}


def _over(sql: str) -> str:
    """The same SQL over the derived logs."""
    return f"with {LOGS}, {sql.removeprefix('with ')}"


_LAYERS = (
    _over(lq.TYPED)
    + f", telemetry_events as (select *, {lq._OK} as has_valid_coordinates, {lq._QUAL} as position_quality from t), "
    + lq._IDENT[lq._IDENT.index("i as (") :].replace("i as (", "device_identity_events as (", 1)
    + ", rejected_logs as (select coalesce(strftime(event_timestamp, '%Y-%m-%d'), 'unknown') as rejection_date, * from c where rejection_reason is not null)"
)

SQL = {
    "events_resolved": f"{_over(lq.WITH_C)} select row_id, device_serial, device_resolution_method, rejection_reason, event_timestamp from c",
    "events_silver_telemetry": _over(lq.SQL["silver_telemetry"]),
    "events_silver_identity": _over(lq.SQL["silver_identity"]),
    "events_silver_rejected": _over(lq.SQL["silver_rejected"]),
    "events_daily_summary": f"{_LAYERS}, {lq.TEL}, {lq.DAILY} select * from ds",
    "events_dim_device": f"{_LAYERS}, {lq.TEL}, {lq.IDB}, {lq.DIM} select * from dim",
    "events_quality_summary": f"{_LAYERS}, {lq.QUALITY} select * from q1",
}
