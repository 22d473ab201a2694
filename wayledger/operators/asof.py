"""Attributes as known at event time.

Method: entities, by day, are hash-partitioned into buckets, and each bucket runs an embedded
DuckDB ``ASOF LEFT JOIN`` of its events on availability-ordered current-state versions. A day of
an entity needs the versions of that day and the one that stood at its start. A report is
available from the later of its event time and its ingestion; the current state at that instant
is the value of the report with the latest event time among those available, so a report that
comes in late but tells of an older time doesn't displace a newer one. Ties are resolved before
the join: one version per entity and instant.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayledger.operators.history import telling
from wayledger.session import SMALL_BYTES, materialize, plan_size


def current_state_versions(reports: DataFrame) -> DataFrame:
    """(entity, avail, value): what is known of an entity from each instant on, changes only.

    ``reports`` has entity, at, seen (naive, UTC), tie and value. Reports of one event time: the
    one seen last wins, then the higher tie. The running maximum is taken within availability
    days first and then over the days' results, so a hot entity isn't one sorted group.
    """
    r = reports.where("entity is not null and at is not null and seen is not null and value is not null")
    avail = F.greatest("at", "seen")
    best = F.struct("at", "seen", "tie", "value").alias("best")
    r = r.select("entity", avail.alias("avail"), F.date_trunc("day", avail).alias("day"), best)
    # prior tie resolution: one row per entity and instant
    r = r.groupBy("entity", "day", "avail").agg(F.max("best").alias("best"))
    days = r.groupBy("entity", "day").agg(F.max("best").alias("best"))
    w = Window.partitionBy("entity").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carry = days.select("entity", "day", F.max("best").over(w).alias("carry"))
    within = Window.partitionBy("entity", "day").orderBy("avail")
    state = r.join(carry, ["entity", "day"]).withColumn("state", F.greatest(F.max("best").over(within.rowsBetween(Window.unboundedPreceding, 0)), F.col("carry")))
    was = F.coalesce(F.lag("state.value").over(within), F.col("carry.value"))
    return state.withColumn("was", was).where(~F.col("state.value").eqNullSafe(F.col("was"))).select("entity", "avail", F.col("state.value").alias("value"))


def _asof(event_schema: pa.Schema):
    def run(events: pa.Table, versions: pa.Table) -> pa.Table:
        if events.num_rows == 0:
            return event_schema.empty_table()
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        try:
            con.register("e", events)
            con.register("v", versions)
            out = con.sql("select e.id, v.value from e asof left join v on e.entity = v.entity and e.at >= v.avail").to_arrow_table()
        finally:
            con.close()
        return out.cast(event_schema)

    return run


def _day(c: str):
    return F.date_trunc("day", c).cast("timestamp_ntz").alias("day")


def _of_days(versions: DataFrame, days: DataFrame) -> DataFrame:
    """(entity, day, avail, value): the versions of each day that has events, and the one carried
    into it, which is available a microsecond before the day."""
    own = versions.select("entity", _day("avail"), "avail", "value")
    ends = own.groupBy("entity", "day").agg(F.max_by("value", "avail").alias("value"), F.lit(False).alias("asked"))
    line = ends.unionByName(days.select("entity", "day", F.lit(None).cast("string").alias("value"), F.lit(True).alias("asked"))).groupBy("entity", "day").agg(F.max("value").alias("value"), F.max("asked").alias("asked"))
    before = Window.partitionBy("entity").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = line.withColumn("value", F.last("value", ignorenulls=True).over(before)).where("asked and value is not null")
    carried = carried.select("entity", "day", (F.col("day") - F.expr("interval 1 microsecond")).alias("avail"), "value")
    return own.join(days.select("entity", "day"), ["entity", "day"], "left_semi").unionByName(carried)


def as_known(events: DataFrame, versions: DataFrame, rows_per_bucket: int = 100_000) -> DataFrame:
    """(id, value) of every event, with the value its entity was known to have at the event's time.

    ``events`` has id (text), entity, at. What was not known is null, as is what an event
    without entity or time would be; repeated events each get their row. Buckets are cut by
    entity and day; a day of an entity with more than ``rows_per_bucket`` events is cut further
    by a hash of the event, and only its versions, which are changes only, are repeated. So no
    bucket grows with the table or with its hottest entity.
    """
    known = events.where("entity is not null and at is not null")
    days = materialize(known.select("entity", _day("at")).groupBy("entity", "day").count(), "days")
    versions = materialize(versions, "versions")
    hot = days.where(F.col("count") > rows_per_bucket).select("entity", "day", F.ceil(F.col("count") / rows_per_bucket).cast("int").alias("shares"))
    total, any_hot = days.agg(F.sum("count"), F.max("count") > rows_per_bucket).first()
    buckets = max(32, -(-(total or 0) // rows_per_bucket))
    e, v = known.withColumn("day", _day("at")), _of_days(versions, days)
    share = F.lit(0)
    if any_hot:  # without a hot day the joins below would add nothing
        hot = materialize(hot, "hot")
        hot = F.broadcast(hot) if plan_size(hot) <= SMALL_BYTES else hot
        e, v = (x.join(hot, ["entity", "day"], "left").withColumn("shares", F.coalesce("shares", F.lit(1))) for x in (e, v))
        share = F.pmod(F.xxhash64("id"), F.col("shares")).cast("int")
        v = v.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    else:
        v = v.withColumn("share", F.lit(0))
    bucket = F.pmod(F.xxhash64("entity", "day", "share"), F.lit(buckets)).cast("int").alias("bucket")
    e = e.withColumn("share", share).select(bucket, "id", "entity", "at")
    v = v.select(bucket, "entity", "avail", "value")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.StringType())])
    run = _asof(pa.schema([("id", pa.string()), ("value", pa.string())]))
    out = e.groupBy("bucket").cogroup(v.groupBy("bucket")).applyInArrow(run, schema)
    return out.unionByName(events.where("entity is null or at is null").select("id", F.lit(None).cast("string").alias("value")))


def imei_reports(identity: DataFrame) -> DataFrame:
    """The reports that tell an IMEI."""
    return identity.select(
        F.col("device_serial").alias("entity"),
        F.col("event_timestamp").alias("at"),
        F.col("ingested_at").cast("timestamp_ntz").alias("seen"),
        F.col("row_id").alias("tie"),
        telling("imei", "has_valid_imei_format").alias("value"),
    ).where("value is not null and entity is not null")


def imei_at_event(telemetry: DataFrame, identity: DataFrame, only_changed: bool = True) -> DataFrame:
    """(row_id, imei) of each telemetry row, as known at its event time.

    ``only_changed``: only for devices that ever reported more than one IMEI. Rows without device,
    event time or known IMEI have no result row.
    """
    reports = imei_reports(identity)
    asked = reports.groupBy("entity").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    asked = materialize(asked.where("lo <> hi" if only_changed else "true").select("entity"), "entities")
    asked = F.broadcast(asked) if plan_size(asked) <= SMALL_BYTES else asked
    reports = reports.join(asked, "entity", "left_semi")
    events = telemetry.select(F.col("row_id").alias("id"), F.col("device_serial").alias("entity"), F.col("event_timestamp").alias("at"))
    # events of other entities can get nothing: they aren't shuffled
    events = events.where("entity is not null and at is not null").join(asked, "entity", "left_semi")
    return as_known(events, current_state_versions(reports)).where("value is not null").select(F.col("id").alias("row_id"), F.col("value").alias("imei"))
