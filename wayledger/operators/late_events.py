"""Per-period aggregates by event time, corrected as late records arrive.

Method: every batch is appended to the retained raw events, the periods it touches are found,
those periods are recomputed entirely from the retained raw events, and their partitions are
replaced in one atomic commit, until the cut-off. A record that arrived behind the cut-off of its
hour is retained in the period's sealed part: it can't change a count any more, so it neither
causes a recompute nor is read by one, and a period past its cut-off stays as it is.

The storage period is the day of ``device_timestamp`` (of ``server_timestamp`` where that is
null): a value that all copies of a record share, so a period can be recomputed without looking
at another one, whatever order the batches come in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.operators.track import as_text
from wayledger.session import packed, scratch_path
from wayledger.store import TableStore

_SEALED = "~sealed"
_RAW = ["device_serial", "device_timestamp", "server_timestamp", "message_type", "serial_count", "ingested_at", "tie"]


@dataclass(frozen=True)
class LatePolicy:
    """When an hour is published, how long it is corrected, and which device clocks are wrong."""

    publish_after_s: int = 3600
    cut_off_s: int = 72 * 3600
    clock_ahead_s: int = 600
    clock_from: str = "2010-01-01"


def event_time(p: LatePolicy) -> Column:
    """Device time, or server time where the device's clock is absent or can't be right.

    A device time is wrong if it lies more than ``clock_ahead_s`` after the server's, or before
    ``clock_from``. Without server time only the latter can be told.
    """
    dev, srv = F.col("device_timestamp"), F.col("server_timestamp")
    wrong = dev.isNull() | (dev < F.lit(p.clock_from).cast("timestamp_ntz")) | F.coalesce(dev > srv + F.make_dt_interval(secs=F.lit(p.clock_ahead_s)), F.lit(False))
    return F.when(wrong, srv).otherwise(dev)


def _storage_period(p: LatePolicy) -> Column:
    t = F.coalesce("device_timestamp", "server_timestamp")
    day = F.date_format(F.when(t >= F.lit(p.clock_from).cast("timestamp_ntz"), t), "yyyy-MM-dd")
    return F.coalesce(day, F.lit("undated"))


def one_per_copy(raw: DataFrame) -> DataFrame:
    """The first by ``ingested_at`` of each group of copies; ties by row id.

    Rows without ``device_timestamp`` are copies only of themselves, by row id.
    """
    key = ["device_serial", "device_timestamp", "message_type", "serial_count"]
    alone = F.when(F.col("device_timestamp").isNull(), F.col("tie")).alias("alone")
    known = raw.where("device_timestamp is not null or tie is not null")
    first = known.groupBy(*key, alone).agg(F.min(F.struct(F.col("ingested_at").isNull().alias("unseen"), "ingested_at", "tie", "server_timestamp")).alias("f"))
    return first.select(*key, "f.server_timestamp", "f.ingested_at").unionByName(raw.where("device_timestamp is null and tie is null").select(*key, "server_timestamp", "ingested_at"))


def _hour(p: LatePolicy) -> Column:
    return F.date_trunc("hour", event_time(p)).cast("timestamp_ntz")


def _cut(hour: Column, p: LatePolicy) -> Column:
    return hour + F.make_dt_interval(secs=F.lit(3600 + p.cut_off_s))


def _seen() -> Column:
    return F.col("ingested_at").cast("timestamp_ntz")


def hourly(raw: DataFrame, p: LatePolicy) -> DataFrame:
    """Counts by storage period, device and hour: as first published and as corrected."""
    hours = one_per_copy(raw).withColumn("period", _storage_period(p)).withColumn("hour_start", _hour(p)).where("hour_start is not null")
    pub = F.col("hour_start") + F.make_dt_interval(secs=F.lit(3600 + p.publish_after_s))
    counts = _seen() <= _cut(F.col("hour_start"), p)
    return hours.groupBy("period", "device_serial", "hour_start").agg(
        F.count_if(_seen() <= pub).alias("published_count"),
        F.count_if(counts).alias("corrected_count"),
        F.max(F.when(counts, F.col("ingested_at"))).alias("last_counted_at"),
    )


def too_late(raw: DataFrame, p: LatePolicy) -> DataFrame:
    """(device_serial, hour_start, excluded_count): records of which no copy came in time."""
    hours = one_per_copy(raw).withColumn("hour_start", _hour(p)).where("hour_start is not null")
    late = ~F.coalesce(_seen() <= _cut(F.col("hour_start"), p), F.lit(False))
    return hours.where(late).groupBy("device_serial", "hour_start").agg(F.count(F.lit(1)).alias("excluded_count"))


class LateAggregates:
    """The retained raw events and the published aggregates, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, policy: LatePolicy | None = None):
        self.spark, self.policy = spark, policy or LatePolicy()
        self.raw = TableStore(spark, f"{path}/raw", "period")
        self.published = TableStore(spark, f"{path}/published", "period")

    def apply(self, batch: DataFrame) -> list[str]:
        """Take in one batch; gives the periods that were recomputed.

        Nulls: a row without any time is kept as raw but belongs to no hour; one without
        ``ingested_at`` counts as excluded; a null device is a device of its own. An empty
        batch changes nothing. Extra columns are not retained. A batch applied twice, as
        after a failure, changes no count of rows that have a device time or a row id.
        """
        p = self.policy
        in_time = F.coalesce(_seen() <= _cut(_hour(p), p), F.lit(False))
        part = F.when(in_time, _storage_period(p)).otherwise(F.concat(_storage_period(p), F.lit(_SEALED)))
        rows = batch.select(*[F.col(c) for c in _RAW[:-1]], F.col("row_id").alias("tie"), part.alias("period"))
        # one or a few files per period instead of one per task; AQE splits a period that is large
        touched = [v for v in self.raw.append(rows.hint("rebalance", "period")) if not v.endswith(_SEALED)]
        if not touched:
            return []
        out = hourly(packed(self.raw.read(only=touched)), p).hint("rebalance", "period")
        if self.published.exists():
            self.published.replace_partitions(out, touched)
        else:
            self.published.overwrite(out)
        self.raw.compact()
        return touched

    def counted(self) -> DataFrame:
        """The published and corrected counts as they stand; an hour may draw on several storage periods."""
        if not self.published.exists():
            return self.spark.createDataFrame([], "device_serial string, hour_start timestamp_ntz, published_count long, corrected_count long, last_counted_at timestamp")
        sums = [F.sum(c).alias(c) for c in ("published_count", "corrected_count")]
        return self.published.read().groupBy("device_serial", "hour_start").agg(*sums, F.max("last_counted_at").alias("last_counted_at"))

    def current(self) -> DataFrame:
        """The same with ``excluded_count``, told from the periods that have a sealed part."""
        parts = set(self.raw.snapshot().parts) if self.raw.exists() else set()
        sealed = {v for v in parts if v.endswith(_SEALED)}
        out = self.counted().withColumn("excluded_count", F.lit(0).cast("long"))
        if not sealed:
            return out
        raw = packed(self.raw.read(only=sorted(sealed | (parts & {v.removesuffix(_SEALED) for v in sealed}))))
        late = too_late(raw, self.policy).select("device_serial", "hour_start", F.lit(0).alias("published_count"), F.lit(0).alias("corrected_count"), F.lit(None).cast("timestamp").alias("last_counted_at"), "excluded_count")
        sums = [F.sum(c).alias(c) for c in ("published_count", "corrected_count", "excluded_count")]
        return out.unionByName(late).groupBy("device_serial", "hour_start").agg(*sums, F.max("last_counted_at").alias("last_counted_at"))


def replay(telemetry: DataFrame, batches: int = 3, policy: LatePolicy | None = None, path: str | None = None) -> LateAggregates:
    """Take a whole table through the operator in ``batches`` steps of arrival.

    The steps are split at quantiles of ``ingested_at``; the result does not depend on them,
    only how often a period is recomputed does.
    """
    spark = telemetry.sparkSession
    agg = LateAggregates(spark, path or scratch_path(spark, "late"), policy)
    at = F.unix_micros("ingested_at")
    cuts = []
    if batches > 1:
        got = telemetry.select(F.percentile_approx(at, [i / batches for i in range(1, batches)], 1000)).first()[0]
        cuts = sorted(set(got or []))
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (at > lo)
        if hi is not None:
            cond = cond & (at <= hi)
        elif lo is not None:
            cond = cond | at.isNull()
        agg.apply(telemetry.where(cond))
    return agg


def corrected_hours(telemetry: DataFrame, policy: LatePolicy | None = None) -> DataFrame:
    """The device-hours whose published count was corrected before the cut-off."""
    return replay(telemetry, policy=policy).counted().where("corrected_count > published_count").select("device_serial", as_text("hour_start").alias("hour_start"))
