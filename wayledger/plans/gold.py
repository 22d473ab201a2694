"""Analytic products over the typed layer, as DataFrame functions.

The optional scopes restrict a rebuild. They are applied to the inputs (partition columns and
grouping keys), so that a rebuild reads only what it needs. ``deduped`` says that telemetry has
been through ``dedup_telemetry`` with ``by_day`` already, as when several products share it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayledger.contracts import DAILY_SUMMARY, DIM_DEVICE, LAST_POSITION, QUALITY_SUMMARY, ROUTE_POINTS, align
from wayledger.functions.dialect import rounded_mean, percentage

# From which speed a device moves; the reasons counted by the quality summary.
MOVING_FROM = 5
REASON_COUNTS = {
    "missing_message_type_count": "MISSING_MESSAGE_TYPE",
    "invalid_message_type_count": "INVALID_MESSAGE_TYPE",
    "invalid_timestamp_count": "MISSING_OR_INVALID_TIMESTAMP",
    "missing_device_serial_count": "MISSING_DEVICE_SERIAL",
    "unknown_rejection_count": "UNKNOWN_REJECTION_REASON",
}


def _key(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("__NULL__"))


def _latest_first() -> list[Column]:
    return [F.col("server_timestamp").desc_nulls_last(), F.col("source_file").desc_nulls_last(), F.col("row_id").asc_nulls_last()]


def dedup_telemetry(telemetry: DataFrame, by_day: bool = False) -> DataFrame:
    """One row per logical record: the latest received, then the greatest file name and least row id.

    ``by_day`` sets event_date from the event time and lays rows out by device and day first.
    Copies share both, so the products per device and day need no second shuffle.
    """
    rows = telemetry.where("device_serial is not null and event_timestamp is not null")
    place = ["device_serial"]
    if by_day:
        rows = rows.withColumn("event_date", F.date_format("event_timestamp", "yyyy-MM-dd")).repartition("device_serial", "event_date")
        place = ["device_serial", "event_date"]
    w = Window.partitionBy(*place, "event_timestamp", "message_type", _key("serial_count"), _key("latitude"), _key("longitude"), _key("speed")).orderBy(*_latest_first())
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def dedup_identity(identity: DataFrame, by_day: bool = False) -> DataFrame:
    """One row per device, time and identity values, chosen likewise."""
    rows = identity.where("device_serial is not null and event_timestamp is not null")
    place = ["device_serial"]
    if by_day:
        rows = rows.withColumn("event_date", F.date_format("event_timestamp", "yyyy-MM-dd")).repartition("device_serial", "event_date")
        place = ["device_serial", "event_date"]
    w = Window.partitionBy(*place, "event_timestamp", _key("imei"), _key("imsi"), _key("iccid")).orderBy(*_latest_first())
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def _only_dates(df: DataFrame, dates: Sequence[str] | None, column: str = "event_date") -> DataFrame:
    return df if dates is None else df.where(F.col(column).isin(list(dates)))


def _by_time(value: str, pick=F.max_by, where: Column | None = None) -> Column:
    """Value at the last (or first) time among rows that have one; ties by row id."""
    known = F.col(value).isNotNull() if where is None else F.col(value).isNotNull() & where
    return pick(value, F.when(known, F.struct("event_timestamp", "row_id")))


def _latest(value: str) -> Column:
    """The last known value with its time and row, so that the latest of several can be told."""
    return F.max(F.when(F.col(value).isNotNull(), F.struct("event_timestamp", "row_id", F.col(value).alias("value")))).alias(value)


_IDENTITY_VALUES = ("imei", "imsi", "iccid", "identity_auxiliary", "protocol_version", "has_valid_imei_format", "has_valid_imsi_format", "has_valid_iccid_format")


def _span() -> list[Column]:
    return [F.min("event_timestamp").alias("first_at"), F.max("event_timestamp").alias("last_at"), F.count(F.lit(1)).alias("n")]


def identity_days(identity: DataFrame) -> DataFrame:
    """What each device and day adds to the device dimension by its identity reports."""
    return dedup_identity(identity, by_day=True).groupBy("event_date", "device_serial").agg(*_span(), *[_latest(c) for c in _IDENTITY_VALUES])


def telemetry_days(telemetry: DataFrame, deduped: bool = False) -> DataFrame:
    """What each device and day adds to the device dimension by its telemetry."""
    base = telemetry if deduped else dedup_telemetry(telemetry, by_day=True)
    return base.groupBy("event_date", "device_serial").agg(*_span(), _latest("protocol_version"))


def dim_from_days(telemetry: DataFrame, identity: DataFrame) -> DataFrame:
    """The device dimension from the states of days."""
    value = lambda c: F.max(c)["value"]
    i = identity.groupBy("device_serial").agg(
        F.min("first_at").alias("first_identity_at"), F.max("last_at").alias("last_identity_at"), F.sum("n").alias("n_identity"), value("protocol_version").alias("i_protocol"),
        *[value(c).alias(f"current_{c}") for c in ("imei", "imsi", "iccid", "identity_auxiliary")],
        *[value(f"has_valid_{c}_format").alias(f"current_{c}_format_valid") for c in ("imei", "imsi", "iccid")],
    )
    t = telemetry.groupBy("device_serial").agg(F.min("first_at").alias("first_telemetry_at"), F.max("last_at").alias("last_telemetry_at"), F.sum("n").alias("n_telemetry"), value("protocol_version").alias("t_protocol"))
    j = i.join(t, "device_serial", "full_outer")
    n_i, n_t = F.coalesce("n_identity", F.lit(0)), F.coalesce("n_telemetry", F.lit(0))
    out = j.withColumns({
        "current_protocol_version": F.coalesce("i_protocol", "t_protocol"), "first_seen_at": F.least("first_identity_at", "first_telemetry_at"), "last_seen_at": F.greatest("last_identity_at", "last_telemetry_at"),
        "identity_event_count": n_i, "telemetry_event_count": n_t, "has_identity_event": n_i > 0, "has_telemetry_event": n_t > 0,
    })
    return align(out, DIM_DEVICE)


def _only_devices(df: DataFrame, devices: DataFrame | None) -> DataFrame:
    return df if devices is None else df.join(devices.select("device_serial").distinct(), "device_serial", "left_semi")


def dim_device(telemetry: DataFrame, identity: DataFrame, devices: DataFrame | None = None) -> DataFrame:
    """One row per device: latest known value of each identity field, and its activity.

    The current values are each the latest non-null one, so they may come from several reports.
    Rows are brought to one per device and day, then per device, before the two inputs meet.
    """
    return dim_from_days(telemetry_days(_only_devices(telemetry, devices)), identity_days(_only_devices(identity, devices)))


def _positions(telemetry: DataFrame, by_day: bool, deduped: bool) -> DataFrame:
    """Deduplicated rows with coordinates that can be shown; 0/0 can't."""
    return (telemetry if deduped else dedup_telemetry(telemetry, by_day)).where("has_valid_coordinates and not (latitude = 0 and longitude = 0)")


def _last_of(positions: DataFrame, *keys: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("last_position_at").desc(), F.col("received_at").desc_nulls_last(), F.col("serial_count").desc_nulls_last(), "row_id")
    return positions.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def position_days(telemetry: DataFrame, deduped: bool = False) -> DataFrame:
    """The last position of each device and day."""
    p = _positions(telemetry, True, deduped).withColumns({"last_position_date": F.col("event_date"), "last_position_at": F.col("event_timestamp"), "received_at": F.col("server_timestamp")})
    return _last_of(p, "device_serial", "event_date").select("event_date", *LAST_POSITION.names, "row_id")


def last_from_days(positions: DataFrame) -> DataFrame:
    """Last positions from those of days."""
    return align(_last_of(positions, "device_serial"), LAST_POSITION)


def last_position(telemetry: DataFrame, devices: DataFrame | None = None) -> DataFrame:
    """The last position of each device that can be shown."""
    return last_from_days(position_days(_only_devices(telemetry, devices)))


def route_points(telemetry: DataFrame, dates: Sequence[str] | None = None, deduped: bool = False) -> DataFrame:
    """Positions of each device and day in order."""
    p = _positions(_only_dates(telemetry, dates), True, deduped).withColumn("received_at", F.col("server_timestamp"))
    w = Window.partitionBy("device_serial", "event_date").orderBy("event_timestamp", F.col("received_at").asc_nulls_last(), F.col("serial_count").asc_nulls_last(), "row_id")
    return align(p.withColumns({"point_sequence": F.row_number().over(w).cast("long"), "is_moving": F.coalesce("speed", F.lit(0.0)) >= MOVING_FROM}), ROUTE_POINTS)


def daily_summary(telemetry: DataFrame, dates: Sequence[str] | None = None, deduped: bool = False) -> DataFrame:
    """One row per device and day."""
    base = _only_dates(telemetry, dates)
    base = base if deduped else dedup_telemetry(base, by_day=True)
    ok = F.coalesce("has_valid_coordinates", F.lit(False))
    moving = F.col("speed") >= MOVING_FROM
    times = F.col("event_timestamp")
    ends = lambda c, w=None: {f"first_{c}": _by_time(c, F.min_by, w), f"last_{c}": _by_time(c, F.max_by, w)}
    spread = lambda c: {f"minimum_{c}": F.min(c), f"maximum_{c}": F.max(c), f"average_{c}": rounded_mean(F.col(c), 3)}
    aggs = {
        "first_event_at": F.min(times), "last_event_at": F.max(times), "message_count": F.count(F.lit(1)), "distinct_message_type_count": F.size(F.collect_set("message_type")).cast("long"),
        "valid_position_count": F.count_if(ok), "invalid_position_count": F.count_if(~ok), "low_gps_precision_count": F.count_if(F.col("position_quality") == "LOW_GPS_PRECISION"),
        "moving_event_count": F.count_if(moving), "stopped_event_count": F.count_if(F.col("speed") < MOVING_FROM), "average_speed": rounded_mean(F.col("speed"), 3), "average_speed_while_moving": rounded_mean(F.col("speed"), 3, moving),
        "maximum_speed": F.max("speed"), **spread("hdop"), **spread("battery_voltage"), **spread("internal_battery"), **ends("odometer_total"),
        "first_valid_position_at": F.min(F.when(ok, times)), "last_valid_position_at": F.max(F.when(ok, times)), **ends("latitude", ok), **ends("longitude", ok),
    }
    day = base.groupBy("event_date", "device_serial").agg(*[v.alias(k) for k, v in aggs.items()])
    first, last = F.col("first_odometer_total"), F.col("last_odometer_total")
    out = day.withColumns({
        "valid_position_percentage": percentage(F.col("valid_position_count"), F.col("message_count"), 2),
        "odometer_delta_raw": F.when(last >= first, last - first), "has_odometer_regression": F.coalesce(last < first, F.lit(False)),
    })
    return align(out, DAILY_SUMMARY)


def quality_summary(telemetry: DataFrame, identity: DataFrame, rejected: DataFrame, dates: Sequence[str] | None = None) -> DataFrame:
    """Accepted and rejected rows per day, copies included; ``unknown`` is a day of its own.

    One pass: the three tables are counted per day each, and only those counts are shuffled.
    """
    none = F.lit(None).cast("string")
    part = lambda df, kind, day, reason: df.select(day.alias("metric_date"), F.lit(kind).alias("kind"), reason.alias("reason"))
    day = F.col("event_date").cast("string")
    rows = (
        part(_only_dates(telemetry, dates), "telemetry", day, none)
        .unionByName(part(_only_dates(identity, dates), "identity", day, none))
        .unionByName(part(rejected, "rejected", F.coalesce(F.col("rejection_date").cast("string"), F.lit("unknown")), F.col("rejection_reason")))
    )
    rows = _only_dates(rows, dates, "metric_date")
    n = lambda k: F.count_if(F.col("kind") == k)
    g = rows.groupBy("metric_date").agg(*[n(k).alias(f"{k}_event_count") for k in ("telemetry", "identity", "rejected")], *[F.count_if(F.col("reason") == r).alias(c) for c, r in REASON_COUNTS.items()])
    accepted = F.col("telemetry_event_count") + F.col("identity_event_count")
    total = accepted + F.col("rejected_event_count")
    return align(g.withColumns({"accepted_event_count": accepted, "total_event_count": total, "rejection_percentage": percentage(F.col("rejected_event_count"), total, 4)}), QUALITY_SUMMARY)
