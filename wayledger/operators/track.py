"""Ordered, copy-free device tracks: what sequence operators start from.

One range shuffle on (device, event time) does three things: a device with a third of all rows
is spread over many tasks in time order, copies of a record meet in one task (they share device
and device time, hence event time), and each task holds its rows sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayledger.functions.geo import usable_position

TRACK_SCHEMA = "device_serial string, ts long, lat double, lon double"


def device_track(telemetry: DataFrame) -> DataFrame:
    """(device_serial, ts, lat, lon), sorted within range partitions on (device, time).

    Copies: rows equal in device_serial, device_timestamp (not null), message_type and
    serial_count (null equals null); the first by ``ingested_at`` stands for all, ties by
    ``row_id``; a row without device time is a copy only of itself, by ``row_id``. The copy is
    chosen first and its position judged after. ``ts`` is
    ``event_timestamp`` in microseconds. Rows without device, event time or usable position are
    no part of a track. Records of one device at the same instant follow serial_count, then
    message_type, then row_id, nulls first.
    """
    t = telemetry.where(F.col("device_serial").isNotNull() & F.col("event_timestamp").isNotNull()).select(
        "device_serial",
        "event_timestamp",
        "device_timestamp",
        "message_type",
        "serial_count",
        F.col("ingested_at").alias("seen"),
        F.col("row_id").alias("tie"),
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
    )
    alone = F.when(F.col("device_timestamp").isNull(), F.col("tie"))
    w = Window.partitionBy("device_serial", "event_timestamp", "device_timestamp", "serial_count", "message_type", alone).orderBy(F.col("seen").asc_nulls_last(), "tie")
    first = t.repartitionByRange("device_serial", "event_timestamp").withColumn("rn", F.row_number().over(w)).where("rn = 1 or (device_timestamp is null and tie is null)")
    micros = F.unix_micros(F.col("event_timestamp").cast("timestamp"))
    track = first.where(usable_position(F.col("lat"), F.col("lon"))).select("device_serial", micros.alias("ts"), "lat", "lon", "serial_count", "message_type", "tie")
    return track.sortWithinPartitions("device_serial", "ts", "serial_count", "message_type", "tie").select("device_serial", "ts", "lat", "lon")


def from_micros(c: str):
    """A naive timestamp from microseconds since 1970."""
    return F.timestamp_micros(F.col(c)).cast("timestamp_ntz")


def as_text(c):
    """``yyyy-MM-dd HH:mm:ss``, fractions cut off."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
