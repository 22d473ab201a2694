"""The typed layer: normalised text, resolved identity, classes, typed tables.

The identity maps are built first, from a narrow scan of the identity reports, and written: one
row per file. All else is one lazy plan of column expressions over one scan, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayledger.contracts import IDENTITY, RAW_NAMES, REJECTED, TELEMETRY, align
from wayledger.functions.dialect import clean_text, full_match, strip_all, try_double, try_integer, try_timestamp
from wayledger.session import SMALL_BYTES, materialize, plan_size

# The legacy protocol, patterns of type and IMEI, and the reasons in their order.
LEGACY_PROTOCOL = "V14.06.111"
TYPE_PATTERN = "T[0-9]+"
IMEI_PATTERN = "[0-9]{15}"
REASONS = ("MISSING_MESSAGE_TYPE", "INVALID_MESSAGE_TYPE", "MISSING_OR_INVALID_TIMESTAMP", "MISSING_DEVICE_SERIAL")


def normalize(bronze: DataFrame) -> DataFrame:
    """Raw text to normalised text, two times and typed lineage; nothing is dropped."""
    lineage = [
        F.col("source_file").cast("string").alias("source_file"),
        F.col("source_file_hash").cast("string").alias("source_file_hash"),
        F.col("source_row_number").cast("long").alias("source_row_number"),
        F.col("row_id").cast("string").alias("row_id"),
        F.col("batch_id").cast("string").alias("batch_id"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        F.col("ingestion_date").cast("date").alias("ingestion_date"),
    ]
    text = [clean_text(F.col(f"`{c}`")).alias(n) for c, n in RAW_NAMES.items()]
    return bronze.select(try_timestamp(F.col("DATA_SERVIDOR")).alias("server_timestamp"), try_timestamp(F.col("TM_STAMP")).alias("device_timestamp"), *text, *lineage)


def device_serial(raw: Column) -> Column:
    """White space and one leading ``M`` go; nothing left is null."""
    return F.nullif(F.regexp_replace(strip_all(raw), r"\AM", ""), F.lit(""))


def valid_imei(raw: Column) -> Column:
    """Exactly fifteen digits, or null."""
    v = strip_all(raw)
    return F.when(full_match(v, IMEI_PATTERN), v)


def event_time() -> Column:
    """Device time, else server time."""
    return F.coalesce("device_timestamp", "server_timestamp")


def unambiguous(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of the keys with exactly one value; nulls are no evidence."""
    g = pairs.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("__hi"))
    return g.where(F.col(value) == F.col("__hi")).drop("__hi")


def imei_evidence(normalized: DataFrame) -> DataFrame:
    """(imei, serial) pairs of identity reports that carry their own serial."""
    t1 = normalized.where((F.col("message_type") == "T1") & event_time().isNotNull())
    return t1.select(valid_imei(F.col("longitude_raw")).alias("imei"), device_serial(F.col("device_serial_raw")).alias("serial"))


def imei_serial_map(normalized: DataFrame) -> DataFrame:
    return unambiguous(imei_evidence(normalized), "imei", "serial")


def history_serial_map(identity: DataFrame) -> DataFrame:
    """The same from stored identity events; inferred serials are never evidence."""
    return unambiguous(identity.select(valid_imei(F.col("imei")).alias("imei"), device_serial(F.col("device_serial_raw")).alias("serial")), "imei", "serial")


def merged_serial_map(*maps: DataFrame) -> DataFrame:
    """Keys on which all maps agree."""
    both = maps[0]
    for m in maps[1:]:
        both = both.unionByName(m)
    return unambiguous(both, "imei", "serial")


def file_imei_map(normalized: DataFrame) -> DataFrame:
    """(file, imei) of the files whose identity reports tell exactly one IMEI."""
    t1 = normalized.where((F.col("message_type") == "T1") & event_time().isNotNull())
    file = F.nullif(strip_all(F.col("source_file")), F.lit(""))
    return unambiguous(t1.select(file.alias("file"), valid_imei(F.col("longitude_raw")).alias("imei")), "file", "imei")


def legacy_serials(evidence: DataFrame, history: DataFrame | None = None, compat: bool = True) -> DataFrame:
    """(file, serial): what a legacy row of a file resolves to.

    ``history`` adds stored identity events. With ``compat`` ambiguity is dropped per source
    before the sources are merged; without it all evidence is weighed at once.
    """
    if history is None:
        serials = imei_serial_map(evidence)
    elif compat:
        serials = merged_serial_map(imei_serial_map(evidence), history_serial_map(history))
    else:
        old = history.select(valid_imei(F.col("imei")).alias("imei"), device_serial(F.col("device_serial_raw")).alias("serial"))
        serials = unambiguous(imei_evidence(evidence).unionByName(old), "imei", "serial")
    return file_imei_map(evidence).join(serials, "imei").select("file", "serial")


def resolve_identity(normalized: DataFrame, history: DataFrame | None = None, compat: bool = True, by_file: DataFrame | None = None) -> DataFrame:
    """Adds device_serial and device_resolution_method; raw values never change.

    DIRECT: the row's own serial. LEGACY_IMEI: a legacy-protocol row of a valid type and time
    whose file tells one IMEI that tells one serial. Else UNRESOLVED. ``by_file`` gives the
    files' serials; by default they are taken from the identity reports among the rows, by a
    narrow scan of their own, and from ``history``.

    One row per file is broadcast where its written size is small; beyond that only the rows
    that need help are shuffled to it.
    """
    by_file = materialize(legacy_serials(normalized, history, compat), "serials") if by_file is None else by_file
    by_file = by_file.select(F.col("file").alias("__file"), F.col("serial").alias("__serial"))
    legacy = (F.col("protocol_version") == LEGACY_PROTOCOL) & full_match(F.col("message_type"), TYPE_PATTERN) & event_time().isNotNull()
    need = F.when(F.col("__own").isNull() & F.coalesce(legacy, F.lit(False)), F.nullif(strip_all(F.col("source_file")), F.lit("")))
    rows = normalized.withColumn("__own", device_serial(F.col("device_serial_raw")))
    method = F.when(F.col("__own").isNotNull(), "DIRECT").when(F.col("__serial").isNotNull(), "LEGACY_IMEI").otherwise("UNRESOLVED")
    out = [*normalized.columns, F.coalesce("__own", "__serial").alias("device_serial"), method.alias("device_resolution_method")]
    if plan_size(by_file) <= SMALL_BYTES:
        return rows.join(F.broadcast(by_file), need == F.col("__file"), "left").select(*out)
    # most rows carry their own serial: only those that need help are shuffled to the files' serials
    rows = rows.withColumn("__need", need)
    alone = rows.where("__need is null").withColumn("__serial", F.lit(None).cast("string"))
    helped = rows.where("__need is not null").join(by_file, F.col("__need") == F.col("__file"), "left")
    return alone.select(*out).unionByName(helped.select(*out))


def evidence(classified: DataFrame) -> DataFrame:
    """(event_day, kind, file, imei, serial): what rows say of identity, and what was inferred, each
    once per day and file.

    ``report``: the IMEI and own serial of an identity report. ``legacy``: the serial that legacy
    rows of the file resolve to, null for none. Incremental builds read this, not the tables.
    """
    file = F.nullif(strip_all(F.col("source_file")), F.lit(""))
    open_row = (F.col("rejection_reason") == REASONS[3]) & (F.col("protocol_version") == LEGACY_PROTOCOL)
    inferred = F.coalesce((F.col("device_resolution_method") == "LEGACY_IMEI") | open_row, F.lit(False))
    report = F.coalesce(F.col("message_type") == "T1", F.lit(False))
    entry = lambda cond, kind, imei, serial: F.when(cond, F.struct(F.lit(kind).alias("kind"), imei.alias("imei"), serial.alias("serial")))
    entries = F.array_compact(F.array(entry(report, "report", valid_imei(F.col("longitude_raw")), device_serial(F.col("device_serial_raw"))), entry(inferred, "legacy", F.lit(None).cast("string"), F.col("device_serial"))))
    rows = classified.where("event_timestamp is not null").select(_day().alias("event_day"), file.alias("file"), F.explode(entries).alias("e"))
    return rows.select("event_day", "e.kind", "file", "e.imei", "e.serial").distinct()


def reports(normalized: DataFrame) -> DataFrame:
    """(file, imei, serial) of identity reports."""
    t1 = normalized.where((F.col("message_type") == "T1") & event_time().isNotNull())
    return t1.select(F.nullif(strip_all(F.col("source_file")), F.lit("")).alias("file"), valid_imei(F.col("longitude_raw")).alias("imei"), device_serial(F.col("device_serial_raw")).alias("serial"))


def serials_of(reports: DataFrame) -> DataFrame:
    """(file, serial) by all reports (file, imei, serial) at once."""
    return unambiguous(reports, "file", "imei").join(unambiguous(reports, "imei", "serial"), "imei").select("file", "serial")


def changed_days(by_file: DataFrame, legacy: DataFrame) -> DataFrame:
    """(event_day): days of stored legacy rows that would now resolve to something else."""
    j = legacy.where("file is not null").join(by_file.select("file", F.col("serial").alias("now")), "file", "left")
    return j.where(~F.col("serial").eqNullSafe(F.col("now"))).select("event_day").distinct()


def classify(resolved: DataFrame) -> DataFrame:
    """Adds event_timestamp and rejection_reason (null: accepted), first reason first."""
    reason = (
        F.when(F.col("message_type").isNull(), REASONS[0])
        .when(~full_match(F.col("message_type"), TYPE_PATTERN), REASONS[1])
        .when(F.col("event_timestamp").isNull(), REASONS[2])
        .when(F.col("device_serial").isNull(), REASONS[3])
    )
    return resolved.withColumn("event_timestamp", event_time()).withColumn("rejection_reason", reason)


def _day(c: str = "event_timestamp") -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def has_valid_coordinates() -> Column:
    lat, lon = F.col("latitude"), F.col("longitude")
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def position_quality() -> Column:
    missing = F.col("latitude").isNull() | F.col("longitude").isNull()
    low = F.coalesce(F.col("hdop") > 5, F.lit(False))
    return F.when(missing, "MISSING_COORDINATES").when(~has_valid_coordinates(), "INVALID_COORDINATES").when(low, "LOW_GPS_PRECISION").otherwise("VALID")


# Typed columns of telemetry and the raw text each comes from.
_DOUBLES = {
    "battery_voltage": "battery_voltage_raw", "latitude": "latitude_raw", "longitude": "longitude_raw", "speed": "speed_raw", "direction_degrees": "direction_raw", "internal_battery": "internal_battery_raw",
    "odometer_trip": "odometer_trip_raw", "odometer_total": "odometer_total_raw", "horimeter": "horimeter_raw", "hdop": "hdop_raw", "rx_level": "rx_level_raw", "rpm": "rpm_raw", "tachograph_speed": "tachograph_speed_raw",
    "tachograph_odometer": "tachograph_odometer_raw", "temperature_1": "temperature_1_raw", "temperature_2": "temperature_2_raw", "temperature_3": "temperature_3_raw", "temperature_4": "temperature_4_raw",
}


def telemetry_table(classified: DataFrame) -> DataFrame:
    """Accepted messages other than T1, typed; unreadable numbers are null, the row stays."""
    rows = classified.where(F.col("rejection_reason").isNull() & (F.col("message_type") != "T1"))
    typed = {n: try_double(F.col(raw)) for n, raw in _DOUBLES.items()} | {"report_type": try_integer(F.col("report_type_raw")), "serial_count": try_integer(F.col("serial_count_raw"), "bigint"), "location_status": F.col("location_status_raw"), "event_date": _day()}
    out = rows.withColumns(typed)
    return align(out.withColumns({"has_valid_coordinates": has_valid_coordinates(), "position_quality": position_quality()}), TELEMETRY)


def identity_table(classified: DataFrame) -> DataFrame:
    """Accepted T1 messages: their fields hold ICCID, auxiliary, IMSI and IMEI."""
    rows = classified.where(F.col("rejection_reason").isNull() & (F.col("message_type") == "T1"))
    out = rows.withColumns({
        "event_date": _day(), "report_type": try_integer(F.col("report_type_raw")), "iccid": F.col("battery_voltage_raw"), "identity_auxiliary": F.col("location_status_raw"), "imsi": F.col("latitude_raw"), "imei": F.col("longitude_raw"),
        "has_valid_iccid_format": full_match(F.col("battery_voltage_raw"), "[0-9]{18,22}"), "has_valid_imsi_format": full_match(F.col("latitude_raw"), "[0-9]{14,16}"), "has_valid_imei_format": full_match(F.col("longitude_raw"), IMEI_PATTERN),
    })
    return align(out, IDENTITY)


def rejected_table(classified: DataFrame) -> DataFrame:
    """Every other row, raw, with its reason; a row without any time is dated ``unknown``."""
    rows = classified.where(F.col("rejection_reason").isNotNull())
    return align(rows.withColumn("rejection_date", F.coalesce(_day(), F.lit("unknown"))), REJECTED)


@dataclass(frozen=True)
class SilverTables:
    """The three tables; each input row is in exactly one."""

    telemetry: DataFrame
    identity: DataFrame
    rejected: DataFrame


def split(classified: DataFrame) -> SilverTables:
    """The three tables of classified rows."""
    return SilverTables(telemetry_table(classified), identity_table(classified), rejected_table(classified))


def build_silver(bronze: DataFrame, history: DataFrame | None = None, compat: bool = True) -> SilverTables:
    """From bronze to the typed tables, as lazy plans."""
    return split(classify(resolve_identity(normalize(bronze), history, compat)))
