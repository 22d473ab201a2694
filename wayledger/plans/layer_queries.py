"""Queries over the layers, with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.contracts import RAW_NAMES
from wayledger.plans import gold, silver
from wayledger.session import table


def _logs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tracker_logs")


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return silver.resolve_identity(silver.normalize(_logs(spark, d)))


def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return silver.normalize(_logs(spark, d)).select("row_id", *RAW_NAMES.values())


def normalize_timestamps(spark: SparkSession, d: str) -> DataFrame:
    n = silver.normalize(_logs(spark, d)).withColumn("event_timestamp", silver.event_time())
    return n.select("row_id", "server_timestamp", "device_timestamp", "event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd").alias("event_date"), "ingestion_date")


def cast_telemetry(spark: SparkSession, d: str) -> DataFrame:
    t = silver.telemetry_table(silver.classify(_resolved(spark, d)))
    return t.select("row_id", "report_type", "serial_count", *silver._DOUBLES)


def position_quality(spark: SparkSession, d: str) -> DataFrame:
    t = silver.telemetry_table(silver.classify(_resolved(spark, d)))
    return t.groupBy("position_quality", "has_valid_coordinates").agg(F.count(F.lit(1)).alias("n"))


def identity_formats(spark: SparkSession, d: str) -> DataFrame:
    t = silver.identity_table(silver.classify(_resolved(spark, d)))
    return t.select("row_id", "iccid", "imsi", "imei", "identity_auxiliary", "has_valid_iccid_format", "has_valid_imsi_format", "has_valid_imei_format")


def imei_serial_map(spark: SparkSession, d: str) -> DataFrame:
    return silver.imei_serial_map(silver.normalize(_logs(spark, d)))


def history_serial_map(spark: SparkSession, d: str) -> DataFrame:
    return silver.history_serial_map(table(spark, d, "device_identity_events"))


def merged_serial_map(spark: SparkSession, d: str) -> DataFrame:
    return silver.merged_serial_map(imei_serial_map(spark, d), history_serial_map(spark, d))


def file_imei_map(spark: SparkSession, d: str) -> DataFrame:
    return silver.file_imei_map(silver.normalize(_logs(spark, d)))


def resolve_identity(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d).select("row_id", "device_serial_raw", "device_serial", "device_resolution_method")


def classify_reasons(spark: SparkSession, d: str) -> DataFrame:
    return silver.classify(_resolved(spark, d)).select("row_id", "event_timestamp", "rejection_reason")


def silver_telemetry(spark: SparkSession, d: str) -> DataFrame:
    return silver.build_silver(_logs(spark, d)).telemetry.drop("ingested_at")


def silver_identity(spark: SparkSession, d: str) -> DataFrame:
    return silver.build_silver(_logs(spark, d)).identity.drop("ingested_at")


def silver_rejected(spark: SparkSession, d: str) -> DataFrame:
    return silver.build_silver(_logs(spark, d)).rejected.drop("ingested_at")


def row_ids(spark: SparkSession, d: str) -> DataFrame:
    return _logs(spark, d).select("source_file_hash", "source_row_number", F.sha2(F.concat_ws(":", "source_file_hash", "source_row_number"), 256).alias("row_id"))


def dedup_telemetry(spark: SparkSession, d: str) -> DataFrame:
    return gold.dedup_telemetry(table(spark, d, "telemetry_events")).select("row_id", "device_serial", "event_timestamp")


def dedup_identity(spark: SparkSession, d: str) -> DataFrame:
    return gold.dedup_identity(table(spark, d, "device_identity_events")).select("row_id", "device_serial", "event_timestamp")


def dim_device(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_device(table(spark, d, "telemetry_events"), table(spark, d, "device_identity_events"))


def device_last_position(spark: SparkSession, d: str) -> DataFrame:
    return gold.last_position(table(spark, d, "telemetry_events"))


def device_route_points(spark: SparkSession, d: str) -> DataFrame:
    return gold.route_points(table(spark, d, "telemetry_events"))


def device_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.daily_summary(table(spark, d, "telemetry_events"))


def data_quality_summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.quality_summary(table(spark, d, "telemetry_events"), table(spark, d, "device_identity_events"), table(spark, d, "rejected_logs"))


QUERIES = {
    f.__name__: f
    for f in (
        device_daily_summary, normalize_text, normalize_timestamps, cast_telemetry, position_quality, identity_formats, imei_serial_map, history_serial_map, merged_serial_map, file_imei_map, resolve_identity, classify_reasons,
        silver_telemetry, silver_identity, silver_rejected, row_ids, dedup_telemetry, dedup_identity, dim_device, device_last_position, device_route_points, data_quality_summary,
    )
}

_SP = "'^[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]+|[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]+$', '', 'g'"
_SERIAL = f"nullif(regexp_replace(regexp_replace(%s, {_SP}), '^M', ''), '')"
_IMEI15 = f"case when regexp_full_match(regexp_replace(%s, {_SP}), '[0-9]{{15}}') then regexp_replace(%s, {_SP}) end"

NORMAL = (
    "n as (select try_cast(data_servidor as timestamp) server_timestamp, try_cast(tm_stamp as timestamp) device_timestamp, "
    + ", ".join(f'nullif(trim("{c.lower()}"), \'\') {n}' for c, n in RAW_NAMES.items())
    + ", source_file, source_file_hash, source_row_number, row_id, batch_id, cast(ingestion_date as date) ingestion_date, coalesce(try_cast(tm_stamp as timestamp), try_cast(data_servidor as timestamp)) event_timestamp from tracker_logs)"
)
EVIDENCE = f"ev as (select {_IMEI15 % ('longitude_raw', 'longitude_raw')} imei, {_SERIAL % 'device_serial_raw'} serial, nullif(regexp_replace(source_file, {_SP}), '') file from n where message_type = 'T1' and event_timestamp is not null)"
SERIALS = "ims as (select imei, min(serial) serial from ev where imei is not null and serial is not null group by imei having min(serial) = max(serial))"
FILES = "fim as (select file, min(imei) imei from ev where imei is not null and file is not null group by file having min(imei) = max(imei))"
RESOLVED = f"""r as (select n.*, coalesce({_SERIAL % "device_serial_raw"}, ims.serial) device_serial, case when {_SERIAL % "device_serial_raw"} is not null then 'DIRECT' when ims.serial is not null then 'LEGACY_IMEI' else 'UNRESOLVED' end device_resolution_method
from n left join fim on {_SERIAL % "device_serial_raw"} is null and n.protocol_version = 'V14.06.111' and regexp_full_match(n.message_type, 'T[0-9]+') and n.event_timestamp is not null and fim.file = nullif(regexp_replace(n.source_file, {_SP}), '') left join ims on ims.imei = fim.imei)"""
CLASSED = "c as (select *, case when message_type is null then 'MISSING_MESSAGE_TYPE' when not regexp_full_match(message_type, 'T[0-9]+') then 'INVALID_MESSAGE_TYPE' when event_timestamp is null then 'MISSING_OR_INVALID_TIMESTAMP' when device_serial is null then 'MISSING_DEVICE_SERIAL' end rejection_reason from r)"
WITH_N = f"with {NORMAL}"
WITH_C = f"with {NORMAL}, {EVIDENCE}, {SERIALS}, {FILES}, {RESOLVED}, {CLASSED}"
_INTS = "try_cast(try_cast(report_type_raw as double) as integer) report_type, try_cast(try_cast(serial_count_raw as double) as bigint) serial_count"
_DBL = ", ".join(f"try_cast({raw} as double) {n}" for n, raw in silver._DOUBLES.items())
_OK = "coalesce(latitude between -90 and 90 and longitude between -180 and 180, false)"
_QUAL = f"case when latitude is null or longitude is null then 'MISSING_COORDINATES' when not {_OK} then 'INVALID_COORDINATES' when hdop > 5 then 'LOW_GPS_PRECISION' else 'VALID' end"
TYPED = WITH_C + f", t as (select strftime(event_timestamp, '%Y-%m-%d') event_date, * exclude (rejection_reason), location_status_raw location_status, {_INTS}, {_DBL} from c where rejection_reason is null and message_type <> 'T1')"
_IDENT = f"""{WITH_C}, i as (select strftime(event_timestamp, '%Y-%m-%d') event_date, server_timestamp, device_timestamp, event_timestamp, message_type, try_cast(try_cast(report_type_raw as double) as integer) report_type, protocol_version, device_serial_raw, device_serial, device_resolution_method,
battery_voltage_raw iccid, location_status_raw identity_auxiliary, latitude_raw imsi, longitude_raw imei, source_file, source_file_hash, source_row_number, row_id, batch_id, ingestion_date, coalesce(regexp_full_match(battery_voltage_raw, '[0-9]{{18,22}}'), false) has_valid_iccid_format,
coalesce(regexp_full_match(latitude_raw, '[0-9]{{14,16}}'), false) has_valid_imsi_format, coalesce(regexp_full_match(longitude_raw, '[0-9]{{15}}'), false) has_valid_imei_format from c where rejection_reason is null and message_type = 'T1')
"""
_TEL_COLS = (
    "event_date, server_timestamp, device_timestamp, event_timestamp, log_type, message_type, report_type, protocol_version, device_serial, device_resolution_method, terminal_status, battery_voltage, location_status, latitude, longitude, speed, direction_degrees, internal_battery, odometer_trip, odometer_total, horimeter, hdop, "
    "mcc, mnc, lac, cell_id, rx_level, serial_count, transmission_technology, message_group, io_status, driver_id, passenger_id, rpm, tachograph_speed, tachograph_odometer, temperature_1, temperature_2, temperature_3, temperature_4, source_file, source_file_hash, source_row_number, row_id, batch_id, ingestion_date"
)
_K = lambda c: f"coalesce(cast({c} as varchar), '__NULL__')"
_LATE = "order by server_timestamp desc nulls last, source_file desc nulls last, row_id"
TEL = f"tb as (select * from telemetry_events where device_serial is not null and event_timestamp is not null qualify row_number() over (partition by device_serial, event_timestamp, message_type, {_K('serial_count')}, {_K('latitude')}, {_K('longitude')}, {_K('speed')} {_LATE}) = 1)"
IDB = f"ib as (select * from device_identity_events where device_serial is not null and event_timestamp is not null qualify row_number() over (partition by device_serial, event_timestamp, {_K('imei')}, {_K('imsi')}, {_K('iccid')} {_LATE}) = 1)"
_SHOWN = "has_valid_coordinates and not (latitude = 0 and longitude = 0)"
_LAST = lambda c: f"arg_max({c}, (event_timestamp, row_id)) filter (where {c} is not null)"
DIM = f"""di as (select device_serial, min(event_timestamp) f, max(event_timestamp) l, count(*) n, {_LAST("imei")} imei, {_LAST("imsi")} imsi, {_LAST("iccid")} iccid, {_LAST("identity_auxiliary")} aux, {_LAST("protocol_version")} pv, {_LAST("has_valid_imei_format")} v1, {_LAST("has_valid_imsi_format")} v2, {_LAST("has_valid_iccid_format")} v3 from ib group by 1),
dt as (select device_serial, min(event_timestamp) f, max(event_timestamp) l, count(*) n, {_LAST("protocol_version")} pv from tb group by 1),
dim as (select coalesce(di.device_serial, dt.device_serial) device_serial, imei current_imei, imsi current_imsi, iccid current_iccid, aux current_identity_auxiliary, coalesce(di.pv, dt.pv) current_protocol_version, least(di.f, dt.f) first_seen_at, greatest(di.l, dt.l) last_seen_at, di.f first_identity_at, di.l last_identity_at, dt.f first_telemetry_at, dt.l last_telemetry_at,
coalesce(di.n, 0) identity_event_count, coalesce(dt.n, 0) telemetry_event_count, coalesce(di.n, 0) > 0 has_identity_event, coalesce(dt.n, 0) > 0 has_telemetry_event, v1 current_imei_format_valid, v2 current_imsi_format_valid, v3 current_iccid_format_valid from di full join dt on di.device_serial = dt.device_serial)"""
LASTPOS = f"""lp as (select device_serial, strftime(event_timestamp, '%Y-%m-%d') last_position_date, event_timestamp last_position_at, server_timestamp received_at, latitude, longitude, speed, direction_degrees, battery_voltage, internal_battery, odometer_total, horimeter, hdop, rx_level, message_type, report_type, serial_count, protocol_version, position_quality, source_file
from tb where {_SHOWN} qualify row_number() over (partition by device_serial order by event_timestamp desc, server_timestamp desc nulls last, serial_count desc nulls last, row_id) = 1)"""
ROUTE = f"""rp as (select strftime(event_timestamp, '%Y-%m-%d') event_date, device_serial, row_number() over (partition by device_serial, strftime(event_timestamp, '%Y-%m-%d') order by event_timestamp, server_timestamp nulls last, serial_count nulls last, row_id) point_sequence, event_timestamp, server_timestamp received_at, latitude, longitude, speed, direction_degrees, odometer_trip, odometer_total, horimeter, hdop, rx_level, message_type, report_type, serial_count, protocol_version, position_quality, coalesce(speed, 0) >= 5 is_moving, source_file from tb where {_SHOWN})"""


def _mean(c: str, where: str = "") -> str:
    # a billionth away from zero: else errors of the sum in doubles, which depend on the order of
    # rows, decide means that lie exactly between two roundings
    f = f" filter (where {where})" if where else ""
    return f"round(avg({c}){f} + sign(avg({c}){f}) * 1e-9, 3)"


def _end(c: str, fn: str, where: str = "true") -> str:
    return f"{fn}({c}, (event_timestamp, row_id)) filter (where {c} is not null and {where})"


def _pct(a: str, b: str, n: int) -> str:
    return f"cast(round(cast(cast({a} as double) * 100.0::double / nullif({b}, 0) as decimal(28,10)), {n}) as double)"


DAILY = f"""dd as (select strftime(event_timestamp, '%Y-%m-%d') event_date, device_serial, min(event_timestamp) first_event_at, max(event_timestamp) last_event_at, count(*) message_count, count(distinct message_type) distinct_message_type_count, count(*) filter (where has_valid_coordinates) valid_position_count, count(*) filter (where has_valid_coordinates is not true) invalid_position_count,
count(*) filter (where position_quality = 'LOW_GPS_PRECISION') low_gps_precision_count, count(*) filter (where speed >= 5) moving_event_count, count(*) filter (where speed < 5) stopped_event_count, {_mean("speed")} average_speed, {_mean("speed", "speed >= 5")} average_speed_while_moving, max(speed) maximum_speed, {_mean("hdop")} average_hdop, min(hdop) minimum_hdop, max(hdop) maximum_hdop,
min(battery_voltage) minimum_battery_voltage, max(battery_voltage) maximum_battery_voltage, {_mean("battery_voltage")} average_battery_voltage, min(internal_battery) minimum_internal_battery, max(internal_battery) maximum_internal_battery, {_mean("internal_battery")} average_internal_battery, {_end("odometer_total", "arg_min")} first_odometer_total, {_end("odometer_total", "arg_max")} last_odometer_total,
min(event_timestamp) filter (where has_valid_coordinates) first_valid_position_at, max(event_timestamp) filter (where has_valid_coordinates) last_valid_position_at, {_end("latitude", "arg_min", "has_valid_coordinates")} first_latitude, {_end("longitude", "arg_min", "has_valid_coordinates")} first_longitude, {_end("latitude", "arg_max", "has_valid_coordinates")} last_latitude, {_end("longitude", "arg_max", "has_valid_coordinates")} last_longitude from tb group by 1, 2),
ds as (select *, {_pct("valid_position_count", "message_count", 2)} valid_position_percentage, case when last_odometer_total >= first_odometer_total then last_odometer_total - first_odometer_total end odometer_delta_raw, coalesce(last_odometer_total < first_odometer_total, false) has_odometer_regression from dd)"""
QUALITY = f"""q0 as (select event_date metric_date, 't' k, null reason from telemetry_events union all select event_date, 'i', null from device_identity_events union all select coalesce(rejection_date, 'unknown'), 'r', rejection_reason from rejected_logs),
q1 as (select metric_date, count(*) filter (where k = 't') telemetry_event_count, count(*) filter (where k = 'i') identity_event_count, count(*) filter (where k <> 'r') accepted_event_count, count(*) filter (where k = 'r') rejected_event_count, count(*) total_event_count, {_pct("count(*) filter (where k = 'r')", "count(*)", 4)} rejection_percentage,
count(*) filter (where reason = 'MISSING_MESSAGE_TYPE') missing_message_type_count, count(*) filter (where reason = 'INVALID_MESSAGE_TYPE') invalid_message_type_count, count(*) filter (where reason = 'MISSING_OR_INVALID_TIMESTAMP') invalid_timestamp_count, count(*) filter (where reason = 'MISSING_DEVICE_SERIAL') missing_device_serial_count, count(*) filter (where reason = 'UNKNOWN_REJECTION_REASON') unknown_rejection_count from q0 group by 1)"""
_HIST = f"hm as (select {_IMEI15 % ('imei', 'imei')} imei, {_SERIAL % 'device_serial_raw'} serial from device_identity_events), hms as (select imei, min(serial) serial from hm where imei is not null and serial is not null group by imei having min(serial) = max(serial))"

SQL = {
    "normalize_text": f"{WITH_N} select row_id, {', '.join(RAW_NAMES.values())} from n",
    "normalize_timestamps": f"{WITH_N} select row_id, server_timestamp, device_timestamp, event_timestamp, strftime(event_timestamp, '%Y-%m-%d') as event_date, ingestion_date from n",
    "cast_telemetry": f"{TYPED} select row_id, report_type, serial_count, {', '.join(silver._DOUBLES)} from t",
    "position_quality": f"{TYPED} select {_QUAL} as position_quality, {_OK} as has_valid_coordinates, count(*) as n from t group by 1, 2",
    "identity_formats": f"{_IDENT} select row_id, iccid, imsi, imei, identity_auxiliary, has_valid_iccid_format, has_valid_imsi_format, has_valid_imei_format from i",
    "imei_serial_map": f"with {NORMAL}, {EVIDENCE}, {SERIALS} select imei, serial from ims",
    "history_serial_map": f"with {_HIST} select imei, serial from hms",
    "merged_serial_map": f"with {NORMAL}, {EVIDENCE}, {SERIALS}, {_HIST} select imei, min(serial) as serial from (select * from ims union all select * from hms) group by imei having min(serial) = max(serial)",
    "file_imei_map": f"with {NORMAL}, {EVIDENCE}, {FILES} select file, imei from fim",
    "resolve_identity": f"{WITH_C} select row_id, device_serial_raw, device_serial, device_resolution_method from c",
    "classify_reasons": f"{WITH_C} select row_id, event_timestamp, rejection_reason from c",
    "silver_telemetry": f"{TYPED} select {_TEL_COLS}, {_OK} as has_valid_coordinates, {_QUAL} as position_quality from t",
    "silver_identity": f"{_IDENT} select * from i",
    "silver_rejected": f"{WITH_C} select coalesce(strftime(event_timestamp, '%Y-%m-%d'), 'unknown') as rejection_date, * from c where rejection_reason is not null",
    "row_ids": "select source_file_hash, source_row_number, sha256(source_file_hash || ':' || source_row_number) as row_id from tracker_logs",
    "dedup_telemetry": f"with {TEL} select row_id, device_serial, event_timestamp from tb",
    "dedup_identity": f"with {IDB} select row_id, device_serial, event_timestamp from ib",
    "dim_device": f"with {TEL}, {IDB}, {DIM} select * from dim",
    "device_last_position": f"with {TEL}, {LASTPOS} select * from lp",
    "device_route_points": f"with {TEL}, {ROUTE} select * from rp",
    "device_daily_summary": f"with {TEL}, {DAILY} select * from ds",
    "data_quality_summary": f"with {QUALITY} select * from q1",
}
