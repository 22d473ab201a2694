"""Table contracts: column names, order and types."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {t.simpleString(): t for t in (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType(), T.TimestampType(), T.DateType())}


def _schema(ddl: str) -> T.StructType:
    """A schema from plain DDL; read here, since Spark's own parser needs a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in ddl.split(","))])


# The source columns, in their order.
SOURCE_COLUMNS = [
    "DATA_SERVIDOR", "TM_STAMP", "TIPO_LOG", "MESS_TYPE", "REPT_TYPE", "PRT_VER", "S/N ou IMEI", "TERM_STATUS", "BAT_VOLT", "LOC_STATUS",
    "LAT", "LONT", "SPEED", "DIR", "INT_BATT", "ODO_TRIP", "ODO_TOTAL", "HORIMETER", "HDOP", "MCC",
    "MNC", "LAC", "CELL_ID", "RX_LEVEL", "SER_COUNT", "TX_TECH", "GRP_MSG", "IO_STATUS", "DRIVER_ID", "PASS_ID",
    "RPM", "TACHO_SPD", "TACHO_ODO", "TEMP_1", "TEMP_2", "TEMP_3", "TEMP_4",
]

# The typed layer's names of the 35 source columns that are not times, in source order.
RAW_NAMES = {
    "TIPO_LOG": "log_type", "MESS_TYPE": "message_type", "REPT_TYPE": "report_type_raw", "PRT_VER": "protocol_version", "S/N ou IMEI": "device_serial_raw", "TERM_STATUS": "terminal_status",
    "BAT_VOLT": "battery_voltage_raw", "LOC_STATUS": "location_status_raw", "LAT": "latitude_raw", "LONT": "longitude_raw", "SPEED": "speed_raw", "DIR": "direction_raw", "INT_BATT": "internal_battery_raw",
    "ODO_TRIP": "odometer_trip_raw", "ODO_TOTAL": "odometer_total_raw", "HORIMETER": "horimeter_raw", "HDOP": "hdop_raw", "MCC": "mcc", "MNC": "mnc", "LAC": "lac", "CELL_ID": "cell_id",
    "RX_LEVEL": "rx_level_raw", "SER_COUNT": "serial_count_raw", "TX_TECH": "transmission_technology", "GRP_MSG": "message_group", "IO_STATUS": "io_status", "DRIVER_ID": "driver_id", "PASS_ID": "passenger_id",
    "RPM": "rpm_raw", "TACHO_SPD": "tachograph_speed_raw", "TACHO_ODO": "tachograph_odometer_raw", "TEMP_1": "temperature_1_raw", "TEMP_2": "temperature_2_raw", "TEMP_3": "temperature_3_raw", "TEMP_4": "temperature_4_raw",
}

LINEAGE_COLUMNS = ["source_file", "source_file_hash", "source_row_number", "row_id", "batch_id", "ingested_at", "ingestion_date"]
_LINEAGE = "source_file string, source_file_hash string, source_row_number bigint, row_id string, batch_id string, ingested_at timestamp, ingestion_date string"

# The tables' columns in order, with their types.
TELEMETRY = _schema(
    "event_date string, server_timestamp timestamp_ntz, device_timestamp timestamp_ntz, event_timestamp timestamp_ntz, log_type string, message_type string, "
    "report_type int, protocol_version string, device_serial string, device_resolution_method string, terminal_status string, battery_voltage double, "
    "location_status string, latitude double, longitude double, speed double, direction_degrees double, internal_battery double, odometer_trip double, "
    "odometer_total double, horimeter double, hdop double, mcc string, mnc string, lac string, cell_id string, rx_level double, serial_count bigint, "
    "transmission_technology string, message_group string, io_status string, driver_id string, passenger_id string, rpm double, tachograph_speed double, "
    "tachograph_odometer double, temperature_1 double, temperature_2 double, temperature_3 double, temperature_4 double, source_file string, "
    "source_file_hash string, source_row_number bigint, row_id string, batch_id string, ingested_at timestamp, ingestion_date date, "
    "has_valid_coordinates boolean, position_quality string"
)
IDENTITY = _schema(
    "event_date string, server_timestamp timestamp_ntz, device_timestamp timestamp_ntz, event_timestamp timestamp_ntz, message_type string, report_type int, "
    "protocol_version string, device_serial_raw string, device_serial string, device_resolution_method string, iccid string, identity_auxiliary string, "
    "imsi string, imei string, source_file string, source_file_hash string, source_row_number bigint, row_id string, batch_id string, ingested_at timestamp, "
    "ingestion_date date, has_valid_iccid_format boolean, has_valid_imsi_format boolean, has_valid_imei_format boolean"
)
REJECTED = T.StructType(
    [
        *_schema("rejection_date string, server_timestamp timestamp_ntz, device_timestamp timestamp_ntz"),
        *[T.StructField(c, T.StringType()) for c in RAW_NAMES.values()],
        *_schema(
            "device_serial string, device_resolution_method string, source_file string, source_file_hash string, source_row_number bigint, row_id string, "
            "batch_id string, ingested_at timestamp, ingestion_date date, event_timestamp timestamp_ntz, rejection_reason string"
        ),
    ]
)
BRONZE = T.StructType([*[T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS], *_schema(_LINEAGE)])
DIM_DEVICE = _schema(
    "device_serial string, current_imei string, current_imsi string, current_iccid string, current_identity_auxiliary string, "
    "current_protocol_version string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, first_identity_at timestamp_ntz, "
    "last_identity_at timestamp_ntz, first_telemetry_at timestamp_ntz, last_telemetry_at timestamp_ntz, identity_event_count bigint, "
    "telemetry_event_count bigint, has_identity_event boolean, has_telemetry_event boolean, current_imei_format_valid boolean, "
    "current_imsi_format_valid boolean, current_iccid_format_valid boolean"
)
LAST_POSITION = _schema(
    "device_serial string, last_position_date string, last_position_at timestamp_ntz, received_at timestamp_ntz, latitude double, longitude double, "
    "speed double, direction_degrees double, battery_voltage double, internal_battery double, odometer_total double, horimeter double, hdop double, "
    "rx_level double, message_type string, report_type int, serial_count bigint, protocol_version string, position_quality string, source_file string"
)
ROUTE_POINTS = _schema(
    "event_date string, device_serial string, point_sequence bigint, event_timestamp timestamp_ntz, received_at timestamp_ntz, latitude double, "
    "longitude double, speed double, direction_degrees double, odometer_trip double, odometer_total double, horimeter double, hdop double, rx_level double, "
    "message_type string, report_type int, serial_count bigint, protocol_version string, position_quality string, is_moving boolean, source_file string"
)
DAILY_SUMMARY = _schema(
    "event_date string, device_serial string, first_event_at timestamp_ntz, last_event_at timestamp_ntz, message_count bigint, "
    "distinct_message_type_count bigint, valid_position_count bigint, invalid_position_count bigint, low_gps_precision_count bigint, "
    "valid_position_percentage double, moving_event_count bigint, stopped_event_count bigint, average_speed double, average_speed_while_moving double, "
    "maximum_speed double, average_hdop double, minimum_hdop double, maximum_hdop double, minimum_battery_voltage double, maximum_battery_voltage double, "
    "average_battery_voltage double, minimum_internal_battery double, maximum_internal_battery double, average_internal_battery double, "
    "first_odometer_total double, last_odometer_total double, odometer_delta_raw double, has_odometer_regression boolean, "
    "first_valid_position_at timestamp_ntz, last_valid_position_at timestamp_ntz, first_latitude double, first_longitude double, last_latitude double, "
    "last_longitude double"
)
QUALITY_SUMMARY = _schema(
    "metric_date string, telemetry_event_count bigint, identity_event_count bigint, accepted_event_count bigint, rejected_event_count bigint, "
    "total_event_count bigint, rejection_percentage double, missing_message_type_count bigint, invalid_message_type_count bigint, "
    "invalid_timestamp_count bigint, missing_device_serial_count bigint, unknown_rejection_count bigint"
)
CONTROL = _schema(
    "control_event_id string, batch_id string, source_file string, source_file_hash string, status string, stage string, started_at timestamp, "
    "finished_at timestamp, row_count bigint, inserted_row_count bigint, duplicate_row_count bigint, status_reason string, error_message string, "
    "recorded_at timestamp"
)


def align(df, schema: T.StructType):
    """The contract's columns in its order and types; a missing one is an error, others go.

    Casts are strict: a value that the type can't hold raises when the rows are written.
    """
    from pyspark.sql import functions as F

    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in have]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in schema])
