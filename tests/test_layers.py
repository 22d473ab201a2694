"""Conversions against DuckDB, and the rules of the typed layer and the products."""

from __future__ import annotations

import datetime as dt
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.helpers import identity, rows, t, telemetry
from wayledger.contracts import BRONZE, DAILY_SUMMARY, RAW_NAMES, REJECTED, SOURCE_COLUMNS, TELEMETRY, align
from wayledger.functions import dialect, geo
from wayledger.plans import gold, silver
from wayledger.plans.ingest import insert_only, upsert
from wayledger.plans.modes import affected_devices, affected_partitions, check_key, incremental_scope
from wayledger.plans.serve import ordered

TIMES = [
    "2015-02-03", "2015-02-3", "2015-2-03", "2015/02/03 10:11:12", "2015-02-03 10:11", " 2015-02-03 10:11:12 ", "2015-02-03T10:11:12", "2015-02-03T10:11:12.123456", "2015-02-03 10:11:12.1234567", "2015-02-03 1:11:12", "2015-02-03 10:1:12", "2015-02-03 10:11:1",
    "2015-02-03 24:00:00", "2015-02-03 24:00:01", "2015-02-0310:11:12", "03/02/2015 10:11:12", "1423000000", "2015-02-03 10:11:12 ?", "2015-02-03 10:O1:12", "15-02-03 10:11:12", "2015-02-30 10:11:12", "2015-02-03 10:11:60", "2015-02-03 10", "2015-02-03 10:11:12Z", "2015-02-03 10:11:12 UTC",
    "2015-02-03 10:11:12-03:00", "2015-02-03 10:11:12+03", "2015-02-03 10:11:12.", "2015-02-03T10:11", "2015-02-03  10:11:12", "\t2015-02-03 10:11:12", "2015-02/03 10:11:12", "2015-02-03 ", "20150203", "2015.02.03 10:11:12", "2015\\02\\03 10:11:12", "2015 02 03", "2015-13-01", "2015-02-03 10:11:12 -03:00",
    "", " ", "value", "null", "2015", "2015-08", "2016-02-29", "2015-02-29", "2015-12-31 24:00:00", "2015-02-03 10:60:00",
]
NUMBERS = ["12.5", "+12.5", " 12.5 ", "12.", ".5", "-.5", "1e5", "1E-3", "1_000", "_1", "1__0", "12,5", "12.5d", "12.5f", "inf", "-Infinity", "nan", "NaN", "", "0x1F", "1 2", "\t5", "5\n", "1e400", "--5", "1e", "1_000.5_5", ".", "-", "5 x", "1e5.5", "true", "1e+5", "+inf", "1.5", "2.5", "-1.5", "2147483647.4", "2147483647.5", "-2147483648.5", "9223372036854775807", "9.3e18", "-9.3e18", "0.5", "-0.0"]
TEXTS = ["", " ", "a", " a ", " a ", "\ta\n", "    ", "a b"]


def column(spark, values, make):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def duck(values, sql):
    return [duckdb.execute(f"select {sql}", [v]).fetchone()[0] for v in values]


def test_timestamps(spark):
    assert column(spark, TIMES, dialect.try_timestamp) == duck(TIMES, "try_cast(? as timestamp)")
    assert column(spark, [None, "infinity", "epoch", "12015-02-03 10:11:12"], dialect.try_timestamp) == [None] * 4


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def test_numbers(spark):
    for make, sql in ((dialect.try_double, "try_cast(? as double)"), (dialect.try_integer, "try_cast(try_cast(? as double) as integer)"), (lambda c: dialect.try_integer(c, "bigint"), "try_cast(try_cast(? as double) as bigint)")):
        got, want = column(spark, NUMBERS, make), duck(NUMBERS, sql)
        assert [v for v, a, b in zip(NUMBERS, got, want, strict=True) if not same(a, b)] == []


def test_text(spark):
    assert column(spark, TEXTS, dialect.clean_text) == duck(TEXTS, "nullif(trim(?), '')")
    serials = ["M123", " M123 ", "123", "MM1", "M", "", "\tM9\n", "m1", None]
    assert column(spark, serials, silver.device_serial) == ["123", "123", "123", "M1", None, None, "9", "m1", None]
    assert column(spark, ["350000000000001", " 350000000000001\n", "35", "35000000000000a", None], silver.valid_imei) == ["350000000000001"] * 2 + [None] * 3
    assert column(spark, ["T1", "T1\n", "T", "T27", "xT1", None], lambda c: dialect.full_match(c, "T[0-9]+")) == [True, False, False, True, False, False]


def test_means_and_percentages(spark):
    df = spark.createDataFrame([(1.005,), (1.004,), (None,)], "v double")
    assert df.select(dialect.rounded_mean(F.col("v"), 2)).first()[0] == 1.0
    assert df.where("false").select(dialect.rounded_mean(F.col("v"), 2)).first()[0] is None
    assert math.isnan(spark.createDataFrame([(float("nan"),), (1.0,)], "v double").select(dialect.rounded_mean(F.col("v"), 2)).first()[0])
    mean = lambda *xs: spark.createDataFrame([(x,) for x in xs], "v double").select(dialect.rounded_mean(F.col("v"), 3)).first()[0]
    assert mean(1e25, 1.0, 3.0) == pytest.approx((1e25 + 4) / 3) and mean(4e-7, 2.0, None) == 1.0 and mean(5e-7, 1e300) == pytest.approx(5e299)
    assert mean(0.0005) == 0.001 and mean(1.0, 1.001) == 1.001 and mean(-1.0, -1.001) == -1.001 and mean(float("inf"), 1.0) == float("inf")
    assert mean(9e21, 9e21) == 9e21 and mean(0.3, 0.6, 0.9) == 0.6
    assert spark.range(1).select(dialect.percentage(F.lit(1), F.lit(3), 2), dialect.percentage(F.lit(1), F.lit(0), 2)).first() == (33.33, None)


def test_distance(spark):
    got = spark.range(1).select(geo.distance_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0]
    assert abs(got - 111194.93) < 0.01 and abs(geo.distance_np(0, 0, 0, 1) - got) < 1e-6


def bronze(spark, *recs):
    data = []
    for i, r in enumerate(recs):
        r = dict.fromkeys(SOURCE_COLUMNS, "") | {"TM_STAMP": "2024-01-01 10:00:00", "DATA_SERVIDOR": "2024-01-01 10:00:05", "MESS_TYPE": "T2", "S/N ou IMEI": "M1", "source_file": "a.csv", "source_file_hash": "h", "source_row_number": i + 1, "row_id": f"r{i}", "batch_id": "b", "ingested_at": dt.datetime(2024, 1, 2, tzinfo=dt.UTC), "ingestion_date": "2024-01-02"} | r
        data.append(tuple(r[c] for c in BRONZE.names))
    return spark.createDataFrame(data, BRONZE)


LEGACY = {"PRT_VER": silver.LEGACY_PROTOCOL, "S/N ou IMEI": ""}
IMEI = "350000000000001"


def test_reasons_and_partition(spark):
    b = bronze(spark, {}, {"MESS_TYPE": " T27 "}, {"MESS_TYPE": "T1"}, {"MESS_TYPE": ""}, {"MESS_TYPE": "X", "TM_STAMP": ""}, {"TM_STAMP": "", "DATA_SERVIDOR": "value"}, {"S/N ou IMEI": " M "}, {"TM_STAMP": "bad"})
    s = silver.build_silver(b)
    assert rows(s.rejected, "row_id", "rejection_reason", "rejection_date") == [("r3", "MISSING_MESSAGE_TYPE", "2024-01-01"), ("r4", "INVALID_MESSAGE_TYPE", "2024-01-01"), ("r5", "MISSING_OR_INVALID_TIMESTAMP", "unknown"), ("r6", "MISSING_DEVICE_SERIAL", "2024-01-01")]
    assert rows(s.identity, "row_id") == [("r2",)]
    assert rows(s.telemetry, "row_id", "event_timestamp") == [("r0", t("2024-01-01 10:00")), ("r1", t("2024-01-01 10:00")), ("r7", t("2024-01-01 10:00:05"))]
    assert s.telemetry.schema.names == TELEMETRY.names and s.rejected.schema.names == REJECTED.names
    empty = silver.build_silver(b.where("false"))
    assert [x.count() for x in (empty.telemetry, empty.identity, empty.rejected)] == [0, 0, 0]


def test_types_and_quality(spark):
    b = bronze(spark, {"LAT": "-3.5", "LONT": "200", "SER_COUNT": "2.5", "REPT_TYPE": "x"}, {"LAT": "0", "LONT": "0", "HDOP": "5.1"}, {"LAT": "1", "LONT": "1", "HDOP": "5", "SPEED": "abc"}, {"LAT": "", "LONT": "1"})
    got = rows(silver.build_silver(b).telemetry, "row_id", "has_valid_coordinates", "position_quality", "serial_count", "report_type", "speed")
    assert got == [("r0", False, "INVALID_COORDINATES", 2, None, None), ("r1", True, "LOW_GPS_PRECISION", None, None, None), ("r2", True, "VALID", None, None, None), ("r3", False, "MISSING_COORDINATES", None, None, None)]


def test_identity_fields(spark):
    b = bronze(spark, {"MESS_TYPE": "T1", "BAT_VOLT": "8955000000000000001", "LOC_STATUS": "aux", "LAT": "72400000000000", "LONT": IMEI}, {"MESS_TYPE": "T1", "BAT_VOLT": "1", "LONT": "3500-"})
    got = rows(silver.build_silver(b).identity, "iccid", "identity_auxiliary", "imsi", "imei", "has_valid_iccid_format", "has_valid_imsi_format", "has_valid_imei_format")
    assert got == [("1", None, None, "3500-", False, False, False), ("8955000000000000001", "aux", "72400000000000", IMEI, True, True, True)]


def resolved(spark, *recs, history=None, compat=True):
    r = silver.resolve_identity(silver.normalize(bronze(spark, *recs)), history, compat)
    return [(x.device_serial, x.device_resolution_method) for x in r.orderBy("source_row_number").collect()]


def test_resolution(spark):
    t1 = {"MESS_TYPE": "T1", "LONT": IMEI, "S/N ou IMEI": "M77"}
    assert resolved(spark, t1, LEGACY) == [("77", "DIRECT"), ("77", "LEGACY_IMEI")]
    assert resolved(spark, t1, LEGACY | {"PRT_VER": "V14.06.117"})[1] == (None, "UNRESOLVED")
    assert resolved(spark, t1, LEGACY | {"MESS_TYPE": "T"})[1] == (None, "UNRESOLVED")
    assert resolved(spark, t1, LEGACY | {"TM_STAMP": "", "DATA_SERVIDOR": ""})[1] == (None, "UNRESOLVED")
    assert resolved(spark, t1, LEGACY | {"source_file": "b.csv"})[1] == (None, "UNRESOLVED")
    assert resolved(spark, t1, t1 | {"S/N ou IMEI": "M78"}, LEGACY)[2] == (None, "UNRESOLVED")  # IMEI of two serials
    assert resolved(spark, t1, t1 | {"LONT": "350000000000002"}, LEGACY)[2] == (None, "UNRESOLVED")  # file of two IMEIs
    # a T1 without serial tells the file's IMEI; another file or the history tells its serial
    anonymous = t1 | {"S/N ou IMEI": ""}
    assert resolved(spark, anonymous, LEGACY, t1 | {"source_file": "c.csv"})[1] == ("77", "LEGACY_IMEI")
    past = identity(spark, [{"device_timestamp": t("2024-01-01"), "imei": IMEI, "device_serial_raw": "M55"}])
    inferred = identity(spark, [{"device_timestamp": t("2024-01-01"), "imei": IMEI, "device_serial_raw": None, "device_serial": "55"}])
    assert resolved(spark, anonymous, LEGACY, history=past)[1] == ("55", "LEGACY_IMEI")
    assert resolved(spark, anonymous, LEGACY, history=inferred)[1] == (None, "UNRESOLVED")
    assert resolved(spark, t1, LEGACY, history=past)[1] == (None, "UNRESOLVED")
    torn = identity(spark, [{"device_timestamp": t("2024-01-01"), "imei": IMEI, "device_serial_raw": s} for s in ("M1", "M2")])
    assert resolved(spark, t1, LEGACY, history=torn)[1] == ("77", "LEGACY_IMEI")  # ambiguity dropped per source
    assert resolved(spark, t1, LEGACY, history=torn, compat=False)[1] == (None, "UNRESOLVED")


D = t("2024-01-01 10:00")


def full(spark, *recs):
    df = telemetry(spark, [{"device_timestamp": D, "latitude": 1.0, "longitude": 2.0} | r for r in recs])
    return df.withColumns({"has_valid_coordinates": silver.has_valid_coordinates(), "position_quality": silver.position_quality(), "event_date": F.date_format("event_timestamp", "yyyy-MM-dd")})


def test_dedup(spark):
    same_key = {"serial_count": 1, "speed": 5.0}
    df = full(spark, same_key | {"server_timestamp": D}, same_key | {"server_timestamp": D + dt.timedelta(1)}, same_key | {"server_timestamp": None}, {"serial_count": None}, {"serial_count": None}, {"device_serial": None})
    assert rows(gold.dedup_telemetry(df), "row_id") == [("r1",), ("r3",)]
    ids = identity(spark, [{"device_timestamp": D, "imei": None, "source_file": f} for f in ("a", "b")] + [{"device_timestamp": D, "imei": "x"}])
    assert rows(gold.dedup_identity(ids), "row_id") == [("i1",), ("i2",)]


def test_daily(spark):
    h = lambda n: D + dt.timedelta(hours=n)
    df = full(spark, {"device_timestamp": h(0), "speed": 4.9, "odometer_total": 10.0}, {"device_timestamp": h(1), "speed": 5.0, "odometer_total": None, "latitude": None}, {"device_timestamp": h(2), "speed": None, "odometer_total": 7.0, "hdop": 6.0, "latitude": 3.0}, {"device_timestamp": h(20), "odometer_total": 9.0})
    d = {r.event_date: r for r in gold.daily_summary(df).collect()}
    r = d["2024-01-01"]
    assert (r.message_count, r.valid_position_count, r.invalid_position_count, r.low_gps_precision_count, r.valid_position_percentage) == (3, 2, 1, 1, 66.67)
    assert (r.moving_event_count, r.stopped_event_count, r.average_speed, r.average_speed_while_moving) == (1, 1, 4.95, 5.0)
    assert (r.first_odometer_total, r.last_odometer_total, r.odometer_delta_raw, r.has_odometer_regression) == (10.0, 7.0, None, True)
    assert (r.first_latitude, r.last_latitude, r.first_valid_position_at, r.last_valid_position_at) == (1.0, 3.0, h(0), h(2))
    assert d["2024-01-02"].odometer_delta_raw == 0.0 and not d["2024-01-02"].has_odometer_regression
    assert rows(gold.daily_summary(df, ["2024-01-02"]), "event_date") == [("2024-01-02",)]
    assert gold.daily_summary(df.where("false")).schema.names == DAILY_SUMMARY.names


def test_positions(spark):
    df = full(spark, {"server_timestamp": D}, {"server_timestamp": D + dt.timedelta(1), "latitude": 5.0}, {"device_timestamp": D + dt.timedelta(1), "latitude": 0.0, "longitude": 0.0}, {"device_timestamp": D + dt.timedelta(1), "latitude": None}, {"device_timestamp": D - dt.timedelta(hours=1), "speed": 5.0})
    assert rows(gold.last_position(df), "latitude", "last_position_date") == [(5.0, "2024-01-01")]
    assert rows(gold.route_points(df), "point_sequence", "latitude", "is_moving") == [(1, 1.0, True), (2, 1.0, False), (3, 5.0, False)]


def test_dim_device(spark):
    ids = identity(spark, [{"device_timestamp": D, "imei": "a", "imsi": "s", "protocol_version": "p1"}, {"device_timestamp": D + dt.timedelta(1), "imei": "b"}, {"device_timestamp": D, "device_serial": "D9", "imei": "z"}])
    r = {x.device_serial: x for x in gold.dim_device(full(spark, {"protocol_version": "p2"}, {"device_serial": "D7", "protocol_version": "p3"}), ids).collect()}
    assert (r["D1"].current_imei, r["D1"].current_imsi, r["D1"].current_protocol_version, r["D1"].identity_event_count) == ("b", "s", "p1", 2)
    assert (r["D7"].current_protocol_version, r["D7"].has_identity_event, r["D9"].has_telemetry_event, r["D9"].telemetry_event_count) == ("p3", False, False, 0)
    assert rows(gold.dim_device(full(spark, {}), ids, spark.createDataFrame([("D9",)], "device_serial string")), "device_serial") == [("D9",)]


def test_quality(spark):
    rejected = spark.createDataFrame([("unknown", "MISSING_OR_INVALID_TIMESTAMP"), ("2024-01-01", "UNKNOWN_REJECTION_REASON"), (None, "MISSING_MESSAGE_TYPE")], "rejection_date string, rejection_reason string")
    got = rows(gold.quality_summary(full(spark, {}, {}), identity(spark, []), rejected), "metric_date", "accepted_event_count", "rejected_event_count", "rejection_percentage", "invalid_timestamp_count", "unknown_rejection_count")
    assert got == [("2024-01-01", 2, 1, 33.3333, 0, 1), ("unknown", 0, 2, 100.0, 1, 0)]


def test_scopes_and_merges(spark):
    b = bronze(spark, {"batch_id": "old"}, {"batch_id": "new", "TM_STAMP": "", "DATA_SERVIDOR": ""}, {"batch_id": "new"}, {"batch_id": "old", "TM_STAMP": "2024-03-01"})
    days = affected_partitions(b, spark.createDataFrame([("new",)], "batch_id string"))
    assert rows(days) == [("2024-01-01",), ("unknown",)]
    assert rows(incremental_scope(b, days), "row_id") == [("r0",), ("r1",), ("r2",)]
    assert rows(affected_devices(["2024-01-01"], full(spark, {}, {"device_serial": "D2", "device_timestamp": t("2024-02-01")}), identity(spark, []))) == [("D1",)]
    old, new = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), ("b", 2)], [("b", 3), ("c", 4)]))
    assert rows(insert_only(old, new, "k")) == [("c", 4)] and rows(upsert(old, new, "k")) == [("a", 1), ("b", 3), ("c", 4)]
    for bad in ([("a",), ("a",)], [(None,)]):
        with pytest.raises(ValueError):
            check_key(spark.createDataFrame(bad, "k string"), "k")
    with pytest.raises(ValueError):
        align(old, TELEMETRY)


def test_page_order_puts_unknown_values_last(spark):
    df = spark.createDataFrame([("a", None), ("b", D), ("c", D)], "device_serial string, last_position_at timestamp_ntz")
    assert [r.device_serial for r in ordered(df, "last_position").collect()] == ["b", "c", "a"]


def test_random_increments_of_the_daily_summary(spark):
    """Replacing the touched days after each batch ends where a full build does."""
    rnd = random.Random(8)
    data = [{"device_serial": f"D{rnd.randrange(3)}", "device_timestamp": D + dt.timedelta(hours=rnd.randrange(96)), "speed": float(rnd.randrange(9)), "batch_id": f"b{rnd.randrange(3)}"} for _ in range(60)]
    df = full(spark, *data)
    built = gold.daily_summary(df.where("batch_id = 'b0'"))
    for done in (["b0", "b1"], ["b0", "b1", "b2"]):
        days = [r.event_date for r in df.where(F.col("batch_id") == done[-1]).select("event_date").distinct().collect()]
        built = built.where(~F.col("event_date").isin(days)).unionByName(gold.daily_summary(df.where(F.col("batch_id").isin(done)), days))
    assert rows(built) == rows(gold.daily_summary(df))
    assert set(RAW_NAMES) < set(SOURCE_COLUMNS)


def test_the_typed_layer_is_one_scan_with_a_short_plan(spark, data):
    """Bronze is read once, after a narrow scan for the identity reports, and no expression multiplies."""
    from wayledger.plans import layer_queries

    plan = layer_queries.cast_telemetry(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 30_000 and plan.count("Relation [") == 2 and "Union" not in plan
