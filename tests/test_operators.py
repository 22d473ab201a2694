"""The data operators on small rows: rules, nulls, ties, copies, empty tables, clashing names."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import identity, rows, t, telemetry
from wayledger.contracts import SOURCE_COLUMNS
from wayledger.functions.geo import distance_np
from wayledger.operators import asof, bad_rows, history, late_events, profile, trips
from wayledger.operators.track import device_track
from wayledger.store import changed_parts

CLASH = "1 as part, 'x' as seq, 2 as rn, 3 as tie, 4 as period, 5 as bucket, 6 as load, 7 as value, 8 as n, 9 as alone, 10 as at, 11 as entity, 12 as hour_start, 13 as seen"


def z(text):
    return t(text).replace(tzinfo=dt.UTC)


# late events ------------------------------------------------------------------------------


def late_rows(spark):
    d = t("2024-01-01 10:10")
    return telemetry(spark, [
        {"device_timestamp": d, "ingested_at": z("2024-01-01 10:11")},
        {"device_timestamp": t("2024-01-01 10:20"), "ingested_at": z("2024-01-01 12:00")},  # just in time
        {"device_timestamp": t("2024-01-01 10:30"), "ingested_at": z("2024-01-01 12:00:01")},  # a correction
        {"device_timestamp": t("2024-01-01 10:40"), "ingested_at": z("2024-01-04 11:00:01")},  # too late
        {"device_timestamp": d, "serial_count": 0, "ingested_at": z("2024-01-02 09:00")},  # a copy of the first
        {"device_timestamp": t("2030-01-01"), "server_timestamp": t("2024-01-01 20:15"), "ingested_at": z("2024-01-02")},  # clock ahead
        {"device_timestamp": None, "server_timestamp": t("2024-01-01 21:15"), "ingested_at": None},
        {"device_timestamp": None, "server_timestamp": None, "event_timestamp": None, "ingested_at": z("2024-01-01")},
        {"device_serial": None, "device_timestamp": d, "ingested_at": z("2024-01-01 13:00")},
    ])


EXPECTED_HOURS = [
    ("D1", "2024-01-01 10:00:00", 2, 3, 1),
    ("D1", "2024-01-01 20:00:00", 0, 1, 0),
    ("D1", "2024-01-01 21:00:00", 0, 0, 1),
    (None, "2024-01-01 10:00:00", 0, 1, 0),
]


def hours(agg):
    return rows(agg.current().select("device_serial", late_events.as_text("hour_start"), "published_count", "corrected_count", "excluded_count"))


@pytest.mark.parametrize("batches", [1, 3])
def test_late_hours(spark, batches):
    assert hours(late_events.replay(late_rows(spark).selectExpr("*", *CLASH.split(", ")), batches)) == sorted(EXPECTED_HOURS, key=str)


def test_late_batches_in_any_order_and_twice(spark, tmp_path):
    df = late_rows(spark)
    agg = late_events.LateAggregates(spark, f"file://{tmp_path}/a")
    parts = [df.where(F.col("row_id").isin(ids)) for ids in (["r4", "r3"], ["r1", "r2"], ["r0", "r5", "r6"], ["r7", "r8"], ["r6", "r0"])]
    touched = [agg.apply(p) for p in parts]
    assert hours(agg) == sorted(EXPECTED_HOURS, key=str)
    assert touched[0] == ["2024-01-01"] and agg.apply(df.where("false")) == []


def test_late_empty(spark):
    assert late_events.corrected_hours(telemetry(spark, [])).count() == 0


def test_late_found(spark):
    assert rows(late_events.corrected_hours(late_rows(spark))) == sorted([("D1", "2024-01-01 10:00:00"), ("D1", "2024-01-01 20:00:00"), (None, "2024-01-01 10:00:00")], key=str)


# history ----------------------------------------------------------------------------------


def test_history_rules(spark):
    df = identity(spark, [
        {"event_timestamp": t("2024-01-01 10:00"), "imei": "1" * 14 + "2"},
        {"event_timestamp": t("2024-01-02 10:00"), "imsi": "72401"},  # a first value is no change
        {"event_timestamp": t("2024-01-03 10:00"), "imei": "999999999999999"},  # filler
        {"event_timestamp": t("2024-01-04 10:00"), "imei": "333333333333334", "has_valid_imei_format": False},
        {"event_timestamp": t("2024-01-20 10:00"), "imei": "333333333333334"},  # a change, in another period
        {"event_timestamp": t("2024-01-20 10:00"), "imei": "333333333333334"},  # repeated
        {"event_timestamp": t("2024-02-20 10:00"), "imei": "333333333333334", "imsi": "72402"},
        {"event_timestamp": None, "imei": "444444444444445"},
        {"device_serial": None, "event_timestamp": t("2024-01-01 10:00"), "imei": "444444444444445"},
    ])
    assert rows(history.identity_changes(df)) == [("D1", "2024-01-20 10:00:00"), ("D1", "2024-02-20 10:00:00")]
    h = history.attribute_history(history.identity_reports(df), ["imei", "imsi"])
    got = rows(h.select("valid_from", "valid_to", "imei", "imsi"))
    a, b = "1" * 14 + "2", "333333333333334"
    assert got == [
        (t("2024-01-01 10:00"), t("2024-01-02 10:00"), a, None),
        (t("2024-01-02 10:00"), t("2024-01-20 10:00"), a, "72401"),
        (t("2024-01-20 10:00"), t("2024-02-20 10:00"), b, "72401"),
        (t("2024-02-20 10:00"), None, b, "72402"),
    ]
    assert history.identity_changes(identity(spark, [])).count() == 0


@pytest.mark.parametrize("days", [1, 7, 400])
def test_history_is_the_same_for_any_checkpoint_spacing(spark, days):
    rnd = random.Random(5)
    base = t("2024-01-01")
    data = [{"device_serial": f"D{rnd.randrange(3)}", "event_timestamp": base + dt.timedelta(hours=rnd.randrange(900)), "imei": rnd.choice([None, "a1", "b2"]), "iccid": rnd.choice([None, "c3", "d4"])} for _ in range(120)]
    got = rows(history.identity_changes(identity(spark, data), days))
    want, state = set(), {}
    for i, r in sorted(enumerate(data), key=lambda x: (x[1]["event_timestamp"], f"i{x[0]}")):
        s = state.setdefault(r["device_serial"], {})
        for a in ("imei", "iccid"):
            if r[a] is not None:
                if s.get(a) not in (None, r[a]):
                    want.add((r["device_serial"], r["event_timestamp"].strftime("%Y-%m-%d %H:%M:%S")))
                s[a] = r[a]
    assert got == sorted(want)


def test_history_store_takes_late_reports_and_tells_the_past(spark, tmp_path):
    rnd = random.Random(6)
    base = t("2024-01-01")
    data = [{"device_serial": f"D{rnd.randrange(3)}", "event_timestamp": base + dt.timedelta(hours=rnd.randrange(900)), "imei": rnd.choice([None, "a1", "b2"]), "iccid": rnd.choice([None, "c3", "d4"])} for _ in range(90)]
    reports = history.identity_reports(identity(spark, data)).cache()
    part = lambda k: reports.where(F.pmod(F.xxhash64("tie.id"), F.lit(3)) == k)
    store = history.HistoryStore(spark, f"file://{tmp_path}/h", ["imei", "iccid"], 7)
    for k in range(3):
        assert store.update(part(k))
    assert store.update(reports.where("false")) == []
    # a late report of one entity leaves the periods without reports of it as they are
    before = store.versions.snapshot()
    late = reports.where("entity = 'D1'").limit(1)
    first = late.select(history._period(7)).first()[0]
    own = {str(r.period) for r in reports.where("entity = 'D1'").select(history._period(7)).distinct().collect() if r.period >= first}
    assert {str(x) for x in store.update(late)} == own == changed_parts(before, store.versions.snapshot())
    h = history.attribute_history(reports, ["imei", "iccid"])
    assert rows(store.history()) == rows(h)
    assert rows(history.attribute_history(reports.where("false"), ["imei", "iccid"])) == []
    at = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    want = rows(h.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))), "entity", "imei", "iccid")
    assert rows(store.as_of(at), "entity", "imei", "iccid") == want and want


# trips ------------------------------------------------------------------------------------


def drive(stops, step=120):
    """Pings: (minutes, lat) standing, then three pings on the way to the next place."""
    out, now = [], t("2024-01-01 08:00")
    for k, (minutes, lat) in enumerate(stops):
        for _ in range(minutes * 60 // step + 1):
            out.append((now, lat, 9.2))
            now += dt.timedelta(seconds=step)
        for j in range(1, 4):
            out.append((now, lat + 0.004 * j, 9.21 - 0.001 * j - 0.1 * k))
            now += dt.timedelta(seconds=step)
    return out


def pings(spark, points, **kw):
    return telemetry(spark, [{"device_timestamp": ts, "latitude": y, "longitude": x} | kw for ts, y, x in points])


def test_stops_and_trips(spark):
    points = drive([(20, 45.1), (6, 45.2), (30, 45.3)])
    points.insert(5, (points[4][0] + dt.timedelta(seconds=30), 45.6, 9.9))  # one stray ping
    df = pings(spark, points).unionByName(telemetry(spark, [{"device_timestamp": t("2024-01-01 08:01"), "latitude": y, "longitude": x, "row_id": f"bad{y}{x}", "serial_count": 900} for y, x in ((None, 1.0), (95.0, 1.0), (0.0, 0.0), (float("nan"), 1.0), (1.0, None), (1.0, float("nan")))]))
    got = trips.stops_and_trips(df.selectExpr("*", *CLASH.split(", "))).orderBy("start_at").collect()
    assert [r.kind for r in got] == ["stop", "trip", "stop"]
    assert [(r.start_at.strftime("%H:%M"), r.end_at.strftime("%H:%M")) for r in got] == [("08:00", "08:20"), ("08:20", "08:42"), ("08:42", "09:12")]
    assert got[0].n_records == 11 and got[1].distance_m > 20_000
    assert trips.stops_and_trips(telemetry(spark, [])).count() == 0


def test_two_pings_elsewhere_end_a_stop_and_silence_does_not(spark):
    a = [(t("2024-01-01 08:00") + dt.timedelta(minutes=5 * i), 45.1, 9.2) for i in range(5)]
    away = [(t("2024-01-01 08:22"), 44.9, 9.2), (t("2024-01-01 08:23"), 45.0, 9.2)]
    b = [(t("2024-01-01 08:25") + dt.timedelta(minutes=5 * i), 45.1, 9.2) for i in range(5)]
    later = [(t("2024-01-02 20:00"), 45.1, 9.2)]
    text = lambda df: rows(df.select(late_events.as_text("start_at"), late_events.as_text("end_at")))
    assert text(trips.stops(pings(spark, a + away + b))) == [("2024-01-01 08:00:00", "2024-01-01 08:20:00"), ("2024-01-01 08:25:00", "2024-01-01 08:45:00")]
    assert text(trips.stops(pings(spark, a + away[:1] + b + later))) == [("2024-01-01 08:00:00", "2024-01-02 20:00:00")]


def made_track(rnd, n, noise, drift):
    """Pings that stand, walk off slowly, stray and drive."""
    points, y, x, now, going = [], 45.0, 9.0, 0, 0.0
    for _ in range(n):
        going = rnd.choice([0.0, 0.0, 0.0, 0.004, -0.01]) if rnd.random() < 0.15 else going
        y, x = y + going + drift, x + going / 2
        stray = 0.05 * (rnd.random() < 0.06)
        points.append((now, y + stray + rnd.gauss(0, noise / 111_000), x + rnd.gauss(0, noise / 78_000)))
        now += rnd.choice([0, 60, 300, 400]) * 1_000_000
    return points


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0, 8, 22, 35, 60]), st.sampled_from([0.0, 0.0, 2e-5, 2e-4]), st.integers(0, 40), st.integers(1, 25))
def test_stops_do_not_depend_on_cuts(seed, noise, drift, cuts, batch):
    """Any partitions and batches give exactly the stops and ways of one pass, ping by ping."""
    rnd = random.Random(seed)
    rules = (100.0 / trips._DEG_M, 100.0, 15 * 60 * 1_000_000)
    tracks = {f"d{k}": made_track(rnd, rnd.choice([1, 3, 40, 150]), noise, drift) for k in range(3)}
    want = []
    for name, points in tracks.items():
        p = trips.Places(*rules)
        for ping in points:
            p.ping(*ping)
        p.finish()
        odo = 0.0
        for s in p.closed:
            odo += s[5]
            want.append((name, *s[:5], odo))
    every = [(name, *ping) for name, points in tracks.items() for ping in points]
    at = sorted(rnd.randrange(len(every) + 1) for _ in range(cuts))
    kinds = [pa.string(), pa.int64(), pa.float64(), pa.float64()]

    def batches(rows_in):
        for k in range(0, len(rows_in), batch):
            yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*rows_in[k : k + batch], strict=True), kinds, strict=True)], names=["device_serial", "ts", "lat", "lon"])

    local = [r for k, (a, b) in enumerate(zip([0, *at], [*at, len(every)], strict=True)) for out in trips.settle(k, batches(every[a:b]), *rules) for r in out.to_pylist()]
    border = sorted((r for r in local if r["kind"] != trips.STOP), key=lambda r: (r["device_serial"], r["part"], r["seq"]))
    sent = [pa.RecordBatch.from_pylist(border[k : k + batch], schema=trips._ARROW) for k in range(0, len(border), batch)]
    rows_out = [r for r in local if r["kind"] == trips.STOP] + [r for out in trips.replay(sent, *rules) for r in out.to_pylist()]
    got, odo = [], {}
    for r in sorted(rows_out, key=lambda r: (r["device_serial"], r["part"], r["seq"], r["start"])):
        odo[r["device_serial"]] = odo.get(r["device_serial"], 0.0) + r["way"]
        if r["kind"] == trips.STOP:
            got.append((r["device_serial"], r["start"], r["end"], r["n"], r["lat"], r["lon"], odo[r["device_serial"]]))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[4:6] == pytest.approx(w[4:6], abs=1e-12) and g[6] == pytest.approx(w[6], abs=1e-3)


def test_partition_number_is_no_matter(spark, data):
    df = spark.read.parquet(f"{data}/telemetry_events.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("2", "41"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            got.append([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows(trips.stops_and_trips(df))])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[0] == got[1] and got[0]


def test_same_instant_follows_row_id(spark):
    """Copies that came in together: the least row id stands; equal times follow counter, type, row id."""
    d = t("2024-01-01 10:00")
    rnd = random.Random(4)
    ids = [f"{rnd.randrange(10**9):x}" for _ in range(40)]
    copies = [{"device_timestamp": d, "serial_count": 1, "row_id": i, "latitude": 10.0 + k, "longitude": 5.0} for k, i in enumerate(ids)]
    got = device_track(telemetry(spark, copies)).collect()
    assert [(r.lat, r.lon) for r in got] == [(10.0 + ids.index(min(ids)), 5.0)]
    alone = [{"device_timestamp": None, "server_timestamp": d, "serial_count": 1, "row_id": i, "latitude": 10.0 + k, "longitude": 5.0} for k, i in enumerate(ids)]
    mixed = alone + [{"device_timestamp": d, "serial_count": 0, "row_id": "z", "latitude": 1.0, "longitude": 5.0}, {"device_timestamp": d, "serial_count": 1, "message_type": "T1", "row_id": "z2", "latitude": 2.0, "longitude": 5.0}]
    assert [r.lat for r in device_track(telemetry(spark, mixed)).collect()] == [1.0, 2.0, *[10.0 + ids.index(i) for i in sorted(ids)]]


# rows that fail to parse ------------------------------------------------------------------

FIELD = st.text(alphabet='a,"\r x1', max_size=5)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(FIELD, min_size=1, max_size=5).map(",".join)), max_size=12))
def test_structural_split_equals_the_scan(lines):
    fields, broken = bad_rows.split_lines(pa.array(lines, pa.string()))
    for got, bad, text in zip(fields.to_pylist(), broken, lines, strict=True):
        raw = (text or "").encode()
        want = bad_rows.scan_line(raw[:-1] if raw.endswith(b"\r") else raw)
        assert bad == (want is None)
        if want is not None:
            assert got == [w.decode() for w in want]


def raw_lines(spark, *lines, file="f"):
    return spark.createDataFrame([(i, file, i, x) for i, x in enumerate(lines, 1)], "raw_id long, source_file string, line_number long, raw_line string")


def test_reasons(spark):
    head = "﻿TM_STAMP,DATA_SERVIDOR,LAT,MESS_TYPE"
    df = raw_lines(
        spark, head, "2024-01-01 10:00:00,,1.5,T2", '"2024-01-01T10:00:00.123456"," ",1.5,T2\r', "", "  ", None,
        '"a,b', '"a"b,c,d,e', "a,b", "2024-02-30 10:00:00,,,", ",2024-01-01,,", ",,95,T2", ",,95, T1 ", ",,1e1,T2", ",, -1.5 ,", ",,1,5,T2", 'x"y,,,',
    ).selectExpr("*", "'c' as header", "'d' as fields", "'e' as broken")
    got = {r.raw_id: r.reason for r in bad_rows.read_lines(df, SOURCE_COLUMNS).collect()}
    assert got == {2: None, 3: None, 7: "quoting", 8: "quoting", 9: "column_count", 10: "invalid_value", 11: "invalid_value", 12: "invalid_value", 13: None, 14: "invalid_value", 15: None, 16: "column_count", 17: "invalid_value"}
    good = rows(bad_rows.valid_rows(bad_rows.read_lines(df, SOURCE_COLUMNS), ["TM_STAMP", "LAT", "ODD"]), "tm_stamp", "lat", "odd")
    assert ("2024-01-01T10:00:00.123456", "1.5", None) in good and len(good) == 4


def test_lines_without_header_and_none(spark):
    df = raw_lines(spark, "x", file="g").withColumn("line_number", F.lit(5).cast("long"))
    assert [r.reason for r in bad_rows.read_lines(df, SOURCE_COLUMNS).collect()] == ["column_count"]
    assert bad_rows.read_lines(df.where("false"), SOURCE_COLUMNS).count() == 0
    long = raw_lines(spark, "TM_STAMP,DATA_SERVIDOR,LAT,MESS_TYPE", ",,," + "x" * 2_000_000)
    assert [r.reason for r in bad_rows.read_lines(long, SOURCE_COLUMNS).collect()] == [None]


# profile ----------------------------------------------------------------------------------


def profile_rows(spark):
    v, n = "V14.06.117", 40
    normal = [{"batch_id": f"b{b}", "latitude": float(i), "rx_level": -70.0 - i % 5, "protocol_version": v} for b in range(6) for i in range(n)]
    odd = (
        [{"batch_id": "nulls", "latitude": None if i % 2 else 1.0, "rx_level": -70.0 - i % 5, "protocol_version": v} for i in range(n)]
        + [{"batch_id": "range", "latitude": 95.0 if i % 10 == 0 else 1.0, "rx_level": -70.0 - i % 5, "protocol_version": v} for i in range(n)]
        + [{"batch_id": "const", "latitude": 1.0, "rx_level": -72.0 if i % 5 else -70.0, "protocol_version": "v14.06.117" if i % 8 == 0 else v} for i in range(n)]
        + [{"batch_id": "shift", "latitude": 1.0, "rx_level": -90.0 - i % 5, "protocol_version": "V99.99.999"} for i in range(n)]
        + [{"batch_id": "void", "latitude": None, "rx_level": None, "protocol_version": None}]
        + [{"batch_id": None, "latitude": float("nan"), "rx_level": -0.0, "protocol_version": ""} for _ in range(1)]
    )
    data = normal + odd
    return telemetry(spark, [{"device_timestamp": t("2024-01-01"), "row_id": f"x{i}"} | r for i, r in enumerate(data)])


def test_findings(spark):
    got = rows(profile.load_findings(profile_rows(spark).selectExpr("*", *CLASH.split(", "))))
    void = [("void", c, "null_rate") for c in ("latitude", "protocol_version", "rx_level")]
    none = [(None, "latitude", "out_of_range"), (None, "rx_level", "out_of_range"), (None, "rx_level", "constant"), (None, "protocol_version", "pattern"), (None, "protocol_version", "distribution")]
    want = [("nulls", "latitude", "null_rate"), ("range", "latitude", "out_of_range"), ("const", "rx_level", "constant"), ("const", "protocol_version", "pattern"), ("shift", "rx_level", "distribution"), ("shift", "protocol_version", "distribution")]
    assert got == sorted(want + void + none, key=str)


def test_profile(spark):
    df = profile_rows(spark)
    p = {(r.batch_id, r.column_name): r for r in profile.column_profile(df).collect()}
    assert len(p) == 12 * (len(df.columns) - 1)
    r = p["b0", "rx_level"]
    assert (r.n_rows, r.n_null, r.n_distinct, r.min_number, r.max_number) == (40, 0, 5, -74.0, -70.0)
    assert 0 < p["b0", "protocol_version"].psi < 2 < p["shift", "protocol_version"].psi
    assert p["void", "speed"].null_rate == 1.0 and p["void", "speed"].n_distinct == 0
    assert profile.column_profile(telemetry(spark, [])).count() == 0 and profile.load_findings(telemetry(spark, [])).count() == 0


# as known at event time -------------------------------------------------------------------


def test_as_known(spark):
    d = identity(spark, [
        {"event_timestamp": t("2024-01-01 10:00"), "imei": "10", "ingested_at": z("2024-01-01 10:05")},
        {"event_timestamp": t("2024-01-01 12:00"), "imei": "21", "ingested_at": z("2024-01-01 12:05")},
        {"event_timestamp": t("2024-01-01 11:00"), "imei": "32", "ingested_at": z("2024-01-01 13:00")},  # late and older
        {"event_timestamp": t("2024-01-01 14:00"), "imei": "43", "ingested_at": z("2024-01-01 13:00")},  # ahead of time
        {"event_timestamp": t("2024-01-01 15:00"), "imei": "999", "ingested_at": z("2024-01-01 15:00")},  # filler
        {"event_timestamp": t("2024-01-01 15:00"), "imei": None},
        {"device_serial": "D2", "event_timestamp": t("2024-01-01 10:00"), "imei": "10"},  # never another
    ])
    e = telemetry(spark, [{"device_timestamp": t(f"2024-01-01 {c}")} for c in ("10:04", "10:05", "12:04", "12:05", "13:30", "14:00", "23:00")] + [{"device_serial": "D2", "device_timestamp": t("2024-01-01 23:00")}, {"device_serial": None, "device_timestamp": t("2024-01-01 23:00")}])
    got = rows(asof.imei_at_event(e.selectExpr("*", *CLASH.split(", ")), d))
    assert got == [("r1", "10"), ("r2", "10"), ("r3", "21"), ("r4", "21"), ("r5", "43"), ("r6", "43")]
    assert rows(asof.imei_at_event(e, d, only_changed=False)) == [*got, ("r7", "10")]
    assert asof.imei_at_event(e.where("false"), d).count() == 0 and asof.imei_at_event(e, d.where("false")).count() == 0


def test_as_known_keeps_events_that_match_nothing(spark):
    v = spark.createDataFrame([("a", t("2024-01-01 00:00"), "x"), ("a", t("2024-01-03 00:00"), "y")], "entity string, avail timestamp_ntz, value string")
    e = spark.createDataFrame([("1", "a", t("2023-12-31")), ("2", "a", t("2024-01-01")), ("3", "a", t("2024-01-02 23:59")), ("4", "a", t("2024-01-03")), ("5", "b", t("2024-01-03")), ("6", None, t("2024-01-03")), ("7", "a", None), ("2", "a", t("2024-01-01"))], "id string, entity string, at timestamp_ntz")
    want = [("1", None), ("2", "x"), ("2", "x"), ("3", "x"), ("4", "y"), ("5", None), ("6", None), ("7", None)]
    for rows_per_bucket in (100_000, 1):
        assert rows(asof.as_known(e, v, rows_per_bucket)) == want
    assert rows(asof.as_known(e, v.where("false"))) == [(k, None) for k, _ in want]


def test_a_hot_entity_and_day_are_cut_into_shares(spark):
    """One entity has 90 % of the events, half of them on one day."""
    hot = spark.range(9000).selectExpr("cast(id as string) id", "'h' entity", "case when id % 2 = 0 then timestamp_ntz '2024-05-05 00:00:00' + make_dt_interval(0, 0, 0, id) else timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(id % 100 as int)) end at")
    cold = spark.range(1000).selectExpr("cast(-id as string) id", "concat('c', id % 50) entity", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(id % 100 as int)) at")
    v = spark.range(100).selectExpr("'h' entity", "timestamp_ntz '2024-01-01 12:00:00' + make_dt_interval(cast(id as int)) avail", "cast(id as string) value")
    events = hot.unionByName(cold)
    got = asof.as_known(events, v, 200)
    assert got.count() == 10_000
    want = dict(rows(events.join(v, "entity", "left").where("at >= avail").groupBy("id").agg(F.max_by("value", "avail").alias("value"))))
    assert {k: x for k, x in rows(got) if x is not None} == want


def test_as_known_by_brute_force(spark):
    rnd = random.Random(3)
    base = t("2024-01-01")
    at = lambda: base + dt.timedelta(minutes=rnd.randrange(4000))
    ids = [{"device_serial": f"D{rnd.randrange(2)}", "event_timestamp": (a := at()), "ingested_at": (a + dt.timedelta(minutes=rnd.choice([-30, 0, 5, 900]))).replace(tzinfo=dt.UTC), "imei": rnd.choice(["12", "23", "34"])} for _ in range(60)]
    ev = [{"device_serial": f"D{rnd.randrange(2)}", "device_timestamp": at(), "serial_count": i} for i in range(300)]
    got = dict(rows(asof.imei_at_event(telemetry(spark, ev), identity(spark, ids))))
    for i, e in enumerate(ev):
        known = [(r["event_timestamp"], r["ingested_at"], f"i{k}", r["imei"]) for k, r in enumerate(ids) if r["device_serial"] == e["device_serial"] and max(r["event_timestamp"], r["ingested_at"].replace(tzinfo=None)) <= e["device_timestamp"]]
        assert got.get(f"r{i}") == (max(known)[3] if known else None)


def naive_stops(points, radius=100.0, minutes=15):
    """Grow a place from each ping in turn, around the median of its pings."""
    out, i = [], 0
    while i < len(points):
        held, last, j = [points[i]], i, i + 1
        while j < len(points):
            lats, lons = sorted(p[1] for p in held), sorted(p[2] for p in held)
            centre = lats[len(lats) // 2], lons[len(lons) // 2]
            if distance_np(*centre, points[j][1], points[j][2]) <= radius:
                held.append(points[j])
                last = j
            elif j - last >= 2:
                break
            j += 1
        if points[last][0] - points[i][0] >= dt.timedelta(minutes=minutes):
            out.append((points[i][0], points[last][0]))
            i = last + 1
        else:
            i += 1
    return out


def test_stops_by_brute_force(spark, data):
    df = spark.read.parquet(f"{data}/telemetry_events.parquet")
    seen, tracks = set(), {}
    cols = ["device_serial", "device_timestamp", "message_type", "serial_count", "event_timestamp", "latitude", "longitude"]
    for r in df.orderBy("ingested_at", "row_id").select(*cols).collect():
        key = (r.device_serial, r.device_timestamp, r.message_type, r.serial_count)
        if r.device_timestamp is not None and key in seen:
            continue
        seen.add(key)
        if r.latitude is not None and r.longitude is not None and abs(r.latitude) <= 90 and (r.latitude, r.longitude) != (0, 0):
            tracks.setdefault(r.device_serial, []).append((r.event_timestamp, r.latitude, r.longitude))
    want = [(dev, *s) for dev, p in tracks.items() for s in naive_stops(sorted(p))]
    assert rows(trips.stops(df)) == sorted(want, key=str) and want
