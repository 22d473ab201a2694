"""Runs of near-identical records, against brute force."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.helpers import rows, t, telemetry
from wayledger.functions.geo import distance_np
from wayledger.llm.runs import agglomerate, collapse_runs


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.floats(0, 9)), max_size=40))
def test_agglomeration_links_all_near_neighbours(pairs):
    near, dist = np.array([p[0] for p in pairs], bool), np.array([p[1] for p in pairs])
    want = [0] + [i + 1 for i, p in enumerate(pairs) if not p[0]]
    assert agglomerate(near, dist).tolist() == want


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_runs_by_brute_force(spark, partitions):
    """One device has most rows, so that its runs cross partition borders."""
    rnd = random.Random(11)
    data, base = [], t("2024-01-01")
    for i in range(400):
        dev = rnd.choice(["A", "A", "A", "B", "C"])
        data.append({"device_serial": dev, "device_timestamp": base + dt.timedelta(seconds=10 * i), "latitude": 1.0 + rnd.choice([0, 0, 0, 0, 1e-3]), "longitude": 2.0, "serial_count": i})
    data += [dict(data[5], row_id="copy", ingested_at=dt.datetime(2025, 1, 1, tzinfo=dt.UTC), latitude=5.0)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = rows(collapse_runs(telemetry(spark, data), min_count=3), "device_serial", "run_start", "run_end", "n_events")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = []
    for dev in "ABC":
        run = []
        for r in [x for x in data[:400] if x["device_serial"] == dev] + [None]:
            if run and (r is None or distance_np(run[-1]["latitude"], 2.0, r["latitude"], 2.0) > 5):
                if len(run) >= 3:
                    want.append((dev, run[0]["device_timestamp"], run[-1]["device_timestamp"], len(run)))
                run = []
            run.append(r)
    assert got == sorted(want, key=str)


def test_gaps_nulls_and_empty(spark):
    base = t("2024-01-01")
    data = [{"device_timestamp": base + dt.timedelta(minutes=m), "latitude": 1.0, "longitude": 2.0} for m in (0, 1, 2, 60, 61)]
    data += [{"device_timestamp": base + dt.timedelta(minutes=1), "latitude": None, "longitude": 2.0}, {"device_timestamp": base, "latitude": 0.0, "longitude": 0.0}, {"device_serial": None, "device_timestamp": base, "latitude": 1.0, "longitude": 2.0}]
    df = telemetry(spark, data).selectExpr("*", "1 as part", "2 as seq", "3 as edge", "4 as ts", "5 as n")
    assert [r[0] for r in rows(collapse_runs(df), "n_events")] == [5]
    assert rows(collapse_runs(df, max_gap_s=600), "n_events", "duration_s") == [(2, 60.0), (3, 120.0)]
    assert collapse_runs(df.where("false")).count() == 0
