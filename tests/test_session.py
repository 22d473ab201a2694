"""Shared folder, scratch tables, code on the workers, and results that don't hang on partitions."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT
from tests.helpers import rows
from wayledger import session
from wayledger.operators import trips


def test_scratch_is_written_once_and_cleared(spark):
    df = session.materialize(spark.range(10), "t")
    assert df.count() == 10 and session.shared_dir(spark)
    assert session.clear_scratch(spark) >= 1 and session.clear_scratch(spark) == 0


@pytest.mark.parametrize("partitions", ["2", "41"])
def test_stops_do_not_depend_on_partitions(spark, data, partitions):
    t = spark.read.parquet(f"{data}/telemetry_events.parquet")
    whole = rows(trips.stops(t))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(trips.stops(t)) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_workers_get_the_code_and_the_named_folder_is_used(tmp_path):
    """From another folder, without PYTHONPATH, with spark.checkpoint.dir set."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from wayledger.session import get_session, shared_dir
from wayledger.sources.csv_files import inspect_files
s = get_session("w", "local[1]", **{{"spark.checkpoint.dir": "file://{tmp_path}/shared", "spark.ui.enabled": "false"}})
assert shared_dir(s) == "file://{tmp_path}/shared"
print("found", [r.error for r in inspect_files(s, ["{tmp_path}/x.csv"])][0] is not None)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "found True" in got.stdout, got.stderr[-2000:]


def test_scratch_tables_go_with_their_scope(spark):
    from wayledger.session import materialize, scratch_scope

    outer = materialize(spark.range(3), "outer")
    with scratch_scope(spark):
        inner = materialize(spark.range(4), "inner")
        files = inner.inputFiles()
        assert inner.count() == 4
    assert outer.count() == 3 and not any(os.path.exists(f.removeprefix("file://")) for f in files)
