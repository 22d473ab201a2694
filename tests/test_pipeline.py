"""Files to products: statuses, modes, late batches, and full equals incremental."""

from __future__ import annotations

import csv
import json
import threading
import urllib.request

import pytest

from tests.helpers import rows
from wayledger.config import Settings, csv_variable
from wayledger.contracts import SOURCE_COLUMNS
from wayledger.http_api import answer, make_server, plain_value
from wayledger.plans.ingest import Bronze, control_event, row_id
from wayledger.plans.modes import Gold, Silver, clean_ids
from wayledger.plans.pipeline import format_result, run_pipeline
from wayledger.plans.serve import QueryService, optional_date
from wayledger.sources.csv_files import FileReport, detect_encoding, discover_csv_files, inspect_file, move_file, read_files
from wayledger.store import TableStore

BASE = {"TIPO_LOG": "tracker", "MESS_TYPE": "T2", "REPT_TYPE": "1", "PRT_VER": "1", "S/N ou IMEI": "M100", "BAT_VOLT": "12.5", "LOC_STATUS": "A", "LAT": "-3.7", "LONT": "-38.5", "SPEED": "45.5", "HDOP": "1.2", "ODO_TOTAL": "20000", "SER_COUNT": "15"}


def line(day, clock="12:00:00", **kw):
    r = dict.fromkeys(SOURCE_COLUMNS, "") | BASE | {"TM_STAMP": f"{day} {clock}", "DATA_SERVIDOR": f"{day} {clock}"}
    return r | {k.replace("SN", "S/N ou IMEI"): v for k, v in kw.items()}


def t1(day, clock="10:00:00", serial="M100", imei="350000000000001", **kw):
    return line(day, clock, MESS_TYPE="T1", SN=serial, BAT_VOLT="8955000000000000001", LAT="724000000000001", LONT=imei, **kw)


def write(folder, name, lines, columns=None, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / name, "w", newline="", encoding=encoding) as f:
        w = csv.DictWriter(f, columns or list(lines[0]))
        w.writeheader()
        w.writerows(lines)


@pytest.fixture
def settings(tmp_path):
    return Settings(tmp_path)


def products(spark, settings):
    g = Gold(spark, settings)
    return {k: rows(s.read()) for k, s in g.stores().items()}


def test_files(tmp_path):
    assert discover_csv_files(tmp_path / "none") == []
    for n in ("b.csv", "A.CSV", "c.txt"):
        (tmp_path / n).write_text("x")
    (tmp_path / "sub").mkdir()
    assert [p.name for p in discover_csv_files(tmp_path)] == ["A.CSV", "b.csv"]
    out = tmp_path / "out"
    move_file(tmp_path / "b.csv", out, "k")
    (tmp_path / "b.csv").write_text("y")
    assert move_file(tmp_path / "b.csv", out, "k").name == "b__k.csv"
    (tmp_path / "b.csv").write_text("z")
    with pytest.raises(FileExistsError):
        move_file(tmp_path / "b.csv", out, "k")


def test_inspection(tmp_path):
    def report(name, text, encoding="utf-8"):
        (tmp_path / name).write_text(text, encoding=encoding)
        return inspect_file(str(tmp_path / name))

    head = ",".join(SOURCE_COLUMNS)
    assert report("empty.csv", "").error
    assert report("rows.csv", head + "\n").error == "no data rows"
    assert report("ok.csv", "﻿" + head + ",EXTRA \n" + "a,b\n\n").error is None
    assert report("long.csv", head + "\n" + ",".join("x" * 38) + "\n").error
    assert report("dup.csv", head + ",LAT \nx\n").error.startswith("duplicated")
    assert report("missing.csv", head.replace("LAT,", "") + "\nx\n").error.startswith("missing")
    assert report("reserved.csv", head + ",row_id\nx\n").error.startswith("reserved")
    assert report("x.txt", "a").error == "not a .csv file"
    latin = report("latin.csv", head + "\nção\n", "latin-1")
    assert latin.error is None and latin.encoding == "latin-1"
    assert inspect_file(str(tmp_path / "gone.csv")).hash_failed
    assert detect_encoding(tmp_path / "ok.csv") == "utf-8-sig"


def test_reading_keeps_order_and_text(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('A,B\n1,"x ""y"", z"\n\n2\n3,"two\nlines"\n')
    q = tmp_path / "b.csv"
    q.write_text("A,C\n9,8\n")
    df = read_files(spark, [FileReport(str(p), "h", "utf-8-sig", ("A", "B"), 3), FileReport(str(q), "g", "utf-8-sig", ("A", "C"), 1)])
    assert rows(df, "source_row_number", "A", "B", "C") == [(1, "1", 'x "y", z', None), (1, "9", None, "8"), (2, "2", "", None), (3, "3", "two\nlines", None)]


def test_run_skip_quarantine_and_noop(spark, settings):
    write(settings.inbox, "one.csv", [line("2024-01-01"), t1("2024-01-01"), line("2024-01-01", MESS_TYPE="INVALID"), line("2024-01-01", MESS_TYPE="")])
    write(settings.inbox, "same.csv", [line("2024-01-01"), t1("2024-01-01"), line("2024-01-01", MESS_TYPE="INVALID"), line("2024-01-01", MESS_TYPE="")])
    (settings.inbox / "bad.csv").write_text("A,B\n1,2\n")
    r = run_pipeline(spark, settings)
    assert (len(r.bronze.successful), r.bronze.skipped, r.bronze.failed) == (1, ("same.csv",), ("bad.csv",))
    assert (r.silver.mode, r.gold.mode) == ("FULL", "FULL")
    assert r.bronze.inserted_rows == 4 and "mode=FULL" in format_result(r)
    assert [p.name for p in settings.quarantine.iterdir()] == ["bad.csv"] and len(list(settings.archive.iterdir())) == 2
    status = [x.status for x in Bronze(spark, settings).control.read().collect()]
    assert sorted(status) == ["FAILED", "PROCESSING", "PROCESSING", "SKIPPED", "SUCCESS"]
    s = Silver(spark, settings)
    assert [x.read().count() for x in (s.telemetry, s.identity, s.rejected)] == [1, 1, 2]
    r = run_pipeline(spark, settings)
    assert (r.silver.mode, r.gold.mode, r.has_changes) == ("NOOP", "NOOP", False)


def test_increments_end_where_a_full_build_does(spark, tmp_path):
    legacy = {"PRT_VER": "V14.06.111", "SN": ""}
    loads = [
        [("a.csv", [line("2024-01-01"), line("2024-01-02", SN="M200"), line("2024-01-01", "13:00:00", **legacy)]), ("b.csv", [line("2024-01-03", TM_STAMP="", DATA_SERVIDOR="")])],
        # late for the first day; new evidence resolves a.csv's legacy row of the first day from another day
        [("a.csv", [line("2024-01-01", "09:00:00", SPEED="3"), t1("2024-01-05", imei="350000000000009")]), ("c.csv", [t1("2024-01-02", serial="M200", imei="350000000000009")])],
        # makes that evidence ambiguous again
        [("d.csv", [t1("2024-01-06", serial="M300", imei="350000000000009")])],
    ]
    step, once = Settings(tmp_path / "step"), Settings(tmp_path / "once")
    modes = []
    for k, load in enumerate(loads):
        for name, lines in load:
            write(step.inbox, name, lines)
            write(once.inbox, f"{k}_{name}", lines)
        modes.append(run_pipeline(spark, step).silver.mode)
    assert modes == ["FULL", "INCREMENTAL", "INCREMENTAL"]
    got = products(spark, step)
    run_pipeline(spark, step, full=True)
    assert products(spark, step) == got
    total = sum(len(lines) for load in loads for _, lines in load)
    s = Silver(spark, step)
    assert sum(x.read().count() for x in (s.telemetry, s.identity, s.rejected)) == total


def test_batches_left_by_a_crash_are_taken_along(spark, settings):
    write(settings.inbox, "a.csv", [line("2024-01-01")])
    run_pipeline(spark, settings)
    write(settings.inbox, "b.csv", [line("2024-01-02", SN="M7")])
    Bronze(spark, settings).load()
    r = run_pipeline(spark, settings)
    assert r.silver.mode == "INCREMENTAL" and r.silver.event_dates == ("2024-01-02",)
    assert {d["device_serial"] for d in QueryService(spark, settings).devices().items} == {"100", "7"}


def test_a_uri_as_data_folder_and_rows_that_do_not_fit(spark, tmp_path):
    """Listing, reading and moving by URI; with salvage a long record costs only itself."""
    where = Settings(f"file://{tmp_path}", salvage=True)
    write(tmp_path / "raw" / "inbox", "a.csv", [line("2024-01-01"), line("2024-01-02", SN="M7")])
    with open(tmp_path / "raw" / "inbox" / "a.csv", "a") as f:
        f.write(",".join("x" * 40) + "\n")
    (tmp_path / "raw" / "inbox" / "b.csv").write_text("A,B\n1,2\n")
    r = run_pipeline(spark, where)
    assert (r.bronze.successful, r.bronze.failed, r.bronze.inserted_rows) == (("a.csv",), ("b.csv",), 2)
    b = Bronze(spark, where)
    bad = b.bad_rows.read().collect()
    assert [(x.source_row_number, x.reason, len(x.fields)) for x in bad] == [(3, "column_count", 40)]
    assert sorted(rows(b.table.read(), "source_row_number")) == [(1,), (2,)]
    assert {p.name for p in (tmp_path / "raw" / "archive").iterdir()} == {"a.csv"} and {p.name for p in (tmp_path / "raw" / "quarantine").iterdir()} == {"b.csv"}
    assert discover_csv_files(f"file://{tmp_path}/none", spark) == [] and discover_csv_files(where.inbox, spark) == []
    (tmp_path / "raw" / "inbox" / "a.csv").write_text("A\n")
    assert move_file(f"file://{tmp_path}/raw/inbox/a.csv", where.archive, "k", spark).endswith("/a__k.csv")


class Crash(BaseException):
    """No handler of the code under test catches it."""


def test_a_crash_at_any_commit_is_made_good_by_a_plain_rerun(spark, settings, monkeypatch):
    """Run after run ends at its first, second, third ... commit, until one gets through."""
    legacy = {"PRT_VER": "V14.06.111", "SN": ""}
    write(settings.inbox, "a.csv", [line("2024-01-01"), line("2024-01-02", SN="M200"), line("2024-01-01", "13:00:00", **legacy)])
    run_pipeline(spark, settings)
    write(settings.inbox, "b.csv", [line("2024-01-01", "09:00:00", SPEED="3"), line("2024-01-09"), line("2024-01-09", MESS_TYPE="")])
    write(settings.inbox, "a2.csv", [t1("2024-01-05", imei="350000000000009")])
    publish, left, crashes = TableStore._publish, [0], 0

    def crashing(self, snap):
        left[0] -= 1
        if left[0] < 0:
            raise Crash
        publish(self, snap)

    monkeypatch.setattr(TableStore, "_publish", crashing)
    for allowed in range(40):
        left[0] = allowed
        try:
            run_pipeline(spark, settings)
            break
        except Crash:
            crashes += 1
    monkeypatch.undo()
    assert crashes > 8
    run_pipeline(spark, settings)
    got = products(spark, settings)
    assert {r[0] for r in got["daily_summary"]} == {"2024-01-01", "2024-01-02", "2024-01-09"}
    assert Bronze(spark, settings).table.read().count() == 7 and list(settings.inbox.iterdir()) == []
    assert run_pipeline(spark, settings).has_changes is False
    run_pipeline(spark, settings, full=True)
    assert products(spark, settings) == got


def test_an_increment_reads_only_the_days_it_touches(spark, settings, monkeypatch):
    write(settings.inbox, "a.csv", [line(f"2024-01-{d:02d}", SN=f"M{d}") for d in range(1, 13)])
    run_pipeline(spark, settings)
    write(settings.inbox, "b.csv", [line("2024-01-03", "13:00:00", SN="M3")])
    read, seen = TableStore.read, []

    def watching(self, only=None, snap=None):
        df = read(self, only, snap)
        seen.append((self.path.rsplit("/", 1)[1], {f.rsplit("__part=", 1)[1].split("/")[0] for f in df.inputFiles() if "__part=" in f}))
        return df

    monkeypatch.setattr(TableStore, "read", watching)
    assert run_pipeline(spark, settings).gold.mode == "INCREMENTAL"
    for name in ("telemetry_events", "device_identity_events", "rejected_logs"):
        assert all(days <= {"2024-01-03"} for n, days in seen if n == name)
    assert any(n == "telemetry_events" and days for n, days in seen)


def test_queries_and_http(spark, settings):
    service = QueryService(spark, settings)
    assert answer(service, "/health") == (200, {"status": "ok"})
    assert answer(service, "/api/v1/devices")[0] == 503
    write(settings.inbox, "a.csv", [line("2024-01-01"), line("2024-01-02", SN="M200", LAT=""), line("2024-01-02", "12:30:00")])
    run_pipeline(spark, settings)
    p = service.devices(limit=1)
    assert (p.total, p.returned, p.has_more, p.next_offset) == (2, 1, True, 1)
    assert service.devices(limit=1, offset=1).next_offset is None
    assert service.device("100")["telemetry_event_count"] == 2 and service.device("nope") is None
    assert [r["event_date"] for r in service.route("100", start="2024-01-02").items] == ["2024-01-02"]
    assert [r["event_date"] for r in service.daily().items] == ["2024-01-02", "2024-01-02", "2024-01-01"]
    assert service.quality(end="2024-01-01").total == 1
    for bad in (lambda: service.devices(limit=0), lambda: service.devices(limit=1001), lambda: service.devices(offset=-1), lambda: service.device(" "), lambda: service.daily(start="2024-02-01", end="2024-01-01"), lambda: service.daily(start="x")):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(TypeError):
        service.devices(limit=True)
    assert optional_date("20240131", "d") == "2024-01-31"
    code, body = answer(service, "/api/v1/devices/100/route?start_date=2024-01-01&limit=1")
    assert code == 200 and body["total"] == 2 and body["items"][0]["event_timestamp"] == "2024-01-01T12:00:00"
    assert answer(service, "/api/v1/devices/100/last-position")[0] == 200
    assert answer(service, "/api/v1/devices/200/last-position")[0] == 404
    assert answer(service, "/api/v1/devices/zzz")[0] == 404 and answer(service, "/nope")[0] == 404
    assert answer(service, "/api/v1/daily-summaries?start_date=2024-02-01&end_date=2024-01-01")[0] == 422
    assert answer(service, "/api/v1/devices?limit=x")[0] == 422 and answer(service, "/api/v1/data-quality")[1]["total"] == 2
    assert plain_value(float("nan")) is None
    server = make_server(spark, Settings(settings.data_dir, ("http://a",)), 0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    req = urllib.request.Request(f"http://127.0.0.1:{server.server_address[1]}/api/v1/devices", headers={"Origin": "http://a"})
    with urllib.request.urlopen(req) as got:
        assert got.headers["Access-Control-Allow-Origin"] == "http://a" and json.load(got)["total"] == 2
    server.shutdown()


def test_small_rules(monkeypatch):
    monkeypatch.setenv("X", "a, b,,a")
    assert csv_variable("X") == ("a", "b")
    assert clean_ids([" b", "a", "", "b "]) == ["a", "b"]
    with pytest.raises(ValueError):
        row_id("", 1)
    import datetime as dt

    with pytest.raises(ValueError):
        control_event("b", "f", "odd", started_at=dt.datetime.now())
    with pytest.raises(ValueError):
        control_event("b", "f", "SUCCESS", started_at=dt.datetime.now(dt.UTC), row_count=-1)
    assert control_event("b", "f", " success ", started_at=dt.datetime.now(dt.UTC))[4] == "SUCCESS"


def test_streams(spark, settings, tmp_path):
    from tests.helpers import t, telemetry
    from wayledger.operators.late_events import LateAggregates
    from wayledger.streaming.inbox import stream_inbox, stream_late_aggregates

    write(settings.inbox, "a.csv", [line("2024-01-01")])
    stream_inbox(spark, settings, f"file://{tmp_path}/cp1").awaitTermination()
    assert QueryService(spark, settings).devices().total == 1
    src = f"{tmp_path}/events"
    df = telemetry(spark, [{"device_timestamp": t("2024-01-01 10:10"), "ingested_at": t("2024-01-01 10:11+00:00")}])
    df.write.mode("append").parquet(src)
    stream = lambda: stream_late_aggregates(spark.readStream.schema(df.schema).parquet(src), f"file://{tmp_path}/agg", checkpoint=f"file://{tmp_path}/cp2").awaitTermination()
    stream()
    telemetry(spark, [{"device_timestamp": t("2024-01-01 10:20"), "row_id": "x", "ingested_at": t("2024-01-01 18:00+00:00")}]).write.mode("append").parquet(src)
    stream()
    assert rows(LateAggregates(spark, f"file://{tmp_path}/agg").current(), "published_count", "corrected_count") == [(1, 2)]


def test_command_line_over_the_sample(spark, tmp_path, monkeypatch, capsys):
    from wayledger import cli
    from wayledger.sources.sample import write_sample

    monkeypatch.setenv("WAYLEDGER_DATA_DIR", str(tmp_path))
    write_sample(tmp_path / "raw" / "inbox" / "sample.csv")
    monkeypatch.setattr(cli, "get_session", lambda: spark)
    assert cli.main(["run"]) == 0
    out = capsys.readouterr().out
    assert "inserted_rows=3" in out and "telemetry_rows=1" in out and "rejected_rows=1" in out and "dim_device_rows=1" in out
    assert cli.main(["run", "--full"]) == 0 and "mode=FULL" in capsys.readouterr().out
