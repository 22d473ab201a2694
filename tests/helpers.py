"""Rows for tests."""

from __future__ import annotations

import datetime as dt

from wayledger.contracts import IDENTITY, TELEMETRY


def t(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def telemetry(spark, rows, extra: str = ""):
    """Telemetry rows from dicts; what a dict lacks is null, event time follows the other two."""
    out = []
    for i, r in enumerate(rows):
        r = {"device_serial": "D1", "message_type": "T2", "serial_count": i, "row_id": f"r{i}", "batch_id": "b1"} | r
        r.setdefault("server_timestamp", r.get("device_timestamp"))
        r.setdefault("event_timestamp", r.get("device_timestamp") or r["server_timestamp"])
        if "ingested_at" not in r and r["server_timestamp"]:
            r["ingested_at"] = r["server_timestamp"].replace(tzinfo=dt.UTC)
        out.append(tuple(r.get(c) for c in TELEMETRY.names))
    df = spark.createDataFrame(out, TELEMETRY)
    return df.selectExpr("*", extra) if extra else df


def identity(spark, rows):
    out = []
    for i, r in enumerate(rows):
        r = {"device_serial": "D1", "device_serial_raw": "MD1", "message_type": "T1", "row_id": f"i{i}"} | r
        r.setdefault("event_timestamp", r.get("device_timestamp"))
        if "ingested_at" not in r and r["event_timestamp"]:
            r["ingested_at"] = r["event_timestamp"].replace(tzinfo=dt.UTC)
        for c in ("imei", "iccid", "imsi"):
            r.setdefault(f"has_valid_{c}_format", r.get(c) is not None)
        out.append(tuple(r.get(c) for c in IDENTITY.names))
    return spark.createDataFrame(out, IDENTITY)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str) if cols else sorted((tuple(r) for r in df.collect()), key=str)
