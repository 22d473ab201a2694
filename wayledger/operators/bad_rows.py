"""Delimited lines that can't be read, told apart from those that can, each with its reason.

Method: structural indexing. Over the byte buffer of a whole Arrow batch, numpy finds quotes and
commas; the parity of the quotes before a comma tells delimiters from commas inside quotes, and
checks on the neighbours of each quote tell whether the parity can be trusted. Lines whose
quotes stand elsewhere than at field borders are scanned byte by byte. Counts and type checks
then give valid rows or a reason.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUOTING, COLUMN_COUNT, INVALID_VALUE = "quoting", "column_count", "invalid_value"
_SLOW = 2


def scan_line(line: bytes) -> list[bytes] | None:
    """Fields of one line by the plain state machine; None if its quoting is broken."""
    out, i, n = [], 0, len(line)
    while True:
        if i < n and line[i] == 34:
            buf, i = bytearray(), i + 1
            while True:
                j = line.find(b'"', i)
                if j < 0:
                    return None
                buf += line[i:j]
                if j + 1 < n and line[j + 1] == 34:
                    buf.append(34)
                    i = j + 2
                    continue
                i = j + 1
                break
            out.append(bytes(buf))
            if i == n:
                return out
            if line[i] != 44:
                return None
            i += 1
        else:
            j = line.find(b",", i)
            if j < 0:
                out.append(line[i:])
                return out
            out.append(line[i:j])
            i = j + 1


def split_lines(lines: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The fields of each line (null where the quoting is broken), and which are broken.

    A null line counts as empty. A final ``\\r`` is no part of a line.
    """
    arr = lines.cast(pa.large_string()).fill_null("")
    n = len(arr)
    if n == 0:
        return pa.array([], pa.list_(pa.string())), np.zeros(0, bool)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + n + 1]
    data = arr.buffers()[2]
    base = off[0]
    buf = np.frombuffer(data, np.uint8)[base : off[-1]] if data is not None and off[-1] > base else np.zeros(0, np.uint8)
    off = off - base
    lo, hi = off[:-1], off[1:].copy()
    full = hi > lo
    hi[full] -= buf[hi[full] - 1] == 13
    # masks and parity
    inside = np.zeros(len(buf) + 1, np.int64)
    quote = buf == 34
    np.cumsum(quote, out=inside[1:])  # quotes before each byte
    qpos = np.flatnonzero(quote)
    qline = np.searchsorted(lo, qpos, "right") - 1
    opening = ((inside[qpos] - inside[lo[qline]]) & 1) == 0
    prev = np.where(qpos > lo[qline], buf[np.maximum(qpos - 1, 0)], 44)
    nxt = np.where(qpos + 1 < hi[qline], buf[np.minimum(qpos + 1, max(len(buf) - 1, 0))], 44)
    fits = np.where(opening, (prev == 44) | (prev == 34), (nxt == 44) | (nxt == 34))
    state = np.zeros(n, np.int8)
    state[qline[~fits]] = _SLOW
    state[((inside[hi] - inside[lo]) & 1) == 1] = _SLOW
    comma = np.flatnonzero(buf == 44)
    cline = np.searchsorted(lo, comma, "right") - 1
    delim = comma[((inside[comma] - inside[lo[cline]]) & 1) == 0]
    dline = np.searchsorted(lo, delim, "right") - 1
    # value bytes: no delimiters, no border quotes, one of each doubled quote, no final \r
    keep = np.ones(len(buf), bool)
    keep[delim] = False
    keep[qpos] = opening & (prev == 34)
    tail = hi < off[1:]
    keep[hi[tail]] = False
    kept = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    counts = np.bincount(dline, minlength=n) + 1
    first = np.zeros(n + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    ends = np.empty(first[-1], np.int64)
    ends[first[1:] - 1] = hi
    is_last = np.zeros(first[-1], bool)
    is_last[first[1:] - 1] = True
    ends[~is_last] = delim
    offsets = np.concatenate([[0], kept[ends]])
    values = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(buf[keep].tobytes()))
    fast = pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), values).cast(pa.list_(pa.string()))
    slow = np.flatnonzero(state == _SLOW)
    broken = np.zeros(n, bool)
    if len(slow) == 0:
        return fast, broken
    scanned = [scan_line(buf[lo[i] : hi[i]].tobytes()) for i in slow]
    broken[slow] = [s is None for s in scanned]
    patch = pa.array([s and [x.decode("utf-8", "replace") for x in s] for s in scanned], pa.list_(pa.string()))
    take = np.arange(n)
    take[slow] = n + np.arange(len(slow))
    return pa.concat_arrays([fast, patch]).take(pa.array(take)), broken


def _splitter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fields, broken = split_lines(b.column(b.schema.get_field_index("raw_line")))
        rest = [b.column(i) for i in range(b.num_columns)]
        yield pa.RecordBatch.from_arrays([*rest, fields, pa.array(broken)], names=[*b.schema.names, "fields", "broken"])


def _split(df: DataFrame) -> DataFrame:
    slim = df.select("raw_id", "source_file", "line_number", "raw_line")
    return slim.mapInArrow(_splitter, "raw_id long, source_file string, line_number long, raw_line string, fields array<string>, broken boolean")


def stripped(c: Column | str) -> Column:
    """Without blanks of any kind around."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def bad_time(c: Column) -> Column:
    """Neither blank nor a real date and time of day to the second, up to six decimals."""
    v = stripped(c)
    shape = v.rlike(r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z")
    real = F.when(shape, F.replace(v, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")).isNotNull()
    return F.coalesce((v != "") & ~real, F.lit(False))


def bad_latitude(c: Column, message_type: Column) -> Column:
    """Neither blank nor a plain decimal number within 90 degrees, where the type isn't T1."""
    v = stripped(c)
    plain = v.rlike(r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\z")
    fine = F.coalesce(F.abs(F.when(plain, v.try_cast("double"))) <= 90, F.lit(False))
    return F.coalesce((v != "") & ~fine, F.lit(False)) & ~F.coalesce(stripped(message_type) == "T1", F.lit(False))


def read_lines(lines: DataFrame, default_header: Sequence[str]) -> DataFrame:
    """Each record line with its fields or the reason why it can't be read.

    Columns: raw_id, source_file, line_number, raw_line, ``fields`` (null for quoting), ``header``
    (upper-case names), ``places`` (where each column of ``default_header`` stands in it, from 1; 0
    for nowhere), reason (null: valid). Line 1 is its file's header, less a byte order mark; a
    file without a readable one is read by ``default_header``. Blank and null lines are no
    records. Repeated rows each come out; an empty table gives no rows.
    """
    lines = lines.select("raw_id", "source_file", "line_number", "raw_line")
    bare = lines.withColumn("raw_line", F.regexp_replace("raw_line", "^﻿", ""))
    names = F.transform("fields", lambda x: F.upper(stripped(x)))
    columns = [c.upper() for c in default_header]
    headers = _split(bare.where("line_number = 1")).where("not broken").groupBy(F.col("source_file").alias("h_file")).agg(F.min_by(names, "raw_id").alias("header"))
    # names are looked up once a file; every row then has its places
    places = lambda at: F.struct(*[at(c).cast("int").alias(c) for c in columns])
    headers = headers.withColumn("places", places(lambda c: F.array_position("header", F.lit(c))))
    default = F.array(*[F.lit(c) for c in columns])
    records = _split(lines.where("(line_number <> 1 or line_number is null)").where(stripped("raw_line") != ""))
    rows = records.join(headers, F.col("source_file") == F.col("h_file"), "left").withColumns({"header": F.coalesce("header", default), "places": F.coalesce("places", places(lambda c: F.lit(columns.index(c) + 1)))})
    get = lambda name: _field(rows, name)
    reason = (
        F.when(F.col("broken"), QUOTING)
        .when(F.size("fields") != F.size("header"), COLUMN_COUNT)
        .when(bad_time(get("TM_STAMP")) | bad_time(get("DATA_SERVIDOR")) | bad_latitude(get("LAT"), get("MESS_TYPE")), INVALID_VALUE)
    )
    return rows.select("raw_id", "source_file", "line_number", "raw_line", "fields", "header", "places", reason.alias("reason"))


def _field(rows: DataFrame, name: str) -> Column:
    """The text of a named column; null where the file lacks it."""
    known = name in rows.schema["places"].dataType.names
    at = F.col("places").getField(name) if known else F.array_position("header", F.lit(name)).cast("int")
    return F.get("fields", at - 1)


def valid_rows(read: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The valid lines as a table of the given columns, all text; those a file lacks are null."""
    return read.where("reason is null").select("raw_id", "source_file", "line_number", *[_field(read, c.upper()).alias(c.lower()) for c in columns])


def failed_rows(lines: DataFrame, logs: DataFrame, rejected: DataFrame, default_header: Sequence[str]) -> DataFrame:
    """(origin, record_key, reason) of every row of the three tables that can't be read."""
    a = read_lines(lines, default_header).where("reason is not null").select(F.lit("tracker_raw_lines").alias("origin"), F.col("raw_id").cast("string").alias("record_key"), "reason")
    b = logs.where(bad_time(F.col("tm_stamp")) | bad_time(F.col("data_servidor"))).select(F.lit("tracker_logs").alias("origin"), F.col("row_id").alias("record_key"), F.lit(INVALID_VALUE).alias("reason"))
    c = rejected.where(bad_latitude(F.col("latitude_raw"), F.col("message_type"))).select(F.lit("rejected_logs").alias("origin"), F.col("row_id").alias("record_key"), F.lit(INVALID_VALUE).alias("reason"))
    return a.unionByName(b).unionByName(c)
