"""Runs of nearly identical consecutive events, each collapsed into one.

Method: adjacent agglomeration. The records of an entity form a linked list of runs; a priority
queue holds every pair of neighbouring runs whose touching records are near enough, and the most
similar pair is merged again and again until none meets the similarity and gap limits. The
similarity of two runs is that of the records that touch, so a merge changes no other pair's, and
runs come out as long as possible whatever the order.

Work is split by range partitions of (device, time). A partition knows the outermost runs of its
rows; those alone are stitched to the runs of the neighbouring partitions. An entity with a third
of all rows is therefore spread over many tasks, and no task holds more than a batch of rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayledger.functions.geo import distance_m, distance_np
from wayledger.operators.track import device_track, from_micros
from wayledger.session import materialize

_SCHEMA = "device_serial string, part int, seq long, start long, end long, n long, flat double, flon double, llat double, llon double, edge int"
_ARROW = pa.schema([("device_serial", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("n", pa.int64()), ("flat", pa.float64()), ("flon", pa.float64()), ("llat", pa.float64()), ("llon", pa.float64()), ("edge", pa.int32())])


def agglomerate(near: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """First index of each run, for a sequence of n records.

    ``near[i]`` says whether records i and i+1 may be merged, ``distance[i]`` how far they are.
    Runs are linked by their ends: ``tail`` of a run's head and ``head`` of its tail.
    """
    n = len(near) + 1
    head, tail = list(range(n)), list(range(n))
    queue = [(float(distance[i]), int(i)) for i in np.flatnonzero(near)]
    heapq.heapify(queue)
    while queue:
        _, i = heapq.heappop(queue)
        h, t = head[i], tail[i + 1]
        tail[h], head[t] = t, h
    heads, h = [], 0
    while h < n:
        heads.append(h)
        h = tail[h] + 1
    return np.array(heads)


def _local_runs(limit_m: float, gap_us: int | None, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None  # the run that the next batch may continue
        seq, opened = 0, False
        for b in batches:
            if b.num_rows == 0:
                continue
            dev = b.column(0).to_numpy(zero_copy_only=False)
            ts, lat, lon = (b.column(i).to_numpy() for i in (1, 2, 3))
            start, end, n, flat, flon, llat, llon = ts, ts, np.ones(len(ts), np.int64), lat, lon, lat, lon
            if held is not None:
                dev = np.concatenate([[held[0]], dev])
                start, end, n, flat, flon, llat, llon = (np.concatenate([[h], x]) for h, x in zip(held[1:], (start, end, n, flat, flon, llat, llon), strict=True))
            dist = distance_np(llat[:-1], llon[:-1], flat[1:], flon[1:])
            near = (dev[:-1] == dev[1:]) & (dist <= limit_m)
            if gap_us is not None:
                near &= start[1:] - end[:-1] <= gap_us
            first = agglomerate(near, dist)
            last = np.append(first[1:], len(dev)) - 1
            total = np.add.reduceat(n, first)
            out = [dev[first], start[first], end[last], total, flat[first], flon[first], llat[last], llon[last]]
            held = tuple(x[-1] for x in out)
            out = [x[:-1] for x in out]
            edge = np.zeros(len(out[0]), np.int32)
            if len(edge) and not opened:
                edge[0], opened = 1, True
            order = seq + np.arange(len(edge))
            seq += len(edge)
            give = (out[3] >= least) | (edge > 0)
            yield _rows(part, order[give], [x[give] for x in out], edge[give])
        if held is not None:
            yield _rows(part, np.array([seq]), [np.array([x]) for x in held], np.array([2 if opened else 3], np.int32))

    return run


def _rows(part: int, seq: np.ndarray, cols: list[np.ndarray], edge: np.ndarray) -> pa.RecordBatch:
    dev, start, end, n, *place = cols
    arrays = [pa.array(list(dev), pa.string()), pa.array(np.full(len(seq), part, np.int32)), pa.array(seq, pa.int64()), *(pa.array(x, pa.int64()) for x in (start, end, n)), *(pa.array(x, pa.float64()) for x in place), pa.array(edge, pa.int32())]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def collapse_runs(telemetry: DataFrame, limit_m: float = 5.0, max_gap_s: float | None = None, min_count: int = 1) -> DataFrame:
    """One row per run of ``min_count`` or more consecutive records of a device.

    Neighbours belong to one run if they are at most ``limit_m`` apart and, if ``max_gap_s`` is
    given, at most that long. Columns: device_serial, run_start, run_end, n_events, duration_s,
    latitude, longitude (of the first record).

    Copies count once and rows without device, event time or usable position (null, NaN, latitude
    beyond 90, 0/0) are left out before neighbours are told (see ``device_track``); records of
    one instant follow its order. An empty table gives no rows; extra columns are ignored.
    """
    gap_us = None if max_gap_s is None else int(max_gap_s * 1e6)
    local = materialize(device_track(telemetry).mapInArrow(_local_runs(limit_m, gap_us, min_count), _SCHEMA), "runs")
    w = Window.partitionBy("device_serial").orderBy("start", "part", "seq")
    before = lambda c: F.lag(c).over(w)
    touches = (before("part") != F.col("part")) & (before("edge").bitwiseAND(2) > 0) & (F.col("edge").bitwiseAND(1) > 0) & (distance_m(before("llat"), before("llon"), F.col("flat"), F.col("flon")) <= limit_m)
    if gap_us is not None:
        touches = touches & (F.col("start") - before("end") <= gap_us)
    border = local.where("edge > 0").withColumn("fresh", F.when(touches, 0).otherwise(1)).withColumn("chain", F.sum("fresh").over(w))
    first = lambda c: F.min_by(c, F.struct("start", "part", "seq")).alias(c)
    stitched = border.groupBy("device_serial", "chain").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"), first("flat"), first("flon")).where(F.col("n") >= min_count).drop("chain")
    runs = local.where("edge = 0").select(*stitched.columns).unionByName(stitched)
    return runs.select("device_serial", from_micros("start").alias("run_start"), from_micros("end").alias("run_end"), F.col("n").alias("n_events"), ((F.col("end") - F.col("start")) / 1e6).alias("duration_s"), F.col("flat").alias("latitude"), F.col("flon").alias("longitude"))
