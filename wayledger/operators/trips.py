"""Stops and trips from noisy location pings.

Method: pings are discretised to a two-level grid (cells as wide as the stop radius, and the cell
of a place's running centre with its neighbours), dwell is run-length encoded with neighbour-cell
hysteresis around that cell, each membership is confirmed by the great-circle distance to the
centre, dwell runs long enough are stops, and the great-circle hops between them add up to trips.

A device may span any number of range partitions, and where they are cut changes nothing. Which
run a ping belongs to depends on the pings before it only back to the last ``turn``: a ping that,
with the one after it, lies more than two radii from both pings before. No run can hold pings
from either side, so one begins there whatever went before. A partition therefore settles
everything from its first turn on, and passes on the pings before it and the state at its end;
those few rows are replayed in order for each device, without holding them. Only a device that
never moves on within a whole partition has all pings of it replayed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayledger.functions.geo import EARTH_M, distance_np
from wayledger.operators.track import device_track, from_micros
from wayledger.session import materialize

_DEG_M = EARTH_M * math.pi / 180
#: Kinds of rows: a stop; a ping before the first turn; that turn; the state at a partition's end;
#: distance covered since the last stop.
STOP, PING, TURN, STATE, WAY = range(5)
_INTS = {"part": pa.int32(), "seq": pa.int64(), "kind": pa.int32(), "start": pa.int64(), "end": pa.int64(), "n": pa.int64()}
_FLOATS = ["lat", "lon", "llat", "llon", "hop", "inner", "way"]
_AWAY = {"ats": pa.int64(), "alat": pa.float64(), "alon": pa.float64()}
_ARROW = pa.schema([("device_serial", pa.string()), *_INTS.items(), *((c, pa.float64()) for c in _FLOATS), *_AWAY.items()])
_SCHEMA = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'int' if f.type == pa.int32() else 'long' if f.type == pa.int64() else 'double'}" for f in _ARROW)


def _far(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    """Great-circle metres."""
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * math.asin(math.sqrt(min(1.0, a)))


class Dwell:
    """A run of pings at one place; a ping on the move is a run of one. ``lat`` and ``lon`` are sums."""

    __slots__ = ("start", "end", "n", "lat", "lon", "llat", "llon", "hop", "inner")

    def __init__(self, ts: int, lat: float, lon: float, hop: float):
        self.start = self.end = ts
        self.n = 1
        self.lat = self.llat = lat
        self.lon = self.llon = lon
        self.hop, self.inner = hop, 0.0

    def holds(self, lat: float, lon: float, step: float, radius: float) -> bool:
        """Same or neighbouring cell, and within the radius of the centre."""
        clat, clon = self.lat / self.n, self.lon / self.n
        if abs(math.floor(lat / step) - math.floor(clat / step)) > 1:
            return False
        wide = step / max(0.01, math.cos(math.radians(clat)))
        lon += 360 * round((clon - lon) / 360)
        if abs(math.floor(lon / wide) - math.floor(clon / wide)) > 1:
            return False
        return _far(clat, clon, lat, lon) <= radius

    def add(self, ts: int, lat: float, lon: float, path: float) -> None:
        self.lon += lon + 360 * round((self.lon / self.n - lon) / 360)
        self.lat += lat
        self.n += 1
        self.end, self.llat, self.llon = ts, lat, lon
        self.inner += path

    def add_all(self, ts: np.ndarray, lat: np.ndarray, lon: np.ndarray, step: float, radius: float) -> int:
        """Add the pings up to the first that the run doesn't hold; gives their number.

        The sums grow ping by ping as in ``add``, so that it is no matter how pings are cut.
        """
        turned = lon + 360 * np.round((self.lon / self.n - lon) / 360)
        slat, slon = np.cumsum(np.append(self.lat, lat)), np.cumsum(np.append(self.lon, turned))
        k = self.n + np.arange(len(lat))
        clat, clon = slat[:-1] / k, slon[:-1] / k
        wide = step / np.maximum(0.01, np.cos(np.radians(clat)))
        held = (np.abs(np.floor(lat / step) - np.floor(clat / step)) <= 1) & (np.abs(np.floor(turned / wide) - np.floor(clon / wide)) <= 1) & (distance_np(clat, clon, lat, turned) <= radius)
        m = len(lat) if held.all() else int(held.argmin())
        if m:
            self.lat, self.lon, self.n = float(slat[m]), float(slon[m]), self.n + m
            self.inner += float(distance_np(np.append(self.llat, lat[: m - 1]), np.append(self.llon, lon[: m - 1]), lat[:m], lon[:m]).sum())
            self.end, self.llat, self.llon = int(ts[m - 1]), float(lat[m - 1]), float(lon[m - 1])
        return m


class Places:
    """Hysteresis over the pings of one device, in order.

    ``closed`` takes (start, end, n, lat, lon, way) of every stop that ends, ``way`` the path since
    the stop before; ``way`` here is the path of the runs closed since the last stop.
    """

    def __init__(self, step: float, radius: float, least: int):
        self.step, self.radius, self.least = step, radius, least
        self.closed: list[tuple] = []
        self.cur: Dwell | None = None
        self.away: tuple[int, float, float] | None = None
        self.way = 0.0

    def ping(self, ts: int, lat: float, lon: float) -> None:
        cur = self.cur
        if cur is None:
            self.cur = Dwell(ts, lat, lon, 0.0)
        elif cur.holds(lat, lon, self.step, self.radius):
            if self.away is None or cur.n > 1:
                path = _far(cur.llat, cur.llon, lat, lon)
            else:
                path = _far(cur.llat, cur.llon, *self.away[1:]) + _far(*self.away[1:], lat, lon)
            cur.add(ts, lat, lon, path)
            self.away = None
        elif self.away is None:
            self.away = (ts, lat, lon)
        else:
            t0, y0, x0 = self.away
            self.close()
            self.cur, self.away = Dwell(t0, y0, x0, _far(cur.llat, cur.llon, y0, x0)), None
            self.ping(ts, lat, lon)

    def close(self) -> None:
        d = self.cur
        if d.end - d.start >= self.least:
            self.closed.append((d.start, d.end, d.n, d.lat / d.n, d.lon / d.n, self.way + d.hop))
            self.way = 0.0
        else:
            self.way += d.hop + d.inner

    def feed(self, ts: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> None:
        """The same as ``ping`` one by one: pings at a place are taken in blocks, and of pings
        that are each a turn only the last is left to look at."""
        turn = turns(lat, lon, self.radius)
        stretch = _run_lengths(turn)
        hop = np.append(0.0, distance_np(lat[:-1], lon[:-1], lat[1:], lon[1:])) if len(lat) > 1 else np.zeros(len(lat))
        i, n, block = 0, len(ts), 16
        while i < n:
            if stretch[i] > 2 and self.cur is not None and self.least > 0:
                # runs of one ping each begin at i, i + 1, ...: the one before them ends here
                if self.away is not None:
                    t0, y0, x0 = self.away
                    last = self.cur
                    self.close()
                    self.cur, self.away = Dwell(t0, y0, x0, _far(last.llat, last.llon, y0, x0)), None
                self.close()
                j = i + int(stretch[i]) - 1
                self.way += float(hop[i:j].sum())
                self.cur = Dwell(int(ts[j]), float(lat[j]), float(lon[j]), float(hop[j]))
                i = j + 1
                continue
            if self.away is None and self.cur is not None and self.cur.n > 1:
                m = self.cur.add_all(ts[i : i + block], lat[i : i + block], lon[i : i + block], self.step, self.radius)
                block = min(4096, block * 2) if m == block else 16
                i += m
                if m:
                    continue
            self.ping(int(ts[i]), float(lat[i]), float(lon[i]))
            i += 1

    def finish(self) -> None:
        if self.cur is not None:
            self.close()
            if self.away is not None:
                last, (t0, y0, x0) = self.cur, self.away
                self.cur = Dwell(t0, y0, x0, _far(last.llat, last.llon, y0, x0))
                self.close()
        self.cur = self.away = None


def turns(lat: np.ndarray, lon: np.ndarray, radius: float) -> np.ndarray:
    """Pings at which a run begins whatever went before: it and its next lie beyond two radii of
    both pings before. A run always holds one of the last two pings, and so can't go on."""
    out = np.zeros(len(lat), bool)
    if len(lat) > 3:
        off = [distance_np(lat[:-k], lon[:-k], lat[k:], lon[k:]) > 2.02 * radius for k in (1, 2, 3)]
        out[2:-1] = off[0][1:-1] & off[1][:-1] & off[1][1:] & off[2]
    return out


def _run_lengths(mask: np.ndarray) -> np.ndarray:
    """At each true value, how many are true from there on."""
    n = len(mask)
    stop = np.where(mask, n, np.arange(n))
    return np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n)


def _devices(b: pa.RecordBatch) -> Iterator[tuple[str, int, int]]:
    """Device and rows of each stretch of a batch."""
    dev = b.column(0).to_numpy(zero_copy_only=False)
    cut = [0, *(np.flatnonzero(dev[1:] != dev[:-1]) + 1).tolist(), len(dev)] if len(dev) else [0]
    for lo, hi in zip(cut, cut[1:], strict=False):
        yield dev[lo], lo, hi


class _Rows:
    """Rows to give on, numbered in order."""

    def __init__(self, part: int = 0):
        self.part, self.seq, self.rows, self.blocks = part, 0, [], []

    def put(self, name: str, kind: int, start: int, end: int, n: int, *floats: float, at: tuple | None = None, away: tuple | None = None) -> None:
        part, seq = at or (self.part, self.seq)
        self.seq += 1
        self.rows.append((name, part, seq, kind, start, end, n, *floats, *[0.0] * (7 - len(floats)), *(away or (None, None, None))))

    def stops(self, name: str, p: Places, at: tuple | None = None) -> None:
        for start, end, n, lat, lon, way in p.closed:
            self.put(name, STOP, start, end, n, lat, lon, 0.0, 0.0, 0.0, 0.0, way, at=at)
        p.closed.clear()

    def state(self, name: str, p: Places) -> None:
        d = p.cur
        self.put(name, STATE, d.start, d.end, d.n, d.lat, d.lon, d.llat, d.llon, d.hop, d.inner, p.way, away=p.away)

    def pings(self, name: str, ts: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> None:
        n, zero = len(ts), np.zeros(len(ts))
        one = np.ones(n, np.int64)
        none = pa.nulls(n, pa.int64()), *[pa.nulls(n, pa.float64())] * 2
        cols = [pa.array([name] * n, pa.string()), pa.array(one * self.part, pa.int32()), self.seq + np.arange(n), pa.array(one * PING, pa.int32()), ts, ts, one, lat, lon, *[zero] * 5, *none]
        self.seq += n
        self.blocks.append(pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], schema=_ARROW))

    def take(self) -> Iterator[pa.RecordBatch]:
        blocks, rows, self.blocks, self.rows = self.blocks, self.rows, [], []
        yield from blocks
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def settle(part: int, batches: Iterable[pa.RecordBatch], step: float, radius: float, least: int) -> Iterator[pa.RecordBatch]:
    """The stops of one range partition from its first turn on, and what its borders need."""
    out = _Rows(part)
    name, places, first = None, None, True
    held = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]  # the last pings before the first turn
    for b in batches:
        cols = [b.column(k).to_numpy() for k in (1, 2, 3)]
        for dev, lo, hi in _devices(b):
            if name is None or dev != name:
                if places is not None:
                    places.finish()
                    out.stops(name, places)
                first = name is None
                name, places = dev, None if first else Places(step, radius, least)
            new = [c[lo:hi] for c in cols]
            if places is None:
                ts, lat, lon = (np.append(h, c) for h, c in zip(held, new, strict=True))
                at = np.flatnonzero(turns(lat, lon, radius))
                if not len(at):
                    out.pings(name, *new)
                    held = [ts[-3:], lat[-3:], lon[-3:]]
                    continue
                a = int(at[0])
                out.pings(name, *(c[: a + 2 - len(held[0])] for c in new))
                out.put(name, TURN, int(ts[a]), int(ts[a]), 0)
                places = Places(step, radius, least)
                places.cur = Dwell(int(ts[a]), float(lat[a]), float(lon[a]), _far(lat[a - 1], lon[a - 1], lat[a], lon[a]))
                new = [c[a + 1 :] for c in (ts, lat, lon)]
            places.feed(*new)
            out.stops(name, places)
        yield from out.take()
    if places is not None:
        out.state(name, places)
    yield from out.take()


def replay(batches: Iterable[pa.RecordBatch], step: float, radius: float, least: int) -> Iterator[pa.RecordBatch]:
    """The stops across borders, from the rows of ``settle`` that aren't stops, by device in order."""
    out = _Rows()
    name, at, p = None, None, Places(step, radius, least)
    for b in batches:
        kind = b.column(3).to_numpy()
        for dev, lo, hi in _devices(b):
            if dev != name:
                p.finish()
                out.stops(name, p, at)
                name, p = dev, Places(step, radius, least)
            cut = [lo, *(np.flatnonzero((kind[lo + 1 : hi] != kind[lo : hi - 1]) | (kind[lo + 1 : hi] != PING)) + lo + 1).tolist(), hi]
            for i, j in zip(cut, cut[1:], strict=False):
                r = dict(zip(_ARROW.names, (c[0].as_py() for c in b.slice(i, 1).columns), strict=True))
                at = (r["part"], r["seq"])
                if r["kind"] == PING:
                    p.feed(*(b.column(k).to_numpy()[i:j] for k in (4, 7, 8)))
                elif r["kind"] == TURN:
                    # the run that begins here is settled already
                    out.put(name, WAY, r["start"], r["start"], 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, p.way, at=at)
                    p.cur = p.away = None
                    p.way = 0.0
                else:
                    d = p.cur = Dwell(r["start"], r["lat"], r["lon"], r["hop"])
                    d.end, d.n, d.llat, d.llon, d.inner = r["end"], r["n"], r["llat"], r["llon"], r["inner"]
                    p.way = r["way"]
                    p.away = None if r["ats"] is None else (r["ats"], r["alat"], r["alon"])
                out.stops(name, p, at)
        yield from out.take()
    p.finish()
    out.stops(name, p, at)
    yield from out.take()


def dwell_runs(telemetry: DataFrame, radius_m: float = 100.0, min_stop_minutes: float = 15.0) -> DataFrame:
    """Rows of kind STOP for every stop of a device and of kind WAY for path between them.

    ``lat`` and ``lon`` are a stop's centre, ``way`` the path since the row before by (part, seq).
    """
    rules = (radius_m / _DEG_M, radius_m, int(min_stop_minutes * 60e6))
    local = materialize(device_track(telemetry).mapInArrow(lambda b: settle(TaskContext.get().partitionId(), b, *rules), _SCHEMA), "stops")
    border = local.where(F.col("kind") != STOP).repartition("device_serial").sortWithinPartitions("device_serial", "part", "seq")
    return local.where(F.col("kind") == STOP).unionByName(border.mapInArrow(lambda b: replay(b, *rules), _SCHEMA))


def stops_and_trips(telemetry: DataFrame, radius_m: float = 100.0, min_stop_minutes: float = 15.0) -> DataFrame:
    """Stops, and the trips between consecutive stops of a device.

    A stop is a stay of at least ``min_stop_minutes`` within ``radius_m`` of one place. One stray
    ping or a silence doesn't end it; two consecutive pings elsewhere do. Columns: device_serial,
    kind (``stop`` or ``trip``), start_at, end_at, duration_s, distance_m (null for stops),
    latitude, longitude (the centre of a stop; null for trips), n_records (of a stop).

    Rows without device, event time or usable position (nulls, NaN, latitude beyond 90 degrees,
    0/0) are ignored; copies count once (see ``device_track``). Empty input gives no rows. Extra
    columns are ignored.
    """
    # within the parts of a device first, then over its parts: no task orders all stops of a device
    w = Window.partitionBy("device_serial", "part").orderBy("seq", "start")
    rows = materialize(dwell_runs(telemetry, radius_m, min_stop_minutes).withColumn("odo", F.sum("way").over(w)), "ways")
    is_stop = F.col("kind") == STOP
    last = F.max_by(F.struct("end", "odo"), F.when(is_stop, F.struct("seq", "start")))
    earlier = Window.partitionBy("device_serial").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("device_serial", "part").agg(F.sum("way").alias("total"), last.alias("last"))
    parts = parts.withColumn("carry", F.coalesce(F.sum("total").over(earlier), F.lit(0.0))).withColumn("last", F.when(F.col("last").isNotNull(), F.struct("last.end", (F.col("last.odo") + F.col("carry")).alias("odo"))))
    parts = parts.select("device_serial", "part", "carry", F.last("last", ignorenulls=True).over(earlier).alias("before"))
    stops_ = rows.where(is_stop).join(parts, ["device_serial", "part"]).withColumn("odo", F.col("odo") + F.col("carry"))
    prev = stops_.withColumn("p_end", F.coalesce(F.lag("end").over(w), F.col("before.end"))).withColumn("p_odo", F.coalesce(F.lag("odo").over(w), F.col("before.odo")))
    row = lambda kind, a, b, dist, lat, lon, n: F.struct(F.lit(kind).alias("kind"), from_micros(a).alias("start_at"), from_micros(b).alias("end_at"), ((F.col(b) - F.col(a)) / 1e6).alias("duration_s"), dist.alias("distance_m"), lat.alias("latitude"), lon.alias("longitude"), n.alias("n_records"))
    none = F.lit(None)
    stop = row("stop", "start", "end", none.cast("double"), F.col("lat"), F.col("lon"), F.col("n"))
    trip = F.when(F.col("p_end").isNotNull(), row("trip", "p_end", "start", F.col("odo") - F.col("p_odo"), none.cast("double"), none.cast("double"), none.cast("long")))
    return prev.select("device_serial", F.explode(F.array(stop, trip)).alias("r")).where("r is not null").select("device_serial", "r.*")


def stops(telemetry: DataFrame, radius_m: float = 100.0, min_stop_minutes: float = 15.0) -> DataFrame:
    """Only the stops: device_serial, start_at, end_at."""
    return dwell_runs(telemetry, radius_m, min_stop_minutes).where(F.col("kind") == STOP).select("device_serial", from_micros("start").alias("start_at"), from_micros("end").alias("end_at"))
