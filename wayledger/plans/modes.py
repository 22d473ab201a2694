"""Full, incremental and no-op builds of the typed layer and the products.

A late batch rebuilds every day it touches, from all bronze rows of that day. The index of event
days beside bronze tells which ingestion partitions hold rows of those days, so an incremental
build reads those and not all of bronze.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.config import Settings
from wayledger.contracts import DAILY_SUMMARY, DIM_DEVICE, IDENTITY, LAST_POSITION, QUALITY_SUMMARY, REJECTED, ROUTE_POINTS, TELEMETRY, align
from wayledger.functions.dialect import try_timestamp
from wayledger.plans import gold, silver
from wayledger.plans.ingest import Bronze
from wayledger.session import materialize
from wayledger.store import Snapshot, TableStore, changed_parts

FULL, INCREMENTAL, NOOP = "FULL", "INCREMENTAL", "NOOP"
UNKNOWN = "unknown"


def clean_ids(ids: Iterable[str]) -> list[str]:
    """Stripped, distinct, sorted, blanks dropped."""
    return sorted({i.strip() for i in ids if i and i.strip()})


def row_day() -> Column:
    """Day of a bronze row by its own times, ``unknown`` without any."""
    t = F.coalesce(try_timestamp(F.col("TM_STAMP")), try_timestamp(F.col("DATA_SERVIDOR")))
    return F.coalesce(F.date_format(t, "yyyy-MM-dd"), F.lit(UNKNOWN))


def affected_partitions(bronze: DataFrame, batch_ids: DataFrame) -> DataFrame:
    """(event_day): the days, and perhaps ``unknown``, that rows of the batches fall on."""
    return bronze.join(batch_ids.select("batch_id").distinct(), "batch_id", "left_semi").select(row_day().alias("event_day")).distinct()


def incremental_scope(bronze: DataFrame, days: DataFrame) -> DataFrame:
    """All bronze rows of the given days, whichever batch brought them."""
    tagged = bronze.withColumn("__day", row_day())
    return tagged.join(days.select(F.col("event_day").alias("__day")).distinct(), "__day", "left_semi").drop("__day")


def affected_devices(dates: Sequence[str] | DataFrame, *tables: DataFrame) -> DataFrame:
    """(device_serial): devices with a row on any of the dates, in any of the tables."""
    out = None
    for t in tables:
        rows = t.where(F.col("event_date").isin(list(dates))) if not isinstance(dates, DataFrame) else t.join(dates.select("event_date").distinct(), "event_date", "left_semi")
        rows = rows.where("device_serial is not null").select("device_serial")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """(key, n): values that keep a column from being a key, null or repeated."""
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("key is null or n > 1")


def check_key(df: DataFrame, key: str) -> None:
    """Keys of an entity table are known and unique."""
    if bad := key_violations(df, key).limit(1).collect():
        raise ValueError(f"{key} is null in {bad[0].n} rows" if bad[0].key is None else f"{key} is not unique")


def pending_batches(known: DataFrame, ledger: DataFrame) -> DataFrame:
    """(batch_id): batches that the ledger doesn't have."""
    return known.select("batch_id").distinct().join(ledger.select("batch_id"), "batch_id", "left_anti")


def replace_entities(old: DataFrame, touched: DataFrame, fresh: DataFrame) -> DataFrame:
    """An entity table in which the touched devices have their fresh rows, or none."""
    return old.join(touched.select("device_serial"), "device_serial", "left_anti").unionByName(fresh)


@dataclass(frozen=True)
class SilverResult:
    mode: str
    event_dates: tuple[str, ...] = ()
    rejection_dates: tuple[str, ...] = ()
    rows: dict[str, int] | None = None


@dataclass
class Silver:
    """The three typed tables, the evidence of identity in them, and the ledger of their batches.

    A build commits them one by one and the ledger last: after a crash in between the same
    batches are pending, and building them again ends in the same tables.
    """

    spark: SparkSession
    settings: Settings

    def __post_init__(self):
        at = self.settings.layer("silver")
        self.telemetry = TableStore(self.spark, f"{at}/telemetry_events", "event_date")
        self.identity = TableStore(self.spark, f"{at}/device_identity_events", "event_date")
        self.rejected = TableStore(self.spark, f"{at}/rejected_logs", "rejection_date")
        self.evidence = TableStore(self.spark, f"{at}/identity_evidence", "event_day")
        self.ledger = TableStore(self.spark, f"{at}/processed_batches")

    def tables(self) -> dict[str, tuple[TableStore, object]]:
        return {"telemetry": (self.telemetry, TELEMETRY), "identity": (self.identity, IDENTITY), "rejected": (self.rejected, REJECTED)}

    def ready(self) -> bool:
        """All three tables exist with every column of their contract."""
        for store, contract in self.tables().values():
            schema = store.snapshot().schema
            if schema is None or not set(contract.names) <= set(schema.names):
                return False
        return True

    def pending(self, bronze: Bronze) -> list[str]:
        """Batches in bronze that the tables don't hold, as after a crash between the layers."""
        if not bronze.days.exists():
            return []
        known = bronze.days.read()
        left = pending_batches(known, self.ledger.read()) if self.ledger.exists() else known.select("batch_id").distinct()
        return [r.batch_id for r in left.collect()]

    def load(self, bronze: Bronze, batch_ids: Sequence[str] | None = None, compat: bool = False) -> SilverResult:
        """None rebuilds all; no ids is a no-op; else the days that the batches touch.

        Without ``compat``, identity is resolved by the evidence of all days at once, and days on
        which new evidence changes a resolution are rebuilt too, so that a row of increments
        ends where a full build does. With it, maps see only the touched days and stored
        identity events, and other days stay as they are.
        """
        if batch_ids is None or not (self.ready() and self.evidence.exists()):
            classified = self._classified(silver.resolve_identity(silver.normalize(bronze.table.read())))
            built = silver.split(classified)
            self.telemetry.overwrite(built.telemetry)
            self.identity.overwrite(built.identity)
            self.rejected.overwrite(built.rejected)
            self.evidence.overwrite(silver.evidence(classified))
            self._note(bronze.table.read().select("batch_id").distinct(), True)
            return SilverResult(FULL, rows={k: store.read().count() for k, (store, _) in self.tables().items()})
        ids = clean_ids(batch_ids)
        if not ids:
            return SilverResult(NOOP)
        index = bronze.days.read()
        days = sorted(r.event_day for r in index.where(F.col("batch_id").isin(ids)).select("event_day").distinct().collect())
        if not days:
            return SilverResult(NOOP)
        if compat:
            classified = self._classified(silver.resolve_identity(silver.normalize(self._scope(bronze, index, days)), self.identity.read()))
        else:
            classified, days = self._resolved_by_all(bronze, index, days)
        built = silver.split(classified)
        dated = [d for d in days if d != UNKNOWN]
        self.telemetry.replace_partitions(built.telemetry, dated)
        self.identity.replace_partitions(built.identity, dated)
        self.rejected.replace_partitions(built.rejected, days)
        self.evidence.replace_partitions(silver.evidence(classified), dated)
        self._note(self.spark.createDataFrame([(i,) for i in ids], "batch_id string"), False)
        written = {k: store.read(only=days).count() for k, (store, _) in self.tables().items()}
        return SilverResult(INCREMENTAL, tuple(dated), tuple(days), written)

    def _scope(self, bronze: Bronze, index: DataFrame, days: list[str]) -> DataFrame:
        """All bronze rows of the days, from the ingestion partitions that hold some."""
        parts = [r.ingestion_date for r in index.where(F.col("event_day").isin(days)).select("ingestion_date").distinct().collect()]
        return bronze.table.read(only=parts).where(row_day().isin(days))

    def _resolved_by_all(self, bronze: Bronze, index: DataFrame, days: list[str]) -> tuple[DataFrame, list[str]]:
        """The days rebuilt by the evidence of all days, and those days that it changes.

        Of the other days only the stored evidence is read, not the typed tables.
        """
        scope = silver.normalize(self._scope(bronze, index, days))
        outside = self.evidence.read(only=[d for d in self.evidence.snapshot().parts if d not in set(days)])
        reports = outside.where("kind = 'report'").select("file", "imei", "serial").unionByName(silver.reports(scope))
        by_file = materialize(silver.serials_of(reports), "serials")
        if more := [x.event_day for x in silver.changed_days(by_file, outside.where("kind = 'legacy'")).collect()]:
            days = sorted({*days, *more})
            scope = silver.normalize(self._scope(bronze, index, days))
        return self._classified(silver.resolve_identity(scope, by_file=by_file)), days

    @staticmethod
    def _classified(resolved: DataFrame) -> DataFrame:
        """Text is normalised and identity resolved once; the tables read that result."""
        return materialize(silver.classify(resolved), "classified")

    def _note(self, batches: DataFrame, whole: bool) -> None:
        (self.ledger.overwrite if whole else self.ledger.append)(batches.coalesce(1))


@dataclass(frozen=True)
class GoldResult:
    mode: str
    devices: int = 0
    rows: dict[str, int] | None = None


@dataclass
class Gold:
    """The five products, the states of days that two of them are merged from, and which versions
    of the typed tables they were built from.

    What to rebuild is told by comparing those versions with the present ones, so that products
    that a crash left behind catch up in the next run.
    """

    spark: SparkSession
    settings: Settings

    def __post_init__(self):
        at = self.settings.layer("gold")
        self.dim_device = TableStore(self.spark, f"{at}/dim_device")
        self.last_position = TableStore(self.spark, f"{at}/device_last_position")
        self.route_points = TableStore(self.spark, f"{at}/device_route_points", "event_date")
        self.daily_summary = TableStore(self.spark, f"{at}/device_daily_summary", "event_date")
        self.quality_summary = TableStore(self.spark, f"{at}/data_quality_summary", "metric_date")
        self.telemetry_days = TableStore(self.spark, f"{at}/states/telemetry_days", "event_date")
        self.identity_days = TableStore(self.spark, f"{at}/states/identity_days", "event_date")
        self.position_days = TableStore(self.spark, f"{at}/states/position_days", "event_date")
        self.built_from = TableStore(self.spark, f"{at}/states/built_from")

    def stores(self) -> dict[str, TableStore]:
        return {k: getattr(self, k) for k in ("dim_device", "last_position", "route_points", "daily_summary", "quality_summary")}

    def states(self) -> dict[str, TableStore]:
        return {k: getattr(self, k) for k in ("telemetry_days", "identity_days", "position_days")}

    def load(self, s: Silver, result: SilverResult | None = None) -> GoldResult:
        """Full if a product or the typed layer's result is missing, else what has changed."""
        if not s.ready():
            raise FileNotFoundError("the typed tables are not complete")
        now = {k: store.snapshot() for k, (store, _) in s.tables().items()}
        was = self._was(s)
        if result is None or result.mode == FULL or was is None or not all(x.exists() for x in self.stores().values()):
            done = self._full(s, now)
        else:
            changed = {k: changed_parts(was[k], now[k]) for k in now}
            dates, metric = sorted(changed["telemetry"] | changed["identity"]), sorted(set().union(*changed.values()))
            if not metric:
                return GoldResult(NOOP)
            done = self._incremental(s, now, was, dates, metric)
        self.built_from.overwrite(self.spark.createDataFrame([(done.mode,)], "mode string"), {k: str(v.version) for k, v in now.items()} | {k: str(x.snapshot().version) for k, x in self.states().items()})
        return done

    def _was(self, s: Silver) -> dict[str, Snapshot] | None:
        """The versions that the products were built from; None if one is gone."""
        versions = self.built_from.snapshot().properties
        stores = {k: store for k, (store, _) in s.tables().items()} | self.states()
        if not set(stores) <= set(versions) or any(int(versions[k]) not in store._versions() for k, store in stores.items()):
            return None
        return {k: store.snapshot(int(versions[k])) for k, store in stores.items()}

    def _base(self, s: Silver, now: dict[str, Snapshot], dates: list[str] | None) -> tuple[DataFrame, dict[str, DataFrame]]:
        """Telemetry shuffled and deduplicated once for all that reads it, and the states of its days."""
        base = materialize(gold.dedup_telemetry(s.telemetry.read(only=dates, snap=now["telemetry"]), by_day=True), "base")
        states = {"telemetry_days": gold.telemetry_days(base, deduped=True), "identity_days": gold.identity_days(s.identity.read(only=dates, snap=now["identity"])), "position_days": gold.position_days(base, deduped=True)}
        return base, states

    def _entities(self, only: DataFrame | None = None) -> dict[str, DataFrame]:
        """The two entity products merged from the states of days, of all devices or some."""
        pick = lambda store: store.read() if only is None else store.read().join(only, "device_serial", "left_semi")
        return {"dim_device": gold.dim_from_days(pick(self.telemetry_days), pick(self.identity_days)), "last_position": gold.last_from_days(pick(self.position_days))}

    def _full(self, s: Silver, now: dict[str, Snapshot]) -> GoldResult:
        base, states = self._base(s, now, None)
        for k, df in states.items():
            getattr(self, k).overwrite(df)
        for k, fresh in self._entities().items():
            fresh = materialize(fresh, "entities")
            check_key(fresh, "device_serial")
            getattr(self, k).overwrite(fresh)
        self.route_points.overwrite(gold.route_points(base, deduped=True))
        self.daily_summary.overwrite(gold.daily_summary(base, deduped=True))
        self.quality_summary.overwrite(gold.quality_summary(*(store.read(snap=now[k]) for k, (store, _) in s.tables().items())))
        return GoldResult(FULL, rows={k: x.read().count() for k, x in self.stores().items()})

    def _incremental(self, s: Silver, now: dict[str, Snapshot], was: dict[str, Snapshot], dates: list[str], metric: list[str]) -> GoldResult:
        """Partitions of the changed days; entities of devices with rows on them, before or after.

        A device that has no row left is removed, which a plain upsert would not do.
        """
        n = 0
        rows: dict[str, int] = {}
        if dates:
            base, states = self._base(s, now, dates)
            seen = [store.read(only=dates, snap=was[k]) for k, store in self.states().items()]
            for k, df in states.items():
                getattr(self, k).replace_partitions(df, dates)
            seen += [store.read(only=dates) for store in self.states().values()]
            devices = materialize(affected_devices(dates, *seen), "devices")
            n = devices.count()
            for k, fresh in self._entities(devices).items():
                store, contract = getattr(self, k), DIM_DEVICE if k == "dim_device" else LAST_POSITION
                fresh = materialize(fresh, "entities")
                check_key(fresh, "device_serial")
                rows[store.path.rsplit("/", 1)[1]] = fresh.count()
                store.overwrite(replace_entities(align(store.read(), contract), devices, fresh))
            self.route_points.replace_partitions(align(gold.route_points(base, dates, deduped=True), ROUTE_POINTS), dates)
            self.daily_summary.replace_partitions(align(gold.daily_summary(base, dates, deduped=True), DAILY_SUMMARY), dates)
        q = gold.quality_summary(*(store.read(only=metric, snap=now[k]) for k, (store, _) in s.tables().items()), metric)
        self.quality_summary.replace_partitions(align(q, QUALITY_SUMMARY), metric)
        return GoldResult(INCREMENTAL, n, rows)
