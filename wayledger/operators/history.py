"""Full history of changing entity attributes from reports that tell some of them.

Method: checkpoint-delta storage. Time is cut into periods; at the start of each period an
entity has one full version of its attributes (the checkpoint), and within the period every
report that changes something is stored as a patch of just the changed attributes. Validity
rows are rebuilt by folding the patches forward from the checkpoint of their period.

The cut into periods also bounds the work on one entity: an entity with a third of all reports
is folded period by period, in parallel, and only one checkpoint row per entity and period goes
through the per-entity pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayledger.operators.track import as_text
from wayledger.session import SMALL_BYTES, materialize, plan_size, scratch_path
from wayledger.store import TableStore

_BEFORE = -(1 << 62)


def telling(value: str, flag: str) -> Column:
    """The value, or null where it says nothing: its flag isn't true, or it repeats one digit."""
    v = F.col(value)
    return F.when(F.coalesce(F.col(flag), F.lit(False)) & ~F.coalesce(v.rlike(r"\A(\d)\1*\z"), F.lit(True)), v)


def identity_reports(events: DataFrame) -> DataFrame:
    """Device, time and what each identity report says."""
    return events.select(
        F.col("device_serial").alias("entity"),
        F.col("event_timestamp").alias("at"),
        F.struct(F.col("ingested_at").alias("seen"), F.col("row_id").alias("id")).alias("tie"),
        *[telling(c, f"has_valid_{c}_format").alias(c) for c in ("imei", "iccid", "imsi")],
    ).where("entity is not null and at is not null")


def _period(days: int) -> Column:
    return F.floor(F.unix_micros(F.col("at").cast("timestamp")) / F.lit(days * 86_400_000_000)).alias("period")


def checkpoints(reports: DataFrame, attributes: Sequence[str], days: int = 7, base: DataFrame | None = None) -> DataFrame:
    """(entity, period, each attribute): the full version standing at the start of the period.

    ``base`` has (entity, each attribute): what stood before the first of the reports.
    """
    last = [F.max_by(a, F.when(F.col(a).isNotNull(), F.struct("at", "tie"))).alias(a) for a in attributes]
    ends = reports.withColumn("period", _period(days)).groupBy("entity", "period").agg(*last)
    if base is not None:
        ends = ends.unionByName(base.select("entity", F.lit(_BEFORE).cast("long").alias("period"), *attributes))
    before = Window.partitionBy("entity").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    return ends.select("entity", "period", *[F.last(a, ignorenulls=True).over(before).alias(a) for a in attributes]).where(F.col("period") > _BEFORE)


def patches(reports: DataFrame, cp: DataFrame, attributes: Sequence[str], days: int = 7) -> DataFrame:
    """One row per report that sets or changes an attribute.

    Columns: entity, period, at, tie, ``patch`` (map of just the attributes it sets to their new
    values), ``changes`` (how many of them had another value before; a first value is none).
    """
    cp = cp.select("entity", "period", *[F.col(a).alias(f"cp_{a}") for a in attributes])
    rows = reports.withColumn("period", _period(days)).join(cp, ["entity", "period"])
    before = Window.partitionBy("entity", "period").orderBy("at", "tie").rowsBetween(Window.unboundedPreceding, -1)
    for a in attributes:
        rows = rows.withColumn(f"was_{a}", F.coalesce(F.last(a, ignorenulls=True).over(before), f"cp_{a}"))
    new = {a: F.col(a).isNotNull() & ~F.col(a).eqNullSafe(F.col(f"was_{a}")) for a in attributes}
    entries = F.filter(F.array(*[F.when(n, F.struct(F.lit(a).alias("key"), F.col(a).alias("value"))) for a, n in new.items()]), lambda x: x.isNotNull())
    changes = sum((F.when(n & F.col(f"was_{a}").isNotNull(), 1).otherwise(0) for a, n in new.items()), F.lit(0))
    return rows.withColumn("patch", F.map_from_entries(entries)).withColumn("changes", changes).where(F.size("patch") > 0).select("entity", "period", "at", "tie", "patch", "changes")


def fold(cp: DataFrame, deltas: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Validity rows: every version, folded forward from the checkpoint of its period.

    Patches of one instant are one version (the last of them). Columns: entity, valid_from,
    valid_to (null: still valid), each attribute, ``changes``.
    """
    base = cp.select("entity", "period", *[F.col(a).alias(f"cp_{a}") for a in attributes])
    w = Window.partitionBy("entity", "period").orderBy("at", "tie")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    state = [F.coalesce(F.last(F.col("patch")[a], ignorenulls=True).over(so_far), F.col(f"cp_{a}")).alias(a) for a in attributes]
    every = deltas.join(base, ["entity", "period"]).select("entity", "period", "at", "tie", "changes", *state)
    last_of = Window.partitionBy("entity", "period", "at").orderBy(F.col("tie").desc())
    versions = every.withColumn("total", F.sum("changes").over(Window.partitionBy("entity", "period", "at"))).withColumn("rn", F.row_number().over(last_of)).where("rn = 1")
    # the end of a period's last version is the first version of a later period
    firsts = deltas.groupBy("entity", "period").agg(F.min("at").alias("first_at"))
    after = firsts.select("entity", "period", F.lead("first_at").over(Window.partitionBy("entity").orderBy("period")).alias("next_at"))
    ends = F.coalesce(F.lead("at").over(Window.partitionBy("entity", "period").orderBy("at")), F.col("next_at"))
    return versions.join(after, ["entity", "period"]).select("entity", F.col("at").alias("valid_from"), ends.alias("valid_to"), *attributes, F.col("total").alias("changes"))


class HistoryStore:
    """Reports, and their checkpoints and patches, of entities under ``path``, by period.

    Checkpoints and patches are rows of one table, so that a build is one commit.
    """

    def __init__(self, spark: SparkSession, path: str, attributes: Sequence[str], days: int = 7):
        self.attributes, self.days = list(attributes), days
        self.reports, self.versions = (TableStore(spark, f"{path}/{t}", "period") for t in ("reports", "versions"))

    def update(self, reports: DataFrame) -> list[int]:
        """Take in reports, late ones too; gives the periods that were built anew.

        Only the entities that have new reports are built anew, each from the first period that its
        new reports fall on, and only in the periods in which it has reports: elsewhere nothing of
        it is stored. Rows of other entities in those periods are carried over as they are. No
        reports change nothing.
        """
        rows = reports.select("entity", "at", "tie", *self.attributes, _period(self.days).cast("string").alias("period"))
        staged = self.reports.stage(rows.hint("rebalance", "period"))
        fresh = self.reports.staged_rows(staged).select("entity", F.col("period").cast("long").alias("period"))
        since = materialize(fresh.groupBy("entity").agg(F.min("period").alias("since")), "since")
        # the reports are a part of the table before they are built on; applied again after a crash
        # in between, they are repeats, which set nothing
        touched = [int(v) for v in self.reports.publish(staged)]
        if not touched:
            return []
        self.reports.compact()
        names = sorted((v for v in self.reports.snapshot().parts if int(v) >= min(touched)), key=int)
        small = F.broadcast(since) if plan_size(since) <= SMALL_BYTES else since
        stored = self.reports.read(only=names).withColumn("period", F.col("period").cast("long"))
        kept = materialize(stored.join(small, "entity").where("period >= since").drop("since"), "reports")
        affected = sorted((str(r.period) for r in kept.select("period").distinct().collect()), key=int)
        kept = kept.drop("period")
        base = self._standing(since=since)
        cp = materialize(checkpoints(kept, self.attributes, self.days, base), "checkpoints")
        out = self._rows(cp, patches(kept, cp, self.attributes, self.days))
        if self.versions.exists():
            old = self.versions.read(only=affected)
            beside = old.join(small, "entity", "left").where(F.col("since").isNull() | (F.col("period").cast("long") < F.col("since"))).drop("since")
            self.versions.replace_partitions(out.unionByName(beside).hint("rebalance", "period"), affected)
        else:
            self.versions.overwrite(out.hint("rebalance", "period"))
        return sorted(map(int, affected))

    def _rows(self, cp: DataFrame, deltas: DataFrame) -> DataFrame:
        """Checkpoints (``patch`` is null) and patches as rows of one table."""
        none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in deltas.schema if f.name in ("at", "tie", "patch", "changes")}
        state = F.struct(*self.attributes).alias("state")
        full = cp.select("entity", F.col("period").cast("string").alias("period"), state, *none.values())
        empty = F.lit(None).cast(full.schema["state"].dataType).alias("state")
        return full.unionByName(deltas.select("entity", F.col("period").cast("string").alias("period"), empty, "at", "tie", "patch", "changes"))

    def _read(self) -> tuple[DataFrame, DataFrame]:
        rows = self.versions.read().withColumn("period", F.col("period").cast("long"))
        return rows.where("patch is null").select("entity", "period", "state.*"), rows.where("patch is not null").drop("state")

    def _standing(self, since: DataFrame | None = None, at: Column | None = None) -> DataFrame | None:
        """(entity, each attribute): what stood, folded from the nearest checkpoint before.

        Before the period ``since`` of the entities in it, or of all entities at a time.
        """
        if not self.versions.exists():
            return None
        cp, deltas = self._read()
        if since is not None:
            since = F.broadcast(since) if plan_size(since) <= SMALL_BYTES else since
            cp, deltas = (x.join(since, "entity").where("period < since").drop("since") for x in (cp, deltas))
        if at is not None:
            day = F.floor(F.unix_micros(at.cast("timestamp")) / F.lit(self.days * 86_400_000_000))
            cp, deltas = cp.where(F.col("period") <= day), deltas.where((F.col("period") <= day) & (F.col("at") <= at))
        near = cp.groupBy("entity").agg(F.max_by(F.struct(*self.attributes), "period").alias("cp"), F.max("period").alias("period"))
        last = deltas.join(near.select("entity", "period"), ["entity", "period"], "left_semi").groupBy("entity").agg(*[F.max_by(F.col("patch")[a], F.when(F.col("patch")[a].isNotNull(), F.struct("at", "tie"))).alias(f"p_{a}") for a in self.attributes])
        return near.join(last, "entity", "left").select("entity", *[F.coalesce(f"p_{a}", f"cp.{a}").alias(a) for a in self.attributes])

    def as_of(self, at: Column) -> DataFrame:
        """The version of every entity that stood at a time."""
        return self._standing(at=at)

    def history(self) -> DataFrame:
        """Validity rows of all entities."""
        return fold(*self._read(), self.attributes)


def attribute_history(reports: DataFrame, attributes: Sequence[str], days: int = 7, path: str | None = None) -> DataFrame:
    """The whole history of each entity, through stored checkpoints and patches.

    ``reports`` has entity, at, tie and the attributes; a null attribute says nothing and the last
    value stays. Reports are taken in order of (at, tie). Repeated rows set nothing and vanish;
    an empty table gives no rows. Reports without entity or time must be left out before.
    """
    spark = reports.sparkSession
    store = HistoryStore(spark, path or scratch_path(spark, "history"), attributes, days)
    if not store.update(reports):
        empty = patches(reports.limit(0), checkpoints(reports.limit(0), store.attributes, days), store.attributes, days)
        return fold(checkpoints(reports.limit(0), store.attributes, days), empty, store.attributes)
    return store.history()


def identity_changes(events: DataFrame, days: int = 7) -> DataFrame:
    """(device_serial, valid_from) of each change of IMEI, ICCID or IMSI."""
    h = attribute_history(identity_reports(events), ["imei", "iccid", "imsi"], days)
    return h.where("changes > 0").select(F.col("entity").alias("device_serial"), as_text("valid_from").alias("valid_from"))
