"""Files to products in one run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from wayledger.config import Settings
from wayledger.plans.ingest import Bronze, BronzeResult
from wayledger.plans.modes import NOOP, Gold, GoldResult, Silver, SilverResult
from wayledger.session import scratch_scope


@dataclass(frozen=True)
class PipelineResult:
    bronze: BronzeResult
    silver: SilverResult
    gold: GoldResult

    @property
    def has_new_data(self) -> bool:
        return bool(self.bronze.batch_ids)

    @property
    def has_changes(self) -> bool:
        return self.silver.mode != NOOP or self.gold.mode != NOOP


def run_pipeline(spark: SparkSession, settings: Settings, full: bool = False, compat: bool = False) -> PipelineResult:
    """Load the inbox, then the typed layer, then the products.

    Batches that an earlier run left in bronze only are taken along, and so are changes of the
    typed tables that it didn't bring into the products.
    """
    with scratch_scope(spark):
        return _run(spark, settings, full, compat)


def _run(spark: SparkSession, settings: Settings, full: bool, compat: bool) -> PipelineResult:
    bronze, s, g = Bronze(spark, settings), Silver(spark, settings), Gold(spark, settings)
    loaded = bronze.load()
    if not bronze.table.exists():
        return PipelineResult(loaded, SilverResult(NOOP), GoldResult(NOOP))
    ids = None if full else sorted({*loaded.batch_ids, *s.pending(bronze)})
    typed = s.load(bronze, ids, compat)
    return PipelineResult(loaded, typed, g.load(s, typed))


def format_result(r: PipelineResult) -> str:
    """A report of a run."""
    b, s, g = r.bronze, r.silver, r.gold
    parts = {
        "BRONZE": {"discovered_files": b.discovered, "successful_files": len(b.successful), "skipped_files": len(b.skipped), "failed_files": len(b.failed), "inserted_rows": b.inserted_rows, "duplicate_rows": b.duplicate_rows, "propagated_batches": len(b.batch_ids)},
        "SILVER": {"mode": s.mode} | {f"{k}_rows": v for k, v in (s.rows or {}).items()} | {"affected_event_dates": len(s.event_dates), "affected_rejection_dates": len(s.rejection_dates)},
        "GOLD": {"mode": g.mode, "affected_devices": g.devices} | {f"{k}_rows": v for k, v in (g.rows or {}).items()},
        "PIPELINE": {"has_new_data": r.has_new_data, "has_changes": r.has_changes},
    }
    return "\n".join(line for name, values in parts.items() for line in (f"[{name}]", *(f"  {k}={v}" for k, v in values.items())))
