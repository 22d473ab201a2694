"""Read-only queries over the published products.

Items and total of a page come from one snapshot of the table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.config import Settings
from wayledger.plans.modes import Gold
from wayledger.store import TableStore

MAX_LIMIT, DEFAULT_LIMIT = 1000, 100

# The order of each product's pages.
ORDERS = {
    "dim_device": [("device_serial", True)],
    "last_position": [("last_position_at", False), ("device_serial", True)],
    "route_points": [("event_timestamp", True), ("point_sequence", True)],
    "daily_summary": [("event_date", False), ("device_serial", True)],
    "quality_summary": [("metric_date", False)],
}


def required_text(value: str, name: str) -> str:
    if not (v := value.strip()):
        raise ValueError(f"{name} must not be empty")
    return v


def optional_date(value: str | None, name: str) -> str | None:
    """A date as ``yyyy-MM-dd``, whatever ISO form it came in."""
    if value is None:
        return None
    try:
        return date.fromisoformat(required_text(value, name)).isoformat()
    except ValueError as e:
        raise ValueError(f"{name} must be a date like 2024-01-31") from e


def checked_page(limit: int, offset: int) -> tuple[int, int]:
    for name, v in (("limit", limit), ("offset", offset)):
        if isinstance(v, bool) or not isinstance(v, int):
            raise TypeError(f"{name} must be an integer")
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be from 1 to {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    return limit, offset


def date_range(start: str | None, end: str | None) -> tuple[str | None, str | None]:
    start, end = optional_date(start, "start_date"), optional_date(end, "end_date")
    if start and end and start > end:
        raise ValueError("start_date must not be after end_date")
    return start, end


def filters(device: str | None = None, start: str | None = None, end: str | None = None, date_column: str = "event_date") -> Column:
    """Text comparisons, so that partition folders are pruned; ``unknown`` sorts after all dates."""
    c = F.lit(True)
    if device is not None:
        c = c & (F.col("device_serial") == device)
    if start is not None:
        c = c & (F.col(date_column) >= start)
    if end is not None:
        c = c & (F.col(date_column) <= end)
    return c


def ordered(df: DataFrame, product: str) -> DataFrame:
    """In the product's page order; unknown values last either way."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in ORDERS[product]])


def page_of(df: DataFrame, product: str, where: Column, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """One page of a product."""
    limit, offset = checked_page(limit, offset)
    return ordered(df.where(where), product).offset(offset).limit(limit)


@dataclass(frozen=True)
class Page:
    """Rows of a page and how many there are in all."""

    items: list[dict[str, Any]]
    total: int
    limit: int
    offset: int
    returned: int = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "returned", len(self.items))

    @property
    def has_more(self) -> bool:
        return self.offset + self.returned < self.total

    @property
    def next_offset(self) -> int | None:
        return self.offset + self.returned if self.has_more else None


class QueryService:
    """Validated, paged reads of the products."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.gold = Gold(spark, settings)

    def _store(self, product: str) -> TableStore:
        store = self.gold.stores()[product]
        if not store.exists():
            raise FileNotFoundError(f"{product} is not published")
        return store

    def _page(self, product: str, where: Column, limit: int, offset: int) -> Page:
        limit, offset = checked_page(limit, offset)
        df = self._store(product).read()
        return Page([r.asDict() for r in page_of(df, product, where, limit, offset).collect()], df.where(where).count(), limit, offset)

    def _one(self, product: str, device: str) -> dict[str, Any] | None:
        device = required_text(device, "device_serial")
        rows = self._store(product).read().where(filters(device)).limit(1).collect()
        return rows[0].asDict() if rows else None

    def devices(self, limit: int = DEFAULT_LIMIT, offset: int = 0) -> Page:
        return self._page("dim_device", F.lit(True), limit, offset)

    def device(self, device: str) -> dict[str, Any] | None:
        return self._one("dim_device", device)

    def last_positions(self, limit: int = DEFAULT_LIMIT, offset: int = 0) -> Page:
        return self._page("last_position", F.lit(True), limit, offset)

    def last_position(self, device: str) -> dict[str, Any] | None:
        return self._one("last_position", device)

    def route(self, device: str, start: str | None = None, end: str | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0) -> Page:
        return self._page("route_points", filters(required_text(device, "device_serial"), *date_range(start, end)), limit, offset)

    def daily(self, device: str | None = None, start: str | None = None, end: str | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0) -> Page:
        device = None if device is None else required_text(device, "device_serial")
        return self._page("daily_summary", filters(device, *date_range(start, end)), limit, offset)

    def quality(self, start: str | None = None, end: str | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0) -> Page:
        return self._page("quality_summary", filters(None, *date_range(start, end), date_column="metric_date"), limit, offset)
