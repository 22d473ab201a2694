"""Raw files into the bronze table, once each, with lineage and a control log."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.config import Settings
from wayledger.contracts import CONTROL, LINEAGE_COLUMNS
from wayledger.functions.dialect import try_timestamp
from wayledger.operators.bad_rows import COLUMN_COUNT
from wayledger.sources.csv_files import FileReport, discover_csv_files, inspect_files, long_rows, move_file, read_files
from wayledger.store import TableStore

STATUSES = ("PROCESSING", "SUCCESS", "FAILED", "SKIPPED")


def new_batch_id() -> str:
    return str(uuid.uuid4())


def utc(t: datetime) -> datetime:
    """Naive times are UTC."""
    return t.replace(tzinfo=UTC) if t.tzinfo is None else t.astimezone(UTC)


def row_id(file_hash: str, number: int) -> str:
    """Stable id of a row: hash of its file's hash and its place."""
    import hashlib

    if not file_hash.strip() or number < 1:
        raise ValueError("needs a file hash and a row number from 1")
    return hashlib.sha256(f"{file_hash}:{number}".encode()).hexdigest()


def control_event(batch_id: str, source_file: str, status: str, *, source_file_hash: str | None = None, stage: str = "BRONZE", started_at: datetime, finished_at: datetime | None = None, row_count: int | None = None, inserted: int | None = None, duplicates: int | None = None, reason: str | None = None, error: str | None = None) -> tuple:
    """One event of the control log, checked; final states are finished when recorded."""
    status = status.strip().upper()
    if status not in STATUSES:
        raise ValueError(f"unknown status {status}")
    if not batch_id.strip() or not source_file.strip():
        raise ValueError("needs a batch id and a file name")
    if any(n is not None and n < 0 for n in (row_count, inserted, duplicates)):
        raise ValueError("counts can't be negative")
    now = datetime.now(UTC)
    started = utc(started_at)
    finished = utc(finished_at) if finished_at else (None if status == "PROCESSING" else now)
    if finished and finished < started:
        raise ValueError("finished before it started")
    return (str(uuid.uuid4()), batch_id, source_file, source_file_hash, status, stage, started, finished, row_count, inserted, duplicates, reason, error, now)


def successful_hashes(control: DataFrame) -> DataFrame:
    """Hashes of files that were loaded at least once."""
    return control.where((F.col("status") == "SUCCESS") & (F.trim(F.coalesce("source_file_hash", F.lit(""))) != "")).select("source_file_hash").distinct()


def insert_only(target: DataFrame, source: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows of ``source`` whose key ``target`` lacks."""
    return source.join(target.select(key), key, "left_anti").select(*source.columns)


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """All of ``source``, and of ``target`` what it doesn't replace."""
    return target.join(source.select(key), key, "left_anti").select(*source.columns).unionByName(source)


@dataclass(frozen=True)
class BronzeResult:
    """What a load did; ``batch_ids`` are the batches that brought new rows."""

    discovered: int = 0
    successful: tuple[str, ...] = ()
    skipped: tuple[str, ...] = ()
    failed: tuple[str, ...] = ()
    batch_ids: tuple[str, ...] = ()
    inserted_rows: int = 0
    duplicate_rows: int = 0


@dataclass
class Bronze:
    """The bronze table, its index of event days, and the control log."""

    spark: SparkSession
    settings: Settings
    table: TableStore = field(init=False)
    days: TableStore = field(init=False)
    control: TableStore = field(init=False)

    def __post_init__(self):
        self.table = TableStore(self.spark, f"{self.settings.layer('bronze')}/tracker_logs", "ingestion_date")
        self.days = TableStore(self.spark, f"{self.settings.layer('bronze')}/tracker_log_days", "ingestion_date")
        self.bad_rows = TableStore(self.spark, f"{self.settings.layer('bronze')}/bad_rows", "ingestion_date")
        self.control = TableStore(self.spark, f"{self.settings.layer('control')}/ingestion_files")

    def log(self, events: Iterable[tuple]) -> None:
        if rows := list(events):
            self.control.append(self.spark.createDataFrame(rows, CONTROL).coalesce(1))
            self.control.compact(64)

    def _known(self, hashes: list[str]) -> set[str]:
        if not self.control.exists():
            return set()
        return {r.source_file_hash for r in self._of_files(successful_hashes(self.control.read()), hashes).collect()}

    def _of_files(self, df: DataFrame, hashes: list[str]) -> DataFrame:
        """The rows of the given file hashes."""
        return df.join(self.spark.createDataFrame([(h,) for h in hashes], "source_file_hash string"), "source_file_hash", "left_semi")

    def load(self) -> BronzeResult:
        """Take in the inbox: skip files loaded before, quarantine bad ones, append the rest.

        All valid files are one commit; each keeps its own batch id. Loaded and skipped files are
        archived after the commit, so a crash before it leaves them in the inbox.
        """
        s = self.settings
        files = discover_csv_files(s.inbox, self.spark)
        if not files:
            return BronzeResult()
        started = datetime.now(UTC)
        reports = inspect_files(self.spark, files, s.salvage)
        batch = {r.path: new_batch_id() for r in reports}
        seen = self._known([r.sha256 for r in reports if r.sha256])
        events, good, skipped, failed = [], [], [], []

        def note(r: FileReport, status: str, **more) -> None:
            events.append(control_event(batch[r.path], r.name, status, source_file_hash=r.sha256, started_at=started, **more))

        for r in reports:
            if r.hash_failed:
                note(r, "FAILED", reason="FILE_HASH_ERROR", error=r.error)
                failed.append(r)
            elif r.sha256 in seen:
                note(r, "SKIPPED", reason="SOURCE_FILE_HASH_ALREADY_SUCCESSFUL")
                skipped.append(r)
            else:
                note(r, "PROCESSING")
                if r.error:
                    note(r, "FAILED", row_count=r.row_count, reason="VALIDATION_FAILED", error=r.error)
                    failed.append(r)
                else:
                    seen.add(r.sha256)
                    good.append(r)
        self.log(events)
        events.clear()
        counts: dict[str, int] = {}
        if good:
            try:
                counts = self._append(good, batch, started)
            except Exception as e:  # noqa: BLE001 - whatever the write failed of goes to the log
                for r in good:
                    note(r, "FAILED", row_count=r.row_count, reason="BRONZE_WRITE_FAILED", error=str(e)[:2000])
                failed += good
                good = []
        for r in good:
            n = counts.get(batch[r.path], 0)
            note(r, "SUCCESS", row_count=r.row_count, inserted=n, duplicates=r.row_count - n)
        self.log(events)
        by_path = {str(f): f for f in files}
        for group, folder in ((good, s.archive), (skipped, s.archive), (failed, s.quarantine)):
            for r in group:
                move_file(by_path[r.path], folder, batch[r.path], self.spark)
        names = lambda g: tuple(r.name for r in g)
        inserted = sum(counts.values())
        return BronzeResult(len(files), names(good), names(skipped), names(failed), tuple(batch[r.path] for r in good if counts.get(batch[r.path])), inserted, sum(r.row_count for r in good) - inserted)

    def with_lineage(self, good: list[FileReport], batch: dict[str, str], at: datetime) -> DataFrame:
        info = self.spark.createDataFrame([(r.path, r.name, r.sha256, batch[r.path]) for r in good], "path string, source_file string, source_file_hash string, batch_id string")
        rows = read_files(self.spark, good)
        out = rows.join(info, "path").withColumns({
            "row_id": F.sha2(F.concat_ws(":", "source_file_hash", "source_row_number"), 256),
            "ingested_at": F.lit(at),
            "ingestion_date": F.lit(utc(at).date().isoformat()),
        })
        return out.select(*[F.col(f"`{c}`") for c in rows.columns if c not in ("path", "source_row_number")], *LINEAGE_COLUMNS)

    def _set_aside(self, good: list[FileReport], batch: dict[str, str], at: datetime) -> DataFrame:
        """The records that don't fit their header, with the reason, keyed as the loaded rows are."""
        info = self.spark.createDataFrame([(r.path, r.name, r.sha256, batch[r.path]) for r in good], "path string, source_file string, source_file_hash string, batch_id string")
        rows = long_rows(self.spark, good).join(info, "path")
        row_key = F.sha2(F.concat_ws(":", "source_file_hash", "source_row_number"), 256).alias("row_id")
        return rows.select("source_file", "source_file_hash", "source_row_number", row_key, "batch_id", "fields", F.lit(COLUMN_COUNT).alias("reason"), F.lit(utc(at).date().isoformat()).alias("ingestion_date"))

    def _append(self, good: list[FileReport], batch: dict[str, str], at: datetime) -> dict[str, int]:
        """Insert-only by row id; gives the rows inserted by batch.

        Only bronze rows of the same file hashes can hold the same ids, so only those are read.
        The rows become part of the table by the last step, when index and counts are known.
        """
        new = self.with_lineage(good, batch, at)
        if self.table.exists():
            old = self._of_files(self.table.read(), [r.sha256 for r in good])
            new = insert_only(old, new)
        staged = self.table.stage(new)
        fresh = self.table.staged_rows(staged)
        day = F.date_format(F.coalesce(try_timestamp(F.col("TM_STAMP")), try_timestamp(F.col("DATA_SERVIDOR"))), "yyyy-MM-dd")
        # the index first: one that names rows which a crash kept out of the table does no harm
        self.days.append(fresh.select("ingestion_date", "batch_id", F.coalesce(day, F.lit("unknown")).alias("event_day")).distinct().coalesce(1))
        if any(r.bad_rows for r in good):
            aside = self._set_aside(good, batch, at)
            self.bad_rows.append(insert_only(self.bad_rows.read(), aside) if self.bad_rows.exists() else aside)
        counts = {r.batch_id: r["count"] for r in fresh.groupBy("batch_id").count().collect()}
        self.table.publish(staged)
        return counts
