"""CSV files of an inbox: discovery, inspection, reading and moving.

Files are inspected and read by tasks, one file each, never on the driver; the driver only sees
one result row per file. A file is named by a local path or by a URI: the driver lists and moves
files of a URI through Hadoop's FileSystem, tasks open them through Arrow's.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import shutil
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path, PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayledger.contracts import LINEAGE_COLUMNS, SOURCE_COLUMNS

_CHUNK = 1 << 20


def _hadoop(spark: SparkSession, uri: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def discover_csv_files(inbox: Path | str, spark: SparkSession | None = None) -> list[Path | str]:
    """The folder's own ``.csv`` files, by lower-cased name; none if there is no folder."""
    if isinstance(inbox, str) and "://" in inbox:
        fs, p = _hadoop(spark, inbox)
        found = [s.getPath() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []
        return sorted((f.toString() for f in found if f.getName().lower().endswith(".csv")), key=lambda f: f.rsplit("/", 1)[1].lower())
    inbox = Path(inbox)
    if not inbox.is_dir():
        return []
    return sorted((p for p in inbox.iterdir() if p.is_file() and p.suffix.lower() == ".csv"), key=lambda p: p.name.lower())


def open_bytes(path: str | Path):
    """A file of a path or URI, to be read from its start."""
    path = str(path)
    if "://" not in path and not path.startswith("file:"):
        return open(path, "rb")
    from pyarrow import fs

    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    source, at = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return source.open_input_stream(at)


def write_bytes(path: str, data: bytes) -> None:
    """A file of a path or URI, written whole."""
    if "://" in path and not path.startswith("file:"):
        from pyarrow import fs

        target, at = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        target.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with target.open_output_stream(at) as f:
            f.write(data)
        return
    local = Path("/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path)
    local.parent.mkdir(parents=True, exist_ok=True)
    local.write_bytes(data)


def open_text(path: str | Path, encoding: str) -> io.TextIOBase:
    return io.TextIOWrapper(open_bytes(path), encoding=encoding, newline="")


def digest_and_encoding(path: str | Path) -> tuple[str, str, int]:
    """Hash of the content, its encoding and its size, in one pass and in pieces.

    utf-8-sig if the whole file decodes as UTF-8, else latin-1.
    """
    h, size, decoder = hashlib.sha256(), 0, codecs.getincrementaldecoder("utf-8")()
    with open_bytes(path) as f:
        while piece := f.read(_CHUNK):
            h.update(piece)
            size += len(piece)
            try:
                decoder = decoder and (decoder.decode(piece), decoder)[1]
            except UnicodeDecodeError:
                decoder = None
    try:
        decoder = decoder and (decoder.decode(b"", True), decoder)[1]
    except UnicodeDecodeError:
        decoder = None
    return h.hexdigest(), "utf-8-sig" if decoder else "latin-1", size


def file_sha256(path: str | Path) -> str:
    """Hash of the content."""
    return digest_and_encoding(path)[0]


def detect_encoding(path: str | Path) -> str:
    """utf-8-sig if the whole file decodes as UTF-8, else latin-1."""
    return digest_and_encoding(path)[1]


def records(lines: io.TextIOBase) -> Iterator[list[str]]:
    """Records of a CSV text without the blank ones."""
    for r in csv.reader(lines):
        if r:
            yield r


@dataclass(frozen=True)
class FileReport:
    """What inspection found; ``error`` is None for a valid file.

    ``row_count`` counts the rows that can be loaded, ``bad_rows`` those that salvage sets aside.
    """

    path: str
    sha256: str | None
    encoding: str | None = None
    header: tuple[str, ...] = ()
    row_count: int | None = None
    error: str | None = None
    hash_failed: bool = False
    bad_rows: int = 0

    @property
    def name(self) -> str:
        return PurePosixPath(self.path).name


def header_problem(header: Sequence[str]) -> str | None:
    """Duplicate, missing or reserved column names, in this order."""
    if len(set(header)) < len(header):
        return "duplicated columns: " + ", ".join(dict.fromkeys(c for c in header if list(header).count(c) > 1))
    if missing := [c for c in SOURCE_COLUMNS if c not in header]:
        return "missing columns: " + ", ".join(missing)
    if reserved := [c for c in LINEAGE_COLUMNS if c in header]:
        return "reserved columns: " + ", ".join(reserved)
    return None


def inspect_file(path: str, salvage: bool = False) -> FileReport:
    """Hash, encoding, header and row count, or what is wrong with the file.

    Order of checks: file, extension, size, readable, rows, header. A record longer than the
    header is an error, or with ``salvage`` a bad row; a shorter one is neither.
    """
    try:
        digest, encoding, size = digest_and_encoding(path)
    except (OSError, pa.ArrowException) as e:
        return FileReport(path, None, error=str(e), hash_failed=True)
    if not path.lower().endswith(".csv"):
        return FileReport(path, digest, error="not a .csv file")
    if size == 0:
        return FileReport(path, digest, error="the file is empty")
    try:
        with open_text(path, encoding) as f:
            rows = records(f)
            header = tuple(c.strip() for c in next(rows, ()))
            if not header:
                return FileReport(path, digest, encoding, error="no header or data")
            n = bad = 0
            for n, r in enumerate(rows, 1):
                if len(r) > len(header):
                    if not salvage:
                        return FileReport(path, digest, encoding, header, error=f"record {n} has {len(r)} fields, the header {len(header)}")
                    bad += 1
    except (OSError, csv.Error, pa.ArrowException) as e:
        return FileReport(path, digest, encoding, error=f"unreadable: {e}")
    if n == bad:
        return FileReport(path, digest, encoding, header, n, "no data rows" if n == 0 else "no row fits the header")
    return FileReport(path, digest, encoding, header, n - bad, header_problem(header), bad_rows=bad)


_REPORT = "path string, sha256 string, encoding string, header array<string>, row_count long, error string, hash_failed boolean, bad_rows long"


def _inspect(salvage: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [w.split()[0] for w in _REPORT.split(", ")]
        kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.string(), pa.bool_(), pa.int64()]
        for b in batches:
            got = [inspect_file(p, salvage) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([list(v) if isinstance(v := getattr(r, c), tuple) else v for r in got], k) for c, k in zip(names, kinds, strict=True)], names=names)

    return run


def _paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per file, each in a task of its own."""
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))


def inspect_files(spark: SparkSession, paths: Sequence[str | Path], salvage: bool = False) -> list[FileReport]:
    """Inspect all files in parallel; one row per file comes back, in the given order."""
    paths = [str(p) for p in paths]
    if not paths:
        return []
    rows = _paths(spark, paths).mapInArrow(_inspect(salvage), _REPORT).toLocalIterator()
    got = {r.path: FileReport(r.path, r.sha256, r.encoding, tuple(r.header), r.row_count, r.error, r.hash_failed, r.bad_rows) for r in rows}
    return [got[p] for p in paths]


def _read(encodings: dict[str, tuple[str, int]], long: bool = False):
    """Rows of the files that fit their header, or with ``long`` those that are longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(path: str, held: list[tuple[int, list[str]]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([path] * len(held)), pa.array([n for n, _ in held], pa.int64()), pa.array([r for _, r in held], pa.list_(pa.string()))], names=["path", "source_row_number", "fields"])

        for b in batches:
            for path in b.column(0).to_pylist():
                encoding, width = encodings[path]
                with open_text(path, encoding) as f:
                    rows = records(f)
                    next(rows)
                    held = []
                    for n, r in enumerate(rows, 1):
                        if (len(r) > width) == long:
                            held.append((n, r + [""] * (width - len(r))))
                        if len(held) == 5000:
                            yield out(path, held)
                            held = []
                    if held:
                        yield out(path, held)

    return run


def long_rows(spark: SparkSession, reports: Sequence[FileReport]) -> DataFrame:
    """(path, source_row_number, fields): the records that are longer than their file's header."""
    some = [r for r in reports if r.bad_rows]
    shape = "path string, source_row_number long, fields array<string>"
    if not some:
        return spark.createDataFrame([], shape)
    return _paths(spark, [r.path for r in some]).mapInArrow(_read({r.path: (r.encoding, len(r.header)) for r in some}, True), shape)


def read_files(spark: SparkSession, reports: Sequence[FileReport]) -> DataFrame:
    """Rows of valid files: all columns as text, with path and 1-based ``source_row_number``.

    Files may have different extra columns; what a file lacks is null. Empty fields and fields
    cut off at the end of a record are ``''``.
    """
    out = None
    by_header: dict[tuple[str, ...], list[FileReport]] = {}
    for r in reports:
        by_header.setdefault(r.header, []).append(r)
    for header, group in by_header.items():
        raw = _paths(spark, [r.path for r in group]).mapInArrow(_read({r.path: (r.encoding, len(header)) for r in group}), "path string, source_row_number long, fields array<string>")
        df = raw.select(*[F.col("fields")[i].alias(c) for i, c in enumerate(header)], "path", "source_row_number")
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        fields = [T.StructField(c, T.StringType()) for c in [*SOURCE_COLUMNS, "path"]]
        out = spark.createDataFrame([], T.StructType([*fields, T.StructField("source_row_number", T.LongType())]))
    return out


def move_file(source: Path | str, folder: Path | str, conflict_suffix: str, spark: SparkSession | None = None) -> Path | str:
    """Move into a folder; a taken name becomes ``stem__suffix.ext``, taken again is an error."""
    name = PurePosixPath(str(source))
    names = (name.name, f"{name.stem}__{conflict_suffix}{name.suffix}")
    if isinstance(folder, str) and "://" in folder:
        fs, to = _hadoop(spark, folder)
        fs.mkdirs(to)
        for n in names:
            _, at = _hadoop(spark, f"{folder}/{n}")
            if not fs.exists(at):
                if not fs.rename(_hadoop(spark, str(source))[1], at):
                    raise OSError(f"can't move {source} to {folder}/{n}")
                return f"{folder}/{n}"
        raise FileExistsError(f"{folder}/{names[1]}")
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    for n in names:
        if not (folder / n).exists():
            return Path(shutil.move(str(source), str(folder / n)))
    raise FileExistsError(str(folder / names[1]))
