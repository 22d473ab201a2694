"""Session defaults and the shared folder where lineage is cut.

Nothing here holds data on one machine: intermediate tables go to the folder that the
cluster names in ``spark.checkpoint.dir``. Only where that is unset (tests, a laptop) a
local folder is made and removed when the process ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None
_scratch: list[str] = []
_shipped: set[str] = set()


def get_session(app: str = "wayledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the plans rely on: UTC, AQE, text partition values."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, wherever they run; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="wayledger-code-")
    atexit.register(shutil.rmtree, folder, True)
    path = f"{folder}/{root.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the context's checkpoint
    folder. Without either a local session gets a folder of its own; a cluster must name one."""
    global _own_dir
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        set_later = spark._jsc.sc().getCheckpointDir()
        named = set_later.get() if set_later.isDefined() else None
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="wayledger-")
        atexit.register(shutil.rmtree, _own_dir, True)
    return f"file://{_own_dir}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nobody used before."""
    path = f"{shared_dir(spark)}/wayledger/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession, keep: int = 0) -> int:
    """Delete the intermediate tables of this process but for its first ``keep``, once the results
    read from them are no longer needed. Gives how many there were."""
    n = len(_scratch) - keep
    while len(_scratch) > keep:
        p = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return n


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end, whose results must be written by then."""
    before = len(_scratch)
    try:
        yield
    finally:
        clear_scratch(spark, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that several consumers read one result, and a lost executor costs
    only the tasks it ran: the written files stay.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Written tables up to this size are broadcast.
SMALL_BYTES = 16 << 20


def plan_size(df: DataFrame) -> int:
    """Bytes that the optimiser knows of; for a scan of files that of the files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def packed(df: DataFrame, target: int = 64 << 20) -> DataFrame:
    """The rows of a scan of many small files in fewer tasks, each of about ``target`` bytes of
    files, but never fewer tasks than cores."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-plan_size(df) // target)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the data folder.

    Its naive times are UTC and meet zoned ones in UTC, so the session is put to UTC.
    """
    ship(spark)
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
