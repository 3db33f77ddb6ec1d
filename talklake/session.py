"""Session helpers and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Partitions for scans of long texts whose files have fewer splits than there are cores; unset: as read.
PARTITIONS_KEY = "spark.talklake.partitions"
_local_roots: dict[str, str] = {}
_run: ContextVar[str | None] = ContextVar("run", default=None)


def local_session(
    app: str = "talklake", cores: str = "*", shuffle_partitions: int = 8, scratch: str | None = None
) -> SparkSession:
    """A session for tests and benchmarks on one machine; ``scratch`` names its folder for written tables."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if cores.isdigit():
        builder = builder.config(PARTITIONS_KEY, cores)
    if scratch:
        builder = builder.config(CHECKPOINT_KEY, scratch)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets a
    folder of this machine, which goes when the process ends: executors elsewhere could not read it.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="talklake-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch root, or below the current run's folder; never reused."""
    return f"{_run.get() or scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """One scratch folder for everything that is written meanwhile; it is removed at the end.

    Leave the block only when the run's sinks have finished: DataFrames made inside read from the folder.
    """
    folder = f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Later branches reread files instead of recomputing, a lost executor costs only
    the rereading, and Catalyst knows the true size when it chooses a join.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows to as many partitions as ``spark.talklake.partitions`` says; unset leaves them as read.

    For a scan with fewer splits than the session has cores; a scan of many files needs no setting.
    """
    partitions = int(df.sparkSession.conf.get(PARTITIONS_KEY, "0") or 0)
    return df.repartition(partitions, *keys) if partitions else df
