"""Session settings, table access and the shared folder for cut lineage.

Every intermediate table that is read more than once is written to the folder in
``spark.checkpoint.dir``.  All executors see that folder, so a lost executor costs
only its running tasks.  Where the setting is missing (tests, a laptop) a folder of
our own is used and removed at the end.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper bounds, in rows, under which a side may be broadcast after it was counted.
SMALL_SIDE_ROWS = 50_000

_own_folder: str | None = None
#: Folders that the running piece of work leaves behind, where it wants them removed.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def build(app: str = "showgrain", cpus: str | int = "*", shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the engine expects."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share.

    Where none is set a local session gets a temporary one of its own; a cluster is refused, because
    its executors would each write to their own disk.
    """
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="showgrain-")
        atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
    return "file://" + os.path.abspath(_own_folder)


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    if (held := _passing.get()) is not None:
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes within are removed at the end: for work whose results are stored elsewhere."""
    token = _passing.set([])
    try:
        yield
    finally:
        for path in _passing.get():
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        _passing.reset(token)


def broadcast_if_small(df: DataFrame, bound: int = SMALL_SIDE_ROWS, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast when a count proves at most ``bound`` rows, else as it is.

    rows: an upper bound of the rows where one was counted already; then nothing is counted.
    """
    held = df.limit(bound + 1).count() if rows is None else rows
    return F.broadcast(df) if held <= bound else df


def spread(df: DataFrame) -> DataFrame:
    """A small input spread over the cluster ahead of CPU-heavy Python work.

    An input that fills every core with read partitions of its own is left as it is, so a
    large corpus is never shuffled for this.
    """
    spark = df.sparkSession
    wanted = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= wanted * spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes():
        return df
    return df.repartition(wanted)
