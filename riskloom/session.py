"""Session defaults, shared scratch space and plan-size checks."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A plan estimated below this reads little enough that a group fits one task comfortably.
SMALL_PLAN_BYTES = 64 * 1024 * 1024

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here relies on; a cluster's own settings win where they are set."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording the Python line of every column expression costs more than building the plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="riskloom-")


def work_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder all executors can see.

    It lies under ``spark.checkpoint.dir``. Only a local session may do without that setting, since its
    executors share the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, tag: str = "cut") -> DataFrame:
    """Write ``df`` to shared storage and read it back: later stages survive the loss of an executor."""
    path = work_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of the result; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, limit: int = SMALL_PLAN_BYTES) -> bool:
    """Whether the files under ``df`` are small.

    Joins multiply the optimizer's estimates, so the leaves are summed instead: these are real file sizes.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        total += int(str(leaves.apply(i).stats().sizeInBytes()))
    return total <= limit


def spread_small(df: DataFrame) -> DataFrame:
    """Deal a small input over all cores; a large one keeps the partitions of its files.

    A small table is often one file with one row group, which a single task would read and process.
    """
    if not is_small(df):
        return df
    # By the hash of the row: the same row always lands in the same place, and nothing has to be sorted for that.
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
