"""Helpers shared by the text operators."""

from __future__ import annotations

import pickle
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import work_dir

# Odd 64-bit multipliers for mixing hashes.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: Whether Spark removes a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Documents whose intermediate arrays are held at once inside a task.
CHUNK_BYTES = 1 << 22


def map_documents(docs: DataFrame, columns: list[str], schema: str, fn: Callable[[Iterator[tuple]], Iterator[dict]]) -> DataFrame:
    """Run ``fn`` over tuples of ``columns``; it yields dicts of lists, each dict being a batch of result rows.

    Only the named columns reach Python, so further columns of ``docs`` cannot clash with the result's.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        def rows():
            for batch in batches:
                taken = [batch.column(i) for i in range(len(columns))]
                for i in range(batch.num_rows):
                    yield tuple(c[i].as_py() for c in taken)

        for part in fn(rows()):
            yield pa.RecordBatch.from_arrays([pa.array(part[f.name], f.type) for f in arrow], schema=arrow)

    return docs.select(*columns).mapInArrow(run, schema)


def in_chunks(rows: Iterator[tuple], text_at: int) -> Iterator[list[tuple]]:
    """Lists of rows whose texts together are about :data:`CHUNK_BYTES` long, so that memory does not follow the row count."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[text_at] or "")
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def write_once(df: DataFrame, tag: str) -> DataFrame:
    """Write a small or shared intermediate to the shared folder; the reread frame has a known size and no lineage.

    The shuffles of the writing go from disk with it: nothing reads them again.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, tag)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drawn(share: float, *columns: str | Column) -> Column:
    """Whether a row is in a sample of this share, by a 64-bit hash: a sample of a few rows of any number of rows isn't empty."""
    return F.lit(True) if share >= 1 else F.xxhash64(*columns) < F.lit(int(share * 2**64) - 2**63)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(29))
    h = h * MIX_A
    h = h ^ (h >> np.uint64(32))
    h = h * MIX_B
    return h ^ (h >> np.uint64(29))


def worker_cache(kind: str, key: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task: of each kind only the entry last asked for, so that memory stays bounded.

    Code travels by value, so a variable of this module would start anew in each task.
    """
    name = "riskloom_worker_state"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if kind not in held or held[kind][0] != key:
        held.pop(kind, None)
        held[kind] = (key, make())
    return held[kind][1]


class Shipped:
    """A broadcast object, unpacked once in each worker. For models and vocabularies, whose size is fixed beforehand."""

    def __init__(self, spark: SparkSession, value: object):
        self.broadcast = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self.key = f"shipped {id(spark.sparkContext)} {self.broadcast._jbroadcast.id()}"

    def __getstate__(self):
        return {"broadcast": self.broadcast, "key": self.key}

    @property
    def value(self):
        return worker_cache("shipped", self.key, lambda: pickle.loads(self.broadcast.value))
