"""Scratch tables in the shared folder, and sizes that decide between a broadcast and a shuffle."""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread
from ..shipping import importable

#: Most rows of a two-column key table that is broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Most vectors of partial sums that the driver adds.
SLOTS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where a local session has none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="curastra-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may be gone at exit
        pass


class Scratch:
    """Tables written once and read again. They cut lineage in a place that outlives any executor.

    ``drop`` removes those that no later step reads; the rest go when the process ends.
    """

    def __init__(self, spark: SparkSession):
        importable(spark)
        self.spark, self.root = spark, f"{shared_dir(spark)}/curastra-{uuid.uuid4().hex}"
        self.count = 0
        atexit.register(_remove, spark, self.root)

    def cut(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _remove(self.spark, df._scratch_path)


def keys_join(df: DataFrame, keys: DataFrame, on: str, how: str, n_keys: int | None = None) -> DataFrame:
    """Join with a table of keys: by broadcast if it has been counted to be small, else by shuffle."""
    n = keys.count() if n_keys is None else n_keys
    return df.join(F.broadcast(keys) if n <= BROADCAST_ROWS else keys, on, how)


def _added(dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column(0):
                part = np.frombuffer(x.as_py(), dtype=dtype)
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def summed(parts: DataFrame, dtype) -> np.ndarray | None:
    """The sum of vectors of one size, one for each partition (``sums``, their bytes), or None if there are none.

    They are added in a tree: no task reads more than about the square root of their number, and the driver a few."""
    n = parts._jdf.queryExecution().toRdd().getNumPartitions()
    parts = parts.withColumn("slot", F.spark_partition_id())
    while n > SLOTS:
        n = max(SLOTS, math.isqrt(n)) if n > SLOTS * SLOTS else SLOTS
        parts = parts.select("sums", (F.col("slot") % n).alias("slot")).repartition(n, "slot").select("sums").mapInArrow(_added(dtype), "sums binary").withColumn("slot", F.spark_partition_id())
    rows = parts.select("sums").collect()
    return sum(np.frombuffer(r["sums"], dtype=dtype) for r in rows) if rows else None


def string_columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns under our own names, so that extra columns of the input never clash."""
    importable(df.sparkSession)
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in wanted.items()])


def each_batch(run: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that applies ``run`` to every batch that has rows."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := run(batch)) is not None and out.num_rows:
                yield out

    return over


def crc_mod(col: str, by: int):
    """crc32 of an id as text, modulo ``by``; null ids give null."""
    return F.crc32(F.col(col).cast("string")) % by


def ceil_div(a, b: int):
    return F.ceil(a / F.lit(float(b))).cast("long")


def bits_needed(p: float, n: int, sigmas: float) -> int:
    """Least count of n Bernoulli(p) trials that lies within so many deviations below the mean."""
    return math.floor(n * p - sigmas * math.sqrt(n * p * (1 - p)))
