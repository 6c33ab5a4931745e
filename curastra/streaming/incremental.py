"""The batch transforms on streams: new files in, first rows of each key out, with watermarked state and checkpoints.

State is bounded by the watermark: keys older than it are forgotten. Without an event-time column the keys of all
time are kept by a left-anti join with the sink in every micro-batch instead, so that state lives in the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.relational import keep_first, resume
from ..sources.sinks import exists


def read_stream(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_in_window(stream: DataFrame, keys: list[str], time: str, lateness: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark; later copies are dropped."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, by: list[str], width: str = "1 hour", slide: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """Counts in tumbling or sliding windows; windows close when the watermark passes them."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, lateness).groupBy(window.alias("w"), *by).agg(F.count("*").alias("n")).select("w.start", "w.end", *by, "n")


def append_new_keys(stream: DataFrame, key: str, order: str, sink: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append the first row of each new key to a Parquet sink, partitioned by ``batch_id``.

    A batch that is run again overwrites its own partition, so that neither half nor double appends remain. Known keys are
    read from a table of their own (``<sink>_keys``: the key alone, by batch), not from the sink's rows.
    """
    known = f"{sink.rstrip('/')}_keys"

    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        rows = keep_first(rows.where(F.col(key).isNotNull()), [key], [order])
        spark = batch.sparkSession
        if exists(spark, known):
            earlier = spark.read.schema(StructType([rows.schema[key], StructField("batch_id", LongType())])).parquet(known)
            rows = resume(rows, earlier.where(F.col("batch_id") != number), [key])
        rows.write.mode("overwrite").parquet(f"{sink}/batch_id={number}")
        done = spark.read.schema(rows.schema).parquet(f"{sink}/batch_id={number}")
        done.select(key).write.mode("overwrite").parquet(f"{known}/batch_id={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
