"""Sinks: append without repeats, named datasets, checkpoints with a manifest, bucketed packs, CSV and JSON lines."""

from __future__ import annotations

import datetime
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import append_new, mode_first


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def children(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return sorted(str(s.getPath()) for s in found or [])


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def append_jsonl(df: DataFrame, path: str, key: str, order: str) -> None:
    """Append rows whose key is neither in the file nor earlier in the batch; rows with a null key always."""
    spark = df.sparkSession
    new = append_new(spark.read.schema(df.schema).json(path), df, key, order) if exists(spark, path) else append_new(df.limit(0), df, key, order)
    new.write.mode("append").json(path)


def dataset_name(df: DataFrame, model: str, order: str, now: datetime.datetime) -> str:
    """<top domain>_<model>_<sources>_<rows>_<time> from the data."""
    top = mode_first(df, "domain", order).first()
    sources = "_".join(sorted(r[0] for r in df.select("source").distinct().orderBy("source").limit(20).collect() if r[0]))
    safe = lambda s: re.sub(r"[^A-Za-z0-9.-]+", "_", str(s))
    return f"{safe(top['domain'] if top else 'none')}_{safe(model)}_{safe(sources)}_{df.count()}_{now:%Y%m%d_%H%M%S}"


def write_dataset(df: DataFrame, folder: str, model: str, order: str = "ord", now: datetime.datetime | None = None) -> str:
    """A named Parquet dataset, and the same as ``dataset_latest`` (overwritten)."""
    path = f"{folder}/{dataset_name(df, model, order, now or datetime.datetime.now(datetime.timezone.utc))}.parquet"
    df.write.parquet(path)
    df.sparkSession.read.parquet(path).write.mode("overwrite").parquet(f"{folder}/dataset_latest.parquet")
    return path


def write_step(df: DataFrame, folder: str, step: int, title: str, key_fields: list[str]) -> None:
    """A step's checkpoint: key fields as columns, all others as JSON in ``_extra``; a manifest row beside it."""
    rest = [c for c in df.columns if c not in key_fields]
    extra = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])) if rest else F.lit("{}")
    df.select(*[F.col(f"`{c}`") for c in key_fields if c in df.columns], extra.alias("_extra")).write.mode("overwrite").parquet(f"{folder}/step{step}")
    spark = df.sparkSession
    n = spark.read.parquet(f"{folder}/step{step}").count()
    now = datetime.datetime.now(datetime.timezone.utc).isoformat()
    spark.createDataFrame([(step, title, now, n)], "step int, title string, timestamp string, total long").coalesce(1).write.mode("overwrite").json(f"{folder}/step{step}_manifest")


def read_step(spark: SparkSession, folder: str, step: int, extra_schema: str | None = None) -> DataFrame:
    """A checkpoint with the wanted extra fields as columns again."""
    df = spark.read.parquet(f"{folder}/step{step}")
    if extra_schema is None:
        return df
    return df.withColumn("_x", F.from_json("_extra", extra_schema)).select(*[c for c in df.columns if c != "_extra"], "_x.*")


def write_packs(df: DataFrame, bucket: str, folder: str) -> None:
    """One pass: a folder per bucket (sft, rl, rejected), as Parquet."""
    df.write.mode("overwrite").partitionBy(bucket).parquet(folder)


def write_csv(df: DataFrame, path: str) -> None:
    """A summary as one CSV part with a header; only for results whose rows are few by construction."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_summary(spark: SparkSession, values: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(values, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def datasets(spark: SparkSession, folder: str) -> list[str]:
    return children(spark, folder, "*.parquet")


def clean_steps(spark: SparkSession, folder: str) -> None:
    for path in children(spark, folder, "step*"):
        remove(spark, path)
