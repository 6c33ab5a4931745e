"""Sessions with the settings that the engine counts on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Adaptive execution coalesces small partitions and splits skewed joins; sizes suit executors of a few GB.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, name: str = "curastra", shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session; on a cluster leave ``master`` and partitions to the submit settings."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SETTINGS, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """The rows over at least as many partitions as there are cores, where a scan gives fewer (a small table in one file).

    Large tables come in many splits and are left as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
