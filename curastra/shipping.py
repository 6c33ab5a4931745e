"""What Python workers need: the package on their path, and Arrow batches of bounded size."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch, where the session has Spark's default of 64 MB: texts are long, and several workers share an executor.
BATCH_BYTES = 8 << 20
_BATCHES, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "67108864", "64m", "64MB")
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> None:
    """Puts the folder of the package on the Python path of workers that start later.

    That serves workers on machines which see the folder; on others the package comes by --py-files, as usual. Arrow
    batches get BATCH_BYTES unless the session sets its own.
    """
    if spark.conf.get(_BATCHES, None) in _DEFAULT:
        spark.conf.set(_BATCHES, str(BATCH_BYTES))
    environment = spark.sparkContext.environment
    parts = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in parts:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *parts])
