"""Makes the package importable in Spark's Python workers when it is used from a source tree."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def reach(spark: SparkSession) -> None:
    """Put the folder that holds this package on the workers' ``PYTHONPATH``.

    It takes effect for functions that are sent from then on.  On a cluster the
    package is installed on the executors, or the folder is one they share.
    """
    env = spark.sparkContext.environment
    parts = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, parts)])
