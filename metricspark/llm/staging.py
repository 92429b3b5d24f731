"""Tables written to the shared checkpoint folder to cut lineage.

Every multi-job operator stages its intermediate results as Parquet under the
folder named by ``spark.checkpoint.dir``.  All executors and the driver share
that folder, so a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode where none is set (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _LOCAL_FALLBACK[app]


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is gone; the folder is scratch space
        pass


_scopes: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder, removed with its scope, at the latest when the driver exits."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove the folders made inside on leaving; no result that outlives the scope may read them."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            drop_folder(spark, path)


def stage_alone(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """As :func:`stage_at` of what ``make`` returns; all tables staged on the way are removed once it is written."""
    path = new_folder(spark, name)
    with scope(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path), path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that no later result reads."""
    _delete(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back."""
    return stage_at(df, name)[0]


def stage_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`stage`, with the folder, for callers that drop it early."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


class Scratch:
    """Staged tables of one operator that its lazy result does not read; dropped together."""

    def __init__(self) -> None:
        self._held: list[tuple[SparkSession, str]] = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """As :func:`stage`, remembered for :meth:`drop`."""
        staged, path = stage_at(df, name)
        self._held.append((df.sparkSession, path))
        return staged

    def drop(self) -> None:
        """Remove the tables; nothing may read them afterwards."""
        for spark, path in self._held:
            drop_folder(spark, path)
        self._held.clear()
