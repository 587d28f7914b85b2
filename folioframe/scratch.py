"""Tables in a folder that the driver and all executors share, which cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors share.

    It lies under ``spark.checkpoint.dir``.  Only where that is unset (tests on one machine) a
    local folder is made and recorded in the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.folioframe.scratch", None)
        if not base:
            folder = tempfile.mkdtemp(prefix="folioframe-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            base = "file://" + folder
            spark.conf.set("spark.folioframe.scratch", base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark).rstrip('/')}/folioframe/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that is no longer read."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _drop_all() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                drop_path(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone at exit
            pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back: lineage is cut, lost executors don't matter."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out
