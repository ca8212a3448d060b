"""Intermediate tables in the cluster's shared folder, for results that several steps of a query start from."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Without the setting a temporary one, but only where all of Spark is one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return _LOCAL.get("dir") or _LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="lessonlake-"))


def materialize(df: DataFrame) -> DataFrame:
    """Writes the rows as Parquet below the shared folder and reads them again: computed once, readable by any
    executor, and of known size to the planner. `release` deletes what was written."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{uuid.uuid4().hex}"
    if not _LOCAL.setdefault("at_exit", ""):
        _LOCAL["at_exit"] = "yes"
        atexit.register(_remove)  # registered once Spark runs, so that it runs before Spark ends
    _WRITTEN.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Deletes all intermediate tables; to be called when the results that start from them are written. Runs at exit too."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session has ended; a local folder goes below
            continue


def _remove() -> None:
    release()
    if "dir" in _LOCAL:
        shutil.rmtree(_LOCAL["dir"], ignore_errors=True)
