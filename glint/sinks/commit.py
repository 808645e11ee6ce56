"""Staged writes: a table appears whole or not at all.

A sink writes to a hidden folder beside its target (names that start with a
dot are no data to Spark's readers) and renames it into place once Spark has
committed the write. A target counts as finished if it holds `_SUCCESS`;
anything else there is what a killed job left, and is replaced."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def finished(spark: SparkSession, path: str) -> bool:
    """Does `path` hold a table that was written to its end?"""
    fs, p = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def beside(path: str, kind: str) -> str:
    """A new hidden folder next to `path`."""
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/.{name}.{kind}-{uuid.uuid4().hex}" if head else f".{name}.{kind}-{uuid.uuid4().hex}"


def staged_write(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    overwrite: bool = False,
    check: Callable[[], None] | None = None,
) -> bool:
    """Let `write` fill a staged folder, then make it `path`. A finished
    target is kept unless `overwrite` (returns False). `check` is called
    between the two and may raise, which leaves the target as it was."""
    if not overwrite and finished(spark, path):
        return False
    stage = beside(path, "staged")
    try:
        write(stage)
        if check:
            check()
        fs, target = _path(spark, path)
        if fs.exists(target):
            fs.delete(target, True)
        if target.getParent() is not None:
            fs.mkdirs(target.getParent())
        if not fs.rename(_path(spark, stage)[1], target):
            raise OSError(f"could not rename {stage} to {path}")
    finally:
        remove(spark, stage)
    return True


def save_beside(df: DataFrame, path: str, write: Callable[[DataFrame], None]) -> None:
    """Write `df` next to `path`, pass it to `write` read back, and remove
    it. A range shuffle samples its input first: what was saved is not
    computed twice."""
    spark, place = df.sparkSession, beside(path, "rows")
    try:
        df.write.option("compression", "lz4").parquet(place)
        write(spark.read.schema(df.schema).parquet(place))
    finally:
        remove(spark, place)
