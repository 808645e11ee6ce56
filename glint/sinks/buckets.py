"""Bucketed tables: rows dealt by a hash of their keys when they are written,
so that joins, groupings and windows on those keys need no shuffle later.

A folder written by `write_bucketed` holds one file per bucket, sorted, and
beside them `_buckets`, which says how it was dealt. `bucketed_table` makes it
known to a session. All rows of a key are in one bucket, which one task reads:
meant for keys that stay small, such as a recording, not for a key that
may hold a large share of all rows."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .commit import finished, staged_write


def write_bucketed(
    df: DataFrame, path: str, keys: list[str], buckets: int, order: list[str] | None = None, overwrite: bool = False,
    compression: str = "lz4",
) -> DataFrame:
    """Write `df` in `buckets` buckets of `keys`, each sorted by the keys and
    `order`."""
    spark = df.sparkSession
    sort = [*keys, *(order or [])]
    name = f"stage_{uuid.uuid4().hex}"

    def save(stage: str) -> None:
        dealt = df.repartition(buckets, *keys).sortWithinPartitions(*sort)
        w = dealt.write.bucketBy(buckets, *keys).sortBy(*sort).option("compression", compression)
        try:
            w.option("path", stage).format("parquet").saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
        note = spark.createDataFrame([(keys, sort, buckets, df.schema.json())], "keys array<string>, sort array<string>, n int, fields string")
        note.coalesce(1).write.json(f"{stage}/_buckets")

    staged_write(spark, path, save, overwrite)
    return df


def bucketed_table(spark: SparkSession, path: str) -> DataFrame:
    """The table of `write_bucketed`, known to be dealt by its keys. Keys that
    are some of a join's are enough from now on in this session."""
    if not finished(spark, path):
        raise FileNotFoundError(f"no finished table at {path}")
    note = spark.read.schema("keys array<string>, sort array<string>, n int, fields string").json(f"{path}/_buckets").first()
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    fields = StructType.fromJson(json.loads(note["fields"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)
    name = f"bucketed_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({quoted(note['keys'])}) "
        f"SORTED BY ({quoted(note['sort'])}) INTO {note['n']} BUCKETS LOCATION '{path}'")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", False)
    return spark.table(name)
