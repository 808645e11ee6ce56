"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A key that holds at least this share of the rows is "heavy". At most
#: 1 / HEAVY_SHARE keys can be, at any input size, so a list of heavy keys is
#: bounded and may be broadcast.
HEAVY_SHARE = 1 / 10_000
#: ... and it has at least so many rows (below that nothing needs splitting).
HEAVY_ROWS = 2_000

#: Fixed: the white space of the word definition `[^\x20\x09-\x0D]+`.
WORD_SPACE = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: Rows sent to a Python worker at once. Texts, pages and packed arrays are
#: large: the default of 10,000 would hold hundreds of MB in the worker and
#: again outside the heap of the executor's JVM.
BATCH_ROWS = 1_000
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session to `BATCH_ROWS` rows and
    about `BATCH_BYTES`."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder of `spark.checkpoint.dir` and read it
    back: cuts the lineage, and any executor may be lost afterwards."""
    return saved(df, name)[0]


#: Spark then deletes the shuffle files of a query when it ends, not when the
#: driver's JVM happens to collect its plan.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str, tidy: bool = False) -> tuple[DataFrame, str]:
    """`tidy`: the shuffle files of this query are deleted at its end."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_TIDY, "false")
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path), path


def drop_saved(spark: SparkSession, path: str) -> None:
    """Delete a table of `saved` that a later one has replaced."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def skew_lookup(
    rows: DataFrame, table: DataFrame, key: str, weight: str, total: int, how: str = "left"
) -> DataFrame:
    """Join `rows` with `table` (one row per `key`; `weight` = at least the
    number of rows with that key, of `total` in all).

    Heavy keys are joined by broadcast: at most 1 / HEAVY_SHARE of them
    exist. Only the other rows are shuffled, and no key among those holds
    more than HEAVY_SHARE of all rows. `how`: left or inner. `weight` is
    dropped."""
    floor = max(HEAVY_ROWS, total * HEAVY_SHARE)
    heavy = F.broadcast(table.where(F.col(weight) >= floor).drop(weight).withColumn("_heavy", F.lit(True)))
    light = table.where(F.col(weight) < floor).drop(weight)
    marked = rows.join(heavy, key, "left")
    hot = marked.where(F.col("_heavy")).drop("_heavy")
    rest = rows.join(heavy.select(key), key, "left_anti").join(light, key, how)
    return hot.unionByName(rest.select(*hot.columns))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (a, b: any ordered type): a table
    (node, root) with root = the smallest node reachable, for every node of
    an edge.

    Rounds of contraction: each node points to its smallest neighbour,
    pointers are followed to their end by doubling, and the edges between
    ends make the next, at most half as large, graph. Degrees are found by
    partial aggregation and hubs are joined through `skew_lookup`, so a
    component that holds most nodes is not one task's work."""
    found = None
    edges = save_table(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("to"))
        )
        up = both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("root"))
        up = save_table(up, "up")
        while True:
            jumped = _follow(up)
            jumped = save_table(jumped, "jump")
            moved = jumped.where("moved").limit(1).isEmpty()
            up = jumped.select("node", "root")
            if moved:
                break
        found = up if found is None else save_table(
            _through(found, up).unionByName(up.join(found, "node", "left_anti")), "found")
        ends = _ends(edges, up)
        edges = save_table(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found


def _weighed(rows: DataFrame, key: str) -> tuple[DataFrame, int]:
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return n, rows.count()


def _follow(up: DataFrame) -> DataFrame:
    """root := root of root."""
    n, total = _weighed(up, "root")
    nxt = up.select(F.col("node").alias("root"), F.col("root").alias("next")).join(n, "root")
    out = skew_lookup(up, nxt, "root", "_n", total)
    nxt_root = F.coalesce("next", "root")
    return out.select("node", nxt_root.alias("root"), (nxt_root != F.col("root")).alias("moved"))


def _through(found: DataFrame, up: DataFrame) -> DataFrame:
    n, total = _weighed(found, "root")
    nxt = up.select(F.col("node").alias("root"), F.col("root").alias("next")).join(n, "root")
    out = skew_lookup(found, nxt, "root", "_n", total)
    return out.select("node", F.coalesce("next", "root").alias("root"))


def _ends(edges: DataFrame, up: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        n, total = _weighed(edges, side)
        t = up.select(F.col("node").alias(side), F.col("root").alias("_r")).join(n, side)
        edges = skew_lookup(edges, t, side, "_n", total).select(
            *[F.coalesce("_r", side).alias(side) if c == side else c for c in ("a", "b")])
    return edges


def smallest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first `k` rows per key; each task sends at most `k` rows of a key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
