"""Row numbering that does not put a whole group into one task.

`row_number() OVER (PARTITION BY key ORDER BY o)` sends every row of a key
to one task. When one key may hold a large share of the data, the rows are
numbered in two levels instead: a coarse `bucket` (monotone in the order,
e.g. a time slice or a file block) splits the key; each (key, bucket) is
numbered by a window, and the bucket's start offset comes from a running
sum over the per-bucket counts, a table of one row per bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    bucket: Column | None = None,
    name: str = "index",
) -> DataFrame:
    """Add a 0-based position of each row within its key, in `order`.

    `order` must be a total order within the key for the result to be
    deterministic. With `bucket` (a column that never decreases along
    `order`) the numbering is split as described in the module doc."""
    keys = list(keys)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w) - 1)
    b = "_bucket"
    staged = df.withColumn(b, bucket)
    counts = staged.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, b, F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy(*keys, b).orderBy(*order)
    local = staged.withColumn("_local", F.row_number().over(w_in) - 1)
    # Null-safe keys: a row whose key is null is numbered, not dropped.
    o = offsets.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(b).alias("_kb"), "_off"
    )
    cond = [local[k].eqNullSafe(o[f"_k{i}"]) for i, k in enumerate(keys)]
    cond.append(local[b].eqNullSafe(o["_kb"]))
    out = local.join(o, cond, "inner")
    out = out.withColumn(name, F.col("_off") + F.col("_local"))
    return out.drop(b, "_local", "_off", "_kb", *[f"_k{i}" for i in range(len(keys))])


def prefixes(
    df: DataFrame,
    keys: Sequence[str],
    index: str,
    wanted: dict[str, tuple[str, str]],
    bucket_size: int = 4096,
) -> DataFrame:
    """Add running values over the rows with a smaller `index` within the
    key (exclusive): `wanted` maps a new name to (kind, column), kind one of
    `sum` (0 at first), `max` and `last` (of the non-null values, null if
    there is none).

    All are computed together in buckets of `bucket_size` consecutive
    indexes, one row per bucket carrying what came before it, so that no key
    is handled by a single task."""
    keys = list(keys)
    staged = df.withColumn("_k", F.floor(F.col(index) / bucket_size).cast("bigint"))
    names = list(wanted)
    whole = {
        "sum": lambda v: F.sum(v),
        "max": lambda v: F.max(v),
        "last": lambda v: F.max_by(v, F.when(F.col(v).isNotNull(), F.col(index))),
    }
    running = {
        "sum": lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0)),
        "max": lambda c, w: F.max(c).over(w),
        "last": lambda c, w: F.last(c, ignorenulls=True).over(w),
    }
    join = {
        "sum": lambda a, b: a + b,
        "max": lambda a, b: F.greatest(a, b),
        "last": lambda a, b: F.coalesce(b, a),
    }
    per = staged.groupBy(*keys, "_k").agg(*[whole[k](v).alias(f"_o{i}") for i, (k, v) in enumerate(wanted.values())])
    before = Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    outer = per.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], F.col("_k").alias("_ko"), *[
        running[k](f"_o{i}", before).alias(f"_o{i}") for i, (k, _) in enumerate(wanted.values())])
    inner = Window.partitionBy(*keys, "_k").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    inside = staged.select("*", *[running[k](v, inner).alias(f"_i{i}") for i, (k, v) in enumerate(wanted.values())])
    # null-safe: a row whose key is null has its prefix, too
    same = [inside[k].eqNullSafe(outer[f"_g{i}"]) for i, k in enumerate(keys)]
    out = inside.join(outer, [*same, inside["_k"].eqNullSafe(outer["_ko"])], "inner")
    for i, name in enumerate(names):
        out = out.withColumn(name, join[wanted[name][0]](F.col(f"_o{i}"), F.col(f"_i{i}")))
    return out.drop("_k", "_ko", *[f"_g{i}" for i in range(len(keys))], *[f"_{s}{i}" for i in range(len(names)) for s in "io"])


def prefix_last(df: DataFrame, keys: Sequence[str], index: str, value: str, name: str, bucket_size: int = 4096) -> DataFrame:
    """The last non-null `value` at a smaller `index` (`prefixes`)."""
    return prefixes(df, keys, index, {name: ("last", value)}, bucket_size)


def prefix_sum(df: DataFrame, keys: Sequence[str], index: str, value: str, name: str, bucket_size: int = 4096) -> DataFrame:
    """The sum of `value` at smaller indexes (`prefixes`)."""
    return prefixes(df, keys, index, {name: ("sum", value)}, bucket_size)
