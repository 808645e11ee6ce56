"""Exact top-k search by inner product over integer vectors.

Vectors are turned into integers in the tasks and packed into blocks: each
shard of candidates is a few binary blocks, each tile of queries one block.
Query tiles are sent to every shard (a stated query set against all rows, in
blocks), one matrix product per (tile, block) gives the scores, each product
keeps its k best per query, and the lists are merged in two levels.

Scores are exact: products run in float64 while the largest possible sum
stays below 2**53 and in Python integers beyond.

Defined cases: vectors that are null, empty, or hold null or non-finite
components take no part; only vectors of the same length are compared; a row
whose id equals the query's is the query's own; a repeated query id asks
once (its first row by vector), while repeated candidate rows each take a
place; rows with a null id take no part; scores beyond 64 bits saturate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import n_partitions, smallest_per

TILE = 2_048          # queries in one block
BLOCK = 16_384        # candidates in one block
SHARD_ROWS = 65_536   # candidates in one shard, about
_BLOB = "part int, dim int, ids binary, vecs binary"


def _blocks(size: int, scale: float):
    """Rows (part, vec_id, embedding) of a partition sorted by part ->
    blocks of at most `size` integer vectors of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list, list]] = {}

        def flush(key):
            ids, vecs = held.pop(key)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([key[0]], pa.int32()), "dim": pa.array([key[1]], pa.int32()),
                "ids": pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                "vecs": pa.array([np.array(vecs, np.float64).tobytes()], pa.binary())})

        for b in batches:
            for part, i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                x = np.floor(scale * np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64))
                key = (part, len(x))
                ids, vecs = held.setdefault(key, ([], []))
                ids.append(i)
                vecs.append(x)
                if len(ids) >= size:
                    yield flush(key)
            for key in [k for k in held if k[0] != part]:
                yield flush(key)
        for key in list(held):
            yield flush(key)

    return pack


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    if np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1] < 2.0**53:
        return (q @ c.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in q], object) @ np.array([[int(x) for x in row] for row in c], object).T
    top = 2**63 - 1
    return np.array([[max(-top - 1, min(top, x)) for x in row] for row in exact], np.int64)


def _best(k: int):
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, dim, qi, qv, ci, cv in zip(*(b.column(i).to_pylist() for i in range(6))):
                qi, ci = np.frombuffer(qi, np.int64), np.frombuffer(ci, np.int64)
                s = _scores(np.frombuffer(qv).reshape(-1, dim), np.frombuffer(cv).reshape(-1, dim))
                own = qi[:, None] == ci[None, :]
                n = min(k, len(ci))
                rows = ([], [], [])
                for r in range(len(qi)):
                    ok = np.flatnonzero(~own[r])
                    if len(ok) > n:  # all that reach the k-th score, then ties by id
                        cut = np.partition(s[r][ok], len(ok) - n)[len(ok) - n]
                        ok = ok[s[r][ok] >= cut]
                    ok = ok[np.lexsort((ci[ok], -s[r][ok].astype(object) if s[r].min() == -2**63 else -s[r][ok]))][:n]
                    rows[0].append(np.full(len(ok), qi[r]))
                    rows[1].append(ci[ok])
                    rows[2].append(s[r][ok])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * sum(map(len, rows[0])), pa.int32()),
                     *(pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in rows)],
                    ["part", "query_id", "vec_id", "score"])

    return best


def topk_search(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """For each query row the `k` candidates of the highest integer inner
    product: query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("embedding"), is_query.alias("ask")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad)
    n = good.count()
    shards = max(1, -(-n // SHARD_ROWS), min(n_partitions(spark), -(-n // BLOCK)))
    # candidates: spread evenly by a hash of the whole row
    cand = good.select(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int").alias("part"), "vec_id", "embedding")
    cand = cand.repartition(n_partitions(spark), "part").sortWithinPartitions("part").mapInArrow(_blocks(BLOCK, scale), _BLOB)
    asked = smallest_per(good.where("ask"), ["vec_id"], [F.col("embedding")], 1)
    tiles = max(1, -(-asked.count() // TILE))
    asked = asked.select(F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.lit(tiles)).cast("int").alias("part"), "vec_id", "embedding")
    asked = asked.repartition(n_partitions(spark), "part").sortWithinPartitions("part").mapInArrow(_blocks(2 * TILE, scale), _BLOB)
    tile = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("part"), "dim",
        F.col("ids").alias("qids"), F.col("vecs").alias("qvecs"))
    pairs = tile.join(cand.hint("shuffle_hash"), ["part", "dim"]).select("part", "dim", "qids", "qvecs", "ids", "vecs")
    lists = pairs.mapInArrow(_best(k), "part int, query_id long, vec_id long, score long")
    order = [F.col("score").desc(), F.col("vec_id").asc()]
    fan = max(1, int(shards**0.5))
    near = smallest_per(lists.withColumn("part", (F.col("part") / fan).cast("int")), ["query_id", "part"], order, k)
    top = smallest_per(near.drop("_rank"), ["query_id"], order, k)
    return top.select("query_id", F.col("_rank").cast("int").alias("rank"), "vec_id", "score")


def op7_topk(spark, sf_dir) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk_search(rows, F.col("vec_id") % 50 == 0, k=5, scale=256.0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
