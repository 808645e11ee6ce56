"""Hard negatives by exact integer inner products in a residue number system.

Components become integers and travel in binary blocks: shards of candidates
and tiles of anchors. Every tile meets every shard (a stated query set
against all rows, in blocks), twice:

1. the products give each anchor its positives, the best rows of its label;
2. a positive's score sets the window that its negatives must lie in, and the
   same products, made again rather than shuffled, give the best rows of other
   labels in each window.

A product is taken modulo several primes below 1,024: residues are
centred on zero, so a sum of 64 of their products stays below 2**24 and
float32 multiplies and adds it without rounding; longer vectors are summed
in pieces of 64. Chinese remaindering (mixed radix) turns the residues into
the signed score. The number of primes follows from the largest
components of the two blocks, so their product exceeds twice any score.

Each (tile, shard) task keeps its first few rows per anchor (or window); the
lists are merged in two levels. Labels play no part in the dealing, so a label
with most rows is no hot key.

Defined cases: a row whose id, label or vector is null, whose vector is empty,
or that holds a null or non-finite component (also once scaled) takes no part;
only vectors of the same length are compared; rows with the anchor's id are
the anchor's own; a repeated anchor id asks once (its first row by label and
vector), while repeated candidate rows each take a place, though a positive's
id and score make one window; ties go to the smaller id; scores beyond 64 bits saturate; further columns are ignored, an
empty table gives no rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import n_partitions, save_table, smallest_per

DEPTH = 64            # products summed in float32 at once
TILE = 1_024          # anchors in one block, about
STRIP = 256           # anchors multiplied at once
BLOCK = 8_192         # candidates in one block
SHARD_ROWS = 65_536   # candidates in one shard, about
TOP = 2**63 - 1


def _small_primes() -> list[int]:
    """The primes p, largest first, with DEPTH * (p // 2)**2 < 2**24."""
    most = 2 * int((2**24 / DEPTH) ** 0.5)
    sieve = np.ones(most, bool)
    sieve[:2] = False
    for i in range(2, int(most**0.5) + 1):
        if sieve[i]:
            sieve[i * i:: i] = False
    return [int(p) for p in np.flatnonzero(sieve)[::-1] if p > 2 and DEPTH * (p // 2) ** 2 < 2**24]


PRIMES = _small_primes()


def moduli(bound: int) -> list[int]:
    """As many primes as tell all numbers from -bound to bound apart."""
    product, out = 1, []
    for p in PRIMES:
        if product > 2 * bound:
            break
        out.append(p)
        product *= p
    if product <= 2 * bound:
        raise OverflowError("components beyond the range of the primes")
    return out


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Integers (float64) modulo p, centred on zero, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def product_mod(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, from 0 to p - 1; a, b: centred residues."""
    out = np.zeros((len(a), len(b)), np.int64)
    for k in range(0, a.shape[1], DEPTH):
        out += (a[:, k: k + DEPTH] @ b[:, k: k + DEPTH].T).astype(np.int64)
    return np.mod(out, p, out=out)


def chinese(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed numbers of least size with the residues `parts`: mixed-radix
    digits first, then their sum, in Python integers where 64 bits are too few."""
    total = 1
    for p in primes:
        total *= p
    digits: list[np.ndarray] = []
    for p, r in zip(primes, parts):
        value, weight = np.zeros_like(r), 1
        for d, q in zip(digits, primes):
            value = (value + d * weight) % p
            weight = weight * q % p
        digits.append((r - value) * pow(weight, -1, p) % p)
    kind = np.int64 if total < 2**62 else object
    out, weight = np.zeros(parts[0].shape, kind), 1
    for d, p in zip(digits, primes):
        out = out + d.astype(kind) * weight
        weight *= p
    out = np.where(out > total // 2, out - total, out)
    if kind is object:
        out = np.clip(out, -TOP - 1, TOP).astype(np.int64)
    return out


class Candidates:
    """A block of vectors with its residues, kept between strips."""

    def __init__(self, vecs: np.ndarray):
        self.vecs, self.most = vecs, int(np.abs(vecs).max(initial=0))
        self.held: dict[int, np.ndarray] = {}

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        bound = anchors.shape[1] * int(np.abs(anchors).max(initial=0)) * self.most
        primes = moduli(bound)
        parts = []
        for p in primes:
            if p not in self.held:
                self.held[p] = residues(self.vecs, p)
            parts.append(product_mod(residues(anchors, p), self.held[p], p))
        return chinese(parts, primes)


def _first(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places `at` the first k by score (high first) and id."""
    if len(at) > k:
        cut = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= cut]
    return at[np.lexsort((ids[at], -np.maximum(scores[at], -TOP)))][:k]


# --- blocks ---------------------------------------------------------------

_BLOB = "part int, dim int, ids binary, labels binary, vecs binary"


def _blocks(size: int, windows: bool = False):
    """Rows (part, id, label, scaled vector[, windows]) of a partition sorted
    by part -> blocks of at most `size` integer vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def flush(key):
            ids, labels, vecs, asked = zip(*held.pop(key))
            out = {
                "part": pa.array([key[0]], pa.int32()), "dim": pa.array([key[1]], pa.int32()),
                "ids": [np.array(ids, np.int64).tobytes()], "labels": [np.array(labels, np.int64).tobytes()],
                "vecs": [np.array(vecs, np.float64).tobytes()]}
            if windows:
                out["windows"] = pa.array([list(asked)], _WINDOWS)
            return pa.RecordBatch.from_pydict({
                k: v if isinstance(v, pa.Array) else pa.array(v, pa.binary()) for k, v in out.items()})

        for b in batches:
            asked = b.column(4).to_pylist() if windows else [None] * b.num_rows
            for part, i, lab, v, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), asked):
                x = np.floor(np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64))
                rows = held.setdefault((part, len(x)), [])
                rows.append((i, lab, x, w))
                if len(rows) >= size:
                    yield flush((part, len(x)))
            for key in [k for k in held if k[0] != part]:
                yield flush(key)
        for key in list(held):
            yield flush(key)

    return pack


_WINDOW = "struct<positive_id:bigint,score:bigint,low:bigint,high:bigint>"
_WINDOWS = pa.list_(pa.list_(pa.struct([(n, pa.int64()) for n in ("positive_id", "score", "low", "high")])))


def _products(select: Callable, width: int, names: list[str]):
    """Blocks of (anchors, candidates) -> the rows that `select` picks for
    each anchor: (part, *names)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, dim, ai, al, av, ci, cl, cv, *more in zip(*(c.to_pylist() for c in b.columns)):
                ai, al, ci, cl = (np.frombuffer(x, np.int64) for x in (ai, al, ci, cl))
                anchors, block = np.frombuffer(av).reshape(-1, dim), Candidates(np.frombuffer(cv).reshape(-1, dim))
                out: list[list[np.ndarray]] = []
                for at in range(0, len(ai), STRIP):
                    scores = block.scores(anchors[at: at + STRIP])
                    for r, s in enumerate(scores, at):
                        out += select(ai[r], al[r], s, ci, cl, more[0][r] if more else None)
                cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * width
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cols[0]), part, np.int32)), *(pa.array(c.astype(np.int64)) for c in cols)],
                    ["part", *names])

    return run


def _positives(k: int):
    def select(anchor, label, s, ids, labels, _):
        at = _first(s, ids, np.flatnonzero((labels == label) & (ids != anchor)), k)
        return [[np.full(len(at), anchor), ids[at], s[at]]]

    return select


def _negatives(k: int):
    def select(anchor, label, s, ids, labels, windows):
        other = np.flatnonzero((labels != label) & (ids != anchor))
        mine, out = s[other], []
        for w in windows:
            at = _first(s, ids, other[(mine >= w["low"]) & (mine <= w["high"])], k)
            n = len(at)
            out.append([np.full(n, anchor), np.full(n, w["positive_id"]), np.full(n, w["score"]), ids[at], s[at]])
        return out

    return select


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3,
    low: int = 50, high: int = 95, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """For each anchor and each of its `positives` best rows of the same
    label, the `negatives` best rows of other labels whose score is at least
    `low` and at most `high` percent of the positive's: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score. `label`:
    whole numbers."""
    spark = vectors.sparkSession
    n_parts = n_partitions(spark)
    whole = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    bad = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).alias("ask"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & ~bad)
    n, n_anchors = good.agg(F.count("*"), F.count(F.when(F.col("ask"), 1))).first()
    shards = max(1, -(-n // SHARD_ROWS), min(n_parts, -(-n // BLOCK)))
    tiles = max(1, -(-n_anchors // TILE))

    def dealt(rows: DataFrame, parts: int, *more: str) -> DataFrame:
        """Rows spread evenly over `parts` by a hash of the whole row."""
        part = F.pmod(F.xxhash64(F.lit(7), "id", "label", "vec"), F.lit(parts)).cast("int")
        rows = rows.select(part.alias("part"), "id", "label", "vec", *more)
        return rows.repartition(n_parts, "part").sortWithinPartitions("part")

    cand = save_table(dealt(good, shards).mapInArrow(_blocks(BLOCK), _BLOB), "candidates")
    anchors = smallest_per(good.where("ask"), ["id"], [F.col("label"), F.col("vec")], 1).drop("_rank")
    fan = max(1, int(shards**0.5))
    order = [F.col("score").desc(), F.col("other").asc()]

    def best(tile: DataFrame, select: Callable, names: list[str], keys: list[str], k: int) -> DataFrame:
        """Every tile against every shard, merged in two levels."""
        extra = ["windows"] if "windows" in tile.columns else []
        asks = tile.select(
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("part"), "dim",
            F.col("ids").alias("aids"), F.col("labels").alias("alabels"), F.col("vecs").alias("avecs"), *extra)
        pairs = asks.join(cand.hint("shuffle_hash"), ["part", "dim"]).select(
            "part", "dim", "aids", "alabels", "avecs", "ids", "labels", "vecs", *extra)
        rows = pairs.mapInArrow(
            _products(select, len(names), names), "part int, " + ", ".join(f"{c} long" for c in names))
        near = smallest_per(rows.withColumn("part", (F.col("part") / fan).cast("int")), [*keys, "part"], order, k)
        return smallest_per(near.drop("_rank", "part"), keys, order, k)

    tile = dealt(anchors, tiles).mapInArrow(_blocks(2 * TILE), _BLOB)
    found = best(tile, _positives(positives), ["anchor", "other", "score"], ["anchor"], positives)
    # whole bounds of low * s <= 100 * x <= high * s, in decimals: no overflow
    s = F.col("score").cast("decimal(20,0)")
    bound = lambda c: F.greatest(F.lit(-TOP - 1), F.least(F.lit(TOP), c)).cast("long")
    window = F.struct(
        F.col("other").alias("positive_id"), "score",
        bound(F.ceil(s * low / 100)).alias("low"), bound(F.floor(s * high / 100)).alias("high"))
    asked = found.groupBy(F.col("anchor").alias("id")).agg(F.collect_set(window).alias("windows"))
    tile = dealt(anchors.join(asked, "id"), tiles, "windows").mapInArrow(
        _blocks(2 * TILE, windows=True), f"{_BLOB}, windows array<array<{_WINDOW}>>")
    out = best(
        tile, _negatives(negatives), ["anchor", "positive", "positive_score", "other", "score"],
        ["anchor", "positive", "positive_score"], negatives)
    return out.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("_rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark, sf_dir) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows, F.col("vec_id") % 50 == 0, label)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id AND len(a.e) = len(c.e)
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), w AS (
  SELECT DISTINCT * FROM p
), n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id, positive_score ORDER BY score DESC, vec_id) AS rank
  FROM w JOIN s USING (anchor_id)
  WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
