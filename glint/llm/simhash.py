"""SimHash near-dedup by Golay-code fuzzy hashing.

A fingerprint has 64 bits, cut into segments of 22, 21 and 21 bits. The
binary Golay code (23, 12) puts every 23-bit word within 3 bits of exactly
one codeword. If two fingerprints differ in at most 3 bits, at most one
segment holds two or more of them, so some pair of segments (x, y) differs
by at most one bit in each (pigeonhole). Flipping one bit of a segment, or
none, reaches 1 or 6 codewords: these are its fuzzy keys, and the codeword of
the other fingerprint's segment is always among them. So for each pair of
segments a fingerprint gets the keys (fuzzy x, exact y) and (exact x, fuzzy
y), and two linked fingerprints share at least one key. Rows with the same
key meet, the bit distance verifies them.

Only distinct fingerprints are compared: copies are counted, never paired.
Within a key only a spanning forest of the links leaves the task, so a
large group of near copies costs output in proportion to its rows; a key
with a heavy share of the rows is dealt out in blocks, every two blocks
meeting in one task.

Defined cases: a null or empty text, or one of white space only, has
fingerprint zero; fewer words than a shingle make one shingle; repeated rows
share a fingerprint and so a component; a row with a null id is linked like
any other, and the smallest non-null id names the component (null if none)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HEAVY_ROWS, components, n_partitions, save_table, skew_lookup, small_batches

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (shift, bits)
KEY_BLOCK = 4_096   # rows of one key that meet at once
#: Keys above this share of all rows are dealt out in blocks; at most its
#: inverse can exist, so their list is bounded and broadcast.
KEY_SHARE = 1 / 20_000


# --- fingerprints ---------------------------------------------------------

def fingerprint(text: bytes | None, size: int, seed: int) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    total, n, digest = np.zeros(64, np.int64), len(words) - size + 1, xxhash.xxh64_intdigest
    starts = np.concatenate(([0], ends[: n - 1]))
    stops = ends[size - 1:] - 1
    for at in range(0, n, 65_536):
        part = slice(at, at + 65_536)
        h = np.fromiter(
            (digest(line[a:b], seed) for a, b in zip(starts[part].tolist(), stops[part].tolist())),
            np.uint64, min(n, at + 65_536) - at)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(size: int, seed: int):
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = np.array([fingerprint(t.as_py(), size, seed) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], ["id", "md5", "fp"])

    return batches


# --- Golay keys -----------------------------------------------------------

@cache
def golay_nearest() -> np.ndarray:
    """For every 23-bit word the index of its codeword (within 3 bits)."""
    generator = 0b101011100011  # x^11+x^9+x^7+x^6+x^5+x+1, reflected
    codewords = np.zeros(4096, np.int64)
    for bit in range(12):
        codewords ^= np.where(np.arange(4096) >> bit & 1, generator << bit, 0)
    ones = 1 << np.arange(23)
    two = (ones[:, None] | ones[None, :])[np.triu_indices(23, 1)]
    three = np.unique((two[:, None] | ones[None, :]).ravel())
    errors = np.concatenate(([0], ones, two, three[np.bitwise_count(three) == 3]))
    nearest = np.zeros(1 << 23, np.uint16)
    for e in errors:
        nearest[codewords ^ e] = np.arange(4096)
    return nearest


def fuzzy(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index) for all distinct codewords near each word or
    near it with one bit flipped."""
    flips = np.concatenate(([0], 1 << np.arange(23)))
    near = np.sort(golay_nearest()[words[:, None] ^ flips], axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    row, col = np.nonzero(new)
    return row, near[row, col].astype(np.int64)


def keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): all join keys of each fingerprint."""
    u = fp.view(np.uint64)
    seg = [((u >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    exact = [golay_nearest()[x].astype(np.int64) for x in seg]
    rows, out = [], []
    spread = [fuzzy(x) for x in seg]
    for pair, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
        for row, key in (
            (spread[x][0], spread[x][1] << 12 | exact[y][spread[x][0]]),
            (spread[y][0], exact[x][spread[y][0]] << 12 | spread[y][1]),
        ):
            rows.append(row)
            out.append(key | pair << 24)
    both = np.unique(np.stack([np.concatenate(rows), np.concatenate(out)]), axis=1)
    return both[0], both[1]


def _keyed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        fp = b.column(0).to_numpy()
        for at in range(0, len(fp), 8_192):
            row, key = keys(fp[at: at + 8_192])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(fp[at: at + 8_192][row], pa.int64())], ["key", "fp"])


# --- links within a key ---------------------------------------------------

def forest(fp: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of the links among distinct `fp`: each
    found fingerprint is compared with those not yet reached."""
    left, edges = fp.view(np.uint64), []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            some, front = front[:256], front[256:]
            near = np.bitwise_count(some[:, None] ^ left[None, :]) <= bits
            hit = near.any(0)
            if hit.any():
                edges.append((some[near[:, hit].argmax(0)], left[hit]))
                front, left = np.concatenate((front, left[hit])), left[~hit]
    return edges


def _links(bits: int):
    def run_links(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def solve(k, f):
            a, b = [], []
            cuts = np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)])) if len(k) else np.zeros(1, int)
            size = np.diff(cuts)
            long = np.repeat(size > 16, size)
            u = f.view(np.uint64)
            for d in range(1, int(min(16, size.max(initial=1)))):
                ok = (k[d:] == k[:-d]) & ~long[d:] & (np.bitwise_count(u[d:] ^ u[:-d]) <= bits)
                a.append(u[:-d][ok])
                b.append(u[d:][ok])
            for i in np.flatnonzero(size > 16):
                for x, y in forest(np.unique(f[cuts[i]: cuts[i + 1]]), bits):
                    a.append(x)
                    b.append(y)
            a = np.concatenate(a) if a else np.zeros(0, np.uint64)
            b = np.concatenate(b) if b else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64), pa.int64()), pa.array(b.view(np.int64), pa.int64())], ["a", "b"])

        for batch in it:
            k = np.concatenate((held_k, batch.column(0).to_numpy()))
            f = np.concatenate((held_f, batch.column(1).to_numpy()))
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))  # the last key may go on
            if cut:
                yield solve(k[:cut], f[:cut])
            held_k, held_f = k[cut:], f[cut:]
        yield solve(held_k, held_f)

    return run_links


def link_fingerprints(fps: DataFrame, bits: int = 3) -> DataFrame:
    """Links among the distinct values of `fps` (fp long) that differ in at
    most `bits` <= 3 bits: edges (a, b) with the same components."""
    if bits > 3:
        raise ValueError("the keys hold for at most 3 differing bits")
    n = n_partitions(fps.sparkSession)
    keyed = save_table(fps.select("fp").mapInArrow(_keyed, "key long, fp long"), "keys")
    total = keyed.count()
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    heavy = F.broadcast(
        counts.where(F.col("n") >= max(KEY_BLOCK, total * KEY_SHARE))
        .select("key", F.ceil(F.col("n") / (KEY_BLOCK // 2)).cast("int").alias("blocks")))
    plain = keyed.join(heavy, "key", "left_anti").select(F.col("key").alias("k"), "fp")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    hot = (
        keyed.join(heavy, "key")
        .withColumn("x", block)
        .select("key", "fp", "x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("y"))
        .select(F.xxhash64("key", F.least("x", "y"), F.greatest("x", "y")).alias("k"), "fp")
    )
    out = None
    for part in (plain, hot):
        links = part.repartition(n, "k").sortWithinPartitions("k").mapInArrow(_links(bits), "a long, b long")
        out = links if out is None else out.unionByName(links)
    return out


def simhash_dedup(
    docs: DataFrame, shingle: int = 3, bits: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id (the id column), md5 (of the text, as
    `text_key`), fp (the fingerprint as a signed long), component_id, and
    `leader_fp` (the smallest fingerprint of the component)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("md5"), F.col(text_col).cast("binary").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, md5 binary, fp long"
    prints = save_table(rows.mapInArrow(_fingerprints(shingle, seed), schema), "prints")
    each = save_table(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
    groups = components(link_fingerprints(each, bits))
    total = prints.count()
    joined = each.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # the smallest id of a component, by partial aggregation and a join that
    # doesn't put a large component into one task
    per = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.min("fp").alias("leader_fp"), F.count(F.lit(1)).alias("m"))
    named = save_table(
        skew_lookup(joined, per, "root", "m", total, "inner").select("fp", "component_id", "leader_fp", "n"), "named")
    return skew_lookup(prints, named, "fp", "n", total, "inner").select("id", "md5", "fp", "component_id", "leader_fp")


def text_key(text_col: str):
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of `docs` with one row of each component: the one with the
    smallest id (among several with that id, the smallest md5)."""
    found = simhash_dedup(docs, id_col=id_col, text_col=text_col, **kw)
    best = found.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("id", "leader_fp").agg(
        F.min("md5").alias("best"))
    b = best.select(F.col("id").alias("_id"), F.col("best").alias("_best")).distinct()
    own = docs.columns
    marked = docs.withColumn("_md5", text_key(text_col))
    kept = marked.join(b, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_md5") == F.col("_best")), "left_semi")
    return kept.dropDuplicates([id_col, "_md5"]).select(*own)


def op10_simhash(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = simhash_dedup(docs, shingle=3, bits=3, seed=42)
    return out.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
