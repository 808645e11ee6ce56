"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are aggregated by membership pattern (the set of sources that a
document belongs to). The flow network has one node per pattern and one per
source: pattern -> source arcs carry a pattern's words into the quota of a
source it belongs to, and each pattern's supply is a set of parallel arcs,
one per repetition, whose cost grows (convex), so no words are repeated
while fresh ones can fill a quota. The flow is solved by successive cheapest
augmentation over that small graph on the driver; documents are then chosen
within each (pattern, source) share in the order of a seeded hash.

What reaches the driver is one row per pattern, not per document: with
sources as labels of the corpus there are few. Beyond `max_patterns` the
operator raises an error rather than drop anything.

The choice needs no global sort: documents are hashed into `BUCKETS` buckets
per pattern; whole buckets below the cut are taken, only the one bucket that
holds the cut is ranked, so no task gets a whole source, and one document
whose size fits best fills what is still missing. The cuts are one row per
pattern; applying them is a map over the documents.

Defined cases: a null text has size 0; a document without words takes none;
a null source is a source of its own, the last; with an empty input the
result is empty; repeated rows are separate documents."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, save_table, skew_lookup

BUCKETS = 4_096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: dict, total: int, most: float = 3.0) -> dict:
    """Shares of `total` by weight; none above `most` times its size: the
    excess is shared again by weight among the others."""
    total, out, open_ = Fraction(total), {}, set(sizes)
    while open_:
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if w and total * weights[s] / w > Fraction(most) * sizes[s]}
        if not over:
            out |= {s: total * weights[s] / w if w else Fraction(0) for s in open_}
            break
        for s in over:
            out[s] = Fraction(most) * sizes[s]
        total -= sum(out[s] for s in over)
        open_ -= over
    return out


def flow(supply: dict[frozenset, int], quota: dict, repeats: int) -> dict:
    """Words carried from each pattern to each of its sources, at least cost
    when the r-th repetition of a pattern's words costs r - 1 a word.
    Successive augmentation: tier by tier (cost 0, 1, ...) the quotas are
    filled by augmenting paths, which may reroute what an earlier tier sent."""
    sent: dict = {}
    need = dict(quota)
    used = dict.fromkeys(supply, Fraction(0))
    for tier in range(1, repeats + 1):
        while True:
            # breadth-first search from patterns with words left in this tier
            room = {p: Fraction(supply[p]) * tier - used[p] for p in supply}
            back: dict = {p: None for p in supply if room[p] > 0}
            todo, goal, reached = list(back), None, False  # a source may be null
            while todo and not reached:
                nxt = []
                for p in todo:
                    for s in sorted(p, key=repr):
                        if ("s", s) in back:
                            continue
                        back["s", s] = p
                        if need.get(s, 0) > 0:
                            goal, reached = s, True
                            break
                        for q in supply:  # reroute what q sends to s
                            if q not in back and sent.get((q, s), 0) > 0:
                                back[q] = s
                                nxt.append(q)
                    if reached:
                        break
                todo = nxt
            if not reached:
                break
            path, s = [], goal
            while True:
                p = back["s", s]
                path.append((p, s))
                if back[p] is None:
                    break
                s = back[p]
            root = path[-1][0]
            amount = min([room[root], need[goal]] + [sent[path[i][0], path[i + 1][1]] for i in range(len(path) - 1)])
            for i, (p, s) in enumerate(path):
                sent[p, s] = sent.get((p, s), Fraction(0)) + amount
                if i + 1 < len(path):
                    sent[p, path[i + 1][1]] -= amount
            used[root] += amount
            need[goal] -= amount
    return {k: v for k, v in sent.items() if v > 0}


def mix_sources(
    docs: DataFrame, members: Column, weight, id_col: str = "doc_id", text_col: str = "text",
    repeats: int = 3, seed: int = 42, max_patterns: int = 100_000,
) -> DataFrame:
    """Return the rows of `docs` with `_size`, `_source` (the source that the
    document's pattern mostly serves), `_source_size`, `_target` and
    `_copies` (how often the mix takes the document, 0 to `repeats`).

    `members`: array of the sources a document belongs to (null elements
    allowed); `weight(sorted sources) -> {source: weight}`."""
    spark = docs.sparkSession
    own = docs.columns
    u = F.xxhash64(F.lit(seed), F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    m = docs.withColumn("_size", word_count(F.col(text_col))).withColumn("_u", u)
    m = m.withColumn("_pattern", F.array_sort(F.array_distinct(members)))
    m = m.withColumn("_pkey", F.to_json(F.struct(F.col("_pattern").alias("p")), {"ignoreNullFields": "false"}))
    m = m.withColumn("_bucket", F.pmod("_u", F.lit(BUCKETS)).cast("int"))
    each = save_table(m.select("_pkey", "_pattern", "_bucket", "_u", "_size"), "sizes")
    stats = each.groupBy("_pkey", "_bucket").agg(
        F.sum("_size").alias("words"), F.count(F.lit(1)).alias("n"), F.first("_pattern").alias("p"))
    groups = stats.groupBy("_pkey").agg(F.sum("words").alias("words"), F.sum("n").alias("n"), F.first("p").alias("p"))
    found = groups.limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    supply = {frozenset(r.p): r.words for r in found}
    names = sorted({s for p in supply for s in p}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(w for p, w in supply.items() if s in p) for s in names}
    goal = targets(sizes, weight(names), sum(supply.values()), repeats)
    sent = flow(supply, goal, repeats)
    plan = []
    for r in found:
        p = frozenset(r.p)
        first = max(p, key=lambda s: (sent.get((p, s), 0), repr(s)), default=None)
        words = sum((sent.get((p, s), Fraction(0)) for s in p), Fraction(0))
        whole, rest = (int(words // r.words), int(round(words % r.words))) if r.words else (0, 0)
        plan.append((r._pkey, first, int(sizes.get(first, 0)), float(goal.get(first, 0)), whole, rest, int(r.n)))
    schema = "_pkey string, _source string, _source_size long, _target double, _whole int, _rest long, _n long"
    plan = spark.createDataFrame(plan, schema)
    m = skew_lookup(m, _cuts(each, stats, plan), "_pkey", "_n", sum(r.n for r in found), "inner")
    more = (
        (F.col("_bucket") < F.coalesce("_cut", F.when(F.col("_rest") > 0, F.lit(BUCKETS)).otherwise(F.lit(0))))
        | F.coalesce((F.col("_bucket") == F.col("_cut")) & (F.col("_u") <= F.col("_last")), F.lit(False))
        | F.coalesce(F.col("_u") == F.col("_fill"), F.lit(False))
    )
    copies = F.when(F.col("_size") > 0, F.col("_whole") + more.cast("int")).otherwise(0)
    return m.select(*own, "_size", "_source", "_source_size", "_target", copies.alias("_copies"))


def _cuts(each: DataFrame, stats: DataFrame, plan: DataFrame) -> DataFrame:
    """`plan` with, per pattern, the bucket `_cut` in which the words reach
    `_rest`, the hash `_last` of the last document before that (in the order
    of hashes within the bucket), and the hash `_fill` of the document
    outside whose size fits best what is then still missing."""
    w = Window.partitionBy("_pkey").orderBy("_bucket")
    cut = (
        stats.withColumn("_before", F.sum("words").over(w) - F.col("words"))
        .join(plan.select("_pkey", "_rest"), "_pkey")
        .where((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("words") > F.col("_rest")))
        .groupBy("_pkey", "_rest").agg(F.min("_bucket").alias("_cut"), F.min_by("_before", "_bucket").alias("_before"))
    )
    # one bucket per pattern is ranked: 1 / BUCKETS of its documents
    edge = each.select("_pkey", F.col("_bucket").alias("_cut"), "_u", "_size").join(F.broadcast(cut), ["_pkey", "_cut"])
    at = Window.partitionBy("_pkey").orderBy("_u")
    edge = edge.withColumn("_upto", F.col("_before") + F.sum("_size").over(at))
    last = edge.groupBy("_pkey").agg(
        F.max(F.when(F.col("_upto") <= F.col("_rest"), F.col("_u"))).alias("_last"),
        F.max(F.when(F.col("_upto") <= F.col("_rest"), F.col("_upto"))).alias("_upto"))
    cut = cut.join(last, "_pkey", "left").select(
        "_pkey", "_cut", "_last", (F.col("_rest") - F.coalesce("_upto", "_before")).alias("_gap"))
    out = each.where("_size > 0").join(F.broadcast(cut), "_pkey").where(
        ~((F.col("_bucket") < F.col("_cut")) | ((F.col("_bucket") == F.col("_cut")) & F.coalesce(F.col("_u") <= F.col("_last"), F.lit(False)))))
    off = F.abs(F.col("_size") - F.col("_gap"))
    fill = out.where(off < F.col("_gap")).groupBy("_pkey").agg(F.min_by("_u", F.struct(off, "_u")).alias("_fill"))
    return plan.join(cut.drop("_gap"), "_pkey", "left").join(fill, "_pkey", "left")


def by_turns(names: list) -> dict:
    """Weights 1, 2, 3, repeating, in the given order."""
    return {s: 1 + i % 3 for i, s in enumerate(names)}


def op1_mixing(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = mix_sources(docs, F.array("source"), by_turns)
    return out.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))
