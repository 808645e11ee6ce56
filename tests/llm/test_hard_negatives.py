"""Operator 13 against brute force in Python integers."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from glint.llm import hard_negatives as H

VECTORS = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, every=50):
    rows = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v), (lab + 1) % 10 if i % 7 == 0 else lab)
            for i, v, lab in rows if i is not None and lab is not None and usable(v)]
    out = []
    for a in sorted({r[0] for r in rows if r[0] % every == 0}):
        _, e, lab = min((r for r in rows if r[0] == a), key=lambda r: (r[2], r[1]))
        scored = sorted((-sum(x * y for x, y in zip(e, v)), i, m == lab) for i, v, m in rows if i != a and len(v) == len(e))
        for p in dict.fromkeys([(i, -s) for s, i, alike in scored if alike][:5]):
            near = [(i, -s) for s, i, alike in scored if not alike and 50 * p[1] <= -100 * s <= 95 * p[1]]
            out += [(a, p[0], n + 1, i, p[1], s) for n, (i, s) in enumerate(near[:3])]
    return sorted(out)


def mine(df, every=50, **k):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = H.mine_hard_negatives(df, F.col("vec_id") % every == 0, label, **k)
    return sorted(map(tuple, out.collect()))


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((5, 16))
    near = [(i, (centre[i % 5] + 0.7 * rng.standard_normal(16)).tolist(), int(i % 3)) for i in range(1, 260)]
    ties = [(400 + i, near[9][1], i % 2) for i in range(12)] + [(500, near[0][1], 1)] * 2 + [(500, near[1][1], 0)]
    bad = [(None, near[0][1], 0), (650, None, 0), (700, [], 0), (750, near[0][1], None), (800, [None] + [1.0] * 15, 0),
           (850, [float("nan")] + [1.0] * 15, 0), (900, [float("inf")] + [1.0] * 15, 0), (950, [1.0, 2.0], 0), (951, [1.0, 2.0], 0),
           (952, [1.0, 1.0], 1), (1000, [0.0] * 16, 0)]
    return near + ties + bad


def test_equals_brute_force(spark, odd, monkeypatch):
    df = spark.createDataFrame(odd, VECTORS).withColumn("id", F.lit(1)).withColumn("vec", F.lit("x")).withColumn("part", F.lit(2))
    want = brute(odd)
    assert len(want) > 20 and mine(df) == want
    monkeypatch.setattr(H, "SHARD_ROWS", 30)  # many shards and tiles
    monkeypatch.setattr(H, "BLOCK", 11)
    monkeypatch.setattr(H, "TILE", 2)
    assert mine(df) == want


def test_query_and_sql(spark, odd, tmp):
    rows = [r for r in odd if r[1] is None or len(r[1]) in (0, 16)]  # the SQL takes one length
    spark.createDataFrame([r for r in rows if r[0] != 500], VECTORS).coalesce(1).write.parquet(f"{tmp}/embeddings.parquet")
    got = sorted(map(tuple, H.op13_hard_negatives(spark, tmp).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp}/embeddings.parquet/*.parquet'")
    assert got == sorted(con.execute(H.OP13_SQL).fetchall()) == brute([r for r in rows if r[0] != 500])


def test_empty_table(spark):
    assert mine(spark.createDataFrame([], VECTORS)) == []


def test_a_label_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 64)
    rng = np.random.default_rng(6)
    rows = [(i, rng.random(8).tolist(), 0 if i % 9 else 1) for i in range(1, 900)]
    assert mine(spark.createDataFrame(rows, VECTORS)) == brute(rows)


def test_residue_products_are_exact():
    rng = random.Random(8)
    for dim, size in ((1, 3), (64, 300), (65, 2**20), (1_000, 2**30), (64, 2**52), (130, 10**40)):
        a, b = (np.array([[float(rng.choice([size, -size, rng.randint(-size, size)])) for _ in range(dim)] for _ in range(4)]) for _ in "ab")
        exact = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
        clip = [[max(-H.TOP - 1, min(H.TOP, x)) for x in row] for row in exact]
        assert H.Candidates(b).scores(a).tolist() == clip
    top = max(H.PRIMES)
    worst = np.full((1, 64), float(top // 2), np.float32)
    assert H.product_mod(worst, worst, top)[0, 0] == 64 * (top // 2) ** 2 % top


def test_windows_of_negative_and_zero_scores(spark):
    rows = [(50, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [0.0, 2.0], 1), (4, [-0.6, 0.0], 1)]
    assert mine(spark.createDataFrame(rows, VECTORS)) == brute(rows) == [(50, 2, 1, 3, 0, 0)]
