from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import DOCS, odd_docs, prose
from test_documents import brute_groups, brute_lines, brute_print

import corpus_pipeline as P
from glint.llm import packing

WORDS_FR = "île forêt château garçon été père mère leçon".split()


@pytest.fixture(scope="module")
def corpus(spark):
    rows = odd_docs()
    rows += [(1000 + i, prose(i, 20 + i), "en", "abcd"[i % 4], 1) for i in range(40)]
    rows += [(2000 + i, prose(i, 25, WORDS_FR), "fr", None, 1) for i in range(20)]
    rows += [(3000 + i, prose(0, 200) + f"\n{prose(i, 3)}", "en", "a", 1) for i in range(4)]
    return rows


def ascii_space(text):
    return len(text.encode().split())


def test_every_stage_against_brute_force(spark, corpus):
    docs = spark.createDataFrame(corpus, DOCS)
    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "line_dedup", "simhash_dedup", "mixing", "packing"]
    # 1: texts without a letter go
    out = P.language_id(spark, docs, "")
    assert out.columns == docs.columns
    kept = [r for r in corpus if r[1] and any(c.isalpha() for c in r[1])]
    assert Counter(map(tuple, out.collect())) == Counter(kept)
    # 2: shared lines go
    out = P.drop_shared_lines(spark, out, "")
    want = []
    for r, (_, _, n, text) in zip(kept, brute_lines(kept, 10)):
        want.append((r[0], text, r[2], r[3], len(text)))
    assert out.columns == docs.columns
    assert Counter(map(tuple, out.collect())) == Counter(want)
    # 3: one of each group of near copies
    out = P.drop_near_copies(spark, spark.createDataFrame(want, DOCS), "")
    root = brute_groups([brute_print(r[1]) for r in want])
    least = defaultdict(list)
    for r, k in zip(want, root):
        least[k].append(r)
    got = out.collect()
    assert len(got) == len(least)
    first = {k: min((r[0] for r in v if r[0] is not None), default=None) for k, v in least.items()}
    assert Counter(r.doc_id for r in got) == Counter(first.values())
    # 4: whole documents, taken zero to three times, near the targets
    rows = [tuple(r) for r in got]
    out = P.mix(spark, spark.createDataFrame(rows, DOCS), "")
    taken = Counter(map(tuple, out.collect()))
    assert set(taken) <= set(rows) and max(taken.values()) <= 3
    from glint.llm.mixing import by_turns, targets

    sizes = Counter()
    for r in rows:
        sizes[r[3]] += ascii_space(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = targets(sizes, by_turns(order), sum(sizes.values()))
    for s in order:
        words = sum(ascii_space(r[1]) * n for r, n in taken.items() if r[3] == s)
        most = max(ascii_space(r[1]) for r in rows if r[3] == s)
        assert abs(words - goal[s]) <= most
    # 5: every token of every copy, once
    pytest.importorskip("public_tokenizers")
    mixed = list(taken.elements())
    out = P.pack(spark, spark.createDataFrame(mixed, DOCS), "").collect()
    import public_tokenizers

    enc = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = Counter()
    for r in mixed:
        tokens[r[0]] += len(enc.by_file(r[1])) // 4 + 1
    packed, place = Counter(), defaultdict(list)
    for r in out:
        packed[r.doc_id] += r.length
        place[r.sequence_id].append((r.offset, r.length))
    assert packed == tokens
    for v in place.values():
        ends = np.cumsum([n for _, n in sorted(v)])
        assert [o for o, _ in sorted(v)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_and_clashing_tables(spark, docs, no_docs, clash, k):
    pytest.importorskip("public_tokenizers")
    stage = P.STAGES[k][1]
    assert stage(spark, no_docs, "").count() == 0
    out, plain = stage(spark, clash, ""), stage(spark, docs, "")
    if k < 4:
        assert out.columns == clash.columns and plain.columns == docs.columns
    assert out.count() == plain.count()
