import bisect
import pathlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import DOCS, odd_docs, prose
from pyspark.sql import functions as F

from glint.llm import licenses, lm_score, mixing, packing, simhash
from glint.llm.langid import Model, codewords, identify, language_model
from glint.llm.line_dedup import line_dedup
from glint.llm.lm_score import score_texts, seat

WS = " \t\n\x0b\f\r"


# --- line dedup -----------------------------------------------------------

def brute_lines(rows, least):
    key = lambda x: x.strip(WS).encode().lower()
    count = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if not key(x) or count[key(x)] < least]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_is_exact(docs, clash):
    want = Counter(brute_lines(odd_docs(), 10))
    for table in (docs, clash):
        got = line_dedup(table, 10).select("doc_id", "n_lines", "n_dropped", F.coalesce("kept", F.lit("")))
        assert Counter(map(tuple, got.collect())) == want
    assert set(clash.columns) - {"kept"} <= set(line_dedup(clash, 10).columns)
    assert sum(r[2] for r in want) >= 12


def test_line_dedup_empty(no_docs):
    assert line_dedup(no_docs).count() == 0


# --- SimHash --------------------------------------------------------------

def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints):
    n, root = len(prints), list(range(len(prints)))
    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_fingerprints_and_components(docs, clash):
    rows = odd_docs()
    prints = [brute_print(r[1]) for r in rows]
    root = brute_groups(prints)
    least = defaultdict(list)
    for r, k in zip(rows, root):
        least[k].append(r[0])
    want = Counter(
        (r[0], np.uint64(p).astype(np.int64).item(), min((x for x in least[k] if x is not None), default=None))
        for r, p, k in zip(rows, prints, root))
    for table in (docs, clash):
        got = simhash.simhash_dedup(table).select("id", "fp", "component_id")
        assert Counter(map(tuple, got.collect())) == want
    kept = simhash.keep_one(clash)
    assert kept.columns == clash.columns
    assert kept.count() == len(set(root))


def test_simhash_empty(no_docs):
    assert simhash.simhash_dedup(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_golay_code_is_perfect():
    assert set(np.bincount(simhash.golay_nearest()).tolist()) == {2048}


def test_any_three_flipped_bits_share_a_key():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x = rng.integers(0, 2**63, dtype=np.uint64)
        y = x
        for b in rng.choice(64, rng.integers(1, 4), replace=False):
            y ^= np.uint64(1 << int(b))
        row, key = simhash.keys(np.array([x, y], np.uint64).view(np.int64))
        assert set(key[row == 0]) & set(key[row == 1])


def test_forest_joins_what_is_linked(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fp = np.unique(np.concatenate([base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 64, 30)]))
    edges = [(int(a), int(b)) for x, y in simhash.forest(fp.view(np.int64), 3) for a, b in zip(x, y)]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    assert len(fp) - len(edges) == len(set(brute_groups([int(x) for x in fp])))


def test_a_crowd_of_near_copies_in_one_key_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "KEY_BLOCK", 8)
    rng = np.random.default_rng(3)
    low = np.unique(rng.integers(0, 1 << 18, 60).astype(np.int64)) << 43  # one key in segments 0 and 1
    table = spark.createDataFrame([(int(x),) for x in low], "fp long")
    links = simhash.link_fingerprints(table).collect()
    root = {int(x): int(x) for x in low}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in links:
        assert (a ^ b).bit_count() <= 3
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert len({find(int(x)) for x in low}) == len(set(brute_groups([int(x) for x in low])))


# --- mixing ---------------------------------------------------------------

def test_mixing_meets_targets(spark):
    rows = [(i, prose(i, 3 + i % 40), "en", "s%d" % (i % 5) if i % 9 else None, 1) for i in range(600)]
    table = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_sources(table, F.array("source"), mixing.by_turns).collect()
    assert len(got) == 600
    total = sum(r._size for r in got)
    by = defaultdict(list)
    for r in got:
        assert r._size == len(r.text.split()) and 0 <= r._copies <= 3
        by[r._source].append(r)
    assert abs(sum(v[0]._target for v in by.values()) - total) < 1e-6 * total
    for s, v in by.items():
        assert v[0]._source_size == sum(r._size for r in v)
        assert v[0]._target <= 3 * v[0]._source_size + 1e-6
        # whole documents of up to 43 words are taken: within half of one
        assert abs(sum(r._size * r._copies for r in v) - v[0]._target) <= 21
    again = mixing.mix_sources(table.repartition(7), F.array("source"), mixing.by_turns).collect()
    assert sorted((r.doc_id, r._copies) for r in again) == sorted((r.doc_id, r._copies) for r in got)


def test_mixing_odd_rows(docs, clash, no_docs):
    out = mixing.mix_sources(clash, F.array("source"), mixing.by_turns)
    assert out.columns[: len(clash.columns)] == clash.columns
    got = out.collect()
    assert len(got) == len(odd_docs())
    assert all(r._copies == 0 for r in got if r._size == 0)
    assert {r._size for r in got if r.text is None} == {0}
    assert mixing.mix_sources(no_docs, F.array("source"), mixing.by_turns).count() == 0


def test_targets_share_what_is_above_the_limit():
    t = mixing.targets({"a": 100, "b": 1, "c": 1}, {"a": 1, "b": 2, "c": 3}, 102, 3)
    assert (t["b"], t["c"], t["a"]) == (3, 3, 96)


def test_flow_prefers_fresh_words_and_reroutes():
    # x can only serve a; xy serves either: fresh words fill both quotas
    sent = mixing.flow({frozenset("a"): 10, frozenset("ab"): 10}, {"a": 10, "b": 10}, 3)
    assert sent == {(frozenset("a"), "a"): 10, (frozenset("ab"), "b"): 10}
    # a quota above the supply repeats words, up to three times
    assert sum(mixing.flow({frozenset("a"): 10}, {"a": 25}, 3).values()) == 25
    assert sum(mixing.flow({frozenset("a"): 10}, {"a": 35}, 3).values()) == 30


def test_overlapping_sources(spark):
    rows = [(i, prose(i, 20), "en", None, 1) for i in range(90)]
    table = spark.createDataFrame(rows, DOCS).withColumn(
        "of", F.when(F.col("doc_id") < 30, F.array(F.lit("a"))).when(F.col("doc_id") < 60, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b"))))
    got = mixing.mix_sources(table, F.col("of"), lambda names: dict.fromkeys(names, 1)).collect()
    assert abs(sum(r._size * r._copies for r in got) - 90 * 20) <= 60


# --- packing --------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_ids_equal_the_tokenizers(vocabulary):
    texts = [r[1] or "" for r in odd_docs()] + [
        " lead", "trail ", "two  spaces", "a \n b", "tab\t x", "nb sp   x", "it's we'll", "<|endoftext|> in text", "x" * 500,
        "a   b", "\x1c \x1d y", "  ", "émigré 東京 \U0001f600 z", "a\n\n\nb \n\n c", "a \x85 b"]
    enc = packing.Encoder(vocabulary)
    assert enc.ranks is not None
    for t in [*texts, "x" * 9_000, " " * 9_000 + "y", "\u2028 a\xa0\xa0b", "\u180e\u200b\ufeff z", "1\u00bd\u0663 II"]:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, repr(t[:40])


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text(" \n\t\xa0\u2003'stremvdl.aA1é!\x1c\x85", max_size=40))
def test_ids_equal_the_tokenizers_for_any_text(text):
    enc = packing.encoder(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    assert enc.encode(text) == enc.by_file(text)


def test_packing_round_trip(docs, clash, vocabulary):
    enc = packing.Encoder(vocabulary)
    for table in (docs, clash):
        got = packing.pack_pieces(packing.token_pieces(table, vocabulary)).collect()
        rows = defaultdict(list)
        for r in got:
            assert len(r.ids) == 4 * r.length and 1 <= r.length <= 2048
            rows[r.sequence_id].append(r)
        for v in rows.values():
            at = 0
            for r in sorted(v, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            assert at <= 2048
        texts = Counter((r[0], tuple(enc.tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (0,)) for r in odd_docs())
        whole = Counter()
        for k in {r.doc_id for r in got}:
            parts = sorted((r for r in got if r.doc_id == k), key=lambda r: r.start)
            n = max(1, sum(r.piece == 0 for r in parts))
            if n == 1:
                whole[k, tuple(x for r in parts for x in np.frombuffer(r.ids, "<u4").tolist())] += 1
        assert whole == Counter({k: v for k, v in texts.items() if k[0] != 9})
        assert all(r.length == 2048 for r in got if r.piece > 0)


def test_packing_is_near_the_bound():
    rng = np.random.default_rng(4)
    counts = Counter(np.clip(rng.lognormal(6.3, 1, 20_000).astype(int), 1, 2048).tolist())
    plan = packing.configurations(counts, 2048)
    held = Counter()
    for conf, n in plan:
        assert sum(x * k for x, k in conf) <= 2048
        for x, k in conf:
            held[x] += n * k
    assert held == counts
    assert sum(n for _, n in plan) <= 1.002 * sum(x * n for x, n in counts.items()) / 2048 + 1


def plain_best_fit(counts, size):
    """Best-fit decreasing, piece by piece: the number of sequences."""
    rooms, n = [], 0
    for x in sorted(counts.elements(), reverse=True):
        i = bisect.bisect_left(rooms, x)
        n += i == len(rooms)
        room = size if i == len(rooms) else rooms.pop(i)
        bisect.insort(rooms, room - x)
    return n


def test_packing_of_given_lengths_is_as_good_as_best_fit(spark, vocabulary):
    """The real texts' lengths, as they are and many times over."""
    rows = packing.token_pieces(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), vocabulary).select("length")
    given = Counter(r.length for r in rows.collect())
    for counts in (given, Counter({x: 40 * n for x, n in given.items()}), Counter({1100: 30, 1000: 3, 900: 30, 48: 5}), Counter({700: 9})):
        plan = packing.configurations(counts, 2048)
        held = Counter()
        for conf, n in plan:
            assert sum(x * k for x, k in conf) <= 2048
            for x, k in conf:
                held[x] += k * n
        used = sum(n for _, n in plan)
        assert held == counts and used <= plain_best_fit(counts, 2048) + used // 20_000
        bound = packing.solve(counts, 2048).bound
        assert bound <= used + 1e-6 and bound >= sum(x * n for x, n in counts.items()) / 2048 - 1e-6


def test_packing_bound_sees_what_does_not_fit_together():
    assert packing.solve({1100: 50}, 2048).bound > 49.9  # by volume it would be 27


def test_packing_empty(no_docs, vocabulary):
    assert packing.pack_pieces(packing.token_pieces(no_docs, vocabulary)).count() == 0
    assert packing.configurations({}, 2048) == []


# --- language ID ----------------------------------------------------------

def test_codewords_are_apart():
    for n in (1, 2, 3, 4, 6, 9):
        code = codewords(n)
        assert code.shape[0] == n
        assert len({tuple(r) for r in code.tolist()}) == (n if n > 1 else 1)


def test_languages(spark):
    lexicon = {"aa": "kala mora tipu".split(), "bb": "xunz wrog plek".split(), "cc": "éton ûlis çavo".split()}
    rows = [(i, prose(i, 30, lexicon[k]), k, None, 1) for i, k in enumerate(list(lexicon) * 40)]
    table = spark.createDataFrame(rows + [(900, None, "aa", "s", 1), (901, "12 !!", "bb", "s", 1), (902, "", None, None, 1)], DOCS)
    model = language_model(table)
    got = {r.doc_id: r for r in table.select("doc_id", "lang", identify(model, F.col("text")).alias("f")).collect()}
    held = [r for k, r in got.items() if k < 900 and zlib.crc32(str(k).encode()) % 4 == 2]
    assert held and all(r.f.lang_pred == r.lang and 0 <= r.f.score <= 1 for r in held)
    assert [tuple(got[k].f) for k in (900, 901, 902)] == [("und", 0.0, False)] * 3


def test_languages_odd_rows(docs, clash, no_docs):
    model = language_model(clash)
    got = clash.select("doc_id", "text", identify(model, F.col("text")).alias("f")).collect()
    assert len(got) == len(odd_docs())
    assert all((r.f.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) for r in got)
    assert language_model(no_docs) is None
    assert docs.select(identify(None, F.col("text")).alias("f")).where("f.lang_pred <> 'und'").count() == 0


def test_a_single_language_is_certain():
    model = Model(["xx"], codewords(1), np.zeros((1 << 15, 0), np.float32))
    assert model.decode(model.margins("any text"))[:2] == ("xx", 1.0)


# --- licences -------------------------------------------------------------

def brute_licenses(rows, least=0.8):
    grams = lambda w: Counter(zip(w, w[1:]))
    known = {k: grams(licenses._words(t)) for k, t in licenses.TEMPLATES.items()}
    out = {}
    for r in rows:
        text = re.sub(r" ?\n ?", "\n", re.sub(r"[^\w\n]+|_+", " ", (r[1] or "").lower()))
        units = [(k, i, u) for k, us in enumerate(([text], re.split(r"\n\n+", text), text.split("\n")))
                 for i, u in enumerate(x for x in (y.replace("\n", " ").strip(" ") for y in us) if x)]
        for k, i, u in units:
            a = grams(u.split(" "))
            for name, b in known.items():
                d = 2 * (a & b).total() / max(1, a.total() + b.total())
                if d >= least:
                    out[r[0], name] = min(out.get((r[0], name), (0, 9, 9)), (-d, k, i))
    return {(*k, -v[0], licenses.KINDS[v[1]], v[2]) for k, v in out.items()}


def test_licenses_equal_brute_force(spark, docs, clash):
    mit, apache = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0 statement"]
    rows = [*odd_docs(), (500, f"Intro\n\n{mit[:200]}\n{mit[200:]}\n\nend", "en", "a", 1), (501, f"x y z\nLICENSED under THE apache license; version 2.0\n{apache}", "en", "a", 1),
            (502, mit.replace("Software", "Library", 1), "en", "a", 1), (503, mit[: len(mit) // 2], "en", "a", 1), (501, "again", None, None, None)]
    got = licenses.license_scan(spark.createDataFrame(rows, DOCS)).collect()
    assert {tuple(r) for r in got} == brute_licenses(rows)
    assert len(got) >= 3
    assert licenses.license_scan(clash).count() == licenses.license_scan(docs).count() == len(brute_licenses(odd_docs()))


def test_license_bounds_lose_nothing():
    for b in range(1, 200):
        low, high = licenses.bounds(b, 0.8)
        for a in (low - 1, high + 1):
            assert a <= 0 or 2 * min(a, b) / (a + b) < 0.8


def test_licenses_empty(no_docs):
    assert licenses.license_scan(no_docs).count() == 0


# --- language model -------------------------------------------------------

def held_out(column="doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def test_scores(spark):
    # every word but the first follows from the one before it
    chain = {w: WORDS[(i * 5 + 3) % len(WORDS)] for i, w in enumerate(WORDS)} if (WORDS := "a b c d e f g h".split()) else {}
    rows = []
    for i in range(120):
        w = [WORDS[i % len(WORDS)]]
        for _ in range(30):
            w.append(chain[w[-1]])
        rows.append((i, " ".join(w), "en", "s", 1))
    table = spark.createDataFrame(rows, DOCS)
    got = score_texts(table, ~held_out()).collect()
    train = Counter(t for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1 for t in [*r[1].split(), None])
    n, v = train.total(), len(train)
    for r in got:
        tokens = [*rows[r.id][1].split(), None]
        assert (r.n_tokens, r.train_tokens) == (len(tokens), n)
        assert r.n_known == sum(train[t] > 0 for t in tokens)
        assert abs(r.base_score - sum(np.log10((train[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)) < 1e-6
        assert r.score > r.base_score * 0.6  # the chain is learned
        assert abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity


def test_scores_odd_rows(docs, clash, no_docs):
    got = score_texts(clash, ~held_out()).collect()
    assert Counter(r.id for r in got) == Counter(r[0] for r in odd_docs())
    assert {r.n_tokens for r in got if r.id in (1, 2, 3)} == {1}
    assert all(r.score < 0 for r in got)
    assert score_texts(no_docs, ~held_out()).count() == 0
    nothing = score_texts(docs, F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in nothing)


def test_probabilities_sum_to_one(spark):
    """The averaged predictive distribution after one context, over the
    vocabulary and one unknown word."""
    rows = [(i, prose(i, 50, "p q r s".split()), "en", "s", 1) for i in range(40)]
    vocabulary = sorted({w for r in rows for w in r[1].split()})
    asked = [(1000 + k, w, "en", "s", 1) for k, w in enumerate([*vocabulary, "never"])] + [(2000, "", "en", "s", 1)]
    table = spark.createDataFrame(rows + asked, DOCS)
    got = {r.id: r for r in score_texts(table, F.col("doc_id") < 1000).collect()}
    # one-word texts: P(word | start) * P(end | word); divide the end out
    two = {k: got[k].score for k in got if k >= 1000}
    assert all(s < 0 for s in two.values())
    assert two[1000 + len(vocabulary)] < max(two.values())


def test_seating_follows_the_restaurant():
    """Mean number of tables of one dish against one-by-one seating."""
    rng = np.random.default_rng(5)
    n, theta, d, base, others = 60, 1.0, 0.5, 0.3, 4
    mean = seat(rng, np.full(4_000, n), np.full(4_000, others), theta, d, np.full(4_000, base))[0].mean()
    t = np.ones(4_000)
    for k in range(1, n):
        new = (theta + d * (others + t)) * base
        t += rng.random(4_000) < new / (new + k - d * t)
    assert abs(mean - t.mean()) < 0.1




def test_few_dishes_are_seated_like_many(monkeypatch):
    rng = np.random.default_rng(6)
    c, others, base = rng.integers(1, 400, 60), rng.integers(1, 900, 60), rng.random(60) / 9
    c[:5], c[5:9] = 20_000, 1
    one, many = [], []
    for few, out in ((60, one), (0, many)):
        monkeypatch.setattr(lm_score, "FEW", few)
        out += seat(np.random.default_rng(7), c, others, 1.0, 0.7, base)
    assert one[0][c == 1].max() == 1 and np.all((one[0] >= 1) & (one[0] <= c))
    # the draws come in the same order
    assert np.array_equal(one[0], many[0]) and np.allclose(one[1], many[1])


def test_distinct_values_and_places():
    for x in (np.array([], np.uint64), np.array([2**64 - 1, 0, 7, 7, 2**63, 0], np.uint64), np.arange(9, dtype=np.int64)[::-1] % 4):
        values, place = lm_score._distinct(x)
        want, at = np.unique(x, return_inverse=True)
        assert values.dtype == x.dtype and np.array_equal(values, want) and np.array_equal(place, at)


def test_packed_arrays():
    arrays = {"u": np.arange(6, dtype=np.uint64), "n": np.array([1, 2**32 - 1], np.uint32), "none": np.zeros(0, np.uint32),
              "own": np.ones((2, 3), np.float32), "p0": [np.ones(2, np.float32)]}
    got = lm_score._unpacked(lm_score._packed(arrays))
    assert got.keys() == arrays.keys()
    for k in ("u", "n", "none", "own"):
        assert got[k].dtype == arrays[k].dtype and np.array_equal(got[k], arrays[k])
    assert np.array_equal(got["p0"][0], arrays["p0"][0])


def test_scores_hold_little_on_disk(spark, monkeypatch):
    """Tables at any time, by token; none but the scores is left."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 20_000, 2_000)), "en", "s", 1) for i in range(100)]
    held, most = {}, 0
    whole = lambda path: sum(f.stat().st_size for f in pathlib.Path(path.removeprefix("file:")).rglob("*.parquet"))

    def watched(df, name, tidy=False, saved=lm_score.saved):
        nonlocal most
        out, path = saved(df, name, tidy)
        held[path] = name
        most = max(most, sum(map(whole, held)))
        return out, path

    monkeypatch.setattr(lm_score, "saved", watched)
    assert score_texts(spark.createDataFrame(rows, DOCS), ~held_out()).count() == 100
    assert most < 25 * 200_100
    assert {held[path] for path in held if whole(path)} == {"scores"}


def _after_rare_words(n: int) -> list[tuple]:
    """Each of `n` words is followed, ten times, by a word of its own."""
    one = lambda k: f"ctx{k} next{k} " + " ".join(f"pad{(k * 7 + j) % 50}" for j in range(8))
    return [(i, " ".join(one(k) for k in range(i % 20, n, 20)), "en", "s", 1) for i in range(200)]


def test_every_training_word_is_a_context(spark):
    """Words far below 1 in 5,000 tokens predict what follows them."""
    n = 1_200
    rows = _after_rare_words(n)
    asked = [(1000 + k, f"ctx{k} next{k}", "en", "s", 1) for k in range(40)]
    asked += [(2000 + k, f"ctx{k} next{(k + 600) % n}", "en", "s", 1) for k in range(40)]
    got = {r.id: r.score for r in score_texts(spark.createDataFrame(rows + asked, DOCS), F.col("doc_id") < 1000).collect()}
    assert all(got[1000 + k] > got[2000 + k] + 1 for k in range(40))


def test_scores_do_not_depend_on_the_split(spark):
    """All counts are over the whole table, however it is cut."""
    table = spark.createDataFrame(_after_rare_words(400), DOCS)
    whole, cut = ({r.id: tuple(r) for r in score_texts(table.repartition(n), ~held_out()).collect()} for n in (1, 64))
    assert whole.keys() == cut.keys()
    for k, r in whole.items():
        assert r[:4] == cut[k][:4] and np.allclose(r[4:], cut[k][4:], rtol=1e-6)


def _paragraphs(text: str, *starts: str) -> str:
    """`text` with a blank line before each of `starts`, in lines of 70."""
    for x in starts:
        assert x in text
        text = text.replace(x, "\n\n" + x)
    return "\n\n".join(re.sub(r"(.{60,70}) ", r"\1\n", p) for p in text.split("\n\n"))


def test_licenses_inside_longer_documents(spark):
    t = licenses.TEMPLATES
    usual = {
        "MIT": _paragraphs(t["MIT"], "The above copyright", "THE SOFTWARE IS"),
        "Apache-2.0 notice": _paragraphs(t["Apache-2.0 notice"], "http://www", "Unless required"),
        "GPL-3.0 notice": _paragraphs(t["GPL-3.0 notice"], "This program is distributed", "You should have"),
        "MIT statement": "This file is released under the MIT License.",
    }
    long = prose(1, 800)
    rows = [(i, f"{long}\n\n{u}\n\nimport os\n{prose(2, 500)}", "en", "a", 1) for i, u in enumerate(usual.values())]
    rows += [(10, prose(3, 50) + " the mit license the software is " + prose(4, 900), "en", "a", 1)]
    got = {(r.doc_id, r.license): r for r in licenses.license_scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert set(got) == {*enumerate(usual), (1, "Apache-2.0 statement")}  # the notice begins with it
    assert all(r.dice > 0.97 and r.kind == "run" for r in got.values())
    assert got[0, "MIT"].position == len(licenses._words(long))


def test_runs_equal_brute_force(spark):
    r, words, grams = random.Random(3), "a b c".split(), lambda w: Counter(zip(w, w[1:]))
    known = {"x": "a b a b c a", "y": "c c c b", "z": "a a a a a b"}
    rows = [(i, "".join(r.choice(words) + r.choice([" ", "\n", "\n\n"]) for _ in range(40)), "en", "a", 1) for i in range(60)]
    got = {(x.doc_id, x.license): x.dice for x in licenses.license_scan(spark.createDataFrame(rows, DOCS), known).collect()}
    want = {}
    for i, text, *_ in rows:
        w = text.split()
        for name, t in known.items():
            b = grams(t.split())
            d = max(2 * (a & b).total() / (a.total() + b.total()) for s in range(39) for e in range(s + 2, 41) if (a := grams(w[s:e])))
            if d >= 0.8:
                want[i, name] = d
    assert got.keys() == want.keys() and all(abs(got[k] - d) < 1e-9 for k, d in want.items())


def test_tidy_tables_leave_no_shuffle_files(spark):
    import time

    from glint.llm.common import drop_saved, saved

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        every = disk.getAllFiles().toString()
        return {f for f in every.split("/") if f.startswith("shuffle_")}

    before, rows = files(), spark.range(1_000).repartition(3, "id")
    out, path = saved(rows, "tidy", tidy=True)
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert out.count() == 1_000
    drop_saved(spark, path)
