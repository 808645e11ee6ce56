"""Operator 11 against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from glint.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(PATH)


@pytest.fixture(scope="module")
def known(vocab):
    return tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def encode(vocab, texts):
    return [x.tolist() for x in bpe.Memory(vocab, public_tokenizers.PATTERN).encode(texts)]


def odd_texts():
    r = random.Random(3)
    pick = [
        lambda: chr(r.randrange(32, 127)), lambda: r.choice("ab \n\tthe"),
        lambda: r.choice(["ing", "er", "tion", "an", "a", "e", "s", "n"]),
        lambda: chr(r.choice([r.randrange(0x20, 0x3000), r.randrange(0x4E00, 0x9FFF), r.randrange(0x10000, 0x40000), 0x558]))]
    out = ["".join(f() for _ in range(r.randrange(200))) for _ in range(800) for f in pick]
    return out + ["", "a" * 30_000, "ab" * 20_000, "é" * 3_000, " " * 5_000, "<|endoftext|> x", "one  two\n\n three ", "\x1c\x85"]


def test_ids_equal_the_library(vocab, known):
    texts = odd_texts()
    got = encode(vocab, texts)
    assert got == [known.encode_ordinary(t) for t in texts]
    assert [vocab.decode(np.array(x, "<u4")) for x in got] == [t.encode() for t in texts]


def test_every_character_is_split_as_by_the_library(vocab, known):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "a!1".join(chars[i: i + 64]) + "1" for i in range(0, len(chars), 64)]
    assert encode(vocab, texts) == [known.encode_ordinary(t) for t in texts]


def test_rank_order_may_go_back():
    """`ab` makes the pair (ab, c) of a lower rank than its own."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"cab": 258, b"abab": 259}
    vocab = bpe.Vocabulary(ranks)
    known = tiktoken.Encoding("small", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(1)
    words = ["".join(r.choice("abc") for _ in range(r.randrange(1, 30))) for _ in range(3_000)]
    assert encode(vocab, words) == [known.encode_ordinary(w) for w in words]


def test_long_texts_and_small_blocks(spark, vocab, known, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 50)
    monkeypatch.setattr(bpe, "MAX_WORDS", 20)
    memory = bpe.Memory(vocab, public_tokenizers.PATTERN)
    texts = odd_texts()[:400]
    for i in range(0, len(texts), 7):
        assert [x.tolist() for x in memory.encode(texts[i: i + 7])] == [known.encode_ordinary(t) for t in texts[i: i + 7]]


def digests(known, text):
    ids = known.encode_ordinary(text or "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())


def test_query_rows(spark, docs, clash, known, tmp):
    docs.write.parquet(f"{tmp}/documents.parquet")
    got = sorted(map(tuple, bpe.op11_bpe(spark, tmp).collect()), key=str)
    assert got == sorted(((r.doc_id, *digests(known, r.text)) for r in docs.collect()), key=str)
    coded = bpe.encode_texts(clash.withColumn("ids", F.lit(1)), PATH, public_tokenizers.PATTERN)
    assert coded.count() == docs.count() and coded.columns[-2:] == ["n_tokens", "ids"] and "label" in coded.columns


def test_no_rows_and_bad_ids(spark, no_docs, vocab):
    assert bpe.encode_texts(no_docs, PATH, public_tokenizers.PATTERN).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids binary").select(bpe.decoded("ids", PATH), bpe.decimal("ids")).first()
    assert tuple(nothing) == (None, None)
    with pytest.raises(ValueError):
        vocab.decode(np.array([50_300], "<u4"))


def test_short_words_are_merged_by_rounds(vocab, monkeypatch):
    """Short words don't go through the index, and get the same ids."""
    r = random.Random(2)
    words = [bytes(r.choice(b"abe \xc3\xa9tionshr") for _ in range(r.randrange(80))) for _ in range(2_000)]
    want, seen = vocab.replay(words), []
    replay = vocab.replay
    monkeypatch.setattr(vocab, "replay", lambda some: seen.extend(some) or replay(some))
    got = vocab.merged(words)
    assert got.values.tolist() == want.values.tolist() and got.sizes.tolist() == want.sizes.tolist()
    assert sorted(seen) == sorted(w for w in words if len(w) > bpe.SHORT)


def test_ids_as_text(spark, vocab):
    ids = [[], [5], [1, 50_000, 2], [4_000_000_000, 7], None]
    rows = spark.createDataFrame([(None if x is None else np.array(x, "<u4").tobytes(),) for x in ids], "ids binary").coalesce(1)
    got = [r[0] for r in rows.select(bpe.decimal("ids")).collect()]
    assert got == [None if x is None else ",".join(map(str, x)) for x in ids]
    ok = rows.limit(3).union(rows.where("ids is null")).select("ids", bpe.decoded("ids", PATH).alias("d")).collect()
    assert [r.d for r in ok] == [None if r.ids is None else vocab.decode(np.frombuffer(r.ids, "<u4")) for r in ok]
