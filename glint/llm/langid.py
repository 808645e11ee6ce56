"""Language identification by error-correcting output codes.

Each language has a binary codeword. For every bit a binary n-gram
classifier (log odds of hashed byte n-grams, calibrated by a logistic fit) says how strongly a text belongs to the languages that have
the bit set. The losses of the classifiers' margins against each codeword
are added up; the codeword with the least loss is the answer, and a small
lead over the second flags the text as ambiguous.

Classifiers learn n-gram counts from a bounded sample (`sample_docs` whole
documents per language, chosen by a hash); only the counts, at most
languages x `DIM`, and a few margins per sampled document reach the driver.
Prediction reads whole texts.

Defined cases: a null text, or one without a letter, is `und` with score 0
and not ambiguous; so is everything when no language can be learned; with a
single language every text with a letter gets it with score 1; ties go to
the language that comes first; repeated rows get the same answer."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save_table, small_batches

BITS = 15
DIM = 1 << BITS
ORDERS = (1, 2, 3, 4)
SLICE = 1 << 16


def grams(text: str) -> list[np.ndarray]:
    """Hashed byte n-grams of the lower-cased text, one array per order."""
    b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    out, run = [], np.zeros(len(b) + 1, np.uint32)
    for n in ORDERS:
        run = (run[:-1] << np.uint32(8)) | b[n - 1:]
        out.append((run * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BITS))
        if len(b) <= n:
            break
    return out


def codewords(n: int, seed: int = 1) -> np.ndarray:
    """(n, bits) of -1 and 1: every split of up to 6 languages, beyond that
    the best of several random codes."""
    if n <= 6:
        rows = [(1, *rest) for rest in product((-1, 1), repeat=n - 1) if -1 in rest]
        return np.array(rows, np.int8).T.reshape(n, -1)
    rng, bits, best = np.random.default_rng(seed), 12 * int(np.ceil(np.log2(n))), None
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.astype(int).sum(0)) < n]
        gap = min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) if n <= 200 else code.shape[1]
        if best is None or gap > best[0]:
            best = gap, code
    return best[1]


class Model:
    """`table`: log odds per n-gram and bit; `scale`, `shift`: calibration."""

    def __init__(self, langs: list[str], code: np.ndarray, table: np.ndarray):
        self.langs, self.code, self.table = langs, code, table
        self.scale, self.shift = np.ones(code.shape[1]), np.zeros(code.shape[1])

    def margins(self, text: str) -> np.ndarray:
        """Mean log odds per bit of all n-grams of the text."""
        total, n = np.zeros(self.code.shape[1]), 0
        for h in grams(text):
            n += len(h)
            for at in range(0, len(h), SLICE):
                total += self.table[h[at: at + SLICE]].sum(0, dtype=np.float64)
        return total / max(n, 1)

    def decode(self, margins: np.ndarray) -> tuple[str, float, float]:
        """Language, its share of belief, and its lead over the second."""
        z = np.clip(self.scale * margins + self.shift, -30, 30)
        loss = np.logaddexp(0.0, -self.code * z).sum(1)
        best = int(loss.argmin())
        share = np.exp(loss[best] - loss)
        lead = np.partition(loss, 1)[1] - loss[best] if len(loss) > 1 else np.inf
        return self.langs[best], float(1 / share.sum()), float(lead)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> n-gram counts per language of the partition."""
    total: dict[str, np.ndarray] = {}
    for b in it:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            t = total.setdefault(lang, np.zeros(DIM))
            for h in grams(text or ""):
                t += np.bincount(h, minlength=DIM)
    for lang, t in total.items():
        at = np.flatnonzero(t)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(t[at])], ["lang", "gram", "n"])


def fit(labelled: DataFrame, sample_docs: int = 600, max_langs: int = 1_000) -> Model | None:
    """Learn from `labelled` (key, text, lang); `key` only picks the sample."""
    some = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r.n for r in some.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    if not sizes:
        return None
    langs = sorted(sizes)
    # by a hash threshold first, so that only about the sample is shuffled
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, 2.0 * sample_docs / sizes[k])))])
    u = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / float(1 << 20)
    w = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key", "text")
    sample = (
        some.where(u < share[F.col("lang")]).withColumn("_r", F.row_number().over(w))
        .where(F.col("_r") <= sample_docs).select("lang", "text")
    )
    sample = save_table(sample, "sample")
    counts = sample.mapInArrow(_sums, "lang string, gram int, n double").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    freq = np.zeros((len(langs), DIM))
    for r in counts.collect():
        freq[langs.index(r.lang), r.gram] = r.n
    freq = (freq + 0.5) / (freq + 0.5).sum(1, keepdims=True)
    code = codewords(len(langs))
    one = (code[:, :, None] > 0) * freq[:, None, :]
    zero = (code[:, :, None] < 0) * freq[:, None, :]
    mean = lambda x, side: x.sum(0) / np.maximum(1, side.sum(0))[:, None]
    table = (np.log(mean(one, code > 0)) - np.log(mean(zero, code < 0))).T if code.shape[1] else np.zeros((DIM, 0))
    model = Model(langs, code, table.astype(np.float32))
    if code.shape[1]:
        margins = F.pandas_udf(lambda t: t.map(lambda x: model.margins(x).tolist()), "array<double>")
        found = sample.select("lang", margins("text").alias("m")).collect()
        _calibrate(model, np.array([r.m for r in found]), np.array([langs.index(r.lang) for r in found]))
    return model


def _calibrate(model: Model, m: np.ndarray, lang: np.ndarray, steps: int = 25, ridge: float = 1e-3) -> None:
    """Per bit a logistic fit of the margin (Newton steps)."""
    for b in range(m.shape[1]):
        y = model.code[lang, b] > 0
        unit = np.abs(m[:, b]).mean() or 1.0
        x, theta = np.stack([m[:, b] / unit, np.ones(len(m))], 1), np.zeros(2)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(m) * np.eye(2)
            theta += np.linalg.solve(h, x.T @ (y - p) - ridge * len(m) * theta)
        model.scale[b], model.shift[b] = theta[0] / unit, theta[1]


def identify(model: Model | None, text: Column, lead: float = 0.5) -> Column:
    """struct(lang_pred, score, ambiguous) of a text column."""
    def predict(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            if t is None or model is None or not has_letter(t):
                out.append(("und", 0.0, False))
            else:
                lang, score, ahead = model.decode(model.margins(t))
                out.append((lang, score, ahead < lead))
        return pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"])

    return F.pandas_udf(predict, "lang_pred string, score double, ambiguous boolean")(text)


def remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n (-1 for a null key)."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(n)), F.lit(-1))


def language_model(docs: DataFrame, id_col: str = "doc_id", sample_docs: int = 600) -> Model | None:
    """Learned from the rows of `docs` that are not held out."""
    small_batches(docs.sparkSession)
    train = docs.where(remainder(id_col, 4) != 2)
    return fit(train.select(F.col(id_col).alias("key"), "text", "lang"), sample_docs)


def op6_langid(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(language_model(docs), F.col("text"))
    out = docs.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), found.alias("f"))
    return out.select("doc_id", "held_out", "f.lang_pred", "f.score", "f.ambiguous")
