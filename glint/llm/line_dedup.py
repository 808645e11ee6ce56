"""Line dedup: drop the lines that many documents share.

Lines are normalised and hashed (128 bits) inside the tasks, exploded as
hashes only, and counted per document with map-side combine. Hashes found in
enough documents are joined back to line positions, so texts never pass a
shuffle before the last join, and common lines are joined by broadcast.

Defined cases: a null or empty text is one empty line and keeps no text
(null stays null in `kept`); lines whose key is shorter than `min_chars` are
never dropped; every row counts as one document, also one that repeats
another row's id or text; a line that repeats inside one document counts
once; columns of the input pass through unchanged, and no name is added but
`kept`, `n_lines`, `n_dropped` (clashing input columns are replaced)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_SPACE, save_table, skew_lookup, small_batches

_STRIP = WORD_SPACE.encode()


def _hashed(min_chars: int):
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(2).to_pylist():
                row = []
                for line in (text or b"").split(b"\n"):
                    key = line.strip(_STRIP)
                    long = len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars
                    row.append(xxhash.xxh3_128_digest(key.lower()) if long else None)
                out.append(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.list_(pa.binary()))], ["id", "txt", "keys"])

    return lines


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, drops: pd.Series) -> pd.Series:
    def one(t, d):
        if t is None or d is None:
            return t
        gone = set(d.tolist())
        return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)

    return pd.Series([one(t, d) for t, d in zip(text, drops)], dtype=object)


def line_dedup(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Return the rows of `docs` with `kept` (the text without its shared
    lines), `n_lines` and `n_dropped`."""
    small_batches(docs.sparkSession)
    text = F.col(text_col)
    txt = F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    keyed = docs.select(F.col(id_col).cast("string").alias("id"), txt.alias("txt"), text.cast("binary").alias("text"))
    hashed = save_table(
        keyed.mapInArrow(_hashed(min_chars), "id string, txt binary, keys array<binary>"), "lines")
    each = hashed.select(F.explode(F.array_distinct("keys")).alias("key")).where("key is not null")
    shared = save_table(
        each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs), "shared")
    lines = hashed.select("id", "txt", F.posexplode("keys").alias("pos", "key")).where("key is not null")
    total = hashed.agg(F.sum(F.size("keys"))).first()[0] or 0
    dropped = (
        skew_lookup(lines, shared, "key", "n", total, "inner")
        .groupBy("id", "txt").agg(F.collect_set("pos").alias("_drops"))
    )
    d = dropped.select(F.col("id").alias("_id"), F.col("txt").alias("_txt"), "_drops")
    own = [c for c in docs.columns if c not in ("kept", "n_lines", "n_dropped")]
    both = docs.withColumn("_md5", txt).join(
        d, F.col(id_col).cast("string").eqNullSafe(F.col("_id")) & (F.col("_md5") == F.col("_txt")), "left")
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return both.select(
        *own,
        _without(text, F.col("_drops")).alias("kept"),
        F.coalesce(n_lines, F.lit(1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op2_line_dedup(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = line_dedup(docs, min_docs=10, min_chars=1)
    return out.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.*, s.key IS NOT NULL AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
