"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, mixing
to target weights, packing.

`STAGES` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns the rows that go on, with the columns of `documents`;
the last returns the packed pieces.

Defined cases: texts that are null or hold no letter are rejected by the
first stage, all others pass it; lines found in at least 10 documents go;
of each group of near copies the row with the smallest id stays; the mix
drops or repeats whole documents (a repeated document is several rows);
extra columns pass through; an empty table stays empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glint.llm.common import save_table
from glint.llm.langid import identify, language_model
from glint.llm.line_dedup import line_dedup
from glint.llm.mixing import by_turns, mix_sources
from glint.llm.packing import pack_pieces, token_pieces
from glint.llm.simhash import keep_one


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: texts of no language go. The flag for ambiguous texts
    rejects nothing: a short or mixed text may be clean."""
    found = identify(language_model(docs), F.col("text"))
    return docs.withColumn("_found", found).where("_found.lang_pred <> 'und'").select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines found in 10 documents or more go; `n_chars` follows
    the text."""
    out = line_dedup(docs, min_docs=10, min_chars=1)
    new = {"text": F.col("kept"), "n_chars": F.coalesce(F.length("kept").cast("long"), F.col("n_chars"))}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group stays."""
    return keep_one(docs, shingle=3, bits=3, seed=42)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents are dropped or repeated to meet the targets."""
    out = mix_sources(docs, F.array("source"), by_turns).where("_copies > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: sequences of at most 2048 tokens."""
    import public_tokenizers

    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end=0)
    return pack_pieces(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), size=2048)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", drop_shared_lines),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: The stages are not expressible in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
