"""The corpus pipeline: documents in, encoded training mix out.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from matchlake.llm import bpe_rounds, mcd_quality, pii_sanitise, pivotal_mixing, simhash_ball
from matchlake.llm.common import read_table, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    names = docs.columns
    assessed = mcd_quality.assess(docs)
    verdict = assessed.columns[-1]
    return assessed.filter(F.col(verdict)["kept"]).select(*names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return simhash_ball.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that disclose it in the texts."""
    names = docs.columns
    clean = pii_sanitise.sanitise(docs)
    text = F.col(clean.columns[-1])["text"]
    changed = {"text": text, "n_chars": F.length(text).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return clean.select(*[changed.get(c, F.col(c)).alias(c) for c in names])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that each source meets its target."""
    names = docs.columns
    mixed = pivotal_mixing.mix(docs)
    copies = F.col(mixed.columns[-1])["copies"].cast("int")
    return mixed.withColumn(mixed.columns[-1], F.explode(F.array_repeat(F.lit(0), copies))).select(*names)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str = public_tokenizers.path("byte_bpe_50k.json")) -> DataFrame:
    """Token ids of every document left, and the text decoded from them."""
    encoded = bpe_rounds.encode(docs, vocabulary, carry=["doc_id", "lang", "source"])
    t = F.col(encoded.columns[-1])
    return encoded.select("doc_id", "lang", "source", F.size(t["ids"]).cast("long").alias("n_tokens"), t["ids"].alias("ids"), t["decoded"].alias("text"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("personal data", personal_data),
    ("mixing", mixing),
    ("byte-level BPE", encoding),
]

#: The fitted estimates, random rounding and merges of the stages have no SQL form;
#: tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
