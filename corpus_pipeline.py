"""Training-corpus pipeline: five stages, each one of the operators in shelfwise/llm.

A stage takes (spark, docs, sf_dir) and returns what it keeps; every stage but
the last returns the columns of ``documents``. ``run`` writes each result as
Parquet into the shared folder and reads it back for the next stage, so a
stage that fails is repeated from its predecessor's table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import op02_quality_mil, op03_ngram_jaccard, op05_sentencepiece, op08_decontamination, op09_pii
from shelfwise.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier rejects; it learns from the labelled documents among ``docs``."""
    return op02_quality_mil.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles at a Jaccard similarity of 0.8."""
    return op03_ngram_jaccard.deduplicate(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return op08_decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; n_chars follows the new text."""
    out = op09_pii.pseudonymize(docs)
    return out.selectExpr(*[f"cast(length(text) as {docs.schema[c].dataType.simpleString()}) as n_chars"
                            if c == "n_chars" else f"`{c}`" for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the final texts."""
    return op05_sentencepiece.digests(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("pseudonyms", pseudonyms), ("tokens", tokens)]

#: Stages 1, 4 and 5 (a trained classifier, keyed hashes, a tokenizer) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
