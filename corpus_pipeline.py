"""From raw documents to a training mix in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import cube_mixing, decontaminate, simhash_ball, suffix_repeats, toxicity
from stayline.llm.common import stored, table

#: Documents with this toxicity score or more go.
TOXIC = 0.7
#: Repeated passages of this many bytes, about 50 words, are cut out.
PASSAGE_BYTES = 240


def toxic_documents_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go; a null text is scored as one without a match, equal texts alike."""
    scored = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"))
    return scored.filter(F.col("score") < TOXIC).select(*docs.columns)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints within four bits stays: that with the smallest id.

    Null and empty texts have one fingerprint and are one group; where no member
    of a group has an id, or the smallest stands twice, any one row of it stays.
    """
    return simhash_ball.keep_one(docs)


def repeated_passages_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand more than once are cut out of the texts; every document stays, a null text as it is."""
    cut = suffix_repeats.remove_repeats(docs, PASSAGE_BYTES)
    left = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = cut.withColumn("text", left)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn(
            "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return changed.select(*docs.columns)


def benchmark_documents_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; a null text holds none, items without words are in none."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document; a null text has none, a null source is a source of its own."""
    return cube_mixing.mix(docs, keep=["doc_id", "source"])


STAGES = [
    ("toxicity", toxic_documents_out),
    ("simhash_near_dedup", near_duplicates_out),
    ("suffix_array_dedup", repeated_passages_out),
    ("benchmark_decontamination", benchmark_documents_out),
    ("mixing", mixed),
]

#: SQL can't express the learned grammar, the components or the balanced sample; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
