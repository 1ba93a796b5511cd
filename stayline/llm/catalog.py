"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import cube_mixing, decontaminate, labelled, licenses, quality_gam, quality_rules, ranked_search, simhash_ball, statements, suffix_repeats, token_alignment, token_cache, token_files, toxicity, warc
from stayline.llm.common import table, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document; each call fills a cache of its own."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.octet_length(text_of()).cast("long").alias("n_bytes")
    )
    counted = token_cache.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op2_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    ruled = quality_rules.quality_rules(table(spark, folder, "documents"), keep=["doc_id"])
    return ruled.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_gam.quality_scores(
        table(spark, folder, "documents"), table(spark, folder, "labels"), folds=4, fold_out=2, keep=["doc_id"]
    )
    return scored.select(
        "doc_id",
        labelled.held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.toxicity_scores(
        table(spark, folder, "documents"), table(spark, folder, "labels"), folds=3, fold_out=1, keep=["doc_id"]
    )
    return scored.select(
        "doc_id",
        labelled.held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = cube_mixing.mix(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    kind = pages.schema["page_id"].dataType
    return warc.archive_and_read(pages).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_ball.near_duplicates(table(spark, folder, "documents"), keep=["doc_id"])
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op10_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = suffix_repeats.remove_repeats(docs, 400, keep=["doc_id"], with_text=False)
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed_spans").cast("long").alias("n_spans"), "kept_sha256"
    )


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, table(spark, folder, "benchmark"), keep=["doc_id"])


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    manifest = token_files.write_ids(docs, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_documents(manifest, docs.select("doc_id").schema, with_ids=False)


@query
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    index = ranked_search.build_index(table(spark, folder, "documents").select("doc_id", "text"))
    return ranked_search.ranked(index, table(spark, folder, "benchmark").select("item_id", "text"), 50)


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    paths = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    found = token_alignment.linked_alignments(docs, *paths, keep=["doc_id"])
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


ORACLES["op2_license_scans"] = statements.LICENSES
ORACLES["op12_ranked_search"] = statements.RANKED
ORACLES["op8_decontamination"] = statements.CONTAINED
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
