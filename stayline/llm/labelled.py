"""Labelled rows for fitting: which rows may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, fold_out: int) -> Column:
    """Whether the label of a row must not be learned from; a null id is not learned from either."""
    return F.coalesce(fold(doc_id, folds) == fold_out, F.lit(True))


def training_labels(
    labels: DataFrame, label: str, folds: int, fold_out: int, rows: int, doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, label) of at most ``rows`` ids outside the held-out fold, the first by a hash of the id.

    Ids with a null or with contradicting labels are left out. The bound makes
    fitting cost the same for every corpus; it is the only place where rows are
    sampled.
    """
    usable = labels.filter(F.col(label).isNotNull() & ~held_out(F.col(doc_id), folds, fold_out))
    return (
        usable.groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("most"))
        .filter("label = most")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
        .select("doc_id", "label")
    )
