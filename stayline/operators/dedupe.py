"""Duplicates and keys. Losers are dropped before the shuffle, so a hot key stays small."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.columns import nulls_in_row
from stayline.sources.schema import present


def drop_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def keep_most_complete(df: DataFrame, keys: list[str], tie_break: list[str] = ()) -> DataFrame:
    """One row per key: fewest nulls, then the smallest ``tie_break``, then the smallest row.

    Only the first row of each key is asked for, so every map task keeps one row
    per key before the shuffle and a hot key brings one row per task.
    """
    keys = present(df, keys)
    rest = [c for c in df.columns if c not in keys and c not in tie_break]
    window = Window.partitionBy(*keys).orderBy(nulls_in_row(df.columns), *tie_break, *rest)
    ranked = df.withColumn("_place", F.row_number().over(window))
    return ranked.filter(F.col("_place") == 1).drop("_place")


def handle_duplicates(df: DataFrame, keys: list[str] = (), tie_break: list[str] = ()) -> DataFrame:
    """Drop identical rows, then resolve key duplicates."""
    if not keys:
        return drop_exact(df)
    return keep_most_complete(df, keys, tie_break)


def duplicates_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, identical rows dropped and key duplicates dropped, from one shuffle of the rows."""
    folded = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    per_key = folded.groupBy(*keys).agg(F.sum("_copies").alias("_rows"), F.count("*").alias("_distinct"))
    return per_key.agg(
        F.sum("_rows").alias("rows_before"),
        F.sum(F.col("_rows") - F.col("_distinct")).alias("exact_dropped"),
        F.sum(F.col("_distinct") - 1).alias("key_dropped"),
        F.count("*").alias("rows_after"),
    )


def best_per_key(df: DataFrame, key: str, by: str, tie_break: list[str], columns: list[str]) -> DataFrame:
    """Row with the largest ``by`` per key (nulls last); ties go to the largest ``tie_break``."""
    order = F.struct(F.col(by).isNotNull(), F.col(by), *[F.col(c) for c in tie_break])
    rest = [c for c in columns if c != key]
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows of a key that should be unique."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_keys")
    ).withColumn("surplus_rows", F.col("rows") - F.col("distinct_keys"))


class DuplicateKeyError(ValueError):
    """A key that must be unique is not."""


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if not df.groupBy(*keys).count().filter(F.col("count") > 1).isEmpty():
        raise DuplicateKeyError(f"{keys} is not unique")
    return df
