"""Profiling reports. Each reads the table once or twice for all columns together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.operators.quantiles import column_quantiles, group_quantiles
from stayline.sources.schema import date_columns, numeric_columns, text_columns

SUMMARY_PROBABILITIES = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of identical rows."""
    return df.groupBy(*df.columns).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, columns by kind, missing cells and duplicate rows.

    Identical rows are folded first, so one shuffle serves all the counts.
    """
    missing = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0))
    folded = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    width = len(df.columns)
    return folded.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.lit(width).cast("long").alias("columns"),
        F.lit(len(numeric_columns(df))).cast("long").alias("numeric_columns"),
        F.lit(len(text_columns(df))).cast("long").alias("text_columns"),
        F.lit(len(date_columns(df))).cast("long").alias("date_columns"),
        F.coalesce(F.sum(missing * F.col("_copies")), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    ).withColumn(
        "missing_pct",
        F.coalesce(F.try_divide(F.col("missing_cells") * 100.0, F.col("rows") * width), F.lit(0.0)),
    )


def _long(row: DataFrame, columns: list[str], *measures: str) -> DataFrame:
    """One wide aggregate row (``<measure>__<column>``) to one row per column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{m}__{c}").alias(m) for m in measures])
        for c in columns
    ]
    return row.select(F.explode(F.array(*entries)).alias("x")).select("x.*")


def missing_share(df: DataFrame, threshold: float = 0.0, columns: list[str] | None = None) -> DataFrame:
    """Missing percentage per column, at or above ``threshold`` percent."""
    columns = columns or df.columns
    row = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(f"missing_pct__{c}") for c in columns])
    return (
        _long(row, columns, "missing_pct")
        .filter(F.col("missing_pct") >= threshold)
        .orderBy(F.desc("missing_pct"), "column")
    )


def columns_missing(df: DataFrame, threshold: float) -> list[str]:
    """Names of columns with at least ``threshold`` percent missing."""
    found = {r["column"] for r in missing_share(df, threshold).collect()}
    return [c for c in df.columns if c in found]


def histogram(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """Equal-width bins per numeric column; the last bin is closed on the right."""
    limits = df.agg(
        *[F.min(c).cast("double").alias(f"lo__{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"hi__{c}") for c in columns],
    ).first()
    entries = []
    for c in columns:
        lo, hi = limits[f"lo__{c}"], limits[f"hi__{c}"]
        if lo is None:
            continue
        lo, hi = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
        entries.append(F.struct(F.lit(c).alias("column"), bin_index(F.col(c), lo, hi, bins).alias("bin")))
    return (
        df.select(F.explode(F.array(*entries)).alias("x"))
        .select("x.*")
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count("*").alias("rows"))
    )


def bin_index(c: Column, lo: float, hi: float, bins: int) -> Column:
    position = F.floor((c.cast("double") - lo) * bins / (hi - lo))
    return F.when(c.isNotNull(), F.least(F.greatest(position, F.lit(0)), F.lit(bins - 1)))


def boxplot(df: DataFrame, columns: list[str]) -> DataFrame:
    """Five-number summary per column."""
    specs = {f"{name}__{c}": (c, p) for c in columns for name, p in SUMMARY_PROBABILITIES.items()}
    return _long(group_quantiles(df, [], specs), columns, *SUMMARY_PROBABILITIES)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, quartiles and limits per column."""
    specs = {f"{name}__{c}": (c, p) for c in columns for name, p in SUMMARY_PROBABILITIES.items()}
    moments = df.agg(
        *[
            measure(c).alias(f"{name}__{c}")
            for c in columns
            for name, measure in {"count": F.count, "mean": F.avg, "std": F.stddev_samp}.items()
        ]
    )
    values = column_quantiles(df, specs)
    row = moments.withColumns({k: F.lit(v).cast("double") for k, v in values.items()})
    return _long(row, columns, "count", "mean", "std", *SUMMARY_PROBABILITIES)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def category_counts(df: DataFrame, columns: list[str], max_categories: int = 10) -> DataFrame:
    """Value counts of the columns that have at most ``max_categories`` values.

    Values are counted in one aggregation; the guard then looks at the number of
    counted values of each column.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.explode(entries).alias("x"))
        .select("x.*")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("rows"))
    )
    few = counts.groupBy("column").agg(F.count("*").alias("values")).filter(F.col("values") <= max_categories)
    return counts.join(F.broadcast(few.select("column")), "column", "left_semi")


def top_categories(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values; equal counts in value order."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), column)
        .limit(n)
    )


def date_part_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per year, per month and per weekday name."""
    parts = F.array(
        F.struct(F.lit("year").alias("part"), F.year(column).cast("string").alias("value")),
        F.struct(F.lit("month").alias("part"), F.month(column).cast("string").alias("value")),
        F.struct(F.lit("weekday").alias("part"), F.date_format(column, "EEEE").alias("value")),
    )
    return (
        df.where(F.col(column).isNotNull())
        .select(F.explode(parts).alias("x"))
        .groupBy("x.part", "x.value")
        .agg(F.count("*").alias("rows"))
    )


def column_types(df: DataFrame) -> DataFrame:
    """Name, type and position of every column."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def type_counts(df: DataFrame) -> DataFrame:
    return column_types(df).groupBy("type").agg(F.count("*").alias("columns"))


def density_curve(
    df: DataFrame,
    column: str,
    group: Column,
    points: int = 300,
    tails: tuple[float, float] = (0.01, 0.99),
    min_rows: int = 20,
) -> DataFrame:
    """Gaussian density of ``column`` on an even grid, per group.

    Values are clipped to the tail quantiles first and the bandwidth follows
    Scott's rule. Equal values are counted once, and each task
    adds them up on the grid before anything is exchanged.
    Groups under ``min_rows`` give no curve.
    """
    rows = df.select(group.alias("group"), F.col(column).cast("double").alias("v")).na.drop()
    limits = group_quantiles(rows, ["group"], {"lo": ("v", tails[0]), "hi": ("v", tails[1])})
    clipped = rows.join(F.broadcast(limits), "group").select(
        "group", F.least(F.greatest("v", "lo"), F.col("hi")).alias("v")
    )
    counted = clipped.groupBy("group", "v").agg(F.count("*").cast("double").alias("w"))
    shape = (
        counted.groupBy("group")
        .agg(
            F.sum("w").alias("n"),
            F.sum(F.col("w") * F.col("v")).alias("s1"),
            F.min("v").alias("lo"),
            F.max("v").alias("hi"),
        )
        .filter(F.col("n") >= min_rows)
        .withColumn("mean", F.col("s1") / F.col("n"))
    )
    spread = (
        counted.join(F.broadcast(shape), "group")
        .groupBy("group", "n", "lo", "hi", "mean")
        .agg(F.sum(F.col("w") * F.pow(F.col("v") - F.col("mean"), F.lit(2))).alias("ss"))
        .withColumn("h", F.sqrt(F.col("ss") / (F.col("n") - 1)) * F.pow("n", F.lit(-0.2)))
        .filter(F.col("h") > 0)
    )
    held = counted.join(F.broadcast(spread), "group").select("group", "v", "w", "n", "h", "mean", "lo", "hi")
    kind = held.schema["group"].dataType.simpleString()
    folded = held.mapInPandas(_folded(points), f"group {kind}, n double, h double, mean double, lo double, hi double, cells array<double>")
    by_point = folded.select("group", "n", "h", "mean", "lo", "hi", F.posexplode("cells").alias("point", "k"))
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    return (
        by_point.groupBy("group", "point", "n", "h", "mean", "lo", "hi")
        .agg(F.sum("k").alias("k"))
        .select(
            "group",
            "point",
            (F.col("lo") + F.col("point") * step).alias("x"),
            (F.col("k") / (F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
            "mean",
        )
    )


def _folded(points: int):
    """Kernel sums on the grid of each group: a task sends one array per group, whatever its rows."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, rows in batch.groupby(["group", "n", "h", "mean", "lo", "hi"], dropna=False, sort=False):
                _, _, h, _, lo, hi = key
                grid = lo + np.arange(points) * ((hi - lo) / (points - 1))
                cells = sums.setdefault(key, np.zeros(points))
                v, w = rows["v"].to_numpy(), rows["w"].to_numpy()
                for at in range(0, len(v), 4096):
                    away = (grid[:, None] - v[None, at : at + 4096]) / h
                    cells += np.exp(-0.5 * away * away) @ w[at : at + 4096]
        if sums:
            names = ["group", "n", "h", "mean", "lo", "hi"]
            yield pd.DataFrame([dict(zip(names, key)) | {"cells": cells} for key, cells in sums.items()])

    return fold


def probability_histogram(df: DataFrame, probability: str, label: str, bins: int = 50) -> DataFrame:
    """Histogram of scores by true label, each label summing to 1."""
    low, high = df.agg(F.min(probability), F.max(probability)).first()
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    counted = (
        df.where(F.col(probability).isNotNull() & F.col(label).isNotNull())
        .groupBy(label, bin_index(F.col(probability), low, high, bins).alias("bin"))
        .agg(F.count("*").alias("rows"))
    )
    return counted.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy(label)))
