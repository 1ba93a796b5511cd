"""Data-quality checks. Each returns a result table and reads the data once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.targets import has_history, not_churned
from stayline.operators.clean import dominant_values
from stayline.operators.profile import dataset_summary, missing_share

TARGETS = ("IS_EARLY_SETTLER", "IS_CHURN")
DATE_ORDER = (
    ("FIRST_DCREAT", "FIRST_D1FIN"),
    ("FIRST_DCREAT", "LAST_DATFIN"),
    ("FIRST_DCREAT", "LAST_DPOS"),
    ("FIRST_DCREAT", "LAST_DCREAT"),
)
# rule name -> (column, lower limit, limit itself allowed)
RANGES = {
    "MAX_DURDEG > 0": ("MAX_DURDEG", 0, False),
    "TOTAL_MENSALIDADE > 0": ("TOTAL_MENSALIDADE", 0, False),
    "TOTAL_MTFINO >= 0": ("TOTAL_MTFINO", 0, True),
    "TOTAL_MTFIN >= 0": ("TOTAL_MTFIN", 0, True),
    "MIN_RANGPRO >= 0": ("MIN_RANGPRO", 0, True),
    "MIN_RANGCLI >= 0": ("MIN_RANGCLI", 0, True),
    "NBENF >= 0": ("NBENF", 0, True),
    "sdem_age > 0": ("sdem_age", 0, False),
    "MAX_RISKA >= 0": ("MAX_RISKA", 0, True),
}


class QualityError(ValueError):
    """A table fails a check it must pass."""


def _checks(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Violations and their percentage of the rows a check applies to."""
    names = list(checks)
    row = df.agg(
        *[F.count(F.when(bad, 1)).alias(f"bad{i}") for i, (bad, _) in enumerate(checks.values())],
        *[F.count(F.when(applies, 1)).alias(f"all{i}") for i, (_, applies) in enumerate(checks.values())],
    )
    entries = [
        F.struct(F.lit(n).alias("check"), F.col(f"bad{i}").alias("violations"), F.col(f"all{i}").alias("checked"))
        for i, n in enumerate(names)
    ]
    return row.select(F.explode(F.array(*entries)).alias("x")).select(
        "x.*", F.coalesce(F.try_divide(F.col("x.violations") * 100.0, F.col("x.checked")), F.lit(0.0)).alias("pct")
    )


def shape_check(df: DataFrame) -> DataFrame:
    return dataset_summary(df).select(
        "rows", "columns", "duplicate_rows", (F.col("rows") > 0).cast("int").alias("non_empty")
    )


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns with nulls, most affected first."""
    return missing_share(df).filter(F.col("missing_pct") > 0)


def overall_missing(df: DataFrame) -> DataFrame:
    nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    row = df.agg(F.count("*").alias("rows"), *nulls)
    cells = sum((F.col(f"n{i}") for i in range(len(df.columns))), F.lit(0))
    some = sum(((F.col(f"n{i}") > 0).cast("int") for i in range(len(df.columns))), F.lit(0))
    empty = sum(((F.col(f"n{i}") == F.col("rows")).cast("int") for i in range(len(df.columns))), F.lit(0))
    return row.select(
        F.coalesce(F.try_divide(cells * 100.0, F.col("rows") * len(df.columns)), F.lit(0.0)).alias("missing_pct"),
        some.alias("columns_with_nulls"),
        empty.alias("empty_columns"),
    )


def require_targets(df: DataFrame, targets=TARGETS) -> DataFrame:
    """Targets exist, hold no null and have two values; no column is empty."""
    absent = [t for t in targets if t not in df.columns]
    if absent:
        raise QualityError(f"missing target columns {absent}")
    row = df.agg(
        F.count("*").alias("rows"),
        *[F.count(c).alias(f"n__{c}") for c in df.columns],
        *[F.count_distinct(t).alias(f"d__{t}") for t in targets],
    ).first()
    empty = [c for c in df.columns if row[f"n__{c}"] == 0]
    if row["rows"] == 0 or empty:
        raise QualityError(f"empty table or empty columns {empty}")
    bad = [t for t in targets if row[f"n__{t}"] != row["rows"] or row[f"d__{t}"] != 2]
    if bad:
        raise QualityError(f"targets with nulls or not binary: {bad}")
    return df


def date_order(df: DataFrame, pairs=DATE_ORDER) -> DataFrame:
    usable = [(a, b) for a, b in pairs if a in df.columns and b in df.columns]
    return _checks(
        df,
        {
            f"{a} <= {b}": (F.col(a) > F.col(b), F.col(a).isNotNull() & F.col(b).isNotNull())
            for a, b in usable
        },
    )


def range_check(df: DataFrame, rules=RANGES) -> DataFrame:
    checks = {}
    for name, (c, limit, inclusive) in rules.items():
        if c in df.columns:
            bad = F.col(c) < limit if inclusive else F.col(c) <= limit
            checks[name] = (bad, F.col(c).isNotNull())
    return _checks(df, checks)


def near_constant_report(df: DataFrame, share: float = 0.99) -> DataFrame:
    """Columns whose top value covers at least ``share`` of the filled rows."""
    return (
        dominant_values(df)
        .filter((F.col("filled_rows") > 0) & (F.col("top_rows") >= F.col("filled_rows") * share))
        .select("column", "top_value", (F.col("top_rows") * 100.0 / F.col("filled_rows")).alias("frequency_pct"))
    )


def target_distribution(df: DataFrame, targets=TARGETS) -> DataFrame:
    """Negatives, positives and their ratio, over all rows and over the settled population."""
    entries = F.array(
        *[
            F.struct(F.lit(p).alias("population"), F.lit(t).alias("target"), F.col(t).alias("value"), keep.alias("keep"))
            for p, keep in {"all": F.lit(True), "settled": has_history()}.items()
            for t in targets
        ]
    )
    counted = (
        df.select(F.explode(entries).alias("x"))
        .where("x.keep")
        .groupBy("x.population", "x.target")
        .agg(F.count("*").alias("rows"), F.sum("x.value").alias("positives"))
    )
    negatives = F.col("rows") - F.col("positives")
    return counted.select(
        "population",
        "target",
        "rows",
        "positives",
        negatives.alias("negatives"),
        (F.col("positives") * 100.0 / F.col("rows")).alias("positive_pct"),
        F.try_divide(negatives.cast("double"), F.col("positives")).alias("imbalance"),
    )


def target_sanity(df: DataFrame, targets=TARGETS) -> DataFrame:
    row = df.agg(
        *[F.count_distinct(t).alias(f"d{i}") for i, t in enumerate(targets)],
        *[F.count(F.when(F.col(t).isNull(), 1)).alias(f"n{i}") for i, t in enumerate(targets)],
    )
    entries = [
        F.struct(F.lit(t).alias("target"), F.col(f"d{i}").alias("distinct_values"), F.col(f"n{i}").alias("nulls"))
        for i, t in enumerate(targets)
    ]
    return row.select(F.explode(F.array(*entries)).alias("x")).select(
        "x.*", ((F.col("x.distinct_values") == 2) & (F.col("x.nulls") == 0)).cast("int").alias("ok")
    )


def scoring_population(df: DataFrame) -> DataFrame:
    count = lambda mask: F.count(F.when(mask, 1))
    return df.agg(
        F.count("*").alias("clients"),
        count(has_history()).alias("trainable"),
        count(not_churned()).alias("active"),
        count(not_churned() & has_history()).alias("active_with_history"),
        count(not_churned() & ~has_history()).alias("active_without_history"),
    )


def high_missing(df: DataFrame, threshold: float = 30.0) -> DataFrame:
    return missing_share(df, threshold)
