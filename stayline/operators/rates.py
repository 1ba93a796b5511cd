"""Target rates and profiles over client groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.columns import clip, flag, month_key, quarter_key, ratio
from stayline.operators.profile import top_categories
from stayline.operators.quantiles import group_quantiles
from stayline.sources.schema import present

SETTLER, CHURN = "IS_EARLY_SETTLER", "IS_CHURN"
PROFILE_COLUMNS = ("MEDIAN_RESSO", "TOTAL_MTFINO", "MEDIAN_DURDEG", "N_CONTRACTS")
QUADRANT_COLUMNS = (
    "MEDIAN_RESSO",
    "TOTAL_MTFINO",
    "TOTAL_MENSALIDADE",
    "MEDIAN_DURDEG",
    "MAX_RISKA",
    "N_CONTRACTS",
)
DEBT_COLUMNS = ("DIVIDAS_CL_MEDIAN", "DIVIDAS_CP_MEDIAN", "DIVIDAS_AUTO_MEDIAN", "DIVIDAS_HT_MEDIAN")
STAGES = ((0, 25, "0-25%"), (25, 50, "25-50%"), (50, 75, "50-75%"), (75, 100, "75-100%"))


def _key(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grouped_rate(df: DataFrame, key: Column | str, target: str, min_rows: int = 20) -> DataFrame:
    """Rate in percent and volume per key; keys under ``min_rows`` are left out."""
    return (
        df.select(_key(key).alias("key"), F.col(target).alias("t"))
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg((F.avg("t") * 100).alias("rate_pct"), F.count("t").alias("clients"))
        .filter(F.col("clients") >= min_rows)
    )


def category_rate(
    df: DataFrame, key: Column | str, target: str, top: int = 10, min_rows: int = 20
) -> DataFrame:
    """The ``top`` keys by rate, flagged where above the median of the shown rates."""
    shown = grouped_rate(df, key, target, min_rows).orderBy(F.desc("rate_pct"), "key").limit(top)
    median = F.median("rate_pct").over(Window.partitionBy(F.lit(1)))
    return shown.withColumn("above_median", flag(F.col("rate_pct") > median))


def top_category_rate(
    df: DataFrame, column: str, target: str, categories: int = 10, top: int = 10, min_rows: int = 20
) -> DataFrame:
    """Category rate over the most frequent categories only."""
    return category_rate(only_top_categories(df, column, categories), column, target, top, min_rows)


def only_top_categories(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Rows whose value is among the ``n`` most frequent."""
    return df.join(F.broadcast(top_categories(df, column, n).select(column)), column, "left_semi")


def rate_by_month(df: DataFrame, date: str, target: str, min_rows: int = 20) -> DataFrame:
    return grouped_rate(df, month_key(date), target, min_rows)


def rate_by_cohort(df: DataFrame, date: str, target: str, min_rows: int = 30) -> DataFrame:
    return grouped_rate(df, quarter_key(date), target, min_rows)


def rate_by_season(df: DataFrame, date: str, target: str, min_rows: int = 20) -> DataFrame:
    return grouped_rate(df, F.month(date), target, min_rows)


def rate_by_stage(df: DataFrame, percent: Column | str, target: str) -> DataFrame:
    """Rate per quarter of the contract, empty quarters included."""
    p = _key(percent)
    stage = F
    for lo, hi, name in STAGES:
        stage = stage.when((p >= lo if lo == 0 else p > lo) & (p <= hi), name)
    row = df.select(stage.alias("s"), F.col(target).alias("t")).agg(
        *[f(F.when(F.col("s") == n, F.col("t"))).alias(f"{m}{i}")
          for i, (_, _, n) in enumerate(STAGES) for m, f in (("r", F.avg), ("n", F.count))]
    )
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(n).alias("stage"),
            (F.col(f"r{i}") * 100).alias("rate_pct"),
            F.col(f"n{i}").alias("clients"),
        )
        for i, (_, _, n) in enumerate(STAGES)
    ]
    return row.select(F.explode(F.array(*entries)).alias("x")).select("x.*")


def mean_profile(df: DataFrame, target: str, columns=PROFILE_COLUMNS) -> DataFrame:
    """Mean per target value and its share of the largest group mean."""
    columns = present(df, columns)
    means = (
        df.where(F.col(target).isNotNull())
        .groupBy(target)
        .agg(*[F.avg(c).alias(c) for c in columns])
        .unpivot([target], columns, "measure", "mean")
    )
    largest = F.max("mean").over(Window.partitionBy("measure"))
    return means.withColumn("relative", ratio(F.col("mean"), largest))


def median_by_target(df: DataFrame, target: str, columns=DEBT_COLUMNS) -> DataFrame:
    columns = present(df, columns)
    wide = group_quantiles(df, [target], {c: (c, 0.5) for c in columns})
    return wide.unpivot([target], columns, "measure", "median")


def outcome_matrix(df: DataFrame) -> DataFrame:
    """Early settlement by churn: clients, share, and churn rate within the settlement group."""
    counts = (
        df.na.drop(subset=[SETTLER, CHURN]).groupBy(SETTLER, CHURN).agg(F.count("*").alias("clients"))
    )
    everyone = F.sum("clients").over(Window.partitionBy(F.lit(1)))
    group = Window.partitionBy(SETTLER)
    churned = F.sum(F.when(F.col(CHURN) == 1, F.col("clients")).otherwise(0)).over(group)
    return counts.select(
        SETTLER,
        CHURN,
        "clients",
        (F.col("clients") * 100.0 / everyone).alias("share_pct"),
        (churned * 100.0 / F.sum("clients").over(group)).alias("group_churn_pct"),
    )


def quadrant_profile(df: DataFrame, columns=QUADRANT_COLUMNS) -> DataFrame:
    """Mean of min-max scaled columns per outcome quadrant.

    A mean of scaled values is the scaled mean, so limits and means come from one
    aggregation of the rows. A constant column reads 0.5.
    """
    columns = present(df, columns)
    side = F.when(F.col(SETTLER) == 1, "SAN").otherwise("Mat")
    end = F.when(F.col(CHURN) == 1, "Churned").otherwise("Renewed")
    groups = (
        df.na.drop(subset=[SETTLER, CHURN])
        .groupBy(F.concat(side, F.lit("+"), end).alias("quadrant"))
        .agg(
            *[F.avg(c).alias(f"m__{c}") for c in columns],
            *[F.min(c).cast("double").alias(f"lo__{c}") for c in columns],
            *[F.max(c).cast("double").alias(f"hi__{c}") for c in columns],
        )
    )
    all_groups = Window.partitionBy(F.lit(1))
    scaled = []
    for c in columns:
        lo, hi = F.min(f"lo__{c}").over(all_groups), F.max(f"hi__{c}").over(all_groups)
        scaled.append(F.when(hi > lo, (F.col(f"m__{c}") - lo) / (hi - lo)).otherwise(0.5).alias(c))
    return groups.select("quadrant", *scaled)


def two_target_rates(df: DataFrame, column: str, categories: int | None = None) -> DataFrame:
    """Settlement and churn rate side by side per value."""
    if categories is not None:
        df = only_top_categories(df, column, categories)
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg((F.avg(SETTLER) * 100).alias("settler_pct"), (F.avg(CHURN) * 100).alias("churn_pct"))
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per value, nulls left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy(F.lit(1))))


def weighted_averages(df: DataFrame, columns: list[str], weight: str) -> DataFrame:
    """Weighted mean per column over the rows where it is filled."""
    return df.agg(
        *[
            F.try_divide(
                F.sum(F.col(c) * F.col(weight)), F.sum(F.when(F.col(c).isNotNull(), F.col(weight)))
            ).alias(c)
            for c in columns
        ]
    )


def share_where(predicate: Column) -> Column:
    """Share of rows that satisfy the predicate, unknown as no."""
    return F.avg(flag(predicate).cast("double"))


def segment_outcomes(df: DataFrame, segment: str = "segment_final") -> DataFrame:
    """Clients, settlement and churn rates per segment."""
    return (
        df.where(F.col(segment).isNotNull())
        .groupBy(segment)
        .agg(
            F.count(CHURN).alias("clients"),
            (F.avg(SETTLER) * 100).alias("settler_pct"),
            F.avg("N_SAN").alias("avg_n_san"),
            (F.avg(CHURN) * 100).alias("churn_pct"),
            (F.avg("CHURN_EARLY") * 100).alias("churn_early_pct"),
            (F.avg("CHURN_NATURAL") * 100).alias("churn_natural_pct"),
        )
    )


def exposure_columns(df: DataFrame) -> DataFrame:
    """Debt-to-income, loan-to-income and income range of a client."""
    return df.withColumns(
        {
            "DTI": clip(ratio("TOTAL_MENSALIDADE", "MEDIAN_RESSO"), 0.0, 2.0),
            "LTI": clip(ratio("TOTAL_MTFINO", "MEDIAN_RESSO"), 0.0, 50.0),
            "INCOME_RANGE": F.col("MAX_RESSO") - F.col("MIN_RESSO"),
        }
    )


def outcome_group() -> Column:
    """Settler, churner or neither, for side-by-side curves. A client may be in two groups."""
    return F.explode(
        F.filter(
            F.array(
                F.when(F.col(SETTLER) == 1, F.lit("settler")),
                F.when(F.col(CHURN) == 1, F.lit("churner")),
                F.when((F.col(SETTLER) == 0) & (F.col(CHURN) == 0), F.lit("neither")),
            ),
            lambda x: x.isNotNull(),
        )
    )
