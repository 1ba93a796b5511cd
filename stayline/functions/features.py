"""Derived client features, grouped so that a caller asks for what it can feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.columns import clip, days_between, flag, ratio, row_sum
from stayline.functions.labels import HOUSING_STABILITY, PARTNERED_CODES, lookup
from stayline.functions.risk import months_at_current_risk, risk_trend, risk_volatility

CREDIT_TYPES = ("CL", "CP", "AUTO", "HT")
AVERAGE_MONTH_DAYS = 30.44
SCORE_LETTERS = 24  # A .. X
AGE_EDGES = (0, 25, 35, 45, 55, 65, 120)
AGE_LABELS = ("<25", "25-34", "35-44", "45-54", "55-64", "65+")
CONTRACT_DATES = ("DPOS", "DCREAT", "DATFIN", "D1FIN", "DCSP")


def letter_rank(c: Column | str, letters: int, first: int = 0) -> Column:
    """Position of a single letter A.. within ``letters``, null outside."""
    letter = F.upper(F.trim(F.col(c) if isinstance(c, str) else c))
    rank = F.ascii(letter) - 65
    return F.when((F.length(letter) == 1) & rank.between(0, letters - 1), rank + first)


def score_ordinal(c: Column | str, letters: int = SCORE_LETTERS) -> Column:
    """Score letter as 0, 1, 2 ...; ``letters=8`` gives the A-H range only."""
    return letter_rank(c, letters)


def behavioural_score(c: Column | str) -> Column:
    """Score letter as 1..24, missing or unlisted as 25."""
    return F.coalesce(letter_rank(c, SCORE_LETTERS, first=1), F.lit(SCORE_LETTERS + 1))


def score_risk_mismatch(score: Column | str, position: Column | str) -> Column:
    position = F.col(position) if isinstance(position, str) else position
    return flag(letter_rank(score, 5).isNotNull() & position.isin(3, 4, 5))


def age_bucket(c: Column | str) -> Column:
    """Left-closed age bands; outside or missing reads ``nan``."""
    c = F.col(c) if isinstance(c, str) else c
    out = F
    for lo, hi, label in zip(AGE_EDGES, AGE_EDGES[1:], AGE_LABELS):
        out = out.when((c >= lo) & (c < hi), label)
    return out.otherwise("nan")


def housing_stability(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(lookup(F.upper(c), HOUSING_STABILITY), F.lit(0))


def is_partnered(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return flag(F.upper(c).isin(*PARTNERED_CODES))


def contract_age_months(end: Column | str, start: Column | str) -> Column:
    return clip(days_between(end, start) / F.lit(AVERAGE_MONTH_DAYS), 0.0)


def lifecycle_percent(age_months: Column | str, duration: Column | str) -> Column:
    return clip(ratio(age_months, duration), 0.0, 1.0) * 100


def loan_to_income(loan: Column | str, income: Column | str, cap: float | None = 50.0) -> Column:
    income = F.col(income) if isinstance(income, str) else income
    value = ratio(loan, income)
    return F.when(income > 0, value) if cap is None else clip(value, 0.0, cap)


def instalment_to_income(instalment: Column | str, income: Column | str) -> Column:
    return clip(ratio(instalment, income), 0.0, 2.0)


def lifecycle_stage(years_since_last: Column | str, duration: Column | str) -> Column:
    """Share of the usual contract length already elapsed."""
    years = F.col(years_since_last) if isinstance(years_since_last, str) else years_since_last
    duration = F.col(duration) if isinstance(duration, str) else duration
    return clip(years * 12 / (duration + F.lit(1e-6)), 0.0, 1.0)


class FeatureError(ValueError):
    """A feature group was asked for without the columns it needs."""


def _present(df: DataFrame, prefix: str) -> list[str]:
    return [f"{prefix}_{t}" for t in CREDIT_TYPES if f"{prefix}_{t}" in df.columns]


def capacity_features(df: DataFrame) -> dict[str, Column]:
    return {
        "DTI_RATIO": clip(ratio("MT_MENSAL", "RESSO"), 0.0),
        "TOTAL_DEBT_BURDEN": row_sum(_present(df, "DIVIDAS")),
        "EXTERNAL_OVERDUE_FLAG": flag(row_sum(_present(df, "MONTVENC")) > 0),
        "INSTALMENT_TO_CAPITAL": clip(ratio("MENSALIDADE", "CRD"), 0.0),
        "INCOME_BUFFER": clip(ratio(F.col("RESSO") - F.col("MENSALIDADE"), "RESSO"), -1.0, 1.0),
    }


def relationship_features(df: DataFrame) -> dict[str, Column]:
    return {
        "MULTI_PRODUCT_FLAG": flag(row_sum(["ALLBD_N_CL__N", "ALLBD_N_CP__N"]) > 1),
        "ACTIVE_CONTRACT_COUNT": row_sum(["ALLBD_A_CL__N", "ALLBD_A_CP__N"]),
        "RELATIONSHIP_TENURE": F.col("ALLBD_IDADE_MSA__N"),
        "NEW_CONTRACT_RECENCY": F.col("ALLBD_IDADE_MIN__N"),
        "EVENT_FREQUENCY": clip(ratio("ALLBD_N_events__N", "ALLBD_IDADE_MEAN__N"), 0.0),
    }


def external_features(df: DataFrame) -> dict[str, Column]:
    overdue = row_sum(_present(df, "MONTVENC"))
    return {
        "CREDIT_CONCENTRATION": clip(ratio("COUNT_CL", "COUNT_TOTAL"), 0.0, 1.0),
        "WRITEOFF_HISTORY_FLAG": flag(row_sum(_present(df, "MONTABATV")) > 0),
        "OVERDUE_TO_DEBT_RATIO": clip(ratio(overdue, row_sum(_present(df, "DIVIDAS"))), 0.0, 1.0),
    }


def scoring_features(df: DataFrame) -> dict[str, Column]:
    return {
        "BEHAVIORAL_SCORE_NUM": behavioural_score("kp_sqe"),
        "SCORE_RISK_MISMATCH": score_risk_mismatch("kp_sqe", "RISKA"),
    }


def demographic_features(df: DataFrame) -> dict[str, Column]:
    return {
        "AGE_BUCKET": age_bucket("sdem_age"),
        "HOUSING_STABILITY_SCORE": housing_stability("sdem_HABITAT"),
        "IS_PARTNERED": is_partnered("sdem_SITFAM"),
    }


def lifecycle_features(df: DataFrame) -> dict[str, Column]:
    """Opt-in: these read end-of-contract state and leak into the targets."""
    age = contract_age_months("DPOS", "DCREAT")
    remaining = clip(ratio("MTFIN", "MENSALIDADE"), 0.0)
    return {
        "REPAYMENT_RATIO": clip(ratio(F.col("MTFINO") - F.col("CRD"), "MTFINO"), 0.0, 1.0),
        "CONTRACT_AGE_MONTHS": age,
        "REMAINING_TERM_MONTHS": remaining,
        "LIFECYCLE_RATIO": clip(ratio(age, age + remaining), 0.0, 1.0),
        "OVERPAYMENT_RATIO": clip(ratio("MENSALIDADE_CORR", "MENSALIDADE"), 0.0),
        "REGULARIZATION_COMPLETION": clip(ratio("RANGPRO", "DURDEG"), 0.0, 1.0),
        "DELAY_INTENSITY": clip(ratio("RANGCLI", age), 0.0),
    }


def risk_history_features(df: DataFrame) -> dict[str, Column]:
    return {
        "RISK_TREND_3M": risk_trend("RISK"),
        "RISK_VOLATILITY_12M": risk_volatility("RISK"),
        "MONTHS_AT_CURRENT_RISK": months_at_current_risk("RISK"),
    }


def settle_propensity() -> Column:
    """Weighted early-settlement score over capacity, lifecycle and scoring features."""
    score = 1 - (F.col("BEHAVIORAL_SCORE_NUM") - 1) / 24
    return (
        0.30 * F.col("REPAYMENT_RATIO")
        + 0.20 * (1 - clip("DTI_RATIO", 0.0, 1.0))
        + 0.20 * F.col("LIFECYCLE_RATIO")
        + 0.15 * clip("OVERPAYMENT_RATIO", hi=2.0) / 2
        + 0.15 * score
    )


def churn_composite() -> Column:
    """Weighted churn score over delay, overdue, activity and trend features."""
    inactivity = 1 - clip("ACTIVE_CONTRACT_COUNT", hi=5.0) / 5
    return (
        0.25 * clip("DELAY_INTENSITY", hi=1.0)
        + 0.20 * F.col("EXTERNAL_OVERDUE_FLAG")
        + 0.20 * inactivity
        + 0.20 * (1 - F.col("RISK_TREND_3M")) / 2
        + 0.15 * clip("DTI_RATIO", hi=1.0)
    )


FEATURE_GROUPS = {
    "capacity": capacity_features,
    "relationship": relationship_features,
    "external": external_features,
    "scoring": scoring_features,
    "demographics": demographic_features,
    "contract_lifecycle": lifecycle_features,
    "risk_history": risk_history_features,
}
DEFAULT_GROUPS = ("capacity", "relationship", "external", "scoring", "demographics")


def add_features(
    df: DataFrame,
    groups: tuple[str, ...] = DEFAULT_GROUPS,
    composites: bool = False,
    drop_dates: bool = True,
) -> DataFrame:
    """Append the feature groups in one projection.

    Composite scores need ``contract_lifecycle`` and ``risk_history``.
    """
    if composites and not {"contract_lifecycle", "risk_history"} <= set(groups):
        raise FeatureError("composite scores need the contract_lifecycle and risk_history groups")
    columns: dict[str, Column] = {}
    for group in groups:
        columns |= FEATURE_GROUPS[group](df)
    out = df.withColumns(columns)
    if composites:
        out = out.withColumns(
            {"EARLY_SETTLE_PROPENSITY": settle_propensity(), "CHURN_RISK_COMPOSITE": churn_composite()}
        )
    return out.drop(*CONTRACT_DATES) if drop_dates else out


def created_columns(before: DataFrame, after: DataFrame) -> list[str]:
    return sorted(set(after.columns) - set(before.columns))
