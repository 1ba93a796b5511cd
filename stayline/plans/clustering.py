"""The clustering table: scaled, complete and encoded client features, and its segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.columns import row_sum, years_before
from stayline.functions.features import CREDIT_TYPES
from stayline.functions.labels import profession_name
from stayline.functions.risk import risk_ever, risk_recent
from stayline.ml.iterative import IterativeImputer
from stayline.ml.preprocess import OneHotEncoder, QuartileScaler
from stayline.operators import clean, missing, outliers, segments
from stayline.plans import columns as lists
from stayline.session import materialise
from stayline.sources.schema import date_columns, numeric_columns, text_columns

REFERENCE_DAY = "2025-11-30"
EXCLUDED_RISK = 7


def cluster_features(abt: DataFrame, reference: str = REFERENCE_DAY) -> DataFrame:
    """Seniority, totals, ratios and risk flags; dates are dropped afterwards."""
    out = abt.withColumns(
        {
            "CLIENT_SENIORITY_YEARS": years_before(reference, "FIRST_DCREAT"),
            "YEARS_SINCE_LAST_CONTRACT": years_before(reference, "LAST_DCREAT"),
            "DIVIDAS_TOTAL_MEDIAN": row_sum([f"DIVIDAS_{t}_MEDIAN" for t in CREDIT_TYPES]),
            "MONTVENC_TOTAL_MAX": row_sum([f"MONTVENC_{t}_MAX" for t in CREDIT_TYPES]),
            "EXTERNAL_TO_OWN": F.col("COUNT_TOTAL_MEDIAN") / (F.col("N_CONTRACTS") + F.lit(1e-6)),
            "RISK_EVER": risk_ever("LAST_RISK"),
            "RISK_RECENT": risk_recent("LAST_RISK"),
            "ALLBD_IDADE_MEAN__N": F.abs("ALLBD_IDADE_MEAN__N"),
        }
    )
    out = out.withColumn("MONTVENC_TOTAL_LOG", F.log1p(F.greatest("MONTVENC_TOTAL_MAX", F.lit(0.0))))
    return out.drop(*date_columns(out))


@dataclass
class ClusterTable:
    table: DataFrame
    rejected: DataFrame


def build_cluster_table(
    abt: DataFrame, reference: str = REFERENCE_DAY, parity: bool = False, imputation_rounds: int = 10
) -> ClusterTable:
    """Clustering features and the rows rejected as outliers.

    Targets and the client id take no part in capping, votes, scaling or
    imputation unless ``parity`` asks for it.
    """
    rows = clean.drop_sparse_rows(abt.drop(*lists.MOSTLY_MISSING), 0.5)
    rows = clean.without_value(cluster_features(rows, reference), "MAX_RISKA", EXCLUDED_RISK)
    aside = ["CONTRIB", "CSP"] + ([] if parity else lists.CLUSTER_TARGETS + ["HAS_ACTIVE"])
    numbers = numeric_columns(rows, tuple(aside))
    voted = numbers + (["CSP"] if parity else [])
    rows = materialise(outliers.cap_narrow_columns(rows, voted))
    rejected, kept = outliers.reject_outlier_rows(rows, voted)
    scaled = QuartileScaler(columns=numbers).fit(kept).transform(kept)
    scaled = missing.fill_text(scaled, columns=text_columns(scaled))
    gone = set(
        lists.CLUSTER_TARGETS + lists.CLUSTER_LEAKS + lists.CLUSTER_REDUNDANT + lists.CLUSTER_CORRELATED
    )
    imputed = IterativeImputer(columns=numbers, maxIter=imputation_rounds).fit(scaled).transform(scaled)
    encoded = OneHotEncoder(columns=["sdem_SITFAM", "sdem_HABITAT"], dropFirst=True).fit(imputed).transform(imputed)
    named = encoded.withColumn("CSP", profession_name("CSP"))
    final = OneHotEncoder(columns=["CSP"]).fit(named).transform(named)
    return ClusterTable(final.drop(*gone), rejected)


def build_segments(
    table: DataFrame, k: int = 3, final: int = 4, starts: int = 10, perspectives: dict | None = None
) -> DataFrame:
    """Cluster labels of each perspective and the merged segment."""
    perspectives = perspectives or segments.PERSPECTIVES
    out = table
    for name, columns in perspectives.items():
        out, _ = segments.assign_clusters(out, columns, f"cluster_{name}", k, starts=starts)
    every = list(dict.fromkeys(c for cols in perspectives.values() for c in cols))
    return segments.merge_segments(out, [f"cluster_{n}" for n in perspectives], every, final)
