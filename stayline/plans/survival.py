"""Survival study of the settled clients."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.targets import has_history
from stayline.ml.preprocess import ClientImputer, OneHotEncoder, OutlierHandler
from stayline.operators import survival
from stayline.operators.clean import constant_columns
from stayline.operators.profile import columns_missing
from stayline.plans import columns as lists
from stayline.session import materialise

DURATION, EVENT, KEY = "TIME_TO_CHURN_D", "IS_CHURN", "CONTRIB"
CATEGORIES = ["sdem_SITFAM", "sdem_HABITAT", "CSP", "PRODALP"]


def survival_frame(abt: DataFrame) -> tuple[DataFrame, list[str]]:
    """Features of settled clients with duration and event; the client id stays the key."""
    settled = abt.filter(has_history())
    sparse = columns_missing(settled, 30.0)
    keep = [c for c in settled.columns if c not in {*lists.leaking(EVENT), *sparse}]
    aside = [KEY, DURATION, EVENT]
    rows = settled.select(KEY, F.col(DURATION), F.col(EVENT), *keep)
    handler = OutlierHandler(exclude=["CSP", *aside]).fit(rows)
    blanked = handler.transform(rows)
    imputed = ClientImputer(keep=[*aside, "CSP"]).fit(blanked).transform(blanked)
    encoded = materialise(OneHotEncoder(columns=CATEGORIES).fit(imputed).transform(imputed))
    features = [c for c in encoded.columns if c not in aside]
    constant = set(constant_columns(encoded, features))
    features = [c for c in features if c not in constant]
    return encoded.select(*aside, *features), features


@dataclass
class SurvivalStudy:
    curve: DataFrame
    grouped_curve: DataFrame
    logrank_chi2: float
    logrank_p: float
    model: survival.CoxModel
    c_index: float


def survival_study(abt: DataFrame, penalty: float = 0.1) -> SurvivalStudy:
    """Curves, group test, hazard model and its concordance."""
    settled = abt.filter(has_history())
    frame, features = survival_frame(abt)
    model = survival.fit_cox(frame, DURATION, EVENT, features, penalty)
    scored = frame.withColumn("_risk", model.risk())
    chi2, p = survival.logrank_test(settled, DURATION, EVENT, F.col("IS_EARLY_SETTLER") == 1)
    return SurvivalStudy(
        survival.kaplan_meier(settled, DURATION, EVENT),
        survival.kaplan_meier(settled, DURATION, EVENT, ["IS_EARLY_SETTLER"]),
        chi2,
        p,
        model,
        survival.concordance(scored, DURATION, EVENT, "_risk").first()["c_index"],
    )
