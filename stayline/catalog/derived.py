"""Derived columns, quality checks and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.catalog.base import VIEWS, query
from stayline.functions import columns as fx
from stayline.functions import features, portfolio, risk, targets
from stayline.operators import contracts, outliers, quality
from stayline.plans import bindings
from stayline.plans.abt import stored_abt

KEY = ["CONTRIB", "DOSSIER", "SEQ_LINE", "SEQ_PART", "SEQ_SUPP"]
KEY_SQL = ", ".join(KEY)

# histories of every shape: full, short, blank, with a decimal tail, missing
VIEWS["histories"] = """
SELECT CONTRIB, DOSSIER, SEQ_LINE, SEQ_PART, SEQ_SUPP, CASE
  WHEN SEQ_PART % 10 = 1 THEN NULL WHEN SEQ_PART % 10 = 2 THEN '' WHEN SEQ_PART % 10 = 3 THEN substr(RISK, 13)
  WHEN SEQ_PART % 10 = 4 THEN ' ' || ltrim(RISK, '0') || '.0' WHEN SEQ_PART % 10 = 5 THEN substr(RISK, 1, 18) || '000100'
  ELSE RISK END AS H FROM loans_raw"""


def histories(spark, folder):
    part = F.col("SEQ_PART") % 10
    h = (
        F.when(part == 1, F.lit(None).cast("string"))
        .when(part == 2, F.lit(""))
        .when(part == 3, F.substring("RISK", 13, 24))
        .when(part == 4, F.concat(F.lit(" "), F.ltrim("RISK", F.lit("0")), F.lit(".0")))
        .when(part == 5, F.concat(F.substring("RISK", 1, 18), F.lit("000100")))
        .otherwise(F.col("RISK"))
    )
    return bindings.loans(spark, folder).select(*KEY, h.alias("H"))


@query(
    "k01_k03_risk_flags",
    f"""SELECT {KEY_SQL}, CASE WHEN regexp_matches(trim(H), '[1-9]') THEN 1 ELSE 0 END AS risk_ever,
    CASE WHEN regexp_matches(right(trim(H), 6), '[1-9]') THEN 1 ELSE 0 END AS risk_recent,
    CAST(coalesce(length(regexp_replace(H, '[^1-9]', '', 'g')), 0) AS INTEGER) AS bad_months FROM histories""",
)
def k01(spark, folder):
    return histories(spark, folder).select(
        *KEY, risk.risk_ever("H").alias("risk_ever"), risk.risk_recent("H").alias("risk_recent"),
        risk.bad_months("H").alias("bad_months"),
    )


_TEXT = "split_part(trim(coalesce(H, 'nan')), '.', 1)"
_PAD = f"CASE WHEN length({_TEXT}) < 24 THEN lpad({_TEXT}, 24, '0') ELSE {_TEXT} END"
_MEAN = "list_avg(list_transform(list_filter(string_split({x}, ''), lambda c: c >= '0' AND c <= '9'), lambda c: CAST(c AS INTEGER)))"
_DIG12 = "list_filter(string_split(right(p, 12), ''), lambda c: c >= '0' AND c <= '9')"


@query(
    "k04_k06_risk_history",
    f"""SELECT {KEY_SQL},
      coalesce({_MEAN.format(x="substr(right(p, 6), 1, 3)")} - {_MEAN.format(x="right(p, 3)")}, 0) AS trend,
      CAST(len(list_filter(range(1, len({_DIG12})), lambda i: {_DIG12}[i] <> {_DIG12}[i + 1])) AS INTEGER) AS volatility,
      CAST(length(d) - length(rtrim(d, right(d, 1))) AS INTEGER) AS months_at_current
    FROM (SELECT *, regexp_replace(p, '[^0-9]', '', 'g') AS d FROM (SELECT *, {_PAD} AS p FROM histories))""",
    doubles="trend",
)
def k04(spark, folder):
    return histories(spark, folder).select(
        *KEY, risk.risk_trend("H").alias("trend"), risk.risk_volatility("H").alias("volatility"),
        risk.months_at_current_risk("H").alias("months_at_current"),
    )


@query(
    "k07_k12_codes",
    """SELECT s.sys_numero_submissao AS id, CASE WHEN kp_sqe BETWEEN 'A' AND 'H' THEN ascii(kp_sqe) - 65 END AS ordinal,
      CASE WHEN kp_sqe BETWEEN 'A' AND 'X' THEN ascii(kp_sqe) - 64 ELSE 25 END AS behavioural,
      CASE WHEN kp_sqe BETWEEN 'A' AND 'E' AND ks_score_tier IN (3, 4) THEN 1 ELSE 0 END AS mismatch,
      CASE WHEN sdem_age >= 0 AND sdem_age < 25 THEN '<25' WHEN sdem_age >= 25 AND sdem_age < 35 THEN '25-34'
        WHEN sdem_age >= 35 AND sdem_age < 45 THEN '35-44' WHEN sdem_age >= 45 AND sdem_age < 55 THEN '45-54'
        WHEN sdem_age >= 55 AND sdem_age < 65 THEN '55-64' WHEN sdem_age >= 65 AND sdem_age < 120 THEN '65+'
        ELSE 'nan' END AS age_bucket,
      CASE sdem_HABITAT WHEN 'P' THEN 3 WHEN 'A' THEN 2 WHEN 'F' THEN 2 WHEN 'L' THEN 1 ELSE 0 END AS housing,
      CASE WHEN sdem_SITFAM IN ('C', 'U') THEN 1 ELSE 0 END AS partnered
    FROM scores_raw s LEFT JOIN fama_raw f ON s.CONTRIB = f.CONTRIB""",
    doubles="ordinal",
)
def k07(spark, folder):
    rows = bindings.scores(spark, folder).join(bindings.client_aggregates(spark, folder), "CONTRIB", "left")
    return rows.select(
        F.col("sys_numero_submissao").alias("id"),
        features.score_ordinal("kp_sqe", 8).alias("ordinal"),
        features.behavioural_score("kp_sqe").alias("behavioural"),
        features.score_risk_mismatch("kp_sqe", "ks_score_tier").alias("mismatch"),
        features.age_bucket("sdem_age").alias("age_bucket"),
        features.housing_stability("sdem_HABITAT").alias("housing"),
        features.is_partnered("sdem_SITFAM").alias("partnered"),
    )


# one wide row per loan observation with bureau, score and client columns attached
VIEWS["feature_rows"] = """
SELECT l.*, b.* EXCLUDE (CONTRIB, OBS_DATE), s.kp_sqe, f.* EXCLUDE (CONTRIB, Date_Obs, REGION),
  NULL AS unused FROM loans_raw l
LEFT JOIN (SELECT * FROM bureau_raw WHERE SEQ_EVENT IN (SELECT min(SEQ_EVENT) FROM bureau_raw GROUP BY CONTRIB)) b USING (CONTRIB)
LEFT JOIN (SELECT CONTRIB, arg_max(kp_sqe, sys_numero_submissao) AS kp_sqe FROM scores_raw WHERE kp_sqe IS NOT NULL GROUP BY CONTRIB) s USING (CONTRIB)
LEFT JOIN fama_raw f USING (CONTRIB)"""


def feature_rows(spark, folder):
    bureau = bindings.bureau(spark, folder).drop("OBS_DATE")
    first = bureau.groupBy("CONTRIB").agg(
        F.min_by(F.struct(*[c for c in bureau.columns if c != "CONTRIB"]), "SEQ_EVENT").alias("x")
    ).select("CONTRIB", "x.*")
    score = bindings.scores(spark, folder).groupBy("CONTRIB").agg(
        contracts.last_filled("kp_sqe", "sys_numero_submissao").alias("kp_sqe")
    )
    clients = bindings.client_aggregates(spark, folder).drop("Date_Obs", "REGION")
    return (
        bindings.loans(spark, folder)
        .join(first, "CONTRIB", "left")
        .join(score, "CONTRIB", "left")
        .join(clients, "CONTRIB", "left")
    )


def _div(a, b, lo=None, hi=None):
    x = f"({a}) / ({b})"
    if lo is not None:
        x = f"greatest({x}, {lo})"
    if hi is not None:
        x = f"least({x}, {hi})"
    return f"CASE WHEN ({b}) <> 0 AND ({a}) IS NOT NULL THEN {x} END"


def _sum(prefix, kinds=("CL", "CP", "AUTO", "HT")):
    return "(" + " + ".join(f"coalesce({prefix}_{k}, 0)" for k in kinds) + ")"


_CAPACITY = {
    "DTI_RATIO": _div("MT_MENSAL", "RESSO", 0),
    "TOTAL_DEBT_BURDEN": _sum("DIVIDAS"),
    "EXTERNAL_OVERDUE_FLAG": f"CASE WHEN {_sum('MONTVENC')} > 0 THEN 1 ELSE 0 END",
    "INSTALMENT_TO_CAPITAL": _div("MENSALIDADE", "CRD", 0),
    "INCOME_BUFFER": _div("RESSO - MENSALIDADE", "RESSO", -1, 1),
    "MULTI_PRODUCT_FLAG": "CASE WHEN coalesce(ALLBD_N_CL__N, 0) + coalesce(ALLBD_N_CP__N, 0) > 1 THEN 1 ELSE 0 END",
    "ACTIVE_CONTRACT_COUNT": "coalesce(ALLBD_A_CL__N, 0) + coalesce(ALLBD_A_CP__N, 0)",
    "RELATIONSHIP_TENURE": "ALLBD_IDADE_MSA__N",
    "NEW_CONTRACT_RECENCY": "ALLBD_IDADE_MIN__N",
    "EVENT_FREQUENCY": _div("CAST(ALLBD_N_events__N AS DOUBLE)", "ALLBD_IDADE_MEAN__N", 0),
    "CREDIT_CONCENTRATION": _div("CAST(COUNT_CL AS DOUBLE)", "COUNT_TOTAL", 0, 1),
    "WRITEOFF_HISTORY_FLAG": f"CASE WHEN {_sum('MONTABATV', ('CL',))} > 0 THEN 1 ELSE 0 END",
    "OVERDUE_TO_DEBT_RATIO": _div(_sum("MONTVENC"), _sum("DIVIDAS"), 0, 1),
}
_RATIOS = [c for c in _CAPACITY if not c.endswith("_FLAG")]


@query(
    "k13_k23_client_features",
    f"SELECT {KEY_SQL}, " + ", ".join(f"{e} AS {c}" for c, e in _CAPACITY.items()) + " FROM feature_rows",
    doubles=" ".join(_RATIOS),
)
def k13(spark, folder):
    out = features.add_features(feature_rows(spark, folder), ("capacity", "relationship", "external"), drop_dates=False)
    return out.select(*KEY, *_CAPACITY)


_AGE = "greatest((DPOS - DCREAT) / 30.44, 0)"
_LEFT = _div("MTFIN", "MENSALIDADE", 0)
_LIFE = {
    "REPAYMENT_RATIO": _div("MTFINO - CRD", "MTFINO", 0, 1),
    "CONTRACT_AGE_MONTHS": _AGE,
    "REMAINING_TERM_MONTHS": _LEFT,
    "LIFECYCLE_RATIO": _div(_AGE, f"{_AGE} + {_LEFT}", 0, 1),
    "OVERPAYMENT_RATIO": _div("MENSALIDADE * 1.5", "MENSALIDADE", 0),
    "REGULARIZATION_COMPLETION": _div("CAST(RANGPRO AS DOUBLE)", "DURDEG", 0, 1),
    "DELAY_INTENSITY": _div("CAST(RANGCLI AS DOUBLE)", _AGE, 0),
}


@query(
    "k24_lifecycle_features",
    f"SELECT {KEY_SQL}, " + ", ".join(f"{e} AS {c}" for c, e in _LIFE.items()) + " FROM loans_raw",
    doubles=" ".join(_LIFE),
)
def k24(spark, folder):
    rows = bindings.loans(spark, folder).withColumn("MENSALIDADE_CORR", F.col("MENSALIDADE") * 1.5)
    return features.add_features(rows, ("contract_lifecycle",), drop_dates=False).select(*KEY, *_LIFE)


_BS = "CASE WHEN kp_sqe BETWEEN 'A' AND 'X' THEN ascii(kp_sqe) - 64 ELSE 25 END"
_TREND = f"""coalesce({_MEAN.format(x="substr(right(RISK, 6), 1, 3)")} - {_MEAN.format(x="right(RISK, 3)")}, 0)"""


@query(
    "k25_k26_composites",
    f"""SELECT {KEY_SQL},
      0.30 * REPAYMENT_RATIO + 0.20 * (1 - CASE WHEN DTI_RATIO IS NOT NULL THEN least(greatest(DTI_RATIO, 0), 1) END)
        + 0.20 * LIFECYCLE_RATIO + 0.15 * CASE WHEN OVERPAYMENT_RATIO IS NOT NULL THEN least(OVERPAYMENT_RATIO, 2) END / 2
        + 0.15 * (1 - (BEHAVIORAL - 1) / 24) AS EARLY_SETTLE_PROPENSITY,
      0.25 * CASE WHEN DELAY_INTENSITY IS NOT NULL THEN least(DELAY_INTENSITY, 1) END + 0.20 * EXTERNAL_OVERDUE_FLAG
        + 0.20 * (1 - least(ACTIVE_CONTRACT_COUNT, 5) / 5.0) + 0.20 * (1 - TREND) / 2
        + 0.15 * CASE WHEN DTI_RATIO IS NOT NULL THEN least(DTI_RATIO, 1) END AS CHURN_RISK_COMPOSITE
    FROM (SELECT {KEY_SQL}, {", ".join(f"{e} AS {c}" for c, e in {**_CAPACITY, **_LIFE}.items())},
      {_BS} AS BEHAVIORAL, {_TREND} AS TREND FROM feature_rows)""",
    doubles="EARLY_SETTLE_PROPENSITY CHURN_RISK_COMPOSITE",
)
def k25(spark, folder):
    rows = feature_rows(spark, folder).withColumn("MENSALIDADE_CORR", F.col("MENSALIDADE") * 1.5)
    out = features.add_features(rows, tuple(features.FEATURE_GROUPS), composites=True)
    return out.select(*KEY, "EARLY_SETTLE_PROPENSITY", "CHURN_RISK_COMPOSITE")


@query("u09_feature_engineer", f"SELECT {KEY_SQL}, {_BS} AS BEHAVIORAL_SCORE_NUM, {_CAPACITY['DTI_RATIO']} AS DTI_RATIO FROM feature_rows", doubles="DTI_RATIO")
def u09(spark, folder):
    from stayline.ml.cleaner import FeatureEngineer

    return FeatureEngineer().transform(feature_rows(spark, folder)).select(*KEY, "BEHAVIORAL_SCORE_NUM", "DTI_RATIO")


@query("k27_bureau_totals", "SELECT SEQ_EVENT, crc_total_overdue, crc_total_debt FROM bureau_clean", doubles="crc_total_overdue crc_total_debt")
def k27(spark, folder):
    rows = bindings.bureau(spark, folder)
    kinds = features.CREDIT_TYPES
    return rows.select(
        "SEQ_EVENT", fx.row_sum([f"MONTVENC_{t}" for t in kinds]).alias("crc_total_overdue"),
        fx.row_sum([f"DIVIDAS_{t}" for t in kinds]).alias("crc_total_debt"),
    )


@query("k28_k30_targets", "SELECT CONTRIB, IS_EARLY_SETTLER, IS_CHURN, TIME_TO_CHURN_D FROM clients", doubles="TIME_TO_CHURN_D")
def k28(spark, folder):
    base = stored_abt(spark, folder).drop("IS_EARLY_SETTLER", "IS_CHURN", "TIME_TO_CHURN_D")
    return contracts.with_targets(base).select("CONTRIB", "IS_EARLY_SETTLER", "IS_CHURN", "TIME_TO_CHURN_D")


@query(
    "k31_k33_time_features",
    """SELECT CONTRIB, (DATE '2025-11-30' - FIRST_DCREAT) / 365.25 AS seniority, (DATE '2025-11-30' - LAST_DCREAT) / 365.25 AS recency,
      greatest((LAST_DPOS - FIRST_DCREAT) / 30.44, 0) AS age_months,
      CASE WHEN MEDIAN_DURDEG <> 0 THEN least(greatest((LAST_DPOS - FIRST_DCREAT) / 30.44, 0) / MEDIAN_DURDEG, 1) * 100 END AS lifecycle_pct,
      least(greatest((DATE '2001-12-31' - LAST_DCREAT) / 365.25 * 12 / (MEDIAN_DURDEG + 1e-6), 0), 1) AS stage FROM abt""",
    doubles="seniority recency age_months lifecycle_pct stage",
)
def k31(spark, folder):
    age = features.contract_age_months("LAST_DPOS", "FIRST_DCREAT")
    return stored_abt(spark, folder).select(
        "CONTRIB", fx.years_before("2025-11-30", "FIRST_DCREAT").alias("seniority"),
        fx.years_before("2025-11-30", "LAST_DCREAT").alias("recency"), age.alias("age_months"),
        features.lifecycle_percent(age, "MEDIAN_DURDEG").alias("lifecycle_pct"),
        features.lifecycle_stage(fx.years_before("2001-12-31", "LAST_DCREAT"), "MEDIAN_DURDEG").alias("stage"),
    )


@query(
    "k36_k38_cluster_features",
    f"""SELECT CONTRIB, {" + ".join(f"coalesce(DIVIDAS_{t}_MEDIAN, 0)" for t in features.CREDIT_TYPES)} AS debt,
      ln(1 + {" + ".join(f"coalesce(MONTVENC_{t}_MAX, 0)" for t in features.CREDIT_TYPES)}) AS overdue_log,
      COUNT_TOTAL_MEDIAN / (N_CONTRACTS + 1e-6) AS external_to_own, abs(ALLBD_IDADE_MEAN__N) AS mean_age FROM abt""",
    doubles="debt overdue_log external_to_own mean_age",
)
def k36(spark, folder):
    from stayline.plans.clustering import cluster_features

    return cluster_features(stored_abt(spark, folder)).select(
        "CONTRIB", F.col("DIVIDAS_TOTAL_MEDIAN").alias("debt"), F.col("MONTVENC_TOTAL_LOG").alias("overdue_log"),
        F.col("EXTERNAL_TO_OWN").alias("external_to_own"), F.col("ALLBD_IDADE_MEAN__N").alias("mean_age"),
    )


@query("k40_churn_kinds", """SELECT CONTRIB, CASE WHEN IS_EARLY_SETTLER = 1 AND IS_CHURN = 1 THEN 1 ELSE 0 END AS CHURN_EARLY,
    CASE WHEN IS_EARLY_SETTLER = 0 AND EVER_SOL = 1 AND IS_CHURN = 1 THEN 1 ELSE 0 END AS CHURN_NATURAL FROM clients""")
def k40(spark, folder):
    return stored_abt(spark, folder).select("CONTRIB", targets.churn_early().alias("CHURN_EARLY"), targets.churn_natural().alias("CHURN_NATURAL"))


@query("k41_combined_label", "SELECT c_custkey, CAST(c_nationkey % 3 AS VARCHAR) || '_' || CAST(c_custkey % 3 AS VARCHAR) || '_' || CAST(c_custkey % 2 AS VARCHAR) AS cluster_label FROM customer")
def k41(spark, folder):
    from stayline.operators.segments import combined_label

    rows = bindings.table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_nationkey") % 3).alias("a"), (F.col("c_custkey") % 3).alias("b"), (F.col("c_custkey") % 2).alias("c")
    )
    return combined_label(rows, ["a", "b", "c"]).select("c_custkey", "cluster_label")


@query("k44_k47_bands", """SELECT event_id, CASE WHEN value / 100 >= 0.6 THEN 'High risk' WHEN value / 100 >= 0.4 THEN 'Moderate' ELSE 'Low risk' END AS band,
    CASE WHEN value / 1000 < 0.001 THEN '***' WHEN value / 1000 < 0.01 THEN '**' WHEN value / 1000 < 0.05 THEN '*' ELSE '' END AS stars FROM events""")
def k44(spark, folder):
    return bindings.table(spark, folder, "events").select(
        "event_id", portfolio.risk_band(F.col("value") / 100).alias("band"),
        portfolio.significance_stars(F.col("value") / 1000).alias("stars"),
    )


@query("k48_period_keys", """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS cohort,
    strftime(o_orderdate, '%Y-%m') AS month FROM orders""")
def k48(spark, folder):
    return bindings.table(spark, folder, "orders").select(
        "o_orderkey", fx.quarter_key("o_orderdate").alias("cohort"), fx.month_key("o_orderdate").alias("month")
    )


@query("g05_last_non_null", """SELECT CONTRIB, arg_max(D1FIN, (OBS_DATE, SEQ_LINE, SEQ_PART, SEQ_SUPP, SEQ_PRICE, DOSSIER)) FILTER (WHERE D1FIN IS NOT NULL) AS last_end
    FROM loans_raw GROUP BY CONTRIB""", dates="last_end")
def g05(spark, folder):
    order = ["OBS_DATE", *bindings.SEQUENCE, "DOSSIER"]
    return bindings.loans(spark, folder).groupBy("CONTRIB").agg(contracts.last_filled("D1FIN", *order).alias("last_end"))


@query("g06_mode", """SELECT CONTRIB, RISKA AS mode FROM (SELECT CONTRIB, RISKA, row_number() OVER (PARTITION BY CONTRIB ORDER BY count(*) DESC, RISKA) AS r
    FROM loans_raw WHERE RISKA IS NOT NULL GROUP BY CONTRIB, RISKA) WHERE r = 1""", doubles="mode")
def g06(spark, folder):
    return bindings.loans(spark, folder).groupBy("CONTRIB").agg(contracts.smallest_mode("RISKA").alias("mode")).na.drop()


@query("g07_group_median", "SELECT CONTRIB, median(RESSO) AS income, median(CRD) AS balance FROM loans_raw GROUP BY CONTRIB", doubles="income balance", places=5)
def g07(spark, folder):
    from stayline.operators.quantiles import group_quantiles

    return group_quantiles(bindings.loans(spark, folder), ["CONTRIB"], {"income": ("RESSO", 0.5), "balance": ("CRD", 0.5)})


@query("g07_group_median_narrowed", "SELECT POS, median(CRD) AS balance, quantile_cont(MENSALIDADE, 0.9) AS instalment FROM loans_raw GROUP BY POS", doubles="balance instalment", places=5)
def g07_narrowed(spark, folder):
    """The way large groups take, forced by a low limit."""
    from stayline.operators.quantiles import group_quantiles

    return group_quantiles(bindings.loans(spark, folder), ["POS"], {"balance": ("CRD", 0.5), "instalment": ("MENSALIDADE", 0.9)}, limit=5000)


@query("g08_g09_row_functions", "SELECT SEQ_EVENT, coalesce(DIVIDAS_CL, 0) + coalesce(DIVIDAS_CP, 0) AS debt, greatest(DIVIDAS_CL, DIVIDAS_CP, MT_MENSAL) AS largest FROM bureau_raw", doubles="debt largest")
def g08(spark, folder):
    return bindings.bureau(spark, folder).select(
        "SEQ_EVENT", fx.row_sum(["DIVIDAS_CL", "DIVIDAS_CP"]).alias("debt"), fx.row_max(["DIVIDAS_CL", "DIVIDAS_CP", "MT_MENSAL"]).alias("largest")
    )


@query(
    "g29_correlation",
    """SELECT feature_a, feature_b, r FROM (
    SELECT 'DIVIDAS_CL' AS feature_a, 'COUNT_TOTAL' AS feature_b, corr(DIVIDAS_CL, COUNT_TOTAL) AS r FROM bureau_raw UNION ALL
    SELECT 'MT_MENSAL', 'COUNT_TOTAL', corr(MT_MENSAL, COUNT_TOTAL) FROM bureau_raw UNION ALL
    SELECT 'MT_MENSAL', 'DIVIDAS_CL', corr(MT_MENSAL, DIVIDAS_CL) FROM bureau_raw)""",
    doubles="r",
)
def g29(spark, folder):
    from stayline.ml.selection import correlation_pairs

    return correlation_pairs(bindings.bureau(spark, folder), ["MT_MENSAL", "DIVIDAS_CL", "COUNT_TOTAL"])


# ------------------------------------------------------------------ quality checks


@query("l01_shape", "SELECT count(*) AS rows, 27 AS columns, 0 AS duplicate_rows, 1 AS non_empty FROM clients")
def l01(spark, folder):
    from stayline.catalog.client_grain import CLIENT_AMOUNTS

    table = stored_abt(spark, folder)
    keep = ["CONTRIB", "N_CONTRACTS", "HAS_ACTIVE", "PRODALP", "LAST_RISK", "FIRST_DCREAT", "EVER_SOL", "EVER_SAN", "EVER_RBT",
            "IS_CHURN", "IS_EARLY_SETTLER", "MAX_RISKA", "CSP", *CLIENT_AMOUNTS.split()]
    return quality.shape_check(table.select(*keep))


_ABT_NULLS = "LAST_OBS_DATE_SOL LAST_OBS_DATE_SAN LAST_OBS_DATE_RBT kp_sqe_enc MT_MENSAL_MAX COUNT_TOTAL_MEDIAN TIME_TO_CHURN_D".split()


@query(
    "l02_missing_summary",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END) * 100 AS missing_pct FROM abt" for c in _ABT_NULLS
    ) + ") WHERE missing_pct > 0",
    doubles="missing_pct",
)
def l02(spark, folder):
    return quality.missing_summary(quality.require_targets(stored_abt(spark, folder))).filter(F.col("column").isin(*_ABT_NULLS))


@query(
    "l02_overall_missing",
    f"""SELECT sum({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _ABT_NULLS)}) * 100.0 / (count(*) * {len(_ABT_NULLS)}) AS missing_pct,
      CAST(({" + ".join(f"CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END" for c in _ABT_NULLS)}) AS INTEGER) AS columns_with_nulls,
      CAST(({" + ".join(f"CASE WHEN count({c}) = 0 THEN 1 ELSE 0 END" for c in _ABT_NULLS)}) AS INTEGER) AS empty_columns FROM abt""",
    doubles="missing_pct",
)
def l02_overall(spark, folder):
    return quality.overall_missing(stored_abt(spark, folder).select(*_ABT_NULLS))


def _check_sql(name, bad, applies, table="abt"):
    return (
        f"""SELECT '{name}' AS "check", count(CASE WHEN {bad} THEN 1 END) AS violations, count(CASE WHEN {applies} THEN 1 END) AS checked, """
        f"CASE WHEN count(CASE WHEN {applies} THEN 1 END) > 0 THEN count(CASE WHEN {bad} THEN 1 END) * 100.0 / count(CASE WHEN {applies} THEN 1 END) ELSE 0 END AS pct FROM {table}"
    )


@query(
    "l03_date_order",
    " UNION ALL ".join(_check_sql(f"{a} <= {b}", f"{a} > {b}", f"{a} IS NOT NULL AND {b} IS NOT NULL") for a, b in quality.DATE_ORDER),
    doubles="pct",
)
def l03(spark, folder):
    return quality.date_order(stored_abt(spark, folder))


@query(
    "l03_observation_order",
    _check_sql("DCREAT <= OBS_DATE", "DCREAT > OBS_DATE", "DCREAT IS NOT NULL AND OBS_DATE IS NOT NULL", "loans_raw")
    + " UNION ALL " + _check_sql("DCREAT <= D1FIN", "DCREAT > D1FIN", "DCREAT IS NOT NULL AND D1FIN IS NOT NULL", "loans_raw"),
    doubles="pct",
)
def l03_rows(spark, folder):
    return quality.date_order(bindings.loans(spark, folder), (("DCREAT", "OBS_DATE"), ("DCREAT", "D1FIN")))


@query(
    "l04_ranges",
    " UNION ALL ".join(
        _check_sql(n, f"{c} {'<' if inclusive else '<='} {limit}", f"{c} IS NOT NULL") for n, (c, limit, inclusive) in quality.RANGES.items()
    ),
    doubles="pct",
)
def l04(spark, folder):
    return quality.range_check(stored_abt(spark, folder))


@query(
    "l05_near_constant",
    """SELECT 'MIN_DURDEG' AS "column", CAST(v AS VARCHAR) AS top_value, n * 100.0 / t AS frequency_pct FROM (
      SELECT MIN_DURDEG AS v, count(*) AS n, sum(count(*)) OVER () AS t FROM abt GROUP BY 1 ORDER BY n DESC LIMIT 1) WHERE n >= t * 0.5 UNION ALL
    SELECT 'EVER_SOL', CAST(v AS VARCHAR), n * 100.0 / t FROM (
      SELECT EVER_SOL AS v, count(*) AS n, sum(count(*)) OVER () AS t FROM abt GROUP BY 1 ORDER BY n DESC LIMIT 1) WHERE n >= t * 0.5""",
    doubles="frequency_pct",
)
def l05(spark, folder):
    return quality.near_constant_report(stored_abt(spark, folder).select("MIN_DURDEG", "EVER_SOL", "TOTAL_MTFINO"), 0.5)


@query(
    "l06_target_distribution",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS population, '{t}' AS target, count(*) AS rows, CAST(sum({t}) AS BIGINT) AS positives, CAST(count(*) - sum({t}) AS BIGINT) AS negatives,
        sum({t}) * 100.0 / count(*) AS positive_pct, (count(*) - sum({t})) * 1.0 / sum({t}) AS imbalance FROM clients WHERE {w}"""
        for p, w in {"all": "TRUE", "settled": "EVER_SAN = 1 OR EVER_SOL = 1 OR EVER_RBT = 1"}.items()
        for t in quality.TARGETS
    ),
    doubles="positive_pct imbalance",
)
def l06(spark, folder):
    return quality.target_distribution(stored_abt(spark, folder))


@query("l07_target_sanity", " UNION ALL ".join(
    f"SELECT '{t}' AS target, count(DISTINCT {t}) AS distinct_values, count(*) - count({t}) AS nulls, CASE WHEN count(DISTINCT {t}) = 2 THEN 1 ELSE 0 END AS ok FROM clients" for t in quality.TARGETS))
def l07(spark, folder):
    return quality.target_sanity(stored_abt(spark, folder))


@query("l08_scoring_population", """SELECT count(*) AS clients, count(CASE WHEN h THEN 1 END) AS trainable, count(CASE WHEN IS_CHURN = 0 THEN 1 END) AS active,
    count(CASE WHEN IS_CHURN = 0 AND h THEN 1 END) AS active_with_history, count(CASE WHEN IS_CHURN = 0 AND NOT h THEN 1 END) AS active_without_history
    FROM (SELECT *, EVER_SAN = 1 OR EVER_SOL = 1 OR EVER_RBT = 1 AS h FROM clients)""")
def l08(spark, folder):
    return quality.scoring_population(stored_abt(spark, folder))


@query("l09_high_missing", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END) * 100 AS missing_pct FROM abt" for c in _ABT_NULLS
) + ") WHERE missing_pct >= 30", doubles="missing_pct")
def l09(spark, folder):
    return quality.high_missing(stored_abt(spark, folder).select(*_ABT_NULLS), 30.0)


# ------------------------------------------------------------------ outliers

# order lines with a heavy tail so that bounds have something to find
VIEWS["skewed"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax,
  CASE WHEN l_partkey % 50 = 0 THEN l_extendedprice * 40 WHEN l_partkey % 51 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice
FROM lineitem"""
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def skewed(spark, folder):
    part = F.col("l_partkey")
    price = F.when(part % 50 == 0, F.col("l_extendedprice") * 40).when(part % 51 != 0, F.col("l_extendedprice"))
    return bindings.table(spark, folder, "lineitem").select(
        *LINE_KEY, "l_quantity", "l_discount", "l_tax", price.alias("l_extendedprice")
    )


_M1 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "m01_outlier_report",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1 END) AS iqr_rows,
        count(CASE WHEN abs(({c} - m) / s) > 3 THEN 1 END) AS z_rows, round(greatest(count(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1 END),
        count(CASE WHEN abs(({c} - m) / s) > 3 THEN 1 END)) * 100.0 / count(*), 1) AS pct_rows
        FROM skewed, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, avg({c}) AS m, stddev_samp({c}) AS s FROM skewed)"""
        for c in _M1
    ),
    doubles="pct_rows",
)
def m01(spark, folder):
    return outliers.outlier_report(skewed(spark, folder), _M1)


_M2 = ["l_quantity", "l_extendedprice", "l_discount"]


def _bounds_sql(c: str, k: float = 1.5, z: float = 3.5) -> str:
    return f"""(SELECT q1 - {k} * (q3 - q1) AS il, q3 + {k} * (q3 - q1) AS iu,
      CASE WHEN mad > 0 THEN med - {z} * mad / 0.6745 ELSE '-infinity'::DOUBLE END AS zl,
      CASE WHEN mad > 0 THEN med + {z} * mad / 0.6745 ELSE 'infinity'::DOUBLE END AS zu FROM (
        SELECT any_value(q1) AS q1, any_value(q3) AS q3, any_value(med) AS med, median(abs({c} - med)) AS mad FROM skewed,
          (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, median({c}) AS med FROM skewed)))"""


@query(
    "m02_voting_bounds",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", il AS iqr_lower, iu AS iqr_upper, zl AS mod_z_lower, zu AS mod_z_upper FROM {_bounds_sql(c)}" for c in _M2),
    doubles="iqr_lower iqr_upper mod_z_lower mod_z_upper",
    places=4,
)
def m02(spark, folder):
    from stayline.ml.preprocess import OutlierHandler

    return OutlierHandler(columns=_M2, skipDiscrete=False).fit(skewed(spark, folder)).bounds_table(spark)


def _votes(c):
    return f"(CASE WHEN {c} < il OR {c} > iu THEN 1 ELSE 0 END + CASE WHEN {c} < zl OR {c} > zu THEN 1 ELSE 0 END)"


@query(
    "m03_blank_outliers",
    f"SELECT {', '.join(LINE_KEY)}, CASE WHEN {_votes('l_extendedprice')} < 2 THEN l_extendedprice END AS l_extendedprice FROM skewed, {_bounds_sql('l_extendedprice')}",
    doubles="l_extendedprice",
)
def m03(spark, folder):
    from stayline.ml.preprocess import OutlierHandler

    rows = skewed(spark, folder)
    return OutlierHandler(columns=["l_extendedprice", "l_tax"]).fit(rows).transform(rows).select(*LINE_KEY, "l_extendedprice")


@query("m03_voting_report", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(CASE WHEN {_votes(c)} >= 2 THEN 1 END) AS cells_flagged FROM skewed, {_bounds_sql(c)}" for c in _M2))
def m03_report(spark, folder):
    rows = skewed(spark, folder)
    return outliers.voting_report(rows, outliers.voting_bounds(rows, _M2, skip_discrete=False))


@query(
    "m04_capping",
    f"""SELECT {', '.join(LINE_KEY)}, least(greatest(l_discount, (SELECT quantile_cont(l_discount, 0.01) FROM skewed)), (SELECT quantile_cont(l_discount, 0.99) FROM skewed)) AS l_discount,
      l_quantity FROM skewed""",
    doubles="l_discount l_quantity",
)
def m04(spark, folder):
    return outliers.cap_narrow_columns(skewed(spark, folder), ["l_discount", "l_quantity"]).select(*LINE_KEY, "l_discount", "l_quantity")


@query(
    "m05_reject_rows",
    f"""SELECT CASE WHEN bad THEN 'rejected' ELSE 'kept' END AS part, count(*) AS rows FROM (
      SELECT (l_extendedprice < p.il OR l_extendedprice > p.iu) AND (l_extendedprice < p.zl OR l_extendedprice > p.zu)
        OR (l_quantity < q.il OR l_quantity > q.iu) AND (l_quantity < q.zl OR l_quantity > q.zu) AS bad
      FROM skewed, {_bounds_sql('l_extendedprice', 3.0)} p, {_bounds_sql('l_quantity', 3.0)} q) GROUP BY 1""",
)
def m05(spark, folder):
    rejected, kept = outliers.reject_outlier_rows(skewed(spark, folder), ["l_extendedprice", "l_quantity"], complete_only=False)
    count = lambda df, part: df.agg(F.lit(part).alias("part"), F.count("*").alias("rows"))
    return count(rejected, "rejected").unionByName(count(kept, "kept"))
