"""Survival, segments and model preparation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from stayline.catalog.base import VIEWS, query
from stayline.operators import segments, survival
from stayline.plans import bindings
from stayline.plans.abt import stored_abt
from stayline.sources.schema import numeric_columns

# ------------------------------------------------------------------ survival on contract observations

VIEWS["spells"] = """
SELECT CONTRIB, DOSSIER, CAST(greatest(OBS_DATE - DCREAT, 0) AS INTEGER) AS days,
  CASE WHEN POS IN ('SAN', 'RBT') OR DOSSIER % 3 = 0 THEN 1 ELSE 0 END AS ended,
  CASE WHEN POS IN ('SAN', 'RBT') THEN 1 ELSE 0 END AS early, RANGPRO, RANGCLI, CRD / 10000 AS CRD FROM loans_raw"""


def spells(spark, folder):
    """Days from contract start to each observation with a stand-in event."""
    early = F.col("POS").isin("SAN", "RBT")
    return bindings.loans(spark, folder).select(
        "CONTRIB", "DOSSIER", F.greatest(F.datediff("OBS_DATE", "DCREAT"), F.lit(0)).alias("days"),
        (early | (F.col("DOSSIER") % 3 == 0)).cast("int").alias("ended"), early.cast("int").alias("early"),
        "RANGPRO", "RANGCLI", (F.col("CRD") / 10000).alias("CRD"),
    )


def _km(group: str) -> str:
    part = f"PARTITION BY {group}" if group else ""
    lead = f"{group}, " if group else ""
    z = survival.NORMAL_95
    return f"""SELECT {lead}t, CAST(events AS BIGINT) AS events, leaving, CAST(at_risk AS BIGINT) AS at_risk, survival,
      CASE WHEN none = 1 THEN 0 WHEN lg < 0 THEN exp(-exp(ln(-lg) - {z} * sqrt(v) / lg)) ELSE 1 END AS lower,
      CASE WHEN none = 1 THEN 0 WHEN lg < 0 THEN exp(-exp(ln(-lg) + {z} * sqrt(v) / lg)) ELSE 1 END AS upper FROM (
      SELECT *, CASE WHEN none = 1 THEN 0 ELSE exp(lg) END AS survival FROM (
        SELECT *, sum(CASE WHEN at_risk > events THEN ln(1 - CAST(events AS DOUBLE) / at_risk) ELSE 0 END) OVER ({part} ORDER BY t) AS lg,
          sum(CASE WHEN at_risk > events THEN CAST(events AS DOUBLE) / (CAST(at_risk AS DOUBLE) * (at_risk - events)) ELSE 0 END) OVER ({part} ORDER BY t) AS v,
          max(CASE WHEN at_risk = events THEN 1 ELSE 0 END) OVER ({part} ORDER BY t) AS none FROM (
          SELECT *, sum(leaving) OVER ({part} ORDER BY t DESC) AS at_risk FROM (
            SELECT {lead}days AS t, sum(ended) AS events, count(*) AS leaving FROM spells GROUP BY {lead}days))))"""


@query("r01_kaplan_meier", _km(""), doubles="survival lower upper")
def r01(spark, folder):
    return survival.kaplan_meier(spells(spark, folder), "days", "ended")


@query("r02_median_survival", f"SELECT max(at_risk) AS clients, min(CASE WHEN survival <= 0.5 THEN t END) AS median_days FROM ({_km('')})")
def r02(spark, folder):
    return survival.median_survival(survival.kaplan_meier(spells(spark, folder), "days", "ended"))


@query(
    "r03_survival_at",
    f"""SELECT p.t, coalesce(arg_max(k.survival, k.t), 1) AS survival
    FROM (VALUES (90), (180), (365), (730), (1460), (2920)) p(t) LEFT JOIN ({_km('')}) k ON k.t <= p.t GROUP BY p.t""",
    doubles="survival",
)
def r03(spark, folder):
    return survival.survival_at(survival.kaplan_meier(spells(spark, folder), "days", "ended"))


@query("r04_grouped_kaplan_meier", _km("early"), doubles="survival lower upper")
def r04(spark, folder):
    return survival.kaplan_meier(spells(spark, folder), "days", "ended", ["early"])


@query("r04_group_medians", f"SELECT early, max(at_risk) AS clients, min(CASE WHEN survival <= 0.5 THEN t END) AS median_days FROM ({_km('early')}) GROUP BY early", doubles="median_days")
def r04_median(spark, folder):
    return survival.median_survival(survival.kaplan_meier(spells(spark, folder), "days", "ended", ["early"]), ["early"])


@query(
    "r05_logrank",
    """SELECT *, pow(observed - expected, 2) / variance AS chi2 FROM (
      SELECT CAST(sum(d1) AS BIGINT) AS observed, sum(d * n1 / n) AS expected,
        sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END) AS variance FROM (
        SELECT d, d1, CAST(sum(n) OVER (ORDER BY t DESC) AS DOUBLE) AS n, CAST(sum(n1) OVER (ORDER BY t DESC) AS DOUBLE) AS n1 FROM (
          SELECT days AS t, sum(ended) AS d, count(*) AS n, sum(ended * early) AS d1, sum(early) AS n1 FROM spells GROUP BY days))
      WHERE d > 0)""",
    doubles="expected variance chi2",
    places=4,
)
def r05(spark, folder):
    return survival.logrank_statistic(spells(spark, folder), "days", "ended", F.col("early") == 1)


@query("r05_logrank_test")
def r05_test(spark, folder):
    chi2, p = survival.logrank_test(spells(spark, folder), "days", "ended", F.col("early") == 1)
    return spark.createDataFrame([(chi2, p)], "chi2 double, p double")


COX = ["early", "RANGPRO", "RANGCLI", "CRD"]


def cox_model(spark, folder):
    return survival.fit_cox(spells(spark, folder), "days", "ended", COX, penalty=0.01)


@query("r06_cox_model")
def r06(spark, folder):
    return cox_model(spark, folder).summary(spark)


@query(
    "r06_score_equations",
    """SELECT 0.0::DOUBLE AS largest, count(*) AS clients FROM clients
    WHERE (EVER_SAN = 1 OR EVER_SOL = 1 OR EVER_RBT = 1) AND TIME_TO_CHURN_D IS NOT NULL""",
    doubles="largest",
)
def r06_equations(spark, folder):
    """Largest derivative of the penalised likelihood at the model of all features of the settled clients: zero at its maximum."""
    from stayline.plans import survival as study

    frame, features = study.survival_frame(stored_abt(spark, folder))
    model = survival.fit_cox(frame, study.DURATION, study.EVENT, features, 0.1)
    largest = np.abs(survival.score_equations(frame, study.DURATION, study.EVENT, model, 0.1)).max()
    clients = frame.select(study.DURATION, study.EVENT, *features).na.drop()
    return clients.agg(F.lit(float(largest)).alias("largest"), F.count("*").alias("clients"))


@query("h06_driver_ranking")
def h06(spark, folder):
    from stayline.functions.portfolio import significance_stars

    ranked = survival.strongest_drivers(cox_model(spark, folder).summary(spark))
    return ranked.withColumn("stars", significance_stars(F.col("p")))


@query(
    "r07_concordance",
    """WITH c AS (SELECT days AS t, RANGPRO AS r, CAST(sum(ended) AS HUGEINT) AS e, CAST(count(*) AS HUGEINT) AS m FROM spells GROUP BY 1, 2),
    pairs AS (SELECT sum(CASE WHEN a.r > b.r THEN w ELSE 0 END) AS concordant, sum(CASE WHEN a.r < b.r THEN w ELSE 0 END) AS discordant,
      sum(CASE WHEN a.r = b.r THEN w ELSE 0 END) AS tied FROM (
        SELECT a.r AS ar, b.r AS br, a.e * CASE WHEN b.t > a.t THEN b.m ELSE b.m - b.e END AS w FROM c a JOIN c b ON b.t >= a.t WHERE a.e > 0) q,
      LATERAL (SELECT q.ar AS r) a, LATERAL (SELECT q.br AS r) b)
    SELECT CAST(concordant AS BIGINT) AS concordant, CAST(discordant AS BIGINT) AS discordant, CAST(tied AS BIGINT) AS tied,
      CAST(concordant + discordant + tied AS BIGINT) AS comparable,
      (CAST(concordant AS DOUBLE) + CAST(tied AS DOUBLE) / 2) / CAST(concordant + discordant + tied AS DOUBLE) AS c_index FROM pairs""",
    doubles="c_index",
)
def r07(spark, folder):
    pairs = survival.concordance(spells(spark, folder), "days", "ended", "RANGPRO")
    return pairs.withColumns({c: F.col(c).cast("long") for c in ("concordant", "discordant", "tied", "comparable")})


@query("r08_survival_frame")
def r08(spark, folder):
    """Prepared survival features of the settled clients, one summary row per target value."""
    from stayline.plans.survival import survival_frame

    frame, features = survival_frame(stored_abt(spark, folder))
    return frame.groupBy("IS_CHURN").agg(
        F.count("*").alias("clients"), F.avg("TIME_TO_CHURN_D").alias("mean_days"), F.lit(len(features)).alias("features")
    )


# ------------------------------------------------------------------ segments

_XY = ["c_acctbal", "balance_gap"]
VIEWS["points"] = """
SELECT c_custkey, c_nationkey % 4 AS label, c_acctbal / 1000 AS c_acctbal, (c_acctbal / 1000 - c_nationkey % 4 * 3) / 2 AS balance_gap FROM customer"""


def points(spark, folder):
    label = F.col("c_nationkey") % 4
    scaled = F.col("c_acctbal") / 1000
    return bindings.table(spark, folder, "customer").select(
        "c_custkey", label.alias("label"), scaled.alias("c_acctbal"), ((scaled - label * 3) / 2).alias("balance_gap")
    )


@query("q03_distribution", "SELECT label, count(*) AS clients, count(*) * 100.0 / sum(count(*)) OVER () AS share_pct FROM points GROUP BY label", doubles="share_pct")
def q03(spark, folder):
    return segments.cluster_distribution(points(spark, folder), "label")


@query("q03_centroids", "SELECT label, avg(c_acctbal) AS c_acctbal, avg(balance_gap) AS balance_gap FROM points GROUP BY label", doubles="c_acctbal balance_gap")
def q03_centroids(spark, folder):
    return segments.group_centroids(points(spark, folder), "label", _XY)


@query(
    "q08_davies_bouldin",
    """WITH c AS (SELECT label, avg(c_acctbal) AS x, avg(balance_gap) AS y FROM points GROUP BY label),
    s AS (SELECT label, x, y, avg(sqrt(pow(c_acctbal - x, 2) + pow(balance_gap - y, 2))) AS s FROM points JOIN c USING (label) GROUP BY label, x, y)
    SELECT avg(worst) AS davies_bouldin FROM (SELECT a.label, max((a.s + b.s) / sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS worst
      FROM s a JOIN s b ON a.label <> b.label GROUP BY a.label)""",
    doubles="davies_bouldin",
)
def q08(spark, folder):
    return segments.davies_bouldin(points(spark, folder), _XY, "label")


@query(
    "q09_r_squared",
    """SELECT (t - w) / t AS r_squared FROM (SELECT sum(pow(c_acctbal - mx, 2) + pow(balance_gap - my, 2)) AS t,
      sum(pow(c_acctbal - gx, 2) + pow(balance_gap - gy, 2)) AS w FROM (
        SELECT *, avg(c_acctbal) OVER () AS mx, avg(balance_gap) OVER () AS my, avg(c_acctbal) OVER (PARTITION BY label) AS gx,
          avg(balance_gap) OVER (PARTITION BY label) AS gy FROM points))""",
    doubles="r_squared",
)
def q09(spark, folder):
    return segments.r_squared(points(spark, folder), _XY, "label")


def segmented(spark, folder):
    from stayline.catalog.exploring import segmented as rows

    return rows(spark, folder)


@query("q05_segment_means", "SELECT segment_final, avg(sdem_age) AS sdem_age, avg(NBENF) AS NBENF, avg(MEDIAN_RESSO) AS MEDIAN_RESSO, avg(ALLBD_IDADE_MEAN__N) AS ALLBD_IDADE_MEAN__N FROM segmented GROUP BY segment_final", doubles="sdem_age NBENF MEDIAN_RESSO ALLBD_IDADE_MEAN__N")
def q05(spark, folder):
    return segments.segment_means(segmented(spark, folder))


_FAMILY = ["C", "D", "F", "P", "S", "U", "Unknown", "V", "X"]


@query(
    "q06_family_shares",
    "SELECT segment_final, " + ", ".join(f"avg(CASE WHEN sdem_SITFAM = '{v}' THEN 1.0 ELSE 0 END) * 100 AS {v}" for v in _FAMILY) + " FROM segmented GROUP BY segment_final",
    doubles=" ".join(_FAMILY),
    places=0,
)
def q06(spark, folder):
    from stayline.ml.preprocess import OneHotEncoder

    rows = segmented(spark, folder)
    return segments.segment_shares(OneHotEncoder(columns=["sdem_SITFAM"]).fit(rows).transform(rows), "sdem_SITFAM_")


@query(
    "q07_profession_floor",
    """SELECT segment_final, name, share_pct FROM (SELECT *, max(share_pct) OVER (PARTITION BY name) AS top FROM (
      SELECT s.segment_final, 'p' || CAST(p.CSP AS VARCHAR) AS name, round(avg(CASE WHEN a.CSP = p.CSP THEN 1.0 ELSE 0 END) * 100, 1) AS share_pct
      FROM (SELECT DISTINCT segment_final FROM segmented) s JOIN segmented a USING (segment_final) JOIN (SELECT DISTINCT CSP FROM segmented) p ON TRUE
      GROUP BY s.segment_final, p.CSP)) WHERE top >= 11""",
    doubles="share_pct",
    places=0,
)
def q07(spark, folder):
    from stayline.ml.preprocess import OneHotEncoder

    rows = segmented(spark, folder)
    wide = segments.segment_shares(OneHotEncoder(columns=["CSP"]).fit(rows).transform(rows), "CSP_")
    long = segments.shares_with_floor(wide, floor=11.0)
    return long.withColumn("name", F.concat(F.lit("p"), "name"))


@query(
    "n04_normalised_profile",
    """SELECT segment_final, measure, value, CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE 0.5 END AS scaled FROM (
      SELECT *, min(value) OVER (PARTITION BY measure) AS lo, max(value) OVER (PARTITION BY measure) AS hi FROM (
        UNPIVOT (SELECT segment_final, avg(NBENF) AS NBENF, avg(MEDIAN_RESSO) AS MEDIAN_RESSO FROM segmented GROUP BY segment_final)
        ON NBENF, MEDIAN_RESSO INTO NAME measure VALUE value))""",
    doubles="value scaled",
)
def n04(spark, folder):
    long = segments.segment_means(segmented(spark, folder), ["NBENF", "MEDIAN_RESSO"]).unpivot(["segment_final"], ["NBENF", "MEDIAN_RESSO"], "measure", "value")
    return segments.normalise_profile(long, "measure", "value")


@query(
    "q10_interventions",
    """SELECT segment_final, count(IS_CHURN) AS clients, avg(IS_CHURN) * 100 AS churn_pct, avg(IS_EARLY_SETTLER) * 100 AS settler_pct,
      avg(s) * 100 AS lifecycle_pct, avg(CASE WHEN s > 0.75 THEN 1.0 ELSE 0 END) * 100 AS final_quarter_pct,
      avg(CASE WHEN s BETWEEN 0.25 AND 0.75 THEN 1.0 ELSE 0 END) * 100 AS mid_contract_pct, avg(CASE WHEN MEDIAN_RESSO > 0 THEN TOTAL_MTFINO / MEDIAN_RESSO END) AS lti,
      CASE segment_final WHEN 1 THEN 'High Risk / Overdue' WHEN 2 THEN 'High Value' WHEN 3 THEN 'High External Credit' ELSE 'Base / Dormant' END AS name,
      CASE segment_final WHEN 1 THEN 50 WHEN 2 THEN 25 WHEN 3 THEN 40 ELSE 75 END AS window_start,
      CASE segment_final WHEN 1 THEN 75 WHEN 2 THEN 40 WHEN 3 THEN 60 ELSE 100 END AS window_end,
      CASE segment_final WHEN 1 THEN 'Recovery restructuring' WHEN 2 THEN 'Refinancing offer' WHEN 3 THEN 'Competitive proposal' ELSE 'Renewal campaign' END AS intervention
    FROM (SELECT *, least(greatest((DATE '2001-12-31' - LAST_DCREAT) / 365.25 * 12 / (MEDIAN_DURDEG + 1e-6), 0), 1) AS s FROM segmented) GROUP BY segment_final""",
    doubles="churn_pct settler_pct lifecycle_pct final_quarter_pct mid_contract_pct lti",
)
def q10(spark, folder):
    return segments.intervention_table(segmented(spark, folder), "2001-12-31")


@query("h05_seeded_sample", "SELECT CONTRIB FROM clients ORDER BY md5('42|' || CAST(CONTRIB AS VARCHAR)), CONTRIB LIMIT 20000")
def h05(spark, folder):
    """A sample of clients as large as the silhouette needs."""
    return segments.seeded_sample(stored_abt(spark, folder), 20_000).select("CONTRIB")


@query(
    "h05_sampled_lines",
    "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY md5('7|' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)), l_orderkey * 10 + l_linenumber LIMIT 20000",
)
def h05_lines(spark, folder):
    rows = bindings.table(spark, folder, "lineitem").withColumn("line", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return segments.seeded_sample(rows, 20_000, "line", 7).select("l_orderkey", "l_linenumber")


@query("q01_cluster_sweep")
def q01(spark, folder):
    return segments.sweep_clusters(points(spark, folder), _XY, "c_custkey")


@query("q02_perspective_clusters")
def q02(spark, folder):
    out, _ = segments.assign_clusters(points(spark, folder), _XY, "cluster", 3, "c_custkey")
    return segments.cluster_distribution(out, "cluster").join(segments.group_centroids(out, "cluster", _XY), "cluster")


@query("q04_segment_merge")
def q04(spark, folder):
    rows = points(spark, folder).withColumns({"b": F.col("c_custkey") % 3, "a": F.col("label") % 3})
    merged = segments.merge_segments(rows, ["a", "b"], _XY, 4)
    return segments.cluster_distribution(merged, "segment_final")


@query("u07_cluster_table")
def u07(spark, folder):
    """The clustering table merged to segments, with segment sizes, means of all its columns and the rows rejected before."""
    from stayline.plans.clustering import build_cluster_table, build_segments

    built = build_cluster_table(stored_abt(spark, folder))
    out = build_segments(built.table)
    means = segments.group_centroids(out, "segment_final", numeric_columns(built.table, ("CONTRIB",)))
    sizes = segments.cluster_distribution(out, "segment_final").withColumn("rejected", F.lit(built.rejected.count()))
    return sizes.join(means, "segment_final")


# ------------------------------------------------------------------ fitted preprocessing


@query(
    "d08_median_imputer",
    """SELECT SEQ_EVENT, coalesce(MT_MENSAL, (SELECT median(MT_MENSAL) FROM bureau_raw)) AS MT_MENSAL,
      coalesce(DIVIDAS_CL, (SELECT median(DIVIDAS_CL) FROM bureau_raw)) AS DIVIDAS_CL FROM bureau_raw""",
    doubles="MT_MENSAL DIVIDAS_CL",
)
def d08(spark, folder):
    from stayline.ml.preprocess import ClientImputer

    rows = bindings.bureau(spark, folder).select("SEQ_EVENT", "MT_MENSAL", "DIVIDAS_CL")
    return ClientImputer(keep=["SEQ_EVENT"]).fit(rows).transform(rows)


@query(
    "d08_mean_imputer",
    "SELECT SEQ_EVENT, coalesce(MT_MENSAL, (SELECT avg(MT_MENSAL) FROM bureau_raw)) AS MT_MENSAL FROM bureau_raw",
    doubles="MT_MENSAL",
)
def d08_mean(spark, folder):
    from stayline.ml.preprocess import ClientImputer

    rows = bindings.bureau(spark, folder).select("SEQ_EVENT", "MT_MENSAL")
    return ClientImputer(strategy="mean", keep=["SEQ_EVENT"]).fit(rows).transform(rows)


@query("d10_iterative_imputer")
def d10(spark, folder):
    from stayline.ml.iterative import IterativeImputer

    rows = bindings.bureau(spark, folder)
    columns = numeric_columns(rows, ("CONTRIB", "SEQ_EVENT"))
    filled = IterativeImputer(columns=columns).fit(rows).transform(rows)
    return filled.agg(*[F.avg(c).alias(c) for c in columns], *[F.count(c).alias(f"n_{c}") for c in columns])


_HOT = " ".join(f"sdem_HABITAT_{v}" for v in "AEFLOPX")


def _one_hot_sql(values, c):
    return ", ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}" for v in values)


@query("n01_one_hot", f"SELECT CONTRIB, {_one_hot_sql('AEFLOPX', 'sdem_HABITAT')} FROM fama_raw")
def n01(spark, folder):
    from stayline.ml.preprocess import OneHotEncoder

    rows = bindings.client_aggregates(spark, folder).select("CONTRIB", "sdem_HABITAT")
    return OneHotEncoder(columns=["sdem_HABITAT"]).fit(rows).transform(rows)


@query("n02_one_hot_reference", f"SELECT CONTRIB, {_one_hot_sql('DFPSUVX', 'sdem_SITFAM')} FROM fama_raw")
def n02(spark, folder):
    from stayline.ml.preprocess import OneHotEncoder

    rows = bindings.client_aggregates(spark, folder).select("CONTRIB", "sdem_SITFAM")
    return OneHotEncoder(columns=["sdem_SITFAM"], dropFirst=True).fit(rows).transform(rows)


def _scaled(c):
    return f"({c} - (SELECT median({c}) FROM bureau_raw)) / (SELECT CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN 1 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END FROM bureau_raw) AS {c}"


@query("n03_quartile_scaler", f"SELECT SEQ_EVENT, {_scaled('MT_MENSAL')}, {_scaled('DIVIDAS_CL')}, {_scaled('MONTABATV_CL')} FROM bureau_raw", doubles="MT_MENSAL DIVIDAS_CL MONTABATV_CL")
def n03(spark, folder):
    from stayline.ml.preprocess import QuartileScaler

    rows = bindings.bureau(spark, folder).select("SEQ_EVENT", "MT_MENSAL", "DIVIDAS_CL", "MONTABATV_CL")
    return QuartileScaler(exclude=["SEQ_EVENT"]).fit(rows).transform(rows)
