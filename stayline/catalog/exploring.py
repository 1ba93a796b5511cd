"""Rates and profiles over the base table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.catalog.base import VIEWS, query
from stayline.functions import features, labels, targets
from stayline.functions.columns import years_before
from stayline.operators import rates
from stayline.operators.profile import density_curve
from stayline.plans.abt import stored_abt

REFERENCE_DAY = "2001-12-31"
_RATE = "avg({t}) * 100 AS rate_pct, count({t}) AS clients"


def rate_sql(key: str, target: str, least: int) -> str:
    return (
        f"SELECT {key} AS key, avg({target}) * 100 AS rate_pct, count({target}) AS clients FROM abt "
        f"WHERE {key} IS NOT NULL GROUP BY 1 HAVING count({target}) >= {least}"
    )


def _register_rates():
    for target, short in (("IS_EARLY_SETTLER", "settle"), ("IS_CHURN", "churn")):
        for column in ("sdem_SITFAM", "sdem_HABITAT"):
            name = column.split("_")[1].lower()
            query(
                f"g10_rate_{name}_{short}",
                f"""SELECT key, rate_pct, clients, CASE WHEN rate_pct > median(rate_pct) OVER () THEN 1 ELSE 0 END AS above_median
                FROM (SELECT * FROM ({rate_sql(column, target, 20)}) ORDER BY rate_pct DESC, key LIMIT 10)""",
                doubles="rate_pct",
            )(lambda s, f, c=column, t=target: rates.category_rate(stored_abt(s, f), c, t))
        for column in ("NBENF", "N_CONTRACTS", "MAX_RISKA"):
            query(f"g10_rate_{column.lower()}_{short}", rate_sql(column, target, 20), doubles="rate_pct")(
                lambda s, f, c=column, t=target: rates.grouped_rate(stored_abt(s, f), c, t)
            )
        query(
            f"g20_top_profession_{short}",
            f"""SELECT key, rate_pct, clients, CASE WHEN rate_pct > median(rate_pct) OVER () THEN 1 ELSE 0 END AS above_median
            FROM (SELECT CSP AS key, avg({target}) * 100 AS rate_pct, count({target}) AS clients FROM abt
              WHERE CSP IN (SELECT CSP FROM abt GROUP BY CSP ORDER BY count(*) DESC, CSP LIMIT 5)
              GROUP BY CSP HAVING count(*) >= 20 ORDER BY rate_pct DESC, key LIMIT 10)""",
            doubles="rate_pct",
        )(lambda s, f, t=target: rates.top_category_rate(stored_abt(s, f), "CSP", t, categories=5))
        query(
            f"g11_rate_by_month_{short}", rate_sql("strftime(LAST_DPOS, '%Y-%m')", target, 20), doubles="rate_pct"
        )(lambda s, f, t=target: rates.rate_by_month(stored_abt(s, f), "LAST_DPOS", t))
        query(
            f"g12_rate_by_cohort_{short}",
            rate_sql("CAST(year(LAST_DCREAT) AS VARCHAR) || 'Q' || CAST(quarter(LAST_DCREAT) AS VARCHAR)", target, 30),
            doubles="rate_pct",
        )(lambda s, f, t=target: rates.rate_by_cohort(stored_abt(s, f), "LAST_DCREAT", t))
        query(
            f"g13_rate_by_stage_{short}",
            f"""SELECT s.position, s.stage, avg(a.t) * 100 AS rate_pct, count(a.t) AS clients
            FROM (VALUES (1, '0-25%', -1, 25), (2, '25-50%', 25, 50), (3, '50-75%', 50, 75), (4, '75-100%', 75, 100))
              AS s(position, stage, lo, hi)
            LEFT JOIN (SELECT {target} AS t, {LIFECYCLE_SQL} AS p FROM abt) a ON a.p > s.lo AND a.p <= s.hi
            GROUP BY s.position, s.stage""",
            doubles="rate_pct",
        )(lambda s, f, t=target: rates.rate_by_stage(stored_abt(s, f), lifecycle(), t))
        query(f"g14_seasonality_{short}", rate_sql("month(LAST_DPOS)", target, 20), doubles="rate_pct key")(
            lambda s, f, t=target: rates.rate_by_season(stored_abt(s, f), "LAST_DPOS", t)
        )
        query(
            f"g15_mean_profile_{short}",
            f"""SELECT {target}, measure, mean, CASE WHEN max(mean) OVER (PARTITION BY measure) <> 0
              THEN mean / max(mean) OVER (PARTITION BY measure) END AS relative FROM (
              UNPIVOT (SELECT {target}, avg(MEDIAN_RESSO) AS MEDIAN_RESSO, avg(TOTAL_MTFINO) AS TOTAL_MTFINO,
                avg(MEDIAN_DURDEG) AS MEDIAN_DURDEG, avg(CAST(N_CONTRACTS AS DOUBLE)) AS N_CONTRACTS FROM abt GROUP BY {target})
              ON MEDIAN_RESSO, TOTAL_MTFINO, MEDIAN_DURDEG, N_CONTRACTS INTO NAME measure VALUE mean)""",
            doubles="mean relative",
            places=4,
        )(lambda s, f, t=target: rates.mean_profile(stored_abt(s, f), t))
        query(
            f"g16_median_debt_{short}",
            " UNION ALL ".join(
                f"SELECT {target}, '{c}' AS measure, median({c}) AS median FROM abt GROUP BY {target}"
                for c in rates.DEBT_COLUMNS
            ),
            doubles="median",
        )(lambda s, f, t=target: rates.median_by_target(stored_abt(s, f), t))


def lifecycle():
    age = features.contract_age_months("LAST_DPOS", "FIRST_DCREAT")
    return features.lifecycle_percent(age, "MEDIAN_DURDEG")


LIFECYCLE_SQL = (
    "CASE WHEN MEDIAN_DURDEG <> 0 THEN least(greatest("
    "greatest((LAST_DPOS - FIRST_DCREAT) / 30.44, 0) / MEDIAN_DURDEG, 0), 1) * 100 END"
)
_register_rates()


@query(
    "g18_quadrant_profile",
    "SELECT quadrant, "
    + ", ".join(
        f"avg(CASE WHEN hi_{c} > lo_{c} THEN ({c} - lo_{c}) / (hi_{c} - lo_{c}) ELSE 0.5 END) AS {c}"
        for c in rates.QUADRANT_COLUMNS
    )
    + " FROM (SELECT CASE WHEN IS_EARLY_SETTLER = 1 THEN 'SAN' ELSE 'Mat' END || '+' || "
    "CASE WHEN IS_CHURN = 1 THEN 'Churned' ELSE 'Renewed' END AS quadrant, "
    + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}, CAST(min({c}) OVER () AS DOUBLE) AS lo_{c}, CAST(max({c}) OVER () AS DOUBLE) AS hi_{c}"
        for c in rates.QUADRANT_COLUMNS
    )
    + " FROM abt) GROUP BY quadrant",
    doubles=" ".join(rates.QUADRANT_COLUMNS),
)
def g18(spark, folder):
    return rates.quadrant_profile(stored_abt(spark, folder))


@query(
    "g19_two_target_profession",
    """SELECT CSP, avg(IS_EARLY_SETTLER) * 100 AS settler_pct, avg(IS_CHURN) * 100 AS churn_pct FROM abt
    WHERE CSP IN (SELECT CSP FROM abt GROUP BY CSP ORDER BY count(*) DESC, CSP LIMIT 10) GROUP BY CSP""",
    doubles="settler_pct churn_pct",
)
def g19(spark, folder):
    return rates.two_target_rates(stored_abt(spark, folder), "CSP", 10)


@query(
    "g19_two_target_risk",
    """SELECT MAX_RISKA, avg(IS_EARLY_SETTLER) * 100 AS settler_pct, avg(IS_CHURN) * 100 AS churn_pct
    FROM abt WHERE MAX_RISKA IS NOT NULL GROUP BY MAX_RISKA""",
    doubles="settler_pct churn_pct",
)
def g19_risk(spark, folder):
    return rates.two_target_rates(stored_abt(spark, folder), "MAX_RISKA")


@query(
    "g21_value_shares",
    "SELECT PRODALP, count(*) AS rows, count(*) * 1.0 / sum(count(*)) OVER () AS share FROM abt WHERE PRODALP IS NOT NULL GROUP BY PRODALP",
    doubles="share",
)
def g21(spark, folder):
    return rates.value_shares(stored_abt(spark, folder), "PRODALP")


VIEWS["segmented"] = """
SELECT *, CAST(CONTRIB % 4 + 1 AS INTEGER) AS segment_final,
  CASE WHEN IS_EARLY_SETTLER = 1 AND IS_CHURN = 1 THEN 1 ELSE 0 END AS CHURN_EARLY,
  CASE WHEN IS_EARLY_SETTLER = 0 AND EVER_SOL = 1 AND IS_CHURN = 1 THEN 1 ELSE 0 END AS CHURN_NATURAL
FROM abt"""


def segmented(spark, folder):
    """Base table with stand-in segments that both engines can compute."""
    return stored_abt(spark, folder).withColumns(
        {
            "segment_final": (F.col("CONTRIB") % 4 + 1).cast("int"),
            "CHURN_EARLY": targets.churn_early(),
            "CHURN_NATURAL": targets.churn_natural(),
        }
    )


_OUTCOMES = """SELECT segment_final, count(IS_CHURN) AS clients, avg(IS_EARLY_SETTLER) * 100 AS settler_pct,
  avg(N_SAN) AS avg_n_san, avg(IS_CHURN) * 100 AS churn_pct, avg(CHURN_EARLY) * 100 AS churn_early_pct,
  avg(CHURN_NATURAL) * 100 AS churn_natural_pct FROM segmented GROUP BY segment_final"""


@query(
    "g24_segment_outcomes",
    _OUTCOMES,
    doubles="settler_pct avg_n_san churn_pct churn_early_pct churn_natural_pct",
)
def g24(spark, folder):
    return rates.segment_outcomes(segmented(spark, folder))


@query(
    "g22_weighted_average",
    f"""SELECT sum(settler_pct * clients) / sum(clients) AS settler_pct, sum(churn_pct * clients) / sum(clients) AS churn_pct
    FROM ({_OUTCOMES})""",
    doubles="settler_pct churn_pct",
)
def g22(spark, folder):
    outcomes = rates.segment_outcomes(segmented(spark, folder))
    return rates.weighted_averages(outcomes, ["settler_pct", "churn_pct"], "clients")


STAGE_SQL = (
    f"least(greatest((DATE '{REFERENCE_DAY}' - LAST_DCREAT) / 365.25 * 12 / (MEDIAN_DURDEG + 1e-6), 0), 1)"
)


@query(
    "g23_conditional_shares",
    f"""SELECT segment_final, avg(CASE WHEN s > 0.75 THEN 1 ELSE 0 END) AS final_quarter,
      avg(CASE WHEN s >= 0.25 AND s <= 0.75 THEN 1 ELSE 0 END) AS mid_contract
    FROM (SELECT segment_final, {STAGE_SQL} AS s FROM segmented) GROUP BY segment_final""",
    doubles="final_quarter mid_contract",
)
def g23(spark, folder):
    stage = features.lifecycle_stage(years_before(REFERENCE_DAY, "LAST_DCREAT"), "MEDIAN_DURDEG")
    return (
        segmented(spark, folder)
        .withColumn("s", stage)
        .groupBy("segment_final")
        .agg(
            rates.share_where(F.col("s") > 0.75).alias("final_quarter"),
            rates.share_where(F.col("s").between(0.25, 0.75)).alias("mid_contract"),
        )
    )


def density_sql(rows: str) -> str:
    """Density curve of (grp, v) rows on 300 points after 1-99 % clipping."""
    return f"""WITH d_rows AS ({rows}),
    d_lim AS (SELECT grp, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM d_rows GROUP BY grp),
    d_clip AS (SELECT grp, least(greatest(v, lo), hi) AS v FROM d_rows JOIN d_lim USING (grp)),
    d_shape AS (SELECT grp, count(*) AS n, min(v) AS lo, max(v) AS hi, avg(v) AS mean,
      stddev_samp(v) * pow(count(*), -0.2) AS h FROM d_clip GROUP BY grp HAVING count(*) >= 20),
    d_grid AS (SELECT *, lo + point * ((hi - lo) / 299) AS x FROM d_shape, range(300) AS g(point) WHERE h > 0)
    SELECT grp AS "group", CAST(point AS INTEGER) AS point, x, mean, sum(exp(-0.5 * pow((x - v) / h, 2))) / (n * h * sqrt(2 * pi())) AS density
    FROM d_grid JOIN d_clip USING (grp) GROUP BY grp, point, x, mean, n, h"""


@query(
    "b10_density_by_target",
    density_sql("SELECT IS_EARLY_SETTLER AS grp, CAST(MEDIAN_RANGPRO AS DOUBLE) AS v FROM abt WHERE MEDIAN_RANGPRO IS NOT NULL"),
    doubles="x mean density",
)
def b10(spark, folder):
    return density_curve(stored_abt(spark, folder), "MEDIAN_RANGPRO", F.col("IS_EARLY_SETTLER"))


DTI_SQL = "CASE WHEN MEDIAN_RESSO <> 0 THEN least(greatest(TOTAL_MENSALIDADE / MEDIAN_RESSO, 0), 2) END"


@query(
    "b10_density_by_outcome",
    density_sql(
        f"""SELECT grp, v FROM (
        SELECT 'settler' AS grp, {DTI_SQL} AS v FROM abt WHERE IS_EARLY_SETTLER = 1 UNION ALL
        SELECT 'churner', {DTI_SQL} FROM abt WHERE IS_CHURN = 1 UNION ALL
        SELECT 'neither', {DTI_SQL} FROM abt WHERE IS_EARLY_SETTLER = 0 AND IS_CHURN = 0) WHERE v IS NOT NULL"""
    ).replace("{{", "{").replace("}}", "}"),
    doubles="x mean density",
)
def b10_outcome(spark, folder):
    rows = rates.exposure_columns(stored_abt(spark, folder)).select("DTI", rates.outcome_group().alias("outcome"))
    return density_curve(rows, "DTI", F.col("outcome"))


@query(
    "f07_code_labels",
    """SELECT CSP, CASE CSP WHEN 10 THEN 'Merchants' WHEN 20 THEN 'ManagingPartners' WHEN 30 THEN 'SeniorMgmt_Private'
      WHEN 40 THEN 'SeniorMgmt_Public' WHEN 60 THEN 'OfficeCommerce' WHEN 70 THEN 'PublicEmployees' WHEN 80 THEN 'Workers'
      WHEN 90 THEN 'Retired_Private' ELSE coalesce('Other_' || CAST(CSP AS VARCHAR), 'Unknown') END AS profession,
      count(*) AS clients FROM abt GROUP BY CSP""",
)
def f07(spark, folder):
    return stored_abt(spark, folder).groupBy("CSP").agg(F.count("*").alias("clients")).withColumn(
        "profession", labels.profession_name("CSP")
    )


@query(
    "k34_exposure",
    f"""SELECT CONTRIB, {DTI_SQL} AS DTI, CASE WHEN MEDIAN_RESSO <> 0 THEN least(greatest(TOTAL_MTFINO / MEDIAN_RESSO, 0), 50) END AS LTI,
    MAX_RESSO - MIN_RESSO AS INCOME_RANGE FROM abt""",
    doubles="DTI LTI INCOME_RANGE",
)
def k34(spark, folder):
    return rates.exposure_columns(stored_abt(spark, folder)).select("CONTRIB", "DTI", "LTI", "INCOME_RANGE")
