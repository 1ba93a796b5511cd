"""Portfolio queries over scored active clients."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.catalog.base import VIEWS, query
from stayline.functions import portfolio as fx
from stayline.plans import portfolio
from stayline.plans.abt import stored_abt
from stayline.plans.portfolio import Search

SCORE_SQL = (
    "CAST(CONTRIB * 37 % 101 AS DOUBLE) / 100 AS Prob_SAN, CAST(CONTRIB * 53 % 101 AS DOUBLE) / 100 AS Prob_Churn, "
    "CASE WHEN CONTRIB % 5 <> 0 THEN CAST(CONTRIB % 5 AS INTEGER) END AS segment_final"
)


def scored_clients(spark, folder):
    """Clients of the base table with stand-in scores that both engines can compute."""
    k = F.col("CONTRIB")
    return stored_abt(spark, folder).withColumns(
        {
            "Prob_SAN": (k * 37 % 101).cast("double") / 100,
            "Prob_Churn": (k * 53 % 101).cast("double") / 100,
            "segment_final": F.when(k % 5 != 0, (k % 5).cast("int")),
        }
    )


def portfolio_table(spark, folder):
    return portfolio.portfolio_table(scored_clients(spark, folder))


VIEWS["scored_clients"] = f"SELECT *, {SCORE_SQL} FROM abt"
VIEWS["portfolio_filled"] = """
SELECT * EXCLUDE (Prob_SAN, Prob_Churn, segment_final), coalesce(Prob_SAN, 0) AS P_SAN,
  coalesce(Prob_Churn, 0) AS P_CHURN, coalesce(segment_final, 0) AS CLUSTER FROM scored_clients"""
VIEWS["portfolio"] = """
SELECT *, CASE
  WHEN CLUSTER = 1 THEN CASE WHEN P_CHURN >= 0.60 THEN 'Urgent restructuring' ELSE 'Debt monitoring' END
  WHEN CLUSTER = 2 THEN CASE WHEN P_SAN >= 0.65 AND P_CHURN >= 0.55 THEN 'Urgent retention'
    WHEN P_SAN >= 0.65 THEN 'Refinancing offer' ELSE 'Upsell opportunity' END
  WHEN CLUSTER = 3 THEN CASE WHEN P_CHURN >= 0.55 THEN 'Competitive proposal'
    WHEN P_SAN >= 0.55 THEN 'Consolidation offer' ELSE 'Monitor' END
  WHEN CLUSTER = 4 THEN CASE WHEN P_CHURN >= 0.60 THEN 'Renewal campaign'
    WHEN P_SAN < 0.35 AND P_CHURN < 0.35 THEN 'Cross-sell' ELSE 'Standard follow-up' END
  ELSE 'Standard follow-up' END AS ACTION,
  round(TOTAL_MTFINO * 0.08 * (MEDIAN_DURDEG / 12) * P_SAN, 2) AS REVENUE_AT_RISK
FROM portfolio_filled"""
SHOWN = "CONTRIB, P_SAN, P_CHURN, CLUSTER, ACTION, REVENUE_AT_RISK"
SHOWN_LIST = SHOWN.split(", ")
FOUND = (
    "FROM portfolio WHERE CLUSTER <> 0 AND contains(CAST(CONTRIB AS VARCHAR), '1') AND P_SAN BETWEEN 0.2 AND 0.9 "
    "AND P_CHURN BETWEEN 0.1 AND 0.95 AND CLUSTER IN (1, 2, 4)"
)
REQUEST = Search(text="1", hide_unassigned=True, settlement=(0.2, 0.9), churn=(0.1, 0.95), segments=(1, 2, 4))


@query("t01_portfolio_table", f"SELECT {SHOWN} FROM portfolio", doubles="P_SAN P_CHURN REVENUE_AT_RISK", places=1)
def t01(spark, folder):
    return portfolio_table(spark, folder).select(*SHOWN_LIST)


@query("t02_client_search", f"SELECT {SHOWN} {FOUND}", doubles="P_SAN P_CHURN REVENUE_AT_RISK", places=1)
def t02(spark, folder):
    return portfolio.search(portfolio_table(spark, folder), REQUEST).select(*SHOWN_LIST)


@query(
    "h03_search_page",
    f"""SELECT {SHOWN} FROM (SELECT *, row_number() OVER (ORDER BY REVENUE_AT_RISK DESC, CONTRIB) AS place, count(*) OVER () AS found
      FROM (SELECT {SHOWN} {FOUND}) f) g
    WHERE (place - 1) // 50 = least(1, (found - 1) // 50)""",
    doubles="P_SAN P_CHURN REVENUE_AT_RISK",
    places=1,
)
def h03(spark, folder):
    found = portfolio.search(portfolio_table(spark, folder), REQUEST)
    return portfolio.page(found, REQUEST, 1).select(*SHOWN_LIST)


@query(
    "h03_keyset_page",
    """SELECT CONTRIB, P_CHURN FROM portfolio WHERE P_CHURN < 0.5 OR (P_CHURN = 0.5 AND CONTRIB > 20)
    ORDER BY P_CHURN DESC, CONTRIB LIMIT 50""",
    doubles="P_CHURN",
)
def h03_keyset(spark, folder):
    request = Search(sort="churn")
    found = portfolio.search(portfolio_table(spark, folder), request)
    return portfolio.page_after(found, request, 0.5, 20).select("CONTRIB", "P_CHURN")


@query(
    "g27_search_summary",
    f"""SELECT count(*) AS clients, count(CASE WHEN starts_with(ACTION, 'Urgent') THEN 1 END) AS urgent,
    coalesce(sum(REVENUE_AT_RISK), 0) AS revenue_at_risk {FOUND}""",
    doubles="revenue_at_risk",
    places=0,
)
def g27(spark, folder):
    return portfolio.search_summary(portfolio.search(portfolio_table(spark, folder), REQUEST))


@query("c19_empty_selection", "SELECT count(*) AS clients FROM portfolio WHERE 1 = 0")
def c19_empty(spark, folder):
    found = portfolio.search(portfolio_table(spark, folder), Search(segments=()))
    return found.agg(F.count("*").alias("clients"))


@query(
    "t03_client_profile",
    """SELECT CONTRIB, P_SAN, P_CHURN, CLUSTER, ACTION, REVENUE_AT_RISK,
    CASE WHEN P_SAN >= 0.6 THEN 'High risk' WHEN P_SAN >= 0.4 THEN 'Moderate' ELSE 'Low risk' END AS SETTLEMENT_BAND,
    CASE WHEN P_CHURN >= 0.6 THEN 'High risk' WHEN P_CHURN >= 0.4 THEN 'Moderate' ELSE 'Low risk' END AS CHURN_BAND,
    CASE CLUSTER WHEN 1 THEN 'High Risk / Overdue' WHEN 2 THEN 'High Value' WHEN 3 THEN 'High External Credit'
      WHEN 4 THEN 'Base / Dormant' ELSE 'Unknown' END AS SEGMENT_NAME
    FROM portfolio WHERE CONTRIB = 42""",
    doubles="P_SAN P_CHURN REVENUE_AT_RISK",
    places=1,
)
def t03(spark, folder):
    return portfolio.client_profile(portfolio_table(spark, folder), 42).select(
        *SHOWN_LIST, "SETTLEMENT_BAND", "CHURN_BAND", "SEGMENT_NAME"
    )


@query(
    "t03_client_details",
    """SELECT * FROM (
    SELECT CONTRIB, 'PRODALP' AS field, PRODALP AS value FROM portfolio WHERE CONTRIB = 42 UNION ALL
    SELECT CONTRIB, 'sdem_age', CAST(sdem_age AS VARCHAR) FROM portfolio WHERE CONTRIB = 42 UNION ALL
    SELECT CONTRIB, 'N_CONTRACTS', CAST(N_CONTRACTS AS VARCHAR) FROM portfolio WHERE CONTRIB = 42 UNION ALL
    SELECT CONTRIB, 'NBENF', CAST(NBENF AS VARCHAR) FROM portfolio WHERE CONTRIB = 42 UNION ALL
    SELECT CONTRIB, 'MEDIAN_DURDEG', CAST(MEDIAN_DURDEG AS VARCHAR) FROM portfolio WHERE CONTRIB = 42
    ) WHERE value IS NOT NULL""",
)
def t03_details(spark, folder):
    fields = ["PRODALP", "sdem_age", "N_CONTRACTS", "NBENF", "MEDIAN_DURDEG"]
    return portfolio.client_details(portfolio_table(spark, folder), 42, fields)


@query(
    "g25_portfolio_kpis",
    """SELECT count(*) AS clients, count(CASE WHEN P_SAN >= 0.6 THEN 1 END) AS settlement_risk,
    count(CASE WHEN P_CHURN >= 0.6 THEN 1 END) AS churn_risk,
    coalesce(sum(CASE WHEN P_SAN >= 0.6 THEN REVENUE_AT_RISK END), 0) AS revenue_at_risk FROM portfolio""",
    doubles="revenue_at_risk",
    places=0,
)
def g25(spark, folder):
    return portfolio.portfolio_kpis(portfolio_table(spark, folder))


_PRIORITY = " ".join(f"WHEN '{a}' THEN {i + 1}" for i, a in enumerate(fx.ACTIONS))


@query(
    "g26_action_breakdown",
    f"""SELECT CASE ACTION {_PRIORITY} END AS priority, ACTION, count(*) AS clients,
    count(*) * 100.0 / sum(count(*)) OVER () AS share_pct FROM portfolio GROUP BY ACTION""",
    doubles="share_pct",
)
def g26(spark, folder):
    return portfolio.action_breakdown(portfolio_table(spark, folder))


@query(
    "h02_top_clients",
    """SELECT CONTRIB, P_SAN, P_CHURN, ACTION, REVENUE_AT_RISK FROM portfolio
    WHERE REVENUE_AT_RISK IS NOT NULL ORDER BY REVENUE_AT_RISK DESC, CONTRIB LIMIT 10""",
    doubles="P_SAN P_CHURN REVENUE_AT_RISK",
    places=1,
)
def h02(spark, folder):
    return portfolio.top_clients(portfolio_table(spark, folder))


@query(
    "g28_segment_cards",
    """SELECT s.CLUSTER, s.name, count(p.CLUSTER) AS clients,
      count(p.CLUSTER) * 100.0 / (SELECT greatest(count(*), 1) FROM portfolio) AS share_pct,
      avg(p.P_SAN) AS avg_p_san, avg(p.P_CHURN) AS avg_p_churn
    FROM (VALUES (1, 'High Risk / Overdue'), (2, 'High Value'), (3, 'High External Credit'), (4, 'Base / Dormant'))
      AS s(CLUSTER, name) LEFT JOIN portfolio p ON p.CLUSTER = s.CLUSTER GROUP BY s.CLUSTER, s.name""",
    doubles="share_pct avg_p_san avg_p_churn",
)
def g28(spark, folder):
    return portfolio.segment_cards(portfolio_table(spark, folder))


_SENTENCES = " ".join(f"WHEN '{a}' THEN '{g[0]}'" for a, g in fx.GUIDANCE.items())
_STEPS = " ".join(f"WHEN '{a}' THEN '{' | '.join(g[1])}'" for a, g in fx.GUIDANCE.items())


@query(
    "k46_action_guidance",
    f"""SELECT CONTRIB, ACTION,
      replace(replace(CASE ACTION {_SENTENCES} END, '{{san}}', CAST(CAST(round_even(P_SAN * 100, 0) AS INTEGER) AS VARCHAR) || '%'),
        '{{churn}}', CAST(CAST(round_even(P_CHURN * 100, 0) AS INTEGER) AS VARCHAR) || '%') AS guidance,
      CASE ACTION {_STEPS} END AS steps,
      CASE CLUSTER WHEN 1 THEN 50 WHEN 2 THEN 25 WHEN 3 THEN 40 WHEN 4 THEN 75 ELSE 0 END AS window_start,
      CASE CLUSTER WHEN 1 THEN 75 WHEN 2 THEN 40 WHEN 3 THEN 60 WHEN 4 THEN 100 ELSE 100 END AS window_end
    FROM portfolio""",
)
def k46(spark, folder):
    return portfolio.with_guidance(portfolio_table(spark, folder)).select(
        "CONTRIB", "ACTION", F.col("GUIDANCE").alias("guidance"), F.array_join("NEXT_STEPS", " | ").alias("steps"),
        F.col("WINDOW_START").alias("window_start"), F.col("WINDOW_END").alias("window_end"),
    )


@query(
    "h04_ranked_scores",
    "SELECT CONTRIB, Prob_Churn FROM scored_clients WHERE HAS_ACTIVE = 1",
    doubles="Prob_Churn",
)
def h04(spark, folder):
    return scored_clients(spark, folder).filter("HAS_ACTIVE = 1").select("CONTRIB", "Prob_Churn").orderBy(
        F.desc("Prob_Churn"), "CONTRIB"
    )


@query("g30_label_counts", """SELECT CASE WHEN Prob_Churn >= 0.5 THEN 1 ELSE 0 END AS Pred_Churn_Label, count(*) AS rows
    FROM scored_clients GROUP BY 1""")
def g30(spark, folder):
    from stayline.operators.clean import label_counts

    labelled = scored_clients(spark, folder).withColumn("Pred_Churn_Label", (F.col("Prob_Churn") >= 0.5).cast("int"))
    return label_counts(labelled, "Pred_Churn_Label")


@query(
    "b11_probability_histogram",
    """SELECT IS_CHURN, bin, count(*) AS rows, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY IS_CHURN) AS share FROM (
      SELECT IS_CHURN, CAST(least(greatest(floor((Prob_Churn - lo) * 50 / (hi - lo)), 0), 49) AS BIGINT) AS bin
      FROM scored_clients, (SELECT min(Prob_Churn) AS lo, max(Prob_Churn) AS hi FROM scored_clients))
    GROUP BY IS_CHURN, bin""",
    doubles="share",
)
def b11(spark, folder):
    from stayline.operators.profile import probability_histogram

    return probability_histogram(scored_clients(spark, folder), "Prob_Churn", "IS_CHURN")
