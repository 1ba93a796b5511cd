"""Contract and client aggregation and the base table."""

from __future__ import annotations

from stayline.catalog.base import query
from stayline.operators import contracts, rates
from stayline.plans import abt as plan
from stayline.plans import bindings

CONTRACT_DATES = "DPOS DCREAT DATFIN D1FIN OBS_DATE_SOL OBS_DATE_SAN OBS_DATE_RBT"
CLIENT_DATES = (
    "FIRST_DCREAT LAST_DCREAT LAST_DPOS LAST_DATFIN FIRST_D1FIN "
    "LAST_OBS_DATE_SOL LAST_OBS_DATE_SAN LAST_OBS_DATE_RBT"
)
CLIENT_AMOUNTS = (
    "TOTAL_MTFIN TOTAL_MTFINO TOTAL_MENSALIDADE TOTAL_CRD TOTAL_SREC TOTAL_RN TOTAL_RD "
    "MIN_RESSO MAX_RESSO MEDIAN_RESSO MEDIAN_DURDEG MEDIAN_RANGPRO MEDIAN_RANGCLI TIME_TO_CHURN_D"
)
BUREAU_AMOUNTS = " ".join(f"{c}_{m}" for c in contracts.BUREAU_COLUMNS for m in ("MIN", "MAX", "MEDIAN"))


def sized_loans(spark, folder):
    raw = bindings.loans(spark, folder)
    sizes = contracts.measure_sizes(raw)
    return plan.prepared_loans(raw, bindings.SEQUENCE, sizes=sizes), sizes


def client_base(spark, folder):
    return plan.client_base(*sized_loans(spark, folder))


@query(
    "g01_first_status_dates",
    """SELECT CONTRIB, DOSSIER, OBS_DATE_SOL, OBS_DATE_SAN, OBS_DATE_RBT, HAS_SOL, HAS_SAN, HAS_RBT
    FROM contracts WHERE HAS_SOL + HAS_SAN + HAS_RBT > 0""",
    dates="OBS_DATE_SOL OBS_DATE_SAN OBS_DATE_RBT",
)
def first_status_dates(spark, folder):
    return contracts.first_status_dates(sized_loans(spark, folder)[0])


@query(
    "g02_contract_table",
    "SELECT * FROM contracts",
    doubles="CRD SREC RN RD MTFIN MTFINO MENSALIDADE RESSO",
    dates=CONTRACT_DATES,
)
def contract_table(spark, folder):
    rows, sizes = sized_loans(spark, folder)
    return contracts.contract_table(rows, sizes=sizes)


@query("g03_client_table", "SELECT * FROM clients", doubles=CLIENT_AMOUNTS, dates=CLIENT_DATES)
def client_table(spark, folder):
    return client_base(spark, folder)


@query("g04_bureau_table", "SELECT * FROM bureau_client", doubles=BUREAU_AMOUNTS)
def bureau_table(spark, folder):
    return contracts.bureau_table(plan.prepared_bureau(bindings.bureau(spark, folder), ["SEQ_EVENT"]))


@query(
    "g17_outcome_matrix",
    """SELECT IS_EARLY_SETTLER, IS_CHURN, count(*) AS clients,
      count(*) * 100.0 / sum(count(*)) OVER () AS share_pct,
      CAST(sum(CASE WHEN IS_CHURN = 1 THEN count(*) ELSE 0 END) OVER (PARTITION BY IS_EARLY_SETTLER) AS DOUBLE) * 100.0
        / sum(count(*)) OVER (PARTITION BY IS_EARLY_SETTLER) AS group_churn_pct
    FROM clients GROUP BY IS_EARLY_SETTLER, IS_CHURN""",
    doubles="share_pct group_churn_pct",
)
def outcome_matrix(spark, folder):
    return rates.outcome_matrix(client_base(spark, folder))


@query(
    "u06_base_table",
    "SELECT * FROM abt",
    doubles=f"{CLIENT_AMOUNTS} {BUREAU_AMOUNTS} kp_sqe_enc ks_score_tier",
    dates=f"{CLIENT_DATES} sys_data_procura",
)
def base_table(spark, folder):
    return plan.build_abt(spark, folder)
