"""Aggregation of dated rows to one row per contract and per client."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.columns import flag
from stayline.functions.targets import ACTIVE_STATUS, END_STATUSES, churned, early_settler, time_to_churn
from stayline.operators.quantiles import aggregate_with_quantiles

CONTRACT_KEYS = ["CONTRIB", "DOSSIER"]
# ---- fixed values: column names of the data model ---------------------------
CONTRACT_LAST = [
    "DPOS",
    "DCREAT",
    "DATFIN",
    "D1FIN",
    "CRD",
    "SREC",
    "RISK",
    "RISKA",
    "RESSO",
    "CSP",
    "NBENF",
]
CONTRACT_MAX = ["DURDEG", "RANGPRO", "RANGCLI", "MTFINO", "MTFIN", "RN", "RD"]
CLIENT_SUM = ["MTFIN", "MTFINO", "MENSALIDADE", "CRD", "SREC", "RN", "RD"]
CLIENT_SPREAD = ["DURDEG", "RANGPRO", "RANGCLI", "RESSO"]
BUREAU_COLUMNS = [
    "MT_MENSAL",
    "COUNT_CL",
    "COUNT_AUTO",
    "COUNT_TOTAL",
    "MONTVENC_CL",
    "MONTVENC_CP",
    "MONTVENC_AUTO",
    "MONTVENC_HT",
    "DIVIDAS_CL",
    "DIVIDAS_CP",
    "DIVIDAS_AUTO",
    "DIVIDAS_HT",
]
# ---- end of fixed values -----------------------------------------------------


def last_filled(c: Column | str, *order: str) -> Column:
    """Last non-null value in the given order; the order must be unique in the group."""
    c = F.col(c) if isinstance(c, str) else c
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return F.max_by(c, F.when(c.isNotNull(), position))


def smallest_mode(c: Column | str) -> Column:
    """Most frequent value, the smallest of ties. For coded columns with few values."""
    return F.mode(c, deterministic=True)


def total(c: str) -> Column:
    """Sum with 0 for an all-null group."""
    return F.coalesce(F.sum(c), F.lit(0.0))


class Sizes(NamedTuple):
    """Largest groups of a contract table, the bounds of its per-group state."""

    rows_per_contract: int
    contracts_per_client: int


def measure_sizes(loans: DataFrame) -> Sizes:
    """Both sizes in one scan of the key columns; later steps only remove rows."""
    per_contract = loans.na.drop(subset=CONTRACT_KEYS).groupBy(*CONTRACT_KEYS).agg(F.count("*").alias("n"))
    per_client = per_contract.groupBy("CONTRIB").agg(F.max("n").alias("n"), F.count("*").alias("c"))
    row = per_client.agg(F.max("n"), F.max("c")).first()
    return Sizes(row[0] or 0, row[1] or 0)


def first_status_dates(loans: DataFrame) -> DataFrame:
    """First observation per end status and contract, with a flag each."""
    ended = loans.filter(F.col("POS").isin(*END_STATUSES)).na.drop(subset=CONTRACT_KEYS)
    dates = ended.groupBy(*CONTRACT_KEYS).agg(*_status_dates())
    return dates.withColumns(_status_flags())


def _status_dates() -> list[Column]:
    return [F.min(F.when(F.col("POS") == s, F.col("OBS_DATE"))).alias(f"OBS_DATE_{s}") for s in END_STATUSES]


def _status_flags() -> dict[str, Column]:
    return {f"HAS_{s}": F.col(f"OBS_DATE_{s}").isNotNull().cast("int") for s in END_STATUSES}


def contract_table(
    loans: DataFrame, order: tuple[str, ...] = ("OBS_DATE",), sizes: Sizes | None = None
) -> DataFrame:
    """One row per contract: last, largest, median and most frequent values and status dates.

    Status dates come from the same aggregation, so the table is shuffled once.
    """
    known = set(loans.columns)
    aggregates = [
        last_filled(flag(F.col("POS") == ACTIVE_STATUS), *order).alias("IS_ACT"),
        *[last_filled(c, *order).alias(c) for c in CONTRACT_LAST if c in known],
        *[F.max(c).alias(c) for c in CONTRACT_MAX if c in known],
        *_status_dates(),
    ]
    if "PRODALP" in known:
        aggregates.append(smallest_mode("PRODALP").alias("PRODALP"))
    out = aggregate_with_quantiles(
        loans,
        CONTRACT_KEYS,
        aggregates,
        {"MENSALIDADE": ("MENSALIDADE", 0.5)},
        group_size=sizes.rows_per_contract if sizes else None,
    )
    return out.withColumns(_status_flags())


def client_table(
    contracts: DataFrame, order: tuple[str, ...] = ("DCREAT", "DOSSIER"), sizes: Sizes | None = None
) -> DataFrame:
    """One row per client from its contracts."""
    known = set(contracts.columns)
    have = lambda *cols: all(c in known for c in cols)
    aggregates = [
        F.count("DOSSIER").alias("N_CONTRACTS"),
        F.max("IS_ACT").alias("HAS_ACTIVE"),
        F.min("DCREAT").alias("FIRST_DCREAT"),
        F.max("DCREAT").alias("LAST_DCREAT"),
    ]
    optional = {
        "LAST_DPOS": ("DPOS", F.max),
        "LAST_DATFIN": ("DATFIN", F.max),
        "FIRST_D1FIN": ("D1FIN", F.min),
        "MAX_RISKA": ("RISKA", F.max),
        "PRODALP": ("PRODALP", smallest_mode),
    }
    aggregates += [f(c).alias(name) for name, (c, f) in optional.items() if have(c)]
    for c in CLIENT_SPREAD:
        if have(c):
            aggregates += [F.min(c).alias(f"MIN_{c}"), F.max(c).alias(f"MAX_{c}")]
    aggregates += [total(c).alias(f"TOTAL_{c}") for c in CLIENT_SUM if have(c)]
    for name, c in {"LAST_RISK": "RISK", "CSP": "CSP", "NBENF": "NBENF"}.items():
        if have(c):
            aggregates.append(last_filled(c, *order).alias(name))
    for s in END_STATUSES:
        aggregates += [
            F.max(f"HAS_{s}").alias(f"EVER_{s}"),
            F.sum(f"HAS_{s}").alias(f"N_{s}"),
            F.max(f"OBS_DATE_{s}").alias(f"LAST_OBS_DATE_{s}"),
        ]
    specs = {f"MEDIAN_{c}": (c, 0.5) for c in CLIENT_SPREAD if have(c)}
    return aggregate_with_quantiles(
        contracts, ["CONTRIB"], aggregates, specs, group_size=sizes.contracts_per_client if sizes else None
    )


def with_targets(clients: DataFrame) -> DataFrame:
    return clients.withColumns(
        {"IS_EARLY_SETTLER": early_settler(), "IS_CHURN": churned(), "TIME_TO_CHURN_D": time_to_churn()}
    )


def bureau_table(bureau: DataFrame, columns: list[str] = BUREAU_COLUMNS) -> DataFrame:
    """Smallest, largest and median of each bureau column per client."""
    aggregates = [f(c).alias(f"{c}_{n}") for c in columns for n, f in {"MIN": F.min, "MAX": F.max}.items()]
    specs = {f"{c}_MEDIAN": (c, 0.5) for c in columns}
    out = aggregate_with_quantiles(bureau, ["CONTRIB"], aggregates, specs)
    return out.select("CONTRIB", *[f"{c}_{n}" for c in columns for n in ("MIN", "MAX", "MEDIAN")])
