"""Scored portfolio: table, search, profile and summaries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions import portfolio as fx
from stayline.functions.columns import as_col
from stayline.functions.labels import lookup
from stayline.operators.clean import in_set, text_contains
from stayline.sources.schema import present

PAGE_SIZE = 50
# ---- fixed values: column names of the data model ---------------------------
DETAILS = [
    "PRODALP",
    "sdem_age",
    "N_CONTRACTS",
    "TOTAL_MTFINO",
    "TOTAL_MENSALIDADE",
    "MEDIAN_DURDEG",
    "MEDIAN_RESSO",
    "NBENF",
    "ALLBD_N_Dossiers__N",
    "COUNT_TOTAL_MEDIAN",
]
# ---- end of fixed values -----------------------------------------------------
SORTS = {
    "revenue": ("REVENUE_AT_RISK", False),
    "settlement": ("P_SAN", False),
    "churn": ("P_CHURN", False),
    "client": ("CONTRIB", True),
}


def portfolio_table(scored: DataFrame, rules: fx.ActionRules = fx.RULES) -> DataFrame:
    """Scored clients with defaults, action and revenue at risk: one projection."""
    named = scored.withColumnsRenamed(
        {"Prob_SAN": "P_SAN", "Prob_Churn": "P_CHURN", "segment_final": "CLUSTER"}
    )
    filled = named.withColumns(
        {
            "CLUSTER": F.coalesce(F.col("CLUSTER").cast("int"), F.lit(0)),
            "P_SAN": F.coalesce("P_SAN", F.lit(0.0)),
            "P_CHURN": F.coalesce("P_CHURN", F.lit(0.0)),
        }
    )
    return filled.withColumns(
        {
            "ACTION": fx.recommended_action(F.col("CLUSTER"), F.col("P_SAN"), F.col("P_CHURN"), rules),
            "REVENUE_AT_RISK": fx.revenue_at_risk(
                F.col("TOTAL_MTFINO"), F.col("MEDIAN_DURDEG"), F.col("P_SAN"), rules
            ),
        }
    )


@dataclass(frozen=True)
class Search:
    """Filters of a client search. ``None`` means no filter, an empty set matches nothing."""

    text: str = ""
    regex: bool = False
    hide_unassigned: bool = False
    settlement: tuple[float, float] = (0.0, 1.0)
    churn: tuple[float, float] = (0.0, 1.0)
    segments: tuple[int, ...] | None = None
    actions: tuple[str, ...] | None = None
    sort: str = "revenue"
    sorts: dict = field(default_factory=lambda: SORTS)


def search(table: DataFrame, request: Search) -> DataFrame:
    """Matching clients, unsorted."""
    keep = F.col("P_SAN").between(*request.settlement) & F.col("P_CHURN").between(*request.churn)
    if request.hide_unassigned:
        keep = keep & (F.col("CLUSTER") != 0)
    if request.text:
        keep = keep & text_contains("CONTRIB", request.text, request.regex)
    if request.segments is not None:
        keep = keep & in_set("CLUSTER", request.segments)
    if request.actions is not None:
        keep = keep & in_set("ACTION", request.actions)
    return table.filter(keep)


def ordering(request: Search) -> list[Column]:
    column, ascending = request.sorts[request.sort]
    first = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    return [first] if column == "CONTRIB" else [first, F.asc("CONTRIB")]


def page(found: DataFrame, request: Search, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """One page of the sorted result; a page past the end gives the last one."""
    rows = found.count()
    last = max(1, -(-rows // size)) - 1
    number = min(max(number, 0), last)
    return found.orderBy(*ordering(request)).offset(number * size).limit(size)


def page_after(found: DataFrame, request: Search, value, client, size: int = PAGE_SIZE) -> DataFrame:
    """Next page from the last shown row: no row before it is sorted again."""
    column, ascending = request.sorts[request.sort]
    later = F.col(column) > F.lit(value) if ascending else F.col(column) < F.lit(value)
    if column != "CONTRIB":
        later = later | (F.col(column).eqNullSafe(F.lit(value)) & (F.col("CONTRIB") > F.lit(client)))
        later = later | F.col(column).isNull()
    return found.filter(later).orderBy(*ordering(request)).limit(size)


def search_summary(found: DataFrame) -> DataFrame:
    return found.agg(
        F.count("*").alias("clients"),
        F.count(F.when(F.col("ACTION").startswith("Urgent"), 1)).alias("urgent"),
        F.coalesce(F.sum("REVENUE_AT_RISK"), F.lit(0.0)).alias("revenue_at_risk"),
    )


def portfolio_kpis(table: DataFrame, rules: fx.ActionRules = fx.RULES) -> DataFrame:
    high = F.col("P_SAN") >= rules.high
    return table.agg(
        F.count("*").alias("clients"),
        F.count(F.when(high, 1)).alias("settlement_risk"),
        F.count(F.when(F.col("P_CHURN") >= rules.high, 1)).alias("churn_risk"),
        F.coalesce(F.sum(F.when(high, F.col("REVENUE_AT_RISK"))), F.lit(0.0)).alias("revenue_at_risk"),
    )


def action_breakdown(table: DataFrame) -> DataFrame:
    """Clients per action in priority order with their share."""
    priority = lookup(F.col("ACTION"), {a: i + 1 for i, a in enumerate(fx.ACTIONS)})
    counts = table.groupBy("ACTION").agg(F.count("*").alias("clients"))
    everyone = F.sum("clients").over(Window.partitionBy(F.lit(1)))
    return counts.select(
        priority.alias("priority"), "ACTION", "clients", (F.col("clients") * 100.0 / everyone).alias("share_pct")
    ).orderBy("priority")


def top_clients(table: DataFrame, n: int = 10) -> DataFrame:
    """Largest revenue at risk, equal amounts in client order."""
    return (
        table.where(F.col("REVENUE_AT_RISK").isNotNull())
        .orderBy(F.desc("REVENUE_AT_RISK"), "CONTRIB")
        .select("CONTRIB", "P_SAN", "P_CHURN", "ACTION", "REVENUE_AT_RISK")
        .limit(n)
    )


def segment_cards(table: DataFrame) -> DataFrame:
    """Clients, share and mean probabilities of each named segment, empty ones included."""
    row = table.agg(
        F.count("*").alias("n"),
        *[
            f(F.when(F.col("CLUSTER") == s, F.col(c))).alias(f"{k}{s}")
            for s in fx.SEGMENTS
            for k, f, c in (("n", F.count, "CLUSTER"), ("s", F.avg, "P_SAN"), ("c", F.avg, "P_CHURN"))
        ],
    )
    entries = [
        F.struct(
            F.lit(s).alias("CLUSTER"),
            F.lit(fx.SEGMENTS[s][0]).alias("name"),
            F.col(f"n{s}").alias("clients"),
            (F.col(f"n{s}") * 100.0 / F.greatest("n", F.lit(1))).alias("share_pct"),
            F.col(f"s{s}").alias("avg_p_san"),
            F.col(f"c{s}").alias("avg_p_churn"),
        )
        for s in fx.SEGMENTS
    ]
    return row.select(F.explode(F.array(*entries)).alias("x")).select("x.*")


def with_guidance(table: DataFrame) -> DataFrame:
    """Segment name, intervention window and the text and steps of the action."""
    text, steps = F.lit(None), F.lit(None)
    sentences = lookup(F.col("ACTION"), {a: g[0] for a, g in fx.GUIDANCE.items()})
    steps = lookup(F.col("ACTION"), {a: " | ".join(g[1]) for a, g in fx.GUIDANCE.items()})
    text = F.replace(sentences, F.lit("{san}"), fx.as_percent(F.col("P_SAN")))
    text = F.replace(text, F.lit("{churn}"), fx.as_percent(F.col("P_CHURN")))
    by_segment = lambda i, other: F.coalesce(
        lookup(F.col("CLUSTER"), {s: v[i] for s, v in fx.SEGMENTS.items()}), F.lit(other)
    )
    return table.withColumns(
        {
            "SEGMENT_NAME": by_segment(0, "Unknown"),
            "WINDOW_START": by_segment(1, fx.DEFAULT_WINDOW[0]),
            "WINDOW_END": by_segment(2, fx.DEFAULT_WINDOW[1]),
            "INTERVENTION": by_segment(3, "-"),
            "GUIDANCE": text,
            "NEXT_STEPS": F.split(steps, r" \| "),
        }
    )


def client_profile(table: DataFrame, client) -> DataFrame:
    """One client: probabilities, bands, segment, action, revenue and guidance."""
    chosen = table.filter(as_col("CONTRIB") == F.lit(client))
    return with_guidance(chosen).withColumns(
        {"SETTLEMENT_BAND": fx.risk_band(F.col("P_SAN")), "CHURN_BAND": fx.risk_band(F.col("P_CHURN"))}
    )


def client_details(table: DataFrame, client, columns=DETAILS) -> DataFrame:
    """Detail fields of one client as label and value, empty fields left out."""
    chosen = table.filter(as_col("CONTRIB") == F.lit(client))
    entries = [
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in present(table, columns)
    ]
    return (
        chosen.select("CONTRIB", F.explode(F.array(*entries)).alias("x"))
        .select("CONTRIB", "x.*")
        .where(F.col("value").isNotNull())
    )
