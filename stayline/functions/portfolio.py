"""Recommended action, revenue at risk and display columns of a scored client."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: action names in priority order --------------------------
ACTIONS = (
    "Urgent restructuring",
    "Urgent retention",
    "Debt monitoring",
    "Refinancing offer",
    "Upsell opportunity",
    "Competitive proposal",
    "Consolidation offer",
    "Renewal campaign",
    "Cross-sell",
    "Monitor",
    "Standard follow-up",
)
# segment -> (name, window start %, window end %, intervention)
SEGMENTS = {
    1: ("High Risk / Overdue", 50, 75, "Recovery restructuring"),
    2: ("High Value", 25, 40, "Refinancing offer"),
    3: ("High External Credit", 40, 60, "Competitive proposal"),
    4: ("Base / Dormant", 75, 100, "Renewal campaign"),
}
# ----------------------------------------------------------------------------
DEFAULT_WINDOW = (0, 100)

# Guidance per action: a sentence with {san} and {churn} places, then next steps.
GUIDANCE = {
    "Urgent restructuring": (
        "Churn probability {churn}: renegotiate the debt before a default.",
        ["Call within two days", "Offer a new instalment plan", "Escalate when unanswered"],
    ),
    "Urgent retention": (
        "Early settlement {san}, churn {churn}: make a retention offer first.",
        ["Call within two days", "Prepare a personal offer", "Open a new contract before the exit"],
    ),
    "Debt monitoring": (
        "Churn probability {churn} with signs of stress: check in early.",
        ["Call this week", "Review recent payments", "Look again in 30 days"],
    ),
    "Refinancing offer": (
        "Early settlement {san} but low churn: offer refinancing.",
        ["Contact before mid-contract", "Prepare a fitting loan", "Compare the cost of settling"],
    ),
    "Upsell opportunity": (
        "Stable, early settlement {san}, churn {churn}: propose a product.",
        ["Add to the next outreach", "Check eligibility", "Review next quarter"],
    ),
    "Competitive proposal": (
        "High external exposure and churn {churn}: counter the competition.",
        ["Contact within two weeks", "Compare market rates", "Stress one single credit"],
    ),
    "Consolidation offer": (
        "Credit spread over lenders, early settlement {san}: consolidate.",
        ["List the external credits", "Prepare a consolidation", "Show the lower total instalment"],
    ),
    "Renewal campaign": (
        "Contract near its end, churn {churn}: invite to renew.",
        ["Add to the renewal campaign", "Contact 60-90 days before the end", "Reward an early renewal"],
    ),
    "Cross-sell": (
        "Low risk, early settlement {san}, churn {churn}: add a product.",
        ["Add to the next campaign", "Check product fit", "No urgency"],
    ),
    "Monitor": (
        "Nothing to do now, churn {churn}: watch for changes.",
        ["No contact needed", "Keep on the watch list", "Review next quarter"],
    ),
    "Standard follow-up": (
        "Nothing to do now: keep in the periodic review.",
        ["Periodic review", "No action"],
    ),
}


@dataclass(frozen=True)
class ActionRules:
    """Probability limits of the recommended-action rules."""

    restructure_churn: float = 0.60
    retain_san: float = 0.65
    retain_churn: float = 0.55
    compete_churn: float = 0.55
    consolidate_san: float = 0.55
    renew_churn: float = 0.60
    quiet: float = 0.35
    high: float = 0.60
    moderate: float = 0.40
    interest_rate: float = 0.08


RULES = ActionRules()


def recommended_action(
    segment: Column, p_san: Column, p_churn: Column, rules: ActionRules = RULES
) -> Column:
    """Action by segment; the first true rule of the segment wins."""
    by_segment = {
        1: [(p_churn >= rules.restructure_churn, "Urgent restructuring"), (None, "Debt monitoring")],
        2: [
            ((p_san >= rules.retain_san) & (p_churn >= rules.retain_churn), "Urgent retention"),
            (p_san >= rules.retain_san, "Refinancing offer"),
            (None, "Upsell opportunity"),
        ],
        3: [
            (p_churn >= rules.compete_churn, "Competitive proposal"),
            (p_san >= rules.consolidate_san, "Consolidation offer"),
            (None, "Monitor"),
        ],
        4: [
            (p_churn >= rules.renew_churn, "Renewal campaign"),
            ((p_san < rules.quiet) & (p_churn < rules.quiet), "Cross-sell"),
        ],
    }
    out = F
    for number, cases in by_segment.items():
        for condition, action in cases:
            here = segment == number
            out = out.when(here if condition is None else here & condition, action)
    return out.otherwise("Standard follow-up")


def revenue_at_risk(
    amount: Column, months: Column, p_san: Column, rules: ActionRules = RULES
) -> Column:
    """Interest lost when the client settles early; rounded half to even."""
    return F.bround(amount * F.lit(rules.interest_rate) * (months / 12) * p_san, 2)


def risk_band(p: Column, rules: ActionRules = RULES) -> Column:
    return (
        F.when(p >= rules.high, "High risk").when(p >= rules.moderate, "Moderate").otherwise("Low risk")
    )


def as_percent(p: Column) -> Column:
    return F.concat(F.bround(p * 100, 0).cast("int").cast("string"), F.lit("%"))


def significance_stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")
