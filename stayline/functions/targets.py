"""Client targets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayline.functions.columns import clip, days_between, flag, row_max

END_STATUSES = ("SOL", "SAN", "RBT")
ACTIVE_STATUS = "ENC"
RENEWAL_GAP_DAYS = 30


def last_end() -> Column:
    return row_max([f"LAST_OBS_DATE_{s}" for s in END_STATUSES])


def ever_ended() -> Column:
    return F.coalesce(row_max([f"EVER_{s}" for s in END_STATUSES]) == 1, F.lit(False))


def early_settler() -> Column:
    return flag((F.col("EVER_SAN") == 1) | (F.col("EVER_RBT") == 1))


def churned(gap_days: int = RENEWAL_GAP_DAYS) -> Column:
    """Ended, not active, and no new contract, or only one after more than ``gap_days``.

    A last contract created on or before the last end also counts as no renewal.
    """
    no_renewal = F.col("LAST_DCREAT") <= last_end()
    late_renewal = days_between("LAST_DCREAT", last_end()) > gap_days
    inactive = ~F.coalesce(F.col("HAS_ACTIVE") == 1, F.lit(False))
    return flag(ever_ended() & inactive & (no_renewal | late_renewal))


def time_to_churn() -> Column:
    """Days from the last contract start to the last end, at least 0."""
    return clip(days_between(last_end(), "LAST_DCREAT"), 0)


def churn_early() -> Column:
    return flag((F.col("IS_EARLY_SETTLER") == 1) & (F.col("IS_CHURN") == 1))


def churn_natural() -> Column:
    return flag((F.col("IS_EARLY_SETTLER") == 0) & (F.col("EVER_SOL") == 1) & (F.col("IS_CHURN") == 1))


def has_history() -> Column:
    """At least one ended contract: the population a model can learn from."""
    return F.coalesce(
        (F.col("EVER_SAN") == 1) | (F.col("EVER_SOL") == 1) | (F.col("EVER_RBT") == 1), F.lit(False)
    )


def has_active_contract() -> Column:
    return F.coalesce(F.col("HAS_ACTIVE") == 1, F.lit(False))


def not_churned() -> Column:
    return F.coalesce(F.col("IS_CHURN") == 0, F.lit(False))
