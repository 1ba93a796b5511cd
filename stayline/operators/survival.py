"""Survival curves, log-rank test, proportional-hazards model and concordance.

Rows are reduced to one entry per whole day first; running sums are taken over
those entries, whose number is bounded by the days observed, not by the clients.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.ml.moments import summed_arrays
from stayline.session import written

NORMAL_95 = 1.959963984540054  # fixed value: 97.5 % point of the normal distribution
TIMEPOINTS = (90, 180, 365, 730, 1460, 2920)


def _by_day(df: DataFrame, duration: str, event: str, group: list[str]) -> DataFrame:
    return (
        df.select(*group, F.col(duration).cast("int").alias("t"), F.col(event).cast("int").alias("e"))
        .na.drop(subset=["t", "e", *group])
        .groupBy(*group, "t")
        .agg(F.sum("e").alias("events"), F.count("*").alias("leaving"))
    )


def kaplan_meier(df: DataFrame, duration: str, event: str, group: list[str] | None = None) -> DataFrame:
    """Survival with a 95 % band (log-log Greenwood) at each day, per group."""
    group = list(group or [])
    days = _by_day(df, duration, event, group)
    by = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    later = by.orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    upto = by.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    table = days.withColumn("at_risk", F.sum("leaving").over(later))
    alive = F.col("at_risk") - F.col("events")
    log_step = F.when(alive > 0, F.log(alive / F.col("at_risk")))
    variance_step = F.when(alive > 0, F.col("events") / (F.col("at_risk") * alive))
    table = table.withColumns(
        {
            "_log": F.sum(F.coalesce(log_step, F.lit(0.0))).over(upto),
            "_var": F.sum(F.coalesce(variance_step, F.lit(0.0))).over(upto),
            "_none": F.max((alive == 0).cast("int")).over(upto),
        }
    ).withColumn("survival", F.when(F.col("_none") == 1, 0.0).otherwise(F.exp("_log")))
    inside = (F.col("_log") < 0) & (F.col("_none") == 0)
    spread = F.lit(NORMAL_95) * F.sqrt("_var") / F.col("_log")
    bound = lambda sign: F.when(
        inside, F.exp(-F.exp(F.log(-F.col("_log")) + F.lit(sign) * spread))
    ).when(F.col("_none") == 1, 0.0).otherwise(1.0)
    return table.select(
        *group, "t", "events", "leaving", "at_risk", "survival",
        bound(-1.0).alias("lower"), bound(1.0).alias("upper"),
    )


def median_survival(curve: DataFrame, group: list[str] | None = None) -> DataFrame:
    """First day at or under one half; null when never reached."""
    measure = F.min(F.when(F.col("survival") <= 0.5, F.col("t"))).alias("median_days")
    size = F.max("at_risk").alias("clients")
    return curve.groupBy(*group).agg(size, measure) if group else curve.agg(size, measure)


def survival_at(curve: DataFrame, times=TIMEPOINTS) -> DataFrame:
    """Survival at the given days: the last step at or before, 1 before the first."""
    row = curve.agg(
        *[F.max_by("survival", F.when(F.col("t") <= t, F.col("t"))).alias(f"s{i}") for i, t in enumerate(times)]
    )
    entries = [
        F.struct(F.lit(t).alias("t"), F.coalesce(F.col(f"s{i}"), F.lit(1.0)).alias("survival"))
        for i, t in enumerate(times)
    ]
    return row.select(F.explode(F.array(*entries)).alias("x")).select("x.*")


def logrank_statistic(df: DataFrame, duration: str, event: str, group: Column) -> DataFrame:
    """Observed and expected events of the rows where ``group`` holds, variance and chi-square."""
    days = (
        df.select(group.cast("int").alias("g"), F.col(duration).cast("int").alias("t"), F.col(event).cast("int").alias("e"))
        .na.drop()
        .groupBy("t")
        .agg(
            F.sum("e").alias("d"),
            F.count("*").alias("n"),
            F.sum(F.col("e") * F.col("g")).alias("d1"),
            F.sum("g").alias("n1"),
        )
    )
    later = Window.partitionBy(F.lit(1)).orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    risk = days.select("d", "d1", F.sum("n").over(later).alias("n"), F.sum("n1").over(later).alias("n1"))
    share = F.col("n1") / F.col("n")
    spread = F.when(
        F.col("n") > 1,
        F.col("d") * share * (1 - share) * (F.col("n") - F.col("d")) / (F.col("n") - 1),
    ).otherwise(0.0)
    return (
        risk.filter(F.col("d") > 0)
        .agg(
            F.sum("d1").alias("observed"),
            F.sum(F.col("d") * share).alias("expected"),
            F.sum(spread).alias("variance"),
        )
        .withColumn(
            "chi2", F.try_divide(F.pow(F.col("observed") - F.col("expected"), F.lit(2)), F.col("variance"))
        )
    )


def logrank_test(df: DataFrame, duration: str, event: str, group: Column) -> tuple[float, float]:
    """Chi-square with one degree of freedom and its p-value."""
    chi2 = logrank_statistic(df, duration, event, group).first()["chi2"] or 0.0
    return chi2, math.erfc(math.sqrt(chi2 / 2))


# ---------------------------------------------------------------- proportional hazards


@dataclass
class CoxModel:
    """Coefficients on the original feature scale with their standard errors."""

    features: list[str]
    coefficients: np.ndarray
    errors: np.ndarray
    log_likelihood: float
    iterations: int
    means: np.ndarray
    scales: np.ndarray

    def summary(self, spark) -> DataFrame:
        """Hazard ratio, 95 % interval and p-value per feature."""
        rows = []
        for name, b, se in zip(self.features, self.coefficients.tolist(), self.errors.tolist()):
            p = math.erfc(abs(b / se) / math.sqrt(2)) if se > 0 else 1.0
            band = NORMAL_95 * se
            rows.append((name, b, se, math.exp(b), math.exp(b - band), math.exp(b + band), p))
        return spark.createDataFrame(
            rows,
            "feature string, coef double, se double, hazard_ratio double, hr_low double, hr_high double, p double",
        )

    def risk(self) -> Column:
        """Log partial hazard as a column expression."""
        out = F.lit(0.0)
        for name, b, m in zip(self.features, self.coefficients.tolist(), self.means.tolist()):
            out = out + F.lit(b) * (F.col(name) - F.lit(m))
        return out


def weighted_gram(df: DataFrame, features: list[str], weight: str) -> np.ndarray:
    """Sum of weight * x x' over the rows, p x p on the driver."""

    def partial(batches: Iterator[pd.DataFrame]) -> dict[str, np.ndarray]:
        gram = np.zeros((len(features), len(features)))
        for batch in batches:
            x = batch[features].to_numpy(float)
            gram += (x * batch[weight].to_numpy(float)[:, None]).T @ x
        return {"gram": gram}

    found = summed_arrays(df.select(*features, weight), partial)
    return found.get("gram", np.zeros((len(features), len(features))))


#: Events of a day up to which their terms are added one by one.
FEW_TIES = 32


def tie_sums(s0: np.ndarray, q0: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per day, over l = 0 .. d - 1 with u = l / d and y = s0 - u q0: sums of 1/y, u/y, 1/y2, u/y2, u2/y2 and log y.

    ``s0`` is the weight at risk, ``q0`` that of the ``d`` rows with an event. Days
    with few events are added up; others by the integral with corrections at both
    ends, whose error falls with the sixth power of the events, or, where the
    events are most of the weight at risk, exactly up to the last few terms.
    """
    out = np.zeros((6, len(d)))
    few = d <= FEW_TIES
    if few.any():
        ties = np.arange(FEW_TIES)[None, :]
        u = ties / d[few, None]
        inside = ties < d[few, None]
        y = np.where(inside, s0[few, None] - u * q0[few, None], 1.0)
        terms = (1 / y, u / y, 1 / y**2, u / y**2, u**2 / y**2, np.log(y))
        out[:, few] = [(t * inside).sum(axis=1) for t in terms]
    for i in np.flatnonzero(~few):
        out[:, i] = _many_ties(float(s0[i]), float(q0[i]), int(d[i]))
    return tuple(out)


def _many_ties(s0: float, q0: float, d: int) -> np.ndarray:
    # the last terms one by one: next to them y may come close to zero
    last = np.arange(max(0, d - FEW_TIES), d) / d
    y = s0 - last * q0
    ends = np.array([(1 / y).sum(), (last / y).sum(), (1 / y**2).sum(), (last / y**2).sum(), (last**2 / y**2).sum(), np.log(y).sum()])
    n = d - len(last)
    h, top = q0 / d, s0 - n * q0 / d
    # sums over l < n of powers of 1 / (s0 - h l), by Euler and Maclaurin
    log = math.log(s0 / top)
    inv = log / h + (1 / s0 - 1 / top) / 2 + h * (1 / top**2 - 1 / s0**2) / 12 - 6 * h**3 * (1 / top**4 - 1 / s0**4) / 720
    inv2 = (1 / top - 1 / s0) / h + (1 / s0**2 - 1 / top**2) / 2 + 2 * h * (1 / top**3 - 1 / s0**3) / 12 - 24 * h**3 * (1 / top**5 - 1 / s0**5) / 720
    logs = (s0 * (math.log(s0) - 1) - top * (math.log(top) - 1)) / h + (math.log(s0) - math.log(top)) / 2 - h * (1 / top - 1 / s0) / 12 + 2 * h**3 * (1 / top**3 - 1 / s0**3) / 720
    # u = (s0 - y) / q0
    u_inv = (s0 * inv - n) / q0
    u_inv2 = (s0 * inv2 - inv) / q0
    uu_inv2 = (s0 * s0 * inv2 - 2 * s0 * inv + n) / q0**2
    return ends + np.array([inv, u_inv, inv2, u_inv2, uu_inv2, logs])


def fit_cox(
    df: DataFrame,
    duration: str,
    event: str,
    features: list[str],
    penalty: float = 0.1,
    ties: str = "efron",
    max_iterations: int = 50,
    tolerance: float = 1e-7,
) -> CoxModel:
    """Newton iterations on Spark aggregates.

    Features are standardised and the squared coefficients are penalised with
    ``penalty * rows / 2``. Each iteration reads the cached rows twice: once for
    sums per day (weight and weighted features), once for one weighted cross
    product; everything else happens on days x features arrays.
    """
    if ties not in ("efron", "breslow"):
        raise ValueError(f"unknown tie method {ties!r}")
    rows = df.select(
        F.col(duration).cast("int").alias("t"),
        F.col(event).cast("int").alias("e"),
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
    ).na.drop()
    xs = [f"x{i}" for i in range(len(features))]
    stats = rows.agg(
        F.count("*").alias("n"),
        *[F.avg(x).alias(f"m{x}") for x in xs],
        *[F.stddev_samp(x).alias(f"s{x}") for x in xs],
    ).first()
    means = np.array([stats[f"m{x}"] for x in xs])
    scales = np.array([stats[f"s{x}"] or 1.0 for x in xs])
    scaled = rows.select(
        "t", "e", *[((F.col(x) - F.lit(float(m))) / F.lit(float(s))).alias(x) for x, m, s in zip(xs, means, scales)]
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        beta, hessian, value, used = _newton(
            scaled, xs, stats["n"], penalty, ties, max_iterations, tolerance
        )
    finally:
        scaled.unpersist()
    errors = np.sqrt(np.clip(np.diag(np.linalg.pinv(hessian)), 0, None)) / scales
    return CoxModel(list(features), beta / scales, errors, value, used, means, scales)


def _newton(scaled, xs, n, penalty, ties, max_iterations, tolerance):
    p = len(xs)
    beta = np.zeros(p)
    best = -np.inf
    step = 1.0
    accepted = None
    used = 0
    for used in range(1, max_iterations + 1):
        trial = beta if accepted is None else beta + step * accepted[2]
        days, value, gradient, per_day = _day_terms(scaled, xs, trial, ties)
        value -= 0.5 * n * penalty * float(trial @ trial)
        if accepted is not None and value < best - 1e-9 * abs(best):
            step /= 2
            if step < 1e-4:
                break
            continue
        beta, improvement, best, step = trial, value - best, value, min(1.0, step * 2)
        hessian = _hessian(scaled, xs, beta, days, per_day) + n * penalty * np.eye(p)
        gradient = gradient - n * penalty * beta
        direction = np.linalg.solve(hessian, gradient)
        accepted = (gradient, hessian, direction)
        if np.abs(direction).max() < tolerance or abs(improvement) < tolerance * 1e-3:
            break
    return beta, accepted[1], best, used


def _score(xs, beta) -> Column:
    out = F.lit(0.0)
    for x, b in zip(xs, beta.tolist()):
        out = out + F.lit(b) * F.col(x)
    return out


def _day_sums(scaled: DataFrame, xs: list[str], beta: np.ndarray) -> dict[int, np.ndarray]:
    """Per day: events, weight, weight of events, log weight of events; then weighted features of all, of events, features of events."""
    p = len(xs)

    def partial(batches: Iterator[pd.DataFrame]) -> dict[str, np.ndarray]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            x, died = batch[xs].to_numpy(float), batch["e"].to_numpy() == 1
            linear = x @ beta
            w = np.exp(linear)
            days, place = np.unique(batch["t"].to_numpy(), return_inverse=True)
            ended = np.where(died, w, 0.0)
            row = np.column_stack([died, w, ended, np.where(died, linear, 0.0), x * w[:, None], x * ended[:, None], x * died[:, None]])
            order = np.argsort(place, kind="stable")
            sums = np.add.reduceat(row[order], np.searchsorted(place[order], np.arange(len(days))), axis=0)
            for day, values in zip(days.tolist(), sums):
                name = str(day)
                total[name] = total[name] + values if name in total else values
        return total

    return {int(day): values for day, values in summed_arrays(scaled.select("t", "e", *xs), partial).items()}


def _day_terms(scaled, xs, beta, ties):
    """Log-likelihood, gradient and the per-day weights of the second derivative."""
    p = len(xs)
    found = _day_sums(scaled, xs, beta)
    days = np.array(sorted(found, reverse=True))
    table = np.array([found[t] for t in days])
    d = table[:, 0].astype(int)
    s0, q0 = np.cumsum(table[:, 1]), table[:, 2]
    s1, q1 = np.cumsum(table[:, 4 : 4 + p], axis=0), table[:, 4 + p : 4 + 2 * p]
    event = d > 0
    hazard = np.zeros(len(days))  # added to every row at risk on the day
    relief = np.zeros(len(days))  # taken from the rows that end with an event that day
    if ties == "efron":
        a, b, c0, c1, c2, logs = tie_sums(s0[event], q0[event], d[event])
    else:
        n, y = d[event], s0[event]
        a, b, c0, c1, c2, logs = n / y, 0 * y, n / y**2, 0 * y, 0 * y, n * np.log(y)
    hazard[event], relief[event] = a, b
    s, q = s1[event], q1[event]
    value = float(table[:, 3].sum() - logs.sum())
    gradient = table[:, 4 + 2 * p :].sum(axis=0) - (a @ s - b @ q)
    cross = (s * c1[:, None]).T @ q
    outer = (s * c0[:, None]).T @ s - cross - cross.T + (q * c2[:, None]).T @ q
    upto = np.cumsum(hazard[::-1])[::-1]  # hazard of all event days at or before each day
    return days, value, gradient, (upto, relief, outer)


def score_equations(df: DataFrame, duration: str, event: str, model: CoxModel, penalty: float = 0.1, ties: str = "efron") -> np.ndarray:
    """Derivative of the penalised likelihood at a fitted model, per row and standardised feature: zero at its maximum."""
    xs = [f"x{i}" for i in range(len(model.features))]
    rows = df.select(
        F.col(duration).cast("int").alias("t"), F.col(event).cast("int").alias("e"),
        *[((F.col(f).cast("double") - F.lit(float(m))) / F.lit(float(s))).alias(x) for f, x, m, s in zip(model.features, xs, model.means, model.scales)],
    ).na.drop()
    beta = model.coefficients * model.scales
    _, _, gradient, _ = _day_terms(rows, xs, beta, ties)
    n = rows.count()
    return (gradient - n * penalty * beta) / max(n, 1)


def _hessian(scaled, xs, beta, days, per_day) -> np.ndarray:
    upto, relief, outer = per_day
    table = scaled.sparkSession.createDataFrame(
        pd.DataFrame({"t": days.astype("int32"), "a": upto, "b": relief})
    )
    weighted = scaled.join(F.broadcast(table), "t").withColumn(
        "c", F.exp(_score(xs, beta)) * (F.col("a") - F.when(F.col("e") == 1, F.col("b")).otherwise(0.0))
    )
    return weighted_gram(weighted, xs, "c") - outer


def rank_drivers(summary: DataFrame, n: int = 20, rising: bool = True) -> DataFrame:
    order = F.desc("hazard_ratio") if rising else F.asc("hazard_ratio")
    return summary.orderBy(order, "feature").limit(n)


def strongest_drivers(summary: DataFrame, n: int = 40) -> DataFrame:
    """Features with the largest absolute log hazard ratio."""
    return (
        summary.withColumn("abs_impact", F.abs(F.log("hazard_ratio")))
        .orderBy(F.desc("abs_impact"), "feature")
        .limit(n)
    )


# ---------------------------------------------------------------- concordance


def _pairs(a: Column, b: Column) -> Column:
    """Product of two counts; pairs of ten billion rows do not fit a long."""
    return (a.cast("decimal(18,0)") * b.cast("decimal(19,0)")).cast("decimal(38,0)")


def pairs_within(t: np.ndarray, r: np.ndarray, e: np.ndarray, m: np.ndarray) -> tuple[int, int]:
    """(concordant, discordant) pairs among entries of a day and a score with ``e`` events in ``m`` rows.

    Entries are merged by score, bit by bit of its rank: two scores part at one
    bit, where the halves of a group are compared in the order of their days.
    """
    rank = np.unique(r, return_inverse=True)[1]
    by_day = np.argsort(-t.astype(np.int64), kind="stable")
    t, e, m, rank = (x[by_day].astype(np.int64) for x in (t, e, m, rank))
    totals = [0, 0]
    for bit in range(int(rank.max()).bit_length() if len(rank) else 0):
        order = np.argsort(rank >> (bit + 1), kind="stable")
        group, high = rank[order] >> (bit + 1), (rank[order] >> bit) & 1
        day, events, rows = t[order], e[order], m[order]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_day = new_group | np.concatenate([[True], day[1:] != day[:-1]])
        starts, cell = np.flatnonzero(new_day), np.cumsum(new_day) - 1
        first_cell = np.maximum.accumulate(np.where(new_group[starts], np.arange(len(starts)), 0))
        for side, total in ((0, 0), (1, 1)):
            own = rows * (high == side)
            ended = events * (high == side)
            per_day, ended_day = np.add.reduceat(own, starts), np.add.reduceat(ended, starts)
            upto = np.cumsum(per_day)
            # later days of the group, and the rows of the day that have no event
            after = upto - per_day - (upto - per_day)[first_cell] + per_day - ended_day
            totals[total] += int((events * (high != side) * after[cell]).sum())
    return totals[0], totals[1]


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and events per day of one range of scores; its first row has the pairs within."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    t, r, e, m = (whole.column(c).to_numpy() for c in ("t", "r", "e", "m"))
    days, place = np.unique(t, return_inverse=True)
    sums = [np.zeros(len(days), np.int64) for _ in range(4)]
    np.add.at(sums[0], place, e)
    np.add.at(sums[1], place, m)
    sums[2][0], sums[3][0] = pairs_within(t, r, e, m)
    part = np.full(len(days), TaskContext.get().partitionId(), np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part, days, *sums)], names=[x.split()[0] for x in CELLS.split(", ")])


CELLS = "part int, t int, e long, m long, concordant long, discordant long"
#: Entries of a range: what one task merges in memory.
RANGE_ENTRIES = 200_000


def concordance(df: DataFrame, duration: str, event: str, risk: str) -> DataFrame:
    """Exact concordant, discordant and tied pairs and the concordance index.

    A higher risk should end earlier. No pair is ever formed. Rows are reduced to
    one entry per day and score and dealt out by ranges of the score. Within a
    range pairs are counted by merging; between ranges they follow from counts
    per range and day, with running sums over ranges and over days.
    """
    rows = (
        df.select(F.col(duration).cast("int").alias("t"), F.col(event).cast("int").alias("e"), F.col(risk).cast("double").alias("r"))
        .na.drop()
        .groupBy("t", "r")
        .agg(F.sum("e").alias("e"), F.count("*").alias("m"))
    )
    rows = written(rows, "entries")
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ENTRIES + 1)
    cells = written(rows.repartitionByRange(ranges, "r").mapInArrow(_ranged, CELLS), "ranges")
    earlier = Window.partitionBy("t").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    later_ranges = Window.partitionBy("t").orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    # days x ranges cells, zero where a range has no rows on a day
    full = (
        cells.select("t").distinct().select("t", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("part"))
        .join(cells, ["part", "t"], "left").na.fill(0, ["e", "m"])
    )
    sides = {"lower": earlier, "higher": later_ranges}
    told = full.select(
        "part", "t", "e",
        *[F.coalesce(F.sum("m").over(w), F.lit(0)).alias(f"{n}_rows") for n, w in sides.items()],
        *[F.coalesce(F.sum(F.col("m") - F.col("e")).over(w), F.lit(0)).alias(f"{n}_left") for n, w in sides.items()],
    )
    after = Window.partitionBy("part").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, -1)
    outlived = told.select(
        "e", *[(F.coalesce(F.sum(f"{n}_rows").over(after), F.lit(0)) + F.col(f"{n}_left")).alias(n) for n in sides]
    )
    none = F.lit(0).cast("decimal(38,0)")
    between = outlived.agg(
        F.coalesce(F.sum(_pairs(F.col("e"), F.col("lower"))), none).alias("concordant"),
        F.coalesce(F.sum(_pairs(F.col("e"), F.col("higher"))), none).alias("discordant"),
    )
    within = cells.select(*[F.col(c).cast("decimal(38,0)").alias(c) for c in ("concordant", "discordant")])
    ordered = between.unionByName(within).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)").alias(c) for c in ("concordant", "discordant")]
    )
    days = cells.groupBy("t").agg(F.sum("e").alias("e"), F.sum("m").alias("m"))
    later = Window.partitionBy(F.lit(1)).orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, -1)
    comparable = days.select(
        _pairs(F.col("e"), F.coalesce(F.sum("m").over(later), F.lit(0)) + F.col("m") - F.col("e")).alias("c")
    ).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("comparable"))
    tied = F.col("comparable") - F.col("concordant") - F.col("discordant")
    sums = ordered.withColumn("comparable", none).unionByName(
        comparable.select(none.alias("concordant"), none.alias("discordant"), "comparable")
    )
    return sums.agg(*[F.max(F.col(c).cast("decimal(38,0)")).alias(c) for c in sums.columns]).select(
        "concordant",
        "discordant",
        tied.alias("tied"),
        "comparable",
        F.try_divide(F.col("concordant").cast("double") + tied.cast("double") / 2, F.col("comparable").cast("double")).alias("c_index"),
    )
