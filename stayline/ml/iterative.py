"""Chained imputation: each incomplete column is regressed on all the others in turn."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.ml.moments import summed_arrays
from stayline.ml.params import Configured
from stayline.session import written


def replay(x: np.ndarray, initial: np.ndarray, steps: list) -> np.ndarray:
    """Fill the gaps of a block of rows by the recorded sequence of regressions."""
    gaps = np.isnan(x)
    out = np.where(gaps, initial, x)
    for j, intercept, weights in steps:
        rows = gaps[:, j]
        if rows.any():
            others = np.delete(out[rows], j, axis=1)
            out[rows, j] = intercept + others @ np.asarray(weights)
    return out


def evidence_ridge(gram: np.ndarray, cross: np.ndarray, target_ss: float, n: float) -> np.ndarray:
    """Ridge weights whose two precisions maximise the evidence, from centred moments."""
    values, vectors = np.linalg.eigh(gram)
    values = np.clip(values, 0, None)
    # directions in which the columns only repeat each other carry no weight; what sums leave there is rounding
    rotated = np.where(values > 1e-9 * max(values.max(initial=0.0), 1e-300), vectors.T @ cross, 0.0)
    tiny = 1e-6
    noise, prior = n / max(target_ss, 1e-12), 1.0
    weights = np.zeros(len(cross))
    for _ in range(300):
        fresh = vectors @ (rotated / (values + prior / noise))
        rss = max(target_ss - 2 * fresh @ cross + fresh @ gram @ fresh, 0.0)
        effective = float((noise * values / (prior + noise * values)).sum())
        prior = (effective + 2 * tiny) / (float(fresh @ fresh) + 2 * tiny)
        noise = (n - effective + 2 * tiny) / (rss + 2 * tiny)
        moved = float(np.abs(fresh - weights).sum())
        weights = fresh
        if moved < 1e-3:
            break
    return weights


#: Rows of a block of the state.
BLOCK_ROWS = 1 << 14
#: Numbers that products per pattern of gaps may take in all; more patterns go by scans.
PATTERN_NUMBERS = 1 << 23

_STATE = "n long, gap binary, f binary, d double"


def _block(gaps: np.ndarray, now: np.ndarray, moved: float) -> pd.DataFrame:
    return pd.DataFrame({"n": [len(now)], "gap": [gaps.tobytes()], "f": [now.tobytes()], "d": [moved]})


def _packed(start: np.ndarray):
    """Rows of doubles as blocks of gaps and current values, gaps filled with ``start``."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), BLOCK_ROWS):
                x = batch.iloc[lo : lo + BLOCK_ROWS].to_numpy(float)
                gaps = np.isnan(x)
                yield _block(gaps, np.where(gaps, start, x), 0.0)

    return pack


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(gaps, current values) of the blocks of a state table."""
    for batch in batches:
        for n, gap, now in zip(batch["n"], batch["gap"], batch["f"]):
            yield np.frombuffer(gap, bool).reshape(n, -1), np.frombuffer(now).reshape(n, -1)


def _apply(gaps: np.ndarray, now: np.ndarray, steps: list) -> np.ndarray:
    """Current values after some regressions in turn."""
    out = now.copy()
    for j, intercept, weights in steps:
        rows = gaps[:, j]
        if rows.any():
            out[rows, j] = intercept + np.delete(out[rows], j, axis=1) @ np.asarray(weights)
    return out


class CoMoments:
    """Sums and products of the current values, apart for each column over the rows where it was given."""

    def regression(self, j: int) -> tuple[float, np.ndarray]:
        """Intercept and weights of column ``j`` on all others, over the rows where it was given."""
        i = self.order.index(j)
        rest = np.delete(np.arange(len(self.centre)), j)
        g, s, n = self.g[i], self.s[i], self.n[i]
        mean, own = s[rest] / n, s[j]
        weights = evidence_ridge(
            g[np.ix_(rest, rest)] - n * np.outer(mean, mean), g[rest, j] - mean * own, g[j, j] - own * own / n, n
        )
        return float(self.centre[j] + own / n - (self.centre[rest] + mean) @ weights), weights


class PatternMoments(CoMoments):
    """Products from those of each pattern of gaps, by one scan in all.

    Rows with the same gaps are filled by the same regressions, so a fill is linear in them and
    the products of the filled rows follow from the products before.
    """

    def __init__(self, state: DataFrame, order: list[int], centre: np.ndarray):
        self.order, self.centre = order, centre
        width = len(centre) + 1

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: dict[bytes, np.ndarray] = {}
            for gaps, now in _blocks(batches):
                # 1 before the values: sums and the number of rows are products too
                x = np.column_stack([np.ones(len(now)), now - centre])
                names = np.ascontiguousarray(np.packbits(gaps, axis=1))
                names = names.view(f"V{names.shape[1]}").ravel()
                by = np.argsort(names, kind="stable")
                sorted_ = names[by]
                starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
                for lo, hi in zip(starts, [*starts[1:], len(by)]):
                    name, own = bytes(sorted_[lo]), x[by[lo:hi]]
                    product = own.T @ own
                    held[name] = held[name] + product if name in held else product
            if held:
                yield pd.DataFrame({"pattern": list(held), "sums": [m.tobytes() for m in held.values()]})

        def merge(own: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(m).reshape(width, width) for m in sorted(own["sums"]))
            return pd.DataFrame({"pattern": own["pattern"].iloc[:1], "sums": [total.tobytes()]})

        parts = state.mapInPandas(partial, "pattern binary, sums binary")
        found = parts.groupBy("pattern").applyInPandas(merge, "pattern binary, sums binary").collect()
        found = sorted((bytes(r.pattern), bytes(r.sums)) for r in found)
        self.gaps = np.array([np.unpackbits(np.frombuffer(p, np.uint8), count=width - 1) for p, _ in found], bool)
        self.m = np.array([np.frombuffer(m).reshape(width, width) for _, m in found])
        whole = [self.m[~self.gaps[:, j]].sum(axis=0) for j in order]
        self.g, self.s, self.n = [w[1:, 1:] for w in whole], [w[0, 1:] for w in whole], [w[0, 0] for w in whole]

    def update(self, state: DataFrame, done: list, step: tuple) -> None:
        """Take in new fills of one column."""
        j, intercept, weights = step
        rest = np.delete(np.arange(len(self.centre)), j)
        # the fill in centred values, as a row over (1, values); the column itself has no part in it
        fill = np.zeros(len(self.centre) + 1)
        fill[1 + rest] = weights
        fill[0] = intercept + self.centre[rest] @ np.asarray(weights) - self.centre[j]
        having = np.flatnonzero(self.gaps[:, j])
        moved = np.zeros((len(having), len(fill)))
        for at, own in enumerate(having):
            m = self.m[own]
            line = fill @ m
            line[j + 1] = line @ fill
            moved[at] = line - m[j + 1]
            m[j + 1], m[:, j + 1] = line, line
        # a column's products take the patterns in which it was given
        total = (~self.gaps[np.ix_(having, self.order)]).T.astype(float) @ moved
        for i, own in enumerate(total):
            self.s[i][j] += own[0]
            self.g[i][j] += own[1:]
            self.g[i][rest, j] += own[1 + rest]


def pattern_count(state: DataFrame, most: int) -> int:
    """Different patterns of gaps; no more than one over ``most`` are counted."""

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        told: set[bytes] = set()
        for gaps, _ in _blocks(batches):
            if len(told) <= most:
                told |= {bytes(r) for r in np.unique(np.packbits(gaps, axis=1), axis=0)}
        yield pd.DataFrame({"pattern": sorted(told)[: most + 1]})

    return state.mapInPandas(own, "pattern binary").distinct().limit(most + 1).count()


def moments_of(state: DataFrame, order: list[int], centre: np.ndarray) -> CoMoments:
    most = PATTERN_NUMBERS // (len(centre) + 1) ** 2
    kind = PatternMoments if pattern_count(state, most) <= most else ScannedMoments
    return kind(state, order, centre)


class ScannedMoments(CoMoments):
    """Products for any number of patterns.

    One scan sets them up. When a column gets new fills, only its row and column
    of each product change, by what the rows with that gap contribute: a scan a column.
    """

    def __init__(self, state: DataFrame, order: list[int], centre: np.ndarray):
        self.order, self.centre = order, centre
        p, q = len(centre), len(order)

        def partial(batches):
            total = {"g": np.zeros((q, p, p)), "s": np.zeros((q, p)), "n": np.zeros(q)}
            for gaps, now in _blocks(batches):
                x = now - centre
                for i, j in enumerate(order):
                    own = x[~gaps[:, j]]
                    total["g"][i] += own.T @ own
                    total["s"][i] += own.sum(axis=0)
                    total["n"][i] += len(own)
            return total

        found = summed_arrays(state, partial)
        self.g, self.s, self.n = found["g"], found["s"], found["n"]

    def update(self, state: DataFrame, done: list, step: tuple) -> None:
        """Take in new fills of one column; ``done`` are the regressions of this round before it."""
        j, order, centre = step[0], self.order, self.centre
        p, q = len(centre), len(order)

        def partial(batches):
            total = {"d": np.zeros((q, p)), "e": np.zeros(q), "s": np.zeros(q)}
            for gaps, now in _blocks(batches):
                # only rows with this gap get new values
                own = gaps[:, j]
                gaps, now = gaps[own], now[own]
                if not len(now):
                    continue
                before = _apply(gaps, now, done)
                x = before - centre
                fresh = _apply(gaps, before, [step])[:, j] - centre[j]
                for i, other in enumerate(order):
                    rows = ~gaps[:, other]
                    moved = fresh[rows] - x[rows, j]
                    total["d"][i] += moved @ x[rows]
                    total["e"][i] += (fresh[rows] ** 2 - x[rows, j] ** 2).sum()
                    total["s"][i] += moved.sum()
            return total

        found = summed_arrays(state, partial)
        if not found:
            return
        rest = np.delete(np.arange(p), j)
        for i in range(q):
            self.g[i][j, rest] += found["d"][i][rest]
            self.g[i][rest, j] += found["d"][i][rest]
            self.g[i][j, j] += found["e"][i]
            self.s[i][j] += found["s"][i]


class IterativeImputer(Configured, Estimator):
    """Rounds of per-column regressions on the given rows of each column.

    The current values are a written table, one per round. Products of the columns
    follow from those of each pattern of gaps, set up by one scan; where patterns are
    too many to hold, they are kept up to date by a scan per column instead. So each
    round costs the same, and its write tells whether values still move.
    """

    OPTIONS = {"columns": [], "maxIter": 10, "tolerance": 1e-3, "initial": "mean"}

    def _fit(self, dataset: DataFrame) -> IterativeImputerModel:
        columns = list(self.value("columns"))
        rows = written(dataset.select(*[F.col(c).cast("double").alias(c) for c in columns]), "imputed")
        return self._learn(rows, columns)

    def _learn(self, rows: DataFrame, columns: list[str]) -> IterativeImputerModel:
        stats = rows.agg(
            F.count("*").alias("n"),
            *[F.count(c).alias(f"n__{c}") for c in columns],
            *[F.avg(c).alias(f"m__{c}") for c in columns],
            *[F.max(F.abs(c)).alias(f"x__{c}") for c in columns],
        ).first()
        n = stats["n"]
        if self.value("initial") == "median":
            from stayline.operators.quantiles import column_quantiles

            found = column_quantiles(rows, {c: (c, 0.5) for c in columns})
            initial = [found[c] or 0.0 for c in columns]
        else:
            initial = [stats[f"m__{c}"] or 0.0 for c in columns]
        gaps = {c: n - stats[f"n__{c}"] for c in columns}
        order = [columns.index(c) for c in sorted(columns, key=lambda c: gaps[c]) if 0 < gaps[c] < n]
        limit = self.value("tolerance") * max((stats[f"x__{c}"] or 0.0 for c in columns), default=0.0)
        steps: list = []
        start = np.array(initial, dtype=float)
        if order:
            parts = min(rows.sparkSession.sparkContext.defaultParallelism, n // BLOCK_ROWS + 1)
            state = written(rows.mapInPandas(_packed(start), _STATE).repartition(parts), "imputed")
            moments = moments_of(state, order, start)
            for round_ in range(self.value("maxIter")):
                done: list = []
                for j in order:
                    intercept, weights = moments.regression(j)
                    step = (j, intercept, [float(w) for w in weights])
                    moments.update(state, done, step)
                    done.append(step)
                steps += done
                state = written(state.mapInPandas(_moved(done), _STATE), "imputed")
                if round_ and (state.agg(F.max("d")).first()[0] or 0.0) < limit:
                    break
        return IterativeImputerModel(columns=columns, initial=[float(v) for v in start], steps=[list(s) for s in steps])


def _moved(steps: list):
    """The state after a round, with the largest change of each block."""

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for gaps, now in _blocks(batches):
            fresh = _apply(gaps, now, steps)
            yield _block(gaps, fresh, float(np.abs(fresh - now).max(initial=0.0)))

    return move


class IterativeImputerModel(Configured, Model):
    OPTIONS = {"columns": [], "initial": [], "steps": []}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, initial, steps = self.value("columns"), np.array(self.value("initial")), self.value("steps")
        doubles = dataset.withColumns({c: F.col(c).cast("double") for c in columns})
        schema = T.StructType(doubles.schema.fields)

        def fill(batches):
            for batch in batches:
                batch[columns] = replay(batch[columns].to_numpy(float), initial, steps)
                yield batch

        return doubles.mapInPandas(fill, schema)
