"""K-means with many starts and many numbers of clusters in the same passes over the rows.

All models are assigned in one scan: a task sends the count, sum and cost of every
cluster of every model, and the next centres follow. The silhouette of all models is
one more scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows from which starting centres are drawn, by a hash of the key.
START_ROWS = 2_000
#: Rows of a packed block.
BLOCK_ROWS = 1 << 14
#: Rows whose distances are worked out at once: they stay in the processor's cache.
STEP_ROWS = 1 << 12


def start_centres(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres drawn one after the other, far points more likely (k-means++)."""
    picked = [sample[rng.integers(len(sample))]]
    nearest = ((sample - picked[0]) ** 2).sum(1)
    for _ in range(1, k):
        total = nearest.sum()
        at = rng.choice(len(sample), p=nearest / total) if total > 0 else rng.integers(len(sample))
        picked.append(sample[at])
        nearest = np.minimum(nearest, ((sample - picked[-1]) ** 2).sum(1))
    return np.array(picked)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)


def packed(rows: DataFrame) -> DataFrame:
    """``x`` of many rows as one row of (n, x): passes read whole matrices, dealt out evenly over the tasks."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), BLOCK_ROWS):
                x = np.stack(batch["x"].iloc[lo : lo + BLOCK_ROWS].to_numpy()).astype(float)
                yield pd.DataFrame({"n": [len(x)], "x": [x.tobytes()]})

    parallel = rows.sparkSession.sparkContext.defaultParallelism
    blocks = -(-rows.count() // BLOCK_ROWS)
    return rows.select("x").mapInPandas(pack, "n long, x binary").repartition(max(1, min(parallel, blocks)))


def opened(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    """The matrices of packed rows."""
    for batch in batches:
        for n, x in zip(batch["n"], batch["x"]):
            yield np.frombuffer(x).reshape(n, -1)


def assigned(columns: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre, the first of equals, and squared distance to it; ``columns`` has a row per dimension."""
    d = np.zeros((len(centres), columns.shape[1]))
    for own, at in zip(columns, centres.T):
        away = np.subtract(own, at[:, None])
        away *= away
        d += away
    least, nearest_ = d[0], np.zeros(columns.shape[1], np.int64)
    for j in range(1, len(centres)):
        np.copyto(nearest_, j, where=d[j] < least)
        least = np.minimum(least, d[j])
    return nearest_, least


def _assign(models: list[np.ndarray]):
    """Per model and cluster: rows, sum, sum of squares and cost of the rows nearest to its centre."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [[np.zeros(len(c)), np.zeros_like(c), np.zeros(len(c)), np.zeros(len(c))] for c in models]
        for whole in opened(batches):
            for lo in range(0, len(whole), STEP_ROWS):
                columns = np.ascontiguousarray(whole[lo : lo + STEP_ROWS].T)
                squares = (columns * columns).sum(0)
                for centres, (n, s, ss, cost) in zip(models, held):
                    k = len(centres)
                    at, d = assigned(columns, centres)
                    n += np.bincount(at, minlength=k)
                    for j, own in enumerate(columns):
                        s[:, j] += np.bincount(at, own, k)
                    ss += np.bincount(at, squares, k)
                    cost += np.bincount(at, d, k)
        told = np.concatenate([np.column_stack([n, ss, cost, s]) for n, s, ss, cost in held])
        yield pd.DataFrame({"sums": [told.tobytes()]})

    return assign


def _sums(blocks: DataFrame, models: list[np.ndarray]) -> list[list[tuple | None]]:
    """(rows, sum, sum of squares, cost) per model and cluster; empty clusters have None.

    A task sends a row of numbers per cluster, whatever its rows, and there are no more
    tasks than cores; added up in the order of the tasks, the sums are the same again.
    """
    shape = (sum(len(c) for c in models), -1)
    told = sum(np.frombuffer(r.sums).reshape(shape) for r in blocks.mapInPandas(_assign(models), "sums binary").collect())
    out: list[list[tuple | None]] = []
    for centres in models:
        own, told = told[: len(centres)], told[len(centres) :]
        out.append([(int(r[0]), r[3:], r[1], r[2]) if r[0] else None for r in own])
    return out


def fit_many(rows: DataFrame, ks: list[int], starts: int, key: str, seed: int = 42, most: int = 100, tolerance: float = 1e-4) -> dict[int, tuple[float, np.ndarray]]:
    """The best of ``starts`` fits for each k: cost and centres. ``rows`` has ``key`` and ``x`` (array<double>)."""
    first = rows.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(START_ROWS)
    sample = np.array([r.x for r in first.select("x").collect()], float)
    if not len(sample):
        raise ValueError("no rows to cluster")
    names = [(k, i) for k in ks for i in range(starts)]
    models = [start_centres(sample, k, np.random.default_rng([seed, k, i])) for k, i in names]
    moving = list(range(len(models)))
    blocks = packed(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(most):
            found = _sums(blocks, [models[i] for i in moving])
            still = []
            for i, clusters in zip(moving, found):
                # an empty cluster keeps its centre
                fresh = np.array([c if told is None else told[1] / told[0] for c, told in zip(models[i], clusters)])
                if ((fresh - models[i]) ** 2).sum(1).max() > tolerance**2:
                    still.append(i)
                models[i] = fresh
            moving = still
            if not moving:
                break
        costs = [sum(told[3] for told in clusters if told) for clusters in _sums(blocks, models)]
    finally:
        blocks.unpersist()
    best = {}
    for (k, _), cost, centres in zip(names, costs, models):
        if k not in best or cost < best[k][0]:
            best[k] = (float(cost), centres[np.lexsort(centres.T[::-1])])
    return best


def silhouettes(rows: DataFrame, models: list[np.ndarray]) -> list[float]:
    """Mean silhouette on squared distances of each model, in one scan.

    The mean squared distance to a cluster follows from its rows, sum and sum of
    squares. Rows alone in their cluster have 0.
    """
    blocks = packed(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _silhouettes(blocks, models, _sums(blocks, models))
    finally:
        blocks.unpersist()


def _silhouettes(blocks: DataFrame, models: list[np.ndarray], clusters: list[list[tuple | None]]) -> list[float]:
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, count = np.zeros(len(models)), 0
        for x in opened(batches):
            count += len(x)
            squares = (x * x).sum(1)
            for i, (centres, told) in enumerate(zip(models, clusters)):
                at = squared_distances(x, centres).argmin(1)
                n = np.array([t[0] if t else 0 for t in told], float)
                mean = np.array([t[1] / t[0] if t else c for t, c in zip(told, centres)])
                spread = np.array([t[2] / t[0] if t else np.inf for t in told])
                d = np.maximum(squares[:, None] - 2 * x @ mean.T + spread[None, :], 0.0)
                row = np.arange(len(x))
                own = d[row, at] * n[at] / np.maximum(n[at] - 1, 1)
                d[row, at] = np.inf
                other = d.min(1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    s = np.where(np.maximum(own, other) > 0, (other - own) / np.maximum(own, other), 0.0)
                totals[i] += np.where((n[at] > 1) & np.isfinite(other), s, 0.0).sum()
        yield pd.DataFrame({"model": np.arange(len(models)), "total": totals, "n": count})

    found = blocks.mapInPandas(score, "model int, total double, n long").groupBy("model").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    by_model = {r.model: r.total / r.n if r.n else 0.0 for r in found.collect()}
    return [by_model.get(i, 0.0) for i in range(len(models))]


def nearest(columns: list[str], centres: np.ndarray) -> Column:
    """Number of the nearest centre, the first of equals; null where a column is."""
    away = [
        sum(((F.col(c).cast("double") - F.lit(float(v))) * (F.col(c).cast("double") - F.lit(float(v))) for c, v in zip(columns, centre)), F.lit(0.0))
        for centre in centres
    ]
    known = F.array(*away)
    return F.when(away[0].isNotNull(), (F.array_position(known, F.array_min(known)) - 1).cast("int"))
