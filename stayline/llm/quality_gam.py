"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees on one feature at a time are boosted in turn; their sums are one
lookup table per feature. Then the pairs of features that explain most of what
is left get tables of their own in the same way. A document's score is the
logistic function of the intercept plus one table entry per feature and pair.

Features of all documents are taken in one pass. The model is fitted on a
bounded sample of labelled rows (:data:`FIT_ROWS`), which is the only thing that
reaches the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import stored, text_of, unpacked, with_row
from stayline.llm.labelled import training_labels

#: Labelled rows the model is fitted on at most.
FIT_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 4
RATE = 0.1
#: Added to the sum of hessians of a leaf.
SHRINK = 2.0
SPLITS = 3

FEATURES = [
    "words", "word_length", "distinct", "top_word", "doubled", "upper", "symbols", "calls", "digits", "marks",
    "bare_marks", "dup_lines", "line_words", "spaces", "long_words",
]

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def features(text: str) -> list[float]:
    """One number per entry of :data:`FEATURES`; an empty text has zeros."""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode(), np.uint8)
    seen = np.bincount(raw, minlength=128)
    size = len(raw)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    upper = seen[65:91].sum()
    symbols = sum(int(seen[ord(c)]) for c in "#*$%&|<>")
    doubled = sum(a == b for a, b in zip(words, words[1:]))
    bare = sum(k for w, k in counts.items() if len(w) <= 3 and not any(c.isalnum() for c in w))
    return [
        float(np.log1p(n)), float(lengths.mean()), len(counts) / n, counts.most_common(1)[0][1] / n, doubled / n,
        upper / size, symbols / size, seen[33] / size, seen[48:58].sum() / size,
        (seen[44] + seen[46] + seen[58] + seen[59] + seen[63]) / n, bare / n, 1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(n / max(1, len(lines)))), (seen[32] + seen[9] + seen[10]) / size, float((lengths > 15).mean()),
    ]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [features(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(values, pa.list_(pa.float64()))], names=["row", "x"]
        )


class Additive(NamedTuple):
    """Cut points and lookup tables; ``pairs`` holds (feature, feature, coarse cuts of both, table)."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (cut, values) in enumerate(zip(self.cuts, self.tables)):
            total += values[np.searchsorted(cut, x[:, j], "right")]
        for a, b, cut_a, cut_b, values in self.pairs:
            total += values[np.searchsorted(cut_a, x[:, a], "right"), np.searchsorted(cut_b, x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Cut points between distinct values, about evenly many rows in each bin, extremes apart."""
    at = np.concatenate([np.linspace(0, 1, bins + 1)[1:-1], [0.01, 0.99]])
    return np.unique(np.quantile(values, at, method="higher")) if len(values) else np.empty(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def _tree(g: np.ndarray, h: np.ndarray, splits: int) -> np.ndarray:
    """Leaf value of every bin for the best tree with few splits on one binned feature."""
    edges = [0, len(g)]
    for _ in range(splits):
        best = (1e-9, 0)
        for lo, hi in zip(edges, edges[1:]):
            if hi - lo > 1:
                left_g, left_h = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
                all_g, all_h = g[lo:hi].sum(), h[lo:hi].sum()
                gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
                k = int(gains.argmax())
                best = max(best, (float(gains[k]), lo + k + 1))
        if not best[1]:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(len(g))
    for lo, hi in zip(edges, edges[1:]):
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + SHRINK)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best pair of cuts of a two-way table."""
    cg, ch = (np.pad(t.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for t in (g, h))
    best, value = 0.0, np.zeros(g.shape)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            parts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, None)), (slice(i, None), slice(0, j)), (slice(i, None), slice(j, None))]
            top, left = (cg[i, -1], ch[i, -1]), (cg[-1, j], ch[-1, j])
            q = [(cg[i, j], ch[i, j]), (top[0] - cg[i, j], top[1] - ch[i, j]), (left[0] - cg[i, j], left[1] - ch[i, j])]
            q.append((cg[-1, -1] - sum(p[0] for p in q), ch[-1, -1] - sum(p[1] for p in q)))
            gain = sum(_gain(*p) for p in q) - _gain(cg[-1, -1], ch[-1, -1])
            if gain > best:
                best, value = gain, np.zeros(g.shape)
                for part, (a, b) in zip(parts, q):
                    value[part] = -a / (b + SHRINK)
    return best, value


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fit on the rows of ``x``; without both labels the score is the share of label 1, or a half."""
    cuts = [_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Additive(float(np.log(share / (1 - share))), cuts, tables, [])
    intercept = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(len(y), intercept)
    binned = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(binned):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, len(tables[j])), np.bincount(b, h, len(tables[j])), SPLITS)
            tables[j] += step
            total += step[b]
    coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    small = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(coarse)]

    def table(a: int, b: int, w: np.ndarray) -> np.ndarray:
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        return np.bincount(small[a] * shape[1] + small[b], w, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ranked = sorted(((_quadrants(table(a, b, g), table(a, b, h))[0], a, b) for a, b in combinations(range(x.shape[1]), 2)), reverse=True)
    pairs = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for _, a, b in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for a, b, values in pairs:
            g, h = slopes()
            step = RATE * _quadrants(table(a, b, g), table(a, b, h))[1]
            values += step
            total += step[small[a], small[b]]
    return Additive(intercept, cuts, tables, [(a, b, coarse[a], coarse[b], v) for a, b, v in pairs])


def _scored(model: Additive):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").flatten()).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.score(x))], names=["row", "score"])

    return score


def quality_scores(
    docs: DataFrame, labels: DataFrame, folds: int = 4, fold_out: int = 2, rows: int = FIT_ROWS,
    text: str = "text", doc_id: str = "doc_id", label: str = "quality", keep: list[str] | None = None,
) -> DataFrame:
    """All rows of ``docs`` with ``score``, the probability of label 1.

    ``keep`` names the input columns to carry (default: all but ``score``). Null
    and empty texts are scored like a text without words. Of an id that
    stands several times one row is fitted on, so rows are bounded as ids are; without labelled rows every score
    is a half. The features are stored once and read for fitting and scoring.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    row = F.struct(*[F.col(f"`{c}`") for c in names], F.col(f"`{doc_id}`").alias("__fit_id")).alias("row")
    rows_in = docs.select(row, text_of(text).alias("text"))
    featured = stored(rows_in.mapInArrow(_featured, with_row(rows_in, x="array<double>")), "features")
    chosen = training_labels(labels, label, folds, fold_out, rows)
    known = featured.join(chosen, featured.row["__fit_id"] == chosen.doc_id).groupBy("doc_id", "label").agg(F.min("x").alias("x")).collect()
    known.sort(key=lambda r: (r.doc_id, r.x))
    model = fit(
        np.array([r.x for r in known]).reshape(len(known), len(FEATURES)), np.array([r.label for r in known], float)
    )
    scored = featured.mapInArrow(_scored(model), with_row(rows_in, score="double"))
    return unpacked(scored, F.col("score")).select(*names, "score")
