"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import lower_ascii

from stayline.llm import ranked_search
from stayline.llm.ranked_search import Bounds, best_of_block

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lower_ascii(text or ""))


def brute(docs, items, k):
    """Rows (item, rank, doc, score), documents being (id, text)."""
    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    out = []
    df = Counter(t for _, c in counted for t in c)
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    for item, text in items:
        scored = []
        for (doc, counts), length in zip(counted, lengths):
            score = 0
            for t in set(terms(text)):
                if counts[t]:
                    w = weights[t]
                    score += w * (10**9 * counts[t] // (1000 * counts[t] + 20 * (50 + 50 * length * n // total)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return out


def corpus(seed, n, vocabulary=60, words=(0, 40)):
    r = random.Random(seed)
    pool = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(r.choices(pool, weights, k=r.randint(*words))) for _ in range(n)]


@pytest.mark.parametrize("k", [3, 50])
def test_against_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 900)
    monkeypatch.setattr(ranked_search, "ITEM_BLOCK", 5)
    monkeypatch.setattr(ranked_search, "FIRST_OF", 3)
    texts = corpus(1, 300)
    texts[5:9] = ["W1, w2!", "W1 w2", None, ""]
    docs = [(1000 - i if i % 50 else None, t) for i, t in enumerate(texts)]
    items = [(i, t) for i, t in enumerate([*corpus(2, 12, words=(1, 12)), "absent", "", None, "w1 w1 w0"])]
    index = ranked_search.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    got = ranked_search.ranked(index, spark.createDataFrame(items, "item_id long, text string"), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == brute(docs, items, k)


def test_odd_rows(odd_docs, no_docs, odd_texts):
    index = ranked_search.build_index(odd_docs)
    items = odd_docs.select("score", "text").withColumnRenamed("score", "item")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted(map(tuple, ranked_search.ranked(index, items, 5).collect()), key=lambda r: r[:2])
    want = brute(docs, sorted((r["item"], r["text"]) for r in items.collect()), 5)
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]
    assert ranked_search.ranked(index, items.limit(0)).count() == 0
    assert ranked_search.ranked(ranked_search.build_index(no_docs), items).count() == 0


def test_pair_bounds_hold_and_skip():
    """Bounds are never below what a document gains, and are below the sum of single maxima where pairs say so."""
    rng = np.random.default_rng(4)
    lower = 0
    for _ in range(60):
        own = {}
        for t in "abcdef":
            docs = np.sort(rng.choice(40, rng.integers(1, 25), replace=False))
            own[t] = (docs, rng.integers(1, 100, len(docs)))
        joint = {}
        for t, u in ("ab", "bc", "cd", "ae", "ef"):
            both, i, j = np.intersect1d(own[t][0], own[u][0], return_indices=True)
            joint[t, u] = (int((own[t][1][i] + own[u][1][j]).max()) if len(both) else 0, both)
        most = {t: int(g.max()) for t, (_, g) in own.items()}
        partners = {t: [u for p in joint for u in p if t in p and u != t] for t in own}
        names = sorted(own, key=lambda t: (-most[t], t))
        bounds = Bounds(names, most, joint, partners)
        scores = np.zeros(40, np.int64)
        for start in (5, 4, 3, 2, 1, 0):
            docs, gain = own[names[start]]
            scores[docs] += gain
            assert bounds.bound(start) >= bounds.bounds(start, np.arange(40)).max() >= scores.max()
            assert (bounds.bounds(start, np.arange(40)) >= scores).all()
        lower += bounds.bound(0) < sum(most.values())
        for floor in (0, int(np.median(scores)), int(scores.max()), int(scores.max()) + 1):
            docs, found = best_of_block(names, own, bounds, 40, 5, floor)
            order = [d for d in np.lexsort((np.arange(40), -scores)) if scores[d] >= max(floor, 1)][:5]
            assert (docs.tolist(), found.tolist()) == (order, scores[order].tolist())
    assert lower > 30


def test_terms_of_texts():
    texts = ["Été-x_9 日本!ABC", "", "a", "b"]
    coded, owner = ranked_search.occurrences(pa.array(texts))
    assert list(zip(coded.to_pylist(), owner.tolist())) == [(t, i) for i, x in enumerate(texts) for t in terms(x)]
