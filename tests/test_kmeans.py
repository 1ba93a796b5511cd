"""Batched k-means against plain NumPy, and the density and as-of join on small tables."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stayline.ml import kmeans
from stayline.operators import joins, segments


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.4, (60, 2)) for c in ((0, 0), (5, 0), (0, 6))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    return df.repartition(3).persist(), x


def test_centres_are_means_of_their_rows(blobs):
    df, x = blobs
    rows = df.select("id", F.array("a", "b").alias("x"))
    best = kmeans.fit_many(rows, [2, 3], 4, "id")
    for k, (cost, centres) in best.items():
        d = ((x[:, None] - centres[None]) ** 2).sum(2)
        at = d.argmin(1)
        assert cost == pytest.approx(d.min(1).sum())
        for j in range(k):
            assert centres[j] == pytest.approx(x[at == j].mean(0), abs=1e-3)
    assert kmeans.fit_many(rows.repartition(5), [3], 4, "id")[3][1] == pytest.approx(best[3][1])
    labels = {frozenset(np.flatnonzero(((x[:, None] - best[3][1][None]) ** 2).sum(2).argmin(1) == j) // 60) for j in range(3)}
    assert labels == {frozenset([0]), frozenset([1]), frozenset([2])}


def test_silhouette_is_that_of_the_evaluator(blobs):
    df, x = blobs
    sweep = segments.sweep_clusters(df, ["a", "b"], "id", ks=(2, 3, 4), starts=3).collect()
    for r in sweep:
        out, centres = segments.assign_clusters(df, ["a", "b"], "g", r["k"], "id", starts=3)
        vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(out)
        assert r["silhouette"] == pytest.approx(ClusteringEvaluator(predictionCol="g").evaluate(vectors), abs=1e-9)
        assert r["inertia"] == pytest.approx(((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum())


def test_labels_are_nearest_centres(blobs):
    df, x = blobs
    out, centres = segments.assign_clusters(df, ["a", "b"], "g", 3, "id", starts=2)
    for r in out.collect():
        assert r["g"] == ((np.array([r["a"], r["b"]]) - centres) ** 2).sum(1).argmin()


def test_passes_read_packed_blocks(spark, blobs, monkeypatch):
    """Rows lie in whole matrices, one task a full block at most, and all of them are passed over."""
    df, x = blobs
    monkeypatch.setattr(kmeans, "BLOCK_ROWS", 50)
    monkeypatch.setattr(kmeans, "STEP_ROWS", 7)
    blocks = kmeans.packed(df.select("id", F.array("a", "b").alias("x")).repartition(40))
    assert blocks.rdd.getNumPartitions() == min(4, spark.sparkContext.defaultParallelism)
    held = np.concatenate([np.frombuffer(r.x).reshape(r.n, 2) for r in blocks.collect()])
    assert np.array_equal(held[np.lexsort(held.T)], x[np.lexsort(x.T)])
    centres = np.array([[0.0, 0.0], [5.0, 0.0], [0.0, 0.0], [90.0, 90.0]])
    at, d = kmeans.assigned(np.ascontiguousarray(x.T), centres)
    every = ((x[:, None] - centres[None]) ** 2).sum(2)
    assert np.array_equal(at, every.argmin(1)) and d == pytest.approx(every.min(1))
    (found,) = kmeans._sums(blocks, [centres])
    assert found[2] is None and found[3] is None
    for j in (0, 1):
        n, s, ss, cost = found[j]
        own = x[at == j]
        assert (n, ss, cost) == (len(own), pytest.approx((own**2).sum()), pytest.approx(d[at == j].sum())) and s == pytest.approx(own.sum(0))


def test_newest_row_at_or_before(spark):
    left = spark.createDataFrame(
        [(1, 5, "a"), (1, 1, "b"), (2, 9, "c"), (None, 3, "d"), (3, None, "e"), (1, 5, "a"), (4, 7, "f")], "k int, t int, v string"
    )
    right = spark.createDataFrame([(1, 2, 10, "x"), (1, 5, 11, "y"), (1, 5, 12, "w"), (2, 9, 20, "z"), (None, 1, 1, "n"), (4, 8, 2, "q")], "k int, t int, s int, v string")
    got = sorted(joins.latest_join(left.repartition(3), right, ["k"], "t", "t", "_r").collect(), key=str)
    want = {(1, 5, "a"): (5, 12, "w"), (1, 1, "b"): (None,) * 3, (2, 9, "c"): (9, 20, "z"), (4, 7, "f"): (None,) * 3}
    assert len(got) == 7
    for r in got:
        assert (r["t_r"], r["s"], r["v_r"]) == want.get((r["k"], r["t"], r["v"]), (None,) * 3)


def test_a_hot_key_is_cut(spark):
    """One client with many rows on both sides: the carried row crosses the borders of the pieces."""
    left = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    right = spark.createDataFrame([(1, 0, "first"), (1, 1500, "second")], "k int, s long, v string")
    got = {r["t"]: r["v"] for r in joins.latest_join(left.repartition(4), right, ["k"], "t", "s").collect()}
    assert all(v == ("second" if t >= 1500 else "first") for t, v in got.items()) and len(got) == 2000
