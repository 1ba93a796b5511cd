"""Fitted steps and statistical operators against plain NumPy or brute force."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stayline.ml import iterative
from stayline.ml.iterative import IterativeImputer, evidence_ridge
from stayline.ml.moments import pairwise_correlation
from stayline.ml.oversample import exact_neighbours, oversample
from stayline.ml.preprocess import ClientImputer, OneHotEncoder, OneHotModel, OutlierHandler, QuartileScaler
from stayline.ml.selection import FeatureSelector, SelectionError, SelectorModel, prune_correlated
from stayline.ml.split import stratified_folds, stratified_split
from stayline.operators import segments, survival


def frame(spark, n=240, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    t = np.ceil(rng.exponential(30 * np.exp(-0.7 * x[:, 0] + 0.4 * x[:, 1]))).astype(int)
    e = (rng.random(n) < 0.7).astype(int)
    rows = [(i, int(t[i]), int(e[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, t int, e int, a double, b double, c double").repartition(3), t, e, x


def cox_reference(t, e, x, penalty, ties):
    """Newton on the full risk sets, row by row."""
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    n, p = z.shape
    beta = np.zeros(p)
    for _ in range(60):
        w = np.exp(z @ beta)
        g, h = np.zeros(p), np.zeros((p, p))
        for day in np.unique(t[e == 1]):
            risk, dead = t >= day, (t == day) & (e == 1)
            d = int(dead.sum())
            for i in range(d):
                share = i / d if ties == "efron" else 0.0
                weight = w * (risk - share * dead)
                s0 = weight.sum()
                mean = weight @ z / s0
                g += z[dead].sum(0) / d - mean
                h += (z * weight[:, None]).T @ z / s0 - np.outer(mean, mean)
        g -= n * penalty * beta
        h += n * penalty * np.eye(p)
        move = np.linalg.solve(h, g)
        beta = beta + move
        if np.abs(move).max() < 1e-10:
            break
    return beta / x.std(0, ddof=1), np.sqrt(np.diag(np.linalg.inv(h))) / x.std(0, ddof=1)


@pytest.mark.parametrize("ties", ["efron", "breslow"])
def test_cox_matches_row_by_row_newton(spark, ties):
    df, t, e, x = frame(spark)
    model = survival.fit_cox(df, "t", "e", ["a", "b", "c"], penalty=0.05, ties=ties)
    beta, errors = cox_reference(t, e, x, 0.05, ties)
    assert model.coefficients == pytest.approx(beta, abs=1e-6)
    assert model.errors == pytest.approx(errors, rel=1e-5)


def test_tie_sums_are_those_of_all_terms():
    s0 = np.array([10.0, 500.0, 500.0, 80.0, 1e6, 3000.0])
    q0 = np.array([2.0, 500.0, 499.0, 1.0, 5.0, 1500.0])
    d = np.array([3, 200, 33, 90, 40, 1000])
    got = survival.tie_sums(s0, q0, d)
    for i in range(len(d)):
        u = np.arange(d[i]) / d[i]
        y = s0[i] - u * q0[i]
        want = [(1 / y).sum(), (u / y).sum(), (1 / y**2).sum(), (u / y**2).sum(), (u**2 / y**2).sum(), np.log(y).sum()]
        # the smallest sums of few events in a large weight are differences of larger ones
        assert [g[i] for g in got] == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_cox_with_many_ties_and_its_score_equations(spark):
    df, t, e, x = frame(spark, n=400)
    tied = df.withColumn("t", F.ceil(F.col("t") / 40).cast("int"))
    model = survival.fit_cox(tied, "t", "e", ["a", "b", "c"], penalty=0.05)
    beta, _ = cox_reference(np.ceil(t / 40).astype(int), e, x, 0.05, "efron")
    assert model.coefficients == pytest.approx(beta, abs=1e-6)
    assert np.abs(survival.score_equations(tied, "t", "e", model, 0.05)).max() < 1e-7


def test_concordance_matches_all_pairs(spark):
    df, t, e, x = frame(spark, 150)
    risk = np.round(x[:, 0], 1)  # with ties and both signs
    df = df.withColumn("risk", F.round("a", 1))
    good = bad = same = 0
    for i in range(len(t)):
        for j in range(len(t)):
            if e[i] and (t[j] > t[i] or (t[j] == t[i] and not e[j] and i != j)):
                good += risk[i] > risk[j]
                bad += risk[i] < risk[j]
                same += risk[i] == risk[j]
    row = survival.concordance(df, "t", "e", "risk").first()
    assert tuple(int(row[c]) for c in ("concordant", "discordant", "tied")) == (good, bad, same)


def test_kaplan_meier_with_ties_and_a_final_event(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (3, 0), (4, 1)], "t int, e int")
    curve = {r["t"]: r for r in survival.kaplan_meier(df, "t", "e").collect()}
    assert [curve[t]["survival"] for t in (1, 2, 3, 4)] == pytest.approx([0.8, 0.6, 0.6, 0.0])
    assert [curve[t]["at_risk"] for t in (1, 2, 3, 4)] == [5, 4, 2, 1]
    assert all(r["lower"] <= r["survival"] <= r["upper"] for r in curve.values())
    assert survival.median_survival(survival.kaplan_meier(df, "t", "e")).first()["median_days"] == 4


def test_logrank_of_equal_groups_is_zero(spark):
    df = spark.createDataFrame([(g, t, 1) for g in (0, 1) for t in (1, 2, 3)], "g int, t int, e int")
    chi2, p = survival.logrank_test(df, "t", "e", F.col("g") == 1)
    assert chi2 == pytest.approx(0.0) and p == pytest.approx(1.0)


def test_imputer_learns_on_train_only(spark):
    train = spark.createDataFrame([(1, 1.0, "a"), (2, 3.0, None), (3, None, "b")], "id int, v double, s string")
    test = spark.createDataFrame([(9, None, None)], "id int, v double, s string")
    row = ClientImputer(keep=["id"]).fit(train).transform(test).first()
    assert (row["v"], row["s"]) == (2.0, "Unknown")
    with pytest.raises(ValueError):
        ClientImputer(strategy="mode").fit(train)


def test_one_hot_unseen_and_null_give_zeros(spark, tmp_path):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    model = OneHotEncoder(columns=["s"]).fit(train)
    out = model.transform(spark.createDataFrame([("a",), ("z",), (None,)], "s string"))
    assert [tuple(r) for r in out.collect()] == [(1, 0), (0, 0), (0, 0)]
    model.write().overwrite().save(str(tmp_path / "m"))
    assert OneHotModel.load(str(tmp_path / "m")).output_columns == ["s_a", "s_b"]
    assert OneHotEncoder(columns=["s"], dropFirst=True).fit(train).output_columns == ["s_b"]
    with pytest.raises(ValueError):
        OneHotEncoder(columns=["s"], maxCategories=1).fit(train)


def test_scaler_keeps_nulls_and_survives_zero_range(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, c double")
    rows = QuartileScaler().fit(df).transform(df).collect()
    assert [r["a"] for r in rows] == [-1.0, 0.0, 1.0, None]
    assert {r["c"] for r in rows} == {0.0}


def test_outlier_handler_keeps_rows(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(50)] + [(50, 9e9)], "key_id int, v double")
    out = OutlierHandler().fit(df).transform(df)
    assert out.count() == 51 and out.filter("v IS NULL").count() == 1


def test_pairwise_correlation_uses_pairwise_complete_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 3)) + 1e6
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=80)
    x[::7, 0] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double")
    r = pairwise_correlation(df, ["a", "b", "c"])
    for i, j in ((0, 1), (0, 2), (1, 2)):
        ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert r[i, j] == pytest.approx(np.corrcoef(x[ok, i], x[ok, j])[0, 1], abs=1e-9)


def test_pruning_looks_at_earlier_partners():
    r = np.array([[1, 0.95, 0.95], [0.95, 1, 0.1], [0.95, 0.1, 1.0]])
    kept, dropped = prune_correlated(["a", "b", "c"], r, 0.9)
    assert kept == ["a"] and dropped == {"b": ["a"], "c": ["a"]}


def test_selector_votes_and_errors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.1 * rng.normal(size=300) > 0).astype(float)
    df = spark.createDataFrame([(float(y[i]), *map(float, x[i])) for i in range(300)], "label double, a double, b double, c double, d double")
    model = FeatureSelector(trees=10, forestDepth=3, lassoC=0.05).fit(df)
    assert {"a", "b"} <= set(model.value("selected"))
    assert sum(model.support()) == len(model.support(indices=True)) == len(model.value("selected"))
    with pytest.raises(SelectionError):
        model.transform(df.drop("a"))
    with pytest.raises(SelectionError):
        FeatureSelector(features=[]).fit(df)
    assert isinstance(model, SelectorModel)


def test_folds_and_split_are_exact_and_stable(spark):
    rows = [(i, float(i % 3 == 0)) for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, label double")
    folds = stratified_folds(df, "label", "id", 5)
    counts = {}
    for r in folds.groupBy("label", "fold").count().collect():
        counts.setdefault(r["label"], []).append(r["count"])
    assert all(len(c) == 5 and max(c) - min(c) <= 1 for c in counts.values())
    train, test = stratified_split(df.repartition(7), "label", "id")
    assert test.filter("label = 1").count() == round(335 * 0.2)
    assert train.count() + test.count() == 1003
    again = stratified_split(df.repartition(2), "label", "id")[1]
    assert {r["id"] for r in test.collect()} == {r["id"] for r in again.collect()}


def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(150, 3)), rng.normal(size=(90, 3)) + 6, np.repeat(rng.normal(size=(1, 3)), 8, axis=0)])
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["id", "features"])
    got = {r["id"]: [e["d"] for e in r["near"]] for r in exact_neighbours(df, 4, block_rows=40).collect()}
    for i in range(len(x)):
        d = np.sort(np.delete(np.linalg.norm(x - x[i], axis=1), i))[:4]
        assert got[i] == pytest.approx(list(d), abs=1e-6)


def test_oversampling_balances_and_stays_in_the_hull(spark):
    rows = [(i, float(i < 12), Vectors.dense([float(i), float(i % 5)])) for i in range(61)]
    out = oversample(spark.createDataFrame(rows, ["id", "label", "features"]), k=3).collect()
    minority = [r["features"] for r in out if r["label"] == 1.0]
    assert len(minority) == len(out) - len(minority) == 49
    assert all(0 <= v[0] <= 11 and 0 <= v[1] <= 4 for v in minority)


def test_oversampling_takes_text_ids(spark):
    rows = [(f"C{i}", float(i < 12), Vectors.dense([float(i), float(i % 5)])) for i in range(41)]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    assert oversample(df, k=3).filter("label = 1").count() == 29
    with pytest.raises(ValueError, match="unique"):
        oversample(df.union(df.filter("label = 1").limit(1)), k=3)


def test_concordance_counts_more_pairs_than_a_long_holds(spark):
    from stayline.operators import survival

    product = spark.range(1).select(survival._pairs(F.lit(10**10), F.lit(10**10)).alias("p")).first()["p"]
    assert product == 10**20


def test_evidence_ridge_recovers_weights():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    y = x @ [1.0, -2.0, 0.0] + 0.01 * rng.normal(size=500)
    xc, yc = x - x.mean(0), y - y.mean()
    assert evidence_ridge(xc.T @ xc, xc.T @ yc, yc @ yc, 500) == pytest.approx([1.0, -2.0, 0.0], abs=0.01)


def test_iterative_imputer_recovers_a_linear_column(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 2))
    rows = [(i, float(a), float(b), None if i % 5 == 0 else float(3 * a - b + 2)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    out = IterativeImputer(columns=["a", "b", "y"], maxIter=4).fit(df).transform(df).collect()
    assert max(abs(r["y"] - (3 * r["a"] - r["b"] + 2)) for r in out) < 0.01


def test_iterative_imputer_is_that_of_plain_rounds(spark):
    """Every regression on the values as they stand, rows and columns in plain NumPy."""
    rng = np.random.default_rng(6)
    full = rng.normal(size=(120, 4)) @ rng.normal(size=(4, 4)) + 5
    gaps = rng.random(full.shape) < [0.0, 0.1, 0.2, 0.4]
    rows = [(i, *[None if g else float(v) for v, g in zip(row, hole)]) for i, (row, hole) in enumerate(zip(full, gaps))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double").repartition(3)
    model = IterativeImputer(columns=["a", "b", "c", "d"], maxIter=3, tolerance=0.0).fit(df)
    seen = np.where(gaps, np.nan, full)
    now = np.where(gaps, np.nanmean(seen, axis=0), full)
    for _ in range(3):
        for j in (1, 2, 3):
            own = ~gaps[:, j]
            x, y = np.delete(now[own], j, axis=1), now[own, j]
            a, b = x - x.mean(0), y - y.mean()
            w = evidence_ridge(a.T @ a, a.T @ b, b @ b, len(y))
            now[~own, j] = y.mean() + (np.delete(now[~own], j, axis=1) - x.mean(0)) @ w
    out = {r["id"]: r for r in model.transform(df).collect()}
    got = np.array([[out[i][c] for c in "abcd"] for i in range(len(rows))])
    assert got == pytest.approx(now, abs=1e-6)
    assert len(model.value("steps")) == 9


def test_imputer_takes_products_from_patterns_of_gaps(spark, monkeypatch):
    """One scan for all columns and rounds; with too many patterns, scans per column give the same regressions."""
    rng = np.random.default_rng(9)
    full = rng.normal(size=(300, 9)) @ rng.normal(size=(9, 9)) + 50
    gaps = rng.random(full.shape) < [0.0, 0.1, 0.2, 0.4, 0.0, 0.3, 0.1, 0.0, 0.5]
    names = list("abcdefghi")
    rows = [tuple(None if g else float(v) for v, g in zip(row, hole)) for row, hole in zip(full, gaps)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    monkeypatch.setattr(iterative, "BLOCK_ROWS", 70)
    fit = lambda: IterativeImputer(columns=names, maxIter=3, tolerance=0.0).fit(df).value("steps")
    monkeypatch.setattr(iterative, "PATTERN_NUMBERS", 0)
    by_scans = fit()
    monkeypatch.undo()

    def scan(*_):
        raise AssertionError("a scan per column")

    monkeypatch.setattr(iterative, "summed_arrays", scan)
    by_patterns = fit()
    assert [j for j, *_ in by_patterns] == [j for j, *_ in by_scans] and len(by_scans) == 18
    for (_, a, v), (_, b, w) in zip(by_patterns, by_scans):
        assert a == pytest.approx(b, rel=1e-6, abs=1e-6) and v == pytest.approx(w, rel=1e-6, abs=1e-6)


def test_ward_joins_close_points():
    points = np.array([[0.0], [0.1], [5.0], [5.1], [20.0]])
    assert segments.ward_labels(points, 3) == [1, 1, 2, 2, 3]


def test_validation_measures(spark):
    rows = [(0, 0.0, 0.0), (0, 0.0, 2.0), (1, 10.0, 0.0), (1, 10.0, 2.0)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    assert segments.davies_bouldin(df, ["x", "y"], "g").first()[0] == pytest.approx(0.2)
    assert segments.r_squared(df, ["x", "y"], "g").first()[0] == pytest.approx(100 / 104)


def test_clusters_leave_incomplete_rows_unassigned(spark):
    rows = [(i, float(i % 2) * 10 + i / 100, 1.0) for i in range(40)] + [(99, None, 1.0)]
    df = spark.createDataFrame(rows, "CONTRIB long, x double, y double")
    out, _ = segments.assign_clusters(df, ["x", "y"], "k", 2, starts=2)
    got = {r["CONTRIB"]: r["k"] for r in out.collect()}
    assert got[99] is None and len({got[i] for i in range(0, 40, 2)}) == 1 and got[0] != got[1]


def test_report_arithmetic(spark):
    from stayline.plans.modelling import auc, classification_report

    rows = [(1.0, 1, 0.9), (1.0, 0, 0.4), (0.0, 0, 0.2), (0.0, 1, 0.6)]
    df = spark.createDataFrame(rows, "label double, predicted int, probability double")
    got = {r["class"]: r for r in classification_report(df).collect()}
    assert got["1"]["precision"] == got["1"]["recall"] == 0.5 and got["accuracy"]["f1"] == 0.5
    assert auc(df) == pytest.approx(0.75)
    assert math.isclose(got["weighted"]["support"], 4)


def test_target_is_never_a_predictor(spark, small):
    from stayline.plans.abt import stored_abt
    from stayline.plans.columns import TARGETS
    from stayline.plans.modelling import scoring_rows

    rows = scoring_rows(stored_abt(spark, small), "IS_CHURN")
    assert not set(TARGETS) & set(rows.columns)
