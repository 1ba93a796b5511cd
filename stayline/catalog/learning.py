"""Feature selection and supervised models, with the parameters they are meant to run with."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.catalog.base import query
from stayline.plans import bindings
from stayline.plans import modelling as m
from stayline.plans.abt import stored_abt
from stayline.session import materialise

# ---- fixed values: settings found best for the two targets ----
SETTLE_BEST = m.Setting("boosting", {"rate": 0.1, "rounds": 200, "depth": 7, "leaf": 30, "l2": 1.0})
SETTLE_SELECTOR = {"corrThreshold": 0.85, "lassoC": 0.01, "rfeFraction": 0.5}
CHURN_BEST = m.Setting("boosting", {"rate": 0.03, "rounds": 300, "depth": None, "leaf": 10, "l2": 0.0})
CHURN_SELECTOR = {"corrThreshold": 0.95, "lassoC": 0.1, "rfeFraction": 0.6}
# ---- end of fixed values ----


def _settle_rows(spark, folder):
    return m.training_rows(stored_abt(spark, folder), "IS_EARLY_SETTLER")


_SETTLED = "FROM clients WHERE EVER_SAN = 1 OR EVER_SOL = 1 OR EVER_RBT = 1"


@query(
    "p01_stratified_split",
    f"""SELECT part, label, n AS rows FROM (SELECT IS_EARLY_SETTLER AS label, CAST(round_even(count(*) * 0.2, 0) AS BIGINT) AS t, count(*) AS c {_SETTLED} GROUP BY 1),
    LATERAL (VALUES ('test', t), ('train', c - t)) v(part, n)""",
    doubles="label",
)
def p01(spark, folder):
    from stayline.ml.split import stratified_split

    train, test = stratified_split(_settle_rows(spark, folder), m.LABEL, m.KEY)
    count = lambda df, part: df.groupBy(m.LABEL).agg(F.count("*").alias("rows")).withColumn("part", F.lit(part))
    return count(train, "train").unionByName(count(test, "test"))


@query(
    "p02_stratified_folds",
    f"""SELECT f.fold, label, (fold + 1) * n // 5 - fold * n // 5 AS rows FROM (SELECT IS_EARLY_SETTLER AS label, count(*) AS n {_SETTLED} GROUP BY 1),
    (VALUES (0), (1), (2), (3), (4)) f(fold)""",
    doubles="label",
)
def p02(spark, folder):
    from stayline.ml.split import stratified_folds

    return stratified_folds(_settle_rows(spark, folder), m.LABEL, m.KEY).groupBy("fold", m.LABEL).agg(F.count("*").alias("rows"))


def _numeric(spark, folder):
    """Order lines with a label that depends on the price: a fixed selection problem."""
    rows = bindings.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_tax", (F.col("l_extendedprice") / 10000).alias("price"),
        (F.col("l_extendedprice") / 10000 * 1.01 + F.col("l_tax")).alias("gross"), (F.col("l_suppkey") % 7).cast("double").alias("noise"),
    )
    signal = F.col("price") + F.col("l_quantity") / 20 + F.pmod(F.xxhash64("l_orderkey", "price"), F.lit(100)) / 50
    return rows.withColumn("label", (signal > 7.5).cast("double"))


SELECTED = ["l_quantity", "l_discount", "l_tax", "price", "gross", "noise"]


@query("o01_correlation_pruning")
def o01(spark, folder):
    from stayline.ml.moments import pairwise_correlation
    from stayline.ml.selection import prune_correlated

    rows = _numeric(spark, folder)
    kept, dropped = prune_correlated(SELECTED, pairwise_correlation(rows, SELECTED), 0.9)
    table = [(f, f in kept, ",".join(dropped.get(f, []))) for f in SELECTED]
    return spark.createDataFrame(table, "feature string, kept boolean, partners string")


@query("o02_o06_selection_audit")
def o06(spark, folder):
    from stayline.ml.selection import FeatureSelector

    return FeatureSelector(features=SELECTED).fit(_numeric(spark, folder)).audit(spark)


@query("o07_apply_selection")
def o07(spark, folder):
    from stayline.ml.selection import FeatureSelector

    rows = _numeric(spark, folder)
    model = FeatureSelector(features=SELECTED, useForest=False).fit(rows)
    return model.transform(rows).groupBy("label").agg(F.count("*").alias("rows"), F.lit(sum(model.support())).alias("selected"))


@query(
    "p03_oversampling",
    """SELECT CASE WHEN c_nationkey < 5 THEN 1 ELSE 0 END AS label, (SELECT count(*) FROM customer WHERE c_nationkey >= 5) AS rows
    FROM customer GROUP BY 1""",
    doubles="label",
)
def p03(spark, folder):
    from pyspark.ml.feature import VectorAssembler

    from stayline.ml.oversample import oversample

    rows = bindings.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), (F.col("c_nationkey") < 5).cast("double").alias("label"),
        (F.col("c_acctbal") / 1000).alias("a"), (F.col("c_custkey") % 97 / 10).alias("b"),
    )
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    return oversample(vectors).groupBy("label").agg(F.count("*").alias("rows"))


_PLANE = "SELECT c_custkey AS id, c_acctbal / 1000 AS a, c_custkey % 97 / 10.0::DOUBLE AS b FROM customer"


@query(
    "p03_nearest_neighbours",
    f"""WITH p AS ({_PLANE}), d AS (SELECT p.id, q.id AS other, sqrt((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b)) AS d
      FROM p JOIN p q ON p.id <> q.id)
    SELECT id, CAST(n AS INTEGER) AS n, d AS distance FROM (
      SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY d) AS n FROM d) WHERE n <= 5""",
    doubles="distance",
)
def p03_near(spark, folder):
    """Distances of the five nearest others of every customer in a plane, by ball tree."""
    from pyspark.ml.feature import VectorAssembler

    from stayline.ml.oversample import exact_neighbours

    rows = bindings.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 1000).alias("a"), (F.col("c_custkey") % 97 / 10).alias("b")
    )
    near = exact_neighbours(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows), 5, block_rows=100)
    return near.select("id", F.posexplode("near").alias("i", "e")).select("id", (F.col("i") + 1).alias("n"), F.col("e.d").alias("distance"))


@query("p04_p05_pipeline_scores")
def p04(spark, folder):
    """Probabilities of the held-out clients by one fitted pipeline."""
    train, test = m.train_and_test(stored_abt(spark, folder), "IS_EARLY_SETTLER")
    return m.fit_scorer(train, m.Setting("forest")).score(test)


@query(
    "p05_boosting_first_split",
    """WITH r AS (SELECT l_quantity AS f0, l_discount AS f1, l_tax AS f2, CAST(l_linenumber AS DOUBLE) AS f3,
        CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y FROM lineitem),
    s AS (SELECT sum(y) / count(*) AS share FROM r),
    d AS (SELECT r.*, round((1 / (1 + exp(-ln(share / (1 - share)))) - y) * 4294967296) / 4294967296 AS g,
        round(share * (1 - share) * 4294967296) / 4294967296 AS h FROM r, s),
    v AS (UNPIVOT (SELECT f0, f1, f2, f3, g, h FROM d) ON f0, f1, f2, f3 INTO NAME f VALUE x),
    c AS (SELECT f, x, sum(g) AS g, sum(h) AS h, count(*) AS n FROM v GROUP BY f, x),
    u AS (SELECT f, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, sum(g) OVER t AS g, sum(h) OVER t AS h,
        sum(n) OVER t AS n, lead(x) OVER (PARTITION BY f ORDER BY x) AS nx
        FROM c WINDOW w AS (PARTITION BY f ORDER BY x), t AS (PARTITION BY f)),
    b AS (SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain FROM u
        WHERE nx IS NOT NULL AND nl >= 30 AND n - nl >= 30 QUALIFY row_number() OVER (ORDER BY gain DESC, f, x) = 1)
    SELECT CAST(right(f, 1) AS INTEGER) AS feature, (x + nx) / 2 AS cut, gain, CAST(nl AS BIGINT) AS left_rows, CAST(n - nl AS BIGINT) AS right_rows,
        -gl / (hl + 1) AS left_value, -(g - gl) / (h - hl + 1) AS right_value FROM b""",
    doubles="cut gain left_value right_value",
)
def p05_split(spark, folder):
    """The first split of boosted trees on order lines: its gain from merged histograms and the values of both leaves."""
    from pyspark.ml.feature import VectorAssembler

    from stayline.ml.boosting import HistogramBoosting

    names = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    rows = bindings.table(spark, folder, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("double"))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    model = HistogramBoosting(rounds=1, maxLeaves=2, leaf=30, l2=1.0).fit(vectors)
    root, left, right = model.value("trees")[0]
    cut = model.value("edges")[root["feature"]][root["bin"]]
    found = (root["feature"], cut, root["gain"], left["rows"], right["rows"], left["value"], right["value"])
    return spark.createDataFrame(
        [found], "feature int, cut double, gain double, left_rows long, right_rows long, left_value double, right_value double"
    )


@query("p06_model_comparison")
def p06(spark, folder):
    """All models on five folds, the logistic one with oversampling too."""
    settings = [m.Setting("logistic"), m.Setting("forest"), m.Setting("boosting"), m.Setting("logistic", smote=True)]
    return m.compare_models(_settle_rows(spark, folder), settings, folds=5)


@query("p07_random_search")
def p07(spark, folder):
    """Five drawn settings of logistic models on five folds; more draws are a parameter."""
    train, _ = m.train_and_test(stored_abt(spark, folder), "IS_EARLY_SETTLER")
    return m.random_search(train, m.draw_settings("logistic", False, 5), folds=5).trials


@query("p08_evaluation_report")
def p08(spark, folder):
    train, test = m.train_and_test(stored_abt(spark, folder), "IS_EARLY_SETTLER")
    scored = materialise(m.fit_scorer(train, SETTLE_BEST, SETTLE_SELECTOR).score(test))
    return m.classification_report(scored).withColumn("auc", F.lit(m.auc(scored)))


_SCORED_LINES = "SELECT l_quantity * (1 - l_discount) AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS hit FROM lineitem"


def _scored_lines(spark, folder):
    return bindings.table(spark, folder, "lineitem").select(
        (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("probability"), (F.col("l_returnflag") == "R").cast("int").alias(m.LABEL)
    )


@query(
    "p08_roc_area",
    f"""SELECT sum(hit * (below + same / 2.0)) / (sum(hit) * sum(1 - hit)) AS auc FROM (
      SELECT score, hit, (sum(1 - hit) OVER (ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) - (sum(1 - hit) OVER (PARTITION BY score)) AS below,
      sum(1 - hit) OVER (PARTITION BY score) AS same FROM ({_SCORED_LINES}))""",
    doubles="auc",
)
def p08_area(spark, folder):
    """Area under the ROC curve of a score with ties, by ranks."""
    return spark.createDataFrame([(m.auc(_scored_lines(spark, folder)),)], "auc double")


@query(
    "p08_roc_curve",
    f"""SELECT score, CAST(sum(hit) AS BIGINT) AS positives, CAST(sum(1 - hit) AS BIGINT) AS negatives,
      CAST(coalesce(sum(sum(hit)) OVER w, 0) AS BIGINT) AS positives_above, CAST(coalesce(sum(sum(1 - hit)) OVER w, 0) AS BIGINT) AS negatives_above
      FROM ({_SCORED_LINES}) GROUP BY score WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    doubles="score",
)
def p08_curve(spark, folder):
    return m.roc_points(_scored_lines(spark, folder))


@query(
    "p08_thresholds",
    f"""SELECT t AS threshold, count(*) FILTER (WHERE score >= t AND hit = 1) AS tp, count(*) FILTER (WHERE score >= t AND hit = 0) AS fp,
      count(*) FILTER (WHERE score < t AND hit = 1) AS fn, count(*) FILTER (WHERE score < t AND hit = 0) AS tn
      FROM ({_SCORED_LINES}), (VALUES (10.0::DOUBLE), (25.0::DOUBLE), (40.0::DOUBLE)) v(t) GROUP BY t""",
    doubles="threshold",
)
def p08_cuts(spark, folder):
    return m.threshold_counts(_scored_lines(spark, folder), [10.0, 25.0, 40.0])


@query("p09_score_active_clients")
def p09(spark, folder):
    return m.score_active(stored_abt(spark, folder), "IS_CHURN", CHURN_BEST, CHURN_SELECTOR)
