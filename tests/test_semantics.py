"""Null, tie and boundary rules on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayline.functions import columns as fx
from stayline.functions import features, labels, portfolio, risk
from stayline.operators import clean, contracts, dedupe, missing, outliers
from stayline.operators.quantiles import group_quantiles
from stayline.sources import files


def one(df, column="v"):
    return [r[column] for r in df.collect()]


def day(text):
    return dt.date.fromisoformat(text)


def test_clip_keeps_null_and_ratio_guards_zero(spark):
    df = spark.createDataFrame([(5.0, 0.0), (None, 2.0), (9.0, 3.0)], "a double, b double")
    assert one(df.select(fx.clip("a", 0, 4).alias("v"))) == [4.0, None, 4.0]
    assert one(df.select(fx.ratio("a", "b").alias("v"))) == [None, None, 3.0]


def test_row_sum_flag_and_inequality(spark):
    df = spark.createDataFrame([(1, None), (None, None), (7, 2)], "a int, b int")
    assert one(df.select(fx.row_sum(["a", "b"]).alias("v"))) == [1.0, 0.0, 9.0]
    assert one(df.select(fx.flag(F.col("b") > 1).alias("v"))) == [0, 0, 1]
    assert one(clean.without_value(df, "a", 7), "a") == [1, None]


def test_risk_strings(spark):
    rows = [("",), (None,), ("12",), ("0" * 24,), ("0" * 18 + "000100",)]
    df = spark.createDataFrame(rows, "r string")
    pick = lambda c: one(df.select(c.alias("v")))
    assert pick(risk.risk_ever("r")) == [0, 0, 1, 0, 1]
    assert pick(risk.risk_recent("r")) == [0, 0, 1, 0, 1]
    assert pick(risk.bad_months("r")) == [0, 0, 2, 0, 1]
    assert pick(risk.risk_volatility("r")) == [0, 0, 2, 0, 2]
    assert pick(risk.months_at_current_risk("r")) == [24, 21, 1, 24, 2]
    assert pick(risk.risk_trend("r")) == pytest.approx([0.0, 0.0, -1.0, 0.0, -1 / 3])


def test_labels(spark):
    df = spark.createDataFrame([(80.0,), (12.0,), (None,)], "c double")
    assert one(df.select(labels.profession_name("c").alias("v"))) == ["Workers", "Other_12", "Unknown"]
    text = spark.createDataFrame([("C",), ("Q",), (None,)], "c string")
    shown = labels.display_label("c", labels.FAMILY_DISPLAY)
    assert one(text.select(shown.alias("v"))) == ["Married", "Q", "Unknown"]


def test_age_and_scores(spark):
    df = spark.createDataFrame([(24,), (25,), (119,), (120,), (None,)], "a int")
    assert one(df.select(features.age_bucket("a").alias("v"))) == ["<25", "25-34", "65+", "nan", "nan"]
    s = spark.createDataFrame([("a",), ("X",), ("Z",), (None,)], "s string")
    assert one(s.select(features.behavioural_score("s").alias("v"))) == [1, 24, 25, 25]
    assert one(s.select(features.score_ordinal("s", 8).alias("v"))) == [0, None, None, None]


def test_composites_need_their_groups(spark):
    with pytest.raises(features.FeatureError):
        features.add_features(spark.range(1), composites=True)


LOAN = (
    "CONTRIB long, DOSSIER long, OBS_DATE date, POS string, DPOS date, DCREAT date, DATFIN date, D1FIN date, CRD double, "
    "SREC double, RISK string, RISKA int, RESSO double, CSP int, NBENF int, DURDEG int, RANGPRO int, RANGCLI int, "
    "MTFINO double, MTFIN double, RN double, RD double, MENSALIDADE double, PRODALP string"
)


def loan(client, contract, obs, pos="SOL", created="2020-01-01", income=None, product=None, instalment=None, amount=None):
    return (
        client, contract, day(obs), pos, day(obs), day(created), None, None, amount, None, "0" * 24, 1, income, 10, 0, 12, 1, 0,
        amount, amount, None, None, instalment, product,
    )


def test_last_value_skips_nulls_and_mode_breaks_ties_low(spark):
    rows = [
        loan(1, 1, "2021-01-01", income=100.0, product="B", instalment=1.0),
        loan(1, 1, "2021-02-01", income=200.0, product="A", instalment=4.0),
        loan(1, 1, "2021-03-01", income=None, product=None),
        loan(None, 9, "2021-03-01", income=7.0),
    ]
    out = contracts.contract_table(spark.createDataFrame(rows, LOAN)).collect()
    assert len(out) == 1  # a null client forms no group
    assert (out[0]["RESSO"], out[0]["PRODALP"], out[0]["MENSALIDADE"]) == (200.0, "A", 2.5)


def test_all_null_amount_sums_to_zero(spark):
    table = contracts.client_table(contracts.contract_table(spark.createDataFrame([loan(1, 1, "2021-01-01")], LOAN)))
    assert table.first()["TOTAL_MTFINO"] == 0.0
    assert table.first()["MEDIAN_RESSO"] is None


@pytest.mark.parametrize(
    ("created", "churn"), [("2021-01-11", 0), ("2021-01-31", 0), ("2021-02-01", 1), ("2021-01-01", 1), ("2020-06-01", 1)]
)
def test_churn_boundary_of_thirty_days(spark, created, churn):
    rows = [loan(1, 1, "2021-01-01", "SOL", "2019-01-01"), loan(1, 2, "2020-12-01", "XXX", created)]
    table = contracts.with_targets(contracts.client_table(contracts.contract_table(spark.createDataFrame(rows, LOAN))))
    assert table.first()["IS_CHURN"] == churn


def test_active_client_is_not_churned_and_never_ended_neither(spark):
    rows = [
        loan(1, 1, "2021-01-01", "SAN", "2019-01-01"),
        loan(1, 2, "2021-05-01", "ENC", "2019-02-01"),
        loan(2, 3, "2021-05-01", "ENC", "2019-02-01"),
    ]
    table = contracts.with_targets(contracts.client_table(contracts.contract_table(spark.createDataFrame(rows, LOAN))))
    got = {r["CONTRIB"]: (r["IS_EARLY_SETTLER"], r["IS_CHURN"], r["TIME_TO_CHURN_D"]) for r in table.collect()}
    assert got[1][:2] == (1, 0)
    assert got[2] == (0, 0, None)


def test_most_complete_row_wins(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, None)], "k int, x int, y string")
    got = {r["k"]: (r["x"], r["y"]) for r in dedupe.keep_most_complete(df, ["k"]).collect()}
    assert got == {1: (5, "b"), 2: (None, None)}


def test_unique_key_guard(spark):
    with pytest.raises(dedupe.DuplicateKeyError):
        dedupe.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_fill_needs_an_order(spark):
    df = spark.createDataFrame([(1, 1, 1)], "k int, t int, v int")
    for keys, order in (([], ["t"]), (["k"], [])):
        with pytest.raises(ValueError):
            missing.directional_fill(df, ["v"], keys, order)


@pytest.mark.parametrize("kind", ["int", "string", "decimal(12,3)", "date", "double"])
def test_fill_follows_the_order_of_its_own_type(spark, kind):
    """One key has most rows, so it is cut into pieces; text sorts as text, ties by the row."""
    rows = [(0 if i % 10 else i, i, None if (i * 7) % 5 else i, None if i % 3 else f"w{i}") for i in range(400)]
    rows += [(None, 3, None, "n"), (None, 4, 5, None), (0, None, -1, None), (0, None, None, "tie")]
    df = spark.createDataFrame(rows, "k int, n int, v int, w string")
    order = {"int": "n", "string": "'x' || n", "date": "date_add(date'2020-01-01', n)"}.get(kind, f"CAST(n AS {kind})")
    df = df.withColumn("t", F.expr(order)).repartition(7)
    for direction, pick in (("ffill", lambda vs: vs[-1:]), ("bfill", lambda vs: vs[:1])):
        got = missing.directional_fill(df, ["v", "w"], ["k"], ["t"], direction)
        tie = F.xxhash64(*df.columns)
        ranked = df.withColumn("h", tie).orderBy(F.asc_nulls_first("t"), "h").collect()
        expected = []
        for i, r in enumerate(ranked):
            side = ranked[: i + 1] if direction == "ffill" else ranked[i:]
            near = {c: [x[c] for x in side if x["k"] == r["k"] and x[c] is not None] for c in ("v", "w")}
            expected.append((r["k"], r["n"], *((pick(near[c]) or [None])[0] for c in ("v", "w")), r["t"]))
        assert got.columns == df.columns
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_completeness_guard_names_columns(spark):
    with pytest.raises(missing.IncompleteError, match="'b'"):
        missing.require_complete(spark.createDataFrame([(1, None)], "a int, b int"))


def test_bad_dates_and_numbers_become_null(spark):
    df = spark.createDataFrame([("2020-01-02", "7"), ("nonsense", "x")], "d string, n string")
    assert one(files.parse_dates(df, ["d"], ("yyyy-MM-dd",)).select(F.col("d").cast("date").alias("v"))) == [day("2020-01-02"), None]
    assert one(df.select(clean.in_range("n", 0, 10).alias("v"))) == [7.0, None]


def test_near_constant_and_empty_columns(spark):
    rows = [(1, None, "x" if i else "y", i) for i in range(100)]
    df = spark.createDataFrame(rows, "c int, e string, n string, v int")
    assert clean.near_constant_columns(df) == ["c", "e", "n"]
    assert clean.empty_columns(df) == ["e"]
    assert clean.constant_columns(df.select("c", "v"), ["c", "v"]) == ["c"]


def test_wide_integers_become_double(spark, tmp_path):
    df = spark.sql("SELECT CAST(9223372036854775808 AS DECIMAL(38,0)) AS w, CAST(5 AS DECIMAL(38,0)) AS s")
    assert dict(files.narrow_wide_integers(df).dtypes) == {"w": "double", "s": "decimal(38,0)"}
    with pytest.raises(ValueError):
        files.load(spark, str(tmp_path / "x.json"))


def test_quantile_ways_agree(spark):
    rows = [("hot", float((i * 7919) % 1000) / 3) for i in range(3000)] + [("cold", float(i)) for i in range(7)]
    rows += [("hot", None), ("ties", 1.0), ("ties", 1.0), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    specs = {"a": ("v", 0.5), "b": ("v", 0.9), "c": ("v", 0.01), "d": ("v", 1.0)}
    plain = {r["k"]: r for r in group_quantiles(df, ["k"], specs).collect()}
    narrow = {r["k"]: r for r in group_quantiles(df, ["k"], specs, limit=50).collect()}
    assert plain.keys() == narrow.keys()
    for k, row in plain.items():
        assert list(narrow[k])[1:] == pytest.approx(list(row)[1:], nan_ok=True) or row["a"] is None


def test_voting_bounds_skip_discrete_and_flat_columns(spark):
    rows = [(i % 5, 7.0 if i else 900.0, float(i)) for i in range(60)] + [(1, 7.0, 10_000.0)]
    df = spark.createDataFrame(rows, "code int, flat double, v double")
    bounds = outliers.voting_bounds(df, ["code", "flat", "v"])
    assert "code" not in bounds and "flat" not in bounds  # at most ten values
    loose = outliers.voting_bounds(df, ["flat"], skip_discrete=False)
    assert loose["flat"]["mod_z"].upper == float("inf")  # no spread around the median
    cleaned = outliers.blank_outliers(df, bounds)
    assert cleaned.count() == df.count()
    assert cleaned.filter("v IS NULL").count() == 1


def test_split_is_a_partition(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    left, right = clean.split_rows(df, F.col("v") > 2)
    assert (left.count(), right.count()) == (1, 2)
    assert df.filter(clean.in_set("v", [])).count() == 0


def test_action_rules_and_revenue(spark):
    rows = [(1, 0.1, 0.6), (2, 0.65, 0.55), (2, 0.65, 0.5), (3, 0.55, 0.1), (4, 0.34, 0.34), (4, 0.35, 0.1), (0, 0.9, 0.9)]
    df = spark.createDataFrame(rows, "c int, s double, h double")
    got = one(df.select(portfolio.recommended_action(F.col("c"), F.col("s"), F.col("h")).alias("v")))
    assert got == [
        "Urgent restructuring", "Urgent retention", "Refinancing offer", "Consolidation offer", "Cross-sell",
        "Standard follow-up", "Standard follow-up",
    ]
    money = spark.createDataFrame([(1000.0, 24.0, 0.5)], "a double, m double, p double")
    assert one(money.select(portfolio.revenue_at_risk(F.col("a"), F.col("m"), F.col("p")).alias("v"))) == [80.0]


def test_page_past_the_end_gives_the_last_page(spark):
    from stayline.plans.portfolio import Search, page

    df = spark.createDataFrame([(i, float(i), 0.1, 1, "Monitor", float(i)) for i in range(7)], "CONTRIB int, P_SAN double, P_CHURN double, CLUSTER int, ACTION string, REVENUE_AT_RISK double")
    assert one(page(df, Search(), 99, size=3), "CONTRIB") == [0]


def test_only_a_local_master_may_use_a_temporary_folder():
    from stayline.session import require_local

    for master in ("local", "local[8]", "local[*]"):
        require_local(master)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError):
            require_local(master)


def test_sparse_rows_of_wide_tables_are_those_of_the_plain_test(spark):
    """Wide tables count filled columns in an array: one test of them all is too long for the JVM to compile."""
    odd = [None, float("nan"), 1.0, 2.0]
    value = lambda i, j: odd[(i * 7 + j * (i % 5 + 1)) % 4] if (i + j) % 3 else (None if i % 2 else 3.0)
    rows = [tuple([i, *(value(i, j) for j in range(60)), *(None if i % 6 else "s" for _ in range(9))]) for i in range(120)]
    names = ["k long", *(f"x{j} double" for j in range(60)), *(f"s{j} string" for j in range(9))]
    df = spark.createDataFrame(rows, ", ".join(names))
    for share in (0.4, 0.5, 0.6):
        got = clean.drop_sparse_rows(df, share)
        plain = df.na.drop(thresh=int(70 * (1 - share)))
        assert "atleastnnonnulls" not in got._jdf.queryExecution().executedPlan().toString().lower()
        assert sorted(one(got, "k")) == sorted(one(plain, "k"))
    assert 0 < got.count() < 120
    assert clean.drop_sparse_rows(df, 1.0).count() == 120
