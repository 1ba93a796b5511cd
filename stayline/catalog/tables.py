"""Sources, profiling, cleaning, missing values, duplicates and joins on row-level tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stayline.catalog.base import query

from stayline.operators import clean, contracts, dedupe, joins, missing, profile
from stayline.plans import abt as plan
from stayline.plans import bindings
from stayline.plans.abt import stored_abt
from stayline.session import shared_dir
from stayline.sources import files
from stayline.sources.schema import columns_with_prefix, numeric_columns


def scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}-{name}"


# ------------------------------------------------------------------ sources and sinks

_ORDERS = """SELECT o_orderstatus, count(*) AS rows, min({d}) AS first_day, max({d}) AS last_day,
  sum(o_totalprice) AS total FROM orders GROUP BY o_orderstatus""".format(d="CAST(o_orderdate AS DATE)")


def order_summary(df):
    day = F.col("o_orderdate").cast("date")
    return df.groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.sum("o_totalprice").alias("total"),
    )


def order_rows(spark, folder):
    return bindings.table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("a01_csv_scan", _ORDERS, doubles="total", dates="first_day last_day", places=2)
def a01(spark, folder):
    source = order_rows(spark, folder)
    path = scratch(spark, "orders.csv")
    files.save(source.withColumn("o_orderdate", F.col("o_orderdate").cast("string")), path)
    text_day = source.withColumn("o_orderdate", F.col("o_orderdate").cast("string")).schema
    return order_summary(files.load(spark, path, text_day, dates=("o_orderdate",)))


@query("a02_parquet_scan", _ORDERS, doubles="total", dates="first_day last_day", places=2)
def a02(spark, folder):
    return order_summary(files.load(spark, f"{folder}/orders.parquet"))


@query("a04_named_sources", "SELECT count(*) AS rows, count(DISTINCT CONTRIB) AS clients, sum(sdem_age) AS ages FROM fama_raw", doubles="ages")
def a04(spark, folder):
    root = scratch(spark, "sources")
    keep = ["CONTRIB", "Date_Obs", "sdem_SITFAM", "sdem_HABITAT", "sdem_age"]
    rows = bindings.client_aggregates(spark, folder).select(*keep).withColumn("Date_Obs", F.col("Date_Obs").cast("string"))
    files.save(rows, f"{root}/fama.csv")
    registry = files.SourceRegistry(root)
    registry.sources["fama"] = files.Source("fama.csv", rows.schema, ("Date_Obs",))
    back = registry.load(spark, "fama")
    return back.agg(F.count("*").alias("rows"), F.count_distinct("CONTRIB").alias("clients"), F.sum("sdem_age").alias("ages"))


@query("a06_parquet_sink", _ORDERS, doubles="total", dates="first_day last_day", places=2)
def a06(spark, folder):
    path = scratch(spark, "orders.parquet")
    files.save(order_rows(spark, folder), path, partition_by=("o_orderstatus",))
    return order_summary(files.load(spark, path))


@query("a07_wide_integers", "SELECT count(*) AS rows, sum(CAST(o_orderkey AS DOUBLE) * 1e18) / 1e24 AS wide FROM orders", doubles="wide", places=3)
def a07(spark, folder):
    wide = (F.col("o_orderkey").cast("decimal(19,0)") * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(38,0)")
    rows = files.narrow_wide_integers(order_rows(spark, folder).select(wide.alias("wide")))
    return rows.agg(F.count("*").alias("rows"), (F.sum("wide") / 1e24).cast("double").alias("wide"))


@query("a08_parquet_to_csv", "SELECT n_regionkey, count(*) AS rows FROM nation GROUP BY n_regionkey")
def a08(spark, folder):
    path = scratch(spark, "nation.csv")
    files.parquet_to_csv(spark, f"{folder}/nation.parquet", path)
    schema = bindings.table(spark, folder, "nation").schema
    return files.load(spark, path, schema).groupBy("n_regionkey").agg(F.count("*").alias("rows"))


@query("a09_save_and_verify", "SELECT count(*) AS rows, sum(c_acctbal) AS balance FROM customer", doubles="balance", places=2)
def a09(spark, folder):
    back = files.save_and_verify(bindings.table(spark, folder, "customer"), scratch(spark, "customer.parquet"))
    return back.agg(F.count("*").alias("rows"), F.sum("c_acctbal").alias("balance"))


_SCORED = """SELECT CONTRIB, CASE WHEN HAS_ACTIVE = 1 THEN CAST(CONTRIB % 10 AS DOUBLE) / 10 END AS Prob_SAN,
  CASE WHEN HAS_ACTIVE = 1 THEN CAST(CONTRIB % 7 AS DOUBLE) / 7 END AS Prob_Churn FROM clients"""


@query("a10_score_upsert", _SCORED, doubles="Prob_SAN Prob_Churn")
def a10(spark, folder):
    """Two score sets attached in turn, the first one twice: the second write replaces it."""
    root = scratch(spark, "scored")
    base = stored_abt(spark, folder).select("CONTRIB", "HAS_ACTIVE")
    active = base.filter("HAS_ACTIVE = 1")
    score = lambda name, n: active.select("CONTRIB", ((F.col("CONTRIB") % n).cast("double") / n).alias(name))
    for scores in (score("Prob_SAN", 3), score("Prob_Churn", 7), score("Prob_SAN", 10)):
        path = files.upsert_scores(spark, root, "scored", base, scores)
    return spark.read.parquet(path).select("CONTRIB", "Prob_SAN", "Prob_Churn")


@query("a11_segment_append", "SELECT CONTRIB, CASE WHEN HAS_ACTIVE = 1 THEN CONTRIB % 4 + 1 END AS segment_final FROM clients", doubles="segment_final")
def a11(spark, folder):
    base = stored_abt(spark, folder).select("CONTRIB", "HAS_ACTIVE")
    segments = base.filter("HAS_ACTIVE = 1").select("CONTRIB", (F.col("CONTRIB") % 4 + 1).alias("segment_final"))
    path = files.upsert_scores(spark, scratch(spark, "segments"), "scored", base, segments)
    return spark.read.parquet(path).select("CONTRIB", "segment_final")


@query("a12_active_snapshot", "SELECT CONTRIB, N_CONTRACTS FROM clients WHERE HAS_ACTIVE = 1")
def a12(spark, folder):
    path = scratch(spark, "active.parquet")
    files.save(stored_abt(spark, folder).filter("HAS_ACTIVE = 1").select("CONTRIB", "N_CONTRACTS"), path)
    return files.load(spark, path)


@query("a13_rejected_rows_output", "SELECT 'kept' AS part, count(*) AS rows FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT 'rejected', count(*) FROM customer WHERE c_acctbal < 0")
def a13(spark, folder):
    path = scratch(spark, "rejected.parquet")
    kept = files.save_split(bindings.table(spark, folder, "customer"), F.col("c_acctbal") < 0, path)
    count = lambda df, part: df.agg(F.lit(part).alias("part"), F.count("*").alias("rows"))
    return count(kept, "kept").unionByName(count(files.load(spark, path), "rejected"))


# ------------------------------------------------------------------ profiling

_BUREAU_COLUMNS = (
    "CONTRIB OBS_DATE MT_MENSAL COUNT_CL COUNT_CP COUNT_AUTO COUNT_HT COUNT_TOTAL MONTVENC_CL MONTVENC_CP "
    "MONTVENC_AUTO MONTVENC_HT MONTABATV_CL DIVIDAS_CL DIVIDAS_CP DIVIDAS_AUTO DIVIDAS_HT SEQ_EVENT"
).split()
_LONG_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END) * 100 AS missing_pct FROM bureau_raw"
    for c in _BUREAU_COLUMNS
)


@query(
    "b01_dataset_summary",
    f"""SELECT count(*) AS rows, 18 AS columns, 17 AS numeric_columns, 0 AS text_columns, 1 AS date_columns,
    CAST(sum({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _BUREAU_COLUMNS)}) AS BIGINT) AS missing_cells,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM bureau_raw)) AS duplicate_rows,
    sum({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _BUREAU_COLUMNS)}) * 100.0 / (count(*) * 18) AS missing_pct
    FROM bureau_raw""",
    doubles="missing_pct",
)
def b01(spark, folder):
    return profile.dataset_summary(bindings.bureau(spark, folder))


@query("b02_missing_share", f"SELECT * FROM ({_LONG_MISSING}) WHERE missing_pct >= 30", doubles="missing_pct")
def b02(spark, folder):
    return profile.missing_share(bindings.bureau(spark, folder), 30.0)


def _histogram_sql(c: str, table: str, bins: int = 30) -> str:
    return f"""SELECT '{c}' AS "column", CAST(least(greatest(floor((CAST({c} AS DOUBLE) - lo) * {bins} / (hi - lo)), 0), {bins - 1}) AS BIGINT) AS bin,
      count(*) AS rows FROM {table}, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {table}) GROUP BY 2"""


@query("b03_histogram", _histogram_sql("l_extendedprice", "lineitem") + " UNION ALL " + _histogram_sql("l_quantity", "lineitem"))
def b03(spark, folder):
    return profile.histogram(bindings.table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"])


_FIVE = ", ".join(f"quantile_cont({{c}}, {p}) AS {n}" for n, p in profile.SUMMARY_PROBABILITIES.items())


@query(
    "b04_boxplot",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_FIVE.format(c=c)} FROM lineitem" for c in ("l_extendedprice", "l_discount")),
    doubles="q0 q25 q50 q75 q100",
)
def b04(spark, folder):
    return profile.boxplot(bindings.table(spark, folder, "lineitem"), ["l_extendedprice", "l_discount"])


_GUARDED = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS rows FROM orders GROUP BY {c} HAVING (SELECT count(DISTINCT {c}) FROM orders) <= 10"
    for c in ("o_orderstatus", "o_orderpriority")
)


@query("b05_category_counts", _GUARDED)
def b05(spark, folder):
    rows = bindings.table(spark, folder, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return profile.category_counts(rows, ["o_orderstatus", "o_orderpriority", "day"])


@query("b05_top_categories", "SELECT p_brand, count(*) AS rows FROM part GROUP BY p_brand ORDER BY rows DESC, p_brand LIMIT 10")
def b05_top(spark, folder):
    return profile.top_categories(bindings.table(spark, folder, "part"), "p_brand")


@query(
    "b06_date_parts",
    """SELECT 'year' AS part, CAST(year(l_shipdate) AS VARCHAR) AS value, count(*) AS rows FROM lineitem GROUP BY 2 UNION ALL
    SELECT 'month', CAST(month(l_shipdate) AS VARCHAR), count(*) FROM lineitem GROUP BY 2 UNION ALL
    SELECT 'weekday', dayname(l_shipdate), count(*) FROM lineitem GROUP BY 2""",
)
def b06(spark, folder):
    return profile.date_part_counts(bindings.table(spark, folder, "lineitem"), "l_shipdate")


@query(
    "b07_describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, {_FIVE.format(c=c)} FROM bureau_raw"
        for c in ("MT_MENSAL", "DIVIDAS_CL", "COUNT_TOTAL")
    ),
    doubles="mean std q0 q25 q50 q75 q100",
)
def b07(spark, folder):
    return profile.describe(bindings.bureau(spark, folder), ["MT_MENSAL", "DIVIDAS_CL", "COUNT_TOTAL"])


@query("b08_distinct_values", "SELECT DISTINCT POS FROM loans_raw")
def b08(spark, folder):
    return profile.distinct_values(bindings.loans(spark, folder), "POS")


@query("b09_type_counts", "SELECT * FROM (VALUES ('bigint', 2), ('int', 7), ('double', 3), ('date', 1), ('string', 3)) AS v(type, columns) WHERE EXISTS (SELECT 1 FROM customer)")
def b09(spark, folder):
    """Types of the client aggregates."""
    return profile.type_counts(bindings.client_aggregates(spark, folder).withColumn("clients", F.lit(1).cast("bigint")))


# ------------------------------------------------------------------ cleaning


@query(
    "c01_initial_preparation",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders",
    dates="day",
)
def c01(spark, folder):
    rows = bindings.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"))
    out = clean.initial_preparation(rows, dates=["day", "absent"], remove=["o_orderstatus", "absent"], formats=("dd/MM/yyyy",))
    return out.withColumn("day", F.col("day").cast("date"))


@query(
    "c03_parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""",
    dates="day",
)
def c03(spark, folder):
    """Two text layouts and unreadable text in one column."""
    k = F.col("o_orderkey")
    text = (
        F.when(k % 5 == 0, F.lit("not a date"))
        .when(k % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    rows = bindings.table(spark, folder, "orders").select("o_orderkey", text.alias("day"))
    out = files.parse_dates(rows, ["day"], ("dd/MM/yyyy", "yyyy-MM-dd"))
    return out.withColumn("day", F.col("day").cast("date"))


@query(
    "c04_range_guard",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS l_quantity,
      CASE WHEN l_discount >= 0.02 THEN l_discount END AS l_discount, l_extendedprice FROM lineitem""",
    doubles="l_quantity l_discount l_extendedprice",
)
def c04(spark, folder):
    rows = bindings.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("string").alias("l_quantity"),
        "l_discount", "l_extendedprice",
    )
    return clean.apply_ranges(rows, {"l_quantity": (5, 45), "l_discount": (0.02, None), "absent": (0, 1)})


SEGMENT_MAP = {"household": "home", "machinery": "work", "building": "work"}


@query(
    "c05_category_map",
    """SELECT c_custkey, CASE lower(trim(c_mktsegment)) WHEN 'household' THEN 'home' WHEN 'machinery' THEN 'work'
      WHEN 'building' THEN 'work' END AS c_mktsegment FROM customer""",
)
def c05(spark, folder):
    rows = bindings.table(spark, folder, "customer").select("c_custkey", F.concat(F.lit("  "), "c_mktsegment").alias("c_mktsegment"))
    return clean.apply_category_maps(rows, {"c_mktsegment": SEGMENT_MAP})


@query(
    "l10_cleaning_report",
    """SELECT 'l_quantity' AS "column", 'new_nulls' AS change, count(*) AS cells FROM lineitem WHERE l_quantity > 45 UNION ALL
    SELECT 'l_returnflag', 'relabelled', count(*) FROM lineitem WHERE l_returnflag <> 'N'""",
)
def l10(spark, folder):
    rows = bindings.table(spark, folder, "lineitem")
    return clean.cleaning_report(rows, {"l_quantity": (0, 45)}, {"l_returnflag": {"n": "n", "a": "accepted"}})


@query("c06_c07_loan_columns", "SELECT * FROM (VALUES ('TYPEPROD'), ('MENSALIDADE_CORR')) AS v(\"column\") WHERE EXISTS (SELECT 1 FROM lineitem)")
def c07(spark, folder):
    """Columns the loan cleaner removes: empty or nearly constant."""
    rows = bindings.loans(spark, folder)
    removed = sorted(set(rows.columns) - set(clean.clean_loans(rows).columns))
    return profile.column_types(rows).filter(F.col("column").isin(*removed)).select("column")


@query("c08_sparse_columns", f"SELECT \"column\" FROM ({_LONG_MISSING}) WHERE missing_pct < 30")
def c08(spark, folder):
    kept = clean.drop_sparse_columns(bindings.bureau(spark, folder), 30.0)
    return profile.column_types(kept).select("column")


_FILLED = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in _BUREAU_COLUMNS)


@query("c09_sparse_rows", f"SELECT SEQ_EVENT FROM bureau_raw WHERE {_FILLED} >= 9")
def c09(spark, folder):
    return clean.drop_sparse_rows(bindings.bureau(spark, folder), 0.5).select("SEQ_EVENT")


@query("c10_constant_columns", "SELECT 'TYPECODE' AS \"column\" FROM (SELECT 1 FROM orders LIMIT 1)")
def c10(spark, folder):
    rows = bindings.table(spark, folder, "orders").withColumn("TYPECODE", F.lit(1.0))
    constant = clean.constant_columns(rows, numeric_columns(rows))
    return profile.column_types(rows).filter(F.col("column").isin(*constant)).select("column")


@query("c11_population_masks", """SELECT count(CASE WHEN EVER_SAN = 1 OR EVER_SOL = 1 OR EVER_RBT = 1 THEN 1 END) AS settled,
    count(CASE WHEN HAS_ACTIVE = 1 THEN 1 END) AS active, count(CASE WHEN IS_CHURN = 0 THEN 1 END) AS not_churned FROM clients""")
def c11(spark, folder):
    from stayline.functions import targets

    count = lambda mask: F.count(F.when(mask, 1))
    return stored_abt(spark, folder).agg(
        count(targets.has_history()).alias("settled"),
        count(targets.has_active_contract()).alias("active"),
        count(targets.not_churned()).alias("not_churned"),
    )


@query("c12_null_keeping_inequality", "SELECT CONTRIB, DOSSIER, RISKA, SEQ_LINE, SEQ_PART FROM loans_raw WHERE RISKA IS DISTINCT FROM 7", doubles="RISKA")
def c12(spark, folder):
    return clean.without_value(bindings.loans(spark, folder), "RISKA", 7).select("CONTRIB", "DOSSIER", "RISKA", "SEQ_LINE", "SEQ_PART")


@query("c13_c14_select_columns", "SELECT DIVIDAS_CL, DIVIDAS_CP, DIVIDAS_AUTO, DIVIDAS_HT, SEQ_EVENT FROM bureau_raw", doubles="DIVIDAS_CL DIVIDAS_CP DIVIDAS_AUTO DIVIDAS_HT")
def c14(spark, folder):
    rows = bindings.bureau(spark, folder)
    numeric = rows.select(*numeric_columns(rows))
    return numeric.select(*columns_with_prefix(numeric, "DIVIDAS_"), "SEQ_EVENT")


@query("c15_modelling_columns", "SELECT CONTRIB, MEDIAN_RANGPRO, MEDIAN_RESSO, PRODALP FROM abt", doubles="MEDIAN_RANGPRO MEDIAN_RESSO")
def c15(spark, folder):
    from stayline.plans.columns import modelling_features

    table = stored_abt(spark, folder)
    kept = modelling_features(table, "IS_CHURN")
    return table.select("CONTRIB", *[c for c in ("MEDIAN_RANGPRO", "MEDIAN_RESSO", "PRODALP", "TOTAL_CRD", "N_SAN") if c in kept])


@query("c16_flatten_names", "SELECT l_returnflag, min(l_quantity) AS L_QUANTITY_MIN, max(l_quantity) AS L_QUANTITY_MAX FROM lineitem GROUP BY l_returnflag", doubles="L_QUANTITY_MIN L_QUANTITY_MAX")
def c16(spark, folder):
    rows = bindings.table(spark, folder, "lineitem")
    return rows.groupBy("l_returnflag").agg(F.min("l_quantity").alias("L_QUANTITY_MIN"), F.max("l_quantity").alias("L_QUANTITY_MAX"))


@query("c17_text_search", "SELECT c_custkey FROM customer WHERE contains(lower(c_name), lower('MER#00000001'))")
def c17(spark, folder):
    return bindings.table(spark, folder, "customer").filter(clean.text_contains("c_name", "MER#00000001")).select("c_custkey")


@query("c17_regex_search", "SELECT c_custkey FROM customer WHERE regexp_matches(c_name, '(?i)R#0+[13]5')")
def c17_regex(spark, folder):
    return bindings.table(spark, folder, "customer").filter(clean.text_contains("c_name", "R#0+[13]5", regex=True)).select("c_custkey")


@query("c18_c20_predicates", """SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 50000 AND 150000
    AND o_orderstatus IN ('F', 'O') AND starts_with(o_orderpriority, '1')""")
def c18(spark, folder):
    keep = F.col("o_totalprice").between(50000, 150000) & clean.in_set("o_orderstatus", ["F", "O"]) & F.col("o_orderpriority").startswith("1")
    return bindings.table(spark, folder, "orders").filter(keep).select("o_orderkey")


@query("c21_required_columns", "SELECT SEQ_EVENT FROM bureau_raw WHERE MT_MENSAL IS NOT NULL AND DIVIDAS_CL IS NOT NULL")
def c21(spark, folder):
    return bindings.bureau(spark, folder).na.drop(subset=["MT_MENSAL", "DIVIDAS_CL"]).select("SEQ_EVENT")


@query("i01_split", "SELECT 'late' AS part, count(*) AS rows FROM loans_raw WHERE OBS_DATE < DCREAT UNION ALL SELECT 'ordered', count(*) FROM loans_raw WHERE NOT coalesce(OBS_DATE < DCREAT, FALSE)")
def i01(spark, folder):
    late, ordered = clean.split_rows(bindings.loans(spark, folder), F.col("OBS_DATE") < F.col("DCREAT"))
    count = lambda df, part: df.agg(F.lit(part).alias("part"), F.count("*").alias("rows"))
    return count(late, "late").unionByName(count(ordered, "ordered"))


@query(
    "i02_transpose",
    " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, max(CASE WHEN o_orderstatus = 'F' THEN v END) AS F, max(CASE WHEN o_orderstatus = 'O' THEN v END) AS O,
        max(CASE WHEN o_orderstatus = 'P' THEN v END) AS P FROM (SELECT o_orderstatus, {e} AS v FROM orders GROUP BY o_orderstatus)"""
        for m, e in {"mean_price": "avg(o_totalprice)", "max_price": "max(o_totalprice)"}.items()
    ),
    doubles="F O P",
    places=3,
)
def i02(spark, folder):
    from stayline.operators.segments import transpose_profile

    wide = bindings.table(spark, folder, "orders").groupBy("o_orderstatus").agg(
        F.avg("o_totalprice").alias("mean_price"), F.max("o_totalprice").alias("max_price")
    )
    return transpose_profile(wide, "o_orderstatus", ["F", "O", "P"])


@query("h01_sorted_history", "SELECT CONTRIB, sys_data_procura, ks_score_tier FROM scores_raw ORDER BY CONTRIB, sys_data_procura DESC", dates="sys_data_procura")
def h01(spark, folder):
    return clean.newest_first(bindings.scores(spark, folder), "CONTRIB", "sys_data_procura").select("CONTRIB", "sys_data_procura", "ks_score_tier")


# ------------------------------------------------------------------ missing values

_LOAN_ORDER = "ORDER BY OBS_DATE, SEQ_LINE, SEQ_PART, SEQ_SUPP, SEQ_PRICE"


@query(
    "d01_handle_missing",
    """SELECT CONTRIB, DOSSIER, OBS_DATE, D1FIN, MTFIN, RISKA, RESSO, PRODALP, SEQ_LINE, SEQ_PART FROM loans_filled""",
    doubles="MTFIN RESSO",
    dates="OBS_DATE D1FIN",
)
def d01(spark, folder):
    rows = missing.handle_missing(
        bindings.loans(spark, folder).drop("TYPEPROD", "MENSALIDADE_CORR"), contracts.CONTRACT_KEYS,
        ["OBS_DATE", *bindings.SEQUENCE], date_fill_columns=["D1FIN"],
    )
    return rows.select("CONTRIB", "DOSSIER", "OBS_DATE", "D1FIN", "MTFIN", "RISKA", "RESSO", "PRODALP", "SEQ_LINE", "SEQ_PART")


@query("d01_missing_report", f"""SELECT 'before' AS stage, count(*) AS rows, CAST(sum(18 - ({_FILLED})) AS BIGINT) AS missing_cells FROM bureau_raw UNION ALL
    SELECT 'after', count(*), 0 FROM bureau_raw WHERE {_FILLED} >= 9""")
def d01_report(spark, folder):
    rows = bindings.bureau(spark, folder)
    return missing.missing_report(rows, missing.fill_numeric(clean.drop_sparse_rows(rows)))


@query("d02_fill_numeric", "SELECT SEQ_EVENT, coalesce(MT_MENSAL, -1) AS MT_MENSAL, coalesce(COUNT_CL, -1) AS COUNT_CL FROM bureau_raw", doubles="MT_MENSAL")
def d02(spark, folder):
    return missing.fill_numeric(bindings.bureau(spark, folder), -1.0).select("SEQ_EVENT", "MT_MENSAL", "COUNT_CL")


def _fill_query(name: str, direction: str, sql_function: str, frame: str, keys: list[str]):
    rest = "" if "DOSSIER" in keys else ", DOSSIER"

    @query(
        name,
        f"""SELECT CONTRIB, DOSSIER, SEQ_LINE, SEQ_PART, OBS_DATE, {sql_function}(D1FIN IGNORE NULLS) OVER (
          PARTITION BY {", ".join(keys)} {_LOAN_ORDER}{rest} ROWS BETWEEN {frame}) AS D1FIN FROM loans_raw""",
        dates="OBS_DATE D1FIN",
    )
    def fill(spark, folder):
        order = [c for c in ("OBS_DATE", *bindings.SEQUENCE, "DOSSIER") if c not in keys]
        rows = missing.directional_fill(bindings.loans(spark, folder), ["D1FIN"], keys, order, direction)
        return rows.select("CONTRIB", "DOSSIER", "SEQ_LINE", "SEQ_PART", "OBS_DATE", "D1FIN")


_FORWARD = ("ffill", "last_value", "UNBOUNDED PRECEDING AND CURRENT ROW")
_BACKWARD = ("bfill", "first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING")
_fill_query("d03_forward_fill", *_FORWARD, ["CONTRIB", "DOSSIER"])
_fill_query("d04_backward_fill", *_BACKWARD, ["CONTRIB", "DOSSIER"])
# over all contracts of a client: larger groups, more of which are cut
_fill_query("d03_forward_fill_pieces", *_FORWARD, ["CONTRIB"])
_fill_query("d04_backward_fill_pieces", *_BACKWARD, ["CONTRIB"])


@query("d05_drop_null_dates", "SELECT CONTRIB, DOSSIER, SEQ_LINE, SEQ_PART FROM loans_raw WHERE D1FIN IS NOT NULL")
def d05(spark, folder):
    rows = missing.handle_missing(
        bindings.loans(spark, folder).drop("MENSALIDADE_CORR"), contracts.CONTRACT_KEYS, ["OBS_DATE"], dates="drop", date_fill_columns=["D1FIN"]
    )
    return rows.select("CONTRIB", "DOSSIER", "SEQ_LINE", "SEQ_PART")


@query("d06_fill_text", "SELECT CONTRIB, coalesce(sdem_SITFAM, 'Unknown') AS sdem_SITFAM, coalesce(sdem_HABITAT, 'Unknown') AS sdem_HABITAT FROM fama_raw")
def d06(spark, folder):
    return missing.fill_text(bindings.client_aggregates(spark, folder)).select("CONTRIB", "sdem_SITFAM", "sdem_HABITAT")


@query("d07_prefix_fill", "SELECT SEQ_EVENT, COUNT_CL, MONTVENC_CL, DIVIDAS_CL, MT_MENSAL FROM bureau_clean", doubles="MONTVENC_CL DIVIDAS_CL MT_MENSAL")
def d07(spark, folder):
    rows = missing.fill_prefix(bindings.bureau(spark, folder), *clean.ZERO_MEANS_NONE)
    return rows.select("SEQ_EVENT", "COUNT_CL", "MONTVENC_CL", "DIVIDAS_CL", "MT_MENSAL")


@query("d09_complete_table", "SELECT count(*) AS rows FROM fama")
def d09(spark, folder):
    rows = missing.fill_text(missing.fill_numeric(bindings.client_aggregates(spark, folder)))
    return missing.require_complete(rows).agg(F.count("*").alias("rows"))


# ------------------------------------------------------------------ duplicates and keys


@query("e01_exact_duplicates", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def e01(spark, folder):
    return dedupe.drop_exact(bindings.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("e02_most_complete", "SELECT CONTRIB, DOSSIER, OBS_DATE, D1FIN, MTFIN, CRD, SEQ_LINE, SEQ_PART FROM loans", doubles="MTFIN CRD", dates="OBS_DATE D1FIN")
def e02(spark, folder):
    loans = bindings.loans(spark, folder)
    # ordinary contracts stay where the join put them, as in the base table
    rows = plan.prepared_loans(loans, bindings.SEQUENCE, sizes=contracts.measure_sizes(loans))
    return rows.select("CONTRIB", "DOSSIER", "OBS_DATE", "D1FIN", "MTFIN", "CRD", "SEQ_LINE", "SEQ_PART")


@query("e02_duplicates_report", """SELECT CAST(sum(n) AS BIGINT) AS rows_before, CAST(sum(n - d) AS BIGINT) AS exact_dropped,
    CAST(sum(d - 1) AS BIGINT) AS key_dropped, count(*) AS rows_after FROM (
      SELECT l_orderkey, l_linenumber, sum(c) AS n, count(*) AS d FROM (
        SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS c FROM lineitem GROUP BY ALL) GROUP BY ALL)""")
def e02_report(spark, folder):
    rows = bindings.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return dedupe.duplicates_report(rows, ["l_orderkey", "l_linenumber"])


@query("e03_best_score", "SELECT * FROM score_best", dates="sys_data_procura")
def e03(spark, folder):
    rows = plan.prepared_scores(bindings.scores(spark, folder))
    return dedupe.best_per_key(rows, "CONTRIB", "ks_score_tier", ["sys_data_procura", "kp_sqe_enc"], plan.SCORE_COLUMNS)


@query("e04_key_uniqueness", "SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_keys, count(*) - count(DISTINCT user_id) AS surplus_rows FROM events")
def e04(spark, folder):
    return dedupe.key_uniqueness(bindings.table(spark, folder, "events"), ["user_id"])


@query("e05_duplicate_rows", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)) AS duplicates FROM lineitem")
def e05(spark, folder):
    return profile.duplicate_rows(bindings.table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag"))


# ------------------------------------------------------------------ joins


@query(
    "f01_two_key_join",
    """SELECT l.CONTRIB, l.DOSSIER, l.SEQ_LINE, l.SEQ_PART, b.MT_MENSAL FROM loans_raw l LEFT JOIN (
      SELECT CONTRIB, OBS_DATE + INTEGER '-9000' + CAST(CONTRIB AS INTEGER) AS OBS_DATE, MT_MENSAL FROM bureau) b
    ON l.CONTRIB = b.CONTRIB AND l.OBS_DATE = b.OBS_DATE""",
    doubles="MT_MENSAL",
)
def f01(spark, folder):
    """Bureau days are moved into the loan period so that some rows match."""
    bureau = plan.prepared_bureau(bindings.bureau(spark, folder), ["SEQ_EVENT"])
    moved = bureau.select("CONTRIB", F.date_add("OBS_DATE", (F.col("CONTRIB") - 9000).cast("int")).alias("OBS_DATE"), "MT_MENSAL")
    return joins.left_join(bindings.loans(spark, folder), moved, ["CONTRIB", "OBS_DATE"], "_crc").select(
        "CONTRIB", "DOSSIER", "SEQ_LINE", "SEQ_PART", "MT_MENSAL"
    )


@query(
    "u05_merge_loan_level",
    """SELECT l.CONTRIB, count(*) AS rows, count(s.ks_score_tier) AS scored, count(f.sdem_age) AS aged, count(b.MT_MENSAL) AS bureau
    FROM loans l LEFT JOIN bureau b ON l.CONTRIB = b.CONTRIB AND l.OBS_DATE = b.OBS_DATE
    LEFT JOIN scores s ON l.CONTRIB = s.CONTRIB LEFT JOIN fama f ON l.CONTRIB = f.CONTRIB GROUP BY l.CONTRIB""",
)
def u05(spark, folder):
    tables = plan.prepared_tables(spark, folder)
    tables.pop("sizes")
    return plan.merge_loan_level(**tables, history="all").groupBy("CONTRIB").agg(
        F.count("*").alias("rows"), F.count("ks_score_tier").alias("scored"), F.count("sdem_age").alias("aged"),
        F.count("MT_MENSAL").alias("bureau"),
    )


@query(
    "u05_merge_latest",
    """SELECT l.CONTRIB, l.DOSSIER, l.SEQ_LINE, l.SEQ_PART, l.OBS_DATE, b.MT_MENSAL, s.sys_data_procura, s.ks_score_tier, s.kp_sqe_enc,
      f.Date_Obs, f.sdem_age
    FROM loans l LEFT JOIN bureau b ON l.CONTRIB = b.CONTRIB AND l.OBS_DATE = b.OBS_DATE
    ASOF LEFT JOIN scores s ON l.CONTRIB = s.CONTRIB AND l.OBS_DATE >= s.sys_data_procura
    ASOF LEFT JOIN fama f ON l.CONTRIB = f.CONTRIB AND l.OBS_DATE >= f.Date_Obs""",
    doubles="MT_MENSAL",
    dates="OBS_DATE sys_data_procura Date_Obs",
)
def u05_latest(spark, folder):
    """Observations with the bureau row of their day and the score and client aggregates known by then."""
    tables = plan.prepared_tables(spark, folder)
    tables.pop("sizes")
    return plan.merge_loan_level(**tables).select(
        "CONTRIB", "DOSSIER", "SEQ_LINE", "SEQ_PART", "OBS_DATE", "MT_MENSAL", "sys_data_procura", "ks_score_tier", "kp_sqe_enc", "Date_Obs", "sdem_age"
    )


@query(
    "f03_suffixes",
    "SELECT o_orderkey, o_totalprice, r.mean AS o_totalprice_status FROM orders LEFT JOIN (SELECT o_orderstatus, avg(o_totalprice) AS mean FROM orders GROUP BY 1) r USING (o_orderstatus)",
    doubles="o_totalprice o_totalprice_status",
    places=3,
)
def f03(spark, folder):
    rows = bindings.table(spark, folder, "orders")
    means = rows.groupBy("o_orderstatus").agg(F.avg("o_totalprice").alias("o_totalprice"))
    return joins.left_join(rows, means, ["o_orderstatus"], "_status").select("o_orderkey", "o_totalprice", "o_totalprice_status")


@query("f04_row_preserving", "SELECT count(*) AS base_rows, count(*) AS joined_rows, 1 AS preserved FROM clients")
def f04(spark, folder):
    base = stored_abt(spark, folder).select("CONTRIB", "N_CONTRACTS")
    bureau = contracts.bureau_table(plan.prepared_bureau(bindings.bureau(spark, folder), ["SEQ_EVENT"]))
    return joins.same_row_count(base, joins.left_join_chain(base, {"crc": bureau}, check=True))


@query(
    "f05_coverage",
    """SELECT 'crc' AS source, count(CASE WHEN MT_MENSAL_MAX IS NOT NULL OR COUNT_TOTAL_MAX IS NOT NULL OR DIVIDAS_CL_MAX IS NOT NULL THEN 1 END) AS matched,
      count(CASE WHEN MT_MENSAL_MAX IS NOT NULL OR COUNT_TOTAL_MAX IS NOT NULL OR DIVIDAS_CL_MAX IS NOT NULL THEN 1 END) * 100.0 / count(*) AS coverage_pct FROM abt UNION ALL
    SELECT 'credscore', count(CASE WHEN kp_sqe_enc IS NOT NULL OR ks_score_tier IS NOT NULL THEN 1 END),
      count(CASE WHEN kp_sqe_enc IS NOT NULL OR ks_score_tier IS NOT NULL THEN 1 END) * 100.0 / count(*) FROM abt UNION ALL
    SELECT 'fama', count(CASE WHEN ALLBD_N_Dossiers__N IS NOT NULL OR sdem_age IS NOT NULL THEN 1 END),
      count(CASE WHEN ALLBD_N_Dossiers__N IS NOT NULL OR sdem_age IS NOT NULL THEN 1 END) * 100.0 / count(*) FROM abt""",
    doubles="coverage_pct",
)
def f05(spark, folder):
    return joins.coverage(stored_abt(spark, folder), plan.COVERAGE)


@query("f06_flags_with_default", "SELECT c_custkey, coalesce(urgent, 0) AS urgent FROM customer LEFT JOIN (SELECT o_custkey, 1 AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON c_custkey = o_custkey")
def f06(spark, folder):
    urgent = bindings.table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.lit(1)).alias("urgent"))
    return joins.attach_flags(bindings.table(spark, folder, "customer").select("c_custkey"), urgent, ["c_custkey"], ["urgent"])


@query("f08_target_attach", "SELECT fama.CONTRIB, fama.sdem_age, c.IS_CHURN, c.IS_EARLY_SETTLER FROM fama_raw fama LEFT JOIN clients c ON fama.CONTRIB = c.CONTRIB", doubles="sdem_age IS_CHURN IS_EARLY_SETTLER")
def f08(spark, folder):
    base = bindings.client_aggregates(spark, folder).select("CONTRIB", "sdem_age")
    return joins.attach_columns(base, stored_abt(spark, folder), "CONTRIB", ["IS_CHURN", "IS_EARLY_SETTLER"])


# ------------------------------------------------------------------ cleaners

@query("u01_clean_loans", "SELECT POS, count(*) AS rows, count(D1FIN) AS ends FROM loans_raw GROUP BY POS")
def u01(spark, folder):
    return clean.clean_loans(bindings.loans(spark, folder), protect=["POS", "D1FIN"]).groupBy("POS").agg(F.count("*").alias("rows"), F.count("D1FIN").alias("ends"))


@query("u02_clean_bureau", "SELECT * FROM bureau_clean", doubles="MT_MENSAL MONTVENC_CL MONTVENC_CP MONTVENC_AUTO MONTVENC_HT MONTABATV_CL DIVIDAS_CL DIVIDAS_CP DIVIDAS_AUTO DIVIDAS_HT crc_total_overdue crc_total_debt", dates="OBS_DATE")
def u02(spark, folder):
    return clean.clean_bureau(bindings.bureau(spark, folder))


@query("u03_clean_scores", "SELECT * FROM scores_clean", doubles="kp_sqe_enc", dates="sys_data_procura")
def u03(spark, folder):
    return clean.clean_scores(bindings.scores(spark, folder))


@query("u03_clean_scores_short", "SELECT * REPLACE (CASE WHEN kp_sqe_enc < 8 THEN kp_sqe_enc END AS kp_sqe_enc) FROM scores_clean", doubles="kp_sqe_enc", dates="sys_data_procura")
def u03_short(spark, folder):
    return clean.clean_scores(bindings.scores(spark, folder), letters=8)


@query("u04_clean_client_aggregates", "SELECT CONTRIB, Date_Obs, sdem_age FROM fama_raw ORDER BY CONTRIB", dates="Date_Obs", doubles="sdem_age")
def u04(spark, folder):
    return clean.newest_first(clean.clean_client_aggregates(bindings.client_aggregates(spark, folder)), "CONTRIB", "Date_Obs").select("CONTRIB", "Date_Obs", "sdem_age")


@query("u08_client_cleaner", """SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN c_acctbal END AS c_acctbal,
    CASE lower(c_mktsegment) WHEN 'household' THEN 'home' WHEN 'machinery' THEN 'work' WHEN 'building' THEN 'work' END AS c_mktsegment FROM customer""", doubles="c_acctbal")
def u08(spark, folder):
    from stayline.ml.cleaner import ClientCleaner

    cleaner = ClientCleaner(remove=["c_name", "c_nationkey"], ranges={"c_acctbal": [0, 5000]}, categoryMaps={"c_mktsegment": SEGMENT_MAP})
    return cleaner.transform(bindings.table(spark, folder, "customer"))


