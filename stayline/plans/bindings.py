"""The four source tables as views over the supplied star-schema tables.

Orders stand for contracts, order lines for their dated observations, events
for bureau and score rows, customers for the client aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEQUENCE = ["SEQ_LINE", "SEQ_PART", "SEQ_SUPP", "SEQ_PRICE"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def loans(spark: SparkSession, folder: str) -> DataFrame:
    """Contract observations with a sequence that makes their order unique."""
    line = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", F.col("l_shipdate").cast("date").alias("shipped"),
    )
    order = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("ordered"),
    )
    client = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    # clients join the orders first: the lines, the largest table, are dealt out once and stay by contract
    owned = order.join(client, F.col("o_custkey") == F.col("c_custkey"))
    rows = line.join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
    even = F.col("o_orderkey") % 2 == 0
    status = (
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT") & even, "SAN")
        .when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"), "RBT")
        .when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW") & even, "ENC")
        .otherwise("SOL")
    )
    months = F.col("l_linenumber") * 12
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rows.select(
        F.col("o_custkey").alias("CONTRIB"),
        F.col("o_orderkey").alias("DOSSIER"),
        F.col("shipped").alias("OBS_DATE"),
        status.alias("POS"),
        F.col("ordered").alias("DCREAT"),
        F.date_add("ordered", months * 30).alias("DATFIN"),
        F.when(
            F.col("l_partkey") % 7 != 0, F.date_add("ordered", (F.col("l_suppkey") % 400 - 20).cast("int"))
        ).alias("D1FIN"),
        F.col("shipped").alias("DPOS"),
        months.alias("DURDEG"),
        F.col("l_quantity").cast("int").alias("RANGPRO"),
        (F.col("l_linenumber") % 4).alias("RANGCLI"),
        F.col("o_totalprice").alias("MTFINO"),
        F.when(F.col("l_suppkey") % 7 != 0, net).alias("MTFIN"),
        (F.col("l_extendedprice") / 12).alias("MENSALIDADE"),
        net.alias("CRD"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice") / 10).otherwise(0.0).alias("SREC"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("RN"),
        (F.col("l_quantity") * F.col("l_tax")).alias("RD"),
        F.lpad((F.col("l_partkey") * F.col("l_suppkey")).cast("string"), 24, "0").alias("RISK"),
        F.when(
            F.col("l_linenumber") != 7, F.round(F.col("l_discount") * 100).cast("int") % 8
        ).alias("RISKA"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") + F.col("l_linenumber")).alias("RESSO"),
        (F.col("c_nationkey") % 10 * 10).alias("CSP"),
        (F.col("c_nationkey") % 5).alias("NBENF"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("PRODALP"),
        F.lit("A").alias("TYPEPROD"),
        F.lit(None).cast("double").alias("MENSALIDADE_CORR"),
        F.col("l_linenumber").alias("SEQ_LINE"),
        F.col("l_partkey").alias("SEQ_PART"),
        F.col("l_suppkey").alias("SEQ_SUPP"),
        F.col("l_extendedprice").alias("SEQ_PRICE"),
    )


def bureau(spark: SparkSession, folder: str) -> DataFrame:
    """Credit-bureau rows, one per event; several may fall on one day."""
    rows = table(spark, folder, "events")
    kind = F.col("event_type")
    value = F.col("value")
    units = (F.floor("value") % 5).cast("int")
    of = lambda name, amount: F.when(kind == name, amount)
    return rows.select(
        F.col("user_id").alias("CONTRIB"),
        F.col("ts").cast("date").alias("OBS_DATE"),
        F.when(F.col("event_id") % 7 != 0, value).alias("MT_MENSAL"),
        of("click", units).alias("COUNT_CL"),
        of("view", units).alias("COUNT_CP"),
        of("purchase", units).alias("COUNT_AUTO"),
        of("signup", units).alias("COUNT_HT"),
        (units + 1).alias("COUNT_TOTAL"),
        of("error", value / 10).alias("MONTVENC_CL"),
        of("error", value / 20).alias("MONTVENC_CP"),
        of("error", value / 40).alias("MONTVENC_AUTO"),
        of("error", value / 80).alias("MONTVENC_HT"),
        F.when(value > 90, value / 100).alias("MONTABATV_CL"),
        of("click", value).alias("DIVIDAS_CL"),
        of("view", value).alias("DIVIDAS_CP"),
        of("purchase", value).alias("DIVIDAS_AUTO"),
        of("signup", value).alias("DIVIDAS_HT"),
        F.col("event_id").alias("SEQ_EVENT"),
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Credit-score history: the sign-up events."""
    whole = F.floor("value").cast("int")
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "signup")
        .select(
            F.col("user_id").alias("CONTRIB"),
            F.col("ts").cast("date").alias("sys_data_procura"),
            F.when(F.col("event_id") % 9 != 0, F.char(whole % 26 + 65)).alias("kp_sqe"),
            (whole % 5).alias("ks_score_tier"),
            F.col("event_id").alias("sys_numero_submissao"),
        )
    )


def client_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with contract counts, ages and codes."""
    client = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    rows = client.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    k = F.col("c_custkey")
    family = F.element_at(F.split(F.lit("C D F P S U V X"), " "), (k % 8 + 1).cast("int"))
    housing = F.element_at(F.split(F.lit("A E F L O P X"), " "), F.col("c_nationkey") % 7 + 1)
    return rows.select(
        k.alias("CONTRIB"),
        F.lit("2001-12-31").cast("date").alias("Date_Obs"),
        (k % 9).cast("int").alias("ALLBD_N_Dossiers__N"),
        (k % 3).cast("int").alias("ALLBD_N_CL__N"),
        (k % 2).cast("int").alias("ALLBD_N_CP__N"),
        (k % 4).cast("int").alias("ALLBD_A_CL__N"),
        (k % 5).cast("int").alias("ALLBD_A_CP__N"),
        (k % 6).cast("int").alias("ALLBD_N_events__N"),
        ((k * 7 % 240) - 12).cast("double").alias("ALLBD_IDADE_MEAN__N"),
        (k % 300).cast("double").alias("ALLBD_IDADE_MSA__N"),
        (k % 50).cast("double").alias("ALLBD_IDADE_MIN__N"),
        F.when(k % 13 != 0, (k * 31 % 103 + 16).cast("int")).alias("sdem_age"),
        F.when(k % 11 != 0, family).alias("sdem_SITFAM"),
        F.when(k % 17 != 0, housing).alias("sdem_HABITAT"),
        F.col("r_name").alias("REGION"),
    )
