"""Registration of queries with their DuckDB counterparts, and the shared SQL views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame, places: int, doubles: tuple[str, ...]) -> DataFrame:
    """Output both engines print alike: doubles rounded, dates as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in doubles or isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), places)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, places: int = 6, doubles: str = "", dates: str = ""):
    """Register a query and its statement.

    ``doubles`` and ``dates`` name columns that the statement must round or turn
    into text; the Spark side does so by type.
    """
    double_columns = tuple(doubles.split())

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: comparable(fn(spark, folder), places, double_columns)
        if sql is not None:
            changed = [f"round(CAST({c} AS DOUBLE), {places}) AS {c}" for c in double_columns]
            changed += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates.split()]
            ORACLES[name] = with_views(
                f"SELECT * REPLACE ({', '.join(changed)}) FROM ({sql.strip()}) q" if changed else sql
            )
        return fn

    return register


# ---------------------------------------------------------------- shared SQL views

VIEWS: dict[str, str] = {}

VIEWS["loans_raw"] = """
SELECT o_custkey AS CONTRIB, o_orderkey AS DOSSIER, CAST(l_shipdate AS DATE) AS OBS_DATE,
  CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 0 THEN 'SAN'
       WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'RBT'
       WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0 THEN 'ENC'
       ELSE 'SOL' END AS POS,
  CAST(o_orderdate AS DATE) AS DCREAT,
  CAST(o_orderdate AS DATE) + CAST(l_linenumber * 12 * 30 AS INTEGER) AS DATFIN,
  CASE WHEN l_partkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(l_suppkey % 400 - 20 AS INTEGER) END AS D1FIN,
  CAST(l_shipdate AS DATE) AS DPOS,
  l_linenumber * 12 AS DURDEG, CAST(floor(l_quantity) AS INTEGER) AS RANGPRO, l_linenumber % 4 AS RANGCLI,
  o_totalprice AS MTFINO,
  CASE WHEN l_suppkey % 7 <> 0 THEN l_extendedprice * (1 - l_discount) END AS MTFIN,
  l_extendedprice / 12 AS MENSALIDADE, l_extendedprice * (1 - l_discount) AS CRD,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice / 10 ELSE 0.0 END AS SREC,
  l_extendedprice * l_tax AS RN, l_quantity * l_tax AS RD,
  lpad(CAST(l_partkey * l_suppkey AS VARCHAR), 24, '0') AS RISK,
  CASE WHEN l_linenumber <> 7 THEN CAST(round(l_discount * 100) AS INTEGER) % 8 END AS RISKA,
  CASE WHEN c_acctbal > 0 THEN c_acctbal + l_linenumber END AS RESSO,
  c_nationkey % 10 * 10 AS CSP, c_nationkey % 5 AS NBENF,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS PRODALP,
  'A' AS TYPEPROD, CAST(NULL AS DOUBLE) AS MENSALIDADE_CORR,
  l_linenumber AS SEQ_LINE, l_partkey AS SEQ_PART, l_suppkey AS SEQ_SUPP, l_extendedprice AS SEQ_PRICE
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

VIEWS["loans_filled"] = """
SELECT * EXCLUDE (TYPEPROD, MENSALIDADE_CORR) REPLACE (
  last_value(D1FIN IGNORE NULLS) OVER (PARTITION BY CONTRIB, DOSSIER
    ORDER BY OBS_DATE, SEQ_LINE, SEQ_PART, SEQ_SUPP, SEQ_PRICE
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS D1FIN,
  coalesce(MTFIN, 0) AS MTFIN, coalesce(RISKA, 0) AS RISKA, coalesce(RESSO, 0) AS RESSO,
  coalesce(PRODALP, 'Unknown') AS PRODALP)
FROM loans_raw"""

VIEWS["loans"] = """
SELECT * EXCLUDE (row_no) FROM (
  SELECT *, row_number() OVER (PARTITION BY CONTRIB, DOSSIER, OBS_DATE
    ORDER BY CASE WHEN D1FIN IS NULL THEN 1 ELSE 0 END, SEQ_LINE, SEQ_PART, SEQ_SUPP, SEQ_PRICE,
      POS, DCREAT, DATFIN, D1FIN, DPOS, DURDEG, RANGPRO, RANGCLI, MTFINO, MTFIN, MENSALIDADE, CRD) AS row_no
  FROM loans_filled) WHERE row_no = 1"""

_MODE = """{name} AS (
SELECT {keys}, {c} FROM (
  SELECT {keys}, {c}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {c}) AS row_no
  FROM {source} WHERE {c} IS NOT NULL GROUP BY {keys}, {c}) WHERE row_no = 1)"""

VIEWS["contracts"] = """
SELECT c.*, m.PRODALP FROM (
SELECT CONTRIB, DOSSIER,
  arg_max(CASE WHEN POS = 'ENC' THEN 1 ELSE 0 END, OBS_DATE) AS IS_ACT,
  arg_max(DPOS, OBS_DATE) AS DPOS, arg_max(DCREAT, OBS_DATE) AS DCREAT, arg_max(DATFIN, OBS_DATE) AS DATFIN,
  arg_max(D1FIN, OBS_DATE) FILTER (WHERE D1FIN IS NOT NULL) AS D1FIN,
  arg_max(CRD, OBS_DATE) AS CRD, arg_max(SREC, OBS_DATE) AS SREC, arg_max(RISK, OBS_DATE) AS RISK,
  arg_max(RISKA, OBS_DATE) AS RISKA, arg_max(RESSO, OBS_DATE) AS RESSO, arg_max(CSP, OBS_DATE) AS CSP,
  arg_max(NBENF, OBS_DATE) AS NBENF,
  max(DURDEG) AS DURDEG, max(RANGPRO) AS RANGPRO, max(RANGCLI) AS RANGCLI, max(MTFINO) AS MTFINO,
  max(MTFIN) AS MTFIN, max(RN) AS RN, max(RD) AS RD, median(MENSALIDADE) AS MENSALIDADE,
  min(CASE WHEN POS = 'SOL' THEN OBS_DATE END) AS OBS_DATE_SOL,
  min(CASE WHEN POS = 'SAN' THEN OBS_DATE END) AS OBS_DATE_SAN,
  min(CASE WHEN POS = 'RBT' THEN OBS_DATE END) AS OBS_DATE_RBT,
  CASE WHEN count(CASE WHEN POS = 'SOL' THEN 1 END) > 0 THEN 1 ELSE 0 END AS HAS_SOL,
  CASE WHEN count(CASE WHEN POS = 'SAN' THEN 1 END) > 0 THEN 1 ELSE 0 END AS HAS_SAN,
  CASE WHEN count(CASE WHEN POS = 'RBT' THEN 1 END) > 0 THEN 1 ELSE 0 END AS HAS_RBT
FROM loans GROUP BY CONTRIB, DOSSIER) c LEFT JOIN (
SELECT CONTRIB, DOSSIER, PRODALP FROM (
  SELECT CONTRIB, DOSSIER, PRODALP, row_number() OVER (PARTITION BY CONTRIB, DOSSIER ORDER BY count(*) DESC, PRODALP) AS row_no
  FROM loans GROUP BY CONTRIB, DOSSIER, PRODALP) WHERE row_no = 1) m USING (CONTRIB, DOSSIER)"""

VIEWS["clients_base"] = """
SELECT c.*, m.PRODALP FROM (
SELECT CONTRIB, count(*) AS N_CONTRACTS, max(IS_ACT) AS HAS_ACTIVE,
  min(DCREAT) AS FIRST_DCREAT, max(DCREAT) AS LAST_DCREAT, max(DPOS) AS LAST_DPOS,
  max(DATFIN) AS LAST_DATFIN, min(D1FIN) AS FIRST_D1FIN,
  min(DURDEG) AS MIN_DURDEG, max(DURDEG) AS MAX_DURDEG, CAST(median(DURDEG) AS DOUBLE) AS MEDIAN_DURDEG,
  min(RANGPRO) AS MIN_RANGPRO, max(RANGPRO) AS MAX_RANGPRO, CAST(median(RANGPRO) AS DOUBLE) AS MEDIAN_RANGPRO,
  min(RANGCLI) AS MIN_RANGCLI, max(RANGCLI) AS MAX_RANGCLI, CAST(median(RANGCLI) AS DOUBLE) AS MEDIAN_RANGCLI,
  coalesce(sum(MTFIN), 0) AS TOTAL_MTFIN, coalesce(sum(MTFINO), 0) AS TOTAL_MTFINO,
  coalesce(sum(MENSALIDADE), 0) AS TOTAL_MENSALIDADE, coalesce(sum(CRD), 0) AS TOTAL_CRD,
  coalesce(sum(SREC), 0) AS TOTAL_SREC, coalesce(sum(RN), 0) AS TOTAL_RN, coalesce(sum(RD), 0) AS TOTAL_RD,
  arg_max(RISK, (DCREAT, DOSSIER)) AS LAST_RISK, max(RISKA) AS MAX_RISKA,
  min(RESSO) AS MIN_RESSO, max(RESSO) AS MAX_RESSO, median(RESSO) AS MEDIAN_RESSO,
  arg_max(CSP, (DCREAT, DOSSIER)) AS CSP, arg_max(NBENF, (DCREAT, DOSSIER)) AS NBENF,
  max(HAS_SOL) AS EVER_SOL, CAST(sum(HAS_SOL) AS BIGINT) AS N_SOL,
  max(HAS_SAN) AS EVER_SAN, CAST(sum(HAS_SAN) AS BIGINT) AS N_SAN,
  max(HAS_RBT) AS EVER_RBT, CAST(sum(HAS_RBT) AS BIGINT) AS N_RBT,
  max(OBS_DATE_SOL) AS LAST_OBS_DATE_SOL, max(OBS_DATE_SAN) AS LAST_OBS_DATE_SAN,
  max(OBS_DATE_RBT) AS LAST_OBS_DATE_RBT
FROM contracts GROUP BY CONTRIB) c LEFT JOIN (
SELECT CONTRIB, PRODALP FROM (
  SELECT CONTRIB, PRODALP, row_number() OVER (PARTITION BY CONTRIB ORDER BY count(*) DESC, PRODALP) AS row_no
  FROM contracts WHERE PRODALP IS NOT NULL GROUP BY CONTRIB, PRODALP) WHERE row_no = 1) m USING (CONTRIB)"""

_LAST_END = "greatest(LAST_OBS_DATE_SOL, LAST_OBS_DATE_SAN, LAST_OBS_DATE_RBT)"
VIEWS["clients"] = f"""
SELECT *,
  CASE WHEN EVER_SAN = 1 OR EVER_RBT = 1 THEN 1 ELSE 0 END AS IS_EARLY_SETTLER,
  CASE WHEN greatest(EVER_SOL, EVER_SAN, EVER_RBT) = 1 AND HAS_ACTIVE <> 1
    AND (LAST_DCREAT <= {_LAST_END} OR LAST_DCREAT - {_LAST_END} > 30) THEN 1 ELSE 0 END AS IS_CHURN,
  CAST(CASE WHEN {_LAST_END} IS NOT NULL THEN greatest({_LAST_END} - LAST_DCREAT, 0) END AS INTEGER) AS TIME_TO_CHURN_D
FROM clients_base"""

VIEWS["bureau_raw"] = """
SELECT user_id AS CONTRIB, CAST(ts AS DATE) AS OBS_DATE,
  CASE WHEN event_id % 7 <> 0 THEN value END AS MT_MENSAL,
  CASE WHEN event_type = 'click' THEN CAST(floor(value) AS INTEGER) % 5 END AS COUNT_CL,
  CASE WHEN event_type = 'view' THEN CAST(floor(value) AS INTEGER) % 5 END AS COUNT_CP,
  CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS INTEGER) % 5 END AS COUNT_AUTO,
  CASE WHEN event_type = 'signup' THEN CAST(floor(value) AS INTEGER) % 5 END AS COUNT_HT,
  CAST(floor(value) AS INTEGER) % 5 + 1 AS COUNT_TOTAL,
  CASE WHEN event_type = 'error' THEN value / 10 END AS MONTVENC_CL,
  CASE WHEN event_type = 'error' THEN value / 20 END AS MONTVENC_CP,
  CASE WHEN event_type = 'error' THEN value / 40 END AS MONTVENC_AUTO,
  CASE WHEN event_type = 'error' THEN value / 80 END AS MONTVENC_HT,
  CASE WHEN value > 90 THEN value / 100 END AS MONTABATV_CL,
  CASE WHEN event_type = 'click' THEN value END AS DIVIDAS_CL,
  CASE WHEN event_type = 'view' THEN value END AS DIVIDAS_CP,
  CASE WHEN event_type = 'purchase' THEN value END AS DIVIDAS_AUTO,
  CASE WHEN event_type = 'signup' THEN value END AS DIVIDAS_HT,
  event_id AS SEQ_EVENT
FROM events"""

_ZERO = (
    "COUNT_CL COUNT_CP COUNT_AUTO COUNT_HT COUNT_TOTAL MONTVENC_CL MONTVENC_CP MONTVENC_AUTO MONTVENC_HT "
    "MONTABATV_CL DIVIDAS_CL DIVIDAS_CP DIVIDAS_AUTO DIVIDAS_HT"
).split()
VIEWS["bureau_clean"] = f"""
SELECT *, MONTVENC_CL + MONTVENC_CP + MONTVENC_AUTO + MONTVENC_HT AS crc_total_overdue,
  DIVIDAS_CL + DIVIDAS_CP + DIVIDAS_AUTO + DIVIDAS_HT AS crc_total_debt
FROM (SELECT * REPLACE ({", ".join(f"coalesce({c}, 0) AS {c}" for c in _ZERO)}) FROM bureau_raw)"""

VIEWS["bureau"] = """
SELECT * EXCLUDE (row_no) FROM (
  SELECT * REPLACE (coalesce(MT_MENSAL, 0) AS MT_MENSAL),
    row_number() OVER (PARTITION BY CONTRIB, OBS_DATE ORDER BY SEQ_EVENT) AS row_no
  FROM bureau_clean) WHERE row_no = 1"""

_BUREAU = (
    "MT_MENSAL COUNT_CL COUNT_AUTO COUNT_TOTAL MONTVENC_CL MONTVENC_CP MONTVENC_AUTO MONTVENC_HT "
    "DIVIDAS_CL DIVIDAS_CP DIVIDAS_AUTO DIVIDAS_HT"
).split()
VIEWS["bureau_client"] = "SELECT CONTRIB, " + ", ".join(
    f"min({c}) AS {c}_MIN, max({c}) AS {c}_MAX, CAST(median({c}) AS DOUBLE) AS {c}_MEDIAN" for c in _BUREAU
) + " FROM bureau GROUP BY CONTRIB"

VIEWS["scores_raw"] = """
SELECT user_id AS CONTRIB, CAST(ts AS DATE) AS sys_data_procura,
  CASE WHEN event_id % 9 <> 0 THEN chr(CAST(floor(value) AS INTEGER) % 26 + 65) END AS kp_sqe,
  CAST(floor(value) AS INTEGER) % 5 AS ks_score_tier, event_id AS sys_numero_submissao
FROM events WHERE event_type = 'signup'"""

VIEWS["scores_clean"] = """
SELECT CONTRIB, sys_data_procura, ks_score_tier,
  CASE WHEN ascii(kp_sqe) - 65 BETWEEN 0 AND 23 THEN ascii(kp_sqe) - 65 END AS kp_sqe_enc
FROM scores_raw"""

VIEWS["scores"] = """
SELECT CONTRIB, sys_data_procura, ks_score_tier, kp_sqe_enc FROM (
  SELECT *, row_number() OVER (PARTITION BY CONTRIB, sys_data_procura ORDER BY ks_score_tier, kp_sqe_enc) AS row_no
  FROM (SELECT * REPLACE (coalesce(kp_sqe_enc, 0) AS kp_sqe_enc) FROM scores_clean)) WHERE row_no = 1"""

VIEWS["score_best"] = """
SELECT CONTRIB, sys_data_procura, kp_sqe_enc, ks_score_tier FROM (
  SELECT *, row_number() OVER (PARTITION BY CONTRIB
    ORDER BY ks_score_tier DESC, sys_data_procura DESC, kp_sqe_enc DESC) AS row_no FROM scores) WHERE row_no = 1"""

VIEWS["fama_raw"] = """
SELECT c_custkey AS CONTRIB, DATE '2001-12-31' AS Date_Obs,
  CAST(c_custkey % 9 AS INTEGER) AS ALLBD_N_Dossiers__N, CAST(c_custkey % 3 AS INTEGER) AS ALLBD_N_CL__N,
  CAST(c_custkey % 2 AS INTEGER) AS ALLBD_N_CP__N, CAST(c_custkey % 4 AS INTEGER) AS ALLBD_A_CL__N,
  CAST(c_custkey % 5 AS INTEGER) AS ALLBD_A_CP__N, CAST(c_custkey % 6 AS INTEGER) AS ALLBD_N_events__N,
  CAST(c_custkey * 7 % 240 - 12 AS DOUBLE) AS ALLBD_IDADE_MEAN__N,
  CAST(c_custkey % 300 AS DOUBLE) AS ALLBD_IDADE_MSA__N, CAST(c_custkey % 50 AS DOUBLE) AS ALLBD_IDADE_MIN__N,
  CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey * 31 % 103 + 16 AS INTEGER) END AS sdem_age,
  CASE WHEN c_custkey % 11 <> 0 THEN substr('CDFPSUVX', CAST(c_custkey % 8 + 1 AS INTEGER), 1) END AS sdem_SITFAM,
  CASE WHEN c_custkey % 17 <> 0 THEN substr('AEFLOPX', c_nationkey % 7 + 1, 1) END AS sdem_HABITAT,
  r_name AS REGION
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

VIEWS["fama"] = """
SELECT * REPLACE (coalesce(sdem_age, 0) AS sdem_age, coalesce(sdem_SITFAM, 'Unknown') AS sdem_SITFAM,
  coalesce(sdem_HABITAT, 'Unknown') AS sdem_HABITAT) FROM fama_raw"""

VIEWS["abt"] = """
SELECT clients.*, bureau_client.* EXCLUDE (CONTRIB), score_best.* EXCLUDE (CONTRIB),
  fama.ALLBD_N_Dossiers__N, fama.ALLBD_A_CL__N, fama.ALLBD_A_CP__N, fama.ALLBD_IDADE_MEAN__N,
  fama.ALLBD_N_events__N, fama.sdem_SITFAM, fama.sdem_HABITAT, fama.sdem_age
FROM clients LEFT JOIN bureau_client USING (CONTRIB) LEFT JOIN score_best USING (CONTRIB)
LEFT JOIN fama USING (CONTRIB)"""


def _needed(sql: str, found: list[str]) -> list[str]:
    import re

    for name in VIEWS:
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            _needed(VIEWS[name], found)
            if name not in found:
                found.append(name)
    return found


def with_views(sql: str) -> str:
    """Prefix the shared views a statement reads from."""
    sql = sql.strip()
    views = [f"{n} AS MATERIALIZED ({VIEWS[n].strip()})" for n in _needed(sql, [])]
    if not views:
        return sql
    if sql[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(views) + ",\n" + sql[5:]
    return "WITH " + ",\n".join(views) + "\n" + sql
