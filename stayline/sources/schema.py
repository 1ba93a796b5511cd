"""Schemas of the four source tables and schema-time column selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.NumericType,)
TEXT = (T.StringType, T.CharType, T.VarcharType)
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _of(df: DataFrame, kinds: tuple) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame, exclude: tuple | list = ()) -> list[str]:
    return [c for c in _of(df, NUMERIC) if c not in exclude]


def text_columns(df: DataFrame, exclude: tuple | list = ()) -> list[str]:
    return [c for c in _of(df, TEXT) if c not in exclude]


def date_columns(df: DataFrame) -> list[str]:
    return _of(df, DATES)


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def present(df: DataFrame, columns) -> list[str]:
    """The listed columns that exist, in list order."""
    return [c for c in columns if c in df.columns]


def nan_free(df: DataFrame) -> DataFrame:
    """NaN and null are one thing downstream: null."""
    floats = _of(df, (T.DoubleType, T.FloatType))
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def _struct(**groups: str) -> T.StructType:
    kinds = {
        "text": T.StringType(),
        "whole": T.IntegerType(),
        "amount": T.DoubleType(),
        "day": T.DateType(),
    }
    fields = []
    for kind, names in groups.items():
        fields += [T.StructField(n, kinds[kind.rstrip("_2")]) for n in names.split()]
    return T.StructType(fields)


LOANS = _struct(
    text="CONTRIB DOSSIER POS RISK PRODALP PTT TYPEPROD",
    day="OBS_DATE DCREAT DATFIN D1FIN DPOS DCSP",
    whole="DURDEG RANGPRO RANGCLI RISKA CSP NBENF",
    amount="MTFINO MTFIN MENSALIDADE CRD SREC RN RD RESSO",
)
BUREAU = _struct(
    text="CONTRIB",
    day="OBS_DATE",
    whole="COUNT_CL COUNT_CP COUNT_AUTO COUNT_HT COUNT_CONEXO COUNT_OTHER COUNT_TOTAL",
    amount="MT_MENSAL MONTVENC_CL MONTVENC_CP MONTVENC_AUTO MONTVENC_HT "
    "MONTABATV_CL MONTABATV_CP MONTABATV_AUTO MONTABATV_HT "
    "DIVIDAS_CL DIVIDAS_CP DIVIDAS_AUTO DIVIDAS_HT",
)
SCORES = _struct(text="CONTRIB kp_sqe sys_numero_submissao", day="sys_data_procura", whole="ks_score_tier")
CLIENTS = _struct(
    text="CONTRIB sdem_SITFAM sdem_HABITAT",
    day="Date_Obs",
    whole="ALLBD_N_Dossiers__N ALLBD_N_CL__N ALLBD_N_CP__N ALLBD_A_CL__N ALLBD_A_CP__N "
    "ALLBD_N_events__N sdem_age",
    amount="ALLBD_IDADE_MEAN__N ALLBD_IDADE_MSA__N ALLBD_IDADE_MIN__N",
)
