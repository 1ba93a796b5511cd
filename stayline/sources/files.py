"""Reading and writing tables."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.sources import schema as schemas
from stayline.sources.schema import nan_free

FORMATS = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}
INT64_MIN, INT64_MAX = -(2**63), 2**63 - 1


def format_of(path: str) -> str:
    extension = PurePosixPath(path).suffix.lower()
    if extension not in FORMATS:
        raise ValueError(f"unsupported file format {extension!r}; use .csv or .parquet")
    return FORMATS[extension]


def parse_dates(df: DataFrame, columns, formats: tuple[str, ...] = ()) -> DataFrame:
    """Dates from text; unreadable text becomes null. Absent columns are skipped."""
    known = {f.name: f.dataType for f in df.schema.fields}
    parsed = {}
    for c in columns or ():
        if c not in known:
            continue
        if isinstance(known[c], schemas.DATES):
            parsed[c] = F.col(c)
        elif formats:
            parsed[c] = F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])
        else:
            parsed[c] = F.col(c).try_cast("timestamp")
    return df.withColumns(parsed) if parsed else df


def load(
    spark: SparkSession, path: str, schema: T.StructType | None = None, dates: tuple[str, ...] = ()
) -> DataFrame:
    """CSV or parquet by extension. A schema avoids a pass over the data to infer one."""
    kind = format_of(path)
    reader = spark.read
    if kind == "csv":
        reader = reader.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return parse_dates(nan_free(reader.format(kind).load(path)), dates)


@dataclass(frozen=True)
class Source:
    """A named table: where it lies, its schema and its date columns."""

    file: str
    schema: T.StructType
    dates: tuple[str, ...] = ()


@dataclass
class SourceRegistry:
    """Loaders by table name under one root folder."""

    root: str
    sources: dict[str, Source] = field(
        default_factory=lambda: {
            "bdoss": Source("bdoss.csv", schemas.LOANS, ("OBS_DATE", "DCREAT", "DATFIN", "D1FIN", "DPOS")),
            "crc": Source("crc.csv", schemas.BUREAU, ("OBS_DATE",)),
            "credscore": Source("credscore.csv", schemas.SCORES, ("sys_data_procura",)),
            "fama": Source("fama.csv", schemas.CLIENTS, ("Date_Obs",)),
        }
    )

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        source = self.sources[name]
        path = os.path.join(self.root, source.file)
        return load(spark, path, source.schema if format_of(path) == "csv" else None, source.dates)


def narrow_wide_integers(df: DataFrame) -> DataFrame:
    """Decimal(38,0) columns whose values leave the 64-bit range become double."""
    wide = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0 and f.dataType.precision > 18
    ]
    if not wide:
        return df
    limits = df.agg(
        *[F.min(c).alias(f"lo_{c}") for c in wide], *[F.max(c).alias(f"hi_{c}") for c in wide]
    ).first()
    over = [
        c
        for c in wide
        if limits[f"hi_{c}"] is not None
        and (limits[f"hi_{c}"] > INT64_MAX or limits[f"lo_{c}"] < INT64_MIN)
    ]
    return df.withColumns({c: F.col(c).cast("double") for c in over}) if over else df


def save(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    kind = format_of(path)
    if kind == "parquet":
        df = narrow_wide_integers(df)
    writer = df.write.mode(mode).format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def parquet_to_csv(spark: SparkSession, source: str, target: str) -> None:
    save(spark.read.parquet(source), target)


def save_and_verify(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write, read back and compare rows and columns; returns the table as read.

    Rows are counted while they are written, so the table is built once.
    """
    written = Observation()
    save(df.observe(written, F.count(F.lit(1)).alias("rows")), path, mode)
    rows = written.get["rows"]
    back = load(df.sparkSession, path, df.schema if format_of(path) == "csv" else None)
    found = back.count()
    if found != rows or back.columns != df.columns:
        raise ValueError(f"{path}: wrote {rows} rows x {len(df.columns)}, read {found} x {len(back.columns)}")
    return back


def attach_scores(table: DataFrame, scores: DataFrame, key: str = "CONTRIB") -> DataFrame:
    """Replace the score columns of ``table`` by those of ``scores``; unscored rows get null."""
    columns = [c for c in scores.columns if c != key]
    return table.drop(*columns).join(scores, key, "left")


def next_version(spark: SparkSession, root: str, name: str) -> tuple[str | None, str]:
    """Latest written version of a table under ``root`` and the path for the next one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    versions = []
    if fs.exists(path):
        for status in fs.listStatus(path):
            stem = status.getPath().getName()
            number = stem.removeprefix(f"{name}.v").removesuffix(".parquet")
            done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if stem.startswith(f"{name}.v") and number.isdigit() and fs.exists(done):
                versions.append(int(number))
    latest = max(versions, default=0)
    at = lambda n: os.path.join(root, f"{name}.v{n}.parquet")
    return (at(latest) if latest else None), at(latest + 1)


def upsert_scores(
    spark: SparkSession, root: str, name: str, base: DataFrame, scores: DataFrame, key: str = "CONTRIB"
) -> str:
    """Add scores to the newest version of a table (or to ``base``) as a new version.

    A table cannot be overwritten while it is read, so every step writes a new
    version; a reader takes the newest finished one.
    """
    current, target = next_version(spark, root, name)
    table = spark.read.parquet(current) if current else base
    save(attach_scores(table, scores, key), target)
    return target


def save_split(df: DataFrame, rejected, path: str) -> DataFrame:
    """Write the rows that match ``rejected`` and return the others."""
    mask = F.coalesce(rejected, F.lit(False))
    save(df.filter(mask), path)
    return df.filter(~mask)
