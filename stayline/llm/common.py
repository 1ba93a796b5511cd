"""Helpers the training-data operators share."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Hashable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.session import shared_dir

#: A word is a run of anything but ASCII white space.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE_CLASS}]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """``df`` as one struct column ``row`` beside working columns.

    Names of working columns therefore never clash with columns of the input.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    return df.select(whole, *[c.alias(k) for k, c in named.items()])


def with_row(df: DataFrame, **types: str) -> T.StructType:
    """Schema of the packed ``row`` of ``df`` followed by further columns."""
    schema = T.StructType([df.schema["row"]])
    for name, kind in types.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))
    return schema


def unpacked(df: DataFrame, *more: Column) -> DataFrame:
    return df.select("row.*", *more)


def text_of(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def new_folder(spark: SparkSession, what: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/stayline-{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there: lineage ends here."""
    path = new_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``keys``, as many as shuffles have partitions.

    Joins on the keys read it without an exchange. Rows that are already dealt
    out by the keys are written where they are. The table's name is only needed
    to read it once.
    """
    spark = df.sparkSession
    name = f"stayline_{what}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", new_folder(spark, what)).option("compression", "zstd")
    writer.bucketBy(partitions(spark), *keys).saveAsTable(name)
    found = spark.table(name)
    found.schema  # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return found


def text_key(c: Column) -> list[Column]:
    """Two 64-bit hashes that name a text: equal texts, equal keys."""
    return [F.xxhash64(c).alias("k1"), F.xxhash64(F.lit("second"), c).alias("k2")]


def per_process(key: Hashable, make: Callable):
    """One object per worker process, kept between tasks.

    Functions reach workers by value, with new globals for each task, so the
    object is kept by a module of its own.
    """
    kept = sys.modules.setdefault("stayline_process", types.ModuleType("stayline_process")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
