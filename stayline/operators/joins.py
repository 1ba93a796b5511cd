"""Left equi-joins that keep the base rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.clean import sentinel
from stayline.operators.dedupe import require_unique
from stayline.operators.missing import directional_fill
from stayline.operators.quantiles import largest_group
from stayline.sources.schema import present

#: Rows of ``right`` per key up to which a latest join looks them up in one array of the key.
LATEST_LIMIT = 1_000


def suffix_overlap(right: DataFrame, left_columns: list[str], keys: list[str], suffix: str) -> DataFrame:
    """Rename right columns that also exist on the left."""
    clash = {c: f"{c}{suffix}" for c in right.columns if c in left_columns and c not in keys}
    return right.withColumnsRenamed(clash)


def left_join(left: DataFrame, right: DataFrame, keys: list[str], suffix: str = "_right") -> DataFrame:
    return left.join(suffix_overlap(right, left.columns, keys, suffix), keys, "left")


def latest_join(left: DataFrame, right: DataFrame, keys: list[str], time: str, right_time: str, suffix: str = "_right", limit: int = LATEST_LIMIT) -> DataFrame:
    """Every row of ``left`` with the newest row of ``right`` of the same keys at or before its ``time``.

    Where every key of ``right`` has few rows, they are joined as one array of the
    key. Otherwise both tables are put in one order and the last row of ``right`` is
    carried forward, so a key with very many rows on both sides makes no product of
    them and is cut into pieces like any other. Both ways give the same rows. Of several rows of ``right`` at one
    time the largest counts. Rows without a key or time match nothing.
    """
    other = suffix_overlap(right.na.drop(subset=[*keys, right_time]), left.columns, keys, suffix)
    when = f"{right_time}{suffix}" if right_time in left.columns and right_time not in keys else right_time
    values = F.struct(F.col(when), *[F.col(f"`{c}`") for c in other.columns if c not in keys and c != when])
    newest = other.groupBy(*keys, F.col(when).alias("_time")).agg(F.max(values).alias("_other"))
    added = [c for c in other.columns if c not in keys]
    if largest_group(newest, keys) <= limit:
        history = newest.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_time", "_other"))).alias("_history"))
        known = F.filter("_history", lambda x: x["_time"] <= F.col(f"`{time}`"))
        found = left.join(history, keys, "left").withColumn("_other", F.get(known, F.size(known) - 1)["_other"])
        return found.select(*[f"`{c}`" for c in left.columns], *[F.col("_other")[c].alias(c) for c in added])
    own = left.select(*keys, F.col(time).alias("_time"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_own"))
    both = own.withColumn("_kind", F.lit(1)).unionByName(newest.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    carried = directional_fill(both, ["_other"], keys, ["_time", "_kind"])
    return carried.filter("_kind = 1").select("_own.*", *[F.col("_other")[c].alias(c) for c in added])


def left_join_chain(base: DataFrame, others: dict[str, DataFrame], key: str = "CONTRIB", check: bool = False) -> DataFrame:
    """Join client-grain tables in turn; ``check`` asserts that each key is unique first."""
    out = base
    for name, other in others.items():
        out = left_join(out, require_unique(other, [key]) if check else other, [key], f"_{name}")
    return out


def attach_flags(base: DataFrame, flags: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Left join with 0 for rows without a match."""
    return base.join(flags, keys, "left").na.fill(0, columns)


def attach_columns(base: DataFrame, other: DataFrame, key: str, columns: list[str], suffix: str = "_abt") -> DataFrame:
    """Left join of a few columns of a wide table."""
    return left_join(base, other.select(key, *present(other, columns)), [key], suffix)


def same_row_count(before: DataFrame, after: DataFrame) -> DataFrame:
    left = before.agg(F.count("*").alias("base_rows"), F.lit(0).cast("long").alias("joined_rows"))
    right = after.agg(F.lit(0).cast("long").alias("base_rows"), F.count("*").alias("joined_rows"))
    counts = left.unionByName(right).agg(*[F.max(c).alias(c) for c in ("base_rows", "joined_rows")])
    return counts.withColumn("preserved", (F.col("base_rows") == F.col("joined_rows")).cast("int"))


def coverage(df: DataFrame, sources: dict[str, list[str]]) -> DataFrame:
    """Matched rows and percentage per joined source, from its sentinel columns."""
    found = {name: present(df, cols) for name, cols in sources.items()}
    row = df.agg(
        F.count("*").alias("rows"), *[F.sum(sentinel(cols)).alias(f"m__{n}") for n, cols in found.items()]
    )
    entries = [F.struct(F.lit(n).alias("source"), F.col(f"m__{n}").alias("matched")) for n in found]
    return row.select("rows", F.explode(F.array(*entries)).alias("x")).select(
        "x.source", "x.matched", F.try_divide(F.col("x.matched") * 100.0, F.col("rows")).alias("coverage_pct")
    )
