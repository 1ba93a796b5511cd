"""Cleaning projections and column or row removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.columns import differs, flag, row_sum
from stayline.functions.features import SCORE_LETTERS, score_ordinal
from stayline.functions.labels import lookup
from stayline.operators.profile import columns_missing
from stayline.sources.files import parse_dates
from stayline.sources.schema import columns_with_prefix, present

#: Values per column that the heavy-hitter sketch reports at most.
CANDIDATES = 4
NEAR_CONSTANT_SHARE = 0.98
#: Columns above which a test of all of them is not put into one generated method.
WIDE_COLUMNS = 40
LOAN_DATES = ("OBS_DATE", "DCREAT", "DATFIN", "D1FIN", "DPOS", "DCSP")
ZERO_MEANS_NONE = ("COUNT_", "MONTVENC_", "MONTABATV_", "DIVIDAS_")


def drop_columns(df: DataFrame, columns) -> DataFrame:
    return df.drop(*(columns or ()))


def initial_preparation(
    df: DataFrame, dates=(), remove=(), formats: tuple[str, ...] = ()
) -> DataFrame:
    return drop_columns(parse_dates(df, dates, formats), remove)


def in_range(c: Column | str, low: float | None, high: float | None) -> Column:
    """Number when inside the range, null when outside or not a number."""
    value = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    outside = F.lit(False)
    if low is not None:
        outside = outside | (value < low)
    if high is not None:
        outside = outside | (value > high)
    return F.when(~outside, value)


def canonical(c: Column | str, mapping: dict[str, str]) -> Column:
    """Canonical label for trimmed lower-case text, null when unlisted."""
    return lookup(F.lower(F.trim(F.col(c) if isinstance(c, str) else c)), mapping)


def apply_ranges(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    return df.withColumns({c: in_range(c, *r) for c, r in ranges.items() if c in df.columns})


def apply_category_maps(df: DataFrame, maps: dict[str, dict]) -> DataFrame:
    return df.withColumns({c: canonical(c, m) for c, m in maps.items() if c in df.columns})


def cleaning_report(df: DataFrame, ranges: dict[str, tuple] | None = None, maps: dict | None = None) -> DataFrame:
    """What range guards and category maps change, counted in one pass."""
    changes = {}
    for c, r in (ranges or {}).items():
        if c in df.columns:
            changes[c, "new_nulls"] = F.col(c).isNotNull() & in_range(c, *r).isNull()
    for c, m in (maps or {}).items():
        if c in df.columns:
            plain = F.lower(F.trim(F.col(c)))
            changes[c, "relabelled"] = ~canonical(c, m).eqNullSafe(plain) | plain.isNull()
    names = list(changes)
    row = df.agg(*[F.count(F.when(p, 1)).alias(f"n{i}") for i, p in enumerate(changes.values())])
    return row.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.lit(k).alias("change"), F.col(f"n{i}").alias("cells"))
                    for i, (c, k) in enumerate(names)
                ]
            )
        ).alias("x")
    ).select("x.*")


def empty_columns(df: DataFrame) -> list[str]:
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if counts[c] == 0]


def dominant_values(df: DataFrame, columns: list[str] | None = None, floor: float = 0.5) -> DataFrame:
    """Most frequent non-null value of each column where it covers at least ``floor`` of the filled rows.

    A value with a share of one half or more is always among the candidates of
    the heavy-hitter sketch, whose counts are never too low. Where the candidates
    are fewer than the sketch reports at most and account for every filled row,
    the counts are exact already; only for other columns with a promising candidate
    a second pass counts it. No column is
    spread over the cluster by value. Columns without such a value read 0 rows.
    """
    if floor < 0.5:
        raise ValueError("dominant values are exact from a share of one half upwards")
    columns = columns or df.columns
    texts = {c: F.col(c).cast("string") for c in columns}
    found = df.agg(
        F.count("*").alias("rows"),
        *[F.count(c).alias(f"filled__{c}") for c in columns],
        *[F.call_function("approx_top_k", t, F.lit(CANDIDATES), F.lit(1024)).alias(f"top__{c}") for c, t in texts.items()],
    ).first()
    filled = {c: found[f"filled__{c}"] for c in columns}
    candidates = {
        c: {x["item"]: x["count"] for x in (found[f"top__{c}"] or []) if x["item"] is not None} for c in columns
    }
    open_columns = [
        c
        for c, items in candidates.items()
        if (len(items) == CANDIDATES or sum(items.values()) != filled[c]) and max(items.values(), default=0) >= floor * filled[c] > 0
    ]
    if open_columns:
        counted = df.agg(
            *[
                F.count(F.when(texts[c] == v, 1)).alias(f"{i}__{c}")
                for c in open_columns
                for i, v in enumerate(candidates[c])
            ]
        ).first()
        for c in open_columns:
            candidates[c] = {v: counted[f"{i}__{c}"] for i, v in enumerate(candidates[c])}
    rows = []
    for c, items in candidates.items():
        value, count = max(items.items(), key=lambda x: x[1], default=(None, 0))
        if not items or count < floor * filled[c]:
            value, count = None, 0
        rows.append((c, value, count, filled[c], found["rows"]))
    return df.sparkSession.createDataFrame(
        rows, "column string, top_value string, top_rows long, filled_rows long, rows long"
    )


def near_constant_columns(
    df: DataFrame, share: float = NEAR_CONSTANT_SHARE, columns: list[str] | None = None
) -> list[str]:
    """Columns where one value (null counts as a value) covers at least ``share`` of the rows.

    An empty column is one of them.
    """
    columns = df.columns if columns is None else columns
    if not columns:
        return []
    if share < 0.5:
        raise ValueError("the share must be one half or more")
    top = F.greatest(F.col("top_rows"), F.col("rows") - F.col("filled_rows"))
    hits = dominant_values(df, columns).filter(top >= F.col("rows") * share).select("column").collect()
    names = {r["column"] for r in hits}
    return [c for c in columns if c in names]


def drop_empty_columns(df: DataFrame, protect=()) -> DataFrame:
    return df.drop(*[c for c in empty_columns(df) if c not in protect])


def drop_near_constant(df: DataFrame, share: float = NEAR_CONSTANT_SHARE, protect=()) -> DataFrame:
    return df.drop(*near_constant_columns(df, share, [c for c in df.columns if c not in protect]))


def drop_sparse_columns(df: DataFrame, threshold: float = 30.0) -> DataFrame:
    return df.drop(*columns_missing(df, threshold))


def drop_sparse_rows(df: DataFrame, max_missing: float = 0.5) -> DataFrame:
    """Keep rows with enough filled columns.

    Columns that cannot be null count as filled without being tested: a short
    condition keeps the optimizer's constraint inference cheap on wide tables.
    There the filled ones are counted in an array, since one test of so many
    columns makes a generated method too long for the JVM to compile.
    """
    nullable = [f.name for f in df.schema.fields if f.nullable]
    needed = int(len(df.columns) * (1 - max_missing)) - (len(df.columns) - len(nullable))
    if needed <= 0:
        return df
    if len(nullable) <= WIDE_COLUMNS:
        return df.na.drop(thresh=needed, subset=nullable)
    kinds = dict(df.dtypes)

    def filled(name: str) -> Column:
        c = F.col(f"`{name}`")
        return c.isNotNull() & ~F.isnan(c) if kinds[name] in ("float", "double") else c.isNotNull()

    return df.filter(F.size(F.array_compact(F.array(*[F.when(filled(c), True) for c in nullable]))) >= needed)


def constant_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Numeric columns without variance (or with fewer than two values)."""
    spread = df.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
    return [c for c in columns if not spread[c] or spread[c] <= 0]


def without_value(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column is not ``value``; null rows stay."""
    return df.filter(differs(column, value))


def split_rows(df: DataFrame, mask: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that match and all the others; an unknown mask counts as no match."""
    mask = F.coalesce(mask, F.lit(False))
    return df.filter(mask), df.filter(~mask)


def in_set(c: Column | str, values) -> Column:
    """Membership; an empty set matches nothing."""
    values = list(values)
    return (F.col(c) if isinstance(c, str) else c).isin(*values) if values else F.lit(False)


def text_contains(c: Column | str, text: str, regex: bool = False) -> Column:
    """Case-insensitive search in the text form of a column."""
    plain = (F.col(c) if isinstance(c, str) else c).cast("string")
    hit = plain.rlike(f"(?i){text}") if regex else F.lower(plain).contains(text.lower())
    return F.coalesce(hit, F.lit(False))


def clean_loans(df: DataFrame, share: float = NEAR_CONSTANT_SHARE, protect=()) -> DataFrame:
    """Parse dates, then drop empty and near-constant columns (an empty one is both).

    Columns in ``protect`` are kept and not profiled.
    """
    return drop_near_constant(parse_dates(df, LOAN_DATES), share, protect)


def clean_bureau(df: DataFrame) -> DataFrame:
    """No record means no exposure: counts and amounts become 0, totals are added."""
    filled = parse_dates(df, ("OBS_DATE",)).na.fill(0, columns_with_prefix(df, *ZERO_MEANS_NONE))
    totals = {}
    if overdue := columns_with_prefix(df, "MONTVENC_"):
        totals["crc_total_overdue"] = row_sum(overdue)
    if debt := columns_with_prefix(df, "DIVIDAS_"):
        totals["crc_total_debt"] = row_sum(debt)
    return filled.withColumns(totals) if totals else filled


def clean_scores(df: DataFrame, letters: int = SCORE_LETTERS) -> DataFrame:
    """Ordinal score; history is kept. ``letters=8`` leaves letters after H null."""
    out = parse_dates(df, ("sys_data_procura",))
    if "kp_sqe" in df.columns:
        out = out.withColumn("kp_sqe_enc", score_ordinal("kp_sqe", letters)).drop("kp_sqe")
    return out.drop("sys_numero_submissao")


def clean_client_aggregates(df: DataFrame) -> DataFrame:
    return parse_dates(df, ("Date_Obs",))


def newest_first(df: DataFrame, key: str, date: str) -> DataFrame:
    """Reading order of a history: key ascending, date descending."""
    return df.orderBy(key, F.desc_nulls_last(date))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("rows"))


def sentinel(columns: list[str]) -> Column:
    """1 when any of the columns is filled."""
    mask = F.lit(False)
    for c in columns:
        mask = mask | F.col(c).isNotNull()
    return flag(mask)


def select_present(df: DataFrame, columns) -> DataFrame:
    return df.select(*present(df, columns))
