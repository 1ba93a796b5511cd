"""Missing-value treatment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.operators.clean import drop_sparse_rows
from stayline.session import written
from stayline.sources.schema import columns_with_prefix, date_columns, numeric_columns, text_columns

UNKNOWN = "Unknown"
#: Rows of a group up to which a fill sorts whole groups; larger ones are cut into pieces.
GROUP_LIMIT = 1_000_000


def fill_numeric(df: DataFrame, value: float = 0.0, columns: list[str] | None = None) -> DataFrame:
    return df.na.fill(value, numeric_columns(df) if columns is None else columns)


def fill_text(df: DataFrame, value: str = UNKNOWN, columns: list[str] | None = None) -> DataFrame:
    return df.na.fill(value, text_columns(df) if columns is None else columns)


def fill_prefix(df: DataFrame, *prefixes: str, value: float = 0) -> DataFrame:
    return df.na.fill(value, columns_with_prefix(df, *prefixes))


def directional_fill(
    df: DataFrame,
    columns: list[str],
    partition_by: list[str],
    order_by: list[str],
    direction: str = "ffill",
    group_size: int | None = None,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Carry the nearest earlier (or later) non-null value over nulls.

    The row order must be named: it follows ``order_by`` inside ``partition_by``,
    and a hash of the row where that leaves ties. Rows are dealt out once, by ranges
    of key and order, so a large group is cut into pieces wherever its order columns
    allow it, whatever their type. Each sorted piece is filled as it streams by;
    only the first group of a piece can take over values, those of one row per
    piece.

    Where the rows of the largest group are known (``group_size``, or more) and
    few, groups are sorted whole instead, which gives the same rows: tables that lie
    by their key already, as after a join, are not dealt out again.
    """
    if not partition_by:
        raise ValueError("a directional fill needs a partition key")
    if not order_by:
        raise ValueError("a directional fill needs an order")
    if direction not in ("ffill", "bfill"):
        raise ValueError(f"unknown direction {direction!r}")
    if not columns:
        return df
    names = df.columns
    if group_size is not None and group_size <= limit:
        return _fill_whole_groups(df, columns, partition_by, order_by, direction)
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*[F.col(c) for c in partition_by], *_fill_order(order_by, direction)]
    dealt = _tied(df).repartitionByRange(pieces, *order).sortWithinPartitions(*order).drop("_tie")
    schema = T.StructType([*dealt.schema.fields, *T.StructType.fromDDL("_piece int, _first boolean, _last boolean").fields])
    filled = written(dealt.mapInArrow(_filler(partition_by, columns), schema), "filled")
    # one row per piece: what it hands on, and whether it goes to the piece's next one
    ends = filled.filter("_last").select("_piece", "_first", *[f"`{c}`" for c in dict.fromkeys([*partition_by, *columns])]).collect()
    starts = filled.groupBy("_piece").agg(*[F.first(F.when(F.col("_first"), F.col(f"`{k}`")), True).alias(f"_k{i}") for i, k in enumerate(partition_by)])
    carried = _carries({r["_piece"]: r for r in ends}, {r["_piece"]: tuple(r)[1:] for r in starts.collect()}, partition_by, columns)
    if not carried:
        return filled.select(*[f"`{c}`" for c in names])
    kinds = {f.name: f.dataType for f in filled.schema.fields}
    told = T.StructType([T.StructField("_piece", T.IntegerType()), *[T.StructField(f"_c{i}", kinds[c]) for i, c in enumerate(columns)]])
    small = df.sparkSession.createDataFrame(carried, told)
    place = {c: i for i, c in enumerate(columns)}
    # the first group of a piece may have begun in an earlier one; others never take anything over
    into = lambda c: F.coalesce(F.col(f"`{c}`"), F.when(F.col("_first"), F.col(f"_c{place[c]}"))).alias(c)
    return filled.join(F.broadcast(small), "_piece", "left").select(*[into(c) if c in place else F.col(f"`{c}`") for c in names])


def _tied(df: DataFrame) -> DataFrame:
    return df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def _fill_order(order_by: list[str], direction: str) -> list:
    # a later value carried back is an earlier one in the reversed order
    way = (lambda c: F.col(c).asc()) if direction == "ffill" else (lambda c: F.col(c).desc())
    return [way(c) for c in [*order_by, "_tie"]]


def _fill_whole_groups(
    df: DataFrame, columns: list[str], keys: list[str], order_by: list[str], direction: str
) -> DataFrame:
    so_far = Window.partitionBy(*keys).orderBy(*_fill_order(order_by, direction)).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(F.col(f"`{c}`"), ignorenulls=True).over(so_far) for c in columns}
    return _tied(df).withColumns(filled).select(*[f"`{c}`" for c in df.columns])


def _filler(keys: list[str], columns: list[str]):
    """Fill each sorted piece by itself; its first group and its last row are marked."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()
        last: pa.RecordBatch | None = None  # the last row so far, filled
        first_group = True
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield held
            new = np.zeros(batch.num_rows, bool)
            joined = batch if last is None else _under(last, batch, keys)
            for k in keys:
                column = joined.column(k)
                new |= _changes(column)[len(column) - batch.num_rows :]
            begins = np.flatnonzero(new)
            inner = int(begins[0]) if len(begins) else batch.num_rows
            first = np.arange(batch.num_rows) < inner if first_group else np.zeros(batch.num_rows, bool)
            first_group = first_group and not len(begins)
            at = np.arange(batch.num_rows)
            group = np.maximum.accumulate(np.where(new, at, 0))
            arrays = dict(zip(batch.schema.names, batch.columns))
            for c in columns:
                valid = batch.column(c).is_valid().to_numpy(zero_copy_only=False)
                near = np.maximum.accumulate(np.where(valid, at, -1))
                from_before = (near < 0) & (at < inner)
                source = pa.array(near, mask=(near < group) & ~from_before | (near < 0))
                filled = batch.column(c).take(source)
                if last is not None and from_before.any():
                    filled = pc.if_else(pa.array(from_before), last.column(c)[0], filled)
                arrays[c] = filled
            whole = list(arrays.values())
            n = batch.num_rows
            schema = batch.schema.append(pa.field("_piece", pa.int32())).append(pa.field("_first", pa.bool_())).append(pa.field("_last", pa.bool_()))
            marks = [pa.array(np.full(n, piece, np.int32)), pa.array(first), pa.array(np.zeros(n, bool))]
            held = pa.RecordBatch.from_arrays([*whole, *marks], schema=schema)
            last = held.slice(n - 1, 1)
        if held is not None:
            end = np.zeros(held.num_rows, bool)
            end[-1] = True
            yield held.set_column(held.schema.get_field_index("_last"), "_last", pa.array(end))

    return fill


def _under(last: pa.RecordBatch, batch: pa.RecordBatch, keys: list[str]) -> pa.Table:
    return pa.Table.from_batches([last.select(keys), batch.select(keys)]).combine_chunks()


def _changes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; the first one never does, nulls are alike."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros(len(whole), bool)
    if len(whole) > 1:
        a, b = whole.slice(0, len(whole) - 1), whole.slice(1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        out[1:] = pc.or_(differ, pc.xor(a.is_valid(), b.is_valid())).to_numpy(zero_copy_only=False)
    return out


def _carries(ends: dict, starts: dict, keys: list[str], columns: list[str]) -> list[tuple]:
    """What each piece takes over: the filled end of the piece before it, if its first group goes on there."""
    out, before = [], None
    for piece in sorted(ends):
        own = tuple(ends[piece][k] for k in keys)
        taken = before[1] if before is not None and before[0] == starts[piece] else [None] * len(columns)
        if any(v is not None for v in taken):
            out.append((piece, *taken))
        values = [ends[piece][c] for c in columns]
        if ends[piece]["_first"]:
            values = [t if v is None else v for v, t in zip(values, taken)]
        before = (own, values)
    return out


def handle_missing(
    df: DataFrame,
    partition_by: list[str],
    order_by: list[str],
    numeric_value: float = 0.0,
    dates: str = "ffill",
    max_missing: float = 0.5,
    exclude: tuple[str, ...] = (),
    date_fill_columns: list[str] | None = None,
    group_size: int | None = None,
) -> DataFrame:
    """Drop sparse rows, then fill by type.

    ``exclude`` names columns of any type that keep their nulls, as keys should. Only date columns
    named in ``date_fill_columns`` (all but the order columns when left out) are
    filled or, with ``dates="drop"``, required.
    """
    kept = drop_sparse_rows(df, max_missing)
    out = fill_numeric(kept, numeric_value, numeric_columns(kept, exclude))
    out = fill_text(out, columns=[c for c in text_columns(out) if c not in exclude])
    targets = date_fill_columns
    if targets is None:
        targets = [c for c in date_columns(out) if c not in order_by]
    if dates == "drop":
        return out.na.drop(subset=targets) if targets else out
    return directional_fill(out, targets, partition_by, order_by, dates, group_size)


def missing_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and missing cells before and after treatment."""
    def counts(df: DataFrame, stage: str) -> DataFrame:
        cells = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0))
        return df.agg(
            F.lit(stage).alias("stage"),
            F.count("*").alias("rows"),
            F.coalesce(F.sum(cells), F.lit(0)).alias("missing_cells"),
        )

    return counts(before, "before").unionByName(counts(after, "after"))


class IncompleteError(ValueError):
    """Nulls remain where none are allowed."""


def require_complete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pass the table through, or raise and name the columns that still hold nulls."""
    columns = columns or df.columns
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]).first()
    left = {c: counts[c] for c in columns if counts[c]}
    if left:
        raise IncompleteError(f"{sum(left.values())} null(s) remain in columns: {sorted(left)}")
    return df
