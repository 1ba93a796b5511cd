"""Repeated byte strings by range-partitioned suffix sorting.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else
too. Sorting every suffix would move a text many times over, so suffixes are
sorted in two steps, each by leading tokens that name fixed stretches of bytes
by hash:

1. *Sparse suffixes.* In each window of ``length`` bytes one anchor is chosen by
   its content (the least hash of the first three quarters), so equal windows
   choose the same anchor. The windows of an anchor follow each other. An
   anchor's suffix has the token of the stretch all its windows share and the
   tokens of the stretch they cover together. Equal in all tokens: every window
   repeats. Different in the first from all others: none does. Only anchors that
   agree in the first token but not in the others go on.
2. *Window suffixes.* For those every single window is a suffix, whose two tokens
   name all its bytes.

In both steps sampled splitters cut the order of tokens into ranges, each range
is sorted in memory by multikey quicksort and neighbours are compared. Splitters
include the place, so suffixes that are equal a great many times fall into
several ranges; runs that reach the edge of a range are compared across it.

Texts and tokens are named by 96 bits of hash, which tells 10^12 of them apart.
Copies of a text are reduced to one before both steps, for every window of a text
that stands twice repeats; so no two suffixes agree in place as well, and no range
grows with the number of copies. No group of equal suffixes is ever collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import bucketed, partitions, stored, text_key, text_of, with_row
from stayline.llm.rolling import PIECE, Rolled, column_bytes, least_in_window, mix

LENGTH = 400
#: Bytes whose hash decides where anchors are.
GRAM = 12
#: Suffixes sorted in one task.
TASK_SUFFIXES = 500_000

SPARSE = "t1 long, t2 int, k1 long, k2 int, start int, n int"
WINDOWS = "t1 long, t2 int, k1 long, k2 int, start int"
SPANS = "k1 long, k2 int, start int, n int, sure boolean"


def stretch(length: int) -> int:
    """Windows of an anchor that are told apart in the first step: those in one stretch of offsets."""
    return max(1, length // 4)


def anchors(raw: np.ndarray, starts: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, windows, t1, t2) of the sparse suffixes of all texts, piece by piece.

    ``starts`` has the text borders in ``raw``. ``start`` is the first window's,
    counted from its text. The windows of an anchor are cut where their offset
    to the anchor passes a multiple of :func:`stretch`, wherever they begin, so
    the bytes that ``t1`` names depend on the anchor and the stretch alone.
    """
    gram = min(GRAM, length)
    width, step = length - gram + 1, stretch(length)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    for lo in range(0, len(raw), PIECE):
        piece = raw[lo : lo + PIECE + length - 1]
        windows = min(PIECE, len(piece) - length + 1)
        if windows <= 0:
            break
        text = owner[lo : lo + windows]
        rolled = Rolled(piece)
        at = np.arange(windows + width - 1)
        order = rolled.of(at, at + gram)
        # the place in the low bits makes the leftmost of equal hashes the least
        least = least_in_window((order & ~np.uint64(0x1FFFFF)) | at.astype(np.uint64), width)[:windows]
        anchor = (least & np.uint64(0x1FFFFF)).astype(np.int64)
        block = (anchor - at[:windows]) // step
        new = np.ones(windows, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, windows))
        # windows that leave their text come last in it
        n = np.minimum(n, starts[text[first] + 1] - length + 1 - lo - first)
        first, n = first[n > 0], n[n > 0]
        near = anchor[first] - block[first] * step
        far = np.minimum(near - step + 1 + length, len(piece))
        yield (
            text[first], lo + first - starts[text[first]], n,
            rolled.of(near, far), mix(rolled.of(first, first + n - 1 + length) + n.astype(np.uint64)),
        )


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _upper(x: np.ndarray) -> pa.Array:
    """The upper half of a hash, which with a whole one beside it tells enough apart."""
    return pa.array((x >> np.uint64(32)).astype(np.uint32).view(np.int32))


def _keys(batch: pa.RecordBatch, rows: np.ndarray) -> list[pa.Array]:
    index = pa.array(rows)
    return [batch.column("k1").take(index), batch.column("k2").take(index)]


def _sparse(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts = column_bytes(batch.column("text"))
            for text, start, n, t1, t2 in anchors(raw, starts, length):
                yield pa.RecordBatch.from_arrays(
                    [_signed(t1), _upper(t2), *_keys(batch, text),
                     pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=[x.split()[0] for x in SPARSE.split(", ")],
                )

    return emit


def multikey_quicksort(tokens: list[np.ndarray]) -> np.ndarray:
    """Order of suffixes by their tokens: sort by one token, then each run of equals by the next."""
    order = np.argsort(tokens[0])
    run = np.zeros(len(order), np.int64)
    for depth, token in enumerate(tokens):
        if depth:
            many = np.flatnonzero(_in_runs(run))
            if not len(many):
                break
            order[many] = order[many][np.lexsort((token[order[many]], run[many]))]
        if len(order):
            sorted_token = token[order]
            new = np.concatenate([[False], (sorted_token[1:] != sorted_token[:-1]) | (run[1:] != run[:-1])])
            run = np.cumsum(new)
    return order


def _in_runs(run: np.ndarray) -> np.ndarray:
    """Whether an entry's run has more than one member."""
    same = np.zeros(len(run) + 1, bool)
    same[1:-1] = run[1:] == run[:-1]
    return same[1:] | same[:-1]


def _columns(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray] | None:
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return None
    whole = pa.Table.from_batches(tables)
    return {c: whole.column(c).to_numpy() for c in whole.column_names}


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Numbers of the runs of equal entries."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def _compare_sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors whose windows surely repeat (``sure``), and those whose windows must be looked at.

    A run of equal first tokens at the edge of the range may go on in the next
    range, so its members are looked at even if they are alone here.
    """
    c = _columns(batches)
    if c is None:
        return
    order = multikey_quicksort([c["t1"], c["t2"]])
    c = {k: v[order] for k, v in c.items()}
    group = _runs(c["t1"])
    kind = _runs(c["t1"], c["t2"])
    equal = _in_runs(kind)
    leader = np.concatenate([[True], kind[1:] != kind[:-1]])
    kinds_of_group = np.bincount(group[leader])
    mixed = (kinds_of_group[group] > 1) | (group == 0) | (group == group[-1])
    # of equal anchors one goes on, for others to be compared with
    for rows, sure in ((equal, True), (mixed & leader, False)):
        if rows.any():
            picked = [pa.array(c[k][rows]) for k in ("k1", "k2", "start", "n")]
            yield pa.RecordBatch.from_arrays(
                [*picked, pa.array(np.full(int(rows.sum()), sure))], names=[x.split()[0] for x in SPANS.split(", ")]
            )


#: Window suffixes sent on at a time.
SENT = 200_000


def _window_tokens(raw: np.ndarray, ranges: list[tuple[int, int]], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, t1, t2) of the windows in the ranges (start, n) of one text, piece by piece."""
    if len(raw) <= PIECE:
        at = np.concatenate([np.arange(start, start + n) for start, n in ranges])
        yield at, Rolled(raw).of(at, at + length), Rolled(raw, 1).of(at, at + length)
        return
    for start, n in ranges:
        for lo in range(start, start + n, PIECE):
            at = np.arange(min(PIECE, start + n - lo))
            piece = raw[lo : lo + len(at) + length - 1]
            yield lo + at, Rolled(piece).of(at, at + length), Rolled(piece, 1).of(at, at + length)


def _window_suffixes(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, borders = column_bytes(batch.column("text"))
            held: list[tuple[np.ndarray, ...]] = []
            size = 0

            def sent() -> pa.RecordBatch:
                text, at, t1, t2 = (np.concatenate(x) for x in zip(*held))
                held.clear()
                return pa.RecordBatch.from_arrays(
                    [_signed(t1), _upper(t2), *_keys(batch, text), pa.array(at.astype(np.int32))],
                    names=[x.split()[0] for x in WINDOWS.split(", ")],
                )

            for i in range(batch.num_rows):
                ranges = sorted({(s["start"], s["n"]) for s in batch.column("ranges")[i].as_py()})
                for at, t1, t2 in _window_tokens(raw[borders[i] : borders[i + 1]], ranges, length):
                    held.append((np.full(len(at), i), at, t1, t2))
                    size += len(at)
                    if size >= SENT:
                        yield sent()
                        size = 0
            if held:
                yield sent()

    return emit


EDGED = "t1 long, t2 int, k1 long, k2 int, start int, repeats boolean"


def _compare_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with an equal neighbour, and the first and the last suffix of the range with their tokens."""
    c = _columns(batches)
    if c is None:
        return
    order = multikey_quicksort([c["t1"], c["t2"]])
    c = {k: v[order] for k, v in c.items()}
    repeats = _in_runs(_runs(c["t1"], c["t2"]))
    inner = np.ones(len(repeats), bool)
    inner[[0, -1]] = False
    keep = repeats | ~inner
    yield pa.RecordBatch.from_arrays(
        [
            *[pa.array(c[k][keep], mask=inner[keep]) for k in ("t1", "t2")],
            *[pa.array(c[k][keep]) for k in ("k1", "k2", "start")], pa.array(repeats[keep]),
        ],
        names=[x.split()[0] for x in EDGED.split(", ")],
    )


def sorted_ranges(suffixes: DataFrame, rows: int, compare, schema: str) -> DataFrame:
    """Deal suffixes out by sampled splitters over tokens and place, then compare each range."""
    ranges = max(partitions(suffixes.sparkSession), rows // TASK_SUFFIXES + 1)
    return suffixes.repartitionByRange(ranges, "t1", "t2", "k1", "k2", "start").mapInArrow(compare, schema)


def suffix_key(text: Column) -> list[Column]:
    """A hash of 64 bits and one of 32 that name a text; suffix rows carry them."""
    k1, k2 = text_key(text)
    return [k1, F.shiftright(k2, 32).cast("int").alias("k2")]


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(k1, k2, text, copies): every text of ``rows`` (k1, k2, text) once, in buckets of its key.

    Each task drops its copies before the exchange, which is the only one of the
    texts: both steps and the cut read the buckets as they lie.
    """
    texts = rows.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    return bucketed(texts, ["k1", "k2"], "texts")


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, n): windows start .. start + n - 1 of a text also start elsewhere.

    ``texts`` has a row (k1, k2, text, copies) per distinct text. A text with two
    or more copies repeats from end to end; it stays in both steps once, so that
    others are compared with it.
    """
    long_enough = F.octet_length("text") >= length
    size = texts.filter(long_enough).agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    sparse = texts.filter(long_enough).select("k1", "k2", "text").mapInArrow(_sparse(length), SPARSE)
    spans = stored(sorted_ranges(sparse, 6 * size // length, _compare_sparse, SPANS), "spans")
    open_ = spans.filter("NOT sure").groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "n")).alias("ranges"))
    expected = spans.filter("NOT sure").agg(F.sum("n")).first()[0] or 0
    windows = texts.join(open_, ["k1", "k2"]).select("k1", "k2", "text", "ranges").mapInArrow(_window_suffixes(length), WINDOWS)
    compared = stored(sorted_ranges(windows, expected, _compare_windows, EDGED), "windows")
    # rows at the edges, two per range at most, meet those with their tokens; all others stay by themselves
    meeting = Window.partitionBy("t1", "t2")
    edges = compared.filter("t1 IS NOT NULL").withColumn("met", F.count("*").over(meeting)).filter("repeats OR met > 1")
    inner = compared.filter("t1 IS NULL AND repeats")
    return spans.filter("sure").select("k1", "k2", "start", "n").unionByName(
        inner.select("k1", "k2", "start", F.lit(1).alias("n"))
    ).unionByName(edges.select("k1", "k2", "start", F.lit(1).alias("n")))


def covered(start: np.ndarray, n: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Starts and stops of the maximal runs of bytes that windows start .. start + n - 1 cover."""
    if not len(start):
        return [], []
    order = np.argsort(start, kind="stable")
    start, stop = start[order].astype(np.int64), (start + n - 1 + length)[order].astype(np.int64)
    upto = np.maximum.accumulate(stop)
    new = np.concatenate([[True], start[1:] > upto[:-1]])
    return start[new].tolist(), upto[np.append(np.flatnonzero(new)[1:] - 1, len(upto) - 1)].tolist()


def _cut(length: int, with_text: bool):
    """What is left of each distinct text; of one with copies, nothing that a window covers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, borders = column_bytes(batch.column("text"))
            lists = batch.column("spans")
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            flat = lists.flatten()
            starts, counts = (flat.field(c).to_numpy() for c in ("start", "n"))
            copies = batch.column("copies").to_pylist()
            removed, spans, digest, kept = [], [], [], []
            for i in range(batch.num_rows):
                data = raw[borders[i] : borders[i + 1]].tobytes()
                own = slice(ends[i - 1] if i else 0, ends[i])
                if copies[i] > 1 and len(data) >= length:
                    first, last = [0], [len(data)]
                else:
                    first, last = covered(starts[own], counts[own], length)
                left = b"".join(data[a:b] for a, b in zip([0, *last], [*first, len(data)])) if first else data
                removed.append(len(data) - len(left))
                spans.append([{"start": a, "stop": b} for a, b in zip(first, last)])
                digest.append(hashlib.sha256(left).hexdigest())
                # a character goes as a whole if any of its bytes goes; a text that stays is not sent again
                kept.append(left.decode("utf-8", "ignore") if with_text and first else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), pa.array(np.diff(borders)), pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    pa.array(digest, pa.string()), pa.array(kept, pa.string()),
                ],
                names=["row", "n_bytes", "n_removed", "removed_spans", "kept_sha256", "kept_text"],
            )

    return cut


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, text: str = "text", keep: list[str] | None = None, with_text: bool = True
) -> DataFrame:
    """All rows of ``docs`` with what is left of their texts.

    Adds ``n_bytes``, ``n_removed``, ``removed_spans`` (maximal runs of removed
    bytes), ``kept_sha256`` of the remaining bytes and, unless ``with_text`` is
    off, ``kept_text`` (whole characters only). ``keep`` names the input columns
    to carry (default: all). A null text is empty; texts shorter than ``length``
    bytes stay as they are; rows that repeat a text are copies of each other, so
    all of them lose their bytes. Strings are judged on the input.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    added = ["n_bytes", "n_removed", "removed_spans", "kept_sha256", "kept_text"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    k1, k2 = suffix_key(text_of(text))
    own = [text_of(text).alias("own")] if with_text and text not in names else []
    rows = docs.select(F.struct(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *own).alias("all"), k1, k2)
    texts = distinct_texts(docs.select(k1, k2, text_of(text).alias("text")))
    spans = repeated_spans(texts, length)
    by_text = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    joined = texts.select(F.struct("k1", "k2").alias("row"), "k1", "k2", "text", "copies").join(by_text, ["k1", "k2"], "left")
    schema = with_row(
        joined, n_bytes="long", n_removed="long", removed_spans="array<struct<start:bigint,stop:bigint>>",
        kept_sha256="string", kept_text="string",
    )
    cut = joined.mapInArrow(_cut(length, with_text), schema).select("row.*", F.struct(*added).alias("cut"))
    # a join of plain exchanges, so that Spark can split a text with very many copies
    found = rows.join(cut, ["k1", "k2"])
    told = {c: F.col("cut")[c] for c in added if c != "kept_text"}
    if with_text:
        told["kept_text"] = F.coalesce(F.col("cut")["kept_text"], F.col("all.own") if own else F.coalesce(F.col("all.row")[text], F.lit("")))
    return found.select("all.row.*", *[c.alias(n) for n, c in told.items()])
