"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is the set of its word 5-grams; a document holds it if at least 0.8 of
them stand anywhere in the document. Items are partitioned by size. An item's
sketch is its bottom-k by a min-hash order, with k one more than the 5-grams it
may lack: whatever a document leaves out, one sketch entry must be in it, so
probing sketches misses nothing, however long the document is. Documents are
only probed for partitions whose items they are large enough to hold. Candidates
are verified by counting all shared 5-grams.

Items that are the same words are searched once. The 5-grams of the items go to
every task as a filter while they are few enough (:data:`FILTER_ROWS`); beyond
that all 5-grams of the documents meet them in a shuffled join instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import packed, stored, text_key, text_of, unpacked
from stayline.llm.rolling import PIECE, Rolled, column_bytes, mix

SHINGLE = 5
CONTAINMENT = 0.8
#: 5-grams of items that are sent to every task, at 16 bytes each.
FILTER_ROWS = 2_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters, digits and everything outside ASCII.
_IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])

SHINGLES = "k1 long, k2 long, h long"
ITEMS = "k1 long, k2 long, n_words int, h long"


def _pieces(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Borders of pieces of about :data:`PIECE` bytes that do not cut a word."""
    lo = 0
    while lo < len(raw):
        hi = min(lo + PIECE, len(raw))
        while hi < len(raw) and _IN_WORD[raw[hi]]:
            hi += 1
        yield lo, hi
        lo = hi


def word_hashes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of all texts in ``raw``."""
    raw = _LOWER[raw]
    hashes, texts = [], []
    for lo, hi in _pieces(raw):
        piece = raw[lo:hi]
        inside = np.concatenate([[False], _IN_WORD[piece], [False]])
        begins = np.zeros(len(piece) + 1, bool)
        borders = starts[(starts >= lo) & (starts < hi)] - lo
        begins[borders] = True
        first = np.flatnonzero(inside[1:] & (~inside[:-1] | begins))
        last = np.flatnonzero(inside[:-1] & (~inside[1:] | begins))
        if len(first):
            hashes.append(Rolled(piece).of(first, last))
            texts.append(np.searchsorted(starts, first + lo, "right") - 1)
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(texts)


def grams(words: np.ndarray, texts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``size`` words within a text."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = words[:n] + np.uint64(size)
    for j in range(1, size):
        h = mix(h) + words[j : j + n]
    whole = texts[:n] == texts[size - 1 :]
    return mix(h[whole]), texts[:n][whole]


def _groups(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about :data:`PIECE` bytes together."""
    lo = 0
    while lo < len(starts) - 1:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + PIECE, "right")) - 1)
        yield lo, hi
        lo = hi


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct shingles of every item; an item of fewer words than a shingle is one shingle."""
    for batch in batches:
        for i in range(batch.num_rows):
            raw, starts = column_bytes(batch.column("text").slice(i, 1))
            words, texts = word_hashes(raw, starts)
            if not len(words):
                continue
            h = np.unique(grams(words, texts, min(SHINGLE, len(words)))[0])
            keys = [pa.array(np.full(len(h), batch.column(k)[i].as_py())) for k in ("k1", "k2")]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(np.full(len(h), len(words), np.int32)), pa.array(h.view(np.int64))],
                names=[x.split()[0] for x in ITEMS.split(", ")],
            )


class Filter:
    """Which hashes occur in the items: a bit table first, then a search."""

    BITS = 24

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[(self.hashes >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def positions(self, h: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.table[(h >> np.uint64(64 - self.BITS)).astype(np.int64)])
        if not len(maybe) or not len(self.hashes):
            return maybe[:0]
        at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        return maybe[self.hashes[at] == h[maybe]]


def _document_shingles(sizes: list[int], known: np.ndarray | None):
    """Distinct shingles of every document, of all lengths that items have; with ``known`` only those."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Filter(known) if known is not None else None
        for batch in batches:
            raw, starts = column_bytes(batch.column("text"))
            for lo, hi in _groups(starts):
                words, texts = word_hashes(raw[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])
                for size in sizes:
                    h, text = grams(words, texts, size)
                    if wanted:
                        at = wanted.positions(h)
                        h, text = h[at], text[at]
                    if not len(h):
                        continue
                    pairs = np.unique(np.column_stack([text.astype(np.uint64), h]), axis=0)
                    index = pa.array(pairs[:, 0].astype(np.int64) + lo)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("k1").take(index), batch.column("k2").take(index),
                         pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64))],
                        names=[x.split()[0] for x in SHINGLES.split(", ")],
                    )

    return emit


def item_tables(items: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Shingles of the distinct items (item1, item2, h, n, size_class), and their sketches."""
    texts = items.select(*text_key(text_of(text)), text_of(text).alias("text")).dropDuplicates(["k1", "k2"])
    shingles = stored(texts.mapInArrow(_item_shingles, ITEMS), "items")
    sized = shingles.groupBy("k1", "k2").agg(F.count("*").alias("n"))
    full = (
        shingles.join(sized, ["k1", "k2"])
        .withColumn("size_class", F.floor(F.log2("n")).cast("int"))
        .withColumnsRenamed({"k1": "item1", "k2": "item2"})
    )
    # k one more than the shingles that may be missing
    rank = F.array_sort(F.collect_list(F.struct(F.xxhash64("h").alias("o"), "h")))
    lacking = F.col("n") - F.ceil(CONTAINMENT * F.col("n") - 1e-9)
    sketches = (
        full.groupBy("item1", "item2", "n", "size_class")
        .agg(rank.alias("ranked"))
        .select("item1", "item2", "n", "size_class", F.explode(F.slice("ranked", 1, (lacking + 1).cast("int"))).alias("x"))
        .select("item1", "item2", "n", "size_class", "x.h")
    )
    return full, sketches


def contained(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", filter_rows: int = FILTER_ROWS) -> DataFrame:
    """(k1, k2, item1, item2, n, found): items of which a text holds enough, by the hashes of both texts."""
    full, sketches = item_tables(items, item_text)
    sizes = sorted(r[0] for r in full.select(F.least("n_words", F.lit(SHINGLE))).distinct().collect())
    rows = full.count()
    small = rows <= filter_rows
    known = np.array([r[0] for r in full.select("h").distinct().collect()], np.int64).view(np.uint64) if small else None
    texts = docs.select(*text_key(text_of(text)), text_of(text).alias("text"))
    probes = stored(texts.mapInArrow(_document_shingles(sizes, known), SHINGLES).distinct(), "probes")
    side = (lambda t: F.broadcast(t)) if small else (lambda t: t)
    held = probes.groupBy("k1", "k2").agg(F.count("*").alias("size"))
    # a document with fewer shingles than a partition's least item can not hold any of it
    room = F.ceil(CONTAINMENT * F.pow(F.lit(2.0), F.col("size_class")) - 1e-9)
    candidates = (
        probes.join(side(sketches), "h")
        .join(held, ["k1", "k2"])
        .filter(F.col("size") >= room)
        .select("k1", "k2", "item1", "item2")
        .distinct()
    )
    shared = probes.join(side(full.select("h", "item1", "item2", "n")), "h")
    return (
        shared.join(candidates, ["k1", "k2", "item1", "item2"], "left_semi")
        .groupBy("k1", "k2", "item1", "item2", "n")
        .agg(F.count("*").alias("found"))
        .filter(F.col("found") >= F.ceil(CONTAINMENT * F.col("n") - 1e-9))
    )


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
    keep: list[str] | None = None, filter_rows: int = FILTER_ROWS,
) -> DataFrame:
    """One row per document and item it holds: the document's columns, ``item_id``, ``n_shingles``, ``n_found``, ``containment``.

    ``keep`` names the document columns to carry (default: all). Null and empty
    texts hold nothing and items without a word are held by nothing. An item of
    fewer than five words is looked for as one run of its words. Repeated
    documents and repeated items each have rows of their own.
    """
    added = ["item_id", "n_shingles", "n_found", "containment"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    found = stored(contained(docs, items, text, item_text, filter_rows), "contained")
    k1, k2 = text_key(text_of(text))
    i1, i2 = text_key(text_of(item_text))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), k1, k2)
    named = items.select(F.col(f"`{item_id}`").alias("item_id"), i1.alias("item1"), i2.alias("item2"))
    return unpacked(
        rows.join(found, ["k1", "k2"]).join(named, ["item1", "item2"]),
        F.col("item_id"),
        F.col("n").alias("n_shingles"),
        F.col("found").alias("n_found"),
        (F.col("found") / F.col("n")).alias("containment"),
    )


def without_items(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    found = stored(contained(docs, items, text, item_text).select("k1", "k2").distinct(), "contained")
    k1, k2 = text_key(text_of(text))
    return unpacked(packed(docs, k1=k1, k2=k2).join(found, ["k1", "k2"], "left_anti"))
