"""Ranked lexical search over an index in blocks, with pair bounds.

*Index.* Each task cuts its documents into blocks and writes, per block and term,
the documents that hold the term with how often they do and their lengths. Within a
block documents are numbered in the order of their ids.

*Pairs.* For pairs of terms that queries use together, a block also stores the
documents that hold both and the largest joint impact of one of them.

*Search.* Blocks are searched by themselves, for up to ``ITEM_BLOCK`` items at a
time. Terms are taken from the largest impact down. Once the terms that are left can
not reach the score of the k-th document together, no new documents come in
(MaxScore); what is left to gain is bounded by pairs: of two terms a document holds
both, and gains their joint maximum, or one, and gains the larger single maximum. The
first blocks searched give each item a floor for all others. Scores are whole numbers,
so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stayline.llm.common import lower_ascii, stored, text_of
from stayline.llm.rolling import byte_slices, column_bytes

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text in a block, unless one document has more.
BLOCK_BYTES = 8 << 20
#: Items searched at a time.
ITEM_BLOCK = 256
#: Of each item's terms the most frequent ones are paired.
PAIRED = 8
#: One of so many blocks is searched first, for the floors.
FIRST_OF = 16

IN_TERM = np.zeros(256, bool)
IN_TERM[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


# ---------------------------------------------------------------- index


def occurrences(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Every term of all texts in a row, and the number of its text."""
    raw, borders = column_bytes(texts)
    inside = IN_TERM[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[borders] = True
    at = np.flatnonzero(inside & (first[:-1] | np.concatenate([[True], ~inside[:-1]])))
    offsets = np.concatenate([[0], np.cumsum(inside, dtype=np.int32)])[np.append(at, len(raw))].astype(np.int32)
    data = LOWERED[raw[inside]]
    terms = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return terms.dictionary_encode(), np.searchsorted(borders, at, side="right") - 1


ENTRY = "block long, at int, n_terms long, term string, docs array<int>, tf array<int>, n array<int>"


def _indexer(schema: pa.Schema):
    def lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))

    def filled(rows: int, **columns: pa.Array) -> pa.RecordBatch:
        arrays = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for lo, hi in byte_slices(sizes, BLOCK_BYTES):
                part = batch.slice(lo, hi - lo)
                part = part.take(pc.sort_indices(part.column("doc"), null_placement="at_end"))
                terms, owner = occurrences(part.column("text"))
                n = np.bincount(owner, minlength=len(part))
                codes = terms.indices.to_numpy().astype(np.int64)
                held, tf = np.unique(codes * len(part) + owner, return_counts=True)
                docs = held % len(part)
                begins = np.searchsorted(held, np.arange(len(terms.dictionary) + 1) * len(part))
                number = pa.array(np.full(len(part), block))
                yield filled(len(part), doc=part.column("doc"), block=number, at=pa.array(np.arange(len(part))), n_terms=pa.array(n))
                for start in range(0, len(terms.dictionary), 20_000):
                    some = terms.dictionary.slice(start, 20_000)
                    cut = begins[start : start + len(some) + 1]
                    inner = slice(cut[0], cut[-1])
                    yield filled(
                        len(some), block=pa.array(np.full(len(some), block)), term=some, docs=lists(cut - cut[0], docs[inner]),
                        tf=lists(cut - cut[0], tf[inner]), n=lists(cut - cut[0], n[docs[inner]]),
                    )
                block += 1

    return index


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The index of all rows, stored: rows of documents (``term`` null) and of terms per block."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), text_of(text).alias("text"))
    schema = T.StructType([T.StructField("doc", rows.schema["doc"].dataType), *T.StructType.fromDDL(ENTRY).fields])
    return stored(rows.mapInArrow(_indexer(to_arrow_schema(schema)), schema), "search-index")


# ---------------------------------------------------------------- impacts


def impacts(w: int, tf: np.ndarray, n: np.ndarray, stats: tuple[int, int]) -> np.ndarray:
    """What a term of weight ``w`` adds to the scores of documents; ``stats`` are N and L."""
    documents, length = stats
    m = 100 - 50 + 50 * n.astype(np.int64) * documents // length
    tf = tf.astype(np.int64)
    return w * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def weight(df: Column, documents: int) -> Column:
    return F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * documents + 2.0) / (F.lit(2.0) * df + 1.0))).cast("long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of each key as one table; rows come sorted by the keys."""
    held: list[pa.RecordBatch] = []
    at: tuple | None = None
    for batch in batches:
        told = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        lo = 0
        for key, run in groupby(told):
            hi = lo + sum(1 for _ in run)
            if held and key != at:
                yield at, pa.Table.from_batches(held)
                held = []
            at = key
            held.append(batch.slice(lo, hi - lo))
            lo = hi
    if held:
        yield at, pa.Table.from_batches(held)


def _lists(table: pa.Table, column: str) -> list[np.ndarray]:
    whole = table.column(column).combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(whole), 0).to_numpy())
    return np.split(whole.flatten().to_numpy(), ends[:-1])


PAIRS = "block long, a string, b string, docs array<int>, joint long"


def _pair_lists(stats: tuple[int, int]):
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block,), rows in _groups(batches, ["block"]):
            names, weights, partners = (rows.column(c).to_pylist() for c in ("term", "w", "partners"))
            docs, tf, n = (_lists(rows, c) for c in ("docs", "tf", "n"))
            own = {t: (docs[i], impacts(weights[i], tf[i], n[i], stats)) for i, t in enumerate(names)}
            out: list[tuple] = []
            for i, a in enumerate(names):
                for b in partners[i] or []:
                    if b in own:
                        both, in_a, in_b = np.intersect1d(docs[i], own[b][0], assume_unique=True, return_indices=True)
                        joint = own[a][1][in_a] + own[b][1][in_b]
                        out.append((block, a, b, both.tolist(), int(joint.max()) if len(both) else 0))
            if out:
                types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names=[x.split()[0] for x in PAIRS.split(", ")]
                )

    return pair


def pair_lists(postings: DataFrame, pairs: DataFrame, terms: DataFrame, stats: tuple[int, int]) -> DataFrame:
    """(block, a, b, docs, joint): documents of a block that hold both terms of a pair, and the largest joint impact.

    ``postings`` are term rows of the index, ``pairs`` has rows (a, b), ``terms``
    (term, w). Pairs whose terms both stand in a block have a row there, with an
    empty list where no document holds both.
    """
    partners = pairs.groupBy("a").agg(F.collect_set("b").alias("partners")).withColumnRenamed("a", "term")
    ends = pairs.select(F.col("a").alias("term")).union(pairs.select("b")).distinct()
    told = terms.join(ends, "term").join(partners, "term", "left")
    rows = postings.select("block", "term", "docs", "tf", "n").join(told, "term")
    return stored(rows.repartition("block").sortWithinPartitions("block").mapInArrow(_pair_lists(stats), PAIRS), "pair-lists")


# ---------------------------------------------------------------- search


class Bounds:
    """What a document can gain at most from the last terms of an item; ``terms`` go by falling maximum.

    ``joint`` has joint maximum and documents of pairs of terms, ``partners`` the
    terms each one is paired with.
    """

    def __init__(self, terms: list[str], most: dict[str, int], joint: dict[tuple[str, str], tuple[int, np.ndarray]], partners: dict[str, list[str]]):
        place = {t: i for i, t in enumerate(terms)}
        self.after = np.append(np.cumsum([most[t] for t in reversed(terms)])[::-1], 0)
        self.gains = []
        for i, t in enumerate(terms):
            for u in partners.get(t, ()):
                j = place.get(u, -1)
                if j > i:
                    larger, both = joint[min(t, u), max(t, u)]
                    one = most[t]
                    gain = int(one + most[u] - max(larger, one))
                    if gain > 0:
                        self.gains.append((gain, i, j, max(0, larger - one), both))
        self.gains.sort(key=lambda g: (-g[0], g[1], g[2]))

    def matched(self, start: int) -> list[tuple]:
        """Disjoint pairs among the terms from ``start`` on that lower the bound the most, greedily."""
        used, out = set(), []
        for pair in self.gains:
            if pair[1] >= start and pair[1] not in used and pair[2] not in used:
                used |= {pair[1], pair[2]}
                out.append(pair)
        return out

    def bound(self, start: int) -> int:
        """No document gains more from these terms."""
        return int(self.after[start]) - sum(p[0] for p in self.matched(start))

    def bounds(self, start: int, docs: np.ndarray) -> np.ndarray:
        """The same for each of these documents: those not in a pair's list hold one of its terms at most."""
        out = np.full(len(docs), self.bound(start), np.int64)
        for _, _, _, beyond_one, both in self.matched(start):
            if beyond_one:
                out[~_place(both, docs)[1]] -= beyond_one
        return out


def _place(sorted_docs: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where documents stand in a list, and whether they do."""
    if not len(sorted_docs):
        return np.zeros(len(docs), np.int64), np.zeros(len(docs), bool)
    at = np.minimum(np.searchsorted(sorted_docs, docs), len(sorted_docs) - 1)
    return at, sorted_docs[at] == docs


def best_of_block(
    terms: list[str], own: dict[str, tuple[np.ndarray, np.ndarray]], bounds: Bounds, size: int, k: int, floor: int
) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``k`` best of a block with a score of ``floor`` or more; ties go to the first document.

    ``terms`` go by falling maximum, as in ``bounds``.
    """
    scores = np.zeros(size, np.int64)
    least, nth = max(floor, 1), 0
    while nth < len(terms) and bounds.bound(nth) >= least:
        docs, gain = own[terms[nth]]
        scores[docs] += gain
        nth += 1
        if len(scores) > k:
            # what documents have so far is never more than their score
            least = max(least, int(np.partition(scores, -k)[-k]))
    docs = np.flatnonzero(scores)
    if nth < len(terms):
        docs = docs[scores[docs] + bounds.bounds(nth, docs) >= least]
    while nth < len(terms) and len(docs):
        held, gain = own[terms[nth]]
        nth += 1
        at, there = _place(held, docs)
        scores[docs[there]] += gain[at[there]]
        docs = docs[scores[docs] + bounds.bound(nth) >= least]
    docs = docs[scores[docs] >= least]
    order = np.lexsort((docs, -scores[docs]))[:k]
    return docs[order], scores[docs[order]]


FOUND = "item long, block long, at int, score long"


def _search(stats: tuple[int, int], k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, block), rows in _groups(batches, ["item_block", "block"]):
            is_pair = pc.is_valid(rows.column("b"))
            terms, pairs = rows.filter(pc.invert(is_pair)), rows.filter(is_pair)
            if not len(terms):
                continue
            names, weights = (terms.column(c).to_pylist() for c in ("term", "w"))
            docs, tf, n = (_lists(terms, c) for c in ("docs", "tf", "n"))
            own = {t: (docs[i], impacts(weights[i], tf[i], n[i], stats)) for i, t in enumerate(names)}
            joint = {}
            if len(pairs):
                told = (pairs.column(c).to_pylist() for c in ("term", "b", "joint"))
                joint = {(a, b): (j, both) for a, b, j, both in zip(*told, _lists(pairs, "docs"))}
            most = {t: int(gain.max()) for t, (_, gain) in own.items()}
            partners: dict[str, list[str]] = {}
            for a, b in joint:
                partners.setdefault(a, []).append(b)
                partners.setdefault(b, []).append(a)
            size = 1 + max(int(d[-1]) for d in docs)
            wanted: dict[int, list[str]] = {}
            floors: dict[int, int] = {}
            for t, items in zip(names, terms.column("items").to_pylist()):
                for one in items:
                    wanted.setdefault(one["item"], []).append(t)
                    floors[one["item"]] = one["floor"]
            out = []
            for item, own_terms in wanted.items():
                own_terms.sort(key=lambda t: (-most[t], t))
                bounds = Bounds(own_terms, most, joint, partners)
                best, scores = best_of_block(own_terms, own, bounds, size, k, floors[item])
                out.append((np.full(len(best), item), np.full(len(best), block), best.astype(np.int32), scores))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=[x.split()[0] for x in FOUND.split(", ")])

    return search


def _searched(item_terms: DataFrame, item_pairs: DataFrame, postings: DataFrame, lists: DataFrame, stats: tuple[int, int], k: int) -> DataFrame:
    """Best documents of every block for every item of ``item_terms`` (item_block, term, w, item, floor)."""
    by_term = item_terms.groupBy("item_block", "term", "w").agg(F.collect_list(F.struct("item", "floor")).alias("items"))
    rows = postings.select("block", "term", "docs", "tf", "n").join(by_term, "term")
    pairs = lists.join(item_pairs, ["a", "b"]).select("item_block", "block", F.col("a").alias("term"), "b", "docs", "joint")
    both = rows.unionByName(pairs, allowMissingColumns=True)
    dealt = both.repartition("item_block", "block").sortWithinPartitions("item_block", "block")
    return dealt.mapInArrow(_search(stats, k), FOUND)


def item_pairs_of(item_terms: DataFrame) -> DataFrame:
    """(item_block, a, b): pairs among the ``PAIRED`` most frequent terms of each item, each once per block of items."""
    order = Window.partitionBy("item").orderBy(F.col("df").desc(), "term")
    often = item_terms.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= PAIRED)
    listed = often.groupBy("item", "item_block").agg(F.array_sort(F.collect_list("term")).alias("t"))
    first = listed.select("item_block", "t", F.posexplode("t").alias("i", "a"))
    return first.select("item_block", "a", F.explode(F.slice("t", F.col("i") + 2, F.lit(PAIRED))).alias("b")).distinct()


def ranked(
    index: DataFrame, items: DataFrame, k: int = 50, text: str = "text", keep: list[str] | None = None, doc_id: str = "doc_id"
) -> DataFrame:
    """The ``k`` best documents of ``index`` for every row of ``items``: the row, ``rank``, the document's id, ``score``.

    Only documents with a score above 0 are ranked; equal scores go by ascending
    id, documents without an id last. Documents that repeat an id are ranked each
    for themselves, rows of ``items`` too. Items without terms, and all items if
    no document has a term, give no rows. ``keep`` names the columns of ``items``
    to carry (default: all but the text); ``doc_id`` names the id in the result.
    """
    spark = items.sparkSession
    names = [c for c in (items.columns if keep is None else keep) if c not in {"rank", doc_id, "score"} and (keep or c != text)]
    documents = index.filter("term IS NULL")
    n, length = documents.filter("n_terms > 0").agg(F.count("*"), F.sum("n_terms")).first()
    stats = (n, length or 1)
    asked = stored(
        items.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
            F.array_distinct(F.regexp_extract_all(lower_ascii(text_of(text)), F.lit(f"({TERM})"), 1)).alias("terms"),
        ).withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    blocks = asked.count() // ITEM_BLOCK + 1
    own = asked.select("item", F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("item_block"), F.explode("terms").alias("term"))
    postings = stored(index.filter("term IS NOT NULL").drop("doc", "at", "n_terms").join(own.select("term").distinct(), "term"), "postings")
    df = postings.groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    item_terms = stored(own.join(df, "term").withColumn("w", weight(F.col("df"), n)).withColumn("floor", F.lit(0).cast("long")), "item-terms")
    item_pairs = stored(item_pairs_of(item_terms), "item-pairs")
    lists = pair_lists(postings, item_pairs.select("a", "b").distinct(), item_terms.select("term", "w").distinct(), stats)
    turn = F.pmod(F.xxhash64("block"), F.lit(FIRST_OF))
    first = stored(
        _searched(item_terms, item_pairs, postings.filter(turn == 0), lists.filter(turn == 0), stats, k), "first-found"
    )
    best = Window.partitionBy("item").orderBy(F.col("score").desc())
    floors = first.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") == k).select("item", F.col("score").alias("least"))
    raised = item_terms.join(floors, "item", "left").withColumn("floor", F.coalesce("least", "floor")).drop("least")
    found = first.unionByName(_searched(raised, item_pairs, postings.filter(turn != 0), lists.filter(turn != 0), stats, k))
    told = found.join(documents.select("block", "at", "doc"), ["block", "at"])
    rank = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last(), "block", "at")
    top = told.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return top.join(asked.select("item", "row"), "item").select("row.*", "rank", F.col("doc").alias(doc_id), "score")
