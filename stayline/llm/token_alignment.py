"""Alignment of the tokens of two tokenizers over the same text.

Where a token of A and a token of B end at the same byte, the text is cut; between
neighbouring cuts lies a group of tokens of both. Cuts are found by dividing: of an
interval between two known cuts, the end of an A token near its middle is looked up
among the ends of B by bisection, then the next one outward, until a common end
divides the interval in two. An interval without one is a leaf: a group. All
intervals of all texts of a batch are divided together, one probe each at a time.

The two tokens that end at a cut are linked. How often each pair of ids is linked is
counted over the whole corpus: links leave a task inverted, one row per pair and
block of documents, so that counts are joined to as many rows as a block has pairs,
not links.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from stayline.llm.common import per_process, stored, text_of, with_row
from stayline.llm.rolling import byte_slices, column_bytes
from stayline.llm.unit_memo import UnitEncoder, encoder_arguments

#: Bytes of text aligned at a time, unless one document has more.
SLICE = 1 << 20
#: Links held before a block is closed.
BLOCK_LINKS = 4_000_000


def byte_level_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies and the bytes they stand for: printable Latin-1 is itself, the rest follows from 256 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pieces:
    """The bytes of every id of a vocabulary, and those of many ids joined."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        n = self.sizes[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[ids] - (ends - n), n) + np.arange(total)].tobytes(), ends


def entries_of_json(encoder: UnitEncoder) -> list[bytes]:
    alphabet, size = byte_level_alphabet(), encoder.library.get_vocab_size(with_added_tokens=True)
    found = [b""] * size
    added = {i: t.content for i, t in encoder.library.get_added_tokens_decoder().items()}
    for token, i in encoder.library.get_vocab(with_added_tokens=True).items():
        found[i] = added[i].encode() if i in added else bytes(alphabet[c] for c in token)
    return found


def entries_of_model(model) -> list[bytes]:
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
        found.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return found


def shared_cuts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the ends they share; both ascend strictly and have the last end in common."""
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cuts_a, cuts_b = [np.array([len(a) - 1])], [np.array([len(b) - 1])]
    # tokens lo .. hi - 1 of A and blo .. bhi - 1 of B lie between two cuts; ``tried`` ends near the middle were not shared
    lo, hi, blo, bhi, tried = (np.array([x], np.int64) for x in (0, len(a), 0, len(b), 0))
    while True:
        inner = hi - lo - 1
        open_ = (tried < inner) & (bhi - blo > 1)
        lo, hi, blo, bhi, tried, inner = (x[open_] for x in (lo, hi, blo, bhi, tried, inner))
        if not len(lo):
            break
        probe = lo + (inner - 1) // 2 + np.where(tried % 2, (tried + 1) // 2, -(tried // 2))
        at = np.searchsorted(b, a[probe])
        hit = b[at] == a[probe]
        cut_a, cut_b = probe[hit], at[hit]
        cuts_a.append(cut_a)
        cuts_b.append(cut_b)
        # a divided interval gives way to its halves in its place: probes stay in order, which bisection likes
        place = np.repeat(np.arange(len(lo)), 1 + hit)
        first = np.flatnonzero(hit) + np.arange(len(cut_a))
        lo, hi, blo, bhi, tried = lo[place], hi[place], blo[place], bhi[place], np.where(hit, 0, tried + 1)[place]
        hi[first] = lo[first + 1] = cut_a + 1
        bhi[first] = blo[first + 1] = cut_b + 1
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


class Aligned(NamedTuple):
    """Tokens of several texts in a row; arrays with ``_ends`` have one entry per text."""

    a: np.ndarray
    b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    group_ends: np.ndarray


class Aligner:
    def __init__(self, arguments: tuple, model: str):
        import sentencepiece

        self.a = UnitEncoder(*arguments)
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        entries = [entries_of_json(self.a), entries_of_model(self.b)]
        self.bytes_a, self.bytes_b = map(Pieces, entries)
        # decimal ids with what follows them inside a group, and at its end
        self.told = np.array(
            [b"%d%s" % (i, sign) for own, last in zip(entries, (b"|", b";")) for i in range(len(own)) for sign in (b",", last)], object
        )

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B in a row with their numbers per text; none where the bytes of either are not those of the text."""
        spaced = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
        a, n_a = self.a.encode(spaced)
        lists = self.b.encode(texts.to_pylist(), num_threads=1)
        n_b = np.array([len(x) for x in lists], np.int64)
        b = np.fromiter(chain.from_iterable(lists), np.int32, int(n_b.sum()))
        raw, borders = column_bytes(spaced)
        raw = raw.tobytes()
        good = np.ones(len(texts), bool)
        for ids, n, pieces in ((a, n_a, self.bytes_a), (b, n_b, self.bytes_b)):
            whole, ends = pieces.joined(ids)
            stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n)])].tolist()
            good &= [whole[s:e] == raw[p:q] for s, e, p, q in zip(stops, stops[1:], borders.tolist(), borders[1:].tolist())]
        good &= np.diff(borders) > 1  # an empty text has no tokens
        return a[np.repeat(good, n_a)], np.where(good, n_a, 0), b[np.repeat(good, n_b)], np.where(good, n_b, 0)

    def align(self, texts: pa.Array) -> Aligned:
        a, n_a, b, n_b = self.tokens(texts)
        # texts end at a byte that both share, so all are divided as one
        cuts_a, cuts_b = shared_cuts(np.cumsum(self.bytes_a.sizes[a]), np.cumsum(self.bytes_b.sizes[b]))
        a_ends = np.cumsum(n_a)
        return Aligned(a, b, cuts_a, cuts_b, a_ends, np.cumsum(n_b), np.searchsorted(cuts_a, a_ends))

    def written(self, x: Aligned) -> list[bytes]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        if not len(x.a):
            return [b""] * len(x.a_ends)
        last_a, last_b = np.zeros(len(x.a), bool), np.zeros(len(x.b), bool)
        last_a[x.cuts_a] = True
        last_b[x.cuts_b] = True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        out = np.empty(len(x.a) + len(x.b), np.int64)
        out[np.arange(len(x.a)) + np.concatenate([[0], x.cuts_b + 1])[group_a]] = x.a * 2 + last_a
        out[np.arange(len(x.b)) + (x.cuts_a + 1)[group_b]] = (x.b + len(self.bytes_a.sizes)) * 2 + last_b
        ends = (x.a_ends + x.b_ends).tolist()
        return [b"".join(self.told[out[s:e]].tolist())[:-1] for s, e in zip([0, *ends], ends)]


DOCUMENT = {"block": "long", "at": "int", "n_a": "long", "n_b": "long", "n_groups": "long", "groups_sha256": "string",
            "groups": "array<struct<a:array<int>,b:array<int>>>"}
LINKS = {"pair": "long", "n": "long", "held": "array<struct<at:int,times:int>>"}


def _offsets(ends: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], ends]).astype(np.int32))


def _group_lists(x: Aligned) -> pa.Array:
    a = pa.ListArray.from_arrays(_offsets(x.cuts_a + 1), pa.array(x.a.astype(np.int32)))
    b = pa.ListArray.from_arrays(_offsets(x.cuts_b + 1), pa.array(x.b.astype(np.int32)))
    return pa.ListArray.from_arrays(_offsets(x.group_ends), pa.StructArray.from_arrays([a, b], names=["a", "b"]))


def link_rows(pair: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Distinct pairs with their number of links and the documents that hold them."""
    coded = pa.array(pair).dictionary_encode()
    distinct, place = coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)
    width = int(at.max()) + 1
    held, times = np.unique(place * width + at, return_counts=True)
    owner = held // width
    begins = np.searchsorted(owner, np.arange(len(distinct) + 1))
    lists = pa.ListArray.from_arrays(
        pa.array(begins.astype(np.int32)),
        pa.StructArray.from_arrays([pa.array((held % width).astype(np.int32)), pa.array(times.astype(np.int32))], names=["at", "times"]),
    )
    return distinct, np.bincount(place, minlength=len(distinct)), lists


def _align(arguments: tuple, model: str, schema: pa.Schema, with_groups: bool, with_links: bool):
    def filled(rows: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray]] = []
        at = n_links = 0

        def links() -> pa.RecordBatch:
            pair, n, lists = link_rows(*(np.concatenate(x) for x in zip(*held)))
            return filled(
                len(pair), block=pa.array(np.full(len(pair), block)), pair=pa.array(pair), n=pa.array(n),
                held=lists.cast(schema.field("held").type),
            )

        for batch in batches:
            texts = batch.column("text")
            for lo, hi in byte_slices(pc.binary_length(texts).to_numpy(zero_copy_only=False), SLICE):
                aligner = per_process(("aligner", model, *arguments), lambda: Aligner(arguments, model))
                x = aligner.align(texts.slice(lo, hi - lo))
                n_groups = np.diff(np.concatenate([[0], x.group_ends]))
                digests = [hashlib.sha256(w).hexdigest() if w else "" for w in aligner.written(x)]
                more = {"groups": _group_lists(x).cast(schema.field("groups").type)} if with_groups else {}
                yield filled(
                    hi - lo, row=batch.column("row").slice(lo, hi - lo), block=pa.array(np.full(hi - lo, block)),
                    at=pa.array(np.arange(at, at + hi - lo, dtype=np.int32)),
                    n_a=pa.array(np.diff(np.concatenate([[0], x.a_ends]))), n_b=pa.array(np.diff(np.concatenate([[0], x.b_ends]))),
                    n_groups=pa.array(n_groups), groups_sha256=pa.array(digests), **more,
                )
                if with_links and len(x.cuts_a):
                    pair = x.a[x.cuts_a].astype(np.int64) << 32 | x.b[x.cuts_b]
                    held.append((pair, np.repeat(np.arange(at, at + hi - lo), n_groups)))
                    n_links += len(pair)
                at += hi - lo
                if n_links >= BLOCK_LINKS:
                    yield links()
                    held.clear()
                    block, at, n_links = block + 1, 0, 0
        if held:
            yield links()

    return align


def _aligned(docs: DataFrame, json_path: str, model_path: str, text: str, names: list[str], with_groups: bool, with_links: bool) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), text_of(text).alias("text"))
    schema = with_row(rows, **DOCUMENT, **LINKS)
    schema["row"].nullable = True  # null in the rows of links
    run = _align(encoder_arguments(json_path, plain_specials=True), model_path, to_arrow_schema(schema), with_groups, with_links)
    return rows.mapInArrow(run, schema)


TOLD = ["n_a", "n_b", "n_groups", "groups_sha256"]


def alignments(
    docs: DataFrame, json_path: str, model_path: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """All rows of ``docs`` with the groups of tokens that both tokenizers cut alike.

    A is a byte-level ``.json`` tokenizer that encodes a space and the text, B a
    ``.model`` of sentencepiece that adds the space; special strings in texts are
    plain text. Adds ``n_a``, ``n_b`` and ``n_groups``, ``groups`` (ids ``a`` and
    ``b`` of each, in order) and ``groups_sha256`` over ``a1,a2|b1;a3|b2,b3``.
    Null and empty texts, and texts whose bytes the tokens of either do not give
    back, have no tokens: zeros, no groups and an empty ``groups_sha256``.
    Repeated rows are aligned alike. ``keep`` names the input columns to carry.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in {*TOLD, "groups"}]
    return _aligned(docs, json_path, model_path, text, names, True, False).select("row.*", *TOLD, "groups")


def b_of(pair: Column) -> Column:
    return pair.bitwiseAND(F.lit(0xFFFFFFFF))


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, times, best): links of every pair of ids, and whether no other A id is linked to its B id more often."""
    counts = stored(links.groupBy("pair").agg(F.sum("n").alias("times")), "pair-counts")
    most = counts.groupBy(b_of(F.col("pair")).alias("b")).agg(F.max("times").alias("most"))
    return counts.join(most, b_of(F.col("pair")) == F.col("b")).select("pair", "times", (F.col("times") == F.col("most")).alias("best"))


def linked_alignments(
    docs: DataFrame, json_path: str, model_path: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """All rows of ``docs`` with the figures of :func:`alignments` and of their links over the corpus.

    ``n_links`` counts cuts, each linking the two tokens that end there; the count
    of a pair of ids is its links in all rows. ``count_sum`` adds the counts of a
    row's links; ``n_best`` counts the links whose count is the highest of their
    B id, ties included. Rows without tokens have zeros.
    """
    added = [*TOLD, "n_links", "n_best", "count_sum"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    aligned = stored(_aligned(docs, json_path, model_path, text, names, False, True), "aligned")
    links = aligned.filter("pair IS NOT NULL").select("block", "pair", "n", "held")
    rows = aligned.filter("pair IS NULL").select("row", "block", "at", *TOLD)
    known = links.select("block", "pair", "held").join(pair_counts(links), "pair")
    # dealt out by block before the lists are opened, so their entries are summed where they are
    opened = known.repartition("block").select("block", "times", "best", F.explode("held").alias("one"))
    sums = opened.groupBy("block", F.col("one.at").alias("at")).agg(
        F.sum("one.times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("one.times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("one.times") * F.col("times")).alias("count_sum"),
    )
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")}
    return rows.join(sums, ["block", "at"], "left").select("row.*", *TOLD, *zero.values())
