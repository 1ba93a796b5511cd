"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most four bits have a word between them that
differs from each in at most two. So every distinct fingerprint emits all its
variants with up to two flipped bits, variants are shuffled, and fingerprints
that share a variant are linked. Fingerprints that share a variant differ in at
most four bits of one another, so the members of a bucket are linked to its
smallest member only; a bucket holds no more distinct fingerprints than a ball
has words (2,081), however many documents there are.

Before that, fingerprints that can have no partner are put aside by the same
idea on part of the word: of three blocks of bits two together hold at most two
of four differing bits, so partners share a variant with one flipped bit of two
blocks. Variants travel packed: per fingerprint and target partition one row
with the numbers of the flips, about two bytes a variant.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import stored, text_of, with_row
from stayline.llm.components import roots

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Variants one reducing task sorts in memory.
TASK_VARIANTS = 1_000_000
#: Fingerprints whose variants are packed together.
SLICE = 500
#: Bits of the three blocks.
BLOCKS = (22, 21, 21)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str) -> int:
    """Unsigned SimHash: a bit is set if over half of the shingle hashes have it; 0 without words."""
    words = text.encode().translate(LOWER).split()  # splits at ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65_536):
        part = np.array(hashes[lo : lo + 65_536], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = (counts * 2 > len(hashes)).astype(np.uint64)
    return int((set_bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(values)], names=["row", "fp"])


def flips(bits: list[int], most: int) -> np.ndarray:
    """All words with at most ``most`` of the given bits set."""
    return np.array([sum(1 << b for b in some) for n in range(most + 1) for some in combinations(bits, n)], np.uint64)


def block_pairs() -> list[tuple[int, np.ndarray]]:
    """Mask of two blocks and the flips of one bit in them, for every two blocks."""
    edges = np.cumsum([0, *BLOCKS])
    blocks = [list(range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [(sum(1 << x for x in a + b), flips(a + b, 1)) for a, b in combinations(blocks, 2)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble, so that close words fall to unlike partitions."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return np.array(batch.column(column), np.int64).view(np.uint64)


def _block_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = block_pairs()
    for batch in batches:
        for lo in range(0, batch.num_rows, 2_000):
            fp = _words(batch.slice(lo, 2_000), "fp")
            for number, (mask, flip) in enumerate(pairs):
                keys = mixed(((fp & np.uint64(mask))[:, None] ^ flip[None, :]) + np.uint64(number * 0x9E3779B97F4A7C15 % 2**64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fp, len(flip)).view(np.int64))],
                    names=["key", "fp"],
                )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct fingerprints of this task's keys that share a key with another one."""
    parts = [(_words(b, "key"), _words(b, "fp")) for b in batches if b.num_rows]
    if not parts:
        return
    key, fp = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.argsort(key)
    key, fp = key[order], fp[order]
    same = key[1:] == key[:-1]
    hit = np.zeros(len(key), bool)
    hit[1:] |= same
    hit[:-1] |= same
    yield pa.RecordBatch.from_arrays([pa.array(np.unique(fp[hit]).view(np.int64))], names=["fp"])


def _ball_variants(buckets: int):
    """One row per bucket and slice of fingerprints: which of them have variants there, how many, and their flips."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flip = flips(list(range(64)), RADIUS // 2)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                fp = _words(batch.slice(lo, SLICE), "fp")
                to = (mixed(fp[:, None] ^ flip[None, :]) % np.uint64(buckets)).astype(np.int64).ravel()
                order = np.argsort(to, kind="stable")
                bucket, owner, number = to[order], order // len(flip), (order % len(flip)).astype(np.int16)
                run = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])]))
                used = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                by_run = pa.array(np.append(np.searchsorted(run, used), len(run)).astype(np.int32))
                by_variant = pa.array(np.append(used, len(bucket)).astype(np.int32))
                times = np.diff(np.append(run, len(bucket))).astype(np.int16)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[used].astype(np.int32)),
                        pa.ListArray.from_arrays(by_run, pa.array(fp[owner[run]].view(np.int64))),
                        pa.ListArray.from_arrays(by_run, pa.array(times)),
                        pa.ListArray.from_arrays(by_variant, pa.array(number)),
                    ],
                    names=["bucket", "fps", "times", "flips"],
                )

    return emit


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from the members of each variant to the smallest of them, verified."""
    flip = flips(list(range(64)), RADIUS // 2)
    fps, variants = [], []
    for batch in batches:
        if batch.num_rows:
            fp = np.array(batch.column("fps").flatten(), np.int64).view(np.uint64)
            fp = np.repeat(fp, np.array(batch.column("times").flatten()))
            fps.append(fp)
            variants.append(fp ^ flip[np.array(batch.column("flips").flatten())])
    if not fps:
        return
    fp, variant = np.concatenate(fps), np.concatenate(variants)
    del fps, variants
    order = np.argsort(variant)
    variant, fp = variant[order], fp[order]
    first = np.concatenate([[True], variant[1:] != variant[:-1]])
    shared = ~first | np.concatenate([~first[1:], [False]])
    fp, first = fp[shared], first[shared]
    starts = np.flatnonzero(first)
    if len(starts):
        least = np.minimum.reduceat(fp, starts)
        least = np.repeat(least, np.diff(np.append(starts, len(fp))))
        near = (fp != least) & (np.bitwise_count(fp ^ least) <= RADIUS)
        links = np.unique(np.column_stack([fp[near], least[near]]), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(links[:, 0].view(np.int64)), pa.array(links[:, 1].view(np.int64))], names=["u", "v"]
        )


def links(fingerprints: DataFrame) -> DataFrame:
    """Links (u, v) that connect distinct fingerprints ``fp`` as all pairs within the radius would."""
    keys = fingerprints.mapInArrow(_block_variants, "key long, fp long")
    paired = stored(
        keys.repartition("key").mapInArrow(_shared, "fp long").distinct(), "paired"
    )
    n = paired.count()
    # both follow from the number of fingerprints, so rows are slices x buckets whatever the partitioning
    buckets = n * len(flips(list(range(64)), RADIUS // 2)) // TASK_VARIANTS + 1
    slices = paired.repartition(n // (4 * SLICE) + 1)
    balls = slices.mapInArrow(_ball_variants(buckets), "bucket int, fps array<long>, times array<smallint>, flips array<smallint>")
    return balls.repartitionById(buckets, "bucket").mapInArrow(_linked, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with ``fingerprint``, ``component_id`` and ``component_key``.

    ``keep`` names the input columns to carry (default: all). ``component_id`` is
    the smallest id among the documents that can be reached over links of at most
    four differing bits, null if none of them has an id; ``component_key`` names
    the component by its smallest fingerprint. Null and empty texts have
    fingerprint zero and are linked like others. Repeated rows share a component.
    """
    added = ["fingerprint", "component_id", "component_key"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(
        F.struct(F.struct(*[F.col(f"`{c}`") for c in names]).alias("own"), F.col(f"`{doc_id}`").alias("id")).alias("row"),
        text_of(text).alias("text"),
    )
    marked = stored(rows.mapInArrow(_fingerprints, with_row(rows, fp="long")), "fingerprints")
    by_print = stored(marked.groupBy("fp").agg(F.min("row.id").alias("least")), "distinct")
    root = roots(links(by_print.select("fp")))
    known = by_print.join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    component = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(known.select("fp", "root").join(component, "root"), "components")
    return marked.join(named, "fp").select(
        "row.own.*",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("root").alias("component_key"),
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The columns of ``docs`` with one row of each component: one with the smallest id."""
    found = near_duplicates(docs, text, doc_id)
    least = found.filter(F.col(f"`{doc_id}`").eqNullSafe(F.col("component_id")))
    # a component has several such rows only where its smallest id is repeated or missing
    return least.dropDuplicates(["component_key"]).select(*docs.columns)
