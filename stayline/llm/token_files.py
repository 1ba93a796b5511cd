"""Token ids in binary files that give random access to every token.

Documents are dealt out by ranges of their id; each task encodes its range in order
and writes shards. A shard holds the ids of its documents as directly addressable
codes (:mod:`direct_codes`) and a table of the documents. The manifest has one row
per shard with the number of the first id, so a token's place in the whole corpus
leads to one shard and one place in it.

File: 8 bytes of magic, 8 bytes with the length of a JSON head, the head, then the
sections it lists: four for each level and the table of documents in Arrow's format.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm import direct_codes
from stayline.llm.common import new_folder, partitions, stored, text_of
from stayline.llm.unit_memo import encoder_arguments, unit_encoder
from stayline.llm.warc import open_to_read, put

MAGIC = b"DACIDS01"
#: Ids of a shard, unless one document has more.
SHARD_IDS = 1 << 22
MANIFEST = "part int, shard int, path string, n_docs long, n_ids long, n_bytes long"


def shard_bytes(ids: np.ndarray, docs: pa.Table) -> list[bytes]:
    levels, sections = direct_codes.encode(ids)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_table(docs)
    sections.append(sink.getvalue().to_pybytes())
    ends = np.cumsum([len(s) for s in sections]).tolist()
    head = json.dumps({"levels": levels, "starts": [0, *ends[:-1]], "ends": ends}).encode()
    return [MAGIC, len(head).to_bytes(8, "little"), head, *sections]


class Shard:
    """An open shard: ``codes`` reads ids by place, ``documents`` the table (row, n_tokens)."""

    def __init__(self, path: str):
        self.file = open_to_read(path)
        if self.file.read(8) != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        size = int.from_bytes(self.file.read(8), "little")
        self.head = json.loads(self.file.read(size))
        self.base = 16 + size
        self.codes = direct_codes.Codes(self.head["levels"], self.section)

    def section(self, number: int, lo: int, hi: int) -> bytes:
        start, end = self.head["starts"][number], self.head["ends"][number]
        hi = min(hi, end - start)
        self.file.seek(self.base + start + lo)
        data = self.file.read(hi - lo)
        if len(data) != hi - lo:
            raise EOFError("the file of token ids is cut short")
        return data

    def documents(self) -> pa.Table:
        last = len(self.head["ends"]) - 1
        return pa.ipc.open_stream(self.section(last, 0, 1 << 62)).read_all()

    def __enter__(self) -> Shard:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def with_end(ids: np.ndarray, n: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each document's ids."""
    if end_id is None:
        return ids, n
    out = np.empty(len(ids) + len(n), np.int32)
    last = np.zeros(len(out), bool)
    last[np.cumsum(n + 1) - 1] = True
    out[last] = end_id
    out[~last] = ids
    return out, n + 1


def _writer(folder: str, arguments: tuple, end_id: int | None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        size = 0

        def sent() -> pa.RecordBatch:
            ids, n, rows = zip(*held)
            ids, n = np.concatenate(ids), np.concatenate(n)
            docs = pa.table({"row": pa.chunked_array(rows), "n_tokens": pa.array(n)})
            name = f"part-{part:06d}-{shard:06d}.ids"
            written = put(folder, name, iter(shard_bytes(ids, docs)))
            values = [part, shard, f"{folder}/{name}", len(n), len(ids), written]
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types)], names=[x.split()[0] for x in MANIFEST.split(", ")]
            )

        for batch in batches:
            for lo in range(0, batch.num_rows, 2_000):
                piece = batch.slice(lo, 2_000)
                ids, n = with_end(*unit_encoder(arguments).encode(piece.column("text")), end_id)
                held.append((ids, n, piece.column("row")))
                size += len(ids)
                if size >= SHARD_IDS:
                    yield sent()
                    held.clear()
                    shard, size = shard + 1, 0
        if held:
            yield sent()

    return write


def write_ids(
    docs: DataFrame, path: str, folder: str | None = None, end_id: int | None = 2, text: str = "text",
    order: str = "doc_id", keep: list[str] | None = None,
) -> DataFrame:
    """Write the token ids of every row, ascending by ``order``; the manifest comes back.

    ``path`` is a ``.json`` file of the tokenizers library that lies on every
    executor; no special tokens are added but ``end_id`` after each document
    (None: nothing). ``keep`` names the columns the shards carry (default: all
    but the text). A null text is empty and has the end id alone. Rows without an
    id come first; rows with equal ids go by the hash of their text, so equal
    rows are interchangeable. An empty table gives an empty manifest.

    Manifest: ``part`` and ``shard`` (their order is the order of the corpus),
    ``path``, ``n_docs``, ``n_ids``, ``n_bytes``, and ``first_doc`` and
    ``first_id``, the documents and ids in all shards before.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-ids")
    names = [c for c in docs.columns if c != text] if keep is None else keep
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col(f"`{order}`").alias("place"),
        text_of(text).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    ranged = rows.repartitionByRange(partitions(spark), "place", "tie").sortWithinPartitions("place", "tie")
    written = ranged.select("row", "text").mapInArrow(_writer(folder, encoder_arguments(path), end_id), MANIFEST)
    return numbered(stored(written, "shards"))


def numbered(shards: DataFrame) -> DataFrame:
    """Shards with what stands before them: sums per part, of which there are as many as tasks, then within each part."""
    parts = {
        r["part"]: (r["docs"], r["ids"])
        for r in shards.groupBy("part").agg(F.sum("n_docs").alias("docs"), F.sum("n_ids").alias("ids")).collect()
    }
    before, docs, ids = [], 0, 0
    for part in sorted(parts):
        before.append((part, docs, ids))
        docs, ids = docs + parts[part][0], ids + parts[part][1]
    spark = shards.sparkSession
    base = spark.createDataFrame(before, "part int, docs_before long, ids_before long")
    earlier = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    told = (
        shards.join(base, "part")
        .withColumn("first_doc", F.col("docs_before") + F.coalesce(F.sum("n_docs").over(earlier), F.lit(0)))
        .withColumn("first_id", F.col("ids_before") + F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
        .drop("docs_before", "ids_before")
    )
    return stored(told, "id-manifest")


READ = "start long, n_tokens long, ids_crc32 long, ids array<int>"


def _reader(with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("first_id").to_pylist()):
                with Shard(path) as shard:
                    yield from _documents(shard, start, with_ids)

    return read


def _documents(shard: Shard, first_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    docs = shard.documents()
    ends = np.cumsum(docs.column("n_tokens").to_numpy())
    at, place = 0, 0
    while at < len(ends):
        # as many documents as make about a step of ids, one at least
        upto = max(at + 1, int(np.searchsorted(ends, place + direct_codes.STEP, side="right")))
        ids = shard.codes.range(place, int(ends[upto - 1])).astype("<u4")
        cuts = np.concatenate([[0], ends[at:upto] - place])
        starts = first_id + place + cuts[:-1]
        crc = [zlib.crc32(ids[a:b].data) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32)))
        yield pa.RecordBatch.from_arrays(
            [
                docs.column("row").slice(at, upto - at).combine_chunks(), pa.array(starts), pa.array(np.diff(cuts)),
                pa.array(crc, pa.int64()), lists if with_ids else pa.nulls(upto - at, lists.type),
            ],
            names=["row", "start", "n_tokens", "ids_crc32", "ids"],
        )
        place, at = int(ends[upto - 1]), upto


def read_documents(manifest: DataFrame, carried: T.StructType, with_ids: bool = True) -> DataFrame:
    """One row per document, read from the shards: the columns it carries, ``start``, ``n_tokens``, ``ids_crc32``, ``ids``.

    ``carried`` is the schema of the columns kept by :func:`write_ids`. ``start``
    counts the ids of all documents before, ``ids_crc32`` covers the ids as
    little-endian unsigned 32-bit numbers; ``ids`` is left out where ``with_ids``
    is off.
    """
    schema = T.StructType([T.StructField("row", carried), *T.StructType.fromDDL(READ).fields])
    shards = manifest.filter("n_docs > 0").select("path", "first_id")
    dealt = shards.repartition(max(partitions(manifest.sparkSession), 1), "path")
    added = ["start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return dealt.mapInArrow(_reader(with_ids), schema).select("row.*", *added)


def _picker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens at single places; rows of a shard follow each other."""
    path, shard = None, None
    for batch in batches:
        found = []
        for p, at in zip(batch.column("path").to_pylist(), batch.column("at").to_pylist()):
            if p != path:
                if shard:
                    shard.file.close()
                path, shard = p, Shard(p)
            found.append(shard.codes.get(at))
        yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(found, pa.int32())], names=["position", "id"])
    if shard:
        shard.file.close()


def tokens_at(manifest: DataFrame, wanted: DataFrame, position: str = "position") -> DataFrame:
    """(position, id) for places in the whole corpus, each read from its shard without decoding what surrounds it.

    Places outside the corpus and nulls give no row, repeated places one row
    each. Shards and places meet on stretches of the corpus, so any number of
    either can be joined.
    """
    stop = F.col("first_id") + F.col("n_ids")
    shards = manifest.filter("n_ids > 0").select(
        "path", "first_id", stop.alias("stop"),
        F.explode(F.sequence(F.floor(F.col("first_id") / SHARD_IDS), F.floor((stop - 1) / SHARD_IDS))).alias("stretch"),
    )
    places = wanted.select(F.col(f"`{position}`").cast("long").alias("position")).filter("position >= 0")
    met = places.withColumn("stretch", F.floor(F.col("position") / SHARD_IDS)).join(shards, "stretch")
    inside = met.filter("position >= first_id AND position < stop").select(
        "path", (F.col("position") - F.col("first_id")).alias("at"), "position"
    )
    dealt = inside.repartition(partitions(manifest.sparkSession), "path", F.floor(F.col("at") / (SHARD_IDS // 64)))
    return dealt.sortWithinPartitions("path", "at").mapInArrow(_picker, "position long, id int")
