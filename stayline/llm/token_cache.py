"""Token counts behind a digest cache.

Normalised content and tokenizer version are digested; counts already stored
under the pair of digests are joined, only distinct misses are encoded, and
their counts are appended to the cache.

Normalisation is limited to what cannot change a count: a null is the empty
text. Texts that differ in case or spacing have digests of their own, because
special strings are matched before a tokenizer folds case.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import new_folder, packed, stored, text_of, unpacked

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"

#: Pre-token counts a task remembers before it starts anew.
MEMO_LIMIT = 100_000


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file: another file, another version."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


class Counter:
    """Counts tokens of whole texts with the library that the file is for."""

    def __init__(self, path: str, by_word: bool = False, special: tuple[str, ...] = ()):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.many = lambda texts: [len(x) for x in self.model.encode(texts, num_threads=1)] if texts else []
            return
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.many = self.by_word if by_word else self.by_text
        self.memo: dict[str, int] = {}
        # other engines do not count the control characters 1C-1F as white space
        self.unusual = re.compile("|".join([*map(re.escape, special), "[\x1c-\x1f]"]))

    def by_text(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def by_word(self, texts: list[str]) -> list[int]:
        """Words between spaces never share a token, so each word is encoded once and remembered."""
        if len(self.memo) > MEMO_LIMIT:
            self.memo.clear()
        memo, tokenize = self.memo, self.whole.model.tokenize
        odd = {i for i, t in enumerate(texts) if self.unusual.search(t)}
        words = [[] if i in odd else t.split() for i, t in enumerate(texts)]
        rest: dict[str, None] = {}
        ended: list[tuple[str, str, str]] = []
        for word in {w for ws in words for w in ws if w not in memo}:
            core = word.rstrip(".,;:!?")
            if core.isascii() and core.isalpha():
                tail = word[len(core) :]
                if not tail:
                    memo[word] = len(tokenize(core.lower()))
                    continue
                for part in (core, tail):
                    if part not in memo:
                        if part is tail:
                            rest[tail] = None
                        else:
                            memo[core] = len(tokenize(core.lower()))
                ended.append((word, core, tail))
            else:
                rest[word] = None
        for word, n in zip(rest, self.by_text(list(rest)), strict=True):
            memo[word] = n
        for word, core, tail in ended:
            memo[word] = memo[core] + memo[tail]
        counts = [sum(map(memo.__getitem__, ws)) for ws in words]
        for i in odd:
            counts[i] = self.by_text([texts[i]])[0]
        return counts


def splits_at_spaces(spec: dict) -> bool:
    """Whether white space ends a pre-token and letters and marks never share one."""
    parts = (spec.get("normalizer") or {}).get("normalizers", [])
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = cuts[0] if cuts else {}
    return (
        [p["type"] for p in parts] == ["NFC", "Replace", "Lowercase"]
        and parts[1]["content"] == " "
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and (first["behavior"], first["invert"]) == ("Removed", True)
        and not cuts[1]["add_prefix_space"]
        and first["pattern"]["Regex"].endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    )


def counter_arguments(path: str) -> tuple:
    """What :class:`Counter` needs to know of a vocabulary file, read once on the driver."""
    if path.endswith(".model"):
        return (path,)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return path, splits_at_spaces(spec), tuple(t["content"] for t in spec["added_tokens"])


def _encoder(arguments: tuple):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            if not batch.num_rows:
                continue
            counter = counter or Counter(*arguments)
            counts: list[int] = []
            texts = batch.column("text")
            for start in range(0, batch.num_rows, 100):
                counts += counter.many(texts.slice(start, 100).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array(counts, pa.int64())], names=["content", "n_tokens"]
            )

    return encode


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """One row per content; a folder that does not exist yet is an empty cache."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    cache = (
        spark.read.schema(CACHE_SCHEMA).parquet(folder) if there else spark.createDataFrame([], CACHE_SCHEMA)
    )
    # two runs may have appended the same content
    return cache.filter(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def add_misses(docs: DataFrame, folder: str, path: str, text: str = "text") -> None:
    """Encode the distinct texts that the cache lacks and append their counts."""
    spark = docs.sparkSession
    version = tokenizer_version(path)
    texts = docs.select(text_of(text).alias("text")).withColumn("content", content_digest(F.col("text")))
    # copies are reduced before the exchange, so a hot text is one row per task
    missing = (
        texts.join(read_cache(spark, folder, version), "content", "left_anti")
        .groupBy("content")
        .agg(F.first("text").alias("text"))
    )
    (
        missing.mapInArrow(_encoder(counter_arguments(path)), "content binary, n_tokens long")
        .select("content", F.lit(version).alias("tokenizer"), "n_tokens")
        .write.mode("append")
        .parquet(folder)
    )


def token_counts(docs: DataFrame, path: str, cache: str | None = None, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``n_tokens``.

    ``path`` names a ``.json`` file of the tokenizers library or a ``.model`` of
    sentencepiece, present on every executor. ``cache`` is a folder that keeps
    counts between runs; None starts an empty one. Null and empty texts have 0
    tokens, repeated rows each get their count, an empty table stays empty. A
    column ``n_tokens`` of the input is replaced.
    """
    spark = docs.sparkSession
    folder = cache or new_folder(spark, "token-cache")
    add_misses(docs, folder, path, text)
    kept = docs.drop("n_tokens")
    rows = packed(kept, content=content_digest(text_of(text)))
    # a stored side leaves the join between two plain exchanges, so Spark can split a hot text
    counts = stored(read_cache(spark, folder, tokenizer_version(path)), "counts")
    return unpacked(rows.join(counts, "content", "left"), F.col("n_tokens"))
