"""Token files: codes, the encoder by units, round trips and random access."""

import json
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stayline.llm import catalog, direct_codes, token_files, unit_memo

WORDS, BYTES = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
#: What units can go wrong on: blanks of all kinds, contractions, special strings, other scripts, marks.
BITS = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "Don't", "'s", "''re", "ÉÍß", "İ", "ﬁ", "é", "日本", "12", "½", "Σας",
        "<|endoftext|>", "x.", "...", "²", "µ", "🙂", "‍", "_", "the", "The9Éa3", "1a", "\x00", "\x7f", "́", "×"]


@lru_cache
def library(path, plain=False):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = plain
    return lambda s: t.encode(s, add_special_tokens=False).ids


@lru_cache
def encoder_of(path, plain):
    return unit_memo.UnitEncoder(*unit_memo.encoder_arguments(path, plain))


@pytest.mark.parametrize(("path", "plain"), [(WORDS, False), (BYTES, True), (BYTES, False)])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(BITS), max_size=14).map("".join), max_size=6))
def test_units_give_the_ids_of_the_library(path, plain, texts):
    encode = library(path, plain)
    ids, n = encoder_of(path, plain).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == [encode(t) for t in texts]


def test_units_of_long_texts(odd_texts, monkeypatch):
    monkeypatch.setattr(unit_memo, "MEMO_UNITS", 50)
    texts = [t for t in odd_texts if t is not None] + ["z" * 9_000, ("word's  end\n \n" * 900)]
    for path in (WORDS, BYTES):
        arguments = unit_memo.encoder_arguments(path, path == BYTES)
        assert arguments[1] == (unit_memo.LEADING if path == BYTES else unit_memo.DROPPED)
        encoder = unit_memo.UnitEncoder(*arguments)
        monkeypatch.setattr(unit_memo.pieces, "__defaults__", (300,))
        ids, n = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == [library(path, path == BYTES)(t) for t in texts]


@pytest.mark.parametrize(("path", "plain"), [(WORDS, False), (BYTES, True)])
def test_latin_letters_are_mapped_as_the_library_does(path, plain):
    encode = library(path, plain)
    letters = [f"{chr(c) * 2}n {chr(c)}" for c in unit_memo.LATIN]
    ids, n = encoder_of(path, plain).encode(pa.array(letters))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == [encode(x) for x in letters]


def test_unknown_rules_take_whole_texts(tmp_path):
    spec = json.load(open(WORDS))
    spec["normalizer"]["normalizers"][1]["pattern"] = {"Regex": "x"}
    (tmp_path / "t.json").write_text(json.dumps(spec))
    arguments = unit_memo.encoder_arguments(str(tmp_path / "t.json"))
    assert arguments[1] == unit_memo.WHOLE
    ids, n = unit_memo.UnitEncoder(*arguments).encode(pa.array(["a b", ""]))
    assert (ids.tolist(), n.tolist()) == (library(str(tmp_path / "t.json"))("a b"), [2, 0])


def coded(ids):
    levels, sections = direct_codes.encode(np.array(ids, np.uint32))
    return direct_codes.Codes(levels, lambda s, a, b: sections[s][a:b])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=300), st.data())
def test_codes_give_any_range(ids, data):
    codes = coded(ids)
    lo = data.draw(st.integers(0, len(ids)))
    hi = data.draw(st.integers(lo, len(ids)))
    assert codes.range(lo, hi).tolist() == ids[lo:hi]


def test_codes_over_many_blocks():
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.zipf(1.3, 60_000), 49_000).astype(np.uint32)
    codes = coded(ids)
    assert len(codes.levels) > 1 and (codes.range(0, len(ids)) == ids).all()
    for at in [0, 1, 63, 64, 4095, 4096, 59_999, *rng.integers(0, len(ids), 300)]:
        assert codes.get(int(at)) == ids[at]
    bits = sum(level["n"] * level["width"] for level in codes.levels)
    assert bits < 16 * len(ids)
    with pytest.raises(IndexError):
        codes.get(len(ids))


def expected(rows, end=2):
    """Rows in order with their ids: no id first, then by id; equal ids in any order."""
    encode = library(WORDS)
    return [(r["doc_id"], r["score"], encode(r["text"] or "") + [end]) for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))]


def test_round_trip(odd_docs, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 5_000)
    manifest = token_files.write_ids(odd_docs, WORDS, keep=odd_docs.columns)
    assert manifest.count() > 3
    got = sorted(token_files.read_documents(manifest, odd_docs.schema).collect(), key=lambda r: r["start"])
    want = expected(odd_docs.collect())
    by_score = {score: ids for _, score, ids in want}
    assert [r["doc_id"] for r in got] == [d for d, _, _ in want]
    at = 0
    for r in got:
        ids = by_score[r["score"]]
        assert (r["start"], r["n_tokens"], r["ids"]) == (at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    flat = [i for r in got for i in r["ids"]]
    spark = odd_docs.sparkSession
    places = [0, 1, 1, 77, len(flat) - 1, len(flat), -1, None, *range(0, len(flat), 997)]
    picked = token_files.tokens_at(manifest, spark.createDataFrame([(p,) for p in places], "position long")).collect()
    inside = [p for p in places if p is not None and 0 <= p < len(flat)]
    assert sorted((r["position"], r["id"]) for r in picked) == sorted((p, flat[p]) for p in inside)


def test_without_rows(no_docs):
    manifest = token_files.write_ids(no_docs, WORDS)
    assert manifest.count() == 0
    assert token_files.read_documents(manifest, no_docs.drop("text").schema).count() == 0


def test_query_against_the_library(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    got = catalog.op11_token_files(spark, small).collect()
    encode, at = library(WORDS), 0
    want = []
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        ids = encode(r["text"] or "") + [2]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got)) == want
