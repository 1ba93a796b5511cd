"""Token counts, license scans, quality rules."""

import re
from collections import Counter

import public_tokenizers
import pytest
from llm_helpers import WORD, lower_ascii, prose

from stayline.llm import licenses, quality_rules, token_cache

JSON = public_tokenizers.path("word_bpe_49k.json")


def library_counts(texts, path=JSON):
    if path.endswith(".model"):
        import sentencepiece

        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    from tokenizers import Tokenizer

    return [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_are_the_librarys(odd_docs, odd_texts, file):
    path = public_tokenizers.path(file)
    rows = token_cache.token_counts(odd_docs, path).collect()
    expected = dict(zip(range(len(odd_texts)), library_counts([t or "" for t in odd_texts], path)))
    assert len(rows) == len(odd_texts)
    assert all(r["n_tokens"] == expected[r["score"]] for r in rows)
    assert rows[0].asDict().keys() == {*odd_docs.columns, "n_tokens"}


def test_words_counted_one_by_one_agree_with_whole_texts():
    words = ["Hello,world", "it's", "'S", "x²", "ΣΑΣ", "İstanbul", "naïve!?", "áb", "…", "don't.", "a.b,c", "１２"]
    texts = [" ".join(words[i:] + words[:i]) for i in range(len(words))] + ["a b c　d", "﻿x  y"]
    counter = token_cache.Counter(*token_cache.counter_arguments(JSON))
    assert counter.many(texts) == library_counts(texts)


def test_cache_is_used_and_extended(spark, odd_docs, tmp_path):
    folder = str(tmp_path / "cache")
    token_cache.add_misses(odd_docs, folder, JSON)
    size = spark.read.parquet(folder).count()
    assert size == odd_docs.na.fill({"text": ""}).select("text").distinct().count()
    token_cache.add_misses(odd_docs, folder, JSON)
    assert spark.read.parquet(folder).count() == size
    version = token_cache.tokenizer_version(JSON)
    forged = spark.read.parquet(folder).selectExpr("content", "tokenizer", "n_tokens + 1000 AS n_tokens")
    forged.write.parquet(str(tmp_path / "forged"))
    counted = token_cache.token_counts(odd_docs, JSON, str(tmp_path / "forged"))
    assert counted.agg({"n_tokens": "min"}).first()[0] >= 1000 and version


def test_token_counts_of_no_rows(no_docs):
    assert token_cache.token_counts(no_docs, JSON).count() == 0


def base_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))
    found = [
        (i, t.label)
        for t in licenses.TEMPLATES
        if t.exact
        for i in range(len(words))
        if words[i : i + len(t.words.split())] == t.words.split()
    ]
    return len(words), found


def test_license_base_places(odd_docs, odd_texts):
    rows = {r["score_in"]: r for r in licenses.scan_licenses(odd_docs.withColumnRenamed("score", "score_in")).collect()}
    assert len(rows) == len(odd_texts)
    for i, text in enumerate(odd_texts):
        n, found = base_places(text)
        places = [p for p, _ in found]
        got = rows[i]
        assert (got["n_words"], got["n_base"]) == (n, len(found))
        assert (got["first_word"], got["last_word"]) == (min(places, default=None), max(places, default=None))
        assert got["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert 0 <= got["score"] <= 1 and set(got["base_labels"].split(",")) <= set(got["labels"].split(","))


def test_neighbouring_diagonals_are_merged(spark):
    whole = "licensed under the gnu general public license version 3"
    cut = "Notice: LICENSED UNDER the really GNU General Public License, version 3 applies"
    apart = "licensed under the gnu. " + "word " * 30 + "general public license version 3"
    rows = spark.createDataFrame([(1, whole), (2, cut), (3, apart), (4, "gnu general")], "id int, text string")
    got = {r["id"]: r for r in licenses.scan_licenses(rows).collect()}
    assert got[1]["labels"] == "gpl-3" and got[1]["score"] == 1 and got[1]["spans"][0]["stop"] == 9
    assert 0 < got[2]["score"] < 1
    assert got[3]["labels"] == "" and got[4]["score"] == 0


def test_license_scan_of_no_rows(no_docs):
    assert licenses.scan_licenses(no_docs).count() == 0


def counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(grams)
    inside = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
    }


def test_quality_rule_counts(odd_docs, odd_texts):
    rows = {r["score"]: r for r in quality_rules.quality_rules(odd_docs).collect()}
    assert len(rows) == len(odd_texts)
    for i, text in enumerate(odd_texts):
        expected = counts(text)
        got = rows[i]
        assert {k: got[k] for k in expected} == expected, i
        failed = expected["n_words"] < 20 or 100 * expected["n_repeat_words"] > 30 * expected["n_words"]
        assert got["base_failed"] == failed and not (failed and got["kept"])


def test_thresholds_follow_the_group(spark):
    """What is usual in one source is an outlier in another."""
    plain = [(i, prose(i, 60), "en", "plain") for i in range(80)]
    code = [(100 + i, prose(i, 60).replace(" ", " <b> ", 25), "en", "code") for i in range(80)]
    odd = [(500, code[0][1], "en", "plain")]
    rows = spark.createDataFrame(plain + code + odd, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(rows, keep=["doc_id"]).collect()}
    assert not kept[500] and all(v for k, v in kept.items() if k != 500)


def test_sketches_merge_by_addition(spark, odd_docs):
    text = odd_docs.selectExpr("lang", "source", "1.0 * length(text) AS symbol_rate", "0.1 AS word_length", "0.2 AS dup_line_rate", "0.3 AS repeat_rate", "0.0 AS upper_rate").na.fill(0.0)
    whole = quality_rules.sketch(text)
    halves = quality_rules.sketch(text.filter("symbol_rate < 50")).union(quality_rules.sketch(text.filter("symbol_rate >= 50")))
    merged = quality_rules.merged(halves, "lang", "source")
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_quality_rules_of_no_rows(no_docs):
    assert quality_rules.quality_rules(no_docs).count() == 0


def fence_of(values, spread):
    """Upper quartile plus four distances, of values as bins round them."""
    import math

    bins = sorted(math.floor(math.log(max(v, quality_rules.LEAST_RATE) / quality_rules.LEAST_RATE) / math.log(quality_rules.BIN_GROWTH)) for v in values)
    at = lambda q: bins[math.ceil(q * len(bins)) - 1]
    value = lambda b: 0.0 if b <= 0 else quality_rules.LEAST_RATE * quality_rules.BIN_GROWTH ** (b + 0.5)
    mid, high = value(at(0.5)), value(at(0.75))
    return high + quality_rules.REACH * max(high - mid, spread)


def test_verdicts_follow_from_the_rates(spark):
    """``kept`` worked out again: fences of a document's language and source, of its language, or of all."""
    rows = [r.asDict() for r in quality_rules.quality_rules(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()]
    verdicts = set()
    for r in rows:
        own = [x for x in rows if (x["lang"], x["source"]) == (r["lang"], r["source"])]
        if len(own) < quality_rules.LEAST_DOCS:
            own = [x for x in rows if x["lang"] == r["lang"]]
        if len(own) < quality_rules.LEAST_DOCS:
            own = rows
        fences = r.setdefault("fences", {k: fence_of([x[k] for x in own], s) for k, s in quality_rules.LEAST_SPREAD.items()})
        assert all(abs(r[f"max_{k}"] - f) < 1e-9 for k, f in fences.items())
        expected = not r["base_failed"] and all(r[k] <= f for k, f in fences.items())
        assert r["kept"] == expected
        verdicts.add(expected)
    assert verdicts == {True, False}
