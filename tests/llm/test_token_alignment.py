"""Alignment of two tokenizers against a plain walk over both lists of ends."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stayline.llm import catalog, token_alignment
from stayline.llm.token_alignment import shared_cuts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_all_common_ends_are_found(a, b):
    a, b = sorted({*a, 61}), sorted({*b, 61})
    cuts_a, cuts_b = shared_cuts(np.array(a), np.array(b))
    assert [a[i] for i in cuts_a] == [b[i] for i in cuts_b] == sorted(set(a) & set(b))


def brute(texts):
    """Per text: ids of A and B, groups, and figures of its links over all texts."""
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = token_alignment.byte_level_alphabet()
    names = {i: bytes(alphabet[c] for c in token) for token, i in t.get_vocab(with_added_tokens=False).items()}
    found = []
    for text in texts:
        groups = []
        if text:
            a = [(i, names[i]) for i in t.encode(" " + text, add_special_tokens=False).ids]
            b = []
            for i in model.encode(text):
                piece = model.id_to_piece(i)
                is_byte = len(piece) == 6 and piece.startswith("<0x")
                b.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                ends_b, at = {}, 0
                for k, (_, x) in enumerate(b):
                    at += len(x)
                    ends_b[at] = k
                at, group, done = 0, [], 0
                for i, x in a:
                    at += len(x)
                    group.append(i)
                    if at in ends_b:
                        groups.append((group, [j for j, _ in b[done : ends_b[at] + 1]]))
                        group, done = [], ends_b[at] + 1
        found.append(groups)
    counts = Counter((g[0][-1], g[1][-1]) for groups in found for g in groups)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for groups in found:
        pairs = [(g[0][-1], g[1][-1]) for g in groups]
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(pairs),
            sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs),
            hashlib.sha256(told.encode()).hexdigest() if groups else "", groups,
        ))
    return out


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_against_brute_force(odd_docs, monkeypatch):
    monkeypatch.setattr(token_alignment, "SLICE", 2_000)
    monkeypatch.setattr(token_alignment, "BLOCK_LINKS", 3_000)
    rows = odd_docs.collect()
    want = {r["score"]: w for r, w in zip(rows, brute([r["text"] for r in rows]))}
    assert any(w[2] for w in want.values()) and any(not w[2] for w in want.values())
    got = token_alignment.linked_alignments(odd_docs, A, B)
    assert got.columns[:6] == odd_docs.columns
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in FIGURES) == want[r["score"]][:7]
    for r in token_alignment.alignments(odd_docs, A, B, keep=["score"]).collect():
        assert [(g["a"], g["b"]) for g in r["groups"]] == want[r["score"]][7]


def test_without_rows(no_docs):
    assert token_alignment.linked_alignments(no_docs, A, B).count() == 0
    assert token_alignment.alignments(no_docs, A, B).count() == 0


def test_query_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = {r["doc_id"]: w[:7] for r, w in zip(docs, brute([r["text"] for r in docs]))}
    got = catalog.op13_token_alignment(spark, small).collect()
    assert {r["doc_id"]: tuple(r[c] for c in FIGURES) for r in got} == want and len(got) == len(docs)
