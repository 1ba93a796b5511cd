"""Near-duplicates, repeated passages, benchmark items, mixing and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_helpers import WORD, lower_ascii, prose

import corpus_pipeline
from stayline.llm import components, cube_mixing, decontaminate, simhash_ball, suffix_repeats, toxicity
from stayline.llm.rolling import Rolled, column_bytes, least_in_window


def simhash(text):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_simhash_groups(odd_docs, odd_texts):
    rows = simhash_ball.near_duplicates(odd_docs).collect()
    assert len(rows) == len(odd_texts)
    prints = {r["score"]: simhash(r["text"]) for r in rows}
    assert all(r["fingerprint"] == f"{prints[r['score']]:016x}" for r in rows)
    root = groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r in rows:
        if r["doc_id"] is not None:
            g = root[prints[r["score"]]]
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    assert all(r["component_id"] == least.get(root[prints[r["score"]]]) for r in rows)
    kept = simhash_ball.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(root[simhash(r["text"])] for r in kept.collect()) == sorted(set(root.values()))


def test_ball_hashing_loses_no_link(spark):
    """Chains and clusters of fingerprints at the largest distance, over all ways the bits can fall."""
    rng = random.Random(3)
    prints = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(4):
            for b in rng.sample(range(64), rng.choice([1, 3, 4, 4, 4, 5, 6])):
                x ^= 1 << b
            prints.add(x)
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r["node"] % 2**64: r["root"] % 2**64 for r in components.roots(simhash_ball.links(df)).collect()}
    root = groups(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 4)
    mine, theirs = Counter(), Counter()
    for x in prints:
        mine[got.get(x, x)] += 1
        theirs[root[x]] += 1
    assert sorted(mine.values()) == sorted(theirs.values()) and len(theirs) < len(prints)
    for x in prints:
        for y in prints:
            assert (got.get(x, x) == got.get(y, y)) == (root[x] == root[y])


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in components.roots(links).collect()}
    assert {got[i] for i in range(41)} == {0} and got[100] == 90


def cut(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(b) else 0
        out.append((len(b), len(b) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("length", [24, 60, 400])
def test_repeated_bytes(spark, odd_texts, length):
    passage = [prose(i, 80) for i in range(3)]
    rng = random.Random(length)
    texts = [t for t in odd_texts if len(t or "") < 5_000]
    for i in range(40):
        p = rng.choice(passage)
        a, b = sorted(rng.sample(range(len(p)), 2))
        texts.append(prose(100 + i, rng.randint(0, 30)) + p[a:b] + prose(200 + i, rng.randint(0, 30)))
    texts += ["ab" * 300, "ab" * 301, "é" * 333, "aé" * 200]
    rows = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, start string").repartition(5)
    got = {r["doc_id"]: r for r in suffix_repeats.remove_repeats(rows, length).collect()}
    for i, expected in enumerate(cut(texts, length)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], len(r["removed_spans"]), r["kept_sha256"]) == expected, i
        assert r["start"] == "n" and (r["n_removed"] or r["kept_text"] == (texts[i] or ""))


def test_ranges_are_compared_across_their_edges(spark, monkeypatch):
    """One window suffix per range at most: every equality is found at an edge."""
    shared = prose(9, 30)
    texts = [prose(i, 5) + shared + prose(50 + i, 5) for i in range(3)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(suffix_repeats, "TASK_SUFFIXES", 3)
    got = {r["doc_id"]: r["kept_sha256"] for r in suffix_repeats.remove_repeats(rows, 60).collect()}
    assert [got[i] for i in range(3)] == [x[3] for x in cut(texts, 60)]


def test_multikey_quicksort_and_rolling_hashes():
    rng = np.random.default_rng(2)
    tokens = [rng.integers(0, 4, 500) for _ in range(3)]
    order = suffix_repeats.multikey_quicksort(tokens)
    assert [tuple(t[i] for t in tokens) for i in order] == sorted(zip(*tokens))
    raw = np.frombuffer(b"abcabcabxabc", np.uint8)
    h = Rolled(raw)
    same = h.of(np.array([0, 3, 9]), np.array([3, 6, 12]))
    assert len(set(same.tolist())) == 1 and h.of(np.array([6]), np.array([9]))[0] != same[0]
    v = rng.integers(0, 100, 57).astype(np.uint64)
    assert least_in_window(v, 10).tolist() == [v[i : i + 10].min() for i in range(48)]
    import pyarrow as pa

    raw, starts = column_bytes(pa.array(["xx", "", "é", "abc"]).slice(1))
    assert raw.tobytes().decode() == "éabc" and starts.tolist() == [0, 0, 2, 5]


def shingles(text, size=5):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))
    k = min(size, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


@pytest.mark.parametrize("filter_rows", [0, 1_000])
def test_items_in_documents(spark, odd_docs, odd_texts, filter_rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 64)
    item = prose(2, 90)
    words = item.split()
    items = [item, item, " ".join(words[:40]), words[7], f"{words[3]} {words[4]}", None, "...", " ".join(words[5:15] + ["zz"] + words[15:60])]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["score"], r["item_id"], r["n_shingles"], r["n_found"]) for r in decontaminate.contamination(odd_docs, bench, filter_rows=filter_rows).collect()}
    expected = set()
    for d, text in enumerate(odd_texts):
        for i, t in enumerate(items):
            q = shingles(t)
            size = len(next(iter(q))) if q else 0
            found = len(q & shingles(text, size)) if q and len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))) >= size else 0
            if q and found >= 0.8 * len(q) - 1e-9:
                expected.add((d, i, len(q), found))
    assert got == expected and len(expected) > 5


def test_documents_without_items(odd_docs, odd_texts, spark):
    bench = spark.createDataFrame([(1, prose(2, 90))], "item_id long, text string")
    kept = decontaminate.without_items(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted(r["score"] for r in kept.collect()) == [i for i, t in enumerate(odd_texts) if prose(2, 90) not in (t or "")]
    assert decontaminate.without_items(odd_docs, bench.limit(0)).count() == len(odd_texts)


def shares(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        target |= {s: 3 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= set(over)
    return target


@pytest.mark.parametrize("block", [50, 10_000])
def test_mixing_meets_its_targets(spark, block):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * int(rng.lognormvariate(3, 1))), rng.choice(["a", "b", "b", "b", "c", None, "é"])) for i in range(1_500)]
    rows += [(5_000 + i, "x y", "tiny") for i in range(2)] + [(6_000, None, "empty"), (7, "dup id", "a"), (7, "dup id", "a"), (None, "q", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = cube_mixing.mix(df, block=block).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["size"] == len((r["text"] or "").split())
        assert r["taken"] == 0 or (r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"])
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows)
    for s, t in shares(sizes).items():
        assert abs(next(r["target"] for r in got if r["source"] == s) - t) < 1e-6
        assert abs(taken[s] - t) <= max(40, 0.02 * t), s
    again = cube_mixing.mix(df.repartition(2).orderBy("text"), block=block).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_flight_keeps_totals_and_expectations():
    rng = np.random.default_rng(4)
    size = rng.integers(1, 500, 400)
    chance = np.full(400, 0.3)
    runs = np.array([cube_mixing.fly(size, chance, seed) for seed in range(200)])
    assert np.abs(runs.sum(axis=1) - 120).max() < 1e-6
    assert np.abs(runs @ size - size.sum() * 0.3).max() < 1e-6
    assert ((runs > 0) & (runs < 1)).sum(axis=1).max() <= 2
    assert abs(runs.mean(axis=0) - 0.3).max() < 0.2


def test_empty_tables(no_docs, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (
        simhash_ball.near_duplicates(no_docs), simhash_ball.keep_one(no_docs), suffix_repeats.remove_repeats(no_docs),
        decontaminate.contamination(no_docs, bench), decontaminate.without_items(no_docs, bench), cube_mixing.mix(no_docs),
    ):
        assert out.count() == 0


def test_pipeline_against_its_rules(spark, tmp_path):
    """Every stage on small tables, with the learned scores taken as given and the rest recomputed."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, out = [], docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in out.collect()}
        stage(spark, out, folder).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        after = {r["doc_id"]: r for r in out.collect()}
        names.append(name)
        if name == "toxicity":
            scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
            assert set(after) == {d for d in before if scores[d] < 0.7}
        elif name == "simhash_near_dedup":
            prints = {d: simhash(r["text"]) for d, r in before.items()}
            root = groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
            first = {}
            for d in sorted(before):
                first.setdefault(root[prints[d]], d)
            assert set(after) == set(first.values())
        elif name == "suffix_array_dedup":
            ids = sorted(before)
            expected = dict(zip(ids, cut([before[d]["text"] for d in ids], corpus_pipeline.PASSAGE_BYTES)))
            for d in ids:
                same = after[d]["text"] == before[d]["text"]
                assert same == (expected[d][1] == 0) and after[d]["n_chars"] == len(after[d]["text"])
        elif name == "benchmark_decontamination":
            items = [shingles(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            clean = {d for d, r in before.items() if all(len(q & shingles(r["text"])) < 0.8 * len(q) for q in items)}
            assert set(after) == clean
        if name != "mixing":
            assert out.columns == docs.columns and all(after[d]["lang"] == before[d]["lang"] for d in after)
        else:
            assert set(after) == set(before)
            total = sum(r["size"] for r in after.values())
            assert abs(sum(r["taken"] for r in after.values()) - total) < 0.05 * total
    assert len(names) == 5
