"""Small sources in a large mix, and passages of texts with very many copies."""

import random
from collections import Counter

import pytest
from llm_helpers import prose
from pyspark.sql import functions as F

from stayline.llm import cube_mixing, suffix_repeats


@pytest.mark.parametrize("most", [1, 20])
def test_small_sources_of_a_large_table(spark, most):
    """The largest source has 12,000 documents; each small one has texts of 9,000 words, ``most`` of them alike."""
    rng = random.Random(5)
    rows = [("a", " ".join(["w"] * rng.randint(1, 5))) for _ in range(12_000)]
    for source in ("b", "c", "d", "e", "f"):
        rows += [(source, " ".join(["w"] * rng.randint(20, 400))) for _ in range(300)]
        rows += [(source, "w " * (9_000 // most)) for _ in range(most)]
    docs = spark.createDataFrame(rows, "source string, text string").repartition(4)
    taken, target = Counter(), {}
    for r in cube_mixing.mix(docs).select("source", "target", "taken").collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.015 * t for s, t in target.items()), (taken, target)


def test_ranges_do_not_grow_with_copies(spark, monkeypatch):
    """A third of all rows are copies of one text, which shares a passage with others."""
    compare = suffix_repeats.sorted_ranges

    def counted(suffixes, rows, fn, schema):
        seen.append((suffixes.count(), suffixes.groupBy("t1", "t2", "k1", "k2", "start").count().agg(F.max("count")).first()[0]))
        return compare(suffixes, rows, fn, schema)

    seen = []
    monkeypatch.setattr(suffix_repeats, "sorted_ranges", counted)
    shared, tail = prose(1, 60), prose(2, 60)
    rows = [(i, shared + tail) for i in range(300)] + [(300 + i, prose(10 + i, 40) + shared + prose(900 + i, 40)) for i in range(6)]
    rows += [(400, prose(500, 80)), (401, "short"), (402, "short"), (403, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in suffix_repeats.remove_repeats(docs, 100).collect()}
    assert len(got) == len(rows)
    assert all(most == 1 for _, most in seen) and len(seen) == 2
    whole = len(shared + tail)
    assert all(got[i]["n_removed"] == whole and got[i]["removed_spans"][0]["stop"] == whole for i in range(300))
    assert all(got[300 + i]["n_removed"] >= len(shared) for i in range(6))
    assert [got[i]["n_removed"] for i in (400, 401, 402, 403)] == [0, 0, 0, 0] and got[403]["kept_text"] == ""
