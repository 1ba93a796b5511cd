"""Toxicity and quality scores: held-out accuracy, odd rows, and the parts of the models."""

import zlib

import numpy as np
import pytest

from stayline.llm import labelled, quality_gam, toxicity
from stayline.llm.common import table

FOLDER = "/root/testdata/sf0.1"


def accuracy(scored, labels, label, folds, fold_out):
    known = {r["doc_id"]: r[label] for r in labels.collect()}
    out = [(r["score"], known[r["doc_id"]]) for r in scored.collect() if r["doc_id"] in known and zlib.crc32(str(r["doc_id"]).encode()) % folds == fold_out]
    return out


def test_quality_on_held_out_labels(spark):
    labels = table(spark, FOLDER, "labels")
    out = accuracy(quality_gam.quality_scores(table(spark, FOLDER, "documents"), labels, keep=["doc_id"]), labels, "quality", 4, 2)
    assert len(out) > 500
    assert np.mean([(s >= 0.7) == y for s, y in out]) > 0.98
    assert np.mean([s >= 0.7 for s, y in out if y]) > 0.98


def test_toxicity_on_held_out_labels(spark):
    """All documents; recall and false alarms by language."""
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    found: dict[tuple[str, int], list[bool]] = {}
    for r in toxicity.toxicity_scores(docs, labels, keep=["doc_id", "lang"]).collect():
        if r["doc_id"] in known and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1:
            found.setdefault((r["lang"], known[r["doc_id"]]), []).append(r["score"] >= 0.7)
    print({k: (sum(v), len(v)) for k, v in sorted(found.items())})
    together = lambda label: [x for (_, y), own in found.items() if y == label for x in own]
    assert np.mean(together(1)) > 0.85 and np.mean(together(0)) < 0.01
    for (lang, label), own in found.items():
        assert np.mean(own) > 0.75 if label else np.mean(own) < 0.03, lang


@pytest.mark.parametrize("score,label", [(toxicity.toxicity_scores, "toxic"), (quality_gam.quality_scores, "quality")])
def test_scores_of_odd_rows(spark, odd_docs, no_docs, score, label):
    labels = spark.createDataFrame(
        [(0, 1), (1, 0), (1, 1), (5, None), (None, 1), (7, 0), (8, 1), (9, 0), (9, 0), (99, 1)], f"doc_id long, {label} int"
    )
    rows = score(odd_docs.withColumnRenamed("score", "number"), labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert score(no_docs, labels).count() == 0
    unlabelled = score(odd_docs, labels.limit(0)).collect()
    assert {round(r["score"], 6) for r in unlabelled} == {0.5}


def test_held_out_labels_are_never_learned(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    chosen = labelled.training_labels(labels, "quality", 4, 2, 1_000).collect()
    assert {r["doc_id"] for r in chosen} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert labelled.training_labels(labels, "quality", 4, 2, 10).count() == 10


def test_clauses_are_composed():
    scanner = toxicity.Scanner({"idiot": 4.0, "scu*": 2.0})
    worth = lambda text: sum(scanner.clauses(text))
    plain = worth("such an idiot here")
    assert plain == 4 and worth("a scumbag") == 2
    assert worth("you are an idiot") > plain > worth("that is not idiot")
    assert worth("reported as idiot") < plain and worth('the word "idiot" here') < plain
    assert worth("you. what an idiot") == plain
    assert worth("kill the process") == 0 < worth("they will kill")
    assert worth("") == 0 and scanner.summary("") == [0, 0, 0]


def test_composition_is_the_product():
    a = toxicity.countdown(toxicity.TARGET, 2, {toxicity.INSULT: 2.0}, {})
    b = toxicity.countdown(toxicity.NEGATION, 1, {toxicity.INSULT: 0.5}, {})
    both = toxicity.compose([a, b])
    assert len(both.step) == len(a.step) * len(b.step)
    rng = np.random.default_rng(0)
    for word in rng.integers(0, toxicity.CLASSES, (50, 12)):
        s = sa = sb = 0
        for c in word.tolist():
            s, f = both.step[s][c]
            sa, fa = a.step[sa][c]
            sb, fb = b.step[sb][c]
            assert f == fa * fb


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(5)
    x = rng.random((3_000, len(quality_gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (0, 1) in [p[:2] for p in model.pairs]
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_trees_pick_the_best_cuts():
    g = np.array([-5.0, -5.0, 5.0, 5.0, -5.0])
    tree = quality_gam._tree(g, np.ones(5), 2)
    assert (np.sign(tree) == [1, 1, -1, -1, 1]).all()


def test_targets_on_either_side():
    scanner = toxicity.Scanner({"idiot": 4.0})
    worth = lambda text: sum(scanner.clauses(text))
    assert worth("i will kill you") == worth("they will kill") == worth("they will kill them") == 6
    assert worth("we will burn your house") > 0
    assert worth("idiot, you there") == worth("you idiot") == worth("you idiot you") == 6
    assert worth("never kill you") < worth("kill you") and worth('"kill" you') < worth("kill you")
    assert worth("kill the process") == worth("kill. you") == worth("kill a b c d you") == 0
    assert worth("idiot a b c d you") == 4
