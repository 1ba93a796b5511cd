"""Toxicity by a weighted finite-state pattern grammar.

Small weighted transducers read the word classes of a clause: one for insults,
one for threats, one for targets, one for negation and one for reported speech.
Each keeps a state and a weight factor; :func:`compose` builds their product,
whose transitions are one table lookup per word. A clause is worth what the
composed transducer emits for its matches: an insult counts more beside a
target and less under negation or in reported speech, a threat counts only with
a target. What a match is worth with a target only is held for a few words where
no target precedes, and emitted if one follows in the clause. A document's score is a logistic function of its clause weights.

Insults are learned from labelled rows: words and word beginnings that stand in
toxic documents far more often than elsewhere, with a weight from the lower
bound of the log ratio. Fixed word lists serve the other transducers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import stored, text_of, unpacked, with_row
from stayline.llm.labelled import training_labels

#: Labelled rows the lexicon and the weights are fitted on at most.
FIT_ROWS = 20_000
#: Entries of the learned lexicon at most, the heaviest first.
LEXICON = 5_000
#: Different words that must precede an entry in toxic documents; copies of a document add none.
SUPPORT = 5
#: Lower bound of the log ratio an entry must reach: one that no clean document has, and any other.
LEAST_WEIGHT = 2.2
LEAST_WEIGHT_SEEN = 3.0
STEMS = (3, 4, 5, 6)
#: Word classes a task remembers before it starts anew.
MEMO_LIMIT = 300_000

# Closed word classes in English, German, French and Spanish.
TARGETS = """you your yours yourself u ur he him she her they them their these those
du dich dir dein deine ihr euch euer sie ihn ihm ihnen
tu te toi ton ta tes vous votre vos il elle eux leur
usted ustedes ti contigo él ella ellos ellas"""
NEGATIONS = "not no never nor isn aren wasn don didn nicht kein keine keinen nie pas jamais non ni nunca jamás"
REPORTS = """said says say called calls wrote writes quoted claimed reported allegedly according
sagte sagt nannte schrieb angeblich laut
dit disait appelé écrit selon prétendument
dijo dice llamó escribió según supuestamente"""
THREATS = """kill hurt destroy shoot stab burn hang beat murder
töten umbringen verletzen erschießen verbrennen
tuer frapper détruire brûler égorger
matar golpear destruir quemar degollar"""
# End of fixed values.

TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n\"“”«»]")
CLAUSE_ENDS = frozenset(".!?;\n")
QUOTES = frozenset("\"“”«»")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)
CLASSES = 7


class Transducer(NamedTuple):
    """``step[state][class]`` is (next state, factor); state 0 is the start."""

    step: list[list[tuple[int, float]]]


def countdown(trigger: int, reach: int, on: dict[int, float], off: dict[int, float]) -> Transducer:
    """After ``trigger`` the factors ``on`` hold for ``reach`` words, else those of ``off``."""
    step = []
    for state in range(reach + 1):
        factors = on if state else off
        step.append([(reach if c == trigger else max(0, state - 1), factors.get(c, 1.0)) for c in range(CLASSES)])
    return Transducer(step)


def quotation() -> Transducer:
    """Between quotation marks a match is someone else's words."""
    inside = {INSULT: 0.5, THREAT: 0.5}
    return Transducer(
        [[(state ^ (c == QUOTE), inside.get(c, 1.0) if state else 1.0) for c in range(CLASSES)] for state in (0, 1)]
    )


def compose(parts: list[Transducer]) -> Transducer:
    """The product: states side by side, factors multiplied."""
    spaces = [range(len(p.step)) for p in parts]
    number = {states: i for i, states in enumerate(product(*spaces))}
    step = []
    for states in number:
        row = []
        for c in range(CLASSES):
            moves = [p.step[s][c] for p, s in zip(parts, states)]
            row.append((number[tuple(m[0] for m in moves)], float(np.prod([m[1] for m in moves]))))
        step.append(row)
    return Transducer(step)


#: A match and its target, in either order, are at most so many words apart.
REACH = 4


def _around(target: Transducer) -> Transducer:
    return compose(
        [
            target,
            countdown(NEGATION, 2, {INSULT: 0.6, THREAT: 0.2}, {}),
            countdown(REPORT, 6, {INSULT: 0.7, THREAT: 0.4}, {}),
            quotation(),
        ]
    )


def grammar() -> Transducer:
    """What a match is worth at once."""
    return _around(countdown(TARGET, REACH, {INSULT: 1.5, THREAT: 1.0}, {THREAT: 0.0}))


def held_grammar() -> Transducer:
    """What a match without a target before it is worth more if one follows; its states are those of :func:`grammar`."""
    return _around(countdown(TARGET, REACH, {INSULT: 0.0, THREAT: 0.0}, {INSULT: 0.5, THREAT: 1.0}))


class Scanner:
    """Reads texts clause by clause."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {k: v for k, v in lexicon.items() if not k.endswith("*")}
        self.stems = {k[:-1]: v for k, v in lexicon.items() if k.endswith("*")}
        self.step = grammar().step
        self.held = held_grammar().step
        self.fixed = {w: QUOTE for w in QUOTES}
        for words, kind in ((REPORTS, REPORT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (THREATS, THREAT)):
            self.fixed |= dict.fromkeys(words.split(), kind)
        self.memo: dict[str, tuple[int, float]] = {}

    def kind(self, word: str) -> tuple[int, float]:
        """Class and weight of a word; a learned word goes before a learned beginning."""
        if len(self.memo) > MEMO_LIMIT:
            self.memo.clear()
        weight = self.words.get(word) or max(
            (self.stems.get(word[:n], 0.0) for n in STEMS if n < len(word)), default=0.0
        )
        if weight:
            found = INSULT, weight
        else:
            found = self.fixed.get(word, OTHER), 6.0 if self.fixed.get(word) == THREAT else 0.0
        self.memo[word] = found
        return found

    def clauses(self, text: str) -> list[float]:
        """Weights of the clauses with a match."""
        tokens = TOKEN.findall(text.lower())
        kinds = [self.memo.get(t) or self.kind(t) for t in tokens]
        hits = [i for i, k in enumerate(kinds) if k[1]]
        out: list[float] = []
        done = -1
        for i in hits:
            if i <= done:
                continue
            lo = i
            while lo and tokens[lo - 1] not in CLAUSE_ENDS:
                lo -= 1
            done = i
            while done + 1 < len(tokens) and tokens[done + 1] not in CLAUSE_ENDS:
                done += 1
            out.append(self.clause(kinds[lo : done + 1]))
        return out

    def clause(self, kinds: list[tuple[int, float]]) -> float:
        state, total = 0, 0.0
        waiting: list[tuple[int, float]] = []
        for place, (c, weight) in enumerate(kinds):
            if c == TARGET and waiting:
                total += sum(more for since, more in waiting if place - since <= REACH)
                waiting.clear()
            more = weight * self.held[state][c][1] if weight else 0.0
            if more:
                waiting.append((place, more))
            state, factor = self.step[state][c]
            total += weight * factor
        return total

    def summary(self, text: str) -> list[float]:
        """What the score looks at: the sum of clause weights, the heaviest, and their number, each damped."""
        found = [w for w in self.clauses(text) if w > 0]
        return [float(np.log1p(sum(found))), float(np.log1p(max(found, default=0.0))), float(np.log1p(len(found)))]


class Model(NamedTuple):
    lexicon: dict[str, float]
    weights: list[float]
    intercept: float


def beginnings(word: str) -> list[str]:
    """A word and, with a star, its proper beginnings."""
    return [word, *(word[:n] + "*" for n in STEMS if n < len(word))]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, before, clean): a row per term and preceding word of toxic documents, and counts of clean ones."""
    clean: Counter = Counter()
    toxic: set[tuple[str, str]] = set()
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
            words = [t for t in TOKEN.findall(text.as_py().lower()) if t[0].isalpha()]
            if label:
                toxic |= {(term, before) for before, word in zip(["", *words], words) for term in beginnings(word)}
            else:
                clean.update({term for word in set(words) for term in beginnings(word)})
    names = ["term", "before", "clean"]
    found = list(toxic)
    yield pa.RecordBatch.from_arrays(
        [pa.array([t for t, _ in found], pa.string()), pa.array([w for _, w in found], pa.string()), pa.array([0] * len(found), pa.int64())],
        names=names,
    )
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(clean), pa.string()), pa.nulls(len(clean), pa.string()), pa.array(list(clean.values()), pa.int64())],
        names=names,
    )


def learn_lexicon(train: DataFrame) -> dict[str, float]:
    """Weights of words and beginnings from (text, label) rows; empty without both labels."""
    totals = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not (totals.get(0) and totals.get(1)):
        return {}
    counted = (
        train.mapInArrow(_term_counts, "term string, before string, clean long")
        .groupBy("term")
        .agg(F.least(F.count_distinct("before"), F.lit(totals[1])).alias("t"), F.sum("clean").alias("c"))
    )
    ratio = F.log((F.col("t") + 0.5) / (totals[1] + 1)) - F.log((F.col("c") + 0.5) / (totals[0] + 1))
    doubt = 2 * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    kept = (
        counted.filter(F.col("t") >= SUPPORT)
        .withColumn("weight", ratio - doubt)
        .filter(F.col("weight") >= F.when(F.col("c") == 0, LEAST_WEIGHT).otherwise(LEAST_WEIGHT_SEEN))
        .orderBy(F.desc("weight"), "term")
        .limit(LEXICON)
    )
    return without_needless_stems({r["term"]: (float(r["weight"]), r["t"]) for r in kept.collect()})


def without_needless_stems(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Drop the beginnings that one longer entry accounts for: they would only catch words never seen."""
    explained = set()
    for term, (_, t) in found.items():
        own = term.rstrip("*")
        explained |= {stem for n in STEMS if n < len(own) and t >= 0.9 * found.get(stem := own[:n] + "*", (0, 1e18))[1]}
        if not term.endswith("*"):
            explained |= {stem for n in STEMS if n == len(own) and t >= 0.9 * found.get(stem := own + "*", (0, 1e18))[1]}
    return {term: weight for term, (weight, _) in found.items() if term not in explained}


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> tuple[list[float], float]:
    """Newton steps; the penalty keeps separable labels finite."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    keep = np.diag([penalty] * x.shape[1] + [1e-6])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep, z.T @ (p - y) + keep @ w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1].tolist(), float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, folds: int, fold_out: int, rows: int, text: str, doc_id: str, label: str) -> Model:
    """Lexicon and weights from a bounded sample of labelled rows, read once and stored."""
    # at most ``rows`` ids: a bounded side
    chosen = F.broadcast(training_labels(labels, label, folds, fold_out, rows))
    known = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text")).join(chosen, "doc_id")
    # an id that stands more than once counts once, so that rows are bounded as ids are
    once = known.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
    train = stored(once.select("doc_id", F.col("least.text").alias("text"), "label"), "labelled")
    lexicon = learn_lexicon(train.select("text", "label"))
    summed = train.select(F.struct("doc_id", "label").alias("row"), "text")
    seen = summed.mapInArrow(_summaries(lexicon), with_row(summed, x="array<double>")).select("row.*", "x").collect()
    seen.sort(key=lambda r: (r.doc_id, r.x))
    y = np.array([r.label for r in seen], float)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(lexicon, [0.0] * 3, float(np.log(share / (1 - share))))
    return Model(lexicon, *logistic(np.array([r.x for r in seen]), y))


def _summaries(lexicon: dict[str, float]):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(lexicon)
        for batch in batches:
            values = [scanner.summary(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(values, pa.list_(pa.float64()))], names=["row", "x"]
            )

    return summarise


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, folds: int = 3, fold_out: int = 1, rows: int = FIT_ROWS,
    text: str = "text", doc_id: str = "doc_id", label: str = "toxic", keep: list[str] | None = None,
) -> DataFrame:
    """All rows of ``docs`` with ``score``, the probability that the document is toxic.

    ``keep`` names the input columns to carry (default: all but ``score``). Null
    and empty texts are scored as texts without a match. Repeated rows get equal
    scores; of an id with several texts one is fitted on; without labelled rows every score is a half.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    model = fit(docs, labels, folds, fold_out, rows, text, doc_id, label)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), text_of(text).alias("text"))
    summed = packed.mapInArrow(_summaries(model.lexicon), with_row(packed, x="array<double>"))
    z = F.lit(model.intercept)
    for i, w in enumerate(model.weights):
        z = z + F.col("x")[i] * w
    return unpacked(summed, (1 / (1 + F.exp(-z))).alias("score"))
