"""Quality rules with adaptive thresholds, with DataFrame functions only.

Counts are taken within each row. Every rate is put into logarithmic bins with
a fixed relative error; the bin counts per language and source are a quantile
sketch that merges by addition, whatever the order. Fences from those sketches
replace fixed cut-offs; groups with few documents use the sketch merged over
their language, or over all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import SPACE_CLASS, stored, text_of, unpacked, word_count

WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

#: Relative width of a bin of the sketch.
BIN_GROWTH = 1.02
#: Rates below this share the lowest bin.
LEAST_RATE = 1e-4
#: Documents a group must have for a threshold of its own.
LEAST_DOCS = 50
#: A fence stands this many quartile distances above the upper quartile.
REACH = 4.0
# Smallest quartile distance taken for each rate, so that equal documents leave some room.
LEAST_SPREAD = {"symbol_rate": 0.005, "word_length": 0.25, "dup_line_rate": 0.1, "repeat_rate": 0.075, "upper_rate": 0.02}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def doubled(hashes: Column, step: int) -> Column:
    """Hashes of windows of ``2 * step`` words from those of ``step`` words; the last ones run past the end."""
    return let(
        hashes, lambda h: F.zip_with(h, F.slice(h, step + 1, F.size(h) + 1), lambda a, b: F.xxhash64(a, b))
    )


def repeated_words(words: Column) -> Column:
    """Words inside 8-word windows that stand in the text twice or more."""
    far = F.size(words) + 1
    window = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1, 2, 4):
        window = doubled(window, step)
    whole = let(window, lambda h: F.slice(h, 1, F.greatest(F.size(h) - (WINDOW_WORDS - 1), F.lit(0))))

    def covered(grams: Column) -> Column:
        by_gram = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        twice = let(by_gram, lambda s: F.zip_with(s, F.slice(s, 2, F.size(s) + 1), lambda a, b: F.when(a.g == b.g, F.array(a.i, b.i))))
        starts = F.sort_array(F.array_distinct(F.flatten(F.array_compact(twice))))
        steps = let(starts, lambda p: F.zip_with(p, F.slice(p, 2, F.size(p) + 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW_WORDS)), F.lit(WINDOW_WORDS))))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    return let(
        F.when(far > WINDOW_WORDS, whole).otherwise(F.array().cast("array<bigint>")),
        lambda grams: F.when(F.size(F.array_distinct(grams)) < F.size(grams), covered(grams)).otherwise(F.lit(0)),
    )


def base_counts(text: Column) -> dict[str, Column]:
    """Counts of one text; ``words`` and ``lines`` are split once each."""
    words = F.array_remove(F.split(text, f"[{SPACE_CLASS}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")
    return {
        "n_words": word_count(text).cast("long"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(words, repeated_words).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long"),
    }


def rates() -> dict[str, Column]:
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return {
        "symbol_rate": ratio("n_symbols", "word_chars"),
        "word_length": ratio("word_chars", "n_words"),
        "dup_line_rate": ratio("n_dup_lines", "n_lines"),
        "repeat_rate": ratio("n_repeat_words", "n_words"),
        "upper_rate": ratio("n_upper", "word_chars"),
    }


def sketch(counted: DataFrame) -> DataFrame:
    """Bin counts per language, source and rate; adding rows of two sketches merges them."""
    at = F.floor(F.log(F.greatest(F.col("value"), F.lit(LEAST_RATE)) / LEAST_RATE) / F.log(F.lit(BIN_GROWTH)))
    pairs = F.array(*[F.struct(F.lit(k).alias("rate"), F.col(k).alias("value")) for k in LEAST_SPREAD])
    return (
        counted.select("lang", "source", F.explode(pairs).alias("x"))
        .select("lang", "source", "x.*")
        .groupBy("lang", "source", "rate", at.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def merged(bins: DataFrame, *keys: str) -> DataFrame:
    return bins.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"))


def quartiles(bins: DataFrame, *keys: str) -> DataFrame:
    """Median and upper quartile of every rate from bin counts."""
    ordered = Window.partitionBy(*keys, "rate").orderBy("bin")
    total = Window.partitionBy(*keys, "rate")
    value = F.when(F.col("bin") <= 0, 0.0).otherwise(LEAST_RATE * F.pow(F.lit(BIN_GROWTH), F.col("bin") + 0.5))
    up_to = bins.withColumn("upto", F.sum("n").over(ordered)).withColumn("docs", F.sum("n").over(total))
    reached = lambda q: F.min(F.when(F.col("upto") >= q * F.col("docs"), value))
    return up_to.groupBy(*keys, "rate").agg(
        F.max("docs").alias("docs"), reached(0.5).alias("mid"), reached(0.75).alias("high")
    )


def thresholds(bins: DataFrame) -> DataFrame:
    """One row per language and source with a fence ``max_<rate>`` for every rate."""
    own = quartiles(bins, "lang", "source")
    lang = quartiles(merged(bins, "lang"), "lang").toDF("lang_", "rate_", "docs_l", "mid_l", "high_l")
    every = quartiles(merged(bins)).toDF("rate__", "docs_a", "mid_a", "high_a")
    # a row per language and rate, and a row per rate: far fewer than groups, and never more than those
    with_lang = own.join(lang, own.lang.eqNullSafe(lang.lang_) & (own.rate == lang.rate_))
    with_all = with_lang.join(every, with_lang.rate == every.rate__)
    pick = lambda name: (
        F.when(F.col("docs") >= LEAST_DOCS, F.col(name))
        .when(F.col("docs_l") >= LEAST_DOCS, F.col(f"{name}_l"))
        .otherwise(F.col(f"{name}_a"))
    )
    spread = F.create_map(*[F.lit(x) for kv in LEAST_SPREAD.items() for x in kv])[F.col("rate")]
    fence = pick("high") + REACH * F.greatest(pick("high") - pick("mid"), spread)
    return (
        with_all.select("lang", "source", "rate", fence.alias("fence"))
        .groupBy("lang", "source")
        .agg(*[F.max(F.when(F.col("rate") == k, F.col("fence"))).alias(f"max_{k}") for k in LEAST_SPREAD])
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def quality_rules(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep: list[str] | None = None
) -> DataFrame:
    """All rows of ``docs`` with counts, rates, the group's thresholds, ``base_failed`` and ``kept``.

    ``keep`` names the input columns to carry (default: all). A null text has
    no words and fails; a null language or source is a group of its own; a rate
    without a denominator is 0. Repeated rows count as often as they stand.
    Columns of the added names in the input are replaced.
    """
    counts = base_counts(text_of(text))
    added = [*counts, *LEAST_SPREAD, *[f"max_{k}" for k in LEAST_SPREAD], "base_failed", "kept"]
    carried = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep) if c not in added])
    packed_row = F.struct(*[F.col(f"`{c}`") for c in carried.columns]).alias("row")
    rows = docs.select(
        packed_row, F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"),
        *[c.alias(k) for k, c in counts.items()],
    )
    counted = stored(rows.select("*", *[c.alias(k) for k, c in rates().items()]), "counts")
    fences = thresholds(sketch(counted)).withColumnsRenamed({"lang": "lang_", "source": "source_"})
    joined = counted.join(
        fences, counted.lang.eqNullSafe(fences.lang_) & counted.source.eqNullSafe(fences.source_), "left"
    )
    within = F.lit(True)
    for k in LEAST_SPREAD:
        within = within & (F.col(k) <= F.col(f"max_{k}"))
    return unpacked(
        joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & within),
        *[F.col(c) for c in added],
    )
