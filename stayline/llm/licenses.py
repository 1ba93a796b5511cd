"""License scans by diagonal voting, with DataFrame functions only.

Every rolling word 3-gram of a text is joined to the places where templates
have it. A hit votes for the diagonal ``word position - template position``;
hits of one place of a template share a diagonal, insertions and deletions
move it by a word. Votes are added up by diagonal, neighbouring diagonals are
merged, and the spans are verified: a base phrase needs every word on one
diagonal, a longer template a share of its 3-grams within a span of about its
own length.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm.common import lower_ascii, packed, stored, text_key, text_of, unpacked

GRAM = 3
#: Between words stand ASCII characters other than letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before letters are lowered.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    label: str
    words: str
    exact: bool


# Base phrases and public license wordings.
TEMPLATES = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("gpl-3", "licensed under the gnu general public license version 3", False),
    Template("gpl", "under the terms of the gnu general public license as published by the free software foundation", False),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", False),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", False),
    Template("apache-2", "licensed under the apache license version 2 0", False),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", False),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", False),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license", False),
]
# End of fixed values.

#: Share of a template's 3-grams that a span must hold.
COVERAGE = 0.8
#: Words that may be put in or left out between neighbouring diagonals.
DRIFT = 2


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), BETWEEN), "")


def template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """(template, label, exact, grams, t_pos, g1, g2, g3): as many rows as the templates have 3-grams."""
    rows = []
    for number, t in enumerate(templates):
        words = t.words.split()
        grams = len(words) - GRAM + 1
        if not 1 <= grams <= 62:
            raise ValueError(f"a template needs {GRAM} to {GRAM + 61} words: {t.words}")
        rows += [(number, t.label, t.exact, grams, i, *words[i : i + GRAM]) for i in range(grams)]
    schema = "template int, label string, exact boolean, grams int, t_pos int, g1 string, g2 string, g3 string"
    return spark.createDataFrame(rows, schema)


def diagonal_votes(docs: DataFrame, text: str, templates: list[Template]) -> DataFrame:
    """A row for each text, template and diagonal with at least one vote.

    Texts go by their hashes, so copies of a text vote for the same rows;
    ``seen`` has a bit for each 3-gram of the template, which counts a vote of
    a copy once.
    """
    words = F.col("w")
    length = F.size(words)
    # slices run past the end, where the zipped fields are null and match nothing
    grams = F.arrays_zip(
        words.alias("a"),
        F.slice(words, 2, F.greatest(length, F.lit(1))).alias("b"),
        F.slice(words, 3, F.greatest(length, F.lit(1))).alias("c"),
    )
    rolled = (
        docs.select(*text_key(text_of(text)), words_of(text_of(text)).alias("w"))
        .select("k1", "k2", F.posexplode(grams).alias("pos", "g"))
        .select("k1", "k2", "pos", "g.*")
    )
    rolled = rolled.toDF("k1", "k2", "pos", "w1", "w2", "w3").withColumn("h", F.xxhash64("w1", "w2", "w3"))
    known = template_grams(docs.sparkSession, templates).withColumn("h", F.xxhash64("g1", "g2", "g3"))
    # the templates are a constant list of a few hundred rows at most
    hits = rolled.join(F.broadcast(known), "h").filter("w1 = g1 AND w2 = g2 AND w3 = g3")
    return hits.groupBy(
        "k1", "k2", "template", "label", "exact", "grams", (F.col("pos") - F.col("t_pos")).alias("diagonal")
    ).agg(
        F.bit_or(F.expr("shiftleft(1L, t_pos)")).alias("seen"),
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
    )


def verified_spans(votes: DataFrame) -> DataFrame:
    """Merged and verified spans: (k1, k2, label, exact, start, stop, coverage)."""
    exact = votes.filter("exact AND bit_count(seen) = grams").select(
        "k1", "k2", "label", "exact", F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("grams") + GRAM - 1).alias("stop"), F.lit(1.0).alias("coverage"),
    )
    along = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    loose = (
        votes.filter("NOT exact")
        .withColumn("apart", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along), F.lit(DRIFT + 1)))
        .withColumn("bundle", F.sum((F.col("apart") > DRIFT).cast("int")).over(along))
        .groupBy("k1", "k2", "template", "label", "exact", "grams", "bundle")
        .agg(
            F.bit_or("seen").alias("seen"),
            F.min("first_pos").alias("start"),
            (F.max("last_pos") + GRAM).alias("stop"),
        )
        .withColumn("coverage", F.expr("bit_count(seen) / double(grams)"))
        .filter((F.col("stop") - F.col("start")) <= F.col("grams") + GRAM + 2 * DRIFT)
        .select("k1", "k2", "label", "exact", "start", "stop", "coverage")
    )
    return exact.unionByName(loose)


def scan_licenses(docs: DataFrame, text: str = "text", templates: list[Template] = TEMPLATES) -> DataFrame:
    """All rows and columns of ``docs`` with license findings.

    Adds ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and
    ``last_word`` (their smallest and largest start, null without a place),
    ``base_labels`` and ``labels`` (distinct, sorted, comma-joined), ``score``
    (largest covered share of a template, 1 for a base phrase) and ``spans``
    (label, start, stop, coverage of every verified span). A null text is
    empty: no words, empty labels, score 0, no spans. Repeated rows each get
    the findings of their text. Columns of these names in the input are
    replaced.
    """
    found = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    labels = lambda keep: F.array_join(F.array_sort(F.collect_set(F.when(keep, F.col("label")))), ",")
    full = F.col("coverage") >= COVERAGE
    # votes and findings are stored: the texts are read once, and the join below stands between two
    # plain exchanges, which lets Spark split a text that a great many documents share
    by_text = stored(
        verified_spans(stored(diagonal_votes(docs, text, templates), "votes"))
        .groupBy("k1", "k2")
        .agg(
            F.count(F.when(F.col("exact"), 1)).alias("n_base"),
            F.min(F.when(F.col("exact"), F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(F.col("exact"), F.col("start"))).cast("long").alias("last_word"),
            labels(F.col("exact")).alias("base_labels"),
            labels(full).alias("labels"),
            F.max("coverage").alias("score"),
            F.array_sort(F.collect_set(F.when(full, F.struct("label", "start", "stop", "coverage")))).alias("spans"),
        ),
        "licenses",
    )
    k1, k2 = text_key(text_of(text))
    rows = packed(
        docs.drop(*found), k1=k1, k2=k2, n_words=F.regexp_count(text_of(text), F.lit(ANY_CASE_WORD)).cast("long")
    )
    none = F.from_json(F.lit("[]"), "array<struct<label:string,start:int,stop:int,coverage:double>>")
    return unpacked(
        rows.join(by_text, ["k1", "k2"], "left"),
        F.col("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word"),
        F.col("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("spans", none).alias("spans"),
    )
