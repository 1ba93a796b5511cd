"""Mixing sources to target weights by cube-method balanced sampling.

Every source has a target number of words. A document is taken a whole number
of times for certain and once more with a fractional inclusion probability.
The flight phase moves these probabilities through the null space of the
balancing constraints (number of documents, number of words) until almost all
are 0 or 1, so both totals stay as they are. Sources are cut into blocks that
fly on their own; the two or three undecided documents of each block fly again
together, level by level, until one small landing problem per source remains.
The largest documents of a source take no part in any flight and are only placed by
landing, whatever the size of the table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import stored, text_of, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A target stops at this many times the size of its source.
MOST_TIMES = 3
#: Documents that fly together.
BLOCK = 10_000
#: Largest documents of a source that only land, so that landing has a choice.
SPARED = 13
EDGE = 1e-9


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, target): shares of all words by weight, stopped at a multiple of the source.

    With sources ordered by ``limit / weight`` the stopped ones come first, and
    the rest share what they leave. ``sizes`` has a row per source; only these
    rows meet in one task.
    """
    named = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    levels = (
        named.withColumn("weight", weight)
        .withColumn("limit", (most * F.col("source_size")).cast("double"))
        .withColumn("all_words", F.sum("source_size").over(whole))
        .withColumn(
            "level",
            (F.col("all_words") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward),
        )
        .withColumn("stopped", F.col("limit") <= F.col("weight") * F.col("level"))
    )
    level = F.max(F.when(~F.col("stopped"), F.struct(-F.col("limit") / F.col("weight"), -F.col("place"), "level"))).over(whole)
    share = F.when(F.col("stopped"), F.col("limit")).otherwise(F.col("weight") * level["level"])
    return levels.select("source", "source_size", share.alias("target"))


def fly(size: np.ndarray, chance: np.ndarray, seed: int) -> np.ndarray:
    """Flight phase: afterwards at most two chances lie strictly between 0 and 1.

    Three undecided documents always have a direction that keeps their number
    and their words; the chances move along it, to either end with the odds that
    keep every expectation.
    """
    out = chance.astype(float).copy()
    draw = np.random.default_rng(seed).random(len(out) + 3)
    open_ = [i for i in range(len(out)) if EDGE < out[i] < 1 - EDGE]
    size_l, value = size.astype(float).tolist(), out.tolist()
    window, used = open_[:3], 3
    turn = 0
    while len(window) == 3:
        a, b, c = window
        u = (size_l[b] - size_l[c], size_l[c] - size_l[a], size_l[a] - size_l[b])
        if u[0] == 0 and u[1] == 0:
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, d in zip(window, u):
            if d > 0:
                up, down = min(up, (1 - value[i]) / d), min(down, value[i] / d)
            elif d < 0:
                up, down = min(up, value[i] / -d), min(down, (1 - value[i]) / -d)
        step = up if draw[turn] * (up + down) < down else -down
        turn += 1
        for i, d in zip(window, u):
            value[i] = min(1.0, max(0.0, value[i] + step * d))
        window = [i for i in window if EDGE < value[i] < 1 - EDGE]
        while len(window) < 3 and used < len(open_):
            window.append(open_[used])
            used += 1
    for i, v in enumerate(value):
        out[i] = 0.0 if v <= EDGE else 1.0 if v >= 1 - EDGE else v
    return out


def land(size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Landing: of all choices for the last few documents the one that is off by the fewest words and documents."""
    out = chance.copy()
    rest = np.flatnonzero((out > 0) & (out < 1))
    picks = (np.arange(2 ** len(rest))[:, None] >> np.arange(len(rest))) & 1
    off = picks - out[rest]
    cost = np.abs(off @ size[rest].astype(float)) + np.abs(off.sum(axis=1))
    out[rest] = picks[int(cost.argmin())]
    return out


def with_spared(units: DataFrame, most: int = SPARED) -> DataFrame:
    """``units`` with ``spared``: whether a document is among the ``most`` largest of its source.

    ``tie`` tells equal documents apart. Spark keeps ``most`` rows of a source in
    each task before the exchange, so no source meets in one task.
    """
    by_size = Window.partitionBy("source").orderBy(F.desc("size"), F.desc("order"), F.desc("tie"))
    largest = units.select("source", "size", "order", "tie").withColumn("rank", F.row_number().over(by_size)).filter(F.col("rank") <= most)
    last = largest.groupBy(F.col("source").alias("s")).agg(F.min(F.struct("size", "order", "tie")).alias("last"))
    return (
        units.join(stored(last, "largest"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("spared", F.struct("size", "order", "tie") >= F.col("last"))
        .drop("s", "last")
    )


def _flight(landing: bool):
    def one_block(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["order", "size"], kind="stable").reset_index(drop=True)
        size, chance = block["size"].to_numpy(), block["chance"].to_numpy().copy()
        # the largest do not fly: whichever way they fall, other sets of them come close to the total
        rest = np.flatnonzero(~block["spared"].to_numpy(bool))
        rest = rest[np.argsort(-size[rest], kind="stable")]
        chance[rest] = fly(size[rest], chance[rest], int(block["seed"].iloc[0]))
        block["chance"] = land(size, chance) if landing else chance
        return block

    return one_block


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", keep: list[str] | None = None, seed: int = 7,
    weights: tuple[float, ...] = WEIGHTS, most: int = MOST_TIMES, block: int = BLOCK,
) -> DataFrame:
    """All rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken``.

    ``keep`` names the input columns to carry (default: all). ``size`` counts the
    words of the text (null: 0), ``taken`` the words the mix takes of the
    document, a multiple of its size of at most ``most`` times. A null source is
    a source of its own. The choice depends on the rows and ``seed`` alone, so
    reruns agree. An empty table stays empty.
    """
    added = ["size", "source_size", "target", "taken"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    # rows are put in order by a hash of all they hold
    order = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns])
    sized = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
            F.col(f"`{source}`").cast("string").alias("source"),
            word_count(text_of(text)).cast("long").alias("size"),
            order.alias("order"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "sizes",
    )
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    goals = stored(
        targets(by_source.select("source", "source_size"), weights, most).join(
            by_source.select(F.col("source").alias("s"), "docs"), F.col("source").eqNullSafe(F.col("s"))
        ).drop("s"),
        "targets",
    )
    largest = goals.agg(F.max("docs")).first()[0] or 0
    times = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    whole = F.floor(times + EDGE)
    units = (
        with_spared(sized)
        .join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("times", whole.cast("double"))
        .withColumn("chance", F.greatest(times - whole, F.lit(0.0)))
    )
    done: list[DataFrame] = []
    landing = units.filter("spared")
    left, unit_count = units, float(largest)
    while True:
        last = unit_count <= block
        blocks = F.lit(1) if last else F.ceil(F.col("docs") * (unit_count / largest) / block)
        # blocks of a later level mix the leftovers of many blocks of this one
        place = F.pmod(F.xxhash64("order", F.lit(len(done))), F.greatest(blocks, F.lit(1)))
        keyed = left.withColumn("place", place.cast("long")).withColumn("seed", F.pmod(F.xxhash64("source", "place", F.lit(seed)), F.lit(2**31)))
        if not last:
            keyed = keyed.filter("NOT spared")
        flown = keyed.groupBy("source", "place").applyInPandas(_flight(last), keyed.schema)
        columns = [c for c in flown.columns if c not in ("place", "seed")]
        if last:
            done.append(flown.select(columns))
            break
        flown = stored(flown.select(columns), "flown")
        between = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(flown.filter(~between))
        left, unit_count = flown.filter(between).unionByName(landing.select(columns)), max(1.0, 3 * unit_count / block + 3)
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    taken: Column = (F.col("size") * (F.col("times") + F.col("chance"))).cast("long")
    return result.select("row.*", "size", "source_size", "target", taken.alias("taken"))
