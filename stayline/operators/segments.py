"""Clustering, segment merge, profiles and validation."""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.columns import ratio, years_before
from stayline.functions.features import lifecycle_stage, loan_to_income
from stayline.functions.labels import lookup
from stayline.functions.portfolio import SEGMENTS
from stayline.ml import kmeans
from stayline.operators.rates import share_where
from stayline.sources.schema import present

# ---- fixed values: clustering columns per perspective -----------------------
PERSPECTIVES = {
    "P1_Financial": ["N_CONTRACTS", "TOTAL_MTFINO", "TOTAL_MENSALIDADE", "MEDIAN_DURDEG"],
    "P2_Risk": [
        "MAX_RANGPRO",
        "MAX_RANGCLI",
        "MAX_RISKA",
        "ALLBD_IDADE_MEAN__N",
        "COUNT_CL_MEDIAN",
        "COUNT_AUTO_MEDIAN",
        "COUNT_TOTAL_MEDIAN",
        "DIVIDAS_TOTAL_MEDIAN",
        "MONTVENC_TOTAL_LOG",
        "RISK_EVER",
        "RISK_RECENT",
    ],
    "P3_History": ["CLIENT_SENIORITY_YEARS", "YEARS_SINCE_LAST_CONTRACT", "ALLBD_N_Dossiers__N"],
}
CONTINUOUS_PROFILE = [
    "sdem_age",
    "NBENF",
    "MEDIAN_RESSO",
    "ALLBD_IDADE_MEAN__N",
    "RISK_TOTAL",
    "EXTERNAL_TO_OWN",
]
# -----------------------------------------------------------------------------
SEGMENT = "segment_final"


def _complete(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    rows = df.select(key, *[F.col(c).cast("double") for c in columns]).na.drop(subset=columns)
    return rows.select(key, F.array(*columns).alias("x"))


def sweep_clusters(
    df: DataFrame, columns: list[str], key: str = "CONTRIB", ks=range(2, 9), starts: int = 10, seed: int = 42
) -> DataFrame:
    """Cost and silhouette over all rows for each number of clusters, all fitted in the same scans."""
    rows = _complete(df, columns, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        best = kmeans.fit_many(rows, list(ks), starts, key, seed)
        shapes = kmeans.silhouettes(rows, [best[k][1] for k in ks])
    finally:
        rows.unpersist()
    table = [(k, best[k][0], shape) for k, shape in zip(ks, shapes)]
    return df.sparkSession.createDataFrame(table, "k int, inertia double, silhouette double")


def assign_clusters(
    df: DataFrame, columns: list[str], output: str, k: int = 3, key: str = "CONTRIB", starts: int = 10, seed: int = 42
) -> tuple[DataFrame, np.ndarray]:
    """Cluster label per row from the best of several starts, and the centres; rows with nulls stay unassigned."""
    rows = _complete(df, columns, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _, centres = kmeans.fit_many(rows, [k], starts, key, seed)[k]
    finally:
        rows.unpersist()
    return df.withColumn(output, kmeans.nearest(columns, centres)), centres


def combined_label(df: DataFrame, columns: list[str], output: str = "cluster_label") -> DataFrame:
    """Labels of all perspectives in one text; null when any is missing."""
    return df.withColumn(
        output, F.when(sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0)) == 0, F.concat_ws("_", *columns))
    )


def group_centroids(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(*[F.avg(c).alias(c) for c in columns])


def ward_labels(points: np.ndarray, clusters: int) -> list[int]:
    """Ward agglomeration of a handful of unweighted points, cut to ``clusters`` groups.

    Groups are numbered by their smallest member.
    """
    members = {i: [i] for i in range(len(points))}
    centre = {i: points[i].astype(float) for i in members}
    while len(members) > clusters:
        ids = sorted(members)
        cost = lambda a, b: (
            len(members[a]) * len(members[b]) / (len(members[a]) + len(members[b]))
            * float(((centre[a] - centre[b]) ** 2).sum())
        )
        a, b = min(((a, b) for i, a in enumerate(ids) for b in ids[i + 1:]), key=lambda pair: cost(*pair))
        na, nb = len(members[a]), len(members[b])
        centre[a] = (na * centre[a] + nb * centre[b]) / (na + nb)
        members[a] += members.pop(b)
        del centre[b]
    labels = [0] * len(points)
    for number, group in enumerate(sorted(members.values(), key=min), start=1):
        for i in group:
            labels[i] = number
    return labels


def merge_segments(
    df: DataFrame, labels: list[str], columns: list[str], clusters: int = 4, output: str = SEGMENT
) -> DataFrame:
    """Merge label combinations to final segments.

    Combination centroids come from one aggregation; with three labels of three
    values there are at most 27 of them, so the merge runs on the driver and its
    mapping returns as a broadcast table.
    """
    combined = combined_label(df, labels, "_combination")
    centroids = group_centroids(combined, "_combination", columns).orderBy("_combination").collect()
    points = np.array([[row[c] for c in columns] for row in centroids], dtype=float)
    numbers = ward_labels(np.nan_to_num(points), min(clusters, len(points)))
    mapping = df.sparkSession.createDataFrame(
        [(row["_combination"], n) for row, n in zip(centroids, numbers)], f"_combination string, {output} int"
    )
    return combined.join(F.broadcast(mapping), "_combination", "left").drop("_combination")


def cluster_distribution(df: DataFrame, label: str) -> DataFrame:
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("clients"))
    return counts.withColumn("share_pct", F.col("clients") * 100.0 / F.sum("clients").over(Window.partitionBy(F.lit(1))))


def segment_means(df: DataFrame, columns=CONTINUOUS_PROFILE, segment: str = SEGMENT) -> DataFrame:
    return group_centroids(df, segment, present(df, columns))


def segment_shares(df: DataFrame, prefix: str, segment: str = SEGMENT) -> DataFrame:
    """Percentage of each dummy column of a prefix per segment, to one decimal."""
    columns = [c for c in df.columns if c.startswith(prefix)]
    return (
        df.where(F.col(segment).isNotNull())
        .groupBy(segment)
        .agg(*[F.bround(F.avg(c) * 100, 1).alias(c.removeprefix(prefix)) for c in columns])
    )


def category_shares(df: DataFrame, category: str, segment: str = SEGMENT) -> DataFrame:
    """Percentage of each category per segment, long form."""
    rows = df.where(F.col(segment).isNotNull())
    counts = rows.groupBy(segment, category).agg(F.count("*").alias("n"))
    everyone = F.sum("n").over(Window.partitionBy(segment))
    return counts.select(segment, category, F.bround(F.col("n") * 100.0 / everyone, 1).alias("share_pct"))


def shares_with_floor(profile: DataFrame, segment: str = SEGMENT, floor: float = 2.0) -> DataFrame:
    """Wide shares to long form, keeping names that reach ``floor`` percent in some segment."""
    names = [c for c in profile.columns if c != segment]
    long = profile.unpivot([segment], names, "name", "share_pct")
    return long.withColumn("_top", F.max("share_pct").over(Window.partitionBy("name"))).filter(
        F.col("_top") >= floor
    ).drop("_top")


def normalise_profile(long: DataFrame, name: str, value: str) -> DataFrame:
    """Scale each measure to 0..1 over the groups of a small long profile; constant reads 0.5."""
    window = Window.partitionBy(name)
    lo, hi = F.min(value).over(window), F.max(value).over(window)
    return long.withColumn("scaled", F.when(hi > lo, ratio(F.col(value) - lo, hi - lo)).otherwise(0.5))


def transpose_profile(wide: DataFrame, group: str, values: list | None = None) -> DataFrame:
    """Rows to columns for a small profile: one row per measure, one column per group."""
    measures = [c for c in wide.columns if c != group]
    long = wide.select(group, *[F.col(c).cast("double") for c in measures]).unpivot([group], measures, "measure", "value")
    return long.groupBy("measure").pivot(group, values).agg(F.first("value"))


def r_squared(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Share of the total variation that lies between the groups.

    Deviations are taken from centred values so that large means cost no digits.
    """
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centred = df.select(label, *[(F.col(c) - F.lit(means[c])).alias(c) for c in columns])
    groups = centred.groupBy(label).agg(
        *[F.sum(F.col(c) * F.col(c)).alias(f"q_{c}") for c in columns],
        *[(F.sum(c) * F.avg(c)).alias(f"b_{c}") for c in columns],
    )
    total = sum((F.sum(f"q_{c}") for c in columns), F.lit(0.0))
    between = sum((F.sum(f"b_{c}") for c in columns), F.lit(0.0))
    return groups.agg(F.try_divide(between, total).alias("r_squared"))


def davies_bouldin(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Mean over clusters of the worst ratio of spread to centroid distance."""
    rows = df.select(label, *columns).na.drop()
    centroids = group_centroids(rows, label, columns)
    named = centroids.withColumnsRenamed({c: f"_c_{c}" for c in columns})
    away = F.sqrt(sum((F.pow(F.col(c) - F.col(f"_c_{c}"), F.lit(2)) for c in columns), F.lit(0.0)))
    spread = rows.join(F.broadcast(named), label).groupBy(label, *[f"_c_{c}" for c in columns]).agg(F.avg(away).alias("s"))
    table = spread.collect()  # one row per cluster
    worst = []
    for a in table:
        distances = []
        for b in table:
            if a[label] != b[label]:
                d = sum((a[f"_c_{c}"] - b[f"_c_{c}"]) ** 2 for c in columns) ** 0.5
                distances.append((a["s"] + b["s"]) / d)
        worst.append(max(distances, default=0.0))
    value = sum(worst) / len(worst) if worst else None
    return df.sparkSession.createDataFrame([(value,)], "davies_bouldin double")


def intervention_table(df: DataFrame, reference: str, segment: str = SEGMENT) -> DataFrame:
    """Segment outcomes with its contract window and recommended intervention."""
    stage = lifecycle_stage(years_before(reference, "LAST_DCREAT"), "MEDIAN_DURDEG")
    rows = df.where(F.col(segment).isNotNull()).withColumns(
        {"_stage": stage, "_lti": loan_to_income("TOTAL_MTFINO", "MEDIAN_RESSO", cap=None)}
    )
    named = lambda i: lookup(F.col(segment), {s: v[i] for s, v in SEGMENTS.items()})
    return (
        rows.groupBy(segment)
        .agg(
            F.count("IS_CHURN").alias("clients"),
            (F.avg("IS_CHURN") * 100).alias("churn_pct"),
            (F.avg("IS_EARLY_SETTLER") * 100).alias("settler_pct"),
            (F.avg("_stage") * 100).alias("lifecycle_pct"),
            (share_where(F.col("_stage") > 0.75) * 100).alias("final_quarter_pct"),
            (share_where(F.col("_stage").between(0.25, 0.75)) * 100).alias("mid_contract_pct"),
            F.avg("_lti").alias("lti"),
        )
        .withColumns(
            {"name": named(0), "window_start": named(1), "window_end": named(2), "intervention": named(3)}
        )
    )


def seeded_sample(df: DataFrame, n: int, key: str = "CONTRIB", seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a digest of seed and key: the same rows in any engine and partitioning.

    Each task keeps its ``n`` first rows only.
    """
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)
