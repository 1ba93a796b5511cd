"""The analytical base table: one row per client from the four source tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from stayline.operators import clean, contracts, dedupe, joins, missing
from stayline.plans import bindings
from stayline.session import shared_dir
from stayline.sources.files import save_and_verify

# ---- fixed values: column names of the data model ---------------------------
SCORE_COLUMNS = ["CONTRIB", "sys_data_procura", "kp_sqe_enc", "ks_score_tier"]
FAMA_COLUMNS = [
    "CONTRIB",
    "ALLBD_N_Dossiers__N",
    "ALLBD_A_CL__N",
    "ALLBD_A_CP__N",
    "ALLBD_IDADE_MEAN__N",
    "ALLBD_N_events__N",
    "sdem_SITFAM",
    "sdem_HABITAT",
    "sdem_age",
]
COVERAGE = {
    "crc": ["MT_MENSAL_MAX", "COUNT_TOTAL_MAX", "DIVIDAS_CL_MAX"],
    "credscore": ["kp_sqe_enc", "ks_score_tier"],
    "fama": ["ALLBD_N_Dossiers__N", "sdem_age"],
}
# ---- end of fixed values -----------------------------------------------------


def prepared_loans(
    loans: DataFrame,
    sequence: list[str],
    exclude: tuple[str, ...] = (),
    sizes: contracts.Sizes | None = None,
) -> DataFrame:
    """Cleaned, filled and deduplicated observations.

    Rows without a client or contract belong to nobody and are left out; keys are
    never filled. Every date column but the observation date is carried forward.
    ``sizes`` of the observations let ordinary contracts stay where the join put them.
    """
    loans = loans.na.drop(subset=contracts.CONTRACT_KEYS)
    needed = set(loans.columns) - {"TYPEPROD", "MENSALIDADE_CORR", "PTT", "DCSP"}
    rows = clean.clean_loans(loans, protect=needed)
    rows = missing.handle_missing(
        rows,
        contracts.CONTRACT_KEYS,
        ["OBS_DATE", *sequence],
        exclude=(*contracts.CONTRACT_KEYS, *exclude),
        group_size=sizes.rows_per_contract if sizes else None,
    )
    return dedupe.handle_duplicates(rows, [*contracts.CONTRACT_KEYS, "OBS_DATE"], sequence)


def prepared_bureau(bureau: DataFrame, sequence: list[str], exclude: tuple[str, ...] = ()) -> DataFrame:
    rows = clean.clean_bureau(bureau)
    rows = missing.fill_text(missing.fill_numeric(clean.drop_sparse_rows(rows), 0.0, _numbers(rows, exclude)))
    return dedupe.handle_duplicates(rows, ["CONTRIB", "OBS_DATE"], sequence)


def prepared_scores(scores: DataFrame, fill: bool = True) -> DataFrame:
    """``fill`` turns a missing score into 0, as the other numeric columns."""
    rows = clean.clean_scores(scores)
    if fill:
        rows = missing.fill_numeric(clean.drop_sparse_rows(rows))
    return dedupe.handle_duplicates(rows, ["CONTRIB", "sys_data_procura"], ["ks_score_tier", "kp_sqe_enc"])


def prepared_clients(clients: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    rows = clean.drop_sparse_rows(clean.clean_client_aggregates(clients))
    rows = missing.fill_text(missing.fill_numeric(rows, 0.0, _numbers(rows, exclude)))
    return dedupe.handle_duplicates(rows, ["CONTRIB", "Date_Obs"])


def _numbers(df: DataFrame, exclude) -> list[str]:
    from stayline.sources.schema import numeric_columns

    return numeric_columns(df, ("CONTRIB", *exclude))


def client_base(loans: DataFrame, sizes: contracts.Sizes | None = None) -> DataFrame:
    """Prepared observations to one row per client with the targets."""
    per_contract = contracts.contract_table(loans, sizes=sizes)
    return contracts.with_targets(contracts.client_table(per_contract, sizes=sizes))


def assemble(
    loans: DataFrame,
    bureau: DataFrame,
    scores: DataFrame,
    clients: DataFrame,
    sizes: contracts.Sizes | None = None,
    check_keys: bool = True,
) -> DataFrame:
    """Prepared tables to client grain, joined on the client.

    Every side is reduced to one row per client before the joins, so they
    cannot multiply rows and reuse the partitioning of the aggregations.
    """
    base = client_base(loans, sizes)
    best = dedupe.best_per_key(
        scores, "CONTRIB", "ks_score_tier", ["sys_data_procura", "kp_sqe_enc"], SCORE_COLUMNS
    )
    fama = clients.select(*FAMA_COLUMNS)
    if check_keys:
        fama = dedupe.require_unique(fama, ["CONTRIB"])
    return joins.left_join_chain(
        base, {"crc": contracts.bureau_table(bureau), "credscore": best, "fama": fama}
    )


def prepared_tables(spark: SparkSession, folder: str) -> dict:
    loans = bindings.loans(spark, folder)
    sizes = contracts.measure_sizes(loans)
    return {
        "sizes": sizes,
        "loans": prepared_loans(loans, bindings.SEQUENCE, sizes=sizes),
        "bureau": prepared_bureau(bindings.bureau(spark, folder), ["SEQ_EVENT"]),
        "scores": prepared_scores(bindings.scores(spark, folder)),
        "clients": prepared_clients(bindings.client_aggregates(spark, folder)),
    }


def build_abt(spark: SparkSession, folder: str) -> DataFrame:
    return assemble(**prepared_tables(spark, folder))


def stored_abt(spark: SparkSession, folder: str, refresh: bool = False) -> DataFrame:
    """The base table as a written hand-off table, built once per session and input.

    Models, segments and reports all start from it; writing it to the shared
    folder means a lost executor re-reads a file instead of redoing the build.
    The input is taken to stay as it is within a session; ``refresh`` looks at
    its files and builds anew what has changed.
    """
    at = (spark.sparkContext.applicationId, folder)
    known = _STORED.get(at)
    if known is None or (refresh and known[0] != source_version(spark, folder)):
        path = os.path.join(shared_dir(spark), f"abt-{uuid.uuid4().hex}.parquet")
        version = source_version(spark, folder)
        known = _STORED[at] = (version, path, save_and_verify(build_abt(spark, folder), path).schema)
    return spark.read.schema(known[2]).parquet(known[1])


def source_version(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of change of the source tables' files: a changed input is another version."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


_STORED: dict[tuple, tuple] = {}


def merge_loan_level(
    loans: DataFrame, bureau: DataFrame, scores: DataFrame, clients: DataFrame, history: str = "latest"
) -> DataFrame:
    """All four tables at observation grain.

    Scores and client aggregates are those known at the observation: the newest
    row at or before it, one at most, so rows are preserved. ``history="all"``
    joins every row of the client instead, which repeats observations.
    """
    if history not in ("latest", "all"):
        raise ValueError(f"unknown history {history!r}")
    rows = joins.left_join(loans, bureau, ["CONTRIB", "OBS_DATE"], "_crc")
    if history == "all":
        rows = joins.left_join(rows, scores, ["CONTRIB"], "_credscore")
        return joins.left_join(rows, clients, ["CONTRIB"], "_fama")
    rows = joins.latest_join(rows, scores, ["CONTRIB"], "OBS_DATE", "sys_data_procura", "_credscore")
    return joins.latest_join(rows, clients, ["CONTRIB"], "OBS_DATE", "Date_Obs", "_fama")
