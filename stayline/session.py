"""Session defaults and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # per-client aggregates with medians: hash more groups before sorting them
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("stayline")
    settings = {
        **LOCAL_DEFAULTS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "16g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_local(master: str) -> None:
    """Only one machine can share a temporary folder."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and hand-off tables.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is used
    only where that is unset and the master is local; other masters are refused,
    because executors could not read each other's files there.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current is None:
        require_local(context.master)
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stayline-"))
        current = context.getCheckpointDir()
    return current


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read from there afterwards."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later scans read the columns they need."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/stayline-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
