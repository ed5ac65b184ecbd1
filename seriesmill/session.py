"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a part of a table that many jobs read again.
PART_ROWS = 16_384

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # whole web pages travel to the parser: few rows per Arrow batch keep workers small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # the panel projection is wide; keep generated code and plan strings in bounds
    "spark.sql.debug.maxToStringFields": "50",
}


def build_session(master: str | None = None, app: str = "seriesmill", **extra: str) -> SparkSession:
    """Session with the library's settings; a cluster's own submit settings win for the rest."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a fresh temporary folder; on a cluster an unset
    folder is an error, because a lost executor would take the data with it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="seriesmill-"))
    return context.getCheckpointDir()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """New path below the shared folder; nothing is created or removed."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage that survives lost executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_compact(df: DataFrame, label: str) -> DataFrame:
    """As ``settle``, in as many parts as its rows need (``PART_ROWS``), however many tasks made them.

    For tables that many jobs read again: each of them starts a task per part.
    """
    out = settle(df, label)
    parts = max(1, -(-out.count() // PART_ROWS))
    return settle(out.coalesce(parts), label) if parts < out.rdd.getNumPartitions() else out
