"""The quarantine: rejected rows, why and when, by pipeline, stage and run."""

from __future__ import annotations

import datetime as dt
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import column
from ..operators.split import VIOLATIONS
from ..session import small_frame
from ..storage import exists
from .tables import counted_write

REASON, AT = "_quarantine_reason", "_quarantined_at"
PARTITIONS = ("_pipeline", "_stage", "_run_id")


def reason_of(rows: DataFrame, reason: str | None) -> Column:
    """The given reason, or the names of the rules the row breaks."""
    if reason is not None or VIOLATIONS not in rows.columns:
        return F.lit(reason or "quality_failure")
    return F.concat_ws(",", VIOLATIONS)


def marked(rows: DataFrame, at: dt.datetime | str, reason: str | None = None) -> DataFrame:
    """Rejected rows with their reason and the run's one timestamp."""
    stamp = F.lit(str(at)).cast("timestamp")
    columns = {REASON: reason_of(rows, reason), AT: stamp}
    return rows.withColumns(columns).drop(VIOLATIONS)


def quarantine_rows(
    rows: DataFrame,
    root: str,
    pipeline: str,
    stage: str,
    run_id: str,
    at: dt.datetime | str,
    reason: str | None = None,
) -> int:
    """Store rejected rows and return their number; a retry replaces what its run wrote."""
    path = quarantine_path(root, pipeline, stage, run_id)
    return counted_write(
        marked(rows, at, reason), lambda df: df.write.mode("overwrite").parquet(path)
    )


def quarantine_path(root: str, pipeline: str, stage: str, run_id: str) -> str:
    """The run's folder, named the way Spark names partitions."""
    values = (quote(v, safe=" -_.@+,;()") for v in (pipeline, stage, run_id))
    return "/".join([root.rstrip("/"), *(f"{k}={v}" for k, v in zip(PARTITIONS, values))])


def quarantine_summary(spark: SparkSession, root: str) -> DataFrame:
    """Rows per pipeline, stage and run, from file footers and folder names alone."""
    schema = ", ".join(f"{p} string" for p in PARTITIONS)
    stored = spark.read.schema(schema).parquet(root) if exists(spark, root) else small_frame(spark, [], schema)
    names = [F.col(p).alias(n) for p, n in zip(PARTITIONS, ("pipeline_name", "stage_name", "run_id"))]
    return stored.groupBy(*names).agg(F.count("*").alias("row_count"))


def quarantine_sample(
    spark: SparkSession,
    root: str,
    pipeline: str,
    stage: str,
    run_id: str,
    limit: int = 200,
    order_by: tuple[str, ...] = (),
) -> DataFrame:
    """The first rejected rows of one run."""
    path = quarantine_path(root, pipeline, stage, run_id)
    rows = spark.read.option("basePath", root).parquet(path)
    if order_by:
        rows = rows.orderBy(*[column(c) for c in order_by])
    return rows.limit(limit)
