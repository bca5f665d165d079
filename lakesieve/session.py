"""Session helpers: a sensible session, and the shared folder for intermediates."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import delete

#: Name of the hidden row-position column used where "first row" has a meaning.
ROW = "_row"


def build_session(app: str = "lakesieve", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC timestamps."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where the driver's disk is
    the executors' disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="lakesieve-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder, in this application's part of it, that nothing else uses."""
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/lakesieve/{spark.sparkContext.applicationId}"


def clear_intermediates(spark: SparkSession) -> None:
    """Remove what this application has written to the shared folder.

    Results that were not written elsewhere yet may still read from there, so this is the
    caller's to decide, after the last result is stored.
    """
    delete(spark, _own_dir(spark))


def small_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: str) -> DataFrame:
    """A few driver-made rows as a DataFrame, without starting a Python worker.

    Columns a row leaves out are null.
    """
    text = json.dumps([dict(row) for row in rows], default=str)
    parsed = F.from_json(F.lit(text), f"array<struct<{schema}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))


def materialise(df: DataFrame, label: str, row_id: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on its inputs, survives lost executors, and
    has a known size, so Catalyst itself decides whether a join may broadcast
    it and adaptive execution may split its skewed partitions. With ``row_id``
    every row also gets its position in the written files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return read_parquet(spark, path, schema=df.schema, row_id=row_id)


def landed(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` and read it back twice: with ``_row``, and without.

    Spark does not prune file metadata a plan makes no use of, so passes that
    need no row position should read the second.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    numbered = read_parquet(spark, path, schema=df.schema, row_id=True)
    return numbered, read_parquet(spark, path, schema=df.schema)


def read_parquet(spark: SparkSession, path, schema=None, row_id: bool = False) -> DataFrame:
    """Scan Parquet; ``row_id`` adds ``_row``, the row's file and position in it.

    The position is a property of the stored file, so it is the same in every
    pass over it, however the scan is split or retried.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    if row_id:
        position = F.struct("_metadata.file_path", "_metadata.row_index")
        df = df.select("*", position.alias(ROW))
    return df
