"""Sources by type name: each turns options into a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import normalise_missing
from ..session import ROW, landed, materialise, read_parquet
from . import api_pages, files, jdbc, landed_pages

#: ``(spark, options, since) -> DataFrame``
Reader = Callable[[SparkSession, Mapping[str, Any], Any], DataFrame]

FILE_OPTIONS = {
    "csv": ("delimiter", "encoding", "schema", "read_options", "union_columns", "infer"),
    "json": ("records_path", "encoding", "schema", "read_options"),
}


@dataclass(frozen=True)
class Source:
    name: str
    type: str
    options: Mapping[str, Any] = field(default_factory=dict)


def _files(kind: str) -> Reader:
    read = files.read_csv if kind == "csv" else files.read_json

    def reader(spark: SparkSession, options: Mapping[str, Any], since: Any) -> DataFrame:
        chosen = {k: options[k] for k in FILE_OPTIONS[kind] if k in options}
        df = read(spark, options["path"], row_id=bool(options.get("row_id")), **chosen)
        return files.newer_than(df, options.get("incremental_key"), since)

    return reader


def _parquet(spark: SparkSession, options: Mapping[str, Any], since: Any) -> DataFrame:
    df = read_parquet(spark, options["path"], row_id=bool(options.get("row_id")))
    return normalise_missing(files.newer_than(df, options.get("incremental_key"), since))


def _database(kind: str) -> Reader:
    return lambda spark, options, since: normalise_missing(
        jdbc.read_jdbc(spark, kind, options, since)
    )


def _api_pages(spark: SparkSession, options: Mapping[str, Any], since: Any) -> DataFrame:
    """Landed responses: a Parquet folder with ``page`` and ``body`` columns, or with the option
    ``layout_of`` ``"folders"`` a text file for each page, below ``feed=`` and ``page=`` folders."""
    if options.get("layout_of") == "folders":
        landed_pages.register(spark)
        pages = spark.read.format("landed_pages").load(options["path"])
    else:
        pages = spark.read.parquet(options["path"])
    path, feed = options.get("records_path"), options.get("feed")
    pages = api_pages.cut_pages(
        pages,
        options.get("pagination"),
        path,
        feed=feed,
        max_pages=options.get("max_pages"),
    )
    df = api_pages.pages_to_records(pages, path, layout=options.get("layout"))
    return files.newer_than(df, options.get("incremental_key"), since)


READERS: dict[str, Reader] = {
    "csv": _files("csv"),
    "json": _files("json"),
    "parquet": _parquet,
    "postgresql": _database("postgresql"),
    "mysql": _database("mysql"),
    "api_pages": _api_pages,
}


def register_source(kind: str, reader: Reader) -> None:
    """Add or replace a source type."""
    READERS[kind] = reader


def extract(spark: SparkSession, source: Source, since: Any = None) -> DataFrame:
    """The rows of a source, only those newer than ``since`` if it is given."""
    if source.type not in READERS:
        raise ValueError(f"No source registered for type '{source.type}'")
    return READERS[source.type](spark, source.options, since)


def extract_rows(
    spark: SparkSession, source: Source, since: Any = None
) -> tuple[DataFrame, DataFrame]:
    """As :func:`extract`, ready for several passes: with ``_row``, and without.

    Parquet is scanned where it lies. Anything else is read once and landed as
    Parquet, so text is parsed, and databases are queried, a single time.
    """
    numbered = Source(source.name, source.type, {**source.options, "row_id": True})
    if source.type == "parquet":
        return extract(spark, numbered, since), extract(spark, source, since)
    if source.type == "csv" and not source.options.get("schema"):
        # The text is parsed once; types are found in, and applied to, the landed columns.
        texts = Source(source.name, "csv", {**numbered.options, "infer": False})
        rows = files.infer_types(materialise(extract(spark, texts, since), "landed"))
    elif source.type in FILE_OPTIONS:
        rows = materialise(extract(spark, numbered, since), "landed")
    else:
        return landed(extract(spark, source, since), "landed")
    return rows, rows.drop(ROW)
