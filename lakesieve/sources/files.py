"""File sources: CSV and JSON, with data-frame conventions for missing values."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_number, as_whole, column, normalise_missing
from ..operators.transforms import cast
from ..session import ROW

# Texts that mean "missing" in a delimited file (besides the empty text).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

TEXT = T.StringType()

#: Larger files are not held as one text.
WHOLE_BYTES = 256 << 20
#: Compressed files, and how much larger their text is taken to be.
PACKED, PACKED_TIMES = r"\.(gz|bz2|deflate|lz4|snappy|zst)$", 100


def positioned(df: DataFrame) -> DataFrame:
    """Add ``_row``: file, offset of the split in it, and order within the split.

    Evaluate it once (write the result) before using it in several passes.
    """
    return df.select(
        "*",
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("line"),
        ).alias(ROW),
    )


def infer_types(df: DataFrame) -> DataFrame:
    """Give all-text columns the narrowest type that fits every value; one pass."""
    names = [c for c in df.columns if c != ROW]
    if not names:
        return df

    def fits(test: Column) -> Column:
        return F.coalesce(F.bool_and(test), F.lit(True))

    tests = []
    for i, name in enumerate(names):
        value = column(name)
        known = value.isNotNull()
        tests += [
            fits(F.when(known, value.try_cast("bigint").isNotNull())).alias(f"whole_{i}"),
            fits(F.when(known, as_number(value, TEXT).isNotNull())).alias(f"number_{i}"),
            fits(F.when(known, F.lower(value).isin("true", "false"))).alias(f"flag_{i}"),
            F.bool_or(known).alias(f"known_{i}"),
        ]
    found = df.agg(*tests).first()
    types = {}
    for i, name in enumerate(names):
        if not found[f"known_{i}"]:
            types[name] = "double"
        elif found[f"whole_{i}"]:
            types[name] = "int"
        elif found[f"number_{i}"]:
            types[name] = "double"
        elif found[f"flag_{i}"]:
            types[name] = "boolean"
    return cast(df, {"columns": types})


def _typed(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Apply declared types to text columns; unreadable values become null."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = []
    for f in declared.fields:
        value = column(f.name)
        if isinstance(f.dataType, T.LongType):
            value = as_whole(value, TEXT)
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            value = as_number(value, TEXT).cast(f.dataType)
        else:
            value = value.try_cast(f.dataType)
        columns.append(value.alias(f.name))
    kept = [F.col(ROW)] if ROW in df.columns else []
    return df.select(*columns, *kept)


def files_by_header(spark: SparkSession, path: str, encoding: str) -> dict[str, list[str]]:
    """The files under ``path`` by their first line."""
    lines = spark.read.option("encoding", encoding).text(path)
    placed = lines.where(F.col("_metadata.file_block_start") == 0).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("line"),
    )
    first = placed.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    headers: dict[str, list[str]] = {}
    for file, header in first.orderBy("file").collect():
        headers.setdefault(header, []).append(file)
    return headers


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    delimiter: str = ",",
    encoding: str = "utf-8",
    schema: str | T.StructType | None = None,
    read_options: Mapping[str, Any] | None = None,
    union_columns: bool = False,
    infer: bool = True,
    row_id: bool = False,
) -> DataFrame:
    """Read delimited files with a header line.

    ``path`` may be a glob. Files share one header, and a file that does not is
    an error, unless ``union_columns`` asks for the union of their columns by
    name. Without a ``schema`` types are inferred from the data in one pass.
    """
    options = {"header": True, "sep": delimiter, "encoding": encoding, "enforceSchema": False,
               "escape": '"', **(read_options or {})}
    if union_columns:
        paths = [path] if isinstance(path, str) else path
        groups: dict[str, list[str]] = {}
        for p in paths:
            for header, files in files_by_header(spark, p, encoding).items():
                groups.setdefault(header, []).extend(files)
        if not groups:
            raise FileNotFoundError(f"No files matched path: {path}")
    else:
        groups = {"": [path] if isinstance(path, str) else list(path)}
    parts = []
    for files in groups.values():
        try:
            part = spark.read.options(**options).csv(files)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc):
                raise FileNotFoundError(f"No files matched path: {path}") from exc
            raise
        parts.append(positioned(part) if row_id else part)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [c for c in df.columns if c != ROW]
    df = df.withColumns(
        {c: F.when(~column(c).isin(NULL_TOKENS), column(c)) for c in names}
    )
    if schema is not None:
        return _typed(df, schema)
    return infer_types(df) if infer else df


def flatten(df: DataFrame) -> DataFrame:
    """Turn nested objects into columns named by their dotted path; lists stay."""

    def leaves(dtype: T.DataType, parts: list[str]) -> list[list[str]]:
        if isinstance(dtype, T.StructType):
            return [leaf for f in dtype.fields for leaf in leaves(f.dataType, [*parts, f.name])]
        return [parts]

    found = [
        leaf
        for f in df.schema.fields
        for leaf in ([[f.name]] if f.name == ROW else leaves(f.dataType, [f.name]))
    ]
    names = [".".join(parts) for parts in found]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"Several fields flatten to {clashes}")

    def reach(parts: list[str]) -> Column:
        return reduce(lambda value, part: value.getField(part), parts[1:], column(parts[0]))

    return df.select(*[reach(parts).alias(name) for parts, name in zip(found, names)])


def documents_schema(
    spark: SparkSession, paths: Sequence[str], encoding: str, options: Mapping[str, Any]
) -> T.StructType | None:
    """The schema Spark infers from files that hold a document each, found by many tasks.

    Asked for files, Spark packs them into tasks by their bytes alone, so one task opens
    thousands of small ones in turn. Asked for texts, it infers in the tasks that read them,
    and these count what opening a file costs. None where the files are left to the reader:
    one is too large for a text, or they hold no field.
    """
    sizes = spark.read.options(**options).format("binaryFile").load(list(paths))
    # Files are chosen by their listed names and sizes, so no other one is opened.
    packed = F.when(F.col("_metadata.file_name").rlike(PACKED), PACKED_TIMES).otherwise(1)
    if not sizes.where(F.col("_metadata.file_size") * packed > WHOLE_BYTES).select("path").isEmpty():
        return None
    texts = spark.read.options(**options).text(list(paths), wholetext=True).select("value")
    as_texts = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(encoding=encoding, **options)._jreader
    schema = T.StructType.fromJson(json.loads(reader.json(as_texts).schema().json()))
    return schema if schema.fields else None


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    records_path: str | None = None,
    encoding: str = "utf-8",
    schema: str | T.StructType | None = None,
    read_options: Mapping[str, Any] | None = None,
    row_id: bool = False,
) -> DataFrame:
    """Read JSON records: an array per file, or with ``{"lines": True}`` one per line.

    With ``records_path`` each file is a document that holds its records under
    that dotted path; they are taken out and nested objects are flattened.
    """
    options = dict(read_options or {})
    lines = bool(options.pop("lines", False))
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.options(multiLine=not lines, encoding=encoding, **options)
    try:
        if schema is None and not lines:
            schema = documents_schema(spark, paths, encoding, options)
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.json(paths)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"No files matched path: {path}") from exc
        raise
    if row_id:
        df = positioned(df)
    if not records_path:
        return normalise_missing(df)
    dtype: T.DataType = df.schema
    node: Column | None = None
    for part in records_path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            raise KeyError(f"No records under '{records_path}' in {path}")
        node = column(part) if node is None else node.getField(part)
        dtype = dtype[part].dataType
    missing = F.raise_error(F.lit(f"No records under '{records_path}'"))
    node = F.coalesce(node, missing.cast(dtype))
    kept = [F.col(ROW)] if row_id else []
    if isinstance(dtype, T.ArrayType):
        # The record's place in its document completes the row position.
        found = df.select(*kept, F.posexplode(node).alias("_place", "_record"))
        place = [F.struct(F.col(f"{ROW}.*"), F.col("_place")).alias(ROW)] if row_id else []
        if isinstance(dtype.elementType, T.StructType):
            found = found.select(*place, "_record.*")
        else:
            found = found.select(*place, F.col("_record").alias("0"))
    else:
        found = df.select(*kept, node.alias("_record")).select(*kept, "_record.*")
    return normalise_missing(flatten(found))


def newer_than(df: DataFrame, key: str | None, since: Any) -> DataFrame:
    """Rows strictly newer than ``since``; all rows when there is nothing to compare.

    A timestamp column is compared as it is, so the filter reaches the scan.
    """
    if since is None or not key or key not in df.columns:
        return df
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return df.where(column(key) > F.lit(str(since)).cast("timestamp_ntz"))
    if isinstance(dtype, T.TimestampType):
        return df.where(column(key) > F.lit(str(since)).cast("timestamp"))
    return df.where(column(key).try_cast("timestamp") > F.lit(str(since)).cast("timestamp"))


def watermark_row(df: DataFrame, key: str) -> DataFrame:
    """The newest key of a loaded table, as the one row of ``watermark``."""
    return df.agg(F.max(column(key)).alias("watermark"))


def watermark(df: DataFrame, key: str) -> Any:
    """The newest key of a loaded table, to pass as ``since`` next time."""
    return watermark_row(df, key).first()[0]
