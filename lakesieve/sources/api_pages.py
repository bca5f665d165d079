"""Records from landed API responses: one row per response body.

Bodies are parsed as variants inside the JVM. The layout of the records is
found by a distributed aggregate over them, or declared.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import column
from ..functions.json_path import dig
from ..operators.chains import follow
from ..session import materialise
from .files import flatten

# JSON texts that count as "nothing there".
EMPTY_JSON = ["{}", "[]", '""', "0", "0.0", "-0", "false", "null"]


def something(value: Column) -> Column:
    """The variant holds more than an empty object, empty text, zero, false or null."""
    return F.coalesce(~F.to_json(value).isin(EMPTY_JSON), F.lit(False))


def records_in(body: Column, records_path: str | None) -> Column:
    """The records of a parsed body as an array: a list, a lone object, or nothing."""
    found = dig(body, records_path)
    listed = found.try_cast("array<variant>")
    lone = F.when(something(found), F.array(found))
    return F.coalesce(listed, lone, F.array().cast("array<variant>"))


def parsed(pages: DataFrame, body: str = "body") -> DataFrame:
    return pages.withColumn("_body", F.try_parse_json(column(body)))


def cut_pages(
    pages: DataFrame,
    pagination: Mapping[str, Any] | None = None,
    records_path: str | None = None,
    page: str = "page",
    body: str = "body",
    feed: str | None = None,
    max_pages: int | None = None,
) -> DataFrame:
    """Keep the pages a client walking through the source would have fetched.

    Without ``pagination`` every landed page is kept. Otherwise the walk stops after the first
    page without records, and also after the first short page (``offset``), the first page
    without a next cursor (``cursor``) or the very first page (``none``). ``feed`` names a
    column separating independent sources; ``max_pages`` limits each source if a caller names
    a limit.

    Pages are in the order of their number, or, where ``cursor_column`` of the pagination names
    the column of the cursor that each was asked for with, in the order of the cursors.
    """
    number = column(page)
    if pagination and pagination.get("type") == "cursor" and pagination.get("cursor_column"):
        return _walked(pages, pagination, records_path, page, body, feed, max_pages)
    if pagination is None:
        if max_pages is None:
            return pages
        pagination = {"type": "all"}
    kind = pagination.get("type", "none")
    size = F.size(records_in(F.col("_body"), records_path))
    stop = size == 0
    if kind == "none":
        stop = F.lit(True)
    elif kind == "offset":
        stop = stop | (size < int(pagination.get("page_size", 100)))
    elif kind == "cursor":
        cursor = dig(F.col("_body"), pagination.get("next_cursor_path"))
        stop = stop | ~something(cursor)
    elif kind == "all":
        stop = F.lit(None).cast("boolean")
    elif kind != "page":
        raise ValueError(f"Unknown pagination type '{kind}'")
    bounds = [
        F.min(number).alias("_first"),
        F.min(F.when(stop, number)).alias("_stop"),
    ]

    def within(first: Column, last: Column) -> Column:
        kept = last.isNull() | (number <= last)
        return kept if max_pages is None else kept & (number < first + max_pages)

    measured = parsed(pages, body)
    if feed is None:
        found = measured.agg(*bounds).first()
        return pages.where(
            within(F.lit(found["_first"]), F.lit(found["_stop"]).cast("bigint"))
        )
    limits = measured.groupBy(column(feed).alias("_feed")).agg(*bounds)
    joined = pages.join(
        materialise(limits, "page-limits"), column(feed).eqNullSafe(F.col("_feed"))
    )
    return joined.where(within(F.col("_first"), F.col("_stop"))).drop("_feed", "_first", "_stop")


def _walked(
    pages: DataFrame, pagination: Mapping[str, Any], records_path: str | None, page: str, body: str,
    feed: str | None, max_pages: int | None,
) -> DataFrame:
    """The pages that lie on the way of the cursors, from the one asked for without a cursor.

    Of several responses to one cursor the one with the least page number counts, without a
    number the last. A cursor that leads back to an earlier page ends the walk.
    """
    asked, of = column(pagination["cursor_column"]).cast("string"), ["_feed"]
    source = column(feed).cast("string") if feed else F.lit("")
    named = [
        F.concat(F.when(source.isNull(), "-").otherwise("+"), F.coalesce(source, F.lit(""))).alias("_feed"),
        # the first request has no cursor
        F.concat(F.when(asked.isNull(), "-").otherwise("+"), F.coalesce(asked, F.lit(""))).alias("_asked"),
    ]
    whole = F.struct(*[column(c) for c in pages.columns]).alias("_page")
    cursor = dig(F.col("_body"), pagination.get("next_cursor_path"))
    goes_on = (F.size(records_in(F.col("_body"), records_path)) > 0) & something(cursor)
    read = parsed(pages, body).select(*named, column(page).alias("_number"), whole, F.when(goes_on, F.concat(F.lit("+"), cursor.cast("string"))).alias("_next"))
    nodes = read.groupBy("_feed", "_asked").agg(F.min_by(F.struct("_page", "_next"), F.struct(F.col("_number").isNull(), "_number")).alias("n"))
    nodes = materialise(nodes.select("_feed", "_asked", "n._page", "n._next"), "pages")
    starts = nodes.where(F.col("_asked") == "-").select("_feed", "_asked")
    way = follow(nodes.select("_feed", "_asked", "_next"), starts, of, "_asked", "_next", nodes.count() + 1)
    way = way.groupBy("_feed", "_asked").agg(F.min("position").alias("position"))
    if max_pages is not None:
        way = way.where(F.col("position") < max_pages)
    return nodes.join(way, ["_feed", "_asked"], "left_semi").select("_page.*")


def record_layout(records: DataFrame, record: str) -> str:
    """The common type of all records as DDL, by one aggregate over them."""
    found = records.agg(F.schema_of_variant_agg(column(record))).first()[0]
    layout = re.sub(r"\bOBJECT<", "STRUCT<", found or "VOID")
    layout = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", layout)
    return re.sub(r"\bVOID\b", "STRING", layout)


def pages_to_records(
    pages: DataFrame,
    records_path: str | None = None,
    body: str = "body",
    layout: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per record, nested objects flattened to dotted columns.

    ``layout`` declares the record type (``STRUCT<...>``) and saves the pass
    that finds it. ``keep`` names page columns to carry along.
    """
    listed = parsed(pages, body).select(
        *[column(c) for c in keep],
        F.explode(records_in(F.col("_body"), records_path)).alias("_record"),
    )
    layout = layout or record_layout(listed, "_record")
    typed = listed.withColumn("_record", F.col("_record").cast(layout))
    if not layout.startswith("STRUCT<"):
        return typed.withColumnRenamed("_record", "0")
    return flatten(typed.select(*[column(c) for c in keep], "_record.*"))
