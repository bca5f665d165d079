"""Duplicate keys: counting them, flagging later copies, and dropping them.

Nothing here gathers a key's rows in one task. Counting and picking the first
row are aggregates with a map-side step, so a key that holds a third of the
table shrinks to one row per task before the shuffle. Flagging joins the rows
to the (materialised) table of duplicated keys: it is broadcast when its size
allows, and otherwise adaptive execution splits the partitions of hot keys.
Where very many keys are repeated, copies are ranked after one shuffle of the
rows instead, but for keys of very many copies, which are joined as before.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import column, grouping_key
from ..session import ROW, materialise

FIRST, COPIES = "_first", "_copies"

#: Repeated keys up to which their first rows are looked for ahead, to be broadcast: some 7 MB of stored numbers.
FEW_KEYS = 750_000
#: Copies of a key up to which one task compares them.
CROWD = 10_000
#: Parts into which the rows of a key with more copies are dealt.
PARTS = 1_000


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key values that occur more than once, with their number of rows."""
    counted = df.groupBy(*[grouping_key(df, k) for k in keys]).agg(F.count("*").alias(COPIES))
    return counted.where(F.col(COPIES) > 1)


def duplicate_row_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows sharing their key with another row, every copy counted; one row."""
    total = F.coalesce(F.sum(COPIES), F.lit(0).cast("bigint"))
    return duplicate_keys(df, keys).agg(total.alias("duplicate_rows"))


def order_key(df: DataFrame, order_by: Sequence[str], tie_break: Sequence[str]) -> Column:
    return F.struct(*[column(c) for c in [*order_by, *tie_break]])


def first_of_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    plain: DataFrame | None = None,
) -> DataFrame:
    """For each duplicated key, its number of rows and the position of its first row.

    ``df`` carries ``_row``; first means lowest in ``order_by``, then in file
    order. The keys are counted first, which moves nothing but keys (``plain``, the
    table without ``_row``, may save reading row positions for that), and positions
    are compared among the rows of repeated keys alone. Both results are written, so
    Catalyst knows their size and decides itself how to join them.
    """
    return _end_of_duplicates(df, keys, order_by, plain, F.min)


def _end_of_duplicates(df, keys, order_by, plain, pick) -> DataFrame:
    repeated = materialise(duplicate_keys(df if plain is None else plain, keys), "repeated-keys")
    return _ends(df, repeated, keys, order_by, pick)


def _ends(df, repeated, keys, order_by, pick) -> DataFrame:
    marked = repeated.select(*[column(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    candidates = df.join(marked, _same_key(df, keys, "_key"), "left_semi")
    end = pick(order_key(df, order_by, [ROW]))[ROW]
    grouped = candidates.groupBy(*[grouping_key(df, k) for k in keys])
    return materialise(grouped.agg(F.count("*").alias(COPIES), end.alias(FIRST)), "duplicates")


def _same_key(df: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    parts = (grouping_key(df, k).eqNullSafe(F.col(f"{prefix}_{i}")) for i, k in enumerate(keys))
    return reduce(and_, parts)


def flag_later_copies(
    df: DataFrame, firsts: DataFrame, keys: Sequence[str], flag: str
) -> DataFrame:
    """Add ``flag``: the row's key occurs earlier in the table.

    ``firsts`` is the result of :func:`first_of_duplicates`.
    """
    renamed = firsts.select(
        *[column(k).alias(f"{flag}_{i}") for i, k in enumerate(keys)],
        F.col(FIRST).alias(f"{flag}_first"),
    )
    later = F.col(f"{flag}_first").isNotNull() & (F.col(ROW) != F.col(f"{flag}_first"))
    joined = df.join(renamed, _same_key(df, keys, flag), "left")
    return joined.withColumn(flag, later).drop(*renamed.columns)


def find_copies(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    plain: DataFrame | None = None,
) -> DataFrame:
    """The duplicated keys with their number of rows, written once, for :func:`flag_copies`.

    Of few keys the first rows are given as well, as by :func:`first_of_duplicates`. Of many
    they are not: finding them moves every row's key and position, and a join with them the
    whole table, where one move of the table is enough.
    """
    repeated = materialise(duplicate_keys(df if plain is None else plain, keys), "repeated-keys")
    if repeated.count() <= FEW_KEYS:
        return _ends(df, repeated, keys, order_by, F.min)
    return repeated


def flag_copies(
    df: DataFrame, found: DataFrame, keys: Sequence[str], order_by: Sequence[str], flag: str
) -> DataFrame:
    """Add ``flag`` as :func:`flag_later_copies` does; ``found`` is the result of :func:`find_copies`.

    Where it has no first rows, a key's rows meet in one task and are ranked. Those of a key
    with more than ``CROWD`` copies do not: their first row comes from an aggregate, and they
    are dealt to many tasks.
    """
    if FIRST in found.columns:
        return flag_later_copies(df, found, keys, flag)
    crowded = _ends(df, materialise(found.where(F.col(COPIES) > CROWD), "crowded-keys"), keys, order_by, F.min)
    part, place = f"{flag}_part", f"{flag}_place"
    marked = crowded.select(*[column(k).alias(f"{flag}_{i}") for i, k in enumerate(keys)], F.col(FIRST).alias(f"{flag}_first"))
    first = F.col(f"{flag}_first")
    dealt = df.join(marked, _same_key(df, keys, flag), "left").withColumns({
        flag: first.isNotNull() & (F.col(ROW) != first),
        part: F.when(first.isNull(), 0).otherwise(F.pmod(F.xxhash64(ROW), F.lit(PARTS)) + 1).cast("int"),
    }).drop(*marked.columns)
    same = Window.partitionBy(*[grouping_key(df, k) for k in keys], part).orderBy(*[column(c) for c in [*order_by, ROW]])
    ranked = dealt.withColumn(place, F.rank().over(same))
    later = F.col(flag) | ((F.col(part) == 0) & (F.col(place) > 1))
    return ranked.withColumn(flag, later).drop(part, place)


def drop_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    keep: str | bool = "first",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per key (the first or the last), or with ``keep=False`` none.

    Order is ``order_by``, then file position where the rows carry it, then the
    remaining columns; rows equal in all of them are interchangeable.
    """
    values = [c for c in df.columns if c != ROW]
    keys = list(subset) if subset else values
    if keep is not False and set(keys) == set(values) and ROW not in df.columns:
        return df.dropDuplicates()
    if keep is False:
        grouped = df.groupBy(*[grouping_key(df, k).alias(f"_key_{i}") for i, k in enumerate(keys)])
        whole = F.struct(*[column(c) for c in df.columns])
        kept = grouped.agg(F.count("*").alias(COPIES), F.any_value(whole).alias("_kept"))
        return kept.where(F.col(COPIES) == 1).select("_kept.*")
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    if ROW in df.columns:
        ends = _end_of_duplicates(df, keys, order_by, df.drop(ROW), F.min if keep == "first" else F.max)
        flagged = flag_later_copies(df, ends, keys, "_dropped")
        return flagged.where(~F.col("_dropped")).drop("_dropped")
    return _kept_by_content(df, keys, keep, order_by)


def _kept_by_content(df: DataFrame, keys: Sequence[str], keep: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key where rows have no position: unique rows pass, the others are compared."""
    repeated = materialise(duplicate_keys(df, keys), "repeated-keys")
    marked = repeated.select(*[column(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    same = _same_key(df, keys, "_key")
    rows = df.join(marked, same, "left_semi")
    grouped = rows.groupBy(*[grouping_key(df, k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    if all(_orderable(f.dataType) for f in df.schema.fields):
        # The order takes in every column, so the least or greatest one is the whole row.
        rest = [c for c in df.columns if c not in order_by]
        pick = F.min if keep == "first" else F.max
        kept = grouped.agg(pick(order_key(df, order_by, rest)).alias("_kept"))
    else:
        pick = F.min_by if keep == "first" else F.max_by
        whole = F.struct(*[column(c) for c in df.columns])
        kept = grouped.agg(pick(whole, order_key(df, order_by, [])).alias("_kept"))
    picked = kept.select(*[F.col("_kept").getField(c).alias(c) for c in df.columns])
    return df.join(marked, same, "left_anti").unionByName(picked)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))
