"""Column builders for the null, number and time rules of the library.

Every conversion is tolerant: a value that cannot be read becomes null, also
under ANSI mode. NaN counts as missing everywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.FloatType, T.DoubleType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

_INFINITE = ["inf", "+inf", "-inf"]


def quoted(name: str) -> str:
    """``name`` as an identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def without_nan(value: Column, dtype: T.DataType) -> Column:
    """NaN turned into null; other types unchanged."""
    if isinstance(dtype, _FLOATS):
        return F.when(~F.isnan(value), value)
    return value


def is_missing(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, _FLOATS):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def normalise_missing(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every top-level floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATS)]
    if not floats:
        return df
    return df.withColumns({n: without_nan(column(n), column_type(df, n)) for n in floats})


def _plain_number(text: Column) -> Column:
    """False for numbers only Java reads: with a type suffix (``1d``) or hexadecimal."""
    lowered = F.lower(F.trim(text))
    suffixed = F.right(lowered, F.lit(1)).isin("d", "f") & ~lowered.isin(_INFINITE)
    return ~suffixed & ~lowered.contains("x")


def as_number(value: Column, dtype: T.DataType) -> Column:
    """``value`` as a number, null where it is not one."""
    if isinstance(dtype, _FLOATS):
        return without_nan(value, dtype)
    if isinstance(dtype, (*_WHOLE, T.DecimalType)):
        return value
    if isinstance(dtype, T.BooleanType):
        return value.cast("double")
    if isinstance(dtype, T.StringType):
        parsed = value.try_cast("double")
        return F.when(parsed.isNotNull() & ~F.isnan(parsed) & _plain_number(value), parsed)
    return F.lit(None).cast("double")


def as_double(value: Column, dtype: T.DataType) -> Column:
    return as_number(value, dtype).cast("double")


def as_whole(value: Column, dtype: T.DataType) -> Column:
    """Rounded half to even and stored as bigint; null where unreadable."""
    if isinstance(dtype, _WHOLE):
        return value.cast("bigint")
    rounded = F.rint(as_double(value, dtype)).try_cast("bigint")
    if isinstance(dtype, T.StringType):
        # Whole numbers keep all their digits; a double would not.
        return F.coalesce(value.try_cast("bigint"), rounded)
    return rounded


def as_timestamp(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return value
    if isinstance(dtype, (T.TimestampNTZType, T.DateType, T.StringType)):
        return value.try_cast("timestamp")
    return F.lit(None).cast("timestamp")


def as_flag(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, (*_WHOLE, *_FLOATS)):
        return F.when(value == 0, F.lit(False)).when(value == 1, F.lit(True))
    return value.try_cast("boolean")


def epoch_micros(value: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970 in UTC; a zone-less time counts as UTC."""
    if isinstance(dtype, T.TimestampNTZType):
        origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", origin, value)
    return F.unix_micros(as_timestamp(value, dtype))


def fitting_literals(values: Iterable, dtype: T.DataType) -> list:
    """The members of ``values`` a column of this type can be equal to."""
    if isinstance(dtype, T.StringType):
        return [v for v in values if isinstance(v, str)]
    if isinstance(dtype, T.BooleanType):
        return [v for v in values if v in (0, 1) and not isinstance(v, str)]
    if isinstance(dtype, (*_WHOLE, *_FLOATS, T.DecimalType)):
        # True and False are the numbers one and zero
        return [int(v) if isinstance(v, bool) else v for v in values if isinstance(v, (int, float))]
    return list(values)


def is_in(value: Column, values: Sequence, dtype: T.DataType) -> Column:
    """Membership that never mixes types; false for an empty set."""
    literals = fitting_literals(values, dtype)
    if isinstance(dtype, T.BooleanType):
        literals = [bool(v) for v in literals]
    return value.isin(literals) if literals else F.lit(False)


def grouping_key(df: DataFrame, name: str) -> Column:
    """Key expression under which NaN and null are the same value."""
    return without_nan(column(name), column_type(df, name)).alias(name)
