"""Lenient conversions: what cannot be read becomes NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from adtally.functions.names import quoted

MONEY = T.DecimalType(38, 9)

# The texts that count as a number, and the characters around a text that do not matter.
NUMBER_PATTERN = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf(?:inity)?))$"
ASCII_SPACE = " \t\n\x0b\x0c\r"
SPACE = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())

_HAS_ZONE = r"[0-9](Z|z|[+-]\d{2}:?\d{2})$"


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE))


def strict_number(c: Column) -> Column:
    """DOUBLE of a text, NULL unless the whole text is a number.

    ``try_cast`` alone also reads ``12d`` and ``NaN``, which are not numbers here.
    """
    text = F.btrim(c, F.lit(ASCII_SPACE))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_boolean(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.BooleanType):
        return c
    if isinstance(data_type, T.NumericType):
        nan_as_null = F.nullif(c, F.lit(float("nan"))) if isinstance(data_type, (T.DoubleType, T.FloatType)) else c
        return nan_as_null != 0
    return F.lower(stripped(c)).try_cast("boolean")


def to_decimal(c: Column) -> Column:
    return c.try_cast(MONEY)


def to_whole_number(c: Column) -> Column:
    """LONG of a number or number text; NULL when it has a fraction or is not a number."""
    exact = c.try_cast("decimal(38,9)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def to_utc_timestamp(c: Column) -> Column:
    """TIMESTAMP of an ISO text; a text without an offset is taken as UTC in any session zone."""
    text = stripped(c)
    timed = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.concat(text, F.lit("T00:00:00"))).when(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}$"), F.concat(text, F.lit(":00"))
    )
    full = F.coalesce(timed, text)
    zoned = F.when(full.rlike(_HAS_ZONE) & full.contains(":"), full).otherwise(F.concat(full, F.lit("Z")))
    return zoned.try_cast("timestamp")


def to_day(c: Column) -> Column:
    return stripped(c.cast("string")).try_cast("date")


def month_start(c: Column) -> Column:
    """First day of the month of a date or date text."""
    return F.trunc(c.cast("date"), "MM")


def sorted_json(c: Column, data_type: T.DataType) -> Column:
    """JSON text of a nested value with object keys in name order and NULLs kept."""
    return F.to_json(_by_field_name(c, data_type), {"ignoreNullFields": "false"})


def _by_field_name(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StructType):
        ordered = sorted(data_type.fields, key=lambda f: f.name)
        rebuilt = F.struct(*[_by_field_name(c.getField(f.name), f.dataType).alias(f.name) for f in ordered])
        return F.when(c.isNotNull(), rebuilt)
    if isinstance(data_type, T.ArrayType):
        return F.transform(c, lambda item: _by_field_name(item, data_type.elementType))
    if isinstance(data_type, T.MapType):
        values = F.transform_values(c, lambda _, v: _by_field_name(v, data_type.valueType))
        return F.map_from_entries(F.array_sort(F.map_entries(values)))
    return c


def declared_cast(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Cast the declared columns that are present; other columns pass through."""
    wanted = {f.name: f.dataType for f in declared}
    return df.select(
        *[
            _as_type(quoted(f.name), f.dataType, wanted[f.name]).alias(f.name) if f.name in wanted else quoted(f.name)
            for f in df.schema
        ]
    )


def _as_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return c
    nested = isinstance(have, (T.StructType, T.ArrayType, T.MapType))
    if isinstance(want, T.StringType):
        return sorted_json(c, have) if nested else c.cast("string")
    if nested:
        return F.lit(None).cast(want)
    if isinstance(want, T.BooleanType):
        return to_boolean(c, have)
    if isinstance(want, T.DateType):
        return to_day(c)
    if isinstance(want, T.TimestampType) and isinstance(have, T.StringType):
        return to_utc_timestamp(c)
    if isinstance(want, T.IntegralType):
        return to_whole_number(c).try_cast(want)
    return c.try_cast(want)
