"""Which columns hold only numbers: one aggregation for the whole table."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from adtally.functions.coerce import strict_number, to_day
from adtally.functions.names import is_bookkeeping, is_id_column, quoted


def text_columns(df: DataFrame) -> list[str]:
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return [n for n in texts if not is_id_column(n) and not is_bookkeeping(n)]


def column_profile(df: DataFrame, columns: Iterable[str] | None = None, blank_is_missing: bool = False) -> DataFrame:
    """One row per column: name, non-NULL values, how many of them are numbers, and whether all are."""

    def value(name: str) -> Column:
        return F.nullif(quoted(name), F.lit("")) if blank_is_missing else quoted(name)

    names = list(text_columns(df) if columns is None else columns)
    counted = df.agg(
        *[F.count(value(n)).alias(f"v{i}") for i, n in enumerate(names)],
        *[F.count(strict_number(value(n))).alias(f"n{i}") for i, n in enumerate(names)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                F.col(f"v{i}").alias("non_null"),
                F.col(f"n{i}").alias("numeric_like"),
                ((F.col(f"v{i}") > 0) & (F.col(f"v{i}") == F.col(f"n{i}"))).alias("is_numeric"),
            )
            for i, n in enumerate(names)
        ]
    )
    return counted.select(F.inline(rows))


def numeric_text_columns(df: DataFrame, blank_is_missing: bool = False) -> list[str]:
    """Names of the text columns whose every value is a number. Runs one job; the result has one row per column."""
    names = text_columns(df)
    if not names:
        return []
    profile = column_profile(df, names, blank_is_missing)
    return [row["column_name"] for row in profile.where("is_numeric").collect()]


def observed_profile(df: DataFrame) -> tuple[DataFrame, Callable[[], list[str]]]:
    """``df``, and what tells its numeric text columns once a job has read all of it: the profile rides on that job."""
    names = text_columns(df)
    counter = Observation("profile")
    counts = [F.count(quoted(n)).alias(f"v{i}") for i, n in enumerate(names)]
    counts += [F.count(strict_number(quoted(n))).alias(f"n{i}") for i, n in enumerate(names)]

    def numeric() -> list[str]:
        got = counter.get
        return [n for i, n in enumerate(names) if got[f"v{i}"] and got[f"v{i}"] == got[f"n{i}"]]

    return (df.observe(counter, *counts), numeric) if names else (df, list)


def day_if_all_parse(df: DataFrame, column: str) -> DataFrame:
    """Turn a text column into DATE when every value is one. Runs one job for a text column, none otherwise."""
    if column not in df.columns or not isinstance(df.schema[column].dataType, T.StringType):
        return df
    day = to_day(quoted(column))
    values, days = df.agg(F.count(quoted(column)), F.count(day)).first()
    return df.withColumn(column, day) if values and values == days else df
