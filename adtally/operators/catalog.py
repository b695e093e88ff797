"""Set operations over lists of table names, for catalogs held as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def shared_names(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """Names on both sides, each once."""
    return source.select("table_name").intersect(mirror.select("table_name"))


def names_only_in(source: DataFrame, recognised: DataFrame) -> DataFrame:
    """Names of the source nobody recognises, each once."""
    return source.select("table_name").subtract(recognised.select("table_name"))
