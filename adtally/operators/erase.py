"""Erasing accounts: which rows go, which stay, and how many."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from adtally import fixed_values as fv
from adtally.functions.accounts import both_spellings
from adtally.functions.coerce import stripped


def delete_targets(rows: DataFrame) -> DataFrame:
    """Account ids and names marked for deletion in an all-text list."""
    marked = F.upper(stripped(F.col("delete"))).isin(fv.DELETE_TOKENS)
    account = stripped(F.col("account_id"))
    return rows.where(marked & (account != "")).select(
        account.alias("account_id"), stripped(F.coalesce("account_name", F.lit(""))).alias("account_name")
    )


def all_spellings(targets: DataFrame) -> DataFrame:
    """Target ids with and without the prefix, each once."""
    return targets.select(F.explode(both_spellings(F.col("account_id"))).alias("account_id")).distinct()


def victim_keys(table: str, df: DataFrame, targets: DataFrame, dims: Mapping[str, DataFrame]) -> tuple[str, DataFrame] | None:
    """The column that ties a table to accounts and its values to erase; None when nothing does."""
    spellings = all_spellings(targets)
    if table == fv.ACCOUNTS and "id" in df.columns:
        # Accounts always store the prefixed spelling, so the ids apply as given.
        return "id", targets.select(F.col("account_id").alias("id")).distinct()
    if "account_id" in df.columns:
        return "account_id", spellings
    for column, dim_name in fv.ENTITY_LINKS:
        dim = dims.get(dim_name)
        if column in df.columns and dim is not None and "account_id" in dim.columns:
            return column, dim.join(spellings, "account_id", "left_semi").select(column).distinct()
    return None


def erased_rows(table: str, df: DataFrame, targets: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame | None:
    link = victim_keys(table, df, targets, dims)
    return None if link is None else df.join(link[1], link[0], "left_semi")


def surviving_rows(table: str, df: DataFrame, targets: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame | None:
    """Rows to keep; rows with no account survive."""
    link = victim_keys(table, df, targets, dims)
    return None if link is None else df.join(link[1], link[0], "left_anti")


def erase_report(tables: Mapping[str, DataFrame], targets: DataFrame) -> DataFrame:
    """(table_name, rows_erased) for every table tied to an account, and the total over all of them."""
    counts = []
    for name, df in tables.items():
        doomed = erased_rows(name, df, targets, tables)
        if doomed is not None:
            counts.append(doomed.agg(F.count(F.lit(1)).alias("rows_erased")).select(F.lit(name).alias("table_name"), "rows_erased"))
    per_table = reduce(DataFrame.unionByName, counts)
    return per_table.rollup("table_name").agg(F.sum("rows_erased").alias("rows_erased")).select(
        F.coalesce("table_name", F.lit("(total)")).alias("table_name"), "rows_erased"
    )
