"""Upkeep of a database: erasing accounts, pruning and renaming columns, loading goals and the registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from adtally import fixed_values as fv
from adtally.operators import fieldmap
from adtally.operators.erase import delete_targets, erase_report, erased_rows, surviving_rows
from adtally.operators.goals import goals_sql, read_goals
from adtally.operators.registry import merge_registry, registry_from_accounts, sort_registry
from adtally.plans.loads import create_full_view
from adtally.plans.sync import sync_tables
from adtally.session import stage
from adtally.sources import tables
from adtally.sources.landed import read_text_csv


def erase_accounts(spark: SparkSession, database: str, delete_list: DataFrame, confirm: bool = False) -> DataFrame:
    """Erase marked accounts from every table tied to an account; without ``confirm`` only count.

    Returns rows per table and in total, counted before anything changes. The
    links through dimensions are resolved on the state before the erasure, so
    it does not matter which table goes first. Tables, and days of facts,
    without such rows keep their files.
    """
    names = tables.table_names(spark, database)
    frames = {n: spark.table(f"{database}.{n}") for n in names}
    targets = stage(delete_targets(delete_list), "erase-targets")
    report = stage(erase_report(frames, targets), "erase-report")
    if confirm:
        linked = {n: k for n, k in _LINK_KEYS.items() if n in frames and "account_id" in frames[n].columns}
        dims = {n: stage(frames[n].select(k, "account_id"), n) for n, k in linked.items()}
        # One row per table.
        touched = {r["table_name"] for r in report.where("rows_erased > 0").collect()}
        for name in (n for n in names if n in touched):
            links = {**frames, **dims}
            kept = surviving_rows(name, frames[name], targets, links)
            if kept is not None:
                tables.remove_rows(erased_rows(name, frames[name], targets, links), kept, f"{database}.{name}")
        create_full_view(spark, database)
    return report


_LINK_KEYS = {fv.ADS: "ad_id", fv.ADSETS: "adset_id", fv.CAMPAIGNS: "campaign_id"}


def prune_columns(spark: SparkSession, database: str, field_map: DataFrame, dry_run: bool = False) -> DataFrame:
    """Drop the stored columns of excluded fields; returns the plan with what was found."""
    plan = stage(fieldmap.prune_plan(field_map, tables.catalog_columns(spark, database)), "prune-plan")
    if not dry_run:
        for row in fieldmap.columns_by_table(plan).collect():
            tables.drop_columns(spark, f"{database}.{row['table_name']}", row["columns"])
        create_full_view(spark, database)
    return plan


def migrate_renames(
    spark: SparkSession, database: str, field_map: DataFrame, dry_run: bool = False, backup_database: str | None = None
) -> DataFrame:
    """Rename stored columns as the field map says, after an optional backup; returns the plan with outcomes."""
    plan = stage(fieldmap.rename_plan(field_map, tables.catalog_columns(spark, database)), "rename-plan")
    if dry_run:
        return plan
    if backup_database:
        tables.backup(spark, database, backup_database)
    due: dict[str, dict[str, str]] = {}
    for row in plan.where("outcome = 'rename'").collect():
        due.setdefault(row["table_name"], {})[row["old_name"]] = row["new_name"]
    for name, renames in due.items():
        tables.rename_columns(spark, f"{database}.{name}", renames)
    create_full_view(spark, database)
    return plan


def load_goals(spark: SparkSession, database: str, csv_path: str, mirror: str | None = None) -> DataFrame:
    """Upsert a goals file, mirror the goals in full, and define the goals view where delivery is combined."""
    goals = read_goals(read_text_csv(spark, csv_path)).withColumn("_line", F.monotonically_increasing_id())
    tables.upsert_table(spark, goals, f"{database}.{fv.GOALS}", ["_line"])
    if mirror:
        sync_tables(spark, database, mirror, [fv.GOALS], create=True)
    for place in filter(None, (mirror, database)):
        if spark.catalog.tableExists(f"{place}.{fv.COMBINED}"):
            delivery = f"{place}.{fv.COMBINED}"
            text = goals_sql(delivery, f"{place}.{fv.GOALS}", spark.table(delivery).columns)
            spark.sql(f"CREATE OR REPLACE VIEW {place}.{fv.GOALS_VIEW} AS {text}")
            break
    return spark.table(f"{database}.{fv.GOALS}")


def refresh_registry(spark: SparkSession, database: str, accounts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Renew the registry from freshly landed accounts, keeping what users set; returns it sorted."""
    table = f"{database}.{fv.REGISTRY}"
    fresh = registry_from_accounts(accounts, order)
    if spark.catalog.tableExists(table):
        tables.replace_table(merge_registry(fresh, spark.table(table)), table)
    else:
        tables.write_table(fresh, table)
    return sort_registry(spark.table(table))
