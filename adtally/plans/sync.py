"""Mirroring tables from one database to another."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from adtally import fixed_values as fv
from adtally.functions.names import mirror_column_name
from adtally.operators.keyed import prepare_for_mirror
from adtally.operators.profile import day_if_all_parse
from adtally.sources import changes
from adtally.sources.tables import (
    Layout, for_copying, replace_days, stored_layout, table_names, truncate_tables, upsert_table, write_table,
)

MODES = ("auto", "merge", "truncate", "append")


def sync_mode(table: str, mode: str = "auto") -> str:
    """The mode a table is mirrored with; a merge needs a table that is configured for it."""
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"unsupported sync mode: {mode}")
    default = fv.SYNC_MODES.get(table, "truncate")
    chosen = default if mode == "auto" else mode
    if chosen == "merge" and default != "merge":
        raise ValueError(f"no merge keys configured for table {table}: use truncate or append")
    return chosen


def choose_tables(requested: Iterable[str], source: Iterable[str], mirror: Iterable[str], create: bool = False) -> list[str]:
    """The requested names, or for ``all`` those on both sides (with ``create``: recognised ones in the source)."""
    names = [n.strip() for n in requested if n.strip()]
    if not names:
        raise ValueError("name at least one table to mirror")
    if [n.lower() for n in names] != ["all"]:
        return names
    common = sorted(set(source) & (set(fv.DECLARED) | set(fv.NATURAL_KEYS) if create else set(mirror)))
    if not common:
        raise ValueError("source and mirror have no table in common")
    return common


def sync_tables(
    spark: SparkSession,
    source: str,
    mirror: str,
    tables: Iterable[str],
    mode: str = "auto",
    create: bool = False,
    exclude: Mapping[str, Sequence[str]] | None = None,
    rename: str | None = None,
    days: Sequence[date] | None = None,
    owed: bool = False,
) -> list[str]:
    """Mirror tables, or named views, of database ``source`` into database ``mirror``; returns the mirrored names.

    Every table is checked before the first one is written. Partitions of the
    source are the unit of work, so there are no chunks to size. With ``days``
    a fact table that is merged into an existing mirror takes only those along.

    With ``owed`` the source keeps a ledger of its changes, and the mirror gets
    what it lacks: the changed days of tables that are merged or kept by day,
    other tables whole, and nothing of a table that did not change. What a
    failed run left out comes with the next one.
    """
    names = choose_tables(tables, table_names(spark, source), table_names(spark, mirror), create)
    if rename and len(names) != 1:
        raise ValueError("a different mirror name needs a single table")
    targets = {name: rename or name for name in names}
    modes = {name: sync_mode(name, mode) for name in names}
    for name, target in targets.items():
        if not spark.catalog.tableExists(f"{source}.{name}"):
            raise ValueError(f"source table does not exist: {source}.{name}")
        if not create and not spark.catalog.tableExists(f"{mirror}.{target}"):
            raise ValueError(f"mirror table does not exist: {mirror}.{target}")
    consumer = f"mirror {mirror}" + (f".{rename}" if rename else "")
    copier = for_copying(spark)
    if owed:
        changes.start(spark, source)
        due, before = changes.owed(spark, source, consumer, names), changes.logged(spark, source)
    for name, target in targets.items():
        rows = spark.table(f"{source}.{name}").drop(*(exclude or {}).get(name, ()))
        target = f"{mirror}.{target}"
        is_view = spark.catalog.getTable(f"{source}.{name}").tableType == "VIEW"
        stored = None if is_view else stored_layout(spark, f"{source}.{name}")
        layout = replace(stored, bucket_key="", buckets=0) if stored else None
        if stored == layout and _copied(spark, target, modes[name], layout):
            rows = copier.table(f"{source}.{name}").drop(*(exclude or {}).get(name, ()))
        if not owed or is_view or modes[name] == "append":
            _mirror(spark, rows, name, target, modes[name], days, layout)
            continue
        entries = due[name] if spark.catalog.tableExists(target) else None
        if entries is None:
            _mirror(spark, rows, name, target, modes[name], None, layout)
        elif entries:
            changed = {e.day for e in entries}
            by_day = None if None in changed else sorted(changed)
            if modes[name] == "merge" or by_day is None or not _replace_days(spark, rows, name, target, by_day):
                _mirror(spark, rows, name, target, modes[name], by_day, layout)
        changes.take(spark, source, consumer, name, before if due[name] is None else due[name], whole=due[name] is None)
    if owed:
        changes.prune(spark, source)
    return names


def _replace_days(spark: SparkSession, rows: DataFrame, name: str, target: str, days: Sequence[date]) -> bool:
    """Replace some days of a mirror table that is kept by the same days as its source; False if it isn't."""
    partition = stored_layout(spark, target).partition
    prepared = prepare_for_mirror(rows, name)
    if len(partition) != 1 or prepared.columns != spark.table(target).columns:
        return False
    if prepared.schema[partition[0]].dataType != spark.table(target).schema[partition[0]].dataType:
        return False
    replace_days(prepared, target, days)
    return True


def _copied(spark: SparkSession, target: str, mode: str, layout: Layout | None) -> bool:
    """Whether a mirror table is written whole and by the same days or months as its source, so that files match."""
    if layout is None or not layout.partition or mode == "append":
        return False
    return not spark.catalog.tableExists(target) or (mode == "truncate" and stored_layout(spark, target) == layout)


def _mirror(
    spark: SparkSession, rows: DataFrame, name: str, target: str, mode: str, days: Sequence[date] | None, layout: Layout | None
) -> None:
    """Write one mirror table; a new one is laid out like its source, where that is kept by day or month."""
    arranged = _copied(spark, target, mode, layout)
    layout = layout if layout and layout.partition else None
    if mode != "merge" or fv.DATE_PARTITION not in fv.NATURAL_KEYS[name] or not spark.catalog.tableExists(target):
        days = None
    if days is not None:
        rows = rows.where(F.col(fv.DATE_PARTITION).cast("date").isin(list(days)))
    prepared = prepare_for_mirror(rows, name)
    if name.startswith(fv.FACT_TABLE_PREFIX):
        prepared = day_if_all_parse(prepared, fv.DATE_PARTITION)
    if mode == "merge":
        # Source tables hold a key once.
        given = {mirror_column_name(c) for c in rows.columns}
        upsert_table(
            spark, prepared, target, order=None, keys=fv.NATURAL_KEYS[name], days=days, layout=layout, arranged=arranged,
            nulls=[c for c in prepared.columns if c not in given],
        )
    elif mode == "truncate" and prepared.isEmpty():
        truncate_tables(spark, [target])
    else:
        write_table(prepared, target, mode, layout, arranged)
    if arranged:
        # Written by a session of its own.
        spark.catalog.refreshTable(target)
        changes.refresh(spark, target)
