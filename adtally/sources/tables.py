"""Catalog tables: layouts, and changes made by writing a new version and swapping it in.

Parquet tables take no row-level statements, so an update is computed as a
DataFrame, written in full beside the table, and only then put in its place.
A fact table is changed one day partition at a time, so the work grows with
the days a batch touches and not with the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from adtally import fixed_values as fv
from adtally.functions.names import column_name, is_bookkeeping, quoted
from adtally.operators.evolve import (
    align_declared, columns_to_add, fit_stored, promotable, repair_types, type_changes, unfit_values,
)
from adtally.operators.keyed import keep_last, reject_null_keys, require_columns, tasks_for, upsert
from adtally.operators.profile import numeric_text_columns
from adtally.operators.reshape import coalesce_duplicates
from adtally.session import drop_stage, write_stage
from adtally.sources import changes

_NEXT = "__next"
#: Comment of a text column that stays text although batches have numbers for it.
KEPT_TEXT = "holds text that is no number"


@dataclass(frozen=True)
class Layout:
    """How a table's files are arranged."""

    partition: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()
    bucket_key: str = ""
    buckets: int = 0


#: Rows that a bucket should hold at most: it is one task of a join, which sorts it.
BUCKET_ROWS = 1_000_000


def buckets_for(rows: int, least: int = 2) -> int:
    """How many buckets tables get of which the largest has so many rows."""
    return max(least, -(-rows // BUCKET_ROWS))


def layout_of(table: str, buckets: int = 0, keys: Sequence[str] | None = None) -> Layout:
    """The layout for a table name; with ``buckets`` it is bucketed by its entity id.

    Facts and a dimension bucketed by the same id into the same number join
    without shuffling either. Such a join has no shuffle to split, so an id
    with very many rows is one task.
    """
    name = table.split(".")[-1]
    entity = (keys or fv.NATURAL_KEYS.get(name, [""]))[0]
    buckets = buckets if entity else 0
    if name == fv.RAW_INSIGHTS:
        return Layout(("level", fv.DATE_PARTITION))
    if name.startswith(fv.FACT_TABLE_PREFIX):
        return Layout((fv.DATE_PARTITION,), tuple(fv.FACT_CLUSTER), entity, buckets)
    return Layout(bucket_key=entity, buckets=buckets)


def stored_layout(spark: SparkSession, table: str) -> Layout:
    """The layout an existing table has."""
    columns = spark.catalog.listColumns(table)
    partition = tuple(c.name for c in columns if c.isPartition)
    key = next((c.name for c in columns if c.isBucket), "")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first() if key else None
    return Layout(partition, layout_of(table).cluster if partition else (), key, int(described["data_type"]) if described else 0)


def laid_out(df: DataFrame, layout: Layout, rows: int = 0) -> DataFrame:
    """Rows in few, sorted files per partition.

    Adaptive execution brings each partition's rows together and splits those
    that are too big, so a day with a third of the rows is written by several
    tasks. The sort lets filters on an account skip row groups. Adaptive
    execution goes by compressed sizes; where a number of ``rows`` is given
    that would fill tasks in memory, they are cut into ranges instead.
    """
    columns = df.columns
    gather = list(layout.partition)
    if layout.buckets:
        df = df.withColumn("_bucket", F.pmod(F.hash(layout.bucket_key), F.lit(layout.buckets)))
        gather.append("_bucket")
    order = [*gather, *(c for c in layout.cluster if c in columns)]
    tasks = tasks_for(df, rows) if gather and layout.cluster else 0
    if tasks:
        gathered = df.repartitionByRange(tasks, *order)
    else:
        gathered = df.hint("rebalance", *gather) if gather else df
    shaped = gathered.sortWithinPartitions(*order) if order else gathered
    return shaped.select(*[quoted(c) for c in columns])


def _create(df: DataFrame, table: str, layout: Layout, arranged: bool = False) -> None:
    """``arranged`` rows come from files of the same layout and are written in their order."""
    writer = (df if arranged and not layout.buckets else laid_out(df, layout)).write.format("parquet")
    if layout.partition:
        writer = writer.partitionBy(*layout.partition)
    if layout.buckets:
        writer = writer.bucketBy(layout.buckets, layout.bucket_key).sortBy(layout.bucket_key)
    writer.saveAsTable(table)


#: Days or months of which a task of a copy has files open at once; beyond, Spark sorts the rest.
OPEN_FILES = 64


def for_copying(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose writes leave rows in the order in which they are read.

    Writing by day or month would sort each task's rows by it, which already lie so in the files they come from.
    """
    copier = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if copier.conf.isModifiable(name):
            copier.conf.set(name, value)
    copier.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    return copier


def write_table(
    df: DataFrame, table: str, mode: str = "append", layout: Layout | None = None, arranged: bool = False
) -> None:
    """Create, append to (``append``), replace (``truncate``) or create only if absent or empty (``if_empty``).

    An existing table keeps its layout; a new one gets the given layout or that of its name. ``arranged`` rows come from
    files of the same layout, and a table that is created or replaced gets them as they lie.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if mode == "if_empty":
        if exists and not spark.table(table).isEmpty():
            raise ValueError(f"table is not empty: {table}")
    elif mode == "truncate" and exists:
        replace_table(df, table, arranged)
        return
    elif mode not in ("append", "truncate"):
        raise ValueError(f"unknown mode: {mode}")
    if not exists:
        wanted = layout or layout_of(table)
        _create(df, table, replace(wanted, partition=tuple(p for p in wanted.partition if p in df.columns)), arranged)
        return
    changes.record(spark, table, None)
    add_columns(spark, table, columns_to_add(df, spark.table(table).columns))
    stored = spark.table(table).schema
    shaped = laid_out(fit_stored(df, table.split(".")[-1], stored), stored_layout(spark, table))
    shaped.select(*[
        (quoted(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in stored
    ]).write.insertInto(table)


def replace_table(
    df: DataFrame, table: str, arranged: bool = False, keys: DataFrame | None = None, layout: Layout | None = None
) -> None:
    """Put ``df``, which may read the table, in its place with the same or the given layout.

    If only rows with some ``keys`` change, the ledger of changes gets these. A failed write leaves the table as it was. Between the drop and the rename
    the new version exists complete beside the table, and ``finish_replace``
    completes an interrupted swap.
    """
    spark = df.sparkSession
    finish_replace(spark, table)
    for leftover in _next_versions(spark, table):
        spark.sql(f"DROP TABLE {leftover}")
    fresh = f"{table}{_NEXT}{uuid.uuid4().hex[:8]}"
    if layout is None:
        layout = stored_layout(spark, table) if spark.catalog.tableExists(table) else layout_of(table)
    layout = replace(layout, partition=tuple(p for p in layout.partition if p in df.columns))
    _create(df, fresh, layout, arranged)
    changes.record(spark, table, None, keys)
    _note_kept_text(spark, fresh, _kept_text(spark, table) if spark.catalog.tableExists(table) else set())
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    finish_replace(spark, table)


def _kept_text(spark: SparkSession, table: str) -> set[str]:
    return {c.name for c in spark.catalog.listColumns(table) if c.description == KEPT_TEXT}


def _note_kept_text(spark: SparkSession, table: str, columns: Iterable[str]) -> None:
    texts = {f.name for f in spark.table(table).schema if isinstance(f.dataType, T.StringType)}
    for column in sorted(texts & set(columns)):
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT '{KEPT_TEXT}'")


def _next_versions(spark: SparkSession, table: str) -> list[str]:
    database, _, name = table.rpartition(".")
    found = spark.catalog.listTables(database or None)
    return [f"{database}.{t.name}" if database else t.name for t in found if t.name.startswith(name + _NEXT)]


def finish_replace(spark: SparkSession, table: str) -> None:
    """Give a complete new version its name if an earlier swap stopped half way."""
    if spark.catalog.tableExists(table):
        return
    for version in _next_versions(spark, table):
        spark.sql(f"ALTER TABLE {version} RENAME TO {table}")
        if any(c.isPartition for c in spark.catalog.listColumns(table)):
            # Not every catalog moves partition paths along with a renamed table.
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def overwrite_partitions(rows: DataFrame, table: str, changed: str | None = None) -> None:
    """Stage the rows in full, then replace the partitions they hold and no others.

    With a column ``changed``, a day without a row for which it holds keeps the files it has.

    Whether an overwrite spares other partitions is a setting of the session,
    so it is done in a session of its own and no other write can be affected.
    """
    spark = rows.sparkSession
    name = table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"
    layout = stored_layout(spark, table)
    day = quoted(layout.partition[0])
    path = write_stage(rows, table.split(".")[-1])
    writer = spark.newSession()
    writer.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    staged = writer.read.schema(rows.schema).parquet(path)
    days = []
    if changed or changes.is_kept(spark, table):
        # Bounded by the calendar.
        days = [r[0] for r in (staged.where(quoted(changed)) if changed else staged).select(day).distinct().collect()]
        changes.record(spark, table, None if None in days else days)
    if changed:
        found = day.isin([d for d in days if d is not None])
        staged = staged.where(found | day.isNull() if None in days else found).drop(changed)
    if days or not changed:
        # Counted from the footers of the stage.
        laid_out(staged, layout, staged.count()).write.insertInto(name, overwrite=True)
        spark.catalog.refreshTable(table)
    drop_stage(spark, path)


def remove_rows(doomed: DataFrame, kept: DataFrame, table: str) -> None:
    """Leave the rows ``kept`` of a table, which are its rows without ``doomed``.

    Of a table by day only the days that lose rows are rewritten; a day left empty goes.
    """
    spark = kept.sparkSession
    kept = kept.select(*[quoted(c) for c in spark.table(table).columns])
    partition = stored_layout(spark, table).partition
    if len(partition) != 1 or not isinstance(kept.schema[partition[0]].dataType, T.DateType):
        replace_table(kept, table)
        return
    day = quoted(partition[0])
    # Bounded by the calendar.
    days = {r[0] for r in doomed.select(day).distinct().collect()}
    if None in days:
        replace_table(kept, table)
        return
    replace_days(kept, table, days)


def replace_days(rows: DataFrame, table: str, days: Iterable[date]) -> None:
    """Replace some partitions of a table by day with what ``rows`` have for those days; a day without rows goes."""
    spark, days = rows.sparkSession, set(days)
    partition = stored_layout(spark, table).partition[0]
    day = quoted(partition)
    chosen = rows.select(*[quoted(c) for c in spark.table(table).columns]).where(day.isin(list(days)))
    staying = {r[0] for r in chosen.select(day).distinct().collect()}
    if days - staying:
        changes.record(spark, table, days - staying)
    if staying:
        overwrite_partitions(chosen.where(day.isin(list(staying))), table)
    for empty in sorted(days - staying):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = DATE'{empty}')")
    spark.catalog.refreshTable(table)


def truncate_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    for table in tables:
        if spark.catalog.tableExists(table):
            changes.record(spark, table, None)
            spark.sql(f"TRUNCATE TABLE {table}")


def add_columns(spark: SparkSession, table: str, fields: Iterable) -> None:
    added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")


def refuse_cut_collisions(names: Iterable[str]) -> None:
    """Fail if different names become one only because stored names keep their last characters."""
    whole: dict[str, str] = {}
    for name in names:
        if not is_bookkeeping(name):
            stored, full = column_name(name), column_name(name, len(name) + 1)
            if whole.setdefault(stored, full) != full:
                raise ValueError(f"columns {whole[stored]} and {full} would both be stored as {stored}: rename one")


def upsert_table(
    spark: SparkSession,
    batch: DataFrame,
    table: str,
    order: Sequence[str] | None,
    keys: Sequence[str] | None = None,
    absent: str = "keep",
    days: Sequence[date] | None = None,
    layout: Layout | None = None,
    nulls: Iterable[str] = (),
    arranged: bool = False,
) -> None:
    """Upsert a batch into a table, creating it or growing its columns first.

    ``order`` says which batch row of a key is newest, or is None for a batch
    that holds each key once; bookkeeping columns are not stored. Of a fact
    table only the day partitions the batch touches are read and rewritten,
    staged in full before any is replaced. They are found by a job over the
    batch's days, or given as ``days``, and then a batch row of another day
    fails the load. ``layout`` is that of a new table, for which ``arranged``
    says that the batch lies so and holds each key once. Columns named in
    ``nulls`` are NULL in every row of the batch.

    Types that the batch has outgrown are changed first (``migrate_types``).
    Days, and tables that are not kept by day, in which no row changes keep
    their files. What changes is noted in the database's ledger.
    """
    name = table.split(".")[-1]
    keys = list(keys or fv.NATURAL_KEYS[name])
    stored_names = [c if is_bookkeeping(c) else column_name(c) for c in batch.columns]
    refuse_cut_collisions(batch.columns)
    batch = coalesce_duplicates(batch.toDF(*stored_names))
    require_columns(batch, keys)
    hidden = [c for c in batch.columns if is_bookkeeping(c)]
    if not spark.catalog.tableExists(table):
        first = reject_null_keys(batch, keys)
        if order is not None:
            first = keep_last(first, keys, order)
        created = align_declared(first.drop(*hidden), name)
        flat = created.select(*[quoted(f.name) for f in columns_to_add(created, [])])
        write_table(flat, table, layout=layout, arranged=arranged)
        return
    migrate_types(spark, table, batch)
    add_columns(spark, table, columns_to_add(batch.drop(*hidden), spark.table(table).columns, name))
    target = spark.table(table)
    nulls = set(nulls) & set(target.columns)
    kept = [c for c in batch.columns if c not in nulls and (c in target.columns or c in (order or ()))]
    batch = fit_stored(batch.select(*[quoted(c) for c in kept]), name, target.schema)
    partition = [p for p in stored_layout(spark, table).partition if p in keys]
    incoming = 0
    if partition:
        day = quoted(partition[0])
        if days is None:
            # One value per day of the batch: bounded by the calendar.
            found = batch.groupBy(day.cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()
            days = [r.day for r in found if r.day is not None]
            incoming = sum(r.n for r in found)
        # Also where the days were found: the source may have changed since.
        outside = F.raise_error(F.lit(f"{partition[0]} outside the days to load"))
        batch = batch.withColumn(partition[0], F.when(day.isNull() | day.cast("date").isin(list(days)), day).otherwise(outside))
        target = target.where(day.isin(list(days)))
    # The table's rows are counted from footers; a batch whose days are given is not read for its count.
    merged = upsert(target, batch, keys, order, absent, changed="_changed", rows=target.count() + incoming, nulls=nulls)
    merged = merged.select(*[quoted(c) for c in target.columns], "_changed")
    if partition:
        overwrite_partitions(merged, table, "_changed")
        return
    path = write_stage(merged, name)
    staged = spark.read.schema(merged.schema).parquet(path)
    touched = staged.where("_changed")
    if not touched.isEmpty():
        replace_table(staged.drop("_changed"), table, keys=touched.select(quoted(keys[0])) if len(keys) == 1 else None)
    drop_stage(spark, path)


def migrate_types(spark: SparkSession, table: str, batch: DataFrame) -> list[str]:
    """Change the stored types that ``batch`` has outgrown; returns the columns changed.

    Whole-number ids become text and declared days DATE. Texts that the batch has as numbers become DOUBLE if all
    stored ones are numbers; else they stay text, which is noted so that no later load looks at them again. A stored
    text that is no day fails, naming table and column. The files are rewritten as they lie, in one job, and swapped in
    whole. A table whose types fit costs no job.
    """
    stored, name = spark.table(table), table.split(".")[-1]
    ids, days, numbers = type_changes(stored, name, batch)
    if numbers:
        kept = _kept_text(spark, table)
        numbers = [n for n in numbers if n not in kept]
    if not ids and not days and not numbers:
        return []
    unfit = unfit_values(stored, batch, days, numbers)
    for day in days:
        if unfit[day] is not None:
            raise ValueError(f"{table}.{day} is to be a day, but holds {unfit[day]!r}")
    texts = [n for n in numbers if unfit[n] is not None]
    promoted = [n for n in numbers if unfit[n] is None]
    if ids or days or promoted:
        layout = stored_layout(spark, table)
        repaired = repair_types(stored, name, promoted)
        unsorted = any(c in layout.partition for c in days)
        replace_table(repaired, table, arranged=not unsorted, layout=layout)
    _note_kept_text(spark, table, texts)
    return [*ids, *days, *promoted]


def repair_table(spark: SparkSession, table: str, batch: DataFrame | None = None) -> None:
    """Rewrite a table whose ids, dates or, judged with the next batch, number columns have outgrown their types."""
    stored = spark.table(table)
    to_number = [] if batch is None else promotable(
        numeric_text_columns(stored, blank_is_missing=True), numeric_text_columns(batch, blank_is_missing=True)
    )
    repaired = repair_types(stored, table.split(".")[-1], to_number)
    if repaired.schema != stored.schema:
        replace_table(repaired, table)


def drop_columns(spark: SparkSession, table: str, columns: Iterable[str]) -> None:
    replace_table(spark.table(table).drop(*columns), table)


def rename_columns(spark: SparkSession, table: str, renames: dict[str, str]) -> None:
    replace_table(spark.table(table).withColumnsRenamed(renames), table)


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, column_name) of every table of a database."""
    rows = [(n, c.name) for n in table_names(spark, database) for c in spark.catalog.listColumns(f"{database}.{n}")]
    return spark.createDataFrame(rows, "table_name STRING, column_name STRING")


def table_names(spark: SparkSession, database: str) -> list[str]:
    """The tables of a database, without views and unfinished versions."""
    names = (t.name for t in spark.catalog.listTables(database) if not t.isTemporary and t.tableType != "VIEW")
    return sorted(n for n in names if _NEXT not in n and n not in changes.SCHEMAS)


def recognised_tables() -> set[str]:
    return {*fv.DECLARED, *fv.NATURAL_KEYS, fv.COMBINED, fv.FULL_VIEW}


def unrecognised_tables(spark: SparkSession, database: str) -> list[str]:
    """Tables nobody declared; reported, never dropped."""
    return sorted(set(table_names(spark, database)) - recognised_tables())


def backup(spark: SparkSession, database: str, backup_database: str, tables: Iterable[str] | None = None) -> list[str]:
    """Copy the recognised tables of a database, in full, into another database."""
    chosen = sorted(set(table_names(spark, database)) & recognised_tables()) if tables is None else list(tables)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {backup_database}")
    for name in chosen:
        source = f"{database}.{name}"
        write_table(spark.table(source), f"{backup_database}.{name}", "truncate", stored_layout(spark, source))
    return chosen


def restore(spark: SparkSession, backup_database: str, database: str, dry_run: bool = False) -> list[str]:
    """Put every table of a backup back. All copies are written before the first table is replaced."""
    tables = table_names(spark, backup_database)
    if dry_run:
        return tables
    for name in tables:
        target, source = f"{database}.{name}", f"{backup_database}.{name}"
        finish_replace(spark, target)
        for leftover in _next_versions(spark, target):
            spark.sql(f"DROP TABLE {leftover}")
        _create(spark.table(source), f"{target}{_NEXT}{uuid.uuid4().hex[:8]}", stored_layout(spark, source))
    for name in tables:
        changes.record(spark, f"{database}.{name}", None)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        finish_replace(spark, f"{database}.{name}")
    return tables


def materialise(df: DataFrame, table: str) -> int:
    """Write a view's rows as a table and return how many there are, counted while writing."""
    counter = Observation("rows")
    write_table(df.observe(counter, F.count(F.lit(1)).alias("n")), table, "truncate")
    return counter.get["n"]
