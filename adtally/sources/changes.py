"""Which stored days changed, kept until everything that is derived from them has caught up.

A database keeps such a ledger once something is derived from it: a mirror, or the combined table. Writers add entries
before they put a change in place, so an interrupted write is looked at again rather than forgotten. Each consumer takes
the entries it has dealt with, after its own write succeeded; entries that all consumers took go. An entry names a table
and a day of it, or no day for a table that is not kept by day; the keys of such a table's changed rows lie beside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

LOG = "etl_changes"
KEYS = "etl_changed_keys"
TAKEN = "etl_changes_taken"
#: Kept by entry, so that what everybody took goes without a rewrite.
SCHEMAS = {
    LOG: "table_name STRING, day DATE, has_keys BOOLEAN, entry STRING",
    KEYS: "key STRING, entry STRING",
    TAKEN: "consumer STRING, table_name STRING, entry STRING",
}
#: Stand for a consumer's interest in a table, from before it first reads it, and for its having taken all of it.
ASKED, WHOLE = "asked", "whole"


class Entry(NamedTuple):
    table_name: str
    day: date | None
    has_keys: bool
    entry: str


def _split(spark: SparkSession, table: str) -> tuple[str, str]:
    database, _, name = table.rpartition(".")
    return database or spark.catalog.currentDatabase(), name


def is_kept(spark: SparkSession, table: str) -> bool:
    """Whether the database of ``table`` keeps a ledger, and ``table`` is not part of it."""
    database, name = _split(spark, table)
    return name not in SCHEMAS and spark.catalog.tableExists(f"{database}.{LOG}")


def start(spark: SparkSession, database: str) -> None:
    """Keep a ledger from here on."""
    for name, schema in reversed(SCHEMAS.items()):
        if not spark.catalog.tableExists(f"{database}.{name}"):
            spark.createDataFrame([], schema).write.partitionBy("entry").saveAsTable(f"{database}.{name}")


def _append(df: DataFrame, table: str) -> None:
    df.write.insertInto(table)
    df.sparkSession.catalog.refreshTable(table)


def refresh(spark: SparkSession, table: str) -> None:
    """Forget what ``spark`` knows of the ledger of ``table``, to which another session may have added."""
    for name in SCHEMAS if is_kept(spark, table) else ():
        spark.catalog.refreshTable(f"{_split(spark, table)[0]}.{name}")


def record(spark: SparkSession, table: str, days: Iterable[date] | None, keys: DataFrame | None = None) -> None:
    """Note that days of ``table`` are about to change, or rows with ``keys`` (one column), or all of it.

    Nothing is noted where nobody asked for the table.
    """
    if not is_kept(spark, table):
        return
    database, name = _split(spark, table)
    asked = spark.table(f"{database}.{TAKEN}").where((F.col("entry") == ASKED) & (F.col("table_name") == name))
    if asked.isEmpty():
        return
    entry = uuid.uuid4().hex
    if keys is not None:
        named = keys.toDF("key").select(F.col("key").cast("string"), F.lit(entry).alias("entry"))
        _append(named, f"{database}.{KEYS}")
    rows = [(name, d, keys is not None, entry) for d in ([None] if days is None else sorted(days))]
    if rows:
        _append(spark.createDataFrame(rows, SCHEMAS[LOG]).coalesce(1), f"{database}.{LOG}")


def logged(spark: SparkSession, database: str) -> list[Entry]:
    """All entries: as many as days that changed since everybody took them."""
    return [Entry(*r) for r in spark.table(f"{database}.{LOG}").collect()]


def owed(spark: SparkSession, database: str, consumer: str, tables: Sequence[str]) -> dict[str, list[Entry] | None]:
    """For each table what ``consumer`` has not taken yet; None where it never took the table, and so needs all of it."""
    taken = spark.table(f"{database}.{TAKEN}").where(F.col("consumer") == consumer).select("table_name", "entry")
    done = {tuple(r) for r in taken.collect()}
    asked = [(consumer, t, ASKED) for t in tables if (t, ASKED) not in done]
    if asked:
        _append(spark.createDataFrame(asked, SCHEMAS[TAKEN]).coalesce(1), f"{database}.{TAKEN}")
    entries = logged(spark, database)
    return {
        t: [e for e in entries if e.table_name == t and (t, e.entry) not in done] if (t, WHOLE) in done else None
        for t in tables
    }


def take(spark: SparkSession, database: str, consumer: str, table: str, entries: Iterable[Entry], whole: bool = False) -> None:
    """``consumer`` has dealt with ``entries`` of ``table``, for the first time by taking it ``whole``."""
    done = {e.entry for e in entries if e.table_name == table} | ({WHOLE} if whole else set())
    if done:
        rows = [(consumer, table, e) for e in sorted(done)]
        _append(spark.createDataFrame(rows, SCHEMAS[TAKEN]).coalesce(1), f"{database}.{TAKEN}")


def prune(spark: SparkSession, database: str) -> None:
    """Drop the entries that every consumer of their table has taken."""
    taken = [tuple(r) for r in spark.table(f"{database}.{TAKEN}").collect()]
    consumers: dict[str, set[str]] = {}
    for consumer, table, entry in taken:
        if entry == ASKED:
            consumers.setdefault(table, set()).add(consumer)
    done: dict[tuple[str, str], set[str]] = {}
    for consumer, table, entry in taken:
        done.setdefault((table, entry), set()).add(consumer)
    for table, entry in sorted({(e.table_name, e.entry) for e in logged(spark, database)}):
        if consumers.get(table) and consumers[table] <= done.get((table, entry), set()):
            for name in (LOG, KEYS, TAKEN):
                spark.sql(f"ALTER TABLE {database}.{name} DROP IF EXISTS PARTITION (entry = '{entry}')")
    for name in SCHEMAS:
        spark.catalog.refreshTable(f"{database}.{name}")


def changed_keys(spark: SparkSession, database: str, entries: Iterable[Entry]) -> DataFrame:
    """The keys noted with ``entries``, as ``key``."""
    names = sorted({e.entry for e in entries})
    return spark.table(f"{database}.{KEYS}").where(F.col("entry").isin(names)).select("key").distinct()
