"""The governed field map: which source fields are loaded, and under which names."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adtally.fixed_values import FIELD_MAP_COLUMNS
from adtally.functions.names import NAME_LIMIT, is_bookkeeping, quoted

APPROVED, PENDING, EXCLUDED = "approved", "pending", "excluded"
PENDING_NOTE = "New field, not loaded yet. Give it a name in rename_to and approve it here."


@dataclass(frozen=True)
class FieldMap:
    """The decisions for one feed."""

    renames: dict[str, str] = field(default_factory=dict)
    excluded: frozenset[str] = frozenset()
    pending: frozenset[str] = frozenset()
    known: frozenset[str] = frozenset()


def clean_field_map(rows: DataFrame) -> DataFrame:
    """Field-map rows with trimmed text, empty instead of NULL, and approved as the default status."""
    cleaned = rows.select(*[F.trim(F.coalesce(quoted(c), F.lit(""))).alias(c) for c in FIELD_MAP_COLUMNS])
    status = F.lower(F.coalesce(F.nullif("status", F.lit("")), F.lit(APPROVED)))
    return cleaned.withColumn("status", status)


def field_decisions(rows: DataFrame) -> DataFrame:
    """(feed, field, decision, target) per field-map row that names a feed and a field.

    ``decision`` is rename, keep, drop (excluded), wait (pending) or ignore, for
    an approved row without a database column.
    """
    named = clean_field_map(rows).where("endpoint_or_pipeline <> '' AND api_field <> ''")
    target = F.coalesce(F.nullif("rename_to", F.lit("")), F.nullif("current_database_column", F.lit("")))
    decision = (
        F.when(F.col("status") == EXCLUDED, "drop")
        .when(F.col("status") == PENDING, "wait")
        .when(F.col("current_database_column") == "", "ignore")
        .when(F.col("api_field") == target, "keep")
        .otherwise("rename")
    )
    return named.select(
        F.col("endpoint_or_pipeline").alias("feed"), F.col("api_field").alias("field"),
        decision.alias("decision"), target.alias("target"),
    )


def field_map_for(rows: DataFrame, feed: str) -> FieldMap:
    """Collect the decisions of one feed; the map is a hand-kept file of one row per source field."""
    chosen = field_decisions(rows).where(F.col("feed") == feed).collect()

    def fields(decision: str) -> frozenset[str]:
        return frozenset(r["field"] for r in chosen if r["decision"] == decision)

    return FieldMap(
        renames={r["field"]: r["target"] for r in chosen if r["decision"] == "rename"},
        excluded=fields("drop"),
        pending=fields("wait"),
        known=frozenset(r["field"] for r in chosen),
    )


def apply_field_map(df: DataFrame, fields: FieldMap | None, unknown: str = "drop") -> DataFrame:
    """Drop excluded, pending and, unless ``unknown="keep"``, unknown columns; rename the approved ones.

    Without a map the columns stay as they are.
    """
    if fields is None:
        return df
    hidden = fields.excluded | fields.pending
    kept = [c for c in df.columns if c not in hidden and (unknown == "keep" or c in fields.known or is_bookkeeping(c))]
    return df.select(*[quoted(c).alias(fields.renames.get(c, c)) for c in kept])


def default_column(c: Column) -> Column:
    """Column name proposed for a new field."""
    return F.left(F.lower(F.translate(c, ".-", "__")), F.lit(NAME_LIMIT))


def pending_rows(seen: DataFrame, rows: DataFrame, feed: str, table: str = "", group: str = "") -> DataFrame:
    """Field-map rows, in field order, for the seen fields (column ``api_field``) the map does not have."""
    known = clean_field_map(rows).where(F.col("endpoint_or_pipeline") == feed).select("api_field")
    fresh = seen.select("api_field").distinct().join(known, "api_field", "left_anti")
    return fresh.select(
        F.lit(group or f"pending_{feed}").alias("group_name"),
        F.lit(feed).alias("endpoint_or_pipeline"),
        "api_field",
        F.lit(table).alias("current_database_table"),
        default_column(F.col("api_field")).alias("current_database_column"),
        F.lit("").alias("rename_to"),
        F.lit(PENDING).alias("status"),
        F.lit(PENDING_NOTE).alias("notes"),
    ).orderBy("api_field")


def register_unknown(df: DataFrame, rows: DataFrame, feed: str, table: str = "") -> DataFrame:
    """Rows to append to the map for the columns of ``df`` it does not know; none on a second run."""
    return pending_rows(names_frame(df.sparkSession, [c for c in df.columns if not is_bookkeeping(c)]), rows, feed, table)


def names_frame(spark: SparkSession, names: Iterable[str], column: str = "api_field") -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], f"{column} STRING")


def prune_plan(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """(table_name, column_name, found) per column whose field is excluded; ``catalog`` lists stored columns."""
    target = F.coalesce(F.nullif("rename_to", F.lit("")), F.col("current_database_column"))
    planned = (
        clean_field_map(rows)
        .where((F.col("status") == EXCLUDED) & (F.col("current_database_table") != "") & (F.col("current_database_column") != ""))
        .select(F.col("current_database_table").alias("table_name"), target.alias("column_name"))
        .distinct()
    )
    present = catalog.select("table_name", "column_name", F.lit(True).alias("found"))
    tables = catalog.select("table_name").distinct()
    return (
        planned.join(tables, "table_name", "left_semi")
        .join(present, ["table_name", "column_name"], "left")
        .select("table_name", "column_name", F.coalesce("found", F.lit(False)).alias("found"))
    )


def rename_plan(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """(table_name, old_name, new_name, outcome) per approved rename that is a valid column name.

    ``outcome`` is rename, already (only the new column is stored) or missing.
    """
    planned = (
        clean_field_map(rows)
        .where(
            (F.col("status") == APPROVED)
            & (F.col("current_database_table") != "")
            & (F.col("current_database_column") != "")
            & F.col("rename_to").rlike("(?i)^[a-z_][a-z0-9_]*$")
            & (F.col("current_database_column") != F.col("rename_to"))
        )
        .select(
            F.col("current_database_table").alias("table_name"),
            F.col("current_database_column").alias("old_name"),
            F.col("rename_to").alias("new_name"),
        )
        .distinct()
    )
    old = catalog.select("table_name", F.col("column_name").alias("old_name"), F.lit(True).alias("_old"))
    new = catalog.select("table_name", F.col("column_name").alias("new_name"), F.lit(True).alias("_new"))
    outcome = F.when(F.col("_old"), "rename").when(F.col("_new"), "already").otherwise("missing")
    return (
        planned.join(catalog.select("table_name").distinct(), "table_name", "left_semi")
        .join(old, ["table_name", "old_name"], "left")
        .join(new, ["table_name", "new_name"], "left")
        .select("table_name", "old_name", "new_name", outcome.alias("outcome"))
    )


def columns_by_table(plan: DataFrame) -> DataFrame:
    """A prune plan as one list of stored columns per table; a table's list is bounded by its width."""
    return plan.where("found").groupBy("table_name").agg(F.array_sort(F.collect_set("column_name")).alias("columns"))
