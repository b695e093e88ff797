"""The composite jobs: dimensions, then facts, then the mirror and the combined table.

A step that fails raises, so a job never reports success over a failed write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from adtally import fixed_values as fv
from adtally.functions.names import fact_table_name
from adtally.plans.loads import create_full_view, load_dimension, load_range, load_rolling, materialise_combined
from adtally.plans.sync import sync_tables
from adtally.sources.tables import backup

LOAD_ORDER = ("accounts", "campaigns", "adsets", "ads", "creatives")


def refresh_dimensions(
    spark: SparkSession, database: str, entities: Mapping[str, DataFrame], order: Sequence[str], mirror: str | None = None
) -> None:
    """Renew the dimensions that have landed, and what the mirror shows of them."""
    _load_entities(spark, database, entities, order)
    _publish(spark, database, mirror, [fv.CAMPAIGNS, fv.ADSETS, fv.ADS, fv.CREATIVES])


def refresh_delivery(
    spark: SparkSession,
    database: str,
    accounts: DataFrame,
    delivery: DataFrame,
    order: Sequence[str],
    today: date,
    days_back: int = 7,
    level: str = "ad",
    mirror: str | None = None,
    **options: object,
) -> None:
    """The light job of every few hours: accounts and the last days of delivery, today included.

    The mirror gets the accounts and the fact of ``level`` as far as they changed since it last got them, by whatever
    load, and what a failed run left out.
    """
    load_dimension(spark, accounts, "accounts", database, order)
    load_rolling(spark, delivery, level, database, order, today, days_back, include_today=True, **options)
    create_full_view(spark, database)
    if mirror:
        fact = fact_table_name(level, options.get("breakdowns", ()))
        sync_tables(spark, database, mirror, [fv.ACCOUNTS, fact], create=True, owed=True)


def refresh_daily(
    spark: SparkSession,
    database: str,
    entities: Mapping[str, DataFrame],
    delivery: DataFrame,
    order: Sequence[str],
    today: date,
    days_back: int = 7,
    level: str = "ad",
    mirror: str | None = None,
    **options: object,
) -> None:
    """Dimensions and the last days of delivery up to yesterday; the mirror gets what changed."""
    _load_entities(spark, database, entities, order)
    load_rolling(spark, delivery, level, database, order, today, days_back, **options)
    _publish(spark, database, mirror, ["all"])


def refresh_range(
    spark: SparkSession,
    database: str,
    entities: Mapping[str, DataFrame],
    delivery: DataFrame,
    order: Sequence[str],
    first: date | str,
    last: date | str,
    days: int = 7,
    level: str = "ad",
    mirror: str | None = None,
    backup_database: str | None = None,
    **options: object,
) -> None:
    """Dimensions and the unfinished windows of a range, after an optional backup."""
    if backup_database:
        backup(spark, database, backup_database)
    _load_entities(spark, database, entities, order)
    load_range(spark, delivery, level, database, order, first, last, days, **options)
    _publish(spark, database, mirror, ["all"])


def _load_entities(spark: SparkSession, database: str, entities: Mapping[str, DataFrame], order: Sequence[str]) -> None:
    for entity in LOAD_ORDER:
        if entity in entities:
            load_dimension(spark, entities[entity], entity, database, order)


def _publish(spark: SparkSession, database: str, mirror: str | None, names: Sequence[str]) -> None:
    complete = create_full_view(spark, database)
    if not mirror:
        return
    present = [n for n in names if n == "all" or spark.catalog.tableExists(f"{database}.{n}")]
    if present:
        sync_tables(spark, database, mirror, present, create=True, owed=True)
    if complete:
        materialise_combined(spark, database, mirror)
