"""The account registry: which accounts are loaded, for whom."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from adtally.fixed_values import INCLUDE_TOKENS, REGISTRY_COLUMNS
from adtally.functions.accounts import with_prefix
from adtally.functions.coerce import strict_number, stripped
from adtally.operators.keyed import keep_last
from adtally.operators.reshape import ensure_columns

USER_COLUMNS = ("profile_name", "include_in_etl", "notes")
_ALL_TEXT = {c: "string" for c in REGISTRY_COLUMNS}


def registry_from_accounts(accounts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Registry rows of freshly landed accounts, newest per id, all included."""
    newest = keep_last(accounts, ["id"], order)
    return ensure_columns(newest, {"name": "string", "account_status": "string"}).select(
        F.col("id").cast("string").alias("account_id"),
        F.col("name").alias("account_name"),
        strict_number(F.col("account_status").cast("string")).cast("int").alias("account_status"),
        F.lit(None).cast("string").alias("profile_name"),
        F.lit(True).alias("include_in_etl"),
        F.lit(None).cast("string").alias("notes"),
    )


def merge_registry(fresh: DataFrame, existing: DataFrame) -> DataFrame:
    """Fresh accounts with the flags users set before; accounts no longer fresh disappear."""
    edited = ensure_columns(existing, _ALL_TEXT).select(
        "account_id", *[F.col(c).alias(f"_{c}") for c in USER_COLUMNS]
    )
    joined = fresh.join(edited, "account_id", "left")
    kept = {
        "profile_name": F.coalesce("_profile_name", "profile_name"),
        "include_in_etl": F.coalesce(F.col("_include_in_etl").cast("boolean"), "include_in_etl", F.lit(True)),
        "notes": F.coalesce("_notes", "notes"),
    }
    return joined.select(*[kept[c].alias(c) if c in kept else c for c in REGISTRY_COLUMNS])


def sort_registry(registry: DataFrame) -> DataFrame:
    """By profile, included first, then name and id; missing values last."""
    return registry.orderBy(
        F.asc_nulls_last("profile_name"), F.desc_nulls_last("include_in_etl"),
        F.asc_nulls_last("account_name"), F.asc_nulls_last("account_id"),
    )


def included_accounts(registry: DataFrame, order: Sequence[str], profile: str | None = None) -> DataFrame:
    """Registry rows that are included (a missing flag counts as yes), of one profile if given."""
    wide = ensure_columns(registry, _ALL_TEXT)
    flag = F.coalesce(F.lower(stripped(F.col("include_in_etl").cast("string"))), F.lit("true"))
    rows = wide.where(flag.isin(INCLUDE_TOKENS) & F.col("account_id").isNotNull())
    if profile:
        owner = F.lower(stripped(F.coalesce(F.col("profile_name"), F.lit(""))))
        rows = rows.where(owner == profile.strip().lower())
    prefixed = rows.withColumn("account_id", with_prefix(stripped(F.col("account_id"))))
    return keep_last(prefixed, ["account_id"], order).select(*REGISTRY_COLUMNS)


def account_ids(included: DataFrame, default_ids: Iterable[str] = ()) -> DataFrame:
    """Ids of the included accounts, or the default ids when there are none. Runs one small job."""
    ids = included.select("account_id")
    if not included.isEmpty():
        return ids
    defaults = included.sparkSession.createDataFrame([(i,) for i in default_ids], "account_id STRING")
    return defaults.select(with_prefix(F.col("account_id")).alias("account_id"))
