"""Keyed writes: one row per natural key, and partial-column upserts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from adtally.functions.names import mirror_column_name, quoted
from adtally.operators.evolve import align_declared, json_texts
from adtally.operators.reshape import coalesce_duplicates, first_non_blank


def require_columns(df: DataFrame, keys: Iterable[str]) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"missing key columns: {missing}")


def reject_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job that reads a NULL key. The check rides on the scan; it is no job of its own."""
    checked = {k: F.coalesce(quoted(k), F.raise_error(F.lit(f"key column {k} contains NULL"))) for k in keys}
    return df.withColumns(checked)


def keys_like(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Where key types differ, compare keys as text in the type the target stores."""
    wanted = {k: target.schema[k].dataType for k in keys if df.schema[k].dataType != target.schema[k].dataType}
    return df.withColumns({k: quoted(k).cast("string").cast(t) for k, t in wanted.items()}) if wanted else df


def _ranked_first(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # The filter on the rank lets Spark keep one row per key in every task before
    # the shuffle, so a key with a third of the rows costs one row per task.
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key; ``order`` must tell any two rows of a key apart. NULL keys are equal."""
    return _ranked_first(df, keys, [quoted(o).desc_nulls_last() for o in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _ranked_first(df, keys, [quoted(o).asc_nulls_last() for o in order])


#: Bytes of rows, as they lie in memory, that a task sorts.
TASK_BYTES = 256 << 20


def tasks_for(df: DataFrame, rows: int) -> int:
    """How many tasks share a sort of so many rows like ``df``'s, or 0 if Spark's own division leaves each few enough.

    Adaptive execution divides by compressed size, to which a NULL adds nothing. In memory it takes as much as a value:
    8 bytes, for a decimal of over 18 digits 24.
    """
    wide = sum(isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18 for f in df.schema)
    texts = sum(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in df.schema)
    # A sort keeps 32 bytes for a row; texts are short, and many are NULL.
    size = 32 + 8 * len(df.columns) + 16 * wide + 4 * texts
    tasks = -(-rows * size // TASK_BYTES)
    return tasks if tasks > df.sparkSession.sparkContext.defaultParallelism else 0


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    absent: str = "keep",
    new_columns: str = "add",
    changed: str | None = None,
    rows: int = 0,
    nulls: Iterable[str] = (),
) -> DataFrame:
    """Target rows updated by the batch, plus the batch's new keys.

    Only columns of the batch change, and a NULL in the batch does overwrite.
    Columns the batch lacks keep their values, or become NULL on the touched
    rows with ``absent="null"``. Columns new to the target are added or
    dropped. With ``order`` the newest batch row of each key counts; without
    it the caller vouches that the batch holds a key once. NULL keys in the
    batch fail the job. A column ``changed`` tells rows that are new or differ
    from the target's.

    Keys are unique on both sides of the join, so no key is hot. It takes one
    shuffle per side, and the one of the batch also serves its deduplication.
    With ``rows``, the number on both sides, a join too big for that is
    divided by rows, so that no task sorts more than ``TASK_BYTES`` or so.
    Target columns named in ``nulls`` become NULL on the touched rows, as if
    the batch held them as NULL, which spares it to carry them.
    """
    require_columns(target, keys)
    require_columns(batch, keys)
    batch = keys_like(reject_null_keys(batch, keys), target, keys)
    if order is not None:
        batch = keep_last(batch, keys, order)
    nulls = set(nulls) - set(keys)
    names = {c: f"_new_{i}" for i, c in enumerate(c for c in batch.columns if c not in keys and c not in nulls)}
    incoming = batch.select(
        *[quoted(k) for k in keys], *[quoted(c).alias(n) for c, n in names.items()], F.lit(True).alias("_touched")
    )
    old = target.withColumn("_stored", F.lit(True)) if changed else target
    tasks = tasks_for(target, rows)
    if tasks:
        old, incoming = (df.repartition(tasks, *[quoted(k) for k in keys]) for df in (old, incoming))
    joined = old.join(incoming, list(keys), "full_outer")

    def value(name: str) -> Column:
        if name in keys:
            return quoted(name)
        if name in names:
            new = quoted(names[name]).cast(target.schema[name].dataType)
            return F.when(F.col("_touched"), new).otherwise(quoted(name)).alias(name)
        if absent == "null" or name in nulls:
            return F.when(F.col("_touched").isNull(), quoted(name)).alias(name)
        return quoted(name)

    added = [quoted(n).alias(c) for c, n in names.items() if c not in target.columns and new_columns == "add"]
    flag = []
    if changed:
        new = [~value(c).eqNullSafe(quoted(c)) for c in target.columns if c not in keys and (c in names or c in nulls or absent == "null")]
        grown = [n for c, n in names.items() if c not in target.columns and c not in (order or ())]
        new += [quoted(n).isNotNull() for n in grown if new_columns == "add"]
        differs = reduce(or_, new, F.col("_stored").isNull())
        flag = [(F.coalesce(F.col("_touched"), F.lit(False)) & differs).alias(changed)]
    return joined.select(*[value(c) for c in target.columns], *added, *flag)


def prepare_for_mirror(batch: DataFrame, table: str, extra: str = "keep") -> DataFrame:
    """Mirror column names, merged duplicates, declared columns present and cast, nested ones as JSON text."""
    renamed = coalesce_duplicates(batch.toDF(*[mirror_column_name(c) for c in batch.columns]))
    return json_texts(align_declared(renamed, table, extra))


def mirror_merge(
    target: DataFrame, batch: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], extra: str = "keep"
) -> DataFrame:
    """Merge into a mirror table: declared columns the batch lacks become NULL on the touched rows."""
    keys = [mirror_column_name(k) for k in keys]
    order = [mirror_column_name(o) for o in order]
    require_columns(batch.toDF(*[mirror_column_name(c) for c in batch.columns]), keys)
    return upsert(target, prepare_for_mirror(batch, table, extra), keys, order)


def creatives_of_ads(ads: DataFrame, order: Sequence[str]) -> DataFrame:
    """The creative id, account and name each ad carries, newest ad per creative.

    Deliberately no other columns: upserting this keeps what a fuller load stored.
    """
    picked = ads.select(
        first_non_blank(ads, "creative.id", "creative_id").cast("string").alias("creative_id"),
        first_non_blank(ads, "account_id").alias("account_id"),
        first_non_blank(ads, "creative.name", "creative_name").alias("creative_name"),
        *[quoted(o).alias(f"_order_{i}") for i, o in enumerate(order)],
    ).where("creative_id IS NOT NULL")
    ordering = [f"_order_{i}" for i in range(len(order))]
    return keep_last(picked, ["creative_id"], ordering).drop(*ordering)


def fill_missing(df: DataFrame, lookup: DataFrame, key: str, column: str, limit: int | None = None) -> DataFrame:
    """Set ``column`` from the lookup where it is NULL; with ``limit``, for the first rows by key only.

    The lookup holds one row per key.
    """
    found = lookup.select(quoted(key), quoted(column).alias("_found")).where("_found IS NOT NULL")
    if limit is not None:
        chosen = df.where(quoted(column).isNull() & quoted(key).isNotNull()).select(key).orderBy(key).limit(limit)
        found = found.join(chosen, key, "left_semi")
    filled = df.join(found, key, "left")
    return filled.select(
        *[F.coalesce(quoted(c), F.col("_found")).alias(c) if c == column else quoted(c) for c in df.columns]
    )
