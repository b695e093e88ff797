"""Identifier rules: driver-side for schemas, and the same rules as column functions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from adtally.fixed_values import FACT_TABLE_PREFIX

NAME_LIMIT = 63
MIRROR_NAME_LIMIT = 300


def ticked(name: str) -> str:
    """A literal name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(ticked(name))


def is_bookkeeping(name: str) -> bool:
    """Columns such as ``_ingest`` order or tag rows; loads pass them through and do not store them."""
    return name.startswith("_")


def is_id_column(name: str) -> bool:
    """Ids are text at any depth; as numbers, long ones would lose digits."""
    return name.lower().rpartition(".")[2] == "id" or name.lower().endswith("_id")


def keep_tail(name: str, limit: int = NAME_LIMIT) -> str:
    return name[-limit:]


def keep_head(name: str, limit: int = NAME_LIMIT) -> str:
    return name[:limit]


def column_name(name: str, limit: int = NAME_LIMIT) -> str:
    """Lower case, runs of other characters as one underscore, last ``limit`` characters."""
    words = [word for word in re.split(r"[^a-z0-9]+", name.lower()) if word]
    return keep_tail("_".join(words), limit)


def mirror_column_name(name: str) -> str:
    cleaned = column_name(name, MIRROR_NAME_LIMIT) or "col"
    return f"_{cleaned}" if cleaned[0].isdigit() else cleaned


def column_name_of(c: Column, limit: int = NAME_LIMIT) -> Column:
    """``column_name`` over a column of names."""
    underscored = F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_")
    return F.right(F.btrim(underscored, F.lit("_")), F.lit(limit))


def mirror_column_name_of(c: Column) -> Column:
    cleaned = column_name_of(c, MIRROR_NAME_LIMIT)
    return (
        F.when(cleaned == "", F.lit("col"))
        .when(cleaned.rlike("^[0-9]"), F.concat(F.lit("_"), cleaned))
        .otherwise(cleaned)
    )


def breakdown_key(breakdowns: Iterable[str] | None) -> str:
    """Canonical text of a breakdown set as stored with raw rows; empty when there is none."""
    return ",".join(sorted(b.strip() for b in breakdowns or () if b and b.strip()))


def checkpoint_breakdown_key(breakdowns: Iterable[str] | None) -> str:
    """The same set as stored with completed windows: lower case, ``none`` when empty."""
    return breakdown_key(b.lower() for b in breakdowns or () if b) or "none"


def breakdown_key_of(c: Column, for_checkpoint: bool = False) -> Column:
    """Canonical text from a comma-separated column."""
    parts = F.filter(F.transform(F.split(c, ","), lambda p: F.trim(p)), lambda p: p != "")
    if for_checkpoint:
        parts = F.transform(parts, lambda p: F.lower(p))
    joined = F.array_join(F.array_sort(parts), ",")
    if for_checkpoint:
        return F.coalesce(F.nullif(joined, F.lit("")), F.lit("none"))
    return F.coalesce(joined, F.lit(""))


def fact_table_name(level: str, breakdowns: Iterable[str] | None = None) -> str:
    suffix = breakdown_key(breakdowns).replace(",", "_")
    base = FACT_TABLE_PREFIX + level
    return f"{base}__{suffix}" if suffix else base


def fact_table_name_of(level: Column, breakdowns: Column) -> Column:
    suffix = F.replace(breakdown_key_of(breakdowns), F.lit(","), F.lit("_"))
    base = F.concat(F.lit(FACT_TABLE_PREFIX), level)
    return F.when(suffix == "", base).otherwise(F.concat_ws("__", base, suffix))
