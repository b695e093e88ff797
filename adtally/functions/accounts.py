"""Account ids come with and without a prefix; these move between the spellings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from adtally.fixed_values import ACCOUNT_PREFIX


def with_prefix(c: Column) -> Column:
    """Add the prefix where it is missing; NULL and empty stay as they are."""
    return F.when((c == "") | c.startswith(ACCOUNT_PREFIX), c).otherwise(F.concat(F.lit(ACCOUNT_PREFIX), c))


def without_prefix(c: Column) -> Column:
    return F.regexp_replace(c, f"^{ACCOUNT_PREFIX}", "")


def both_spellings(c: Column) -> Column:
    """The two spellings of an id, the given one first."""
    other = F.when(c.startswith(ACCOUNT_PREFIX), without_prefix(c)).otherwise(with_prefix(c))
    return F.array(c, other)
