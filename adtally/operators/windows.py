"""Date windows: splitting a range, skipping what is done, named presets."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from adtally.fixed_values import CHECKPOINT, DATE_PARTITION, NATURAL_KEYS
from adtally.functions.names import checkpoint_breakdown_key
from adtally.operators.keyed import upsert

DEFAULT_PROFILE = "default"


def date_windows(bounds: DataFrame, days: int) -> DataFrame:
    """Consecutive inclusive windows (since, until) over each row's first and last day, the last one clipped.

    ``bounds`` has the DATE columns ``first`` and ``last``.
    """
    if days < 1:
        raise ValueError("a window holds at least one day")
    step = F.expr(f"INTERVAL {days} DAY")
    starts = bounds.where("first <= last").select("last", F.explode(F.sequence("first", "last", step)).alias("since"))
    return starts.select("since", F.least(F.date_add("since", days - 1), F.col("last")).alias("until"))


def profile_key(profile: str | None) -> str:
    return (profile or DEFAULT_PROFILE).lower()


def completed_windows(
    checkpoint: DataFrame, level: str, profile: str | None = None, breakdowns: Iterable[str] | None = None
) -> DataFrame:
    return checkpoint.where(
        (F.col("profile") == profile_key(profile))
        & (F.col("level") == level)
        & (F.col("breakdowns_key") == checkpoint_breakdown_key(breakdowns))
    ).select("since", "until")


def remaining_windows(windows: DataFrame, completed: DataFrame, force: bool = False) -> DataFrame:
    return windows if force else windows.join(completed, ["since", "until"], "left_anti")


def reopen_windows(checkpoint: DataFrame, windows: DataFrame) -> DataFrame:
    """The checkpoint without the given windows (columns of its key), so that they load again."""
    keys = [k for k in NATURAL_KEYS[CHECKPOINT] if k in windows.columns]
    return checkpoint.join(windows.select(*keys), keys, "left_anti")


def mark_completed(
    checkpoint: DataFrame,
    loaded: DataFrame,
    level: str,
    profile: str | None = None,
    breakdowns: Iterable[str] | None = None,
) -> DataFrame:
    """The checkpoint with windows (since, until, rows_loaded) completed now."""
    batch = loaded.select(
        F.lit(profile_key(profile)).alias("profile"),
        F.lit(level).alias("level"),
        F.lit(checkpoint_breakdown_key(breakdowns)).alias("breakdowns_key"),
        "since", "until", F.col("rows_loaded").cast("bigint").alias("rows_loaded"),
        F.current_timestamp().alias("completed_at"),
    )
    return upsert(checkpoint, batch, NATURAL_KEYS[CHECKPOINT])


def rows_per_window(facts: DataFrame, windows: DataFrame, day: str = DATE_PARTITION) -> DataFrame:
    """Windows with the number of fact rows in each, empty ones included.

    Facts are counted per day first and windows spread over their days, so
    the join is on equal days and as small as the calendar.
    """
    per_day = facts.groupBy(F.col(day).cast("date").alias("_day")).agg(F.count(F.lit(1)).alias("_rows"))
    days = windows.select("since", "until", F.explode(F.sequence("since", "until")).alias("_day"))
    return (
        days.join(per_day, "_day", "left")
        .groupBy("since", "until")
        .agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows_loaded"))
    )


def in_windows(facts: DataFrame, windows: DataFrame, day: str = DATE_PARTITION) -> DataFrame:
    """Fact rows on a day of any window; day lists are as small as the calendar."""
    days = windows.select(F.explode(F.sequence("since", "until")).alias(day)).distinct()
    return facts.join(days, day, "left_semi")


def within(first: date | str, last: date | str, day: str = DATE_PARTITION) -> Column:
    return F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def rolling_range(today: date, days_back: int, include_today: bool = False) -> tuple[date, date]:
    """The last days up to yesterday, or up to and including today."""
    return today - timedelta(days=days_back), today if include_today else today - timedelta(days=1)


def preset_range(preset: str, today: date) -> tuple[date, date]:
    """First and last day of a named snapshot; day counts end yesterday."""
    yesterday = today - timedelta(days=1)
    if preset == "today":
        return today, today
    if preset == "yesterday":
        return yesterday, yesterday
    if preset in ("last_7d", "last_30d", "last_90d"):
        return today - timedelta(days=int(preset[5:-1])), yesterday
    if preset == "last_year":
        return date(today.year - 1, 1, 1), date(today.year - 1, 12, 31)
    if preset == "last_quarter":
        this_quarter = date(today.year, (today.month - 1) // 3 * 3 + 1, 1)
        last = this_quarter - timedelta(days=1)
        return date(last.year, last.month - 2, 1), last
    raise ValueError(f"unknown preset: {preset}")
