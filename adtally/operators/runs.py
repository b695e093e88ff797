"""Questions to the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HISTORY = "command profile status started_at duration_seconds rows_loaded error_message".split()


def latest_runs(log: DataFrame, limit: int = 20) -> DataFrame:
    """The newest runs; a bounded sort, no full one."""
    return log.orderBy(F.desc("started_at"), F.desc("run_id")).limit(limit).select("run_id", *HISTORY)


def stale_runs(log: DataFrame, expected: str, now: Column | None = None) -> DataFrame:
    """Runs still marked started after the expected duration, such as ``INTERVAL 2 HOURS``."""
    moment = F.current_timestamp() if now is None else now
    return log.where((F.col("status") == "STARTED") & (F.col("started_at") < moment - F.expr(expected)))
