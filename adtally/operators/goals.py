"""Monthly goals and how far delivery has come towards them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from adtally import fixed_values as fv
from adtally.functions.accounts import with_prefix, without_prefix
from adtally.functions.coerce import month_start, strict_number, stripped
from adtally.functions.names import quoted, ticked
from adtally.operators.reshape import ensure_columns


def read_goals(rows: DataFrame) -> DataFrame:
    """Goal rows from an all-text file: headers cleaned, ids prefixed, months floored, amounts numeric.

    Rows without an id or month are dropped before the id gets its prefix; a
    month that is no date fails the job.
    """
    named = rows.toDF(*[c.strip().lower() for c in rows.columns])
    missing = sorted({"account_id", "month"} - set(named.columns))
    if missing:
        raise ValueError(f"goals are missing required columns: {missing}")
    wide = ensure_columns(named, {c: "string" for c in [*fv.GOAL_AMOUNTS, "note"]})
    present = wide.where((stripped(F.col("account_id")) != "") & F.col("month").isNotNull())
    return present.select(
        with_prefix(stripped(F.col("account_id"))).alias("account_id"),
        month_start(stripped(F.col("month"))).alias("month"),
        *[strict_number(F.col(c)).alias(c) for c in fv.GOAL_AMOUNTS],
        "note",
    )


def goals_vs_actual(delivery: DataFrame, goals: DataFrame) -> DataFrame:
    """Every delivery row with its account's goals of that month and the share reached.

    Both ids are compared without the prefix, as facts store them without and goals with it.
    """
    delivery = ensure_columns(delivery, {c: "double" for c in (fv.PURCHASE_VALUE, fv.PURCHASES, fv.MESSAGES)})
    keyed = goals.select(
        without_prefix(F.col("account_id")).alias("_account"), F.col("month").alias("_month"), *fv.GOAL_AMOUNTS
    )
    joined = delivery.join(
        keyed,
        (without_prefix(F.col("account_id")) == F.col("_account")) & (month_start(F.col("date_start")) == F.col("_month")),
        "left",
    )
    return joined.select(
        *[quoted(c) for c in fv.REPORT_COLUMNS if c in delivery.columns],
        quoted(fv.PURCHASE_VALUE).alias("purchase_value"),
        ratio(fv.PURCHASE_VALUE, "spend").alias("roas"),
        quoted(fv.PURCHASES).alias("purchases"),
        quoted(fv.MESSAGES).alias("messages"),
        *fv.GOAL_AMOUNTS,
        ratio("spend", "goal_spend").alias("pct_spend_goal"),
        ratio(fv.PURCHASE_VALUE, "goal_purchase_value").alias("pct_purchase_value_goal"),
        ratio(fv.PURCHASES, "goal_purchases").alias("pct_purchases_goal"),
        ratio(fv.MESSAGES, "goal_messages").alias("pct_messages_goal"),
    )


def goals_sql(delivery: str, goals: str, columns: Iterable[str]) -> str:
    """The rows of ``goals_vs_actual`` as SQL text over two named tables; ``columns`` are those of the delivery."""
    have = set(columns)

    def metric(name: str) -> str:
        return f"d.{ticked(name)}" if name in have else "CAST(NULL AS DOUBLE)"

    def share(part: str, whole: str) -> str:
        return f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"

    shown = [
        *(f"d.{ticked(c)}" for c in fv.REPORT_COLUMNS if c in have),
        f"{metric(fv.PURCHASE_VALUE)} AS purchase_value",
        f"{share(metric(fv.PURCHASE_VALUE), 'd.spend')} AS roas",
        f"{metric(fv.PURCHASES)} AS purchases", f"{metric(fv.MESSAGES)} AS messages",
        *(f"g.{c}" for c in fv.GOAL_AMOUNTS),
        f"{share('d.spend', 'g.goal_spend')} AS pct_spend_goal",
        f"{share(metric(fv.PURCHASE_VALUE), 'g.goal_purchase_value')} AS pct_purchase_value_goal",
        f"{share(metric(fv.PURCHASES), 'g.goal_purchases')} AS pct_purchases_goal",
        f"{share(metric(fv.MESSAGES), 'g.goal_messages')} AS pct_messages_goal",
    ]
    bare = [f"regexp_replace({t}.account_id, '^{fv.ACCOUNT_PREFIX}', '')" for t in "dg"]
    return (
        f"SELECT {', '.join(shown)} FROM {delivery} AS d LEFT JOIN {goals} AS g"
        f" ON {bare[0]} = {bare[1]} AND trunc(CAST(d.date_start AS DATE), 'MM') = g.month"
    )


def ratio(part: str, whole: str) -> Column:
    """Quotient, NULL where the divisor is 0."""
    return F.try_divide(quoted(part).cast("double"), quoted(whole).cast("double"))
