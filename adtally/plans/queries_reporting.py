"""Registered queries: star joins, goals, roll-ups, calendar, runs and windows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from adtally import fixed_values as fv
from adtally.operators import goals as goal_ops, runs, star, windows
from adtally.plans import driver_model as m
from adtally.plans.driver_model import DELIVERY_SQL, Tables
from adtally.plans.registered import query
from adtally.sources.tables import materialise

STAR_SQL = f"""
    WITH fact AS ({DELIVERY_SQL})
    SELECT f.date_start, f.date_stop, CAST(f.spend AS DOUBLE) AS spend, f.impressions, f.clicks, f.objective,
           f.optimization_goal, f.account_id, f.campaign_id, f.adset_id, f.ad_id,
           n.n_name AS currency, CAST(n.n_regionkey AS BIGINT) AS account_status,
           o.o_orderstatus AS ad_status, o.o_orderpriority AS effective_status,
           CASE WHEN o.o_orderstatus <> 'P' THEN CAST(o.o_custkey AS VARCHAR) END AS creative_id,
           CAST(o.o_orderdate AS DATE) AS ad_created_time,
           c.c_name AS creative_name, c.c_mktsegment AS creative_title,
           p.p_brand AS campaign_status, p.p_type AS buying_type, CAST(p.p_size AS BIGINT) AS campaign_daily_budget,
           s.s_name AS adset_status, CAST(s.s_nationkey AS VARCHAR) AS billing_event,
           COALESCE(CASE WHEN c.c_acctbal >= 0 THEN 'https://i.example/' || c.c_custkey END,
                    CASE WHEN c.c_acctbal < 5000 THEN 'https://f.example/' || c.c_custkey END) AS image_url,
           CASE WHEN c.c_acctbal < 5000 THEN 'https://f.example/' || c.c_custkey END AS thumbnail_url,
           CAST(c.c_nationkey AS VARCHAR) AS image_hash,
           f.action_values_purchase, f.actions_purchase
    FROM fact f
    LEFT JOIN nation n ON f.account_id = replace('act_' || n.n_nationkey, 'act_', '')
    LEFT JOIN orders o ON f.ad_id = CAST(o.o_orderkey AS VARCHAR)
    LEFT JOIN customer c ON o.o_orderstatus <> 'P' AND o.o_custkey = c.c_custkey
    LEFT JOIN part p ON f.campaign_id = CAST(p.p_partkey AS VARCHAR)
    LEFT JOIN supplier s ON f.adset_id = CAST(s.s_suppkey AS VARCHAR)
"""


def star_of(t: Tables) -> DataFrame:
    return star.star_view(m.delivery(t), m.accounts(t), m.ads(t), m.creatives(t), m.campaigns(t), m.adsets(t))


@query("star_view", STAR_SQL)
def star_view(t: Tables) -> DataFrame:
    return m.doubles(star_of(t))


@query(
    "combined_count",
    "SELECT account_id, count(*) AS row_count, CAST(sum(spend) AS DOUBLE) AS spend "
    f"FROM ({DELIVERY_SQL}) GROUP BY account_id",
)
def combined_count(t: Tables) -> DataFrame:
    """The star view written as a table and counted per account from there."""
    table = f"{m.new_database(t.spark, 'combined')}.{fv.COMBINED}"
    materialise(star_of(t), table)
    counted = t.spark.table(table).groupBy("account_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("spend").alias("spend")
    )
    return m.doubles(counted)


@query(
    "level_report",
    f"""
    WITH fact AS ({DELIVERY_SQL})
    SELECT f.ad_id, f.date_start, f.account_id, f.campaign_id, f.adset_id, CAST(f.spend AS DOUBLE) AS spend,
           p.p_brand AS campaigns_status, s.s_name AS adsets_status
    FROM fact f LEFT JOIN part p ON f.campaign_id = CAST(p.p_partkey AS VARCHAR)
    LEFT JOIN supplier s ON f.adset_id = CAST(s.s_suppkey AS VARCHAR)
    """,
)
def level_report(t: Tables) -> DataFrame:
    fact = m.delivery(t).select("ad_id", "date_start", "account_id", "campaign_id", "adset_id", "spend")
    dims = {"campaigns": m.campaigns(t), "adsets": m.adsets(t)}
    return m.doubles(star.level_report(fact, "adset", dims, {"campaigns": ["status"], "adsets": ["status"]}))


@query(
    "accounts_registry_join",
    """
    WITH registry AS (
        SELECT c_nationkey, min(c_mktsegment) AS profile_name, bool_or(c_acctbal > 0) AS include_in_etl,
               max(c_name) AS notes
        FROM customer GROUP BY c_nationkey)
    SELECT 'act_' || s_nationkey AS account_id, s_suppkey, s_name, profile_name, include_in_etl, notes
    FROM supplier LEFT JOIN registry ON s_nationkey = c_nationkey
    """,
)
def accounts_registry_join(t: Tables) -> DataFrame:
    listed = t.supplier.select(F.concat(F.lit("act_"), m.text("s_nationkey")).alias("id"), "s_suppkey", "s_name")
    registry = t.customer.groupBy(F.concat(F.lit("act_"), m.text("c_nationkey")).alias("account_id")).agg(
        F.min("c_mktsegment").alias("profile_name"),
        F.bool_or(F.col("c_acctbal") > 0).alias("include_in_etl"),
        F.max("c_name").alias("notes"),
    )
    return star.accounts_with_registry(listed, registry)


def goal_rows(t: Tables) -> DataFrame:
    """A goals file made of the orders: text values, some ids with and some without the prefix."""
    monthly = t.orders.groupBy(
        F.substr("o_orderpriority", F.lit(1), F.lit(1)).alias("account"), F.trunc("o_orderdate", "MM").alias("first_day")
    ).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"), F.count(F.lit(1)).alias("n"))
    prefixed = F.when(F.month("first_day") < 7, F.concat(F.lit("act_"), "account")).otherwise(F.col("account"))
    return monthly.select(
        F.concat(F.lit(" "), prefixed).alias(" Account_ID"),
        F.date_format(F.date_add("first_day", 9), "yyyy-MM-dd").alias("month"),
        m.text("total").alias("goal_spend"),
        F.when(F.col("account") == "1", "n/a").otherwise(m.text("total")).alias("goal_purchase_value"),
        m.text("n").alias("goal_purchases"),
    )


GOALS_SQL = """
    SELECT substr(o_orderpriority, 1, 1) AS account, date_trunc('month', CAST(o_orderdate AS DATE)) AS first_day,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(count(*) AS DOUBLE) AS n
    FROM orders GROUP BY 1, 2
"""


@query(
    "goals_load",
    f"""
    SELECT 'act_' || account AS account_id, CAST(first_day AS DATE) AS month, total AS goal_spend,
           CASE WHEN account <> '1' THEN total END AS goal_purchase_value, CAST(NULL AS DOUBLE) AS goal_roas,
           n AS goal_purchases, CAST(NULL AS DOUBLE) AS goal_messages, CAST(NULL AS VARCHAR) AS note
    FROM ({GOALS_SQL})
    """,
)
def goals_load(t: Tables) -> DataFrame:
    return goal_ops.read_goals(goal_rows(t))


@query(
    "goals_vs_actual",
    f"""
    WITH fact AS ({DELIVERY_SQL}), goals AS ({GOALS_SQL})
    SELECT f.date_start, f.date_stop, f.account_id, f.campaign_id, f.adset_id, f.ad_id, f.objective,
           CAST(f.spend AS DOUBLE) AS spend, f.action_values_purchase AS purchase_value,
           f.action_values_purchase / NULLIF(CAST(f.spend AS DOUBLE), 0) AS roas, f.actions_purchase AS purchases,
           CAST(NULL AS DOUBLE) AS messages, g.total AS goal_spend,
           CASE WHEN g.account <> '1' THEN g.total END AS goal_purchase_value, CAST(NULL AS DOUBLE) AS goal_roas,
           g.n AS goal_purchases, CAST(NULL AS DOUBLE) AS goal_messages,
           CAST(f.spend AS DOUBLE) / NULLIF(g.total, 0) AS pct_spend_goal,
           f.action_values_purchase / NULLIF(CASE WHEN g.account <> '1' THEN g.total END, 0) AS pct_purchase_value_goal,
           f.actions_purchase / NULLIF(g.n, 0) AS pct_purchases_goal, CAST(NULL AS DOUBLE) AS pct_messages_goal
    FROM fact f LEFT JOIN goals g
      ON f.account_id = g.account AND date_trunc('month', f.date_start) = g.first_day
    """,
)
def goals_vs_actual(t: Tables) -> DataFrame:
    return m.doubles(goal_ops.goals_vs_actual(m.delivery(t), goal_ops.read_goals(goal_rows(t))))


@query(
    "delivery_rollup",
    f"""
    SELECT campaign_id, date_start, objective, CAST(sum(spend) AS DOUBLE) AS spend,
           CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
           CAST(sum(clicks) AS DOUBLE) * 100 / NULLIF(CAST(sum(impressions) AS DOUBLE), 0) AS ctr,
           CAST(sum(spend) AS DOUBLE) * 1000 / NULLIF(CAST(sum(impressions) AS DOUBLE), 0) AS cpm
    FROM ({DELIVERY_SQL}) GROUP BY campaign_id, date_start, objective
    """,
)
def delivery_rollup(t: Tables) -> DataFrame:
    return m.doubles(star.delivery_rollup(m.delivery(t), "campaign", ("objective",)))


@query(
    "account_rollup",
    f"""
    SELECT account_id, date_start, CAST(sum(spend) AS DOUBLE) AS spend, CAST(sum(impressions) AS BIGINT) AS impressions,
           CAST(sum(clicks) AS BIGINT) AS clicks,
           CAST(sum(clicks) AS DOUBLE) * 100 / NULLIF(CAST(sum(impressions) AS DOUBLE), 0) AS ctr,
           CAST(sum(spend) AS DOUBLE) * 1000 / NULLIF(CAST(sum(impressions) AS DOUBLE), 0) AS cpm
    FROM ({DELIVERY_SQL}) GROUP BY account_id, date_start
    """,
)
def account_rollup(t: Tables) -> DataFrame:
    return m.doubles(star.delivery_rollup(m.delivery(t), "account"))


CALENDAR_SQL = """
    SELECT CAST(d AS DATE) AS "date", CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month_no,
           strftime(d, '%b %Y') AS month
    FROM (SELECT unnest(generate_series(min({day}), max({day}), INTERVAL 1 DAY)) AS d FROM {table})
"""


def _calendar(fact: DataFrame, day: str) -> DataFrame:
    return star.calendar_dim(fact, day).withColumns({c: F.col(c).cast("bigint") for c in ("year", "month_no")})


@query("calendar_dim", CALENDAR_SQL.format(day="o_orderdate", table="orders"))
def calendar_dim(t: Tables) -> DataFrame:
    return _calendar(t.orders, "o_orderdate")


@query(
    "calendar_join",
    f"""
    SELECT strftime(date_start, '%b %Y') AS month, CAST(year(date_start) AS BIGINT) AS year, count(*) AS row_count,
           CAST(sum(spend) AS DOUBLE) AS spend
    FROM ({DELIVERY_SQL}) GROUP BY 1, 2
    """,
)
def calendar_join(t: Tables) -> DataFrame:
    fact = m.delivery(t)
    dated = star.with_calendar(fact, _calendar(fact, "date_start"))
    return m.doubles(dated.groupBy("month", "year").agg(F.count(F.lit(1)).alias("row_count"), F.sum("spend").alias("spend")))


def run_log(t: Tables) -> DataFrame:
    """Events as runs: purchases are still started, errors failed."""
    status = F.when(F.col("event_type") == "purchase", "STARTED").when(F.col("event_type") == "error", "FAILED")
    return t.events.select(
        m.text("event_id").alias("run_id"), F.col("event_type").alias("command"), m.text("user_id").alias("profile"),
        F.coalesce(status, F.lit("SUCCEEDED")).alias("status"), F.col("ts").alias("started_at"),
        F.col("value").alias("duration_seconds"), F.lit(None).cast("bigint").alias("rows_loaded"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
    )


def _minutes(df: DataFrame) -> DataFrame:
    """The start as minutes, the same number in any session time zone."""
    started = F.timestamp_diff("MINUTE", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("started_at"))
    return df.withColumn("started_at", started.cast("bigint"))


RUN_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS command, CAST(user_id AS VARCHAR) AS profile,
           CASE event_type WHEN 'purchase' THEN 'STARTED' WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
           CAST(floor(epoch(ts - TIMESTAMP '2024-01-01') / 60) AS BIGINT) AS started_at, value AS duration_seconds,
           CAST(NULL AS BIGINT) AS rows_loaded, CASE WHEN event_type = 'error' THEN props END AS error_message
    FROM events
"""


@query("run_history", RUN_SQL + " ORDER BY ts DESC LIMIT 20")
def run_history(t: Tables) -> DataFrame:
    return _minutes(runs.latest_runs(run_log(t), 20))


@query(
    "stale_runs",
    RUN_SQL + " WHERE event_type = 'purchase' AND ts < (SELECT max(ts) FROM events) - INTERVAL 2 HOURS",
)
def stale_runs(t: Tables) -> DataFrame:
    log = run_log(t)
    latest = log.agg(F.max("started_at")).first()[0]
    return _minutes(runs.stale_runs(log, "INTERVAL 2 HOURS", F.lit(str(latest)).cast("timestamp_ntz")))


WINDOW_SQL = """
    SELECT CAST(d AS DATE) AS since, least(CAST(d AS DATE) + 6, last) AS until
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 7 DAY)) AS d,
                 CAST(max(o_orderdate) AS DATE) AS last FROM orders)
"""


def order_windows(t: Tables) -> DataFrame:
    bounds = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last"))
    return windows.date_windows(bounds, 7)


@query("date_windows", WINDOW_SQL)
def date_windows(t: Tables) -> DataFrame:
    return order_windows(t)


COUNTED_SQL = f"""
    WITH w AS ({WINDOW_SQL})
    SELECT since, until, count(o_orderkey) AS n, count(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS urgent
    FROM w LEFT JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN since AND until GROUP BY since, until
"""


def counted_windows(t: Tables) -> tuple[DataFrame, DataFrame]:
    """All windows with their rows, and those where a fifth of the rows or more is urgent."""
    planned = order_windows(t)
    dated = t.orders.withColumn("date_start", F.to_date("o_orderdate"))
    every = windows.rows_per_window(dated, planned)
    urgent = windows.rows_per_window(dated.where("o_orderpriority = '1-URGENT'"), planned)
    both = every.join(urgent.withColumnRenamed("rows_loaded", "urgent"), ["since", "until"])
    return every, both.where("urgent * 5 >= rows_loaded").drop("urgent")


def checkpoint_of(t: Tables, loaded: DataFrame) -> DataFrame:
    return windows.mark_completed(t.spark.createDataFrame([], fv.DECLARED[fv.CHECKPOINT]), loaded, "ad")


@query("resume_windows", f"SELECT since, until, n AS rows_loaded FROM ({COUNTED_SQL}) WHERE urgent * 5 < n")
def resume_windows(t: Tables) -> DataFrame:
    """With the urgent windows completed, the windows still to load and the rows each will load."""
    every, urgent = counted_windows(t)
    done = windows.completed_windows(checkpoint_of(t, urgent), "ad")
    todo = windows.remaining_windows(order_windows(t), done)
    return every.join(todo, ["since", "until"], "left_semi")


@query("reopened_windows", f"SELECT since, until, n AS rows_loaded FROM ({COUNTED_SQL}) WHERE urgent * 5 < n")
def reopened_windows(t: Tables) -> DataFrame:
    """With all windows completed and the urgent ones opened again, the windows still complete."""
    every, urgent = counted_windows(t)
    kept = windows.reopen_windows(checkpoint_of(t, every), urgent.select("since", "until"))
    return kept.select("since", "until", "rows_loaded")


@query(
    "rolling_reload",
    """
    WITH recent AS (
        SELECT * FROM events
        WHERE CAST(ts AS DATE) BETWEEN (SELECT CAST(max(ts) AS DATE) FROM events) - 6
              AND (SELECT CAST(max(ts) AS DATE) FROM events))
    SELECT CAST(ts AS DATE) AS date_start, CAST(user_id AS VARCHAR) AS ad_id, event_type, value AS spend
    FROM recent QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id, event_type ORDER BY ts DESC) = 1
    """,
)
def rolling_reload(t: Tables) -> DataFrame:
    """The newest row per key of the last seven days, today included."""
    from adtally.operators.keyed import keep_last

    day = F.to_date("ts")
    today = t.events.agg(F.max(day)).first()[0]
    first, last = windows.rolling_range(today + timedelta(days=1), 7)
    recent = t.events.withColumn("date_start", day).where(windows.within(first, last))
    newest = keep_last(recent, ["date_start", "user_id", "event_type"], ["ts"])
    return newest.select("date_start", m.text("user_id").alias("ad_id"), "event_type", F.col("value").alias("spend"))


@query(
    "preset_snapshot",
    """
    SELECT event_id, CAST(ts AS DATE) AS date_start, event_type, value FROM events
    WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events) - 1
    """,
)
def preset_snapshot(t: Tables) -> DataFrame:
    day = F.to_date("ts")
    first, last = windows.preset_range("yesterday", t.events.agg(F.max(day)).first()[0])
    return t.events.withColumn("date_start", day).where(windows.within(first, last)).select(
        "event_id", "date_start", "event_type", "value"
    )
