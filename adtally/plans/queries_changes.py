"""Registered queries about what changes: stored types, days owed to a mirror or the combined table, unchanged days.

Where a query must show that something was left alone, it first puts a mark there that a rewrite would wipe out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from adtally import fixed_values as fv
from adtally.plans import driver_model as m, loads
from adtally.plans.driver_model import Tables
from adtally.plans.queries_tables import KNOWN, LOADED_SQL, MONTH_SQL, landed_delivery, month
from adtally.plans.registered import query
from adtally.operators import reshape
from adtally.operators.star import star_of_buckets
from adtally.plans.queries_reshape import K_SQL, event_metrics
from adtally.plans.sync import sync_tables
from adtally.session import scratch_path
from adtally.sources import changes, landed, tables
from adtally.streaming.landing import REASONS, REJECTS, stream_facts


@query(
    "upsert_promotes",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS ad_id, {MONTH_SQL} AS date_start, {MONTH_SQL} AS date_stop,
           CASE WHEN o_custkey % 3 = 0 THEN o_totalprice * 2 WHEN o_orderstatus <> 'P' THEN o_totalprice END AS frequency,
           CASE WHEN o_custkey % 3 = 0 THEN CAST(o_custkey + 1 AS VARCHAR) WHEN o_orderstatus = 'P' THEN 'n/a'
                ELSE CAST(o_custkey AS VARCHAR) END AS note_score,
           'string,date,date,double,string' AS types
    FROM orders
    """,
)
def upsert_promotes(t: Tables) -> DataFrame:
    """Facts stored with number ids, days as text and numbers as text, then a batch that asks for other types.

    The ids become text, the days DATE, one text column DOUBLE; the other has a text that is no number and stays.
    """
    table = f"{m.new_database(t.spark, 'promotes')}.{fv.AD_FACT}"
    paused = F.col("o_orderstatus") == "P"
    stored = t.orders.select(
        F.col("o_orderkey").cast("bigint").alias("ad_id"), month().alias("date_start"),
        F.date_format(month(), "yyyy-MM-dd").alias("date_stop"),
        F.when(paused, "").otherwise(m.text("o_totalprice")).alias("frequency"),
        F.when(paused, "n/a").otherwise(m.text("o_custkey")).alias("note_score"),
    )
    stored.write.partitionBy("date_start").saveAsTable(table)
    batch = t.orders.where("o_custkey % 3 = 0").select(
        m.text("o_orderkey").alias("ad_id"), month().alias("date_start"), month().alias("date_stop"),
        (F.col("o_totalprice") * 2).alias("frequency"), (F.col("o_custkey") + 1).alias("note_score"),
    )
    tables.upsert_table(t.spark, batch, table, None)
    names = ["ad_id", "date_start", "date_stop", "frequency", "note_score"]
    kept = t.spark.table(table).select(names)
    return kept.withColumn("types", F.lit(",".join(f.dataType.simpleString() for f in kept.schema)))


def monthly(t: Tables, clicks) -> DataFrame:
    return t.orders.groupBy(m.text("o_custkey").alias("ad_id"), month().alias("date_start")).agg(clicks.alias("clicks"))


@query(
    "sync_owed",
    f"""
    SELECT CAST(o_custkey AS VARCHAR) AS ad_id, {MONTH_SQL} AS date_start,
           CAST(CASE WHEN year({MONTH_SQL}) % 2 = 1 OR year({MONTH_SQL}) = 1994 THEN max(o_orderkey) ELSE -1 END AS DOUBLE) AS clicks
    FROM orders GROUP BY 1, 2
    """,
)
def sync_owed(t: Tables) -> DataFrame:
    """Facts mirrored, changed by two loads without a mirror run between them, then mirrored as far as owed.

    The mirror's numbers are marked -1 in between. A third load brings what is stored already and owes nothing.
    """
    database, mirror = m.new_database(t.spark, "owed"), m.new_database(t.spark, "owed_mirror")
    table = f"{database}.{fv.AD_FACT}"
    tables.upsert_table(t.spark, monthly(t, F.lit(0).cast("bigint")), table, None)
    sync_tables(t.spark, database, mirror, [fv.AD_FACT], create=True, owed=True)
    copy = t.spark.table(f"{mirror}.{fv.AD_FACT}")
    marked = F.lit(-1).cast(copy.schema["clicks"].dataType)
    tables.replace_table(copy.withColumn("clicks", marked), f"{mirror}.{fv.AD_FACT}")
    newest = monthly(t, F.max("o_orderkey"))
    tables.upsert_table(t.spark, newest.where("year(date_start) % 2 = 1"), table, None)
    tables.upsert_table(t.spark, newest.where("year(date_start) = 1994"), table, None)
    tables.upsert_table(t.spark, monthly(t, F.lit(0).cast("bigint")).where("year(date_start) = 1996"), table, None)
    sync_tables(t.spark, database, mirror, [fv.AD_FACT], create=True, owed=True)
    return m.doubles(t.spark.table(f"{mirror}.{fv.AD_FACT}").select("ad_id", "date_start", "clicks"))


@query(
    "combined_delta",
    f"""
    WITH f AS (SELECT o_orderkey, {MONTH_SQL} AS month, o_custkey, o_totalprice FROM orders),
    hit AS (SELECT DISTINCT month FROM f WHERE year(month) = 1995 OR o_custkey = (SELECT max(o_custkey) FROM orders))
    SELECT CAST(o_orderkey AS VARCHAR) AS ad_id, f.month AS date_start,
           CASE WHEN hit.month IS NULL THEN CAST(-1 AS DOUBLE)
                ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN year(f.month) = 1995 THEN 1 ELSE 0 END AS DOUBLE) END AS spend,
           CASE WHEN o_custkey = (SELECT max(o_custkey) FROM orders) THEN 'ENDED' ELSE 'ACTIVE' END AS campaign_status
    FROM f LEFT JOIN hit ON f.month = hit.month
    """,
)
def combined_delta(t: Tables) -> DataFrame:
    """The combined table brought up to date after a year of facts and one campaign changed; mirrored in the same way.

    Its spends are marked -1 in between, so months that were left alone show that.
    """
    database, mirror = m.new_database(t.spark, "delta"), m.new_database(t.spark, "delta_mirror")
    facts = t.orders.select(
        m.text("o_orderkey").alias("ad_id"), month().alias("date_start"), month().alias("date_stop"),
        F.lit("1").alias("account_id"), m.text("o_custkey").alias("campaign_id"), m.text("o_custkey").alias("adset_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("spend"), F.lit("x").alias("objective"),
    )
    campaigns = t.orders.select(m.text("o_custkey").alias("campaign_id"), F.lit("ACTIVE").alias("status")).distinct()
    frames = {fv.AD_FACT: facts, fv.ACCOUNTS: m.accounts(t), fv.ADS: m.ads(t), fv.CREATIVES: m.creatives(t), fv.CAMPAIGNS: campaigns}
    for name, df in frames.items():
        tables.upsert_table(t.spark, df, f"{database}.{name}", None)
    loads.materialise_combined(t.spark, database, mirror)
    for stored in (f"{database}.{fv.COMBINED}", f"{mirror}.{fv.COMBINED}"):
        held = tables.for_copying(t.spark).table(stored)
        tables.replace_table(held.withColumn("spend", F.lit(-1).cast(held.schema["spend"].dataType)), stored, arranged=True)
        t.spark.catalog.refreshTable(stored)
        changes.refresh(t.spark, stored)
    # What marks a table is no change of its source.
    sync_tables(t.spark, database, mirror, [fv.COMBINED], create=True, owed=True)
    year = facts.where("year(date_start) = 1995").withColumn("spend", (F.col("spend") + 1).cast("decimal(18,2)"))
    tables.upsert_table(t.spark, year, f"{database}.{fv.AD_FACT}", None)
    last = t.orders.agg(F.max("o_custkey").cast("string").alias("campaign_id")).withColumn("status", F.lit("ENDED"))
    tables.upsert_table(t.spark, last, f"{database}.{fv.CAMPAIGNS}", None)
    loads.materialise_combined(t.spark, database, mirror)
    return m.doubles(t.spark.table(f"{mirror}.{fv.COMBINED}").select("ad_id", "date_start", "spend", "campaign_status"))


@query(
    "rolling_unchanged",
    f"""
    WITH last AS (SELECT max({MONTH_SQL}) AS month FROM orders)
    SELECT n.month AS date_start, n.month <> (SELECT month FROM last) AS same_files, count(DISTINCT o_custkey) AS row_count
    FROM (SELECT o_custkey, {MONTH_SQL} AS month FROM orders) AS n, last
    WHERE n.month BETWEEN last.month - 400 AND last.month GROUP BY 1, 2
    """,
)
def rolling_unchanged(t: Tables) -> DataFrame:
    """The last 400 days reloaded with late records for the last month only: days that did not change keep their files."""
    database = m.new_database(t.spark, "rolling")
    (last,) = t.orders.agg(F.max(month())).first()
    records = landed_delivery(t)
    late = records.withColumn("spend", F.when(F.col("date_start") == str(last), F.lit("0.5")).otherwise(F.col("spend")))

    def load(rows: DataFrame) -> DataFrame:
        loads.load_rolling(t.spark, rows, "ad", database, ["_ingest"], last, 400, include_today=True, **KNOWN)
        return t.spark.table(f"{database}.{fv.AD_FACT}").select("date_start", F.col("_metadata.file_path").alias("file"))

    # As many rows as days and files.
    first = t.spark.createDataFrame(load(records).distinct().collect(), "date_start DATE, file STRING")
    second = load(late).groupBy("date_start", "file").agg(F.count(F.lit(1)).alias("row_count"))
    met = second.join(first.withColumn("was", F.lit(True)), ["date_start", "file"], "left")
    return met.groupBy("date_start").agg(
        F.min(F.coalesce("was", F.lit(False))).alias("same_files"), F.sum("row_count").alias("row_count")
    )


REPLAYED = "year(date_start) = 1997"
REPLAYED_SQL = f"""
    SELECT CAST(o_custkey AS VARCHAR) AS ad_id, {MONTH_SQL} AS date_start, o_orderpriority AS objective, o_totalprice + 1 AS spend
    FROM orders WHERE year({MONTH_SQL}) = 1997
    QUALIFY row_number() OVER (PARTITION BY o_custkey, {MONTH_SQL} ORDER BY o_orderkey DESC) = 1
"""


@query("raw_replay_days", REPLAYED_SQL)
def raw_replay_days(t: Tables) -> DataFrame:
    """A raw history with an older payload of every record, kept by level and day; one year of it replayed."""
    database = m.new_database(t.spark, "raw_days")
    records, raw = landed_delivery(t), f"{database}.{fv.RAW_INSIGHTS}"
    highest = F.lit(1_000_000_000_000)
    for spend, number in ((F.lit("1"), F.col("_ingest")), (F.col("spend").cast("double") + 1, F.col("_ingest") + highest)):
        changed = records.withColumn("spend", spend.cast("string"))
        tables.write_table(landed.raw_insight_rows(changed, "ad", [], number), raw)
    loads.replay_facts(t.spark, t.spark.table(raw), "ad", database, from_date="1997-01-01", to_date="1997-12-31", **KNOWN)
    return m.doubles(t.spark.table(f"{database}.{fv.AD_FACT}").select("ad_id", "date_start", "objective", "spend"))


@query(
    "metric_map",
    f"""
    WITH e AS (SELECT event_id, event_type, {K_SQL} AS k FROM events)
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CASE WHEN event_type = 'click' THEN CAST(CASE WHEN k < 50 THEN k + 1 ELSE k END AS VARCHAR) END AS actions_click,
           CASE WHEN event_type <> 'click' THEN CAST(CASE WHEN k < 50 THEN k + 1 ELSE k END AS VARCHAR) END AS own,
           CAST(k * 2 AS VARCHAR) AS app, CASE WHEN k >= 50 THEN CAST(k + 1 AS VARCHAR) END AS likes,
           CASE WHEN event_type = 'click' THEN 1 ELSE 2 END + CASE WHEN k >= 50 THEN 1 ELSE 0 END AS others
    FROM e
    """,
)
def metric_map(t: Tables) -> DataFrame:
    """One metric type as a column, whatever else there is in a map."""
    wide = reshape.expand_metrics(
        event_metrics(t).join(t.events.select("event_id", "event_type"), "event_id"), {"actions": ["click"]}, unknown="map"
    )
    rest, kind = F.col("actions_other"), F.col("event_type")
    return wide.select(
        F.col("event_id").cast("string").alias("event_id"), "actions_click", F.try_element_at(rest, kind).alias("own"),
        F.try_element_at(rest, F.concat(F.lit("app_"), kind)).alias("app"),
        F.try_element_at(rest, F.lit("page_like")).alias("likes"), F.size(rest).alias("others"),
    )


@query(
    "stream_rejects",
    """
    SELECT reason, count(*) AS row_count, min(line) AS first_line, max(line) AS last_line FROM (
        SELECT 'no JSON' AS reason, '{"ad_id": "' || o_orderkey || '", "spe' AS line FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT 'no JSON object', '[' || o_orderkey || ']' FROM orders WHERE o_orderstatus = 'F')
    GROUP BY reason
    UNION ALL
    SELECT 'loaded', count(*), min(CAST(o_orderkey AS VARCHAR)), max(CAST(o_orderkey AS VARCHAR)) FROM orders
    """,
)
def stream_rejects(t: Tables) -> DataFrame:
    """Records landed with cut lines and lists among them, streamed twice: what was refused, and how much was loaded."""
    database, path = m.new_database(t.spark, "rejects"), scratch_path(t.spark, "landing")
    key, status = m.text("o_orderkey"), F.col("o_orderstatus")
    record = F.to_json(F.struct(key.alias("ad_id"), F.date_format(month(), "yyyy-MM-dd").alias("date_start"), m.text("o_totalprice").alias("spend")))
    cut = F.when(status == "P", F.concat(F.lit('{"ad_id": "'), key, F.lit('", "spe')))
    odd = F.coalesce(cut, F.when(status == "F", F.concat(F.lit("["), key, F.lit("]"))))
    t.orders.select(F.explode(F.array(record, odd)).alias("value")).where("value IS NOT NULL").write.text(path)
    progress = scratch_path(t.spark, "landing-progress")
    for _ in range(2):
        stream_facts(t.spark, path, "ad", database, progress, metric_types={}, numeric_text=["spend"]).awaitTermination()
    rejected = t.spark.table(f"{database}.{REJECTS}").select("reason", "line")
    loaded = t.spark.table(f"{database}.{fv.AD_FACT}").select(F.lit("loaded").alias("reason"), F.col("ad_id").alias("line"))
    return extent(loaded, ["loaded"]).unionByName(extent(rejected, REASONS))


def extent(lines: DataFrame, reasons: Sequence[str]) -> DataFrame:
    """How many lines there are for each of the reasons, the first and the last; no row for a reason without lines.

    Least and largest texts by group would sort all lines in every task; an aggregate without groups keeps one row.
    """
    per_reason = [
        lines.where(F.col("reason") == reason).agg(
            F.lit(reason).alias("reason"), F.count(F.lit(1)).alias("row_count"),
            F.min("line").alias("first_line"), F.max("line").alias("last_line"),
        ).where("row_count > 0")
        for reason in reasons
    ]
    return reduce(DataFrame.unionByName, per_reason)


@query(
    "star_bucketed",
    f"""
    SELECT f.ad_id, f.date_start, f.spend, o_orderstatus AS ad_status, c_mktsegment AS creative_title
    FROM ({LOADED_SQL}) f LEFT JOIN orders ON f.ad_id = CAST(o_orderkey AS VARCHAR)
    LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def star_bucketed(t: Tables) -> DataFrame:
    """Facts, ads and creatives loaded into buckets and joined as they lie, ads with many rows apart from the others."""
    # Ads are the largest of these tables; counted from footers.
    database, buckets = m.new_database(t.spark, "buckets"), tables.buckets_for(t.orders.count())
    loads.load_facts(t.spark, landed_delivery(t), "ad", database, ["_ingest"], buckets=buckets, **KNOWN)
    creatives = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title"), F.col("c_custkey").alias("_ingest")
    )
    ads = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("creative_id"),
        F.col("o_orderkey").alias("_ingest"),
    )
    accounts = t.nation.select(F.concat(F.lit("act_"), m.text("n_nationkey")).alias("id"), F.col("n_nationkey").alias("_ingest"))
    for entity, rows in (("accounts", accounts), ("creatives", creatives), ("ads", ads)):
        loads.load_dimension(t.spark, rows, entity, database, ["_ingest"], buckets=buckets)
    names = (fv.AD_FACT, fv.ACCOUNTS, fv.ADS, fv.CREATIVES)
    star = star_of_buckets(*(t.spark.table(f"{database}.{n}") for n in names), hot_rows=15)
    return m.doubles(star.select("ad_id", "date_start", "spend", "ad_status", "creative_title"))
