"""Registered queries that write: files, raw tables, upserted, mirrored, backed-up and streamed tables.

Each writes into a database or folder of its own below the scratch root and
returns what is stored there.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from adtally import fixed_values as fv
from adtally.operators.keyed import keep_last
from adtally.plans import driver_model as m, loads, upkeep
from adtally.plans.driver_model import Tables
from adtally.plans.queries_keyed import account_tables, delete_list
from adtally.plans.queries_reporting import STAR_SQL, goal_rows
from adtally.plans.refresh import refresh_range
from adtally.plans.registered import query
from adtally.plans.sync import sync_tables
from adtally.session import scratch_path
from adtally.sources import landed, tables
from adtally.streaming.landing import stream_facts


def month() -> Column:
    return F.trunc("o_orderdate", "MM")


MONTH_SQL = "CAST(date_trunc('month', o_orderdate) AS DATE)"


@query(
    "csv_roundtrip",
    """
    SELECT 'act_' || c_custkey AS account_id, c_name AS account_name, CAST(c_nationkey AS VARCHAR) AS account_status,
           CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS profile_name, CAST(NULL AS VARCHAR) AS include_in_etl,
           CAST(NULL AS VARCHAR) AS notes
    FROM customer
    """,
)
def csv_roundtrip(t: Tables) -> DataFrame:
    """Registry rows exported as CSV and scanned again: ids stay text, absent columns come back as NULL."""
    path = scratch_path(t.spark, "registry-csv")
    exported = t.customer.select(
        F.concat(F.lit("act_"), m.text("c_custkey")).alias(" Account_ID "), F.col("c_name").alias("account_name"),
        F.col("c_nationkey").alias("account_status"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("profile_name"),
    )
    landed.write_csv(exported, path)
    return landed.read_text_csv(t.spark, path, fv.REGISTRY_COLUMNS)


@query(
    "goals_file",
    """
    SELECT 'act_' || substr(o_orderpriority, 1, 1) AS account_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS goal_spend, CAST(count(*) AS DOUBLE) AS goal_purchases
    FROM orders GROUP BY 1, 2
    """,
)
def goals_file(t: Tables) -> DataFrame:
    """A goals file loaded into its table and mirrored."""
    path = scratch_path(t.spark, "goals-csv")
    landed.write_csv(goal_rows(t), path)
    database, mirror = m.new_database(t.spark, "goals"), m.new_database(t.spark, "goals_mirror")
    upkeep.load_goals(t.spark, database, path, mirror)
    return m.doubles(t.spark.table(f"{mirror}.{fv.GOALS}").select("account_id", "month", "goal_spend", "goal_purchases"))


@query(
    "json_scan",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS creative_id, c_name AS creative_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END
           AS title, CASE WHEN c_acctbal > 5000 THEN 'u' || c_custkey END AS image
    FROM customer
    """,
)
def json_scan(t: Tables) -> DataFrame:
    """Nested creative records landed as JSON lines, some lines broken, scanned with the declared fields."""
    path = scratch_path(t.spark, "creatives-json")
    images = F.when(F.col("c_acctbal") > 5000, F.array(F.struct(F.concat(F.lit("u"), m.text("c_custkey")).alias("url"))))
    record = F.to_json(
        F.struct(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("title"),
            F.struct(images.alias("images")).alias("asset_feed_spec"),
        )
    )
    t.customer.select(F.explode(F.array(record, F.lit('{"id": "cut'))).alias("value")).write.text(path)
    rows = landed.read_records(t.spark, path, landed.entity_schema("creatives"))
    wide = loads.normalise_dimension(rows, "creatives", numeric_text=[])
    return wide.select("creative_id", "creative_name", "title", F.col("asset_feed_spec_image_url").alias("image"))


def landed_delivery(t: Tables) -> DataFrame:
    """Orders as delivery records of a month each, with metric lists; the order key says which is newest."""
    kind = F.col("o_orderstatus")
    metric = F.struct(
        F.concat(F.lit("kind:"), kind).alias("action_type"), F.lit(None).cast("string").alias("indicator"),
        m.text("o_custkey").alias("value"),
    )
    return t.orders.select(
        m.text("o_custkey").alias("ad_id"), F.date_format(month(), "yyyy-MM-dd").alias("date_start"),
        F.date_format(month(), "yyyy-MM-dd").alias("date_stop"), F.col("o_orderpriority").alias("objective"),
        m.text("o_totalprice").alias("spend"), F.array(metric).alias("actions"), F.col("o_orderkey").alias("_ingest"),
    )


LOADED_SQL = f"""
    SELECT CAST(o_custkey AS VARCHAR) AS ad_id, {MONTH_SQL} AS date_start, o_orderpriority AS objective,
           o_totalprice AS spend,
           CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS actions_kind_f,
           CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS actions_kind_o
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, {MONTH_SQL} ORDER BY o_orderkey DESC) = 1
"""
LOADED_COLUMNS = ["ad_id", "date_start", "objective", "spend", "actions_kind_f", "actions_kind_o"]
KNOWN = {"metric_types": {"actions": ["kind_F", "kind_O", "kind_P"]}, "numeric_text": [
    "spend", "actions_kind_F", "actions_kind_O", "actions_kind_P"]}


@query("fact_load", LOADED_SQL)
def fact_load(t: Tables) -> DataFrame:
    """Two loads into a partitioned fact table: the records with small spends first, then all of them."""
    database = m.new_database(t.spark, "facts")
    records = landed_delivery(t)
    early = records.where("CAST(spend AS DOUBLE) < 100000")
    loads.load_facts(t.spark, early, "ad", database, ["_ingest"], **KNOWN)
    table = loads.load_facts(t.spark, records, "ad", database, ["_ingest"], **KNOWN)
    return m.doubles(t.spark.table(table).select(LOADED_COLUMNS))


@query("raw_replay", LOADED_SQL)
def raw_replay(t: Tables) -> DataFrame:
    """Records appended to the raw table as JSON and loaded into facts from there."""
    database = m.new_database(t.spark, "raw")
    records = landed_delivery(t)
    raw = landed.raw_insight_rows(records, "ad", [], F.col("_ingest"))
    tables.write_table(raw, f"{database}.{fv.RAW_INSIGHTS}", layout=tables.Layout(partition=("level",)))
    table = loads.replay_facts(t.spark, t.spark.table(f"{database}.{fv.RAW_INSIGHTS}"), "ad", database, **KNOWN)
    return m.doubles(t.spark.table(table).select(LOADED_COLUMNS))


@query(
    "breakdown_load",
    f"""
    SELECT CAST(o_custkey AS VARCHAR) AS ad_id, {MONTH_SQL} AS date_start, o_orderstatus AS country, max_by(o_totalprice, o_orderkey) AS spend
    FROM orders GROUP BY ALL
    """,
)
def breakdown_load(t: Tables) -> DataFrame:
    """Delivery records broken down by country, loaded twice: rows are kept by ad, day and country."""
    database = m.new_database(t.spark, "breakdown")
    records = landed_delivery(t).join(
        t.orders.select(F.col("o_orderkey").alias("_ingest"), F.col("o_orderstatus").alias("country")), "_ingest"
    )
    for part in (records.where("country <> 'F'").withColumn("spend", F.lit("1")), records):
        table = loads.load_facts(t.spark, part, "ad", database, ["_ingest"], [" country "], **KNOWN)
    return m.doubles(t.spark.table(table).select("ad_id", "date_start", "country", "spend"))


@query(
    "range_load",
    f"""
    WITH bounds AS (SELECT min({MONTH_SQL}) AS first, max({MONTH_SQL}) AS last FROM orders),
    w AS (SELECT CAST(d AS DATE) AS since, least(CAST(d AS DATE) + 199, last) AS until
          FROM (SELECT unnest(generate_series(first, last, INTERVAL 200 DAY)) AS d, last FROM bounds)),
    kept AS (SELECT DISTINCT o_custkey, {MONTH_SQL} AS month FROM orders)
    SELECT since, until, CAST(count(o_custkey) AS BIGINT) AS rows_loaded
    FROM w LEFT JOIN kept ON month BETWEEN since AND until GROUP BY since, until
    """,
)
def range_load(t: Tables) -> DataFrame:
    """A range loaded in windows, one of them twice, read back from the checkpoint table."""
    database = m.new_database(t.spark, "range")
    records = landed_delivery(t)
    first, last = t.orders.agg(F.min(month()), F.max(month())).first()
    loads.load_range(t.spark, records, "ad", database, ["_ingest"], first, first + timedelta(days=199), 200, **KNOWN)
    loads.load_range(t.spark, records, "ad", database, ["_ingest"], first, last, 200, **KNOWN)
    return t.spark.table(f"{database}.{fv.CHECKPOINT}").select("since", "until", "rows_loaded")


@query(
    "dim_load",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS creative_id,
           CASE WHEN c_custkey IS NOT NULL THEN c_mktsegment END AS title, o_orderpriority AS creative_name
    FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
    LEFT JOIN customer ON o_custkey = c_custkey
    UNION ALL
    SELECT CAST(c_custkey AS VARCHAR), c_mktsegment, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    """,
)
def dim_load(t: Tables) -> DataFrame:
    """Creatives loaded in full, then ads: the ads renew creative names and leave the rest of a creative alone."""
    database = m.new_database(t.spark, "dims")
    creatives = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title"),
        F.col("c_custkey").alias("_ingest"),
    )
    loads.load_dimension(t.spark, creatives, "creatives", database, ["_ingest"])
    ads = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name")).alias("creative"),
        F.col("o_orderkey").alias("_ingest"),
    )
    loads.load_dimension(t.spark, ads, "ads", database, ["_ingest"])
    return t.spark.table(f"{database}.{fv.CREATIVES}").select("creative_id", "title", "creative_name")


@query(
    "dim_replay",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS campaign_id, max_by(o_orderpriority, o_orderkey) AS campaign_name,
           nullif(max_by(CASE WHEN o_totalprice > 200000 THEN o_orderstatus ELSE '' END, o_orderkey), '') AS status
    FROM orders GROUP BY o_custkey
    """,
)
def dim_replay(t: Tables) -> DataFrame:
    """Campaign payloads from a raw table, broken ones skipped, newest per campaign."""
    database = m.new_database(t.spark, "dim_raw")
    records = t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_orderstatus")).alias("status"), F.col("o_orderkey").alias("_ingest"),
    )
    raw = landed.raw_rows(records, {"campaign_id": "id"}, F.col("_ingest"))
    broken = raw.withColumns({"id": F.col("id") + 1_000_000_000, "payload": F.lit("{")})
    table = f"{database}.meta_campaigns_raw"
    tables.write_table(raw.unionByName(broken), table)
    target = loads.replay_dimension(t.spark, t.spark.table(table), "campaigns", database)
    return t.spark.table(target).select("campaign_id", "campaign_name", "status")


@query(
    "partition_layout",
    f"SELECT {MONTH_SQL} AS date_start, count(*) AS row_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend "
    "FROM orders GROUP BY 1",
)
def partition_layout(t: Tables) -> DataFrame:
    """Facts written by day partition, sorted by account and ad, created only if empty, then summed per partition."""
    database = m.new_database(t.spark, "layout")
    table = f"{database}.{fv.AD_FACT}"
    facts = t.orders.select(
        m.text("o_orderkey").alias("ad_id"), m.text("o_custkey").alias("account_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("spend"), month().alias("date_start"),
    )
    tables.write_table(facts, table, "if_empty")
    per_day = t.spark.table(table).groupBy("date_start").agg(F.count(F.lit(1)).alias("row_count"), F.sum("spend").alias("spend"))
    return m.doubles(per_day)


def _source(t: Tables, label: str) -> tuple[str, str]:
    return m.new_database(t.spark, label), m.new_database(t.spark, f"{label}_mirror")


@query("sync_truncate", "SELECT c_custkey AS custkey, c_name AS name, c_acctbal AS acctbal FROM customer")
def sync_truncate(t: Tables) -> DataFrame:
    """A mirror table replaced by its source, one column left out."""
    database, mirror = _source(t, "sync")
    renamed = t.customer.select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), "c_mktsegment"
    )
    tables.write_table(renamed, f"{database}.clients")
    tables.write_table(renamed.drop("c_mktsegment"), f"{mirror}.clients")
    sync_tables(t.spark, database, mirror, ["all"], exclude={"clients": ["c_mktsegment"]})
    return t.spark.table(f"{mirror}.clients")


@query(
    "sync_append",
    """
    SELECT s_suppkey AS suppkey, s_name AS name, CAST(NULL AS DOUBLE) AS acctbal FROM supplier
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
    """,
)
def sync_append(t: Tables) -> DataFrame:
    """A mirror appended to, with a column it did not have."""
    database, mirror = _source(t, "append")
    rows = t.supplier.select(F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    tables.write_table(rows, f"{database}.vendors")
    tables.write_table(rows.drop("acctbal"), f"{mirror}.vendors")
    sync_tables(t.spark, database, mirror, ["vendors"], "append")
    return t.spark.table(f"{mirror}.vendors")


@query(
    "sync_merge",
    f"""
    WITH s AS (SELECT o_custkey, {MONTH_SQL} AS month, max(o_orderkey) AS clicks FROM orders GROUP BY 1, 2),
         o AS (SELECT l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, max(l_orderkey) AS reach
               FROM lineitem GROUP BY 1, 2)
    SELECT CAST(COALESCE(o_custkey, l_partkey) AS VARCHAR) AS ad_id, COALESCE(s.month, o.month) AS date_start,
           CAST(clicks AS DOUBLE) AS clicks, CASE WHEN o_custkey IS NULL THEN CAST(reach AS DOUBLE) END AS reach
    FROM s FULL OUTER JOIN o ON o_custkey = l_partkey AND s.month = o.month
    """,
)
def sync_merge(t: Tables) -> DataFrame:
    """Facts merged into a mirror that holds other ones: matches are overwritten, absent declared columns NULLed."""
    database, mirror = _source(t, "merge")
    source = t.orders.groupBy(m.text("o_custkey").alias("ad_id"), month().alias("date_start")).agg(F.max("o_orderkey").alias("clicks"))
    stored = t.lineitem.groupBy(m.text("l_partkey").alias("ad_id"), F.trunc("l_shipdate", "MM").alias("date_start")).agg(
        F.max("l_orderkey").alias("reach")
    )
    tables.write_table(source, f"{database}.{fv.AD_FACT}")
    tables.write_table(stored, f"{mirror}.{fv.AD_FACT}")
    sync_tables(t.spark, database, mirror, [fv.AD_FACT])
    merged = t.spark.table(f"{mirror}.{fv.AD_FACT}").select("ad_id", "date_start", "clicks", "reach")
    return m.doubles(merged.withColumn("reach", F.col("reach").cast("double")))


@query(
    "sync_merge_days",
    f"""
    SELECT CAST(o_custkey AS VARCHAR) AS ad_id, {MONTH_SQL} AS date_start,
           CASE WHEN {MONTH_SQL} < DATE '1995-01-01' THEN CAST(max(o_orderkey) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS clicks
    FROM orders GROUP BY 1, 2
    """,
)
def sync_merge_days(t: Tables) -> DataFrame:
    """Facts mirrored once, changed, and mirrored again for the days of some years only."""
    database, mirror = _source(t, "merge_days")
    facts = t.orders.groupBy(m.text("o_custkey").alias("ad_id"), month().alias("date_start")).agg(F.max("o_orderkey").alias("clicks"))
    tables.write_table(facts, f"{database}.{fv.AD_FACT}")
    tables.write_table(facts.withColumn("clicks", F.lit(0).cast("bigint")), f"{mirror}.{fv.AD_FACT}")
    early = t.spark.table(f"{database}.{fv.AD_FACT}").where("date_start < DATE'1995-01-01'").select("date_start").distinct()
    sync_tables(t.spark, database, mirror, [fv.AD_FACT], days=[r[0] for r in early.collect()])
    stored = t.spark.table(f"{mirror}.{fv.AD_FACT}")
    return stored.select("ad_id", "date_start", F.col("clicks").cast("double").alias("clicks"))


def _star_tables(t: Tables, database: str) -> None:
    frames = {
        fv.AD_FACT: m.delivery(t), fv.ACCOUNTS: m.accounts(t), fv.ADS: m.ads(t), fv.CAMPAIGNS: m.campaigns(t),
        fv.ADSETS: m.adsets(t), fv.CREATIVES: m.creatives(t).withColumn("title", F.lit("old")),
    }
    for name, df in frames.items():
        tables.write_table(df, f"{database}.{name}", layout=tables.Layout())


@query("full_view_table", STAR_SQL)
def full_view_table(t: Tables) -> DataFrame:
    """The catalog's view, read after a dimension below it was replaced."""
    database = m.new_database(t.spark, "view")
    _star_tables(t, database)
    loads.create_full_view(t.spark, database)
    tables.replace_table(m.creatives(t), f"{database}.{fv.CREATIVES}")
    return m.doubles(t.spark.table(f"{database}.{fv.FULL_VIEW}"))


@query(
    "sync_view",
    f"SELECT account_id, count(*) AS row_count, CAST(sum(spend) AS DOUBLE) AS spend FROM ({m.DELIVERY_SQL}) GROUP BY account_id",
)
def sync_view(t: Tables) -> DataFrame:
    """The catalog's view mirrored as a table, counted per account from there."""
    database, mirror = _source(t, "view")
    _star_tables(t, database)
    loads.create_full_view(t.spark, database)
    sync_tables(t.spark, database, mirror, [fv.FULL_VIEW], create=True)
    per_account = t.spark.table(f"{mirror}.{fv.FULL_VIEW}").groupBy("account_id")
    return m.doubles(per_account.agg(F.count(F.lit(1)).alias("row_count"), F.sum("spend").alias("spend")))


@query(
    "backup_restore",
    "SELECT CAST(o_orderkey AS VARCHAR) AS ad_id, o_orderstatus AS status FROM orders",
)
def backup_restore(t: Tables) -> DataFrame:
    """A table backed up, emptied, and restored from the backup."""
    database, copy = _source(t, "live")
    table = f"{database}.{fv.ADS}"
    tables.write_table(t.orders.select(m.text("o_orderkey").alias("ad_id"), F.col("o_orderstatus").alias("status")), table)
    tables.backup(t.spark, database, copy)
    tables.truncate_tables(t.spark, [table])
    tables.restore(t.spark, copy, database)
    return t.spark.table(table)


@query(
    "erase_tables",
    f"""
    WITH doomed AS (SELECT n_nationkey FROM nation WHERE n_regionkey IN (0, 1))
    SELECT '{fv.ADS}' AS table_name, count(*) AS row_count FROM customer WHERE c_nationkey NOT IN (FROM doomed)
    UNION ALL SELECT '{fv.ADSETS}', count(*) FROM supplier WHERE s_nationkey NOT IN (FROM doomed)
    UNION ALL SELECT '{fv.AD_FACT}', count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey NOT IN (FROM doomed)
    """,
)
def erase_tables(t: Tables) -> DataFrame:
    """Accounts erased from stored tables, confirmed, and what is left in each."""
    database = m.new_database(t.spark, "erase")
    frames = {n: df for n, df in account_tables(t).items() if n in (fv.ADS, fv.ADSETS, fv.AD_FACT)}
    frames[fv.AD_FACT] = frames[fv.AD_FACT].withColumn("date_start", F.lit(date(2024, 1, 1)))
    for name, df in frames.items():
        tables.write_table(df, f"{database}.{name}")
    upkeep.erase_accounts(t.spark, database, delete_list(t), confirm=True)
    left = [
        t.spark.table(f"{database}.{n}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in frames
    ]
    return left[0].unionByName(left[1]).unionByName(left[2])


@query("column_upkeep", "SELECT p_partkey, p_name AS title, p_size FROM part")
def column_upkeep(t: Tables) -> DataFrame:
    """A stored table with one column renamed and one dropped, as a field map says."""
    database = m.new_database(t.spark, "columns")
    tables.write_table(t.part.select("p_partkey", "p_name", "p_brand", "p_size"), f"{database}.parts")
    decided = [("p_name", "title", "approved"), ("p_brand", "", "excluded"), ("p_type", "kind", "approved")]
    rows = t.spark.createDataFrame(
        [("", "parts", c, "parts", c, new, status, "") for c, new, status in decided],
        ", ".join(f"{c} STRING" for c in fv.FIELD_MAP_COLUMNS),
    )
    upkeep.prune_columns(t.spark, database, rows)
    upkeep.migrate_renames(t.spark, database, rows)
    return t.spark.table(f"{database}.parts")


@query(
    "full_refresh",
    f"""
    SELECT f.ad_id, f.date_start, f.spend, f.objective, c_mktsegment AS creative_title
    FROM ({LOADED_SQL}) f LEFT JOIN orders ON f.ad_id = CAST(o_orderkey AS VARCHAR)
    LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def full_refresh(t: Tables) -> DataFrame:
    """Dimensions, facts of the whole range, mirror and combined table; the mirrored combined rows."""
    database, mirror = _source(t, "refresh")
    first, last = t.orders.agg(F.min(month()), F.max(month())).first()
    entities = {
        "accounts": t.nation.select(
            F.concat(F.lit("act_"), m.text("n_nationkey")).alias("id"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("_ingest")
        ),
        "ads": t.orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"), F.struct(F.col("o_custkey").alias("id")).alias("creative"),
            F.col("o_custkey").alias("creative_id"), F.col("o_orderkey").alias("_ingest"),
        ),
        "creatives": t.customer.select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title"), F.col("c_custkey").alias("_ingest")
        ),
    }
    refresh_range(t.spark, database, entities, landed_delivery(t), ["_ingest"], first, last, 400, mirror=mirror, **KNOWN)
    combined = t.spark.table(f"{mirror}.{fv.COMBINED}")
    return m.doubles(combined.select("ad_id", "date_start", "spend", "objective", "creative_title"))


@query("stream_load", LOADED_SQL)
def stream_load(t: Tables) -> DataFrame:
    """Delivery records landed as JSON files and upserted by a stream until nothing is left to read."""
    database = m.new_database(t.spark, "stream")
    path = scratch_path(t.spark, "landing")
    newest = keep_last(landed_delivery(t), ["ad_id", "date_start"], ["_ingest"]).drop("_ingest")
    newest.write.json(path)
    stream_facts(t.spark, path, "ad", database, scratch_path(t.spark, "landing-progress"), **KNOWN).awaitTermination()
    return m.doubles(t.spark.table(f"{database}.{fv.AD_FACT}").select(LOADED_COLUMNS))
