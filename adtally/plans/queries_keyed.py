"""Registered queries: one row per key, upserts, registry and erasure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from adtally import fixed_values as fv
from adtally.operators import catalog, erase, keyed, registry
from adtally.plans import driver_model as m
from adtally.plans.driver_model import Tables
from adtally.plans.loads import distinct_records
from adtally.plans.registered import query

RANKED_SQL = """
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts {direction}, event_id {direction}) = 1
"""
EVENT_COLUMNS = ["user_id", "event_type", "event_id", "value"]


@query("dedup_keep_last", RANKED_SQL.format(direction="DESC"))
def dedup_keep_last(t: Tables) -> DataFrame:
    return keyed.keep_last(t.events, ["user_id", "event_type"], ["ts", "event_id"]).select(EVENT_COLUMNS)


@query("dedup_keep_first", RANKED_SQL.format(direction="ASC"))
def dedup_keep_first(t: Tables) -> DataFrame:
    return keyed.keep_first(t.events, ["user_id", "event_type"], ["ts", "event_id"]).select(EVENT_COLUMNS)


@query("dedup_full_row", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def dedup_full_row(t: Tables) -> DataFrame:
    return distinct_records(
        t.events.select("user_id", "event_type", F.to_date("ts").alias("day"), F.col("event_id").alias("_ingest"))
    )


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINE_ORDER_SQL = ", ".join(f"{c} DESC" for c in LINE_ORDER)


@query(
    "upsert_partial",
    f"""
    WITH target AS (SELECT o_orderkey AS ad_id, 1 AS line, o_orderpriority AS label, o_totalprice AS spend FROM orders),
    batch AS (
        SELECT l_orderkey AS ad_id, l_linenumber AS line, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS spend,
               l_quantity AS clicks
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) = 1)
    SELECT COALESCE(t.ad_id, b.ad_id) AS ad_id, CAST(COALESCE(t.line, b.line) AS BIGINT) AS line, t.label,
           CASE WHEN b.ad_id IS NOT NULL THEN b.spend ELSE t.spend END AS spend, b.clicks
    FROM target t FULL OUTER JOIN batch b ON t.ad_id = b.ad_id AND t.line = b.line
    """,
)
def upsert_partial(t: Tables) -> DataFrame:
    """Line items upserted over the orders: labels survive, spends are overwritten also by NULL, clicks are new."""
    target = t.orders.select(
        F.col("o_orderkey").alias("ad_id"), F.lit(1).cast("bigint").alias("line"),
        F.col("o_orderpriority").alias("label"), F.col("o_totalprice").alias("spend"),
    )
    batch = t.lineitem.select(
        m.text("l_orderkey").alias("ad_id"), F.col("l_linenumber").cast("bigint").alias("line"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("spend"),
        F.col("l_quantity").alias("clicks"), *LINE_ORDER,
    )
    merged = keyed.upsert(target, batch, ["ad_id", "line"], LINE_ORDER)
    return merged.select("ad_id", "line", "label", "spend", "clicks")


@query(
    "merge_null_absent",
    f"""
    WITH batch AS (
        SELECT l_orderkey AS ad_id, l_suppkey AS account_id, l_returnflag AS status, l_quantity AS extra FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}, l_linenumber DESC) = 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS ad_id, CASE WHEN b.ad_id IS NOT NULL THEN CAST(b.account_id AS VARCHAR)
           ELSE CAST(o_custkey AS VARCHAR) END AS account_id,
           CASE WHEN b.ad_id IS NULL THEN o_orderpriority END AS ad_name,
           CASE WHEN b.ad_id IS NOT NULL THEN b.status ELSE o_orderstatus END AS status, o_totalprice AS kept, b.extra
    FROM orders LEFT JOIN batch b ON o_orderkey = b.ad_id
    """,
)
def merge_null_absent(t: Tables) -> DataFrame:
    """The mirror merge: declared columns the batch lacks become NULL where it matches, undeclared ones stay."""
    target = t.orders.select(
        m.text("o_orderkey").alias("ad_id"), m.text("o_custkey").alias("account_id"),
        F.col("o_orderpriority").alias("ad_name"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("kept"),
    )
    batch = t.lineitem.select(
        F.col("l_orderkey").alias("Ad.ID"), F.col("l_suppkey").alias("account_id"), F.col("l_returnflag").alias("status"),
        F.col("l_quantity").alias("extra"), *LINE_ORDER, "l_linenumber",
    )
    merged = keyed.mirror_merge(target, batch, fv.ADS, ["ad_id"], [*LINE_ORDER, "l_linenumber"])
    return merged.select("ad_id", "account_id", "ad_name", "status", "kept", "extra")


@query(
    "split_write",
    """
    SELECT 'ads' AS target, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS account_id, o_orderpriority AS name
    FROM orders
    UNION ALL
    (SELECT 'creatives', CAST(o_custkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
            CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_orderstatus END
     FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
    """,
)
def split_write(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    ads = t.orders.select(
        m.text("o_orderkey").alias("ad_id"), m.text("o_custkey").alias("account_id"), F.col("o_orderpriority").alias("ad_name"),
        F.when(status == "O", F.col("o_custkey")).alias("creative.id"), F.col("o_custkey").alias("creative_id"),
        F.when(status == "F", F.col("o_orderpriority")).otherwise(" ").alias("creative.name"), status.alias("creative_name"),
        F.col("o_orderkey").alias("_ingest"),
    )
    creatives = keyed.creatives_of_ads(ads, ["_ingest"])
    return ads.select(
        F.lit("ads").alias("target"), F.col("ad_id").alias("id"), "account_id", F.col("ad_name").alias("name")
    ).unionByName(
        creatives.select(
            F.lit("creatives").alias("target"), F.col("creative_id").alias("id"), "account_id",
            F.col("creative_name").alias("name"),
        )
    )


@query(
    "fill_missing",
    """
    WITH found AS (SELECT o_custkey, CASE WHEN max(o_totalprice) > 300000 THEN max(o_orderkey) END AS url FROM orders GROUP BY o_custkey)
    SELECT c_custkey AS creative_id, c_name,
           COALESCE(CASE WHEN c_acctbal > 3000 THEN 'known' END, CAST(url AS VARCHAR)) AS preview_url
    FROM customer LEFT JOIN found ON c_custkey = o_custkey
    """,
)
def fill_missing(t: Tables) -> DataFrame:
    stored = t.customer.select(
        F.col("c_custkey").alias("creative_id"), "c_name", F.when(F.col("c_acctbal") > 3000, "known").alias("preview_url")
    )
    lookup = t.orders.groupBy(F.col("o_custkey").alias("creative_id")).agg(
        F.when(F.max("o_totalprice") > 300000, F.max("o_orderkey").cast("string")).alias("preview_url")
    )
    return keyed.fill_missing(stored, lookup, "creative_id", "preview_url")


@query(
    "fill_missing_limit",
    """
    WITH stored AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal > 3000 THEN 'known' END AS url FROM customer),
    found AS (SELECT o_custkey, CAST(max(o_orderkey) AS VARCHAR) AS url FROM orders GROUP BY o_custkey),
    chosen AS (SELECT c_custkey FROM stored WHERE url IS NULL ORDER BY c_custkey LIMIT 25)
    SELECT s.c_custkey AS creative_id, c_name, COALESCE(s.url, CASE WHEN c.c_custkey IS NOT NULL THEN f.url END) AS preview_url
    FROM stored s LEFT JOIN chosen c ON s.c_custkey = c.c_custkey LEFT JOIN found f ON s.c_custkey = o_custkey
    """,
)
def fill_missing_limit(t: Tables) -> DataFrame:
    """The first 25 creatives without a preview looked up, whether or not there is one for them."""
    stored = t.customer.select(
        F.col("c_custkey").alias("creative_id"), "c_name", F.when(F.col("c_acctbal") > 3000, "known").alias("preview_url")
    )
    lookup = t.orders.groupBy(F.col("o_custkey").alias("creative_id")).agg(F.max("o_orderkey").cast("string").alias("preview_url"))
    return keyed.fill_missing(stored, lookup, "creative_id", "preview_url", limit=25)


def customer_registry(t: Tables) -> DataFrame:
    """Customers as registry rows with flags as people type them."""
    flag = (
        F.when(F.col("c_nationkey") < 5, " Yes ").when(F.col("c_nationkey") < 10, "0")
        .when(F.col("c_nationkey") < 15, "TRUE").when(F.col("c_nationkey") < 20, "no")
    )
    spelled = F.when(F.col("c_acctbal") > 0, m.text("c_custkey")).otherwise(F.concat(F.lit("act_"), m.text("c_custkey")))
    return t.customer.select(
        spelled.alias("account_id"), F.col("c_name").alias("account_name"),
        F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("profile_name"), flag.alias("include_in_etl"),
    )


REGISTRY_SQL = """
    SELECT 'act_' || c_custkey AS account_id, c_name AS account_name, ' ' || lower(c_mktsegment) AS profile_name
    FROM customer WHERE (c_nationkey < 5 OR c_nationkey BETWEEN 10 AND 14 OR c_nationkey >= 20)
"""


@query("registry_filter", REGISTRY_SQL)
def registry_filter(t: Tables) -> DataFrame:
    listed = registry.included_accounts(customer_registry(t), ["account_name"])
    return listed.select("account_id", "account_name", "profile_name")


@query("registry_profile", REGISTRY_SQL + " AND c_mktsegment = 'MACHINERY'")
def registry_profile(t: Tables) -> DataFrame:
    listed = registry.included_accounts(customer_registry(t), ["account_name"], " Machinery")
    return registry.account_ids(listed).join(listed.select("account_id", "account_name", "profile_name"), "account_id")


@query(
    "registry_merge",
    """
    WITH existing AS (
        SELECT o_custkey, CASE WHEN max(o_totalprice) > 400000 THEN min(o_orderpriority) END AS profile_name,
               CASE WHEN count(*) > 10 THEN false END AS include_in_etl
        FROM orders GROUP BY o_custkey)
    SELECT 'act_' || c_custkey AS account_id, c_name AS account_name, CAST(c_nationkey AS BIGINT) AS account_status,
           profile_name, COALESCE(include_in_etl, true) AS include_in_etl, CAST(NULL AS VARCHAR) AS notes
    FROM customer LEFT JOIN existing ON c_custkey = o_custkey
    """,
)
def registry_merge(t: Tables) -> DataFrame:
    landed = t.customer.select(
        F.concat(F.lit("act_"), m.text("c_custkey")).alias("id"), F.col("c_name").alias("name"),
        m.text("c_nationkey").alias("account_status"), F.col("c_custkey").alias("_ingest"),
    )
    existing = t.orders.groupBy(F.concat(F.lit("act_"), m.text("o_custkey")).alias("account_id")).agg(
        F.when(F.max("o_totalprice") > 400000, F.min("o_orderpriority")).alias("profile_name"),
        F.when(F.count(F.lit(1)) > 10, F.lit(False)).alias("include_in_etl"),
        F.lit(None).cast("string").alias("notes"),
    )
    merged = registry.merge_registry(registry.registry_from_accounts(landed, ["_ingest"]), existing)
    return registry.sort_registry(merged).withColumn("account_status", F.col("account_status").cast("bigint"))


def delete_list(t: Tables) -> DataFrame:
    """Nations of three regions are marked for deletion, in both spellings of their id."""
    mark = F.when(F.col("n_regionkey") == 0, " true").when(F.col("n_regionkey") == 1, "1").when(F.col("n_regionkey") == 2, "no")
    spelled = F.when(F.col("n_nationkey") > 12, m.text("n_nationkey")).otherwise(F.concat(F.lit("act_"), m.text("n_nationkey")))
    return t.nation.select(spelled.alias("account_id"), F.col("n_name").alias("account_name"), mark.alias("delete"))


DOOMED_SQL = "SELECT n_nationkey FROM nation WHERE n_regionkey IN (0, 1)"


def account_tables(t: Tables) -> dict[str, DataFrame]:
    """Tables tied to accounts directly, through ads, and through ad sets."""
    return {
        fv.ACCOUNTS: t.nation.select(F.concat(F.lit("act_"), m.text("n_nationkey")).alias("id")),
        fv.ADS: t.customer.select(m.text("c_custkey").alias("ad_id"), m.text("c_nationkey").alias("account_id")),
        fv.ADSETS: t.supplier.select(
            m.text("s_suppkey").alias("adset_id"), F.concat(F.lit("act_"), m.text("s_nationkey")).alias("account_id")
        ),
        fv.AD_FACT: t.orders.select(m.text("o_custkey").alias("ad_id"), F.col("o_orderkey").alias("row")),
        fv.FACT_TABLE_PREFIX + "adset": t.lineitem.select(
            m.text("l_suppkey").alias("adset_id"), F.col("l_orderkey").alias("row")
        ),
    }


@query(
    "erase_preview",
    f"""
    WITH doomed AS ({DOOMED_SQL}), counts AS (
        SELECT '{fv.ACCOUNTS}' AS table_name, count(*) AS rows_erased FROM nation WHERE n_nationkey IN (FROM doomed) AND n_nationkey <= 12
        UNION ALL SELECT '{fv.ADS}', count(*) FROM customer WHERE c_nationkey IN (FROM doomed)
        UNION ALL SELECT '{fv.ADSETS}', count(*) FROM supplier WHERE s_nationkey IN (FROM doomed)
        UNION ALL SELECT '{fv.AD_FACT}', count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IN (FROM doomed)
        UNION ALL SELECT '{fv.FACT_TABLE_PREFIX}adset', count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                  WHERE s_nationkey IN (FROM doomed))
    SELECT table_name, CAST(rows_erased AS BIGINT) AS rows_erased FROM counts
    UNION ALL SELECT '(total)', CAST(sum(rows_erased) AS BIGINT) FROM counts
    """,
)
def erase_preview(t: Tables) -> DataFrame:
    return erase.erase_report(account_tables(t), erase.delete_targets(delete_list(t)))


@query(
    "erase_survivors",
    f"""
    WITH doomed AS ({DOOMED_SQL})
    SELECT '{fv.AD_FACT}' AS table_name, CAST(o_custkey AS VARCHAR) AS entity, o_orderkey AS "row"
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey NOT IN (FROM doomed)
    UNION ALL
    SELECT '{fv.FACT_TABLE_PREFIX}adset', CAST(l_suppkey AS VARCHAR), l_orderkey
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey NOT IN (FROM doomed)
    """,
)
def erase_survivors(t: Tables) -> DataFrame:
    frames = account_tables(t)
    targets = erase.delete_targets(delete_list(t))
    kept = [
        erase.surviving_rows(name, frames[name], targets, frames).select(
            F.lit(name).alias("table_name"), F.col(entity).alias("entity"), "row"
        )
        for name, entity in ((fv.AD_FACT, "ad_id"), (fv.FACT_TABLE_PREFIX + "adset", "adset_id"))
    ]
    return reduce(DataFrame.unionByName, kept)


@query(
    "catalog_overlap",
    """
    WITH a AS (SELECT DISTINCT 'orders_of_' || o_custkey AS table_name FROM orders),
         b AS (SELECT DISTINCT 'orders_of_' || c_custkey AS table_name FROM customer WHERE c_acctbal > 0)
    SELECT 'both' AS side, table_name FROM (FROM a INTERSECT FROM b)
    UNION ALL SELECT 'source', table_name FROM (FROM a EXCEPT FROM b)
    UNION ALL SELECT 'mirror', table_name FROM (FROM b EXCEPT FROM a)
    """,
)
def catalog_overlap(t: Tables) -> DataFrame:
    source = t.orders.select(F.concat(F.lit("orders_of_"), m.text("o_custkey")).alias("table_name"))
    mirror = t.customer.where("c_acctbal > 0").select(F.concat(F.lit("orders_of_"), m.text("c_custkey")).alias("table_name"))
    parts = {
        "both": catalog.shared_names(source, mirror),
        "source": catalog.names_only_in(source, mirror),
        "mirror": catalog.names_only_in(mirror, source),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(side).alias("side"), "table_name") for side, df in parts.items()])
