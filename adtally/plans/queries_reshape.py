"""Registered queries: records to wide tables, names, casts and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from adtally.functions import accounts, coerce, names, text
from adtally.operators import evolve, fieldmap, profile, reshape
from adtally.plans import driver_model as m
from adtally.plans.driver_model import Tables
from adtally.plans.loads import normalise_dimension, normalise_facts
from adtally.plans.registered import query
from adtally.sources import landed


def prop_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


K_SQL = "CAST(props->>'$.k' AS INTEGER)"


def item(action: Column, indicator: Column, value: Column) -> Column:
    return F.struct(
        action.cast("string").alias("action_type"), indicator.cast("string").alias("indicator"),
        value.cast("string").alias("value"),
    )


def event_metrics(t: Tables) -> DataFrame:
    """Events with a metric list: dotted types, a type repeated in the list, and items known by indicator."""
    kind, nothing, k = F.col("event_type"), F.lit(None), F.col("k")
    repeated = F.when(k < 50, kind).otherwise("")
    return t.events.withColumn("k", prop_k()).select(
        "event_id", F.to_date("ts").alias("date_start"),
        F.array(
            item(kind, nothing, k),
            item(F.concat(F.lit("app."), kind), nothing, k * 2),
            item(repeated, F.lit("page:like"), k + 1),
        ).alias("actions"),
    )


EVENT_KINDS = ("click", "error", "purchase", "signup", "view")
METRIC_SQL = "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS DATE) AS date_start, " + ", ".join(
    [
        f"CASE WHEN event_type <> '{e}' THEN 0.0 WHEN {K_SQL} < 50 THEN {K_SQL} + 1.0 ELSE {K_SQL} * 1.0 END"
        f" AS actions_{e}, CASE WHEN event_type = '{e}' THEN {K_SQL} * 2.0 ELSE 0.0 END AS actions_app_{e}"
        for e in EVENT_KINDS
    ]
    + [f"CASE WHEN {K_SQL} >= 50 THEN {K_SQL} + 1.0 ELSE 0.0 END AS actions_page_like"]
)
METRIC_SQL = METRIC_SQL.replace(" + 1.0", " + CAST(1 AS DOUBLE)").replace(" * 1.0", " * CAST(1 AS DOUBLE)")
METRIC_SQL = METRIC_SQL.replace(" * 2.0", " * CAST(2 AS DOUBLE)").replace(" 0.0 ", " CAST(0 AS DOUBLE) ") + " FROM events"


@query("metric_expand", METRIC_SQL)
def metric_expand(t: Tables) -> DataFrame:
    records = event_metrics(t)
    types, numeric = reshape.discover_shape(records)
    return m.doubles(reshape.fill_numbers(reshape.cast_numbers(reshape.expand_metrics(records, types), numeric)))


@query(
    "metric_expand_long",
    f"""
    WITH e AS (SELECT event_id, event_type, {K_SQL} AS k FROM events)
    SELECT event_id, 'actions' AS list, event_type AS type,
           CAST(CASE WHEN k < 50 THEN k + 1 ELSE k END AS VARCHAR) AS value FROM e
    UNION ALL SELECT event_id, 'actions', 'app_' || event_type, CAST(k * 2 AS VARCHAR) FROM e
    UNION ALL SELECT event_id, 'actions', 'page_like', CAST(k + 1 AS VARCHAR) FROM e WHERE k >= 50
    """,
)
def metric_expand_long(t: Tables) -> DataFrame:
    return reshape.expand_metrics_long(event_metrics(t), ["event_id"])


def event_results(t: Tables) -> DataFrame:
    """Events with results of every shape, as JSON text: list, object, scalar, empty and none."""
    k = m.text("k")
    shapes = (
        F.when(
            F.col("event_type") == "click",
            F.concat(
                F.lit('[{"indicator": "click", "value": "'), k,
                F.lit('"}, {"action_type": "app.open", "values": [{"value": "'), k,
                F.lit('9"}]}, 7, {"indicator": "none"}]'),
            ),
        )
        .when(F.col("event_type") == "view", F.concat(F.lit('{"views": '), k, F.lit(', "skips": null}')))
        .when(F.col("event_type") == "error", k)
        .when(F.col("event_type") == "signup", F.lit("[]"))
    )
    return t.events.withColumn("k", prop_k()).select("event_id", shapes.alias("results"))


@query(
    "results_split",
    f"""
    WITH e AS (SELECT event_id, event_type, CAST({K_SQL} AS VARCHAR) AS k FROM events)
    SELECT event_id,
           CASE event_type WHEN 'click' THEN 'click,app.open,none' WHEN 'view' THEN 'views,skips'
                WHEN 'error' THEN 'results' END AS results_indicator,
           CASE event_type WHEN 'click' THEN k || ',' || k || '9,0' WHEN 'view' THEN k || ',0'
                WHEN 'error' THEN k END AS results_value
    FROM e
    """,
)
def results_split(t: Tables) -> DataFrame:
    return reshape.split_results(event_results(t))


def raw_events(t: Tables) -> DataFrame:
    """Raw delivery rows made of events; some payloads are missing or broken."""
    payload = F.when(F.col("value") < 2, F.lit('{"k": ')).when(F.col("value") < 30, F.col("props"))
    breakdowns = F.when(F.col("value") > 20, F.lit("age")).when(F.col("value") > 10, F.lit(""))
    return t.events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("level"), F.to_date("ts").alias("date_start"),
        breakdowns.alias("breakdowns"), payload.alias("payload"),
    )


@query(
    "json_replay",
    f"""
    SELECT event_id AS _raw_id, CAST({K_SQL} AS DOUBLE) AS k FROM events
    WHERE event_type = 'click' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
      AND value >= 2 AND value <= 20
    """,
)
def json_replay(t: Tables) -> DataFrame:
    rows = landed.replay_insights(raw_events(t), "click", [], "2024-01-05", "2024-01-25")
    chosen = landed.single_breakdown(rows)
    decoded = landed.decode_payload(rows, landed.payload_schema(rows))
    return reshape.ensure_columns(decoded, {b: "string" for b in chosen}).withColumn("k", F.col("k").cast("double"))


@query(
    "replay_breakdowns",
    """
    SELECT event_type AS level, list_aggregate(list_sort(list(DISTINCT CASE WHEN value > 20 THEN 'age' ELSE '' END)), 'string_agg', '|') AS sets
    FROM events GROUP BY event_type
    """,
)
def replay_breakdowns(t: Tables) -> DataFrame:
    """Breakdown sets present per level; there are as many as breakdowns exist."""
    found = raw_events(t).select("level", F.coalesce("breakdowns", F.lit("")).alias("b")).distinct()
    return found.groupBy("level").agg(F.array_join(F.array_sort(F.collect_set("b")), "|").alias("sets"))


@query(
    "replay_first",
    "SELECT event_id AS id, event_type AS level FROM events ORDER BY event_id LIMIT 100",
)
def replay_first(t: Tables) -> DataFrame:
    return landed.first_ids(raw_events(t), 100).select("id", "level")


@query(
    "flatten_props",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS visit_id, CAST(user_id AS VARCHAR) AS visit_user_id, event_type AS visit_user_kind,
           CAST({K_SQL} AS DOUBLE) AS visit_detail_k, value
    FROM events
    """,
)
def flatten_props(t: Tables) -> DataFrame:
    nested = t.events.select(
        F.struct(
            F.col("event_id").alias("id"),
            F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("user"),
            F.from_json("props", "k STRING").alias("detail"),
        ).alias("visit"),
        "value",
    )
    flat = reshape.flatten(nested)
    typed = reshape.fill_numbers(reshape.cast_numbers(flat, profile.numeric_text_columns(flat)))
    return typed.toDF(*[names.column_name(c) for c in typed.columns])


def order_texts(t: Tables) -> DataFrame:
    price = m.text("o_custkey")
    return t.orders.select(
        price.alias("amount"),
        F.when(F.col("o_orderstatus") == "F", F.concat(price, F.lit("d"))).otherwise(price).alias("suffixed"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(price).alias("blank"),
        F.when(F.col("o_orderstatus") == "P", "NaN").otherwise(F.concat(F.lit(" "), price, F.lit(".5e1 "))).alias("nan"),
        F.when(F.col("o_orderstatus") == "O", None).otherwise("-inf").alias("infinite"),
        "o_orderpriority",
    )


@query(
    "numeric_profile",
    """
    WITH c AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f,
                      count(*) FILTER (o_orderstatus = 'P') AS p, count(*) FILTER (o_orderstatus <> 'O') AS no
               FROM orders),
    d AS (SELECT count(text) AS n, count(*) FILTER (regexp_full_match(trim(text), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')) AS m
          FROM documents)
    SELECT 'amount' AS column_name, n AS non_null, n AS numeric_like, true AS is_numeric FROM c
    UNION ALL SELECT 'suffixed', n, n - f, n > 0 AND f = 0 FROM c
    UNION ALL SELECT 'blank', n, n - p, p = 0 FROM c
    UNION ALL SELECT 'nan', n, n - p, p = 0 FROM c
    UNION ALL SELECT 'infinite', no, no, no > 0 FROM c
    UNION ALL SELECT 'o_orderpriority', n, 0, false FROM c
    UNION ALL SELECT 'text', n, m, n > 0 AND n = m FROM d
    """,
)
def numeric_profile(t: Tables) -> DataFrame:
    return profile.column_profile(order_texts(t)).unionByName(profile.column_profile(t.documents, ["text"]))


@query(
    "null_fill_ids",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name, COALESCE(c_acctbal, 0) AS c_acctbal,
           CAST(o_orderkey AS VARCHAR) AS ad_id, COALESCE(o_totalprice, 0) AS spend, o_orderstatus AS status,
           CASE WHEN o_orderkey IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(o_custkey AS DOUBLE) END AS amount
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    """,
)
def null_fill_ids(t: Tables) -> DataFrame:
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").cast("double").alias("account_id"), "c_name", "c_acctbal",
        F.col("o_orderkey").alias("ad_id"), F.col("o_totalprice").alias("spend"),
        F.col("o_orderstatus").alias("status"), m.text("o_custkey").alias("amount"),
    )
    return reshape.fill_numbers(reshape.cast_numbers(joined, profile.numeric_text_columns(joined)))


@query(
    "coalesce_dupes",
    """
    SELECT o_orderkey, COALESCE(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, CASE WHEN o_totalprice > 200000
           THEN o_orderstatus END, 'rest') AS label,
           COALESCE(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END, o_custkey) AS amount
    FROM orders
    """,
)
def coalesce_dupes(t: Tables) -> DataFrame:
    numbered = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("label"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).alias("amount"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_orderstatus")).alias("label.1"),
        F.lit("rest").alias("label.2"),
        F.col("o_custkey").cast("double").alias("amount"),
    )
    return reshape.coalesce_duplicates(numbered)


@query(
    "first_non_blank",
    """
    SELECT c_custkey, COALESCE(CASE WHEN c_acctbal >= 5000 THEN c_mktsegment END, c_name) AS picked FROM customer
    """,
)
def first_non_blank(t: Tables) -> DataFrame:
    blanked = t.customer.withColumn("maybe", F.when(F.col("c_acctbal") >= 5000, F.col("c_mktsegment")).otherwise("  "))
    return blanked.select("c_custkey", reshape.first_non_blank(blanked, "absent", "maybe", "c_name").alias("picked"))


@query(
    "inf_to_null",
    """
    SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'error') THEN NULL ELSE value END AS value FROM events
    """,
)
def inf_to_null(t: Tables) -> DataFrame:
    odd = (
        F.when(F.col("event_type") == "click", F.lit(float("inf")))
        .when(F.col("event_type") == "view", F.lit(float("-inf")))
        .when(F.col("event_type") == "error", F.lit(float("nan")))
        .otherwise(F.col("value"))
    )
    return reshape.null_non_finite(t.events.select("event_id", odd.alias("value")))


@query(
    "first_element",
    """
    SELECT event_id, CASE WHEN event_type <> 'view' THEN 'https://x/' || user_id END AS asset_feed_spec_image_url,
           CASE WHEN event_type <> 'view' THEN event_type END AS asset_feed_spec_image_hash
    FROM events
    """,
)
def first_element(t: Tables) -> DataFrame:
    image = F.struct(
        F.concat(F.lit("https://x/"), m.text("user_id")).alias("url"), F.col("event_type").alias("hash")
    )
    other = F.struct(F.lit("later").alias("url"), F.lit("later").alias("hash"))
    images = F.when(F.col("event_type") == "view", F.slice(F.array(image), 1, 0)).otherwise(F.array(image, other))
    picked = {"asset_feed_spec_image_url": "url", "asset_feed_spec_image_hash": "hash"}
    return reshape.first_element(t.events.select("event_id", images.alias("images")), "images", picked).drop("images")


def part_field_map(t: Tables) -> DataFrame:
    """Parts as field-map rows: feed is the type, field the name and size, status by brand."""
    status = F.when(F.col("p_brand") == "Brand#1", " Excluded").when(F.col("p_brand") == "Brand#2", "pending").when(
        F.col("p_brand") == "Brand#3", ""
    )
    sized = F.concat_ws(".", F.replace("p_name", F.lit(" "), F.lit("-")), m.text("p_size"))
    return t.part.select(
        F.lit("parts").alias("group_name"), F.col("p_type").alias("endpoint_or_pipeline"), sized.alias("api_field"),
        F.col("p_brand").alias("current_database_table"),
        F.when(F.col("p_size") > 10, F.concat_ws("_", F.lit("size"), m.text("p_size"))).alias("current_database_column"),
        F.when(F.col("p_size") > 25, F.concat_ws("_", F.lit("big"), m.text("p_size"))).alias("rename_to"),
        F.coalesce(status, F.lit("approved")).alias("status"), F.lit(None).cast("string").alias("notes"),
    )


FIELD_SQL = """
    SELECT p_type AS feed, replace(p_name, ' ', '-') || '.' || p_size AS field, p_brand AS table_name,
           CASE p_brand WHEN 'Brand#1' THEN 'excluded' WHEN 'Brand#2' THEN 'pending' ELSE 'approved' END AS status,
           CASE WHEN p_size > 10 THEN 'size_' || p_size END AS old_name,
           CASE WHEN p_size > 25 THEN 'big_' || p_size END AS new_name
    FROM part
"""


@query(
    "field_decisions",
    f"""
    SELECT feed, field,
           CASE WHEN status = 'excluded' THEN 'drop' WHEN status = 'pending' THEN 'wait'
                WHEN old_name IS NULL THEN 'ignore' ELSE 'rename' END AS decision,
           COALESCE(new_name, old_name) AS target
    FROM ({FIELD_SQL})
    """,
)
def field_decisions(t: Tables) -> DataFrame:
    return fieldmap.field_decisions(part_field_map(t))


@query(
    "pending_fields",
    f"""
    SELECT DISTINCT field AS api_field, left(lower(replace(replace(field, '.', '_'), '-', '_')), 63) AS current_database_column,
           'pending' AS status
    FROM ({FIELD_SQL}) WHERE field NOT IN (SELECT field FROM ({FIELD_SQL}) WHERE feed = 'PROMO')
    """,
)
def pending_fields(t: Tables) -> DataFrame:
    rows = part_field_map(t)
    return fieldmap.pending_rows(rows, rows, "PROMO", "parts").select("api_field", "current_database_column", "status")


def part_catalog(t: Tables) -> DataFrame:
    """Stored columns per brand: plain names of its sizes above 35, new names of its sizes from 28 to 45."""
    old = t.part.where("p_size > 35").select(
        F.col("p_brand").alias("table_name"), F.concat_ws("_", F.lit("size"), m.text("p_size")).alias("column_name")
    )
    new = t.part.where("p_size BETWEEN 28 AND 45").select(
        F.col("p_brand").alias("table_name"), F.concat_ws("_", F.lit("big"), m.text("p_size")).alias("column_name")
    )
    return old.union(new).distinct()


CATALOG_SQL = """
    SELECT p_brand AS table_name, 'size_' || p_size AS column_name FROM part WHERE p_size > 35
    UNION SELECT p_brand, 'big_' || p_size FROM part WHERE p_size BETWEEN 28 AND 45
"""


@query(
    "prune_plan",
    f"""
    WITH catalog AS ({CATALOG_SQL}), planned AS (
        SELECT DISTINCT table_name, COALESCE(new_name, old_name) AS column_name FROM ({FIELD_SQL})
        WHERE status = 'excluded' AND old_name IS NOT NULL)
    SELECT table_name, column_name,
           EXISTS (SELECT 1 FROM catalog c WHERE c.table_name = p.table_name AND c.column_name = p.column_name) AS found
    FROM planned p WHERE table_name IN (SELECT table_name FROM catalog)
    """,
)
def prune_plan(t: Tables) -> DataFrame:
    return fieldmap.prune_plan(part_field_map(t), part_catalog(t))


@query(
    "rename_plan",
    f"""
    WITH catalog AS ({CATALOG_SQL}), planned AS (
        SELECT DISTINCT table_name, old_name, new_name FROM ({FIELD_SQL})
        WHERE status = 'approved' AND old_name IS NOT NULL AND new_name IS NOT NULL)
    SELECT p.*, CASE WHEN EXISTS (SELECT 1 FROM catalog c WHERE c.table_name = p.table_name AND c.column_name = old_name)
                     THEN 'rename'
                     WHEN EXISTS (SELECT 1 FROM catalog c WHERE c.table_name = p.table_name AND c.column_name = new_name)
                     THEN 'already' ELSE 'missing' END AS outcome
    FROM planned p WHERE table_name IN (SELECT table_name FROM catalog)
    """,
)
def rename_plan(t: Tables) -> DataFrame:
    return fieldmap.rename_plan(part_field_map(t), part_catalog(t))


@query("field_map", "SELECT p_partkey, p_name AS title, p_type FROM part")
def field_map(t: Tables) -> DataFrame:
    chosen = fieldmap.FieldMap(
        renames={"p_name": "title"}, excluded=frozenset({"p_brand"}), pending=frozenset({"p_size"}),
        known=frozenset({"p_partkey", "p_name", "p_brand", "p_size", "p_type"}),
    )
    return fieldmap.apply_field_map(t.part, chosen)


@query(
    "declared_cast",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS whole,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
           CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag, o_custkey <> 0 AS truthy,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(epoch(o_orderdate) AS BIGINT)
                + CASE WHEN o_orderstatus = 'P' THEN 8 * 3600 ELSE 0 END END AS moment,
           '{"a":' || o_custkey || ',"b":null}' AS doc
    FROM orders
    """,
)
def declared_cast(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    texts = t.orders.select(
        "o_orderkey", day.alias("day"),
        F.when(status == "F", "1.5").otherwise(m.text("o_custkey")).alias("whole"),
        F.when(status == "P", "n/a").otherwise(m.text("o_totalprice")).alias("amount"),
        F.when(status == "F", " Yes").when(status == "O", "f").otherwise("maybe").alias("flag"),
        F.col("o_custkey").alias("truthy"),
        F.when(status == "F", "soon").when(status == "P", F.concat(day, F.lit("T00:00:00-0800"))).otherwise(day).alias("moment"),
        F.struct(F.lit(None).cast("string").alias("b"), F.col("o_custkey").alias("a")).alias("doc"),
    )
    declared = T.StructType.fromDDL(
        "day DATE, whole BIGINT, amount DECIMAL(38,9), flag BOOLEAN, truthy BOOLEAN, moment TIMESTAMP, doc STRING"
    )
    cast = coerce.declared_cast(texts, declared)
    return m.doubles(cast.withColumn("moment", F.unix_seconds("moment")))


@query(
    "type_repair",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS creative_id, CAST(o_orderdate AS DATE) AS date_start,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS DOUBLE) END AS budget, o_orderpriority AS label
    FROM orders
    """,
)
def type_repair(t: Tables) -> DataFrame:
    """Stored columns widened: whole-number ids to text, text dates to DATE, numbers in text to DOUBLE."""
    stored = t.orders.select(
        F.col("o_custkey").alias("creative_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_start"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(m.text("o_orderkey")).alias("budget"),
        F.col("o_orderpriority").alias("label"),
    )
    batch = t.lineitem.select(m.text("l_quantity").alias("budget"), m.text("l_tax").alias("label"))
    to_number = evolve.promotable(
        profile.numeric_text_columns(stored, blank_is_missing=True),
        profile.numeric_text_columns(batch, blank_is_missing=True),
    )
    return evolve.repair_types(stored, "fact_meta_delivery_ad", to_number)


@query(
    "breakdown_key",
    """
    WITH s AS (SELECT p_partkey, list_sort(list_filter(list_transform(string_split(p_type || ', ' || p_brand || ' ,,' || p_name, ','),
                      lambda x: trim(x)), lambda x: x <> '')) AS parts,
                      list_sort(list_filter(list_transform(string_split(lower(p_type || ', ' || p_brand || ' ,,' || p_name), ','),
                      lambda x: trim(x)), lambda x: x <> '')) AS low FROM part)
    SELECT p_partkey, array_to_string(parts, ',') AS raw_key, array_to_string(low, ',') AS checkpoint_key,
           'fact_meta_delivery_ad__' || array_to_string(parts, '_') AS table_name
    FROM s
    """,
)
def breakdown_key(t: Tables) -> DataFrame:
    asked = F.concat("p_type", F.lit(", "), "p_brand", F.lit(" ,,"), "p_name")
    return t.part.select(
        "p_partkey", names.breakdown_key_of(asked).alias("raw_key"),
        names.breakdown_key_of(asked, for_checkpoint=True).alias("checkpoint_key"),
        names.fact_table_name_of(F.lit("ad"), asked).alias("table_name"),
    )


@query(
    "name_normalise",
    """
    SELECT doc_id, right(trim(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '_'), 63) AS stored,
           left(source || '/' || text, 63) AS head, right(source || '/' || text, 63) AS tail,
           '_' || right(trim(regexp_replace(lower(doc_id || '/' || lang || source), '[^a-z0-9]+', '_', 'g'), '_'), 300) AS mirrored
    FROM documents
    """,
)
def name_normalise(t: Tables) -> DataFrame:
    labelled = F.concat("source", F.lit("/"), "text")
    return t.documents.select(
        "doc_id", names.column_name_of(F.col("text")).alias("stored"),
        F.left(labelled, F.lit(63)).alias("head"), F.right(labelled, F.lit(63)).alias("tail"),
        names.mirror_column_name_of(F.concat(m.text("doc_id"), F.lit("/"), "lang", "source")).alias("mirrored"),
    )


@query(
    "prefix_roundtrip",
    """
    SELECT c_custkey, 'act_' || c_custkey AS prefixed, CAST(c_custkey AS VARCHAR) AS stripped, spelling
    FROM customer, unnest(['act_' || c_custkey, CAST(c_custkey AS VARCHAR)]) AS u(spelling)
    """,
)
def prefix_roundtrip(t: Tables) -> DataFrame:
    mixed = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("act_"), m.text("c_custkey"))).otherwise(m.text("c_custkey"))
    ids = t.customer.select("c_custkey", mixed.alias("id"))
    return ids.select(
        "c_custkey", accounts.with_prefix(F.col("id")).alias("prefixed"),
        accounts.without_prefix(F.col("id")).alias("stripped"), F.explode(accounts.both_spellings(F.col("id"))).alias("spelling"),
    )


@query(
    "preview_url",
    """
    SELECT page_id, url AS preview_url, length(regexp_replace(
               replace(replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'),
               '&gt;', '>'), '&amp;?', '&', 'g')) AS decoded
    FROM pages
    """,
)
def preview_url(t: Tables) -> DataFrame:
    """The link of an entity-encoded frame per page, and the length of the whole decoded page."""
    encoded = F.replace("url", F.lit("&"), F.lit("&amp;"))
    body = F.concat(F.lit("&lt;iframe src=&quot;"), encoded, F.lit("&quot; width=&#34;5&#34;&gt;&lt;/iframe&gt;"))
    return t.pages.select(
        "page_id", text.preview_url(body).alias("preview_url"),
        F.length(text.unescape_html(F.col("html"))).cast("bigint").alias("decoded"),
    )


def insight_records(t: Tables) -> DataFrame:
    """Events as delivery records: nested results, metric lists, text numbers and a bad value."""
    kind = F.col("event_type")
    return t.events.select(
        F.col("event_id").cast("double").alias("ad_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_start"),
        kind.alias("objective"),
        F.when(kind == "click", None).otherwise(m.text("user_id")).alias("clicks"),
        F.when(kind == "view", F.lit("inf")).otherwise(m.text("user_id")).alias("reach"),
        F.struct(F.struct(kind.alias("kind")).alias("inner")).alias("extra"),
        F.array(item(F.concat(F.lit("a:"), kind), F.lit(None), prop_k())).alias("actions"),
        F.array(F.struct(kind.alias("indicator"), m.text("user_id").alias("value"))).alias("results"),
        m.text("user_id").alias("age.1"), F.when(kind == "error", kind).alias("age"),
    )


NORMALISED_SQL = (
    "SELECT CAST(event_id AS VARCHAR) AS ad_id, strftime(ts, '%Y-%m-%d') AS date_start, event_type AS objective,"
    " CASE WHEN event_type = 'click' THEN CAST(0 AS DOUBLE) ELSE CAST(user_id AS DOUBLE) END AS clicks,"
    " CASE WHEN event_type = 'view' THEN CAST(0 AS DOUBLE) ELSE CAST(user_id AS DOUBLE) END AS reach,"
    " event_type AS extra_inner_kind, event_type AS results_indicator, CAST(user_id AS DOUBLE) AS results_value,"
    " CASE WHEN event_type = 'error' THEN 'error' ELSE CAST(CAST(user_id AS DOUBLE) AS VARCHAR) END AS age, CAST(NULL AS VARCHAR) AS date_stop,"
    " CAST(NULL AS VARCHAR) AS country, "
    + ", ".join(
        f"CASE WHEN event_type = '{e}' THEN CAST({K_SQL} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS actions_a_{e}"
        for e in EVENT_KINDS
    )
    + " FROM events"
)


@query("fact_normalise", NORMALISED_SQL)
def fact_normalise(t: Tables) -> DataFrame:
    """Records to a wide fact: every step of the delivery load before it is written."""
    facts = normalise_facts(insight_records(t), "ad", ["age", "country"])
    return facts.toDF(*[names.column_name(c) for c in facts.columns])


@query(
    "dim_refresh",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS campaign_id, c_name AS campaign_name, CAST(c_nationkey AS VARCHAR) AS account_id,
           CAST(c_acctbal AS DOUBLE) AS daily_budget, 'ACTIVE' AS effective_status,
           CASE WHEN c_acctbal > 0 THEN 1704153600 + 28800 END AS created_time
    FROM customer WHERE c_mktsegment <> 'MACHINERY'
    """,
)
def dim_refresh(t: Tables) -> DataFrame:
    """Customers as campaign records; machinery is paused and filtered by status."""
    status = F.when(F.col("c_mktsegment") == "MACHINERY", "PAUSED").otherwise("ACTIVE")
    records = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("account_id"),
        m.text("c_acctbal").alias("daily_budget"), status.alias("effective_status"),
        F.when(F.col("c_acctbal") > 0, "2024-01-02T00:00:00-0800").otherwise("unknown").alias("created_time"),
    )
    rows = normalise_dimension(records, "campaigns", statuses=["ACTIVE"])
    return rows.withColumn("created_time", F.unix_seconds("created_time"))
