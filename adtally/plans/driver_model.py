"""The driver tables seen as advertising delivery: one mapping for every registered query.

Line items stand for daily delivery of an ad (order) in a campaign (part), an
ad set (supplier) and an account (line number); customers are the creatives of
their orders and nations the accounts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adtally.session import scratch_path


class Tables:
    """The parquet tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def text(name: str) -> F.Column:
    return F.col(name).cast("string")


def delivery(t: Tables) -> DataFrame:
    return t.lineitem.select(
        text("l_orderkey").alias("ad_id"),
        F.to_date("l_shipdate").alias("date_start"),
        F.to_date("l_shipdate").alias("date_stop"),
        text("l_linenumber").alias("account_id"),
        text("l_partkey").alias("campaign_id"),
        text("l_suppkey").alias("adset_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("spend"),
        F.col("l_quantity").cast("bigint").alias("impressions"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("clicks"),
        F.col("l_returnflag").alias("objective"),
        F.col("l_linestatus").alias("optimization_goal"),
        F.col("l_quantity").alias("actions_purchase"),
        F.col("l_extendedprice").alias("action_values_purchase"),
    )


DELIVERY_SQL = """
    SELECT CAST(l_orderkey AS VARCHAR) AS ad_id, CAST(l_shipdate AS DATE) AS date_start,
           CAST(l_shipdate AS DATE) AS date_stop, CAST(l_linenumber AS VARCHAR) AS account_id,
           CAST(l_partkey AS VARCHAR) AS campaign_id, CAST(l_suppkey AS VARCHAR) AS adset_id,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS spend, CAST(l_quantity AS BIGINT) AS impressions,
           CAST(round(l_discount * 100) AS BIGINT) AS clicks, l_returnflag AS objective,
           l_linestatus AS optimization_goal, l_quantity AS actions_purchase,
           l_extendedprice AS action_values_purchase
    FROM lineitem
"""


def accounts(t: Tables) -> DataFrame:
    return t.nation.select(
        F.concat(F.lit("act_"), text("n_nationkey")).alias("id"),
        F.col("n_name").alias("currency"),
        F.col("n_regionkey").cast("bigint").alias("account_status"),
    )


def ads(t: Tables) -> DataFrame:
    return t.orders.select(
        text("o_orderkey").alias("ad_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("effective_status"),
        F.when(F.col("o_orderstatus") != "P", text("o_custkey")).alias("creative_id"),
        F.to_date("o_orderdate").alias("created_time"),
    )


def creatives(t: Tables) -> DataFrame:
    key = text("c_custkey")
    return t.customer.select(
        key.alias("creative_id"),
        F.col("c_name").alias("creative_name"),
        F.col("c_mktsegment").alias("title"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("https://i.example/"), key)).alias("image_url"),
        F.when(F.col("c_acctbal") < 5000, F.concat(F.lit("https://f.example/"), key)).alias("asset_feed_spec_image_url"),
        text("c_nationkey").alias("object_story_spec_link_data_image_hash"),
    )


def campaigns(t: Tables) -> DataFrame:
    return t.part.select(
        text("p_partkey").alias("campaign_id"),
        F.col("p_brand").alias("status"),
        F.col("p_type").alias("buying_type"),
        F.col("p_size").cast("bigint").alias("daily_budget"),
    )


def adsets(t: Tables) -> DataFrame:
    return t.supplier.select(
        text("s_suppkey").alias("adset_id"),
        F.col("s_name").alias("status"),
        text("s_nationkey").alias("billing_event"),
    )


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, for comparison across engines."""
    decimals = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(decimals) if decimals else df


def new_database(spark: SparkSession, label: str) -> str:
    """An empty database of its own, stored in the scratch folder."""
    name = f"adtally_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name
