"""One row per key, upserts and their checks."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from adtally import fixed_values as fv
from adtally.operators import keyed


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_keep_last_and_first_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k STRING, o INT")
    assert rows(keyed.keep_last(df, ["k"], ["o"]), "o") == [("a", 2), (None, 4)]
    assert rows(keyed.keep_first(df, ["k"], ["o"]), "o") == [("a", 1), (None, 3)]


def test_hot_key_is_cut_to_one_row_per_task_before_the_shuffle(spark):
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    df = spark.range(1000).select(key.alias("k"), F.col("id").alias("o"))
    plan = keyed.keep_last(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    # Printed top down: the final limit, the shuffle, and below it the limit inside every task.
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_upsert_changes_only_batch_columns(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k INT, name STRING, v DOUBLE")
    batch = spark.createDataFrame([("2", 9.0, 1), ("2", None, 2), ("3", 5.0, 1)], "k STRING, v DOUBLE, o INT")
    got = keyed.upsert(target, batch, ["k"], ["o"]).drop("o")
    assert rows(got, "k") == [(1, "a", 1.0), (2, "b", None), (3, None, 5.0)]
    nulled = keyed.upsert(target, batch, ["k"], ["o"], absent="null").drop("o")
    assert rows(nulled, "k") == [(1, "a", 1.0), (2, None, None), (3, None, 5.0)]


def test_upsert_adds_or_drops_new_columns(spark):
    target = spark.createDataFrame([(1, "a")], "k INT, name STRING")
    batch = spark.createDataFrame([(1, "n")], "k INT, fresh STRING")
    assert rows(keyed.upsert(target, batch, ["k"]), "k") == [(1, "a", "n")]
    assert keyed.upsert(target, batch, ["k"], new_columns="drop").columns == ["k", "name"]


def test_missing_and_null_keys_fail(spark):
    target = spark.createDataFrame([("1", "2024-01-01")], "ad_id STRING, date_start STRING")
    keys = ["ad_id", "date_start"]
    with pytest.raises(ValueError, match="ad_id"):
        keyed.upsert(target, target.drop("ad_id"), keys)
    with pytest.raises(Exception, match="ad_id contains NULL"):
        keyed.upsert(target, spark.createDataFrame([(None, "x")], target.schema), keys).collect()


def test_mirror_merge_nulls_absent_declared_columns_and_casts(spark):
    target = spark.createDataFrame([("1", "old", date(2024, 1, 1), 4)], "ad_id STRING, ad_name STRING, date_start DATE, reach BIGINT")
    batch = spark.createDataFrame([(1, "2024-01-01", "7", "e")], "`Ad.ID` INT, date_start STRING, reach STRING, extra STRING")
    merged = keyed.mirror_merge(target, batch, fv.AD_FACT, ["ad_id", "date_start"], ["ad_id"])
    row = merged.first()
    assert (row.ad_id, row.ad_name, row.date_start, row.reach, row.extra) == ("1", None, date(2024, 1, 1), 7, "e")
    assert set(merged.columns) > {"spend", "actions"}


def test_undeclared_columns_can_be_left_out(spark):
    batch = spark.createDataFrame([("1", "e")], "ad_id STRING, extra STRING")
    assert "extra" in keyed.prepare_for_mirror(batch, fv.ADS).columns
    assert "extra" not in keyed.prepare_for_mirror(batch, fv.ADS, "drop").columns


def test_upsert_join_is_one_shuffle_per_side(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        target = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
        batch = spark.range(300).select((F.col("id") % 100).alias("k"), F.col("id").alias("o"), F.col("id").alias("v"))
        plan = keyed.upsert(target, batch, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2


ROWS = st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 9))), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, ROWS)
def test_upsert_is_idempotent_and_leaves_unique_keys(spark, first, second):
    target = keyed.keep_last(
        spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(first)], "k INT, o INT, v INT"), ["k"], ["o"]
    ).drop("o")
    batch = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(second)], "k INT, o INT, v INT")
    once = keyed.upsert(target, batch, ["k"], ["o"], new_columns="drop")
    twice = keyed.upsert(once, batch, ["k"], ["o"], new_columns="drop")
    expected = dict(first) | dict(second)
    assert dict(rows(once, "k")) == expected
    assert rows(twice, "k") == rows(once, "k")


def test_creatives_come_from_ads(spark):
    ads = spark.createDataFrame(
        [("1", "c1", " ", "flat", 1), ("2", "c1", "nested", "flat", 2), ("3", None, None, "own", 3), ("4", None, None, None, 4)],
        "ad_id STRING, `creative.id` STRING, `creative.name` STRING, creative_name STRING, o INT",
    ).withColumn("account_id", F.lit("act_1")).withColumn("creative_id", F.when(F.col("ad_id") == "3", "c3"))
    got = rows(keyed.creatives_of_ads(ads, ["o"]), "creative_id")
    assert got == [("c1", "act_1", "nested"), ("c3", "act_1", "own")]


def test_fill_missing_with_a_limit(spark):
    stored = spark.createDataFrame([("a", None), ("b", None), ("c", "kept"), ("d", None)], "k STRING, url STRING")
    lookup = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3"), ("d", "4")], "k STRING, url STRING")
    assert rows(keyed.fill_missing(stored, lookup, "k", "url"), "k") == [("a", "1"), ("b", None), ("c", "kept"), ("d", "4")]
    assert rows(keyed.fill_missing(stored, lookup, "k", "url", limit=2), "k") == [("a", "1"), ("b", None), ("c", "kept"), ("d", None)]


def test_a_big_merge_is_divided_by_rows(spark, monkeypatch):
    target = spark.createDataFrame([(1, "a", 1.0, "x"), (2, "b", 2.0, None), (4, "d", 4.0, None)], "k INT, name STRING, v DOUBLE, w STRING")
    batch = spark.createDataFrame([(1, 1.0), (2, 9.0), (3, 5.0), (4, 4.0)], "k INT, v DOUBLE")
    plan = lambda rows: keyed.upsert(target, batch, ["k"], rows=rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan(1000) and plan(10**9).count("RepartitionByExpression") == 2
    padded = batch.withColumn("w", F.lit(None).cast("string"))
    want = rows(keyed.upsert(target, padded, ["k"], changed="c"), "k")
    assert [r[-1] for r in want] == [True, True, True, False]
    assert rows(keyed.upsert(target, batch, ["k"], changed="c", rows=10**9, nulls=["w"]), "k") == want
    assert rows(keyed.upsert(target, padded, ["k"], changed="c", nulls=["w"]), "k") == want
