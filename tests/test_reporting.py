"""Star joins, goals, roll-ups, registry, windows, erasure and the field map."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from adtally import fixed_values as fv
from adtally.operators import catalog, erase, evolve, fieldmap, goals, registry, runs, star, windows


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def small_star(spark):
    fact = spark.sql(
        "SELECT * FROM VALUES ('a1', DATE'2024-01-01', '1', 'c1', 's1', 5.0D, 7.0D), ('a2', DATE'2024-01-02', '2', 'c9', NULL, 1.0D, NULL),"
        " ('a9', DATE'2024-01-02', NULL, NULL, 's1', 2.0D, 3.0D)"
        " AS t(ad_id, date_start, account_id, campaign_id, adset_id, spend, actions_purchase)"
    )
    accounts = spark.sql("SELECT 'act_1' AS id, 'EUR' AS currency, TIMESTAMP'2024-01-01' AS created_time, 'x' AS unused")
    ads = spark.sql("SELECT * FROM VALUES ('a1', 'k1', 'ON'), ('a2', NULL, 'OFF') AS t(ad_id, creative_id, status)")
    creatives = spark.sql("SELECT 'k1' AS creative_id, 'nice' AS creative_name, CAST(NULL AS STRING) AS image_url, 'feed' AS asset_feed_spec_image_url")
    campaigns = spark.sql("SELECT 'c1' AS campaign_id, 'RUN' AS status")
    return fact, accounts, ads, creatives, campaigns


def test_star_view_keeps_every_fact_row(spark):
    fact, accounts, ads, creatives, campaigns = small_star(spark)
    view = star.star_view(fact, accounts, ads, creatives, campaigns)
    assert view.columns == [
        "date_start", "spend", "account_id", "campaign_id", "adset_id", "ad_id", "currency", "account_created_time",
        "ad_status", "creative_id", "creative_name", "campaign_status", "image_url", "thumbnail_url", "actions_purchase",
    ]
    got = {r.ad_id: r for r in view.collect()}
    assert (got["a1"].currency, got["a1"].ad_status, got["a1"].creative_name, got["a1"].campaign_status) == ("EUR", "ON", "nice", "RUN")
    assert (got["a1"].image_url, got["a1"].thumbnail_url) == ("feed", "feed")
    assert (got["a2"].ad_status, got["a2"].creative_name, got["a2"].campaign_status) == ("OFF", None, None)
    assert got["a9"].ad_status is None and got["a9"].spend == 2.0


def test_star_view_rejects_clashing_names(spark):
    fact, accounts, ads, creatives, _ = small_star(spark)
    with pytest.raises(ValueError, match="currency"):
        star.star_view(fact.withColumn("currency", F.lit("x")), accounts, ads, creatives)


def test_level_report_uses_the_joins_of_its_level(spark):
    fact, accounts, ads, _, campaigns = small_star(spark)
    report = star.level_report(fact, "campaign", {"accounts": accounts, "campaigns": campaigns, "ads": ads},
                               {"accounts": ["currency"], "campaigns": ["status"], "ads": ["status"]})
    assert set(report.columns) == {*fact.columns, "accounts_currency", "campaigns_status"}
    assert report.count() == 3


def test_calendar(spark):
    fact = spark.sql("SELECT * FROM VALUES (DATE'2024-02-28'), (DATE'2024-03-01'), (NULL) AS t(date_start)")
    calendar = star.calendar_dim(fact)
    assert rows(calendar, "date") == [
        (date(2024, 2, 28), 2024, 2, "Feb 2024"), (date(2024, 2, 29), 2024, 2, "Feb 2024"), (date(2024, 3, 1), 2024, 3, "Mar 2024")]
    assert star.calendar_dim(fact.limit(0)).count() == 0
    assert star.with_calendar(fact, calendar).count() == 3


def test_rollup_leaves_out_what_does_not_add_up(spark):
    fact = spark.sql(
        "SELECT * FROM VALUES ('c', DATE'2024-01-01', 'x', 1.5D, 10, 2, 9), ('c', DATE'2024-01-01', 'y', 2.5D, 30, 2, 9),"
        " ('d', DATE'2024-01-01', 'x', 1.0D, 0, 0, 1) AS t(campaign_id, date_start, age, spend, impressions, clicks, reach)"
    )
    got = star.delivery_rollup(fact, "campaign")
    assert got.columns == ["campaign_id", "date_start", "spend", "impressions", "clicks", "ctr", "cpm"]
    assert rows(got, "campaign_id") == [("c", date(2024, 1, 1), 4.0, 40, 4, 10.0, 100.0), ("d", date(2024, 1, 1), 1.0, 0, 0, None, None)]
    assert star.delivery_rollup(fact, "campaign", ("age",)).count() == 3


def test_goals_are_cleaned_before_the_prefix(spark):
    text = spark.createDataFrame(
        [(" 1 ", "2024-05-17", "10", "n/a"), ("act_2", "2024-06-01", None, "4"), (None, "2024-05-01", "1", "1"), (" ", "2024-05-01", "1", "1")],
        "` Account_ID` STRING, MONTH STRING, goal_spend STRING, goal_roas STRING",
    )
    got = goals.read_goals(text)
    assert got.columns == ["account_id", "month", *fv.GOAL_AMOUNTS, "note"]
    assert [r[:5] for r in rows(got, "account_id")] == [
        ("act_1", date(2024, 5, 1), 10.0, None, None), ("act_2", date(2024, 6, 1), None, None, 4.0)]
    with pytest.raises(ValueError, match="month"):
        goals.read_goals(spark.sql("SELECT '1' AS account_id"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        goals.read_goals(spark.sql("SELECT '1' AS account_id, 'May' AS month")).collect()


def test_goals_meet_delivery_in_spite_of_the_prefix(spark):
    delivery = spark.sql(
        "SELECT * FROM VALUES ('1', DATE'2024-05-03', 5.0D, 20.0D), ('1', DATE'2024-06-03', 0.0D, 1.0D) AS t(account_id, date_start, spend, action_values_purchase)"
    )
    target = spark.sql("SELECT 'act_1' AS account_id, '2024-05-09' AS month, '10' AS goal_spend, '0' AS goal_purchase_value")
    got = {r.date_start.month: r for r in goals.goals_vs_actual(delivery, goals.read_goals(target)).collect()}
    assert (got[5].roas, got[5].pct_spend_goal, got[5].pct_purchase_value_goal, got[5].purchases) == (4.0, 0.5, None, None)
    assert (got[6].roas, got[6].goal_spend) == (None, None)


def test_registry_of_fresh_accounts(spark):
    landed = spark.createDataFrame([("act_1", "old", "1", 1), ("act_1", "new", "2", 2), ("act_2", "b", "x", 3)], "id STRING, name STRING, account_status STRING, _i INT")
    got = registry.registry_from_accounts(landed, ["_i"])
    assert got.columns == fv.REGISTRY_COLUMNS
    assert rows(got, "account_id") == [("act_1", "new", 2, None, True, None), ("act_2", "b", None, None, True, None)]


def test_registry_merge_keeps_what_users_set(spark):
    schema = "account_id STRING, account_name STRING, account_status INT, profile_name STRING, include_in_etl BOOLEAN, notes STRING"
    fresh = spark.createDataFrame([("act_1", "new", 2, None, True, None), ("act_2", "b", 1, None, True, None)], schema)
    existing = spark.createDataFrame([("act_1", "old", 1, "p", False, "n"), ("gone", "g", 1, "p", True, None)], schema)
    got = registry.merge_registry(fresh, existing)
    assert rows(got, "account_id") == [("act_1", "new", 2, "p", False, "n"), ("act_2", "b", 1, None, True, None)]


def test_registry_order(spark):
    listed = spark.createDataFrame(
        [("1", "b", None, True), ("2", "a", "p", False), ("3", "z", "p", True), ("4", "a", None, None), ("5", "a", None, True)],
        "account_id STRING, account_name STRING, profile_name STRING, include_in_etl BOOLEAN")
    assert [r[0] for r in rows(registry.sort_registry(listed))] == ["3", "2", "5", "1", "4"]


def test_included_accounts(spark):
    listed = spark.createDataFrame(
        [("1", " Agency ", "YES", 1), ("act_1", "agency", None, 2), ("2", "agency", "no", 3), (None, "agency", "1", 4), ("3", None, "y", 5)],
        "account_id STRING, profile_name STRING, include_in_etl STRING, _i INT")
    assert rows(registry.included_accounts(listed, ["_i"]).select("account_id", "profile_name"), "account_id") == [("act_1", "agency"), ("act_3", None)]
    mine = registry.included_accounts(listed, ["_i"], "AGENCY")
    assert rows(registry.account_ids(mine, ["9"])) == [("act_1",)]
    assert rows(registry.account_ids(registry.included_accounts(listed, ["_i"], "none"), ["9", "act_8"]), "account_id") == [("act_8",), ("act_9",)]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dates(date(2020, 1, 1), date(2026, 1, 1)), st.integers(0, 200), st.integers(1, 40))
def test_windows_cover_the_range_once(spark, first, span, days):
    last = date.fromordinal(first.toordinal() + span)
    bounds = spark.createDataFrame([(first, last)], "first DATE, last DATE")
    got = rows(windows.date_windows(bounds, days), "since")
    covered = [d for since, until in got for d in range(since.toordinal(), until.toordinal() + 1)]
    assert covered == list(range(first.toordinal(), last.toordinal() + 1))
    assert all((until - since).days + 1 == days for since, until in got[:-1])


def test_resume_and_reopen(spark):
    bounds = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 20))], "first DATE, last DATE")
    planned = windows.date_windows(bounds, 7)
    checkpoint = spark.createDataFrame([], fv.DECLARED[fv.CHECKPOINT])
    done = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 7), 5)], "since DATE, until DATE, rows_loaded INT")
    checkpoint = windows.mark_completed(checkpoint, done, "ad", "Agency", ["Age"])
    assert rows(checkpoint.drop("completed_at")) == [("agency", "ad", "age", date(2024, 1, 1), date(2024, 1, 7), 5)]
    completed = windows.completed_windows(checkpoint, "ad", "AGENCY", [" age"])
    assert [r[0].day for r in rows(windows.remaining_windows(planned, completed), "since")] == [8, 15]
    assert windows.remaining_windows(planned, completed, force=True).count() == 3
    assert windows.completed_windows(checkpoint, "ad").count() == 0
    assert windows.reopen_windows(checkpoint, done.select("since", "until")).count() == 0
    assert windows.reopen_windows(checkpoint, done.select("since", "until").withColumn("level", F.lit("adset"))).count() == 1
    again = windows.mark_completed(checkpoint, done.withColumn("rows_loaded", F.lit(6)), "ad", "agency", ["age"])
    assert [r.rows_loaded for r in again.collect()] == [6]
    with pytest.raises(ValueError):
        windows.date_windows(bounds, 0)


def test_rows_and_days_of_windows(spark):
    facts = spark.sql("SELECT * FROM VALUES (DATE'2024-01-02'), (DATE'2024-01-02'), (DATE'2024-01-09') AS t(date_start)")
    two = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 3)), (date(2024, 1, 4), date(2024, 1, 5))], "since DATE, until DATE")
    assert [r[2] for r in rows(windows.rows_per_window(facts, two), "since")] == [2, 0]
    assert windows.in_windows(facts, two).count() == 2


def test_presets_and_rolling_ranges():
    today = date(2024, 5, 15)
    assert windows.preset_range("today", today) == (today, today)
    assert windows.preset_range("yesterday", today) == (date(2024, 5, 14), date(2024, 5, 14))
    assert windows.preset_range("last_7d", today) == (date(2024, 5, 8), date(2024, 5, 14))
    assert windows.preset_range("last_quarter", today) == (date(2024, 1, 1), date(2024, 3, 31))
    assert windows.preset_range("last_quarter", date(2024, 2, 1)) == (date(2023, 10, 1), date(2023, 12, 31))
    assert windows.preset_range("last_year", today) == (date(2023, 1, 1), date(2023, 12, 31))
    assert windows.rolling_range(today, 7) == (date(2024, 5, 8), date(2024, 5, 14))
    assert windows.rolling_range(today, 7, include_today=True) == (date(2024, 5, 8), today)
    with pytest.raises(ValueError):
        windows.preset_range("tomorrow", today)


def erase_tables(spark):
    return {
        fv.ACCOUNTS: spark.sql("SELECT * FROM VALUES ('act_1'), ('act_2') AS t(id)"),
        fv.ADS: spark.sql("SELECT * FROM VALUES ('a1', '1'), ('a2', 'act_2'), ('a3', NULL) AS t(ad_id, account_id)"),
        fv.AD_FACT: spark.sql("SELECT * FROM VALUES ('a1'), ('a1'), ('a2'), ('a3'), ('a9'), (NULL) AS t(ad_id)"),
        "loose": spark.sql("SELECT 1 AS v"),
    }


def test_erasure_finds_direct_and_linked_rows(spark):
    listed = spark.createDataFrame([("act_1", "n", " true"), ("2", "m", "no"), (" ", "b", "1")], "account_id STRING, account_name STRING, delete STRING")
    targets = erase.delete_targets(listed)
    assert rows(targets) == [("act_1", "n")]
    tables = erase_tables(spark)
    report = dict(rows(erase.erase_report(tables, targets)))
    assert report == {fv.ACCOUNTS: 1, fv.ADS: 1, fv.AD_FACT: 2, "(total)": 4}
    assert erase.surviving_rows("loose", tables["loose"], targets, tables) is None
    kept = erase.surviving_rows(fv.AD_FACT, tables[fv.AD_FACT], targets, tables)
    assert sorted(r[0] or "" for r in kept.collect()) == ["", "a2", "a3", "a9"]
    assert erase.surviving_rows(fv.ADS, tables[fv.ADS], targets, tables).count() == 2
    assert rows(erase.all_spellings(targets), "account_id") == [("1",), ("act_1",)]


FIELD_ROWS = [
    ("g", "feed", "a", "t", "col_a", "new_a", "approved", ""),
    ("g", "feed", "b", "t", "b", "", "", None),
    ("g", "feed", "c", "t", "c", "", " Excluded ", ""),
    ("g", "feed", "d", "t", "d", "", "pending", ""),
    ("g", "feed", "e", "t", "", "", "approved", ""),
    ("g", "other", "z", "t", "z", "not a name!", "approved", ""),
    ("g", "feed", "f.g", "t", "f_g", "", "unheard", ""),
    ("g", None, "q", "t", "q", "", "approved", ""),
]


def field_rows(spark):
    return spark.createDataFrame(FIELD_ROWS, ", ".join(f"{c} STRING" for c in fv.FIELD_MAP_COLUMNS))


def test_field_map_drops_waits_and_renames(spark):
    chosen = fieldmap.field_map_for(field_rows(spark), "feed")
    assert chosen == fieldmap.FieldMap({"a": "new_a", "f.g": "f_g"}, frozenset("c"), frozenset("d"), frozenset({"a", "b", "c", "d", "e", "f.g"}))
    df = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c, 4 AS d, 5 AS e, 6 AS `f.g`, 7 AS brand_new, 8 AS _ingest")
    assert fieldmap.apply_field_map(df, chosen).columns == ["new_a", "b", "e", "f_g", "_ingest"]
    assert fieldmap.apply_field_map(df, chosen, "keep").columns == ["new_a", "b", "e", "f_g", "brand_new", "_ingest"]
    assert fieldmap.apply_field_map(df, None).columns == df.columns


def test_unknown_fields_are_registered_once(spark):
    listed = field_rows(spark)
    df = spark.createDataFrame([(1, 2, 3)], "`X.y-Z` INT, a INT, _ingest INT")
    fresh = fieldmap.register_unknown(df, listed, "feed", "t")
    assert rows(fresh) == [("pending_feed", "feed", "X.y-Z", "t", "x_y_z", "", "pending", fieldmap.PENDING_NOTE)]
    assert fieldmap.register_unknown(df, listed.unionByName(fresh), "feed", "t").count() == 0


def test_prune_and_rename_plans(spark):
    stored = spark.createDataFrame([("t", "c"), ("t", "new_a"), ("u", "x")], "table_name STRING, column_name STRING")
    assert rows(fieldmap.prune_plan(field_rows(spark), stored)) == [("t", "c", True)]
    assert rows(fieldmap.columns_by_table(fieldmap.prune_plan(field_rows(spark), stored))) == [("t", ["c"])]
    assert rows(fieldmap.rename_plan(field_rows(spark), stored)) == [("t", "col_a", "new_a", "already")]
    before = spark.createDataFrame([("t", "col_a")], stored.schema)
    assert rows(fieldmap.rename_plan(field_rows(spark), before)) == [("t", "col_a", "new_a", "rename")]
    neither = spark.createDataFrame([("t", "k")], stored.schema)
    assert rows(fieldmap.rename_plan(field_rows(spark), neither)) == [("t", "col_a", "new_a", "missing")]


def test_schema_growth_and_drift(spark):
    batch = spark.createDataFrame([], "`New.Id` BIGINT, v DOUBLE, nested ARRAY<INT>, ad_id STRING")
    added = {f.name: f.dataType.simpleString() for f in evolve.columns_to_add(batch, ["ad_id"])}
    assert added == {"new_id": "string", "v": "double"}
    long = "x" * 70
    assert evolve.stored_name(long, ["x" * 63]) == "x" * 63
    declared = evolve.declared_schema(fv.ADSETS)
    assert {f.name for f in evolve.columns_to_add(batch, ["ad_id", "adset_id"], fv.ADSETS)} == {"account_id", "campaign_id", "adset_name", "new_id", "v"}
    found = spark.createDataFrame([], "adset_id BIGINT, account_id STRING").schema
    assert rows(evolve.schema_drift(spark, declared, found)) == [("adset_id", "string", "bigint")]
    full = evolve.full_schema(spark.createDataFrame([], "adset_id BIGINT, other INT"), fv.ADSETS)
    assert full.simpleString() == "struct<adset_id:string,other:int>"
    assert evolve.declared_schema(fv.CHECKPOINT)["rows_loaded"].dataType.simpleString() == "bigint"


def test_type_repair(spark):
    stored = spark.createDataFrame([(12, "2024-01-05", "", "a")], "page_id BIGINT, date_start STRING, n STRING, s STRING")
    row = evolve.repair_types(stored, fv.AD_FACT, ["n"]).first()
    assert tuple(row) == ("12", date(2024, 1, 5), None, "a")
    assert evolve.promotable(["a", "b"], ["b", "c"]) == ["b"]


def test_catalog_sets(spark):
    a = spark.createDataFrame([("x",), ("y",), ("x",)], "table_name STRING")
    b = spark.createDataFrame([("x",), ("z",)], "table_name STRING")
    assert rows(catalog.shared_names(a, b)) == [("x",)]
    assert rows(catalog.names_only_in(a, b)) == [("y",)]


def test_run_history(spark):
    log = spark.createDataFrame(
        [(str(i), "c", "p", s, datetime(2024, 1, 1, i), None, Decimal(1), 0, None, "h") for i, s in enumerate(["STARTED", "FAILED", "STARTED"])],
        fv.DECLARED[fv.RUN_LOG])
    assert [r.run_id for r in runs.latest_runs(log, 2).collect()] == ["2", "1"]
    stale = runs.stale_runs(log, "INTERVAL 90 MINUTES", F.lit("2024-01-01 03:00:00").cast("timestamp"))
    assert [r.run_id for r in stale.collect()] == ["0"]


def test_hot_campaign_is_split_over_tasks_in_the_star_join(spark):
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": 2,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.shuffle.partitions": 20,
    }
    before = {k: spark.conf.get(k, None) for k in settings_}
    for k, v in settings_.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        fact = spark.range(0, 100_000, 1, 16).select(
            F.col("id").cast("string").alias("ad_id"), F.lit("2024-01-01").cast("date").alias("date_start"),
            F.lit("1").alias("account_id"), hot.alias("campaign_id"), F.lit("s").alias("adset_id"), F.rand(1).alias("spend"))
        campaigns = spark.range(0, 20_000).select(F.col("id").cast("string").alias("campaign_id"), F.lit("RUN").alias("status"))
        report = star.level_report(fact, "campaign", {"campaigns": campaigns}, {"campaigns": ["status"]})
        found = report.collect()
        assert "SortMergeJoin(skew=true)" in report._jdf.queryExecution().executedPlan().toString()
        assert len({r.ad_id for r in found}) == len(found) == 100_000
        assert sum(r.campaigns_status is not None for r in found) == sum(i % 3 != 0 for i in range(20_000))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
