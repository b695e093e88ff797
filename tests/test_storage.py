"""Files, catalog tables, mirroring, loads and the stream."""

import json
import uuid
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adtally import fixed_values as fv
from adtally.operators import fieldmap
from adtally.operators.goals import goals_vs_actual
from adtally.plans import loads, refresh, upkeep
from adtally.plans.driver_model import new_database
from adtally.plans.sync import choose_tables, sync_mode, sync_tables
from adtally.session import scratch_path, scratch_root, stage
from adtally.sources import landed, tables
from adtally.streaming.landing import stream_facts


@pytest.fixture
def database(spark):
    return new_database(spark, "test")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def put_lines(path, records):
    path.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (path / f"{uuid.uuid4().hex}.json").write_text("\n".join(lines))
    return str(path)


def test_scratch_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(scratch_root(spark) + "/adtally/x-")
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert rows(stage(spark.range(3).toDF("v"), "t"), "v") == [(0,), (1,), (2,)]


def test_json_scan_skips_broken_lines_and_keeps_result_shapes(spark, tmp_path):
    path = put_lines(tmp_path / "in", [
        {"ad_id": "1", "date_start": "2024-01-01", "results": [{"indicator": "x", "value": "1"}], "actions": [{"action_type": "a", "value": "2"}]},
        '{"ad_id": "cut', {"ad_id": "2", "results": {"k": 3}, "unknown": 1},
    ])
    got = landed.read_records(spark, path, landed.insight_schema("ad", ["age"])).orderBy("ad_id").collect()
    assert [r.ad_id for r in got] == ["1", "2"]
    assert got[0].actions[0].value == "2" and json.loads(got[1].results) == {"k": 3} and got[0].age is None
    assert "unknown" not in got[0].asDict()
    assert {"ad_id", "results", "unknown"} <= set(landed.read_records(spark, path).columns)


def test_csv_scan_is_all_text_with_clean_headers(spark, tmp_path):
    (tmp_path / "r.csv").write_text("﻿Account_ID , Account_Name\n00123,A\nact_9,\n", encoding="utf-8")
    got = landed.read_text_csv(spark, str(tmp_path / "r.csv"), ["account_id", "notes"])
    assert got.columns == ["account_id", "account_name", "notes"]
    assert rows(got, "account_id") == [("00123", "A", None), ("act_9", None, None)]


def test_raw_rows_replay_and_decode(spark):
    records = spark.createDataFrame([("1", "2024-01-01", None, 7), ("2", "2024-01-02", "x", 8)], "ad_id STRING, date_start STRING, note STRING, _ingest INT")
    raw = landed.raw_insight_rows(records, "ad", ["gender", " age"], F.col("_ingest"))
    first = raw.orderBy("id").first()
    assert (first.id, first.level, first.breakdowns, first.date_start) == (7, "ad", "age,gender", date(2024, 1, 1))
    assert json.loads(first.payload) == {"ad_id": "1", "date_start": "2024-01-01", "note": None}
    assert landed.replay_insights(raw, "ad", from_date="2024-01-02").count() == 1
    assert landed.replay_insights(raw, "ad", []).count() == 0
    assert [r.id for r in landed.replay_insights(raw, "ad", limit=1).collect()] == [7]
    assert landed.single_breakdown(raw) == ["age", "gender"]
    with pytest.raises(ValueError, match="several"):
        landed.single_breakdown(raw.unionByName(raw.withColumn("breakdowns", F.lit(None).cast("string"))))
    generic = landed.raw_rows(records, {"the_id": "ad_id", "none": "absent"}, F.col("_ingest"))
    assert [(r.the_id, r.none) for r in generic.orderBy("id").collect()] == [("1", None), ("2", None)]


def test_decode_skips_missing_and_broken_payloads(spark):
    raw = spark.createDataFrame([(1, '{"a": {"b": 1}, "c": "x"}'), (2, "{"), (3, None), (4, "[1]"), (5, '{"a": {"b": 2}, "c": 4}')], "id INT, payload STRING")
    schema = landed.payload_schema(raw)
    assert schema.simpleString() == "struct<a:struct<b:bigint>,c:string>"
    got = landed.decode_payload(raw, schema).orderBy("_raw_id").collect()
    assert [(r._raw_id, r.a.b, r.c) for r in got] == [(1, 1, "x"), (5, 2, "4")]


def test_write_modes(spark, database):
    table = f"{database}.things"
    df = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    tables.write_table(df, table, "if_empty")
    with pytest.raises(ValueError, match="not empty"):
        tables.write_table(df, table, "if_empty")
    tables.write_table(df.withColumn("extra", F.lit(5)), table, "append")
    assert rows(spark.table(table).select("k", "v", "extra"), "extra") == [(1, "a", None), (1, "a", 5)]
    tables.write_table(spark.table(table).where("extra = 5"), table, "truncate")
    assert spark.table(table).count() == 1
    tables.truncate_tables(spark, [table, f"{database}.absent"])
    assert spark.table(table).count() == 0
    with pytest.raises(ValueError):
        tables.write_table(df, table, "sideways")


def test_interrupted_swap_is_completed(spark, database):
    table = f"{database}.swapped"
    tables.write_table(spark.range(3), table)
    tables.write_table(spark.range(5), table + "__next0")
    spark.sql(f"DROP TABLE {table}")
    tables.finish_replace(spark, table)
    assert spark.table(table).count() == 5


def fact(spark, records):
    return spark.createDataFrame(records, "ad_id STRING, date_start DATE, spend DOUBLE, _ingest INT")


def test_fact_upsert_leaves_other_days_alone(spark, database):
    table = f"{database}.{fv.AD_FACT}"
    tables.upsert_table(spark, fact(spark, [("1", date(2024, 1, 1), 1.0, 1), ("1", date(2024, 1, 1), 2.0, 2), ("1", date(2024, 1, 2), 3.0, 3)]), table, ["_ingest"])
    untouched = {r[0] for r in spark.table(table).where("date_start = DATE'2024-01-02'").select("_metadata.file_path").collect()}
    grown = fact(spark, [("2", date(2024, 1, 1), 9.0, 1)]).withColumn("fresh.metric", F.lit(4.0))
    tables.upsert_table(spark, grown, table, ["_ingest"])
    stored = spark.table(table)
    assert rows(stored.select("ad_id", "date_start", F.col("spend").cast("double"), "fresh_metric"), "date_start", "ad_id") == [
        ("1", date(2024, 1, 1), 2.0, None), ("2", date(2024, 1, 1), 9.0, 4.0), ("1", date(2024, 1, 2), 3.0, None)]
    assert "_ingest" not in stored.columns and "impressions" in stored.columns
    assert {r[0] for r in stored.where("date_start = DATE'2024-01-02'").select("_metadata.file_path").collect()} == untouched


def test_fact_upsert_with_null_day_fails(spark, database):
    table = f"{database}.{fv.AD_FACT}"
    tables.upsert_table(spark, fact(spark, [("1", date(2024, 1, 1), 1.0, 1)]), table, ["_ingest"])
    with pytest.raises(Exception, match="date_start contains NULL"):
        tables.upsert_table(spark, fact(spark, [("1", None, 1.0, 1)]), table, ["_ingest"])
    with pytest.raises(ValueError, match="ad_id"):
        tables.upsert_table(spark, spark.sql("SELECT DATE'2024-01-01' AS date_start, 1 AS _ingest"), table, ["_ingest"])


def test_filters_reach_the_partitions(spark, database):
    table = f"{database}.{fv.AD_FACT}"
    tables.upsert_table(spark, fact(spark, [("1", date(2024, 1, d), 1.0, 1) for d in (1, 2, 3)]), table, ["_ingest"])
    plan = spark.table(table).where("date_start = DATE'2024-01-02' AND spend > 0").select("ad_id", "spend")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_start" in text and "PushedFilters: [IsNotNull(spend), GreaterThan(spend" in text
    assert "ReadSchema: struct<ad_id:string,spend:decimal(38,9)>" in text


def test_repair_prune_and_rename(spark, database):
    table = f"{database}.wide"
    tables.write_table(spark.createDataFrame([(7, "1", "x")], "page_id BIGINT, n STRING, old STRING"), table)
    tables.repair_table(spark, table, spark.createDataFrame([("2",)], "n STRING"))
    assert spark.table(table).schema.simpleString() == "struct<page_id:string,n:double,old:string>"
    decided = spark.createDataFrame(
        [("", "f", "old", "wide", "old", "renamed", "approved", ""), ("", "f", "n", "wide", "n", "", "excluded", "")],
        ", ".join(f"{c} STRING" for c in fv.FIELD_MAP_COLUMNS))
    assert rows(upkeep.prune_columns(spark, database, decided, dry_run=True)) == [("wide", "n", True)]
    assert spark.table(table).columns == ["page_id", "n", "old"]
    upkeep.prune_columns(spark, database, decided)
    upkeep.migrate_renames(spark, database, decided)
    assert spark.table(table).columns == ["page_id", "renamed"]
    assert upkeep.migrate_renames(spark, database, decided).first().outcome == "already"


def test_backup_restore_and_unrecognised(spark, database):
    copy = new_database(spark, "copy")
    tables.write_table(spark.sql("SELECT 'a' AS ad_id"), f"{database}.{fv.ADS}")
    tables.write_table(spark.sql("SELECT 'a' AS ad_id, DATE'2024-01-01' AS date_start, 'f' AS age"), f"{database}.{fv.AD_FACT}__age")
    tables.write_table(spark.sql("SELECT 1 AS v"), f"{database}.scribble")
    assert tables.unrecognised_tables(spark, database) == ["scribble"]
    assert tables.backup(spark, database, copy) == [fv.ADS, f"{fv.AD_FACT}__age"]
    tables.write_table(spark.sql("SELECT 'b' AS ad_id"), f"{database}.{fv.ADS}")
    spark.sql(f"DROP TABLE {database}.{fv.AD_FACT}__age")
    assert tables.restore(spark, copy, database, dry_run=True) == [fv.ADS, f"{fv.AD_FACT}__age"]
    assert spark.table(f"{database}.{fv.ADS}").count() == 2
    tables.restore(spark, copy, database)
    assert rows(spark.table(f"{database}.{fv.ADS}"), "ad_id") == [("a",)]
    assert spark.table(f"{database}.{fv.AD_FACT}__age").count() == 1


def test_sync_modes_and_choices():
    assert sync_mode(fv.AD_FACT) == "merge" and sync_mode(fv.GOALS) == "truncate" and sync_mode("other") == "truncate"
    assert sync_mode(fv.AD_FACT, "APPEND") == "append"
    for table, mode in (("other", "merge"), (fv.AD_FACT, "sideways")):
        with pytest.raises(ValueError):
            sync_mode(table, mode)
    assert choose_tables([" ALL "], ["a", "b"], ["b", "c"]) == ["b"]
    assert choose_tables(["all"], [fv.ADS, "x"], [], create=True) == [fv.ADS]
    assert choose_tables(["x", " y "], [], []) == ["x", "y"]
    for requested in ([], ["all"]):
        with pytest.raises(ValueError):
            choose_tables(requested, ["a"], ["b"])


def test_sync_checks_before_writing(spark, database):
    mirror = new_database(spark, "mirror")
    tables.write_table(spark.sql("SELECT 1 AS `a`"), f"{database}.one")
    with pytest.raises(ValueError, match="mirror table"):
        sync_tables(spark, database, mirror, ["one"])
    with pytest.raises(ValueError, match="source table"):
        sync_tables(spark, database, mirror, ["none"], create=True)
    sync_tables(spark, database, mirror, ["one"], create=True, rename="uno")
    assert rows(spark.table(f"{mirror}.uno")) == [(1,)]
    tables.truncate_tables(spark, [f"{database}.one"])
    sync_tables(spark, database, mirror, ["one"], rename="uno")
    assert spark.table(f"{mirror}.uno").count() == 0


def test_dimension_load_and_status_filter(spark, database):
    records = spark.createDataFrame(
        [("1", "n", "5", "2024-01-01T00:00:00-0100", "ACTIVE", 1), ("1", "later", "x", "bad", "ACTIVE", 2), ("2", "m", "6", None, "PAUSED", 3)],
        "id STRING, name STRING, daily_budget STRING, created_time STRING, effective_status STRING, _ingest INT")
    loads.load_dimension(spark, records, "campaigns", database, ["_ingest"], statuses=["ACTIVE"])
    got = spark.table(f"{database}.{fv.CAMPAIGNS}")
    assert rows(got.select("campaign_id", "campaign_name", "created_time", "account_id")) == [("1", "later", None, None)]


def test_ads_seed_creatives_without_touching_richer_columns(spark, database):
    creatives = spark.createDataFrame(
        [("k1", "first", "T", [("u", "h")], 1), ("k1", "second", "S", [], 2)],
        "id STRING, name STRING, title STRING, images ARRAY<STRUCT<url: STRING, hash: STRING>>, _ingest INT")
    nested = creatives.withColumn("asset_feed_spec", F.struct("images")).drop("images")
    loads.load_dimension(spark, nested, "creatives", database, ["_ingest"])
    ads = spark.createDataFrame([("a1", "ad", ("k1", "renamed"), 1), ("a2", "ad", (None, None), 2)], "id STRING, name STRING, creative STRUCT<id: STRING, name: STRING>, _ingest INT")
    loads.load_dimension(spark, ads, "ads", database, ["_ingest"])
    row = spark.table(f"{database}.{fv.CREATIVES}").collect()
    assert [(r.creative_id, r.creative_name, r.title, r.asset_feed_spec_image_url) for r in row] == [("k1", "renamed", "T", "u")]
    assert spark.table(f"{database}.{fv.ADS}").count() == 2


def test_range_load_resumes_and_rolling_load_does_not_skip(spark, database):
    def records(value):
        return spark.createDataFrame([("1", f"2024-01-{d:02d}", value, d) for d in range(1, 11)], "ad_id STRING, date_start STRING, spend STRING, _ingest INT")

    known = {"metric_types": {}, "numeric_text": ["spend"]}
    first = loads.load_range(spark, records("1"), "ad", database, ["_ingest"], "2024-01-01", "2024-01-10", 4, windows_per_job=2, **known)
    assert rows(first, "since") == [(date(2024, 1, 1), date(2024, 1, 4), 4), (date(2024, 1, 5), date(2024, 1, 8), 4), (date(2024, 1, 9), date(2024, 1, 10), 2)]
    again = loads.load_range(spark, records("2"), "ad", database, ["_ingest"], "2024-01-01", "2024-01-10", 4, windows_per_job=2, **known)
    assert again.count() == 0
    loads.load_rolling(spark, records("3"), "ad", database, ["_ingest"], date(2024, 1, 11), 2, **known)
    stored = spark.table(f"{database}.{fv.AD_FACT}")
    assert [float(r.spend) for r in stored.orderBy("date_start").collect()] == [1.0] * 8 + [3.0] * 2
    loads.load_preset(spark, records("4"), "ad", database, ["_ingest"], date(2024, 1, 3), "yesterday", **known)
    assert [float(r.spend) for r in spark.table(f"{database}.{fv.AD_FACT}").orderBy("date_start").collect()][:3] == [1.0, 4.0, 1.0]


def test_unreadable_batch_marks_nothing(spark, database):
    bad = spark.createDataFrame([(None, "2024-01-01", "1", 1)], "ad_id STRING, date_start STRING, spend STRING, _ingest INT")
    with pytest.raises(Exception, match="ad_id contains NULL"):
        loads.load_range(spark, bad, "ad", database, ["_ingest"], "2024-01-01", "2024-01-02", 7, metric_types={}, numeric_text=[])
    assert spark.table(f"{database}.{fv.CHECKPOINT}").count() == 0


def test_field_map_in_a_fact_load(spark, database):
    records = spark.createDataFrame([("1", "2024-01-01", "2024-01-01", "5", "x", 1)], "ad_id STRING, date_start STRING, date_stop STRING, cost STRING, junk STRING, _ingest INT")
    chosen = fieldmap.FieldMap({"cost": "spend"}, frozenset({"junk"}), frozenset(), frozenset({"ad_id", "date_start", "date_stop", "cost", "junk"}))
    table = loads.load_facts(spark, records, "ad", database, ["_ingest"], fields=chosen, numeric_text=["cost"])
    row = spark.table(table).first()
    assert float(row.spend) == 5.0 and "junk" not in row.asDict() and "cost" not in row.asDict()


def test_goals_and_registry_files(spark, database, tmp_path):
    (tmp_path / "goals.csv").write_text("account_id,month,goal_spend\n1,2024-05-01,10\nact_1,2024-05-20,20\n")
    got = upkeep.load_goals(spark, database, str(tmp_path / "goals.csv"), new_database(spark, "goals_mirror"))
    assert [(r.account_id, r.month, float(r.goal_spend)) for r in got.collect()] == [("act_1", date(2024, 5, 1), 20.0)]
    accounts = spark.createDataFrame([("act_1", "a", "1", 1)], "id STRING, name STRING, account_status STRING, _ingest INT")
    upkeep.refresh_registry(spark, database, accounts, ["_ingest"])
    renamed = accounts.withColumn("name", F.lit("b"))
    assert [r.account_name for r in upkeep.refresh_registry(spark, database, renamed, ["_ingest"]).collect()] == ["b"]


def test_erasure_needs_confirmation(spark, database):
    tables.write_table(spark.sql("SELECT * FROM VALUES ('a1', '1'), ('a2', '2') AS t(ad_id, account_id)"), f"{database}.{fv.ADS}")
    facts = spark.sql("SELECT * FROM VALUES ('a1', DATE'2024-01-01'), ('a1', DATE'2024-01-02'), ('a2', DATE'2024-01-02') AS t(ad_id, date_start)")
    tables.write_table(facts, f"{database}.{fv.AD_FACT}")
    marked = spark.createDataFrame([("act_1", "x", "YES")], "account_id STRING, account_name STRING, delete STRING")
    counted = upkeep.erase_accounts(spark, database, marked)
    assert spark.table(f"{database}.{fv.AD_FACT}").count() == 3
    done = upkeep.erase_accounts(spark, database, marked, confirm=True)
    assert rows(counted, "table_name") == rows(done, "table_name") == [("(total)", 3), (fv.ADS, 1), (fv.AD_FACT, 2)]
    assert rows(spark.table(f"{database}.{fv.AD_FACT}").select("ad_id")) == [("a2",)]
    assert rows(spark.table(f"{database}.{fv.ADS}").select("ad_id")) == [("a2",)]


def test_erasure_leaves_files_of_untouched_tables_alone(spark, database):
    tables.write_table(spark.sql("SELECT * FROM VALUES ('a1', '1'), ('a2', '2') AS t(ad_id, account_id)"), f"{database}.{fv.ADS}")
    tables.write_table(spark.sql("SELECT 's2' AS adset_id, '2' AS account_id"), f"{database}.{fv.ADSETS}")
    before = {r[0] for r in spark.table(f"{database}.{fv.ADSETS}").select("_metadata.file_path").collect()}
    marked = spark.createDataFrame([("act_1", "x", "YES")], "account_id STRING, account_name STRING, delete STRING")
    upkeep.erase_accounts(spark, database, marked, confirm=True)
    assert {r[0] for r in spark.table(f"{database}.{fv.ADSETS}").select("_metadata.file_path").collect()} == before
    assert rows(spark.table(f"{database}.{fv.ADS}").select("ad_id")) == [("a2",)]


def test_combined_table_counts_its_rows(spark, database):
    for name, sql in {
        fv.AD_FACT: "SELECT 'a' AS ad_id, DATE'2024-01-01' AS date_start, '1' AS account_id, 2.0D AS spend",
        fv.ACCOUNTS: "SELECT 'act_1' AS id, 'EUR' AS currency",
        fv.ADS: "SELECT 'a' AS ad_id, 'k' AS creative_id",
    }.items():
        tables.write_table(spark.sql(sql), f"{database}.{name}")
    assert not loads.create_full_view(spark, database)
    tables.write_table(spark.sql("SELECT 'k' AS creative_id, 'T' AS title"), f"{database}.{fv.CREATIVES}")
    assert loads.create_full_view(spark, database)
    view = f"{database}.{fv.FULL_VIEW}"
    assert spark.table(view).first().currency == "EUR"
    assert spark.table(view).columns == loads.full_view(spark, database).columns
    mirror = new_database(spark, "combined")
    assert loads.materialise_combined(spark, database, mirror) == 1
    combined = f"{mirror}.{fv.COMBINED}"
    assert spark.table(combined).first().creative_title == "T"
    # The view outlives a load that replaces a table's files, can be mirrored, and is no table to back up or erase.
    known = spark.sql("SELECT 'k' AS id, 'U' AS title, 'cr' AS name, 1 AS _ingest")
    loads.load_dimension(spark, known, "creatives", database, ["_ingest"], numeric_text=[])
    assert spark.table(view).first().creative_title == "U"
    sync_tables(spark, database, mirror, [fv.FULL_VIEW], create=True)
    assert spark.table(f"{mirror}.{fv.FULL_VIEW}").first().creative_title == "U"
    assert fv.FULL_VIEW not in tables.table_names(spark, database)


def test_goals_view_is_kept_by_the_catalog(spark, database, tmp_path):
    tables.write_table(spark.sql("SELECT '1' AS account_id, DATE'2024-05-03' AS date_start, 5.0D AS spend, 2.0D AS actions_purchase"), f"{database}.{fv.COMBINED}")
    (tmp_path / "goals.csv").write_text("account_id,month,goal_spend,goal_purchases\n1,2024-05-01,10,8\n")
    goals = upkeep.load_goals(spark, database, str(tmp_path / "goals.csv"))
    got = spark.table(f"{database}.{fv.GOALS_VIEW}")
    assert got.columns == goals_vs_actual(spark.table(f"{database}.{fv.COMBINED}"), goals).columns
    row = got.first()
    assert (row.pct_spend_goal, row.pct_purchases_goal, row.roas) == (0.5, 0.25, None)


def files(spark, table, day):
    return {r[0] for r in spark.table(table).where(f"date_start = DATE'{day}'").select("_metadata.file_path").collect()}


def test_mirror_takes_only_the_days_named(spark, database):
    mirror, table = new_database(spark, "days"), fv.AD_FACT
    loaded = fact(spark, [("1", date(2024, 1, d), 1.0, 1) for d in (1, 2)])
    tables.upsert_table(spark, loaded, f"{database}.{table}", ["_ingest"])
    sync_tables(spark, database, mirror, [table], create=True, days=[date(2024, 1, 2)])
    assert spark.table(f"{mirror}.{table}").count() == 2  # a new mirror takes all days
    before = files(spark, f"{mirror}.{table}", "2024-01-01")
    tables.upsert_table(spark, loaded.withColumn("spend", F.lit(4.0)), f"{database}.{table}", ["_ingest"])
    sync_tables(spark, database, mirror, [table], days=[date(2024, 1, 2)])
    spends = spark.table(f"{mirror}.{table}").orderBy("date_start").collect()
    assert [float(r.spend) for r in spends] == [1.0, 4.0]
    assert files(spark, f"{mirror}.{table}", "2024-01-01") == before


def test_erasure_rewrites_only_days_that_lose_rows(spark, database):
    tables.write_table(spark.sql("SELECT * FROM VALUES ('a1', '1'), ('a2', '2') AS t(ad_id, account_id)"), f"{database}.{fv.ADS}")
    table = f"{database}.{fv.AD_FACT}"
    facts = [("a2", date(2024, 1, 1)), ("a1", date(2024, 1, 2)), ("a2", date(2024, 1, 2)), ("a1", date(2024, 1, 3))]
    tables.write_table(spark.createDataFrame(facts, "ad_id STRING, date_start DATE"), table)
    before = files(spark, table, "2024-01-01")
    marked = spark.createDataFrame([("act_1", "x", "YES")], "account_id STRING, account_name STRING, delete STRING")
    upkeep.erase_accounts(spark, database, marked, confirm=True)
    assert rows(spark.table(table), "date_start") == [("a2", date(2024, 1, 1)), ("a2", date(2024, 1, 2))]
    assert files(spark, table, "2024-01-01") == before
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["date_start=2024-01-01", "date_start=2024-01-02"]


def test_range_load_keeps_the_marks_of_jobs_before_a_failure(spark, database):
    records = spark.createDataFrame(
        [("1", "2024-01-01", "1", 1), ("1", "2024-01-03", "1", 2), (None, "2024-01-05", "1", 3)],
        "ad_id STRING, date_start STRING, spend STRING, _ingest INT")
    with pytest.raises(Exception, match="ad_id contains NULL"):
        loads.load_range(
            spark, records, "ad", database, ["_ingest"], "2024-01-01", "2024-01-06", 2, windows_per_job=2,
            metric_types={}, numeric_text=["spend"])
    marked = spark.table(f"{database}.{fv.CHECKPOINT}").select("since")
    assert rows(marked, "since") == [(date(2024, 1, 1),), (date(2024, 1, 3),)]


def test_any_breakdown_is_part_of_the_key_and_buckets_reach_the_table(spark, database):
    records = spark.createDataFrame(
        [("1", "2024-01-01", p, "1", n) for n, p in enumerate(["web", "app", "web"])],
        "ad_id STRING, date_start STRING, publisher_platform STRING, spend STRING, _ingest INT")
    known = {"metric_types": {}, "numeric_text": ["spend"]}
    for _ in range(2):
        table = loads.load_facts(spark, records, "ad", database, ["_ingest"], ["publisher_platform"], buckets=2, **known)
    assert rows(spark.table(table).select("publisher_platform"), "publisher_platform") == [("app",), ("web",)]
    layout = tables.stored_layout(spark, table)
    assert (layout.partition, layout.bucket_key, layout.buckets) == (("date_start",), "ad_id", 2)


def test_stream_takes_each_file_once_and_late_data_wins(spark, database, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    known = {"metric_types": {}, "numeric_text": ["spend"]}
    put_lines(landing, [{"ad_id": "1", "date_start": "2024-01-01", "spend": "1"}, {"ad_id": "1", "date_start": "2024-01-01", "spend": "2"}])
    stream_facts(spark, str(landing), "ad", database, checkpoint, **known).awaitTermination()
    table = f"{database}.{fv.AD_FACT}"
    assert [float(r.spend) for r in spark.table(table).collect()] == [2.0]
    put_lines(landing, [{"ad_id": "1", "date_start": "2024-01-01", "spend": "7"}, {"ad_id": "2", "date_start": "2024-01-02", "spend": "5"}])
    stream_facts(spark, str(landing), "ad", database, checkpoint, **known).awaitTermination()
    assert sorted(float(r.spend) for r in spark.table(table).collect()) == [5.0, 7.0]


def test_days_given_for_a_load_are_enforced(spark, database):
    table = f"{database}.{fv.AD_FACT}"
    tables.upsert_table(spark, fact(spark, [("1", date(2024, 1, 1), 1.0, 1)]), table, ["_ingest"])
    tables.upsert_table(spark, fact(spark, [("1", date(2024, 1, 1), 5.0, 1)]), table, ["_ingest"], days=[date(2024, 1, 1)])
    assert [float(r.spend) for r in spark.table(table).collect()] == [5.0]
    with pytest.raises(Exception, match="outside the days to load"):
        tables.upsert_table(spark, fact(spark, [("1", date(2024, 1, 2), 5.0, 1)]), table, ["_ingest"], days=[date(2024, 1, 1)])


def test_bucketed_facts_and_ads_join_without_a_shuffle(spark, database):
    facts = spark.range(1000).select(F.col("id").cast("string").alias("ad_id"), F.lit(date(2024, 1, 1)).alias("date_start"), F.lit(1.0).alias("spend"))
    ads = spark.range(1000).select(F.col("id").cast("string").alias("ad_id"), F.lit("ON").alias("status"))
    tables.write_table(facts, f"{database}.{fv.AD_FACT}", layout=tables.layout_of(fv.AD_FACT, buckets=4))
    tables.write_table(ads, f"{database}.{fv.ADS}", layout=tables.layout_of(fv.ADS, buckets=4))
    tables.replace_table(spark.table(f"{database}.{fv.ADS}").where("ad_id <> '7'"), f"{database}.{fv.ADS}")
    assert tables.stored_layout(spark, f"{database}.{fv.ADS}") == tables.Layout(bucket_key="ad_id", buckets=4)
    late = fact(spark, [("7", date(2024, 1, 1), 9.0, 1)])
    tables.upsert_table(spark, late, f"{database}.{fv.AD_FACT}", ["_ingest"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table(f"{database}.{fv.AD_FACT}").join(spark.table(f"{database}.{fv.ADS}"), "ad_id", "left")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert {r.ad_id for r in joined.where("status IS NULL").collect()} == {"7"}
        assert joined.where("spend = 9").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_nested_batch_columns_are_stored_as_json(spark, database):
    table = f"{database}.{fv.AD_FACT}"
    batch = fact(spark, [("1", date(2024, 1, 1), 1.0, 1)]).withColumn("actions", F.array(F.struct(F.lit("v").alias("value"), F.lit("a").alias("action_type"))))
    for _ in range(2):
        tables.upsert_table(spark, batch, table, ["_ingest"])
        assert spark.table(table).first().actions == '[{"action_type":"a","value":"v"}]'


def test_creatives_keep_the_first_record_but_replay_the_newest(spark, database):
    records = spark.createDataFrame([("k", "one", 1), ("k", "two", 2)], "id STRING, name STRING, _ingest INT")
    loads.load_dimension(spark, records, "creatives", database, ["_ingest"], numeric_text=[])
    assert spark.table(f"{database}.{fv.CREATIVES}").first().creative_name == "one"
    raw = landed.raw_rows(records, {"creative_id": "id"}, F.col("_ingest"))
    loads.replay_dimension(spark, raw, "creatives", database, numeric_text=[])
    assert spark.table(f"{database}.{fv.CREATIVES}").first().creative_name == "two"


def test_preview_payloads_without_declared_fields(spark, database):
    raw = spark.createDataFrame([(1, '{"ad_id": "1", "body": {"html": "x"}}')], "id INT, payload STRING")
    loads.replay_dimension(spark, raw, "ad-previews", database, numeric_text=[])
    assert spark.table(f"{database}.{fv.ADS}").first().body_html == "x"


def test_composite_jobs(spark, database, tmp_path):
    mirror = new_database(spark, "jobs")
    today = date(2024, 1, 11)
    delivery = spark.createDataFrame(
        [("a", "1", f"2024-01-{d:02d}", "1", d) for d in range(1, 12)], "ad_id STRING, account_id STRING, date_start STRING, spend STRING, _ingest INT")
    entities = {
        "accounts": spark.sql("SELECT 'act_1' AS id, 'acc' AS name, 'EUR' AS currency, 1 AS _ingest"),
        "ads": spark.sql("SELECT 'a' AS id, 'ad' AS name, named_struct('id', 'k', 'name', 'cr') AS creative, 'k' AS creative_id, 1 AS _ingest"),
    }
    known = {"metric_types": {}, "numeric_text": ["spend"]}
    refresh.refresh_daily(spark, database, entities, delivery, ["_ingest"], today, 3, mirror=mirror, **known)
    combined = spark.table(f"{mirror}.{fv.COMBINED}")
    assert rows(combined.select("date_start", "currency", "creative_name"), "date_start") == [
        (date(2024, 1, d), "EUR", "cr") for d in (8, 9, 10)]
    refresh.refresh_delivery(spark, database, entities["accounts"], delivery, ["_ingest"], today, 1, mirror=mirror, **known)
    assert spark.table(f"{mirror}.{fv.AD_FACT}").count() == 4
    refresh.refresh_range(spark, database, {}, delivery, ["_ingest"], "2024-01-01", "2024-01-04", 2, backup_database=new_database(spark, "b"), **known)
    assert spark.table(f"{database}.{fv.AD_FACT}").count() == 8
    renamed = {"ads": entities["ads"].withColumn("name", F.lit("later"))}
    refresh.refresh_dimensions(spark, database, renamed, ["_ingest"], mirror)
    assert spark.table(f"{mirror}.{fv.ADS}").first().ad_name == "later"
    loads.load_preset(spark, delivery, "ad", database, ["_ingest"], today, csv_path=str(tmp_path / "copy"), **known)
    assert landed.read_text_csv(spark, str(tmp_path / "copy")).count() == 1


def test_arrival_order_follows_the_lines(spark, tmp_path):
    path = put_lines(tmp_path / "a", [{"ad_id": "1", "spend": str(i)} for i in range(3)])
    records = landed.with_arrival(landed.read_records(spark, path, landed.insight_schema("ad")))
    assert [r.spend for r in records.orderBy(*landed.ARRIVAL_ORDER).collect()] == ["0", "1", "2"]


def test_text_days_become_dates_only_if_all_do(spark):
    from adtally.operators.profile import day_if_all_parse

    good = spark.createDataFrame([("2024-01-01",), (None,)], "date_start STRING")
    assert day_if_all_parse(good, "date_start").schema["date_start"].dataType.simpleString() == "date"
    bad = good.union(spark.createDataFrame([("soon",)], good.schema))
    assert day_if_all_parse(bad, "date_start").schema == bad.schema
    assert day_if_all_parse(good, "absent").columns == good.columns


def test_rows_read_do_not_depend_on_the_columns_selected(spark, tmp_path):
    path = put_lines(tmp_path / "in", [
        {"ad_id": "1", "spend": "2", "actions": [{"action_type": "a", "value": "2"}]},
        {"ad_id": "2", "spend": "3", "actions": {"action_type": "b"}}, '{"ad_id": "cut', "7", "[1]",
    ])
    records = landed.read_records(spark, path, landed.insight_schema("ad"))
    assert rows(records.select("ad_id"), "ad_id") == [("1",), ("2",)]
    assert [(r["ad_id"], r["spend"]) for r in records.select("ad_id", "spend", "actions").orderBy("ad_id").collect()] == [
        ("1", "2"), ("2", "3")
    ]
    assert records.count() == 2 and landed.unreadable_lines(spark, path).count() == 3
    raw = spark.createDataFrame([(1, '{"ad_id": "1", "actions": {"k": 1}}'), (2, "{cut"), (3, "7")], "id BIGINT, payload STRING")
    decoded = landed.decode_payload(raw, landed.insight_schema("ad"))
    assert rows(decoded.select("_raw_id", "ad_id")) == [(1, "1")] and decoded.count() == 1


def test_names_that_only_cutting_makes_equal_are_refused():
    tables.refuse_cut_collisions(["spend", "Spend", "a" * 70])
    with pytest.raises(ValueError, match="would both be stored"):
        tables.refuse_cut_collisions(["x_" + "a" * 70, "y_" + "a" * 70])


def test_days_that_cannot_be_read_fail(spark):
    for day in ("01.01.2024", None):
        records = spark.createDataFrame([("2024-01-01",), (day,)], "date_start STRING")
        with pytest.raises(Exception, match="date_start is no date"):
            loads._between(records, "2024-01-01", "2024-01-02").collect()


def test_stages_of_partitions_go_once_they_are_in_place(spark, tmp_path):
    name = f"stages_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    facts = spark.sql("SELECT 'a' ad_id, DATE'2024-01-01' date_start, DATE'2024-01-01' date_stop, 1.0D spend, 1 _n")
    before = set((Path(scratch_root(spark)) / "adtally").glob("*"))
    for _ in range(3):
        tables.upsert_table(spark, facts, f"{name}.{fv.AD_FACT}", ["_n"])
    left = set((Path(scratch_root(spark)) / "adtally").glob("*")) - before
    assert not [p for p in left if p.name.startswith(fv.AD_FACT)]


def test_clusters_plan_many_shuffle_partitions(spark):
    from adtally import session

    class Builder:
        settings: dict = {}

        def appName(self, _):
            return self

        def config(self, key, value):
            self.settings[key] = value
            return self

        master = appName

        def getOrCreate(self):
            return self.settings

    original, session.SparkSession = session.SparkSession, type("S", (), {"builder": Builder()})
    try:
        built = session.build_session(scratch="/shared")
    finally:
        session.SparkSession = original
    assert int(built["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) == session.SHUFFLE_WIDTH >= 4000
    assert built["spark.checkpoint.dir"] == "/shared"


def test_a_big_write_is_cut_into_ranges(spark, database, monkeypatch):
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("ad_id"), F.lit(date(2024, 1, 1)).alias("date_start"), F.lit(None).cast("decimal(38,9)").alias("spend")
    )
    layout = tables.layout_of(fv.AD_FACT)
    assert "repartition_by_range" not in tables.laid_out(df, layout, 3000)._jdf.queryExecution().executedPlan().toString().lower()
    monkeypatch.setattr("adtally.operators.keyed.TASK_BYTES", 20_000)
    cut = tables.laid_out(df, layout, 3000)
    assert cut.rdd.getNumPartitions() > 4 and max(cut.rdd.glom().map(len).collect()) < 1500
    assert rows(cut.select("ad_id"), "ad_id") == rows(df.select("ad_id"), "ad_id")
    tables.write_table(df, f"{database}.{fv.AD_FACT}")
    changed = df.where("ad_id < '2'").withColumn("spend", F.lit(1).cast("decimal(38,9)"))
    tables.upsert_table(spark, changed, f"{database}.{fv.AD_FACT}", None)
    stored = spark.table(f"{database}.{fv.AD_FACT}")
    assert stored.count() == 3000 and stored.where("spend = 1").count() == changed.count()
