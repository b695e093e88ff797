"""What changes and what is left alone: types, owed days, the combined table, raw replays, one pass per dimension."""

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from adtally import fixed_values as fv
from adtally.operators import reshape
from adtally.operators.star import star_of_buckets, star_view
from adtally.plans import loads, queries_changes, sync
from adtally.plans.driver_model import Tables, new_database
from adtally.sources import changes, landed, tables
from adtally.streaming import landing


@pytest.fixture
def database(spark):
    return new_database(spark, "t")


def facts(spark, rows):
    return spark.createDataFrame(rows, "ad_id STRING, date_start DATE, clicks BIGINT")


def files(spark, table, column):
    found = spark.table(table).selectExpr(column, "_metadata.file_path AS f").distinct().collect()
    return {r[0]: {x["f"] for x in found if x[0] == r[0]} for r in found}


D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 2, 1)


def test_a_stored_day_that_is_none_fails_the_upsert_by_name(spark, database):
    table = f"{database}.{fv.AD_FACT}"
    spark.createDataFrame([("1", "2024-01-01", "soon")], "ad_id STRING, date_start STRING, date_stop STRING").write.saveAsTable(table)
    with pytest.raises(ValueError, match=rf"{table}.date_stop .* 'soon'"):
        tables.upsert_table(spark, facts(spark, [("1", D1, 2)]), table, None)


def test_text_that_holds_no_number_is_judged_once(spark, database, monkeypatch):
    table = f"{database}.{fv.CAMPAIGNS}"
    spark.createDataFrame([(1, "7", "n/a"), (2, "", "3")], "campaign_id INT, score STRING, note STRING").write.saveAsTable(table)
    batch = spark.createDataFrame([("2", 5.5, 1.0)], "campaign_id STRING, score DOUBLE, note DOUBLE")
    tables.upsert_table(spark, batch, table, None)
    stored = spark.table(table)
    assert [f.dataType.simpleString() for f in stored.schema][:3] == ["string", "double", "string"]
    assert {tuple(r)[:3] for r in stored.collect()} == {("1", 7.0, "n/a"), ("2", 5.5, "1.0")}
    monkeypatch.setattr(tables, "unfit_values", lambda *_: pytest.fail("judged again"))
    tables.upsert_table(spark, batch.withColumn("score", batch["score"] + 1), table, None)
    assert spark.table(table).where("campaign_id = '2'").first()["score"] == 6.5


def test_only_days_that_changed_are_rewritten(spark, database):
    table = f"{database}.{fv.AD_FACT}"
    tables.upsert_table(spark, facts(spark, [("1", D1, 1), ("2", D1, None), ("1", D2, 1)]), table, None)
    before = files(spark, table, "date_start")
    tables.upsert_table(spark, facts(spark, [("1", D1, 1), ("2", D1, None), ("1", D2, 9)]), table, None)
    after = files(spark, table, "date_start")
    assert after[D1] == before[D1] and after[D2] != before[D2]
    dimension = f"{database}.{fv.CAMPAIGNS}"
    row = spark.createDataFrame([("1", "ON")], "campaign_id STRING, status STRING")
    tables.upsert_table(spark, row, dimension, None)
    kept = files(spark, dimension, "campaign_id")
    tables.upsert_table(spark, row, dimension, None)
    assert files(spark, dimension, "campaign_id") == kept


def test_a_failed_sync_owes_its_days(spark, database, monkeypatch):
    mirror, table = new_database(spark, "m"), f"{database}.{fv.AD_FACT}"
    run = lambda: sync.sync_tables(spark, database, mirror, [fv.AD_FACT], create=True, owed=True)
    copied = lambda: {(r["date_start"], r["clicks"]) for r in spark.table(f"{mirror}.{fv.AD_FACT}").collect()}
    tables.upsert_table(spark, facts(spark, [("1", D1, 1), ("1", D2, 1)]), table, None)
    run()
    tables.upsert_table(spark, facts(spark, [("1", D1, 5)]), table, None)
    with monkeypatch.context() as broken:
        broken.setattr(sync, "upsert_table", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("down")))
        with pytest.raises(RuntimeError):
            run()
    assert copied() == {(D1, 1), (D2, 1)}
    tables.upsert_table(spark, facts(spark, [("1", D3, 7)]), table, None)
    run()
    assert copied() == {(D1, 5), (D2, 1), (D3, 7)}
    due = changes.owed(spark, database, f"mirror {mirror}", [fv.AD_FACT])
    assert due == {fv.AD_FACT: []} and changes.logged(spark, database) == []


def star(spark, database):
    rows = [("1", D1, "7", "20"), ("2", D3, "7", "21"), ("3", date(2024, 3, 1), "8", "20")]
    fact = spark.createDataFrame(rows, "ad_id STRING, date_start DATE, account_id STRING, campaign_id STRING")
    frames = {
        fv.AD_FACT: fact.selectExpr("*", "'s' AS adset_id", "1 AS spend"),
        fv.ACCOUNTS: spark.createDataFrame([("act_7", "EUR"), ("act_8", "USD")], "id STRING, currency STRING"),
        fv.ADS: spark.createDataFrame([("1", "5"), ("2", "6"), ("3", "6")], "ad_id STRING, creative_id STRING"),
        fv.CREATIVES: spark.createDataFrame([("5", "a"), ("6", "b")], "creative_id STRING, title STRING"),
    }
    for name, df in frames.items():
        tables.upsert_table(spark, df, f"{database}.{name}", None)


def shown(spark, table):
    return {tuple(r) for r in spark.table(table).select("ad_id", "currency", "creative_title", "ad_status").collect()}


def test_combined_months_without_a_change_keep_their_files(spark, database):
    mirror = new_database(spark, "m")
    star(spark, database)
    combined, copy = f"{database}.{fv.COMBINED}", f"{mirror}.{fv.COMBINED}"
    assert loads.materialise_combined(spark, database, mirror) == 3

    def renewed(change):
        before = [files(spark, t, "date_month") for t in (combined, copy)]
        change()
        assert loads.materialise_combined(spark, database, mirror) == spark.table(f"{database}.{fv.AD_FACT}").count()
        assert shown(spark, combined) == shown(spark, copy)
        after = [files(spark, t, "date_month") for t in (combined, copy)]
        changed = [{m.month for m in {*a, *b} if a.get(m) != b.get(m)} for a, b in zip(after, before, strict=True)]
        assert changed[0] == changed[1]
        return changed[0]

    upsert = lambda name, rows, ddl: tables.upsert_table(spark, spark.createDataFrame(rows, ddl), f"{database}.{name}", None)
    assert renewed(lambda: None) == set()
    assert renewed(lambda: upsert(fv.AD_FACT, [("9", D3, "7")], "ad_id STRING, date_start DATE, account_id STRING")) == {2}
    assert renewed(lambda: upsert(fv.ACCOUNTS, [("act_8", "GBP")], "id STRING, currency STRING")) == {3}
    assert renewed(lambda: upsert(fv.CREATIVES, [("5", "new")], "creative_id STRING, title STRING")) == {1}
    assert renewed(lambda: upsert(fv.ADS, [("3", "6", "ON")], "ad_id STRING, creative_id STRING, status STRING")) == {3}
    table = f"{database}.{fv.AD_FACT}"
    rows = spark.table(table)
    assert renewed(lambda: tables.remove_rows(rows.where("ad_id = '1'"), rows.where("ad_id <> '1'"), table)) == {1}
    # A new dimension gives new columns: everything is written anew.
    assert renewed(lambda: upsert(fv.CAMPAIGNS, [("20", "ON")], "campaign_id STRING, status STRING")) == {2, 3}


def test_replay_reads_asked_days_and_decodes_winners_only(spark, database):
    schema = "ad_id STRING, date_start STRING, date_stop STRING, account_id STRING, spend STRING, _n LONG"
    days = ["2024-01-01", "2024-01-02", "2024-02-01"]
    rows = spark.createDataFrame([("1", d, d, "7", str(n), n) for n in range(4) for d in days], schema)
    raw = f"{database}.{fv.RAW_INSIGHTS}"
    tables.write_table(landed.raw_insight_rows(rows, "ad", [], rows["_n"]), raw)
    broken = spark.table(raw).limit(1).selectExpr(
        "100 AS id", "account_id", "level", "date_start", "date_stop", "breakdowns", "fetched_at", "'{\"ad_id\": \"1\"' AS payload"
    )
    tables.write_table(broken.select(spark.table(raw).columns), raw)
    asked = landed.replay_insights(spark.table(raw), "ad", [], "2024-01-01", "2024-01-31")
    records = landed.decode_payload(landed.newest_payloads(asked, ["ad_id", "date_start"]), landed.insight_schema("ad"))
    text = records._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("from_json") < text.index("Window") < text.index("get_json_object")
    physical = records._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(level" in physical and "date_start" in physical.split("PartitionFilters")[1].split("]")[0]
    assert {(r["date_start"], r["spend"]) for r in records.collect()} == {("2024-01-01", "3"), ("2024-01-02", "3")}
    loads.replay_facts(spark, spark.table(raw), "ad", database, from_date="2024-01-01", to_date="2024-01-31")
    assert {r["spend"] for r in spark.table(f"{database}.{fv.AD_FACT}").collect()} == {3}


def test_a_dimension_load_reads_its_source_once(spark, database, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ddl = "id STRING, name STRING, status STRING, creative STRUCT<id: STRING, name: STRING>, _ingest LONG"
    rows = spark.createDataFrame([(str(i), f"n{i}", "1", (str(i % 3), "c"), i) for i in range(50)], ddl)
    loads.load_dimension(spark, rows.mapInArrow(count, ddl), "ads", database, ["_ingest"], csv_path=str(tmp_path / "csv"))
    assert seen.value == 50
    assert spark.table(f"{database}.{fv.ADS}").count() == 50 and spark.table(f"{database}.{fv.CREATIVES}").count() == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 50


def test_too_many_metric_types_fail_with_their_number(spark):
    item = "named_struct('action_type', concat('t', id), 'value', '1')"
    df = spark.range(100_000).selectExpr(f"array({item}) AS actions", "'x' AS note")
    for discover in (lambda: reshape.discover_shape(df), lambda: reshape.discover_metric_types(df, ["actions"])):
        with pytest.raises(ValueError, match="actions has 100000 metric types"):
            discover()
    assert reshape.expand_metrics(df, unknown="map").selectExpr("sum(size(actions_other))").first()[0] == 100_000


def test_a_third_of_rows_on_one_ad_leaves_its_bucket(spark, database):
    rows = spark.range(3000).selectExpr(
        "CAST(if(id % 3 = 0, 7, id) AS STRING) AS ad_id", "DATE'2024-01-01' AS date_start", "'7' AS account_id", "id AS spend"
    ).selectExpr("*", "'c' AS campaign_id", "'s' AS adset_id")
    ads = spark.range(3000).selectExpr("CAST(id AS STRING) AS ad_id", "CAST(id % 5 AS STRING) AS creative_id", "'ON' AS status")
    names = {fv.AD_FACT: rows, fv.ADS: ads}
    for name, df in names.items():
        layout = tables.Layout(bucket_key="ad_id", buckets=8)
        tables.write_table(df, f"{database}.{name}", layout=layout)
    fact, ads = (spark.table(f"{database}.{n}") for n in names)
    accounts = spark.createDataFrame([("act_7", "EUR")], "id STRING, currency STRING")
    creatives = spark.createDataFrame([(str(i), f"t{i}") for i in range(5)], "creative_id STRING, title STRING")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    split = star_of_buckets(fact, accounts, ads, creatives, hot_rows=100)
    want = sorted(map(str, star_view(fact, accounts, ads, creatives).collect()))
    assert sorted(map(str, split.collect())) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")  # the ads are too many to be sent
    try:
        plan = star_of_buckets(fact, accounts, ads, creatives, hot_rows=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning(ad_id" in line]
    assert not exchanged and "LeftAnti" in plan and "LeftSemi" in plan


def test_a_batch_that_runs_again_replaces_its_rejected_lines(spark, database):
    ddl = f"ad_id STRING, {landed.UNREADABLE} STRING, _file STRING, _arrived TIMESTAMP"
    lines = spark.createDataFrame([("1", None, "f", None), (None, "[1]", "f", None), (None, "{", "f", None), (None, '{"ad_id": [1]}', "f", None)], ddl)
    for batch in (3, 3, 4):
        landing._keep_rejected(spark, lines, database, "s", batch)
    kept = spark.table(f"{database}.{landing.REJECTS}")
    assert sorted((r["batch"], r["line"], r["reason"]) for r in kept.collect()) == [
        (3, "[1]", "no JSON object"), (3, "{", "no JSON"), (4, "[1]", "no JSON object"), (4, "{", "no JSON"),
    ]


def test_days_that_are_dates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / uuid.uuid4().hex)
    spark.sql("SELECT DATE'2024-01-05' AS date_start, '1' AS ad_id").write.parquet(path)
    chosen = loads._between(spark.read.parquet(path), date(2024, 1, 1), date(2024, 1, 31))
    pushed = chosen._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(date_start" in pushed and "LessThanOrEqual(date_start" in pushed and chosen.count() == 1


def test_a_mirror_by_month_is_copied_as_it_lies(spark, database, monkeypatch):
    mirror, name = new_database(spark, "copied"), fv.COMBINED
    rows = facts(spark, [(str(n), date(2024, 1 + n % 3, 5), n) for n in range(60)]).withColumn("date_month", F.trunc("date_start", "MM"))
    tables.write_table(rows, f"{database}.{name}", layout=tables.Layout(("date_month",), ("ad_id",)))
    arranged = []
    real = tables.laid_out
    monkeypatch.setattr(tables, "laid_out", lambda *a, **k: arranged.append(1) or real(*a, **k))
    read = lambda db: sorted(tuple(r) for r in spark.table(f"{db}.{name}").select("ad_id", "date_start", "clicks", "date_month").collect())
    sync.sync_tables(spark, database, mirror, [name], create=True)
    assert not arranged and read(mirror) == read(database)
    tables.replace_table(spark.table(f"{database}.{name}").withColumn("clicks", F.col("clicks") + 1), f"{database}.{name}")
    arranged.clear()
    sync.sync_tables(spark, database, mirror, [name])
    assert not arranged and read(mirror) == read(database) and read(mirror)[0][2] == 1
    assert tables.stored_layout(spark, f"{mirror}.{name}").partition == ("date_month",)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_buckets_grow_with_the_tables(spark, tmp_path, monkeypatch):
    assert (tables.buckets_for(5), tables.buckets_for(4_500_000)) == (2, 5)
    spark.range(35).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "DOUBLE(1) AS o_totalprice",
        "TIMESTAMP'1995-01-01' AS o_orderdate", "'x' AS o_orderpriority",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(tables, "BUCKET_ROWS", 5)
    seen = []

    def load_facts(*args, buckets, **known):
        seen.append(buckets)
        raise RuntimeError("seen")

    monkeypatch.setattr(loads, "load_facts", load_facts)
    with pytest.raises(RuntimeError, match="seen"):
        queries_changes.star_bucketed(Tables(spark, str(tmp_path)))
    assert seen == [7]


def test_first_and_last_lines_need_no_sort(spark):
    lines = spark.createDataFrame([("no JSON", "b"), ("no JSON", "a"), ("other", "z")], "reason STRING, line STRING")
    got = queries_changes.extent(lines, landing.REASONS)
    assert "Sort [" not in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got.collect()] == [("no JSON", 2, "a", "b")]


def test_rejected_lines_are_found_by_several_tasks(spark, database):
    ddl = f"ad_id STRING, {landed.UNREADABLE} STRING, _file STRING, _arrived TIMESTAMP"
    lines = spark.createDataFrame([(None, f"[{n}]", "f", None) for n in range(40)], ddl).repartition(4)
    landing._keep_rejected(spark, lines, database, "s", 1)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    landing._keep_rejected(spark, lines, database, "s", 2)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert len(stages) > 1 and spark.table(f"{database}.{landing.REJECTS}").where("batch = 2").count() == 40
