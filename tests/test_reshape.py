"""Nested records to wide tables."""

import pytest
from pyspark.sql import functions as F

from adtally.operators import profile, reshape
from adtally.plans.loads import normalise_facts

ITEM = "STRUCT<action_type: STRING, indicator: STRING, value: STRING>"


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_flatten_keeps_lists_and_gives_dotted_names(spark):
    df = spark.createDataFrame([((("x", [1]), 2),)], "a STRUCT<b: STRUCT<c: STRING, l: ARRAY<INT>>, d: INT>")
    assert dicts(reshape.flatten(df)) == [{"a.b.c": "x", "a.b.l": [1], "a.d": 2}]


def test_flatten_of_a_missing_struct(spark):
    df = spark.createDataFrame([(None,)], "a STRUCT<b: STRING>")
    assert dicts(reshape.flatten(df)) == [{"a.b": None}]


def metrics(spark):
    return spark.createDataFrame(
        [
            (1, [("a:b.c", None, "1"), ("x", None, "2"), ("x", "ignored", "3")], []),
            (2, [("", "by.indicator", "4"), (None, None, "5"), ("x", None, None)], None),
            (3, None, []),
        ],
        f"k INT, m ARRAY<{ITEM}>, empty ARRAY<{ITEM}>",
    )


def test_metric_lists_become_columns(spark):
    wide = reshape.expand_metrics(metrics(spark)).orderBy("k")
    assert sorted(wide.columns) == ["empty", "k", "m_a_b_c", "m_by_indicator", "m_x"]
    rows = dicts(wide)
    assert [(r["m_a_b_c"], r["m_by_indicator"], r["m_x"]) for r in rows] == [("1", None, "3"), (None, "4", None), (None, None, None)]
    assert rows[0]["empty"] == []


def test_declared_metric_types_need_no_job(spark):
    wide = reshape.expand_metrics(metrics(spark), {"m": ["x", "never"]}, unknown="keep")
    assert [(r["m_x"], r["m_never"]) for r in dicts(wide.orderBy("k"))] == [("3", None), (None, None), (None, None)]
    # What has no column stays.
    assert [r["m_other"] for r in dicts(wide.orderBy("k"))][:2] == ['{"a_b_c":"1"}', '{"by_indicator":"4"}']


def test_metric_types_that_were_not_declared_fail(spark):
    with pytest.raises(Exception, match="m has a metric type that was not named"):
        reshape.expand_metrics(metrics(spark), {"m": ["x"]}).collect()
    named = {"m": ["x", "a_b_c", "by_indicator"]}
    assert reshape.expand_metrics(metrics(spark), named).count() == metrics(spark).count()


def test_declared_numbers_that_are_text_fail(spark):
    df = spark.createDataFrame([("1", " "), ("2.5", None)], "spend STRING, other STRING")
    assert dicts(reshape.cast_numbers(df, ["spend", "other"])) == [
        {"spend": 1.0, "other": None}, {"spend": 2.5, "other": None}
    ]
    with pytest.raises(Exception, match="spend holds text that is no number: 5 EUR"):
        reshape.cast_numbers(spark.createDataFrame([("5 EUR",)], "spend STRING"), ["spend"]).collect()


def test_long_metrics_pivot_back_to_the_wide_ones(spark):
    long = reshape.expand_metrics_long(metrics(spark), ["k"])
    wide = long.groupBy("k").pivot("type", ["a_b_c", "by_indicator", "x"]).agg(F.first("value")).orderBy("k")
    assert [tuple(r) for r in wide.collect()] == [(1, "1", None, "3"), (2, None, "4", None)]


def test_list_of_other_objects_is_kept(spark):
    df = spark.createDataFrame([(1, [("u", "h")])], "k INT, images ARRAY<STRUCT<url: STRING, hash: STRING>>")
    assert reshape.expand_metrics(df).columns == ["k", "images"]
    got = reshape.first_element(df, "images", {"u": "url", "h": "hash"})
    assert dicts(got)[0]["u"] == "u"


RESULTS = [
    ('[{"indicator": "p", "value": "5"}, {"action_type": "q", "values": [{"no": 1}, {"value": "2"}]}, {"indicator": "z"}, 3, "s"]',
     "p,q,z", "5,2,0"),
    ('{"b": 1, "a": null}', "b,a", "1,0"),
    ("7", "results", "7"),
    ("word", "results", "word"),
    ("[]", None, None),
    ("{}", None, None),
    (None, None, None),
    ('[{"indicator": "", "action_type": "t", "value": 0}]', "t", "0"),
]


def test_results_as_text(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(RESULTS)], "i INT, results STRING")
    got = reshape.split_results(df).orderBy("i").collect()
    assert [(r.results_indicator, r.results_value) for r in got] == [(a, b) for _, a, b in RESULTS]
    assert "results" not in got[0].asDict()


def test_results_as_structs_maps_and_numbers(spark):
    kind = "ARRAY<STRUCT<indicator: STRING, action_type: STRING, value: STRING, values: ARRAY<STRUCT<value: STRING>>>>"
    rows = [([("p", None, "5", None), (None, "q", None, [("2",)]), ("z", None, None, None), (None, None, "1", None)],), ([],), (None,)]
    got = reshape.split_results(spark.createDataFrame(rows, f"results {kind}")).collect()
    assert [tuple(r) for r in got] == [("p,q,z", "5,2,0"), (None, None), (None, None)]
    mapped = spark.sql("SELECT map('a', 1, 'b', NULL) AS results")
    assert tuple(reshape.split_results(mapped).first()) == ("a,b", "1,0")
    record = spark.sql("SELECT named_struct('a', 1, 'b', CAST(NULL AS INT)) AS results")
    assert tuple(reshape.split_results(record).first()) == ("a", "1")
    assert tuple(reshape.split_results(spark.sql("SELECT 4 AS results")).first()) == ("results", "4")
    assert tuple(reshape.split_results(spark.sql("SELECT 1 AS k")).first()) == (1, None, None)


def test_duplicates_are_merged_first_value_first(spark):
    df = spark.sql("SELECT NULL AS a, 1 AS `b.1`, 'x' AS a, 2 AS `b.2`, 3 AS k, 'y' AS `a.1`, 4 AS `v1.0`")
    assert dicts(reshape.coalesce_duplicates(df)) == [{"a": "x", "b": 1, "k": 3, "v1": 4}]


def test_non_finite_numbers_become_null(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.0,), (None,)], "v DOUBLE")
    assert [r.v for r in reshape.null_non_finite(df).collect()] == [None, None, None, 1.0, None]


def test_numbers_are_filled_ids_cleaned_texts_kept(spark):
    df = spark.createDataFrame(
        [("123.0", 123.0, None, None, None, None), (None, None, 2.0, "t", True, None)],
        "a_id STRING, b_id DOUBLE, n DOUBLE, s STRING, flag BOOLEAN, d DATE",
    )
    assert dicts(reshape.fill_numbers(df)) == [
        {"a_id": "123", "b_id": "123", "n": 0.0, "s": None, "flag": 0.0, "d": None},
        {"a_id": None, "b_id": None, "n": 2.0, "s": "t", "flag": 1.0, "d": None},
    ]
    assert dicts(reshape.fill_numbers(df, keep_nulls=True))[0]["n"] is None


def test_long_ids_keep_every_digit(spark):
    df = spark.createDataFrame([("1234567890123456789", "9876543210987654321", "10.50")], "id STRING, account_id STRING, spend STRING")
    got = reshape.fill_numbers(reshape.cast_numbers(df, profile.numeric_text_columns(df))).first()
    assert (got.id, got.account_id, got.spend) == ("1234567890123456789", "9876543210987654321", 10.5)


def test_numeric_columns_are_all_or_nothing(spark):
    df = spark.createDataFrame(
        [("1", "1", "", "12d", None), ("2.5", "x", "3", "4", None), (None, "3", "4", "5", None)],
        "good STRING, mixed STRING, blank STRING, suffixed STRING, nothing STRING",
    )
    assert profile.numeric_text_columns(df) == ["good"]
    assert profile.numeric_text_columns(df, blank_is_missing=True) == ["good", "blank"]
    rows = {r.column_name: (r.non_null, r.numeric_like) for r in profile.column_profile(df).collect()}
    assert rows == {"good": (2, 2), "mixed": (3, 2), "blank": (3, 2), "suffixed": (3, 2), "nothing": (0, 0)}


def test_first_non_blank(spark):
    df = spark.createDataFrame([(None, " ", "c"), ("a", "b", "c"), (None, None, None)], "x STRING, y STRING, z STRING")
    assert [r[0] for r in df.select(reshape.first_non_blank(df, "x", "missing", "y", "z")).collect()] == ["c", "a", None]


def test_rename_only_if_absent(spark):
    df = spark.sql("SELECT 1 AS id, 'n' AS name, 'kept' AS ad_name")
    assert reshape.rename_if_absent(df, {"id": "ad_id", "name": "ad_name"}).columns == ["ad_id", "name", "ad_name"]


def test_fact_normalisation_in_one(spark):
    records = spark.createDataFrame(
        [
            ("1", "2024-01-01", "5", [("a.b", None, "2")], '[{"indicator": "i", "value": 3}]', "inf", 9),
            ("2", "2024-01-01", None, [("c", None, "x")], None, "1", 8),
        ],
        f"ad_id STRING, date_start STRING, spend STRING, actions ARRAY<{ITEM}>, results STRING, odd STRING, _ingest INT",
    )
    rows = dicts(normalise_facts(records, "ad", [" age "]).orderBy("ad_id"))
    assert rows[0] == {
        "ad_id": "1", "date_start": "2024-01-01", "spend": 5.0, "actions_a_b": 2.0, "actions_c": None, "odd": 0.0, "_ingest": 9,
        "results_indicator": "i", "results_value": 3.0, "date_stop": None, "age": None,
    }
    assert rows[1]["actions_c"] == "x" and rows[1]["spend"] == 0.0 and rows[1]["results_value"] == 0.0


def test_empty_input_stays_empty(spark):
    records = spark.createDataFrame([], f"ad_id STRING, date_start STRING, spend STRING, actions ARRAY<{ITEM}>")
    assert normalise_facts(records, "ad").count() == 0


@pytest.mark.parametrize("level", ["ad", "adset", "campaign", "account"])
def test_every_level_gets_its_key(spark, level):
    assert {f"{level}_id", "date_start", "date_stop"} <= set(normalise_facts(spark.sql("SELECT 1 AS v"), level).columns)
