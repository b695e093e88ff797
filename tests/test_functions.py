"""Names, account ids, coercion and text."""

import html
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from adtally.functions import accounts, coerce, names, text


def column(spark, values, c, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r["out"] for r in rows.select("i", c(F.col("v")).alias("out")).orderBy("i").collect()]


NAMES = [
    ("ad_review_feedback.global.non-functional_landing_page", "ad_review_feedback_global_non_functional_landing_page"),
    ("  A.B:C - D  ", "a_b_c_d"),
    ("___x__y_", "x_y"),
    ("ÄB", "b"),
    ("", ""),
    ("long " * 20, "_".join(["long"] * 20)[-63:]),
]


@pytest.mark.parametrize(("raw", "clean"), NAMES)
def test_column_name(raw, clean):
    assert names.column_name(raw) == clean


def test_name_columns_follow_the_same_rules(spark):
    raw = [r for r, _ in NAMES] + ["9 lives", "!!!"]
    assert column(spark, raw, names.column_name_of) == [names.column_name(r) for r in raw]
    assert column(spark, raw, names.mirror_column_name_of) == [names.mirror_column_name(r) for r in raw]
    assert names.mirror_column_name("9 lives") == "_9_lives"
    assert names.mirror_column_name("!!!") == "col"


def test_truncations():
    assert names.keep_tail("abcdef", 4) == "cdef"
    assert names.keep_head("abcdef", 4) == "abcd"


def test_breakdowns(spark):
    assert names.breakdown_key([" gender ", "age", "", None]) == "age,gender"
    assert names.breakdown_key(None) == ""
    assert names.checkpoint_breakdown_key(["Gender", " AGE"]) == "age,gender"
    assert names.checkpoint_breakdown_key([]) == "none"
    assert names.fact_table_name("ad") == "fact_meta_delivery_ad"
    assert names.fact_table_name("adset", ["gender", "age"]) == "fact_meta_delivery_adset__age_gender"
    values = [" gender ,age,", "", None]
    assert column(spark, values, names.breakdown_key_of) == ["age,gender", "", ""]
    assert column(spark, values, lambda c: names.breakdown_key_of(c, True)) == ["age,gender", "none", "none"]
    assert column(spark, ["b,a", ""], lambda c: names.fact_table_name_of(F.lit("ad"), c)) == [
        "fact_meta_delivery_ad__a_b", "fact_meta_delivery_ad"]


def test_id_columns():
    assert all(names.is_id_column(n) for n in ("id", "ad_id", "Page_ID", "creative.id"))
    assert not any(names.is_id_column(n) for n in ("paid", "ids", "identity"))


def test_account_prefix(spark):
    values = ["1", "act_1", "", None]
    assert column(spark, values, accounts.with_prefix) == ["act_1", "act_1", "", None]
    assert column(spark, values, accounts.without_prefix) == ["1", "1", "", None]
    assert column(spark, ["1", "act_1"], accounts.both_spellings) == [["1", "act_1"], ["act_1", "1"]]


def test_strict_number(spark):
    values = ["1", " 2.5 ", "-.5e2", "+3.", "12d", "NaN", "inf", "-Infinity", "", "x", "1,000", None, "0x10", "1e400"]
    inf = float("inf")
    assert column(spark, values, coerce.strict_number) == [
        1.0, 2.5, -50.0, 3.0, None, None, inf, -inf, None, None, None, None, None, inf]


def test_booleans(spark):
    texts = ["true", " T ", "1", "Yes", "y", "false", "f", "0", "NO", "n", "maybe", "", None]
    got = column(spark, texts, lambda c: coerce.to_boolean(c, T.StringType()))
    assert got == [True] * 5 + [False] * 5 + [None] * 3
    assert column(spark, [2.0, 0.0, float("nan"), None], lambda c: coerce.to_boolean(c, T.DoubleType()), "DOUBLE") == [
        True, False, None, None]


def test_times_are_utc_in_any_session_zone(spark):
    values = ["2024-01-02T03:04:05-0800", "2024-01-02 03:04:05", "2024-01-02", "2024-01-02T03:04", "2024-01-02T03:04:05Z", "soon", None]
    want = [datetime(2024, 1, 2, 11, 4, 5), datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2), datetime(2024, 1, 2, 3, 4),
            datetime(2024, 1, 2, 3, 4, 5), None, None]
    seconds = [None if w is None else int((w - datetime(1970, 1, 1)).total_seconds()) for w in want]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert column(spark, values, lambda c: F.unix_seconds(coerce.to_utc_timestamp(c))) == seconds
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_months_and_whole_numbers(spark):
    assert column(spark, ["2024-02-29", "2024-03-01"], coerce.month_start) == [date(2024, 2, 1), date(2024, 3, 1)]
    assert column(spark, ["7", "7.0", "7.5", "x"], coerce.to_whole_number) == [7, 7, None, None]
    assert column(spark, ["1.123456789", "x"], coerce.to_decimal) == [Decimal("1.123456789"), None]


def test_declared_cast_keeps_other_columns(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-02", "no", {"b": 1, "a": None}, 5)],
        "n STRING, d STRING, f STRING, j STRUCT<b: INT, a: STRING>, rest INT",
    )
    declared = T.StructType.fromDDL("n DECIMAL(38,9), d DATE, f BOOLEAN, j STRING, absent STRING")
    row = coerce.declared_cast(df, declared).first()
    assert row.asDict() == {"n": Decimal(1), "d": date(2024, 1, 2), "f": False, "j": '{"a":null,"b":1}', "rest": 5}


def test_sorted_json_reaches_into_lists_and_maps(spark):
    df = spark.sql("SELECT array(named_struct('z', 1, 'a', map('q', 1, 'b', 2))) AS v")
    got = df.select(coerce.sorted_json(F.col("v"), df.schema["v"].dataType)).first()[0]
    assert got == '[{"a":{"b":2,"q":1},"z":1}]'


def test_preview_urls(spark):
    bodies = [
        '&lt;iframe src=&quot;https://x.example/p?a=1&amp;b=2&quot; width=&#39;3&#39;&gt;&lt;/iframe&gt;',
        "plain <b>text</b>", "", None, "see http://y.example/z now",
    ]
    assert column(spark, bodies, text.preview_url) == [
        "https://x.example/p?a=1&b=2", "plain <b>text</b>", None, None, "http://y.example/z"]


PIECES = st.lists(
    st.one_of(
        st.sampled_from(["&amp;", "&lt", "&notit;", "&#38;", "&#x26;", "&#128;", "&#0;", "&#xD800;", "&#x110000;", "&#11;", "&#;",
                         "&#xfffe;", "&copy=1", "&;", "&hearts;", "&amp;lt;", "http://a.b/c", "&#99999999999999999999999999999999999999;"]),
        st.text(alphabet="ab &;#x<\"'1", max_size=4),
    ),
    max_size=6,
).map("".join)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PIECES, min_size=50, max_size=100))
def test_unescape_is_what_html_says(spark, bodies):
    assert column(spark, bodies, text.unescape_html) == [html.unescape(b) for b in bodies]
    found = [re.search(r"https?://[^\s\"'<]+", b) for b in bodies]
    assert column(spark, bodies, text.first_url) == [f.group(0) if f else None for f in found]
