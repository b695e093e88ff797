"""Every registered query against its SQL, and the shape of the plans behind the joins."""

import os

import oracle
import pytest

import __spark_entry__ as entry_points

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_entry_has_rows(spark):
    df = entry_points.entry(spark)
    assert df.schema.names and not df.isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_view_reads_only_what_it_needs(spark):
    text = plan(QUERIES["star_view"](spark, FOLDER).select("ad_id", "spend", "currency"))
    # Columns nobody asks for are not read, and the scan takes no other columns of the fact.
    assert "l_tax" not in text and "l_returnflag" not in text and "p_brand" not in text


def test_rollup_sums_before_the_shuffle(spark):
    text = plan(QUERIES["account_rollup"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text[text.index("Exchange hashpartitioning"):]


def test_no_python_in_any_plan(spark):
    for name in ("star_view", "goals_vs_actual", "metric_expand_long", "results_split", "preview_url", "declared_cast"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name
