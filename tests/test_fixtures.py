"""How Spark builds the views: the same rows as their SQL, and line items that move once."""

from datetime import datetime
from decimal import Decimal

import pytest

from verification.catalog import Inputs
from verification.fixtures import BASE_TABLES, VIEWS, fixture, stored_terms, view_ctes


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders with several lines, lines that come twice, an order without a customer and lines without an order."""
    folder = str(tmp_path_factory.mktemp("tables"))
    orders = [(k, k % 5 if k % 7 else None, "OFP"[k % 3], datetime(1996 + k % 6, 1 + k % 12, 1 + k % 28), f"{k % 4 + 1}-URGENT") for k in range(1, 60)]
    lines = [(k or None, 1 + k % 9, 1 + k % 4, n, Decimal(10 + 7 * n), Decimal(100 * k + n), datetime(1998, 1, 1 + k % 28))
             for k in range(64) for n in (1, 2, 2, 6)]
    rows = {
        "nation": ([(k, f"NATION_{k}") for k in range(3)], "n_nationkey long, n_name string"),
        "customer": ([(k, k % 3, "BUILDING" if k % 2 else "FURNITURE") for k in range(4)], "c_custkey long, c_nationkey long, c_mktsegment string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity decimal(12,2), "
                            "l_extendedprice decimal(12,2), l_shipdate timestamp_ntz"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", VIEWS)
def test_views_have_the_rows_of_their_sql(spark, tables, name):
    plain = [f"{t} AS (SELECT * FROM parquet.`{tables}/{t}.parquet`)" for t in BASE_TABLES]
    expected = spark.sql("WITH " + ", ".join([*plain, *view_ctes(name)]) + f" SELECT * FROM {name}")
    found = fixture(spark, tables, name)
    assert found.schema == expected.schema
    rows = sorted(map(repr, found.collect()))
    assert rows and rows == sorted(map(repr, expected.collect()))


@pytest.mark.parametrize("name", ["fx_pm", "src_pm", "src_reporting"])
def test_line_items_move_once(spark, tables, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixture(spark, tables, name)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sorted(moved) == ["c_custkey", "c_nationkey", "l_orderkey", "n_nationkey", "o_custkey", "o_orderkey"]


def test_premium_is_made_after_terms_are_counted(spark, tables):
    """The count of a term's vehicles carries the price only, and an amount is made once."""
    above, _, below = fixture(spark, tables, "fx_pm")._jdf.queryExecution().optimizedPlan().toString().partition("Window [count(1)")
    assert "amount_2#" in above and "amount_2#" not in below and "WP_BI#" not in below


def test_views_of_stored_terms_have_the_same_rows(spark, tables):
    """Also where terms lack line items' orders, and keys repeat or are missing."""
    terms = stored_terms(spark, tables)
    for name in VIEWS:
        found, expected = fixture(spark, tables, name, terms), fixture(spark, tables, name)
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in expected.schema]
        rows = sorted(map(repr, found.collect()))
        assert rows and rows == sorted(map(repr, expected.collect())), name


def test_line_items_of_several_views_are_put_together_once(spark, tables):
    s = Inputs(spark, tables).sources
    for df in (s.pm, s.reporting, s.rating, s.rating_sup):
        assert not [f for f in df.inputFiles() if "/lineitem.parquet/" in f]
    base = Inputs(spark, tables)
    assert base.base.count() == fixture(spark, tables, "fx_pm").count()
    assert not [f for f in base.view("fx_pm").inputFiles() if "/lineitem.parquet/" in f]
