from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from rateloom.plans.facts import facts, facts_row
from rateloom.operators.extracts import Factor, premium_factors
from rateloom.plans.report import pricing_report
from rateloom.sources.sinks import read_result, run_label, snapshot_table, sorted_by_keys
from rateloom.sources.tables import read_table
from verification.catalog import ORACLE, QUERIES, REPORT_PARAMS, REPORT_PLAN, Inputs
from verification.compare import compare, oracle_connection
from verification.fixtures import EXTRACT_FLOOR, FIXTURE_PARAMS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", [
    "loss_extract", "quote_extract", "loss_asof", "loss_ibnr_keep_orphans", "attach_factors_quote", "fanout_check",
    "retention_6m", "full_outer_stats", "summary_no_quotes", "facts",
])
def test_query_matches_oracle(spark, oracle, name):
    ok, note = compare(spark, oracle, name, QUERIES[name], ORACLE[name], SF)
    assert ok, note


def test_factors_with_expressions(spark):
    s = Inputs(spark, SF).sources
    limit = Factor("Limit", "upper(Limit_BI)", "rating")
    assert premium_factors(s.reporting, s.rating, s.rating_sup, [limit, "Segment_F"]).columns == ["VehicleTermKey", "Limit", "Segment_F"]
    both = s.rating.selectExpr("*", "'x' AS Segment_F")
    with pytest.raises(ValueError, match="more than one"):
        premium_factors(s.reporting, both, s.rating_sup, ["Segment_F"])
    owned = premium_factors(s.reporting, both, s.rating_sup, [Factor("Segment_F", owner="rating")])
    assert {r.Segment_F for r in owned.select("Segment_F").distinct().collect()} == {"x"}
    with pytest.raises(ValueError, match="owner"):
        premium_factors(s.reporting, s.rating, s.rating_sup, [Factor("Limit", "upper(Limit_BI)")])


def test_report_writes_summary_and_facts(spark, tmp_path):
    sources = Inputs(spark, SF).sources
    page, summary = pricing_report(
        sources, REPORT_PARAMS, replace(REPORT_PLAN, accept_growth=True), out=str(tmp_path), run_id="r1", history_start=EXTRACT_FLOOR)
    stored = read_result(spark, str(tmp_path), "r1").read("summary")
    assert stored.columns == summary.columns
    assert stored.count() == summary.count() > 100
    assert summary.inputFiles() and all(str(tmp_path) in f for f in summary.inputFiles())
    values = [r.value for r in page.orderBy("position").collect()]
    assert values == ["01JUL98 - 01JUL01", "01JUL00 - 01JUL01", "TermType", "UWYear",
                      "Segment_F", "Limit_BI", "PriorBILimit_F", "TermNumber", "var7", "var8", "var9", "var10"]


def test_facts_page_as_a_row(spark):
    row = facts_row(facts(spark, replace(FIXTURE_PARAMS, rate_factors=()))).first()
    assert (row.fact1, row.fact3, row.fact12) == ("01JUL98 - 01JUL01", "TermType", "var10")


def test_sources_and_sinks(spark, tmp_path):
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "t"))
    assert read_table(spark, "Other", str(tmp_path / "t")).count() == 3
    with pytest.raises(ValueError, match="lacks columns"):
        read_table(spark, "TransactionLoss", str(tmp_path / "t"))
    rows = spark.createDataFrame([(2, "a"), (1, None), (1, "b")], "k int, f string")
    assert [tuple(r) for r in sorted_by_keys(rows, ["k", "f"]).collect()] == [(1, None), (1, "b"), (2, "a")]
    assert run_label("me").startswith("pm_me_")
    spark.sql("DROP TABLE IF EXISTS rateloom_buckets")
    table = snapshot_table(rows, "rateloom_buckets", "k", 4)
    joined = table.hint("merge").join(table.withColumnRenamed("f", "g"), "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE rateloom_buckets")
