"""The single-pass summary against branch-by-branch SQL, on rows full of gaps."""

from dataclasses import replace
from datetime import date
from decimal import Decimal

import duckdb
import pytest

from rateloom.coverages import named
from rateloom.operators.factors import attach_adjustments, attach_factors, attach_factors_by_job
from rateloom.plans.summary import pricing_summary, stat_table
from tests.small import BASE_SCHEMA, QUOTE_SCHEMA, frame, premium_row, quote_row, random_rows
from verification import oracle as o
from verification.catalog import comparable
from verification.compare import _canonical
from verification.fixtures import FIXTURE_PARAMS as P
from verification.values import summary_columns

D = Decimal


def check(got, want):
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    ours = _canonical([tuple(r) for r in comparable(got).collect()], [got.columns.index(c) for c in names])
    theirs = _canonical(want.fetchall(), [want.columns.index(c) for c in names])
    assert len(ours) == len(theirs)
    differing = {c for a, b in zip(ours, theirs) for c, x, y in zip(names, a, b) if x != y}
    assert not differing


def in_duckdb(df, schema, con, name):
    path_rows = df.toArrow()
    con.register(f"{name}_arrow", path_rows)
    con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_arrow")


@pytest.mark.parametrize("seed, nulls", [(1, "strict"), (2, "skip")])
def test_random_rows_match_branches(spark, seed, nulls):
    base_rows, quote_rows = random_rows(seed)
    base, quotes = frame(spark, BASE_SCHEMA, base_rows), frame(spark, QUOTE_SCHEMA, quote_rows)
    con = duckdb.connect()
    in_duckdb(base, BASE_SCHEMA, con, "base")
    in_duckdb(quotes, QUOTE_SCHEMA, con, "quotes")
    sql = o.summary_sql(strict=nulls == "strict", ctes=["unused AS (SELECT 1)"])
    check(pricing_summary(base, quotes, replace(P, nulls=nulls)), con.sql(sql))


def test_layout(spark):
    base = frame(spark, BASE_SCHEMA, [premium_row()])
    quotes = frame(spark, QUOTE_SCHEMA, [quote_row()])
    params = replace(P, rate_factors=("PolicyStateCode_F",))
    summary = pricing_summary(base, quotes, params)
    keys = ["TermType", "UWYear", "PolicyStateCode_F", "var4", "var5", "var6", "var7", "var8", "var9", "var10"]
    assert summary.columns == [*keys, *summary_columns()]
    assert len(summary.columns) == 365
    assert summary.columns[10:12] == ["NetPolQuotes", "PCVQ_BIQB"]
    assert summary.columns[-1] == "LOSS_RI_UMPD"
    assert pricing_summary(base, None, params).columns == summary.columns


def figures(spark, rows, names, **params):
    table = stat_table(frame(spark, BASE_SCHEMA, rows), None, replace(P, **params), names)
    return table.collect()


def test_one_missing_premium_zeroes_the_count(spark):
    rows = [premium_row(WP_BI=v) for v in (D("5.00"), None, D("7.00"))]
    assert figures(spark, rows, ["PCVS_QB"])[0].PCVS_BIQB == 0
    assert figures(spark, rows, ["PCVS_QB"], nulls="skip")[0].PCVS_BIQB == 2


def test_missing_channel_counts_in_the_total_only(spark):
    row = figures(spark, [premium_row(FinanceChannel=None, WP_BI=D("5.00"))], ["PCVS_QB", "WVS_QB", "AVS_QB", "TVS_PB"])[0]
    assert (row.PCVS_BIQB, row.WVS_BIQB, row.AVS_BIQB, row.TVS_BIPB) == (0, 0, 0, 1)


def test_sale_needs_a_whole_unit_of_premium_and_renewal_any(spark):
    rows = [premium_row(WP_BI=D("0.50")), premium_row(WP_BI=D("0.50"), TransactionType="Renewal")]
    found = {r.TermType: r for r in figures(spark, rows, ["PCVS_QB", "VGEN_QB"])}
    assert found["NB"].PCVS_BIQB == 0
    assert found["RN"].VGEN_BIQB == 1


def test_taken_renewal_with_unknown_premium(spark):
    def taken(ep):
        rows = [premium_row(TransactionType="Renewal", WP_BI=D("9.00"), EP_PD=D(ep), WP_PD=None),
                premium_row(TransactionType="Renewal", WP_BI=D("9.00"), EP_PD=D("1.00"), WP_PD=D("1.00"))]
        return figures(spark, rows, ["VREN_QB"])[0].VREN_PDQB

    assert taken("0.00") == 1
    assert taken("1.00") == 0


def test_cancellation_before_a_day_that_does_not_exist(spark):
    def cancelled(expiry):
        row = premium_row(PolicyTermStartEffDate=date(1999, 10, 30), PolicyTermExpirationEffDate=expiry,
                          CancellationDate=date(2000, 1, 10), CancelReason_F="Non-Payment")
        return figures(spark, [row], ["Cancels_NonPay", "Total1Year"])[0]

    assert tuple(cancelled(date(2001, 4, 30)))[-2:] == (0, 1)
    assert tuple(cancelled(date(2001, 4, 28)))[-2:] == (1, 1)


def test_a_time_of_day_is_cut_off(spark):
    start = date(2000, 8, 1)
    row = premium_row(EP_BI=D("1.00"), PolicyTermStartEffDate=start, CancellationDate=date(2000, 8, 4))
    base = frame(spark, BASE_SCHEMA, [row])
    later = base.selectExpr("* EXCEPT (CancellationDate)", "CAST(CancellationDate AS TIMESTAMP) + INTERVAL 10 HOURS AS CancellationDate")
    for rows in (base, later):
        assert stat_table(rows, None, P, ["CXX_ThreeDays_QB"]).first().CXX_ThreeDays_QB == 1


@pytest.mark.parametrize("name", ["EE_BI", "EP", "wp", "RowWeight"])
def test_factors_named_like_figures(spark, name):
    base = frame(spark, BASE_SCHEMA, [premium_row()])
    with pytest.raises(ValueError, match="names of figures"):
        stat_table(base, None, replace(P, rate_factors=(name,)), ["EP"])


def test_groups_seen_by_a_single_branch(spark):
    only_cancel = premium_row(PolicyTermStartEffDate=date(1999, 8, 1), PolicyTermExpirationEffDate=date(2000, 2, 1),
                              PolicyStateCode_F="cancel")
    params = replace(P, prem_loss_start="2000-07-01", rate_factors=("PolicyStateCode_F",))
    quotes = frame(spark, QUOTE_SCHEMA, [quote_row(PolicyStateCode_F="quote", WP_BI=D("3.00")), quote_row(PolicyStateCode_F=None)])
    rows = pricing_summary(frame(spark, BASE_SCHEMA, [only_cancel]), quotes, params).collect()
    found = {r.PolicyStateCode_F: r for r in rows}
    assert set(found) == {"cancel", "quote", None}
    assert (found["cancel"].Total1Year, found["cancel"].EP_BI, found["cancel"].UWYear) == (1, D("0"), 2)
    assert (found["quote"].TermType, found["quote"].PCVQ_BIQB, found["quote"].TPQ_BIQB) == ("NB", 1, 1.0)


def test_missing_factor_value_is_one_group(spark):
    rows = [premium_row(Segment_F=None, WP_BI=D("5.00")), premium_row(Segment_F=None, WP_BI=D("5.00"), FinanceChannel="Web")]
    found = figures(spark, rows, ["PCVS_QB", "WVS_QB"])
    assert [(r.PCVS_BIQB, r.WVS_BIQB) for r in found] == [(1, 1)]


def test_factors_must_be_on_both_sides(spark):
    base, quotes = frame(spark, BASE_SCHEMA, [premium_row()]), frame(spark, QUOTE_SCHEMA, [quote_row()])
    with pytest.raises(ValueError, match="PrimaryDriverGender"):
        pricing_summary(base, quotes, replace(P, rate_factors=("PrimaryDriverGender",)))
    with pytest.raises(ValueError, match="Elsewhere"):
        pricing_summary(base, quotes, replace(P, rate_factors=("Elsewhere",)))
    with pytest.raises(ValueError, match="no such figures"):
        stat_table(base, quotes, P, ["PCVS"])


def test_adjustments_match_missing_attributes(spark):
    base = frame(spark, BASE_SCHEMA, [premium_row(Segment_F=None, WP_BI=D("10.00")), premium_row(WP_BI=D("100.00"))])
    table = spark.createDataFrame([(None, 0.5)], "Segment_F string, ADJ_WP_BI double")
    adjusted = attach_adjustments(base, table, ["Segment_F"])
    rows = {r.Segment_F: r for r in stat_table(adjusted, None, P, ["ADJ_WP"]).collect()}
    assert rows[None].ADJ_WP_BI == 5.0
    assert rows["S"].ADJ_WP_BI == 0.0


def test_job_factors_count_pairs_without_writing_them(spark):
    """One job with many vehicles: V x V pairs, weighted, joined early or late."""
    vehicles = 60
    quote_rows = [quote_row(RowKey=1, VehicleKey=i, VehicleCount=vehicles, WP_BI=D("5.00"),
                            FinanceChannel=["PC", "Web", None][i % 3]) for i in range(vehicles)]
    quote_rows += [quote_row(RowKey=2, WP_BI=D("5.00")), quote_row(RowKey=3, WP_BI=D("5.00"))]
    quotes = frame(spark, QUOTE_SCHEMA, quote_rows).drop("Segment_F")
    rows = [(1, "x")] * 40 + [(1, "y")] * 19 + [(1, None), (2, "x"), (4, "x")]
    factors = spark.createDataFrame(rows, "RowKey long, Segment_F string")
    plain = quotes.join(factors, "RowKey")
    names = ["PCVQ_QB", "WVQ_QB", "AVQ_QB", "TPQ_QB"]
    want = sorted(map(str, comparable(stat_table(None, plain, P, names)).collect()))
    weighted = attach_factors_by_job(quotes, factors, ["Segment_F"])
    assert weighted.count() == 3 * vehicles + 1
    assert sorted(map(str, comparable(stat_table(None, weighted, P, names)).collect())) == want
    early = stat_table(None, quotes, P, names, quote_factors=factors)
    assert sorted(map(str, comparable(early).collect())) == want
    with pytest.raises(ValueError, match="already has"):
        attach_factors(frame(spark, QUOTE_SCHEMA, quote_rows), factors, "RowKey")


def test_plan_reads_the_base_once(spark, tmp_path):
    frame(spark, BASE_SCHEMA, [premium_row()]).write.parquet(str(tmp_path / "base"))
    frame(spark, QUOTE_SCHEMA, [quote_row()]).write.parquet(str(tmp_path / "quotes"))
    base, quotes = (spark.read.parquet(str(tmp_path / n)) for n in ("base", "quotes"))
    plan = pricing_summary(base, quotes, P)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subqueries")[0]
    scans = [line for line in main.splitlines() if "FileScan parquet" in line]
    wide = [s for s in scans if "WP_BI" in s]
    assert len(wide) == 2  # base and quotes
    assert all("RetainedAsOfDate" in s for s in scans if s not in wide)
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert any("GreaterThanOrEqual(PolicyTermStartEffDate" in s for s in wide)


def test_no_base_column_is_read_for_nothing(spark, tmp_path):
    frame(spark, BASE_SCHEMA, [premium_row()]).write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    plan = stat_table(base, None, P, ["WP_QB"])._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    schema = scan.split("ReadSchema")[1]
    assert not [c for c in [*named("EP"), *named("EE"), *named("CLEP")] if f"{c}:" in schema]


def test_retention_date_is_looked_up_or_given(spark):
    row = premium_row(PolicyTermStartEffDate=date(2000, 3, 1), RetainedAsOfDate=date(2000, 8, 1))
    assert figures(spark, [row], ["Month6Total", "Total1Year", "EP"])[0].Month6Total == 0
    assert figures(spark, [row], ["Month6Total", "EP"], retained_as_of="2001-08-01")[0].Month6Total == 1


@pytest.mark.parametrize("names, lines", [(["WP_PB", "LOSS_RI"], 1), (["TPQ_QB"], 1), (["WP_PB", "TPQ_QB"], 2)])
def test_lines_are_made_as_a_column(spark, names, lines):
    """Inside ``inline`` the expression of all lines would be walked for every row."""
    base, quotes = frame(spark, BASE_SCHEMA, [premium_row()]), frame(spark, QUOTE_SCHEMA, [quote_row()])
    plan = stat_table(base, quotes, replace(P, rate_factors=()), names)._jdf.queryExecution().optimizedPlan().toString()
    taken_apart = [row for row in plan.splitlines() if "Generate inline" in row]
    assert len(taken_apart) == lines
    assert all("Generate inline(_lines#" in row for row in taken_apart)


def test_lines_that_add_nothing_leave_the_groups_and_sums(spark):
    """A row without any amount keeps its group; one with a missing premium spoils its count; losses alone count."""
    none = {c: D(0) for c in (*named("WP"), *named("EP"), *named("CLEP"))} | {c: 0.0 for c in named("EE")}
    rows = [premium_row(**none), premium_row(**(none | {"WP_BI": None})), premium_row(**(none | {"LOSS_RI_COMP_CAT": D(7)}))]
    got = stat_table(frame(spark, BASE_SCHEMA, rows), None, replace(P, rate_factors=()), ["WP_PB", "LOSS_RI", "TVS_PB"]).collect()
    assert len(got) == 1
    assert got[0]["LOSS_RI_COMP_CAT"] >= 7 and got[0]["WP_PDPB"] == 0 and got[0]["TVS_BIPB"] == 0


@pytest.mark.parametrize("amounts", [["9999999999999999.99"] * 3, ["-9999999999999999.99", "1.01"], ["1000000.00", "-0.01", "999999.99"]])
def test_amounts_add_up_exactly_as_longs(spark, amounts):
    rows = [premium_row(WP_BI=D(a), CLEP_PD=-D(a)) for a in amounts]
    table = stat_table(frame(spark, BASE_SCHEMA, rows), None, replace(P, rate_factors=()), ["WP_PB", "CLEP"])
    assert table.schema["WP_BIPB"].dataType.simpleString() == "decimal(28,2)"
    got = table.first()
    assert got["WP_BIPB"] == sum(map(D, amounts)) and got["CLEP_PD"] == -sum(map(D, amounts)) and got["WP_COLPB"] == 0
    assert "sum(unscaledvalue(m2" in table._jdf.queryExecution().optimizedPlan().toString().lower()


def test_a_base_row_is_copied_once_before_its_lines(spark):
    """One step with keys, conditions and bits, one that makes the lines."""
    plan = stat_table(frame(spark, BASE_SCHEMA, [premium_row()]), None, P, ["WP_PB", "LOSS_RI"])._jdf.queryExecution().optimizedPlan().toString()
    above = plan[plan.index("Generate inline"):].splitlines()
    assert "_coverage_rows#" in above[1] and " AS _lines#" in above[1] and "THEN NB" in above[2]
