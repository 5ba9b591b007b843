"""Stored inputs, published results, and the plans of a staged report."""

import time
from dataclasses import fields, replace
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rateloom.operators.base import by_month, in_months
from rateloom.operators.checks import guarded_key, require_bounded_growth, worst_keys
from rateloom.operators.factors import attach_adjustments
from rateloom.operators.extracts import ColumnOwners, Factor, premium_extract
from rateloom.operators.losses import loss_by_vehicle
from rateloom.params import PricingParams
from rateloom.plans import report as report_plan
from rateloom.plans.report import FactorPlan, Sources, pricing_inputs, pricing_report, rated_premium, stored_rated_premium
from rateloom.plans.branches import ALL_STATS, QUOTE_STATS
from rateloom.plans.summary import premium_lines, pricing_summary, reach, stat_table
from rateloom.sources.sinks import positioned_by_keys, publish_result, read_result, run_label
from rateloom.sources.store import Store, source_state
from tests.small import BASE_SCHEMA, frame, premium_row, random_rows
from verification.catalog import REPORT_PARAMS, REPORT_PLAN, Inputs, comparable
from verification.fixtures import EXTRACT_FLOOR

SF = "/root/testdata/sf0.001"
PLAN = replace(REPORT_PLAN, accept_growth=True)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """The seven tables as files of their own, some 60 orders of them."""
    folder = tmp_path_factory.mktemp("sources")
    given = Inputs(spark, SF).sources
    tables = {}
    for f in fields(Sources):
        df = getattr(given, f.name)
        key = "PolicyTermKey" if "PolicyTermKey" in df.columns else "JobID" if "JobID" in df.columns else "QuoteVersionKey"
        df.where(F.col(key) % 25 == 1).coalesce(1).write.parquet(str(folder / f.name))
        tables[f.name] = spark.read.parquet(str(folder / f.name))
    return Sources(**tables), folder


def rows(df):
    return sorted(map(str, comparable(df).collect()))


def run(sources, **more):
    return pricing_report(sources, REPORT_PARAMS, PLAN, history_start=EXTRACT_FLOOR, **more)[1]


def plan_of(df):
    return executed_plan(df).toString()


def files_of(df):
    """The folder that each scan of the plan reads."""
    leaves = executed_plan(df).collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return [leaf.relation().location().rootPaths().mkString(",") for leaf in found if leaf.nodeName().startswith("Scan parquet")]


def executed_plan(df):
    """The physical plan with neither broadcast joins nor changes at run time."""
    spark = df.sparkSession
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_later_run_reads_only_what_is_stored(spark, sources, tmp_path, monkeypatch):
    tables, folder = sources
    store = Store(spark, str(tmp_path / "store"))
    first = rows(run(tables, store=store))
    assert first == rows(run(tables))

    def never(*_, **__):
        raise AssertionError("extracted again")

    with monkeypatch.context() as patched:
        for name in ("rated_premium", "quoted_vehicles", "premium_loss_base"):
            patched.setattr(report_plan, name, never)
        again = run(tables, store=store)
    assert rows(again) == first
    assert {Path(f.removeprefix("file:")).relative_to(tmp_path).parts[0] for f in again.inputFiles()} == {"store"}
    assert len(store.entries()) == 1

    with pytest.raises(AssertionError, match="extracted again"), monkeypatch.context() as patched:
        patched.setattr(report_plan, "rated_premium", never)
        pricing_report(tables, REPORT_PARAMS, replace(PLAN, quote_constants={"TermNumber": 2}), history_start=EXTRACT_FLOOR, store=store)


def test_a_changed_source_is_pulled_again_and_a_crash_leaves_the_old_tables(spark, sources, tmp_path, monkeypatch):
    tables, folder = sources
    path = str(tmp_path / "losses")
    tables.losses.write.parquet(path)
    changing = replace(tables, losses=spark.read.parquet(path))
    store = Store(spark, str(tmp_path / "store"))
    before = rows(run(changing, store=store))

    extra = tables.losses.limit(3).withColumn("ClaimNumber", F.lit(-1).cast("long"))
    extra.write.mode("append").parquet(path)
    changed = replace(tables, losses=spark.read.parquet(path))
    write = Store.write

    def dies(self, df, table, *args, **kwargs):
        if table == "quote_base":
            raise OSError("lost")
        return write(self, df, table, *args, **kwargs)

    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(Store, "write", dies)
        run(changed, store=store)
    assert len(store.entries()) == 1 and rows(store.find("pricing inputs").read("premium_base").limit(1))
    run(changed, store=store)
    assert len(store.entries()) == 2
    left = store.clean(timedelta(0))
    assert len(left) == 1 and "premium_base" in left[0] and store.clean(timedelta(0)) == []
    assert before == rows(run(changing, store=store)) or len(store.entries()) == 3


def test_tables_without_files_need_a_version(spark):
    made = spark.range(3)
    assert source_state(made) is None and source_state(made, "1") != source_state(made, "2")
    assert source_state(spark.range(3), "1") == source_state(made, "1") != source_state(spark.range(4), "1")


def test_dates_are_observed_while_the_premium_is_written(spark, sources):
    tables, _ = sources
    rated = rated_premium(tables, PLAN, EXTRACT_FLOOR)
    stored, dates = stored_rated_premium(Store.temporary(spark), rated)
    premium = premium_extract(tables.pm, tables.reporting, EXTRACT_FLOOR)
    assert dates["earned"] == premium.agg(F.max("EarnedAsOfDate")).first()[0]
    assert dates["retained"] == stored.agg(F.max("RetainedAsOfDate")).first()[0] is not None
    nothing = replace(tables, rating=tables.rating.limit(0))
    stored, dates = stored_rated_premium(Store.temporary(spark), rated_premium(nothing, PLAN, EXTRACT_FLOOR))
    assert stored.count() == 0 and dates["earned"] is not None and dates["retained"] is None
    nobody = replace(tables, pm=tables.pm.limit(0))
    assert stored_rated_premium(Store.temporary(spark), rated_premium(nobody, PLAN, EXTRACT_FLOOR))[1]["earned"] is None


def test_scans_and_joins_of_a_report(spark, sources, monkeypatch):
    tables, folder = sources
    read, joins = [], []
    write = Store.write

    def note(df):
        read.extend(files_of(df))
        joins.append(plan_of(df).count("SortMergeJoin"))

    def noted(self, df, table, *args, **kwargs):
        note(df)
        return write(self, df, table, *args, **kwargs)

    monkeypatch.setattr(Store, "write", noted)
    note(run(tables))
    by_table = {f.name: sum(path.endswith(f"{folder}/{f.name}") for path in read) for f in fields(Sources)}
    assert by_table == {"pm": 2, "reporting": 3, "losses": 1, "ibnr": 1, "rating": 2, "rating_sup": 2, "dim_quote": 1}
    assert len(read) == 15  # and the stored premium once, the quoted vehicles twice
    assert sum(joins) <= 12


def test_repeated_keys_fail_the_job_that_meets_them(spark, sources):
    tables, _ = sources
    assert guarded_key(tables.ibnr, "VehicleTermKey", "IBNR").count() == tables.ibnr.count()
    twice = replace(tables, ibnr=tables.ibnr.union(tables.ibnr.limit(1)))
    with pytest.raises(Exception, match="IBNR: key VehicleTermKey repeats, for example"):
        run(twice).collect()
    both = replace(tables, reporting=tables.reporting.union(tables.reporting.where("BoundIndicator = 1").limit(1)))
    with pytest.raises(Exception, match="key VehicleTermKey repeats"):
        run(both)
    assert pricing_inputs(both, PLAN, EXTRACT_FLOOR, check_keys=False).base.count() > 0


def test_a_join_that_grows_too_far_names_its_keys(spark, sources):
    tables, _ = sources
    unbound = replace(tables, reporting=tables.reporting.withColumn("BoundIndicator", F.lit(0)))
    with pytest.raises(ValueError, match="join of quotes and their factors: .* most by RowKey"):
        pricing_report(unbound, REPORT_PARAMS, REPORT_PLAN, history_start=EXTRACT_FLOOR)
    by_vehicle = replace(REPORT_PLAN, quote_key=["RowKey", "VehicleKey"])
    pricing_report(unbound, REPORT_PARAMS, by_vehicle, history_start=EXTRACT_FLOOR)
    left = spark.createDataFrame([(1,)] * 4 + [(2,)] * 3 + [(None,)], "k int")
    assert [tuple(r) for r in worst_keys(left, left, "k").collect()] == [(1, 16), (2, 9)]
    with pytest.raises(ValueError, match=r"\(1, 16\), \(2, 9\)"):
        require_bounded_growth(left, left, "k", "x")
    require_bounded_growth(left, spark.createDataFrame([(1,), (2,)], "k int"), "k", "x")


def test_claims_move_twice(spark, sources):
    assert plan_of(loss_by_vehicle(sources[0].losses)).count("Exchange hashpartitioning") == 2


def test_only_the_months_of_the_windows_are_read(spark, tmp_path):
    base = frame(spark, BASE_SCHEMA, random_rows(3)[0]).withColumn(
        "PolicyTermExpirationEffDate", F.expr("IF(VehicleTermKey = 7, PolicyTermStartEffDate - 5, PolicyTermExpirationEffDate)"))
    params = replace(REPORT_PARAMS, rate_factors=("PolicyStateCode_F",), prem_loss_start="2000-07-01")
    want = rows(pricing_summary(base, None, params))
    _, stored = Store(spark, str(tmp_path)).write(by_month(base), "base", partition_by=["StartMonth"])
    summary = pricing_summary(stored, None, replace(params, retained_as_of="2001-06-15"))
    assert "PartitionFilters: [(isnull(StartMonth" in plan_of(summary)
    months = sorted(p.name for p in Path(tmp_path).glob("data/*/StartMonth=*"))
    assert "StartMonth=__HIVE_DEFAULT_PARTITION__" in months and "StartMonth=199706" in months
    for part in Path(tmp_path).glob("data/*/StartMonth=19970[6-9]/*.parquet"):
        part.write_bytes(b"not a table")  # unreadable, and not read
    assert rows(summary) == want
    assert in_months(base, params.earliest_start, params.end) is base


def test_results_are_published_together_and_once(spark, tmp_path, monkeypatch):
    page, summary = spark.range(2).withColumnRenamed("id", "position"), spark.range(5)
    out = str(tmp_path)
    assert read_result(spark, out) is None
    entry = publish_result({"facts": page, "summary": summary}, out, "a")
    assert entry.read("summary").count() == 5 and read_result(spark, out, "a").entry == entry.entry
    with pytest.raises(FileExistsError):
        publish_result({"facts": page}, out, "a")
    write = Store.write

    def dies(self, df, table, *args, **kwargs):
        if table == "summary":
            raise OSError("lost")
        return write(self, df, table, *args, **kwargs)

    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(Store, "write", dies)
        publish_result({"facts": page, "summary": summary}, out, "b")
    assert read_result(spark, out, "b") is None and read_result(spark, out).name == "a"
    assert publish_result({"facts": page, "summary": summary}, out, "b", "csv").read("facts").count() == 2
    assert len({run_label("me") for _ in range(20)}) == 20


def test_one_of_several_writers_publishes_a_name(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    table = {"t": store.write(spark.range(3), "t")}
    first = store.publish("run", table, once=True)
    with monkeypatch.context() as patched:
        patched.setattr(Store, "find", lambda self, *args: None)  # as one sees it that looked before the other was done
        patched.setattr(Store, "entries", lambda self, *args: [])
        with pytest.raises(FileExistsError):
            store.publish("run", table, once=True)
    assert [e.entry for e in store.entries("run")] == [first.entry]
    assert store.publish("other", table).name == store.publish("other", table).name  # names without a claim can come again


def test_a_name_whose_writer_failed_can_be_published(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    table = {"t": store.write(spark.range(3), "t")}
    (tmp_path / "manifest").write_text("in the way")
    with pytest.raises(Exception):
        store.publish("run", table, once=True)
    (tmp_path / "manifest").unlink()
    store.publish("run", table, once=True)
    store._claim("died")  # a writer that is gone without a word
    with pytest.raises(FileExistsError):
        store.publish("died", table, once=True)
    assert [p.rsplit("/", 2)[-2] for p in store.clean(timedelta(0))] == ["claims"]
    assert store.publish("died", table, once=True).read("t").count() == 3


def test_positions_follow_the_keys(spark, tmp_path):
    made = spark.range(500).selectExpr("CAST(id * 7919 % 500 AS INT) AS k", "IF(id % 3 = 0, NULL, id) AS f").repartition(7)
    got = positioned_by_keys(made, ["f", "k"], Store(spark, str(tmp_path))).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 501))
    keys = [(r.f is not None, r.f or 0, r.k) for r in got]
    assert keys == sorted(keys)
    assert positioned_by_keys(made.limit(0), ["k"], Store(spark, str(tmp_path))).count() == 0


def test_columns_without_a_table_belong_to_the_one_that_has_them(spark, sources):
    tables, _ = sources
    moved = ["TermType", "MaxLoadDate", "Retained6Months", "CancellationDate"]
    there = tables.reporting.join(tables.pm.select("VehicleTermKey", *moved), "VehicleTermKey")
    want = premium_extract(tables.pm, tables.reporting, EXTRACT_FLOOR)
    assert rows(premium_extract(tables.pm.drop(*moved), there, EXTRACT_FLOOR).select(want.columns)) == rows(want)
    with pytest.raises(ValueError, match="TermType is ambiguous"):
        premium_extract(tables.pm, there, EXTRACT_FLOOR)
    with pytest.raises(ValueError, match="CancelReason_F"):
        premium_extract(tables.pm.drop("CancelReason_F"), tables.reporting, EXTRACT_FLOOR)
    owners = ColumnOwners(a=spark.range(1), b=spark.range(1).selectExpr("id AS x"))
    assert (owners.of("X"), owners.find("y")) == ("b.X", None)


def test_factors_made_by_functions(spark, sources):
    from rateloom.functions.recode import band, one_against_rest

    chosen = [Factor("Gap", band, source="AgeDifference"), Factor("State", lambda c: one_against_rest(c, "NATION_3"), "reporting", "PolicyStateCode_F")]
    params = replace(REPORT_PARAMS, rate_factors=("Gap", "State"))
    summary = pricing_report(sources[0], params, FactorPlan(chosen, chosen, accept_growth=True), history_start=EXTRACT_FLOOR)[1]
    assert {r.State for r in summary.collect()} <= {"NATION_3", "CW"} and summary.where("Gap LIKE 'z)%'").count()


def test_half_of_all_rows_under_one_tuple(spark):
    rows = spark.range(40_000).selectExpr(
        "id AS VehicleTermKey", "CAST(IF(id % 2 = 0, NULL, id % 997) AS INT) AS PrimAge", "IF(id % 2 = 0, 'M', 'F') AS PrimGen")
    table = spark.range(997).selectExpr("CAST(id AS INT) AS PrimAge", "'F' AS PrimGen", "id / 10 AS ADJ_WP_BI").union(
        spark.sql("SELECT CAST(NULL AS INT), 'M', 7.0D"))
    key = ("PrimAge", "PrimGen")
    small, large = attach_adjustments(rows, table, key), attach_adjustments(rows, table, key, broadcast_rows=100)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert rows_of(small) == rows_of(large) and small.where("PrimAge IS NULL AND ADJ_WP_BI = 7").count() == 20_000
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        again = attach_adjustments(rows, table, key, broadcast_rows=100)
        sizes = sorted(r["count"] for r in again.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_idle_coverages_are_not_written(spark):
    """With a key that every term has its own value of, a group has few lines, and moves no more than those."""
    base = frame(spark, BASE_SCHEMA, [
        premium_row(VehicleTermKey=i, PolicyTermKey=i, WP_BI=Decimal("5.00"), EP_BI=Decimal("1.00"), EP_TOTAL=Decimal("1.00")) for i in range(50)])
    params = replace(REPORT_PARAMS, rate_factors=("PolicyTermKey",))
    lines = premium_lines(base, params, [s for s in ALL_STATS if s not in QUOTE_STATS])
    by_row = lines.groupBy("PolicyTermKey").agg(F.collect_set("_line").alias("lines")).collect()
    assert len(by_row) == 50 and all(set(r.lines) == {"BI", "V1", "V2"} for r in by_row)
    nothing = frame(spark, BASE_SCHEMA, [premium_row()])
    assert stat_table(nothing, None, replace(params, rate_factors=()), ["WP_PB"]).count() == 1


def test_a_run_without_a_store_keeps_the_rows_in_reach_and_the_dates_of_all(spark, tmp_path):
    params = PricingParams(prem_loss_start="2016-09-30", end="2019-09-30", sale_quote_start="2018-09-30", renewal_start="2018-09-30")
    schema = "VehicleTermKey long, PolicyTermStartEffDate date, PolicyTermExpirationEffDate date, EarnedAsOfDate date, RetainedAsOfDate date, _rated boolean"
    day = date.fromisoformat
    rows = [
        (1, day("2017-01-01"), day("2017-07-01"), day("2019-01-01"), day("2019-01-01"), True),
        (2, day("2010-01-01"), day("2010-07-01"), day("2019-02-01"), day("2019-02-01"), True),
        (3, day("2017-01-01"), day("2017-07-01"), day("2019-03-01"), day("2019-03-01"), None),
        (4, day("2019-09-30"), day("2020-03-30"), None, None, True),
        (5, day("2019-10-30"), day("2019-01-30"), None, None, True),
        (6, None, day("2017-07-01"), None, None, True),
    ]
    stored, latest = stored_rated_premium(Store(spark, str(tmp_path)), spark.createDataFrame(rows, schema), reach(params))
    assert sorted(r["VehicleTermKey"] for r in stored.collect()) == [1, 5]
    assert latest == {"earned": day("2019-03-01"), "retained": day("2019-02-01")}


def test_bucketed_rows_join_without_moving_and_leave_no_table(spark, tmp_path):
    made = spark.range(1000).selectExpr("id AS k", "id * 2 AS a")
    before = {t.name for t in spark.catalog.listTables()}
    folder, stored = Store(spark, str(tmp_path)).write(made, "t", bucket_by="k")
    assert {t.name for t in spark.catalog.listTables()} == before
    joined = stored.join(spark.range(0, 2000, 2).selectExpr("id AS k", "id AS b"), "k")
    assert plan_of(joined).count("Exchange hashpartitioning") == 1
    assert rows_of(joined) == rows_of(made.where("k % 2 = 0").selectExpr("k", "a", "k AS b"))
    assert spark.read.parquet(folder).count() == 1000
    assert Store(spark, str(tmp_path)).write(made.limit(0), "t", bucket_by="k")[1].count() == 0


def test_what_a_stored_table_shuffled_is_removed(spark, tmp_path):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {b.name() for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllBlocks()) if b.isShuffle()}

    before, settings = shuffled(), dict(spark.sparkContext._conf.getAll())
    Store(spark, str(tmp_path)).write(spark.range(1000).repartition("id"), "t")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert dict(spark.sparkContext._conf.getAll()) == settings


def test_capped_losses_are_made_after_the_move_by_month(spark, sources, tmp_path, monkeypatch):
    moved = []
    monkeypatch.setattr(report_plan, "by_month", lambda base: moved.append(base.columns) or by_month(base))
    store = Store(spark, str(tmp_path))
    run(sources[0], store=store)
    assert len(moved) == 1 and "LOSS_RI_BI" in moved[0] and not [c for c in moved[0] if c.startswith(("LOSS_25_", "LOSS_100_"))]
    base = store.entries()[-1].read("premium_base")
    losses = base.where("LOSS_RI_COMP > 0").selectExpr("LOSS_25_COMP <=> least(LOSS_RI_COMP, 25000) AND LOSS_100_COMP <=> least(LOSS_RI_COMP, 100000)")
    assert losses.count() and all(r[0] for r in losses.collect())


def test_rows_out_of_reach_come_without_amounts(spark, sources):
    tables, _ = sources
    wanted = "PolicyTermStartEffDate >= DATE'1999-01-01' AND PolicyTermExpirationEffDate < DATE'2001-07-01'"
    full = premium_extract(tables.pm, tables.reporting, EXTRACT_FLOOR)
    lean = premium_extract(tables.pm, tables.reporting, EXTRACT_FLOOR, wanted)
    assert lean.columns == full.columns and rows(lean.where(wanted)) == rows(full.where(wanted)) != []
    keys = ["VehicleTermKey", "PolicyTermStartEffDate", "PolicyTermExpirationEffDate", "EarnedAsOfDate", "PrimaryDriverAge"]
    out = f"NOT ({wanted})"
    assert rows(lean.where(out).select(keys)) == rows(full.where(out).select(keys)) != []
    assert lean.where(out).where("coalesce(WP_BI, CLEP_BI, EE_BI, TermType, TransactionJobID) IS NOT NULL").count() == 0


def test_a_run_without_a_store_keeps_what_its_figures_need(spark, sources, monkeypatch):
    kept, write = {}, Store.write

    def noted(self, df, table, *args, **kwargs):
        folder, kept[table] = write(self, df, table, *args, **kwargs)
        return folder, kept[table]

    monkeypatch.setattr(Store, "write", noted)
    run(sources[0])
    assert not {"OrigCorePolicyNumber", "CorePolicyNumber", "TransactionDateTime"} & set(kept["rated_premium"].columns)
    start, end = REPORT_PARAMS.sale_quote_start, REPORT_PARAMS.end
    inside = f"QuoteVersionDateTime >= DATE'{start}' AND QuoteVersionDateTime < DATE'{end}'"
    vehicles = kept["quoted_vehicles"]
    assert vehicles.where(inside).where("WP_BI IS NOT NULL AND QuoteID IS NOT NULL").count() > 0
    assert vehicles.where(f"NOT ({inside})").count() > 0 == vehicles.where(f"NOT ({inside})").where("WP_BI IS NOT NULL OR QuoteID IS NOT NULL").count()
    with pytest.raises(ValueError, match="keeps all"):
        pricing_inputs(sources[0], PLAN, EXTRACT_FLOOR, store=Store.temporary(spark), quoted="false")
