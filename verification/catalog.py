"""Every registered query with its oracle SQL."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateloom.coverages import IBNR_COVERAGES, LOSS_COVERAGES, PREMIUM_COVERAGES, named
from rateloom.functions.dates import day_label, lookback_year, minus_months_or_null
from rateloom.functions.recode import band, channel, one_against_rest, term_type, transaction_type
from rateloom.operators import base as base_ops
from rateloom.operators import checks, extracts, factors, losses
from rateloom.operators.extracts import Factor
from rateloom.plans import facts as facts_plan
from rateloom.plans.branches import ALL_STATS, NUMBER_SLOTS
from rateloom.plans.report import FactorPlan, Sources, pricing_report
from rateloom.plans.summary import pricing_summary, stat_table
from rateloom.sources.sinks import positioned_by_keys
from rateloom.sources.store import Store
from verification import oracle as o
from verification.fixtures import EXTRACT_FLOOR, FIXTURE_PARAMS, fixture, stored_terms, view_ctes

P = FIXTURE_PARAMS
REPORT_FACTORS = o.FACTOR_COLUMNS
QUERIES = {}
ORACLE = {}


#: Places that sums of fractions are compared to: the order of addition shows in the last digits.
_PLACES = {c: 4 if c.startswith("ADJ_WP") else 6 for s in ALL_STATS if s.slot in NUMBER_SLOTS for c in s.columns}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that both engines report one type; sums of fractions without their last digits."""
    columns = []
    for f in df.schema.fields:
        sql = f"`{f.name}`"
        if isinstance(f.dataType, T.DecimalType):
            sql = f"CAST({sql} AS DOUBLE) AS {sql}"
        elif f.name in _PLACES and isinstance(f.dataType, T.DoubleType):
            sql = f"round({sql}, {_PLACES[f.name]}) AS {sql}"
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            sql = f"CAST({sql} AS STRING) AS {sql}"
        columns.append(sql)
    return df.selectExpr(*columns)


def query(name, sql):
    def register(build):
        QUERIES[name] = lambda spark, sf_dir: comparable(build(Inputs(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


class Inputs:
    """Engine inputs derived from the tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str, views: dict[str, DataFrame] | None = None):
        self.spark, self.sf_dir, self._views = spark, sf_dir, dict(views or {})

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            self._views[name] = fixture(self.spark, self.sf_dir, name)
        return self._views[name]

    @cached_property
    def terms(self):
        return stored_terms(self.spark, self.sf_dir)

    def view_of_terms(self, name: str) -> DataFrame:
        """A view where several that are built from policy terms are read: the terms are stored first, once."""
        if name not in self._views:
            self._views[name] = fixture(self.spark, self.sf_dir, name, self.terms)
        return self._views[name]

    @cached_property
    def premium(self):
        return extracts.standardise_premium(self.view("fx_pm"))

    @property
    def losses(self):
        return extracts.loss_extract(self.view("fx_loss"))

    @property
    def losses_cut(self):
        return losses.losses_as_of(self.losses, self.premium)

    @property
    def ibnr(self):
        return extracts.ibnr_extract(self.view("fx_ibnr"))

    @property
    def base(self):
        self.view_of_terms("fx_pm")  # the base reads the premium twice, for the latest earned date first
        return base_ops.premium_loss_base(self.premium, self.losses, self.ibnr, keep=("Segment_F",))

    @property
    def quotes(self):
        kept = extracts.kept_quote_versions(self.view("fx_quote"), EXTRACT_FLOOR, "QuoteVersionDate")
        return extracts.standardise_quotes(kept)

    @cached_property
    def sources(self):
        names = ("src_pm", "src_reporting", "src_loss", "fx_ibnr", "src_rating", "src_rating_sup", "src_dim_quote")
        return Sources(*[self.view_of_terms(v) for v in names])

    @property
    def source_quotes(self):
        s = self.sources
        return extracts.quote_extract(s.pm, s.reporting, s.rating, s.rating_sup, s.dim_quote, EXTRACT_FLOOR)

    @property
    def source_premium(self):
        return extracts.premium_extract(self.sources.pm, self.sources.reporting, EXTRACT_FLOOR)

    @property
    def premium_factors(self):
        s = self.sources
        return extracts.premium_factors(s.reporting, s.rating, s.rating_sup, list(REPORT_FACTORS))

    @property
    def quote_factors(self):
        s = self.sources
        fetched = [f for f in REPORT_FACTORS if f != "TermNumber"]
        return extracts.quote_factors(s.reporting, s.rating, s.rating_sup, s.dim_quote, fetched,
                                      {"TermNumber": 1}, EXTRACT_FLOOR)


def _text(*names):
    return [f"CAST({n} AS VARCHAR) AS {n}" for n in names]


def _doubles(names):
    return [f"CAST({n} AS DOUBLE) AS {n}" for n in names]


# ---------------------------------------------------------------- extracts

_PREMIUM_DATES = ("PolicyTermStartEffDate", "PolicyTermExpirationEffDate", "TransactionDateTime",
                  "CancellationDate", "EarnedAsOfDate", "RetainedAsOfDate")
_PREMIUM_MONEY = ["WP_Total", "EP_TOTAL", *named("WP"), *named("EP"), *named("CLEP")]


def _replaced(select_sql, dates, money):
    cells = [f"CAST({n} AS VARCHAR) AS {n}" for n in dates] + [f"CAST({n} AS DOUBLE) AS {n}" for n in money]
    return f"SELECT * REPLACE ({', '.join(cells)}) FROM ({select_sql})"


@query("premium_extract", o.with_(view_ctes(*o.SRC_PREMIUM_VIEWS),
                                  _replaced(o.src_premium_select(), _PREMIUM_DATES, _PREMIUM_MONEY)))
def _(i):
    return i.source_premium


@query("loss_extract", o.with_(view_ctes("src_loss"), """SELECT VehicleTermKey, PolicyTermKey, ClaimNumber,
 CAST(TransactionDate AS VARCHAR) AS TransactionDate,
 CASE WHEN CatastropheKey <> 1 AND CoverageType='Comprehensive' THEN 'COMP_CAT' ELSE CoverageType END AS CoverageType,
 CAST(NetPaidClaims AS DOUBLE) AS NetPaidClaims, CAST(NetCaseReserves AS DOUBLE) AS NetCaseReserves, CatastropheKey FROM src_loss"""))
def _(i):
    return extracts.loss_extract(i.view("src_loss"))


@query("ibnr_extract", o.with_(view_ctes("fx_ibnr"), "SELECT VehicleTermKey, PolicyTermKey, "
                               + ", ".join(_doubles(named("IBNR", IBNR_COVERAGES))) + " FROM fx_ibnr"))
def _(i):
    return i.ibnr


@query("quote_extract", o.with_(view_ctes(*o.SRC_QUOTE_VIEWS),
                                _replaced(o.src_quote_select(), ["QuoteVersionDate"], named("WP"))))
def _(i):
    return i.source_quotes


# ---------------------------------------------------------------- scalar recodes over whole tables

@query("channel_map", o.with_(view_ctes("fx_pm"), f"""SELECT VehicleTermKey, {o.channel('FinanceChannel_F')} AS FinanceChannel FROM fx_pm"""))
def _(i):
    return i.view("fx_pm").select("VehicleTermKey", channel(F.col("FinanceChannel_F")).alias("FinanceChannel"))


@query("term_type", o.with_([*view_ctes("fx_pm"), f"relabelled AS (SELECT * REPLACE ({o.RELABEL} AS TransactionType) FROM fx_pm)"],
                            f"SELECT VehicleTermKey, TransactionType, {o.TERM_TYPE} AS TermType FROM relabelled"))
def _(i):
    relabelled = transaction_type(F.col("TransactionType"))
    return i.view("fx_pm").select("VehicleTermKey", relabelled.alias("TransactionType"),
                                  term_type(F.col("TermType"), relabelled).alias("TermType"))


@query("lookback_year", f"""SELECT o_orderkey, CAST({o.lookback('o_orderdate')} AS INTEGER) AS UWYear FROM orders""")
def _(i):
    orders = i.spark.read.parquet(f"{i.sf_dir}/orders.parquet")
    return orders.select("o_orderkey", lookback_year(F.col("o_orderdate"), P.end).alias("UWYear"))


@query("months_back", """SELECT o_orderkey, CAST(CASE WHEN day(CAST(o_orderdate - INTERVAL 2 MONTH AS DATE)) = day(o_orderdate)
 THEN CAST(o_orderdate - INTERVAL 2 MONTH AS DATE) END AS VARCHAR) AS same_day,
 CAST(CAST(o_orderdate - INTERVAL 6 MONTH AS DATE) AS VARCHAR) AS clamped FROM orders""")
def _(i):
    day = F.col("o_orderdate").cast("date")
    orders = i.spark.read.parquet(f"{i.sf_dir}/orders.parquet")
    return orders.select("o_orderkey", minus_months_or_null(day, 2).alias("same_day"), F.add_months(day, -6).alias("clamped"))


# Bands of the difference between two drivers' ages.
_BANDS = """CASE WHEN a IS NULL THEN 'z) Single Driv' WHEN a < -25 THEN 'a) Less than -25' WHEN a BETWEEN -25 AND -13 THEN 'b) -25 to -13'
 WHEN a BETWEEN -12 AND -8 THEN 'c) -12 to -8' WHEN a BETWEEN -7 AND -6 THEN 'd) -7 to -6' WHEN a BETWEEN -5 AND -4 THEN 'e) -5 to -4'
 WHEN a BETWEEN -3 AND -2 THEN 'f) -3 to -2' WHEN a BETWEEN -1 AND 0 THEN 'g) -1 to 0' WHEN a BETWEEN 1 AND 2 THEN 'h) 1 to 2'
 WHEN a BETWEEN 3 AND 5 THEN 'i) 3 to 5' WHEN a BETWEEN 6 AND 7 THEN 'j) 6 to 7' WHEN a BETWEEN 8 AND 12 THEN 'k) 8 to 12'
 WHEN a BETWEEN 13 AND 25 THEN 'l) 13 to 25' WHEN a >= 26 THEN 'm) More than 25' END"""


@query("band_factor", o.with_(view_ctes("src_rating", "src_pm"), f"""SELECT VehicleFixedID, {_BANDS} AS YNP_Group,
 CASE WHEN state='NATION_3' THEN 'NATION_3' ELSE 'CW' END AS State FROM
 (SELECT r.VehicleFixedID, r.AgeDifference AS a, p.state FROM src_rating r JOIN src_pm p ON r.VehicleFixedID=p.VehicleFixedID AND r.JobID=p.JobID)"""))
def _(i):
    s = i.sources
    rows = s.rating.select(*extracts.VEHICLE_KEY, "AgeDifference").join(
        s.pm.select(*extracts.VEHICLE_KEY, "state"), extracts.VEHICLE_KEY)
    return rows.select("VehicleFixedID", band(F.col("AgeDifference")).alias("YNP_Group"),
                       one_against_rest(F.col("state"), "NATION_3").alias("State"))


@query("date_label", "SELECT upper(strftime(o_orderdate, '%d%b%y')) AS day, count(*) AS orders FROM orders GROUP BY 1")
def _(i):
    orders = i.spark.read.parquet(f"{i.sf_dir}/orders.parquet")
    return orders.groupBy(day_label(F.col("o_orderdate")).alias("day")).agg(F.count(F.lit(1)).alias("orders"))


# ---------------------------------------------------------------- losses and base

_LOSS = [*view_ctes("fx_pm", "fx_loss", "fx_ibnr"), o.premium_cte(), *o.loss_ctes()]
_PIVOT = [*_LOSS, o.pivot_cte()]
_RI, _CC = named("LOSS_RI", LOSS_COVERAGES), named("LOSS_CC", LOSS_COVERAGES)
_CAPPED = named("LOSS_25", LOSS_COVERAGES) + named("LOSS_100", LOSS_COVERAGES)


def _counts(names):
    return [f"CAST({n} AS BIGINT) AS {n}" for n in names]


@query("loss_asof", o.with_(_LOSS, "SELECT VehicleTermKey, ClaimNumber, CAST(TransactionDate AS VARCHAR) AS TransactionDate, CoverageType FROM loss1"))
def _(i):
    return i.losses_cut.select("VehicleTermKey", "ClaimNumber", "TransactionDate", "CoverageType")


@query("loss_summary", o.with_(_LOSS, "SELECT VehicleTermKey, Coverage, CAST(LOSS_RI AS DOUBLE) AS LOSS_RI, CAST(LOSS_CC AS BIGINT) AS LOSS_CC FROM loss_sum"))
def _(i):
    return losses.loss_summary(i.losses_cut)


@query("loss_total_claims", o.with_(_LOSS, "SELECT VehicleTermKey, CAST(LOSS_CC_TOTAL AS BIGINT) AS LOSS_CC_TOTAL FROM loss_tot"))
def _(i):
    return losses.total_claims(i.losses_cut)


@query("loss_pivot", o.with_(_PIVOT, f"SELECT VehicleTermKey, {', '.join(_doubles(_RI) + _counts([*_CC, 'LOSS_CC_TOTAL']))} FROM loss_piv"))
def _(i):
    return losses.loss_by_vehicle(i.losses_cut)


def _developed(how):
    return o.with_([*_PIVOT, *o.developed_cte(how=how)],
                   f"SELECT VehicleTermKey, {', '.join(_doubles(_RI) + _counts([*_CC, 'LOSS_CC_TOTAL']))} FROM loss_dev")


@query("loss_ibnr", _developed("LEFT"))
def _(i):
    return losses.develop(i.ibnr, losses.loss_by_vehicle(i.losses_cut))


@query("loss_ibnr_keep_orphans", _developed("FULL"))
def _(i):
    return losses.develop(i.ibnr, losses.loss_by_vehicle(i.losses_cut), orphan_losses="keep")


@query("capped_loss", o.with_([*_PIVOT, *o.developed_cte()], f"SELECT VehicleTermKey, {', '.join(_doubles(_RI + _CAPPED))} FROM loss_cap"))
def _(i):
    developed = losses.with_caps(base_ops.developed_losses(i.premium, i.losses, i.ibnr))
    return developed.select("VehicleTermKey", *_RI, *_CAPPED)


_BASE_KEPT = ["VehicleTermKey", "PolicyTermKey", "TransactionType", "FinanceChannel", "Segment_F", "VehicleCount"]
_BASE_DATES = ["PolicyTermStartEffDate", "PolicyTermExpirationEffDate", "CancellationDate"]
_BASE_MONEY = [*named("WP"), *named("EP", (*PREMIUM_COVERAGES, "TOTAL")), *named("CLEP"), *_RI, *_CAPPED]


@query("premium_loss_base", o.with_(o.base_ctes(), "SELECT " + ", ".join(
    [*_BASE_KEPT, *_text(*_BASE_DATES), *_doubles(_BASE_MONEY + named("EE")), *_counts([*_CC, "LOSS_CC_TOTAL"])]) + " FROM base"))
def _(i):
    return i.base.select(*_BASE_KEPT, *_BASE_DATES, *_BASE_MONEY, *named("EE"), *_CC, "LOSS_CC_TOTAL")


# ---------------------------------------------------------------- factors and checks

_FACTOR_LIST = ", ".join(f"f.{c}" for c in REPORT_FACTORS)
_SOURCE_PREMIUM = [*view_ctes(*o.SRC_PREMIUM_VIEWS, *o.SRC_FACTOR_VIEWS), f"prem AS ({o.src_premium_select()})",
                   f"pf AS ({o.src_premium_factor_select()})"]
_SOURCE_QUOTES = [*view_ctes(*o.SRC_QUOTE_VIEWS), f"sq AS ({o.src_quote_select()})", f"qf AS ({o.src_quote_factor_select()})"]


@query("attach_factors_premium", o.with_(_SOURCE_PREMIUM,
       f"SELECT p.VehicleTermKey, CAST(p.WP_BI AS DOUBLE) AS WP_BI, {_FACTOR_LIST} FROM prem p JOIN pf f ON p.VehicleTermKey=f.VehicleTermKey"))
def _(i):
    attached = factors.attach_factors(i.source_premium, i.premium_factors)
    return attached.select("VehicleTermKey", "WP_BI", *REPORT_FACTORS)


@query("attach_factors_quote", o.with_(_SOURCE_QUOTES, f"""SELECT q.RowKey, q.VehicleKey, {_FACTOR_LIST}, count(*) AS RowWeight
 FROM sq q JOIN qf f ON q.RowKey=f.RowKey GROUP BY q.RowKey, q.VehicleKey, {_FACTOR_LIST}"""))
def _(i):
    attached = factors.attach_factors_by_job(i.source_quotes, i.quote_factors, list(REPORT_FACTORS))
    return attached.select("RowKey", "VehicleKey", *REPORT_FACTORS, factors.ROW_WEIGHT)


@query("attach_factors_quote_by_vehicle", o.with_(_SOURCE_QUOTES,
       f"SELECT q.RowKey, q.VehicleKey, {_FACTOR_LIST} FROM sq q JOIN qf f ON q.RowKey=f.RowKey AND q.VehicleKey=f.VehicleKey"))
def _(i):
    attached = factors.attach_factors(i.source_quotes, i.quote_factors, ["RowKey", "VehicleKey"])
    return attached.select("RowKey", "VehicleKey", *REPORT_FACTORS)


_ADJ_KEY = ("PrimAge", "PrimGen", "State")


def _adjustment_base(i):
    return i.base.withColumns({"PrimAge": F.col("PrimaryDriverAge"), "PrimGen": F.col("PrimaryDriverGender"),
                               "State": F.col("PolicyStateCode_F")})


@query("attach_adjustments", o.with_(view_ctes("fx_pm", "src_adjustment"),
       """SELECT p.VehicleTermKey, a.ADJ_WP_BI, a.ADJ_WP_COL FROM fx_pm p LEFT JOIN src_adjustment a
 ON p.PrimaryDriverAge IS NOT DISTINCT FROM a.PrimAge AND p.PrimaryDriverGender IS NOT DISTINCT FROM a.PrimGen
 AND p.PolicyStateCode_F IS NOT DISTINCT FROM a.State"""))
def _(i):
    rows = i.view("fx_pm").select("VehicleTermKey", F.col("PrimaryDriverAge").alias("PrimAge"),
                                  F.col("PrimaryDriverGender").alias("PrimGen"), F.col("PolicyStateCode_F").alias("State"))
    return factors.attach_adjustments(rows, i.view("src_adjustment"), _ADJ_KEY).select("VehicleTermKey", "ADJ_WP_BI", "ADJ_WP_COL")


@query("fanout_check", o.with_(_SOURCE_QUOTES, """SELECT l AS left_rows, r AS right_rows, j AS joined_rows, j > l + r AS grows_too_far
 FROM (SELECT (SELECT count(*) FROM sq) AS l, (SELECT count(*) FROM qf) AS r, (SELECT count(*) FROM sq JOIN qf ON sq.RowKey=qf.RowKey) AS j)"""))
def _(i):
    return checks.join_growth(i.source_quotes, i.quote_factors, "RowKey")


@query("repeated_keys", o.with_(_SOURCE_QUOTES, "SELECT RowKey, count(*) AS row_count FROM sq GROUP BY RowKey HAVING count(*) > 1"))
def _(i):
    return checks.repeated_keys(i.source_quotes, "RowKey")


# ---------------------------------------------------------------- figures

def _figures(name, names, sides="both"):
    @query(name, o.stats_sql(names))
    def _(i):
        return stat_table(i.base if sides != "quotes" else None, i.quotes if sides != "premium" else None, P, names)


_figures("sales_stats", ["PCVS_QB", "WVS_QB", "AVS_QB", "TVS_PB"], "premium")
_figures("policy_counts", ["TPS_QB", "TPS_PB"], "premium")
_figures("quote_stats", ["PCVQ_QB", "WVQ_QB", "AVQ_QB"], "quotes")
_figures("quote_policy_counts", ["TPQ_QB"], "quotes")
_figures("business_mix", ["BMAge23_WP_BI", "BMGender_WP_BI", "BMLiaOnly_WP_BI", "BMMinLimit_WP_BI", "BMPayFull_WP_BI",
                          "BMRTPlus_WP_BI", "BMVeh2015_WP_BI"], "premium")
_figures("renewals_generated", ["VGEN_QB", "VGEN_PB"], "premium")
_figures("renewals_taken", ["VREN_QB", "VREN_PB"], "premium")
_figures("retention_6m", ["Month6Active", "Month6Total"], "premium")
_figures("cancellations", ["Cancels_NonPay", "Cancels_Fraud", "Cancels_Other", "Total1Year"], "premium")
_figures("three_day_cancel", ["CXX_QBTotal", "CXX_PBTotal", "CXX_ThreeDays_QB", "CXX_ThreeDays_Total"], "premium")
_figures("premium_loss_sums", ["EE", "EP", "CLEP", "LOSS_CC", "LOSS_CC_TOTAL", "LOSS_25", "LOSS_100", "LOSS_RI"], "premium")
_figures("written_premium_qb", ["WP_QB"], "premium")
_figures("written_premium_pb", ["WP_PB"], "premium")
_figures("full_outer_stats", ["PCVS_QB", "TPQ_QB", "VGEN_PB", "Total1Year", "WP_PB"])

_ADJ_JOIN = """ LEFT JOIN src_adjustment a ON p.PrimaryDriverAge IS NOT DISTINCT FROM a.PrimAge
 AND p.PrimaryDriverGender IS NOT DISTINCT FROM a.PrimGen AND p.PolicyStateCode_F IS NOT DISTINCT FROM a.State"""


def _adjusted_sql():
    oracle = o.Oracle(adjusted=("BI", "COL"))
    views = [c for c in view_ctes("fx_pm", "fx_loss", "fx_ibnr", "src_adjustment")]
    ctes = views + [c for c in o.base_ctes(extra=", a.ADJ_WP_BI, a.ADJ_WP_COL", join=_ADJ_JOIN) if c not in views]
    branches, head, cells, source = oracle.joined(["ADJ_WP"])
    return o.with_([*ctes, oracle.premium_rows(), *branches], f"SELECT {head}, {', '.join(cells)} {source}")


@query("adjusted_premium", _adjusted_sql())
def _(i):
    adjusted = factors.attach_adjustments(_adjustment_base(i), i.view("src_adjustment"), _ADJ_KEY)
    return stat_table(adjusted, None, P, ["ADJ_WP"])


# ---------------------------------------------------------------- summaries

@query("pricing_summary", o.summary_sql())
def _(i):
    return pricing_summary(i.base, i.quotes, P)


@query("summary_mixed_types", o.summary_sql())
def _(i):
    """The same figures where retained vehicles are doubles and written premium is stored in several types."""
    types = {"Retained6Months": "DOUBLE", "WP_PD": "DOUBLE", "WP_COL": "DECIMAL(30,10)", "CLEP_BI": "DECIMAL(38,4)"}
    mixed = i.base.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    summary = pricing_summary(mixed, i.quotes, P)
    kept = {c: summary.schema[c].dataType.simpleString() for c in ("LOSS_CC_TOTAL", "LOSS_CC_BI", "Month6Active")}
    if kept != {"LOSS_CC_TOTAL": "bigint", "LOSS_CC_BI": "bigint", "Month6Active": "double"}:
        raise TypeError(f"a column's type follows another one's: {kept}")
    return summary.withColumn("Month6Active", F.col("Month6Active").cast("bigint"))


@query("summary_no_quotes", o.summary_sql(quotes=False))
def _(i):
    return pricing_summary(i.base, None, P)


@query("summary_skip_nulls", o.summary_sql(strict=False))
def _(i):
    return pricing_summary(i.base, i.quotes, replace(P, nulls="skip"))


@query("summary_no_factors", o.summary_sql(keys=("TermType", "UWYear")))
def _(i):
    return pricing_summary(i.base, i.quotes, replace(P, rate_factors=()))


def _report_sql(keys=("TermType", "UWYear", *REPORT_FACTORS), premium="", quote="", join="", adjusted=()):
    """SQL of a whole run; ``premium`` and ``quote`` are further columns of the base and of the quotes."""
    ctes = [
        *view_ctes(*o.SRC_QUOTE_VIEWS, "src_loss", "fx_ibnr", "src_adjustment"),
        f"prem AS ({o.src_premium_select()})", *o.loss_ctes("src_loss"), o.pivot_cte(), *o.developed_cte(),
        f"pf AS ({o.src_premium_factor_select()})", f"sq AS ({o.src_quote_select()})", f"qf AS ({o.src_quote_factor_select()})",
        f"""base AS (SELECT p.*, {o.channel('p.FinanceChannel_F')} AS FinanceChannel, l.* EXCLUDE (VehicleTermKey), f.* EXCLUDE (VehicleTermKey){premium}
 FROM prem p LEFT JOIN loss_cap l ON p.VehicleTermKey=l.VehicleTermKey JOIN pf f ON p.VehicleTermKey=f.VehicleTermKey{join})""",
        f"""quotes AS (SELECT q.* EXCLUDE (UWYear), {_FACTOR_LIST}{quote} FROM sq q JOIN qf f ON q.RowKey=f.RowKey
 JOIN src_rating r ON r.JobID=f.RowKey AND r.VehicleFixedID=f.VehicleKey JOIN src_reporting v ON v.JobID=f.RowKey AND v.VehicleFixedID=f.VehicleKey)""",
    ]
    return o.summary_sql(keys=keys, ctes=ctes, adjusted=adjusted)


REPORT_PARAMS = replace(P, rate_factors=REPORT_FACTORS)
REPORT_PLAN = FactorPlan(
    premium=list(REPORT_FACTORS), quote=[f for f in REPORT_FACTORS if f != "TermNumber"],
    quote_constants={"TermNumber": 1}, quoted_from=EXTRACT_FLOOR,
)


def _report(i, params=P, plan=FactorPlan(), **more):
    return pricing_report(i.sources, params, replace(plan, accept_growth=True), history_start=EXTRACT_FLOOR, **more)[1]


@query("pricing_report", _report_sql())
def _(i):
    return _report(i, REPORT_PARAMS, REPORT_PLAN)


@query("report_from_store", _report_sql())
def _(i):
    """The same from tables that an earlier run keeps: the base is read by start month."""
    store = Store.temporary(i.spark)
    _report(i, REPORT_PARAMS, REPORT_PLAN, store=store)
    return _report(i, REPORT_PARAMS, REPORT_PLAN, store=store)


@query("report_no_factors", _report_sql(keys=("TermType", "UWYear")))
def _(i):
    return _report(i, replace(P, rate_factors=()))


_GAP = "CASE WHEN AgeDifference < 0 THEN 'younger' WHEN AgeDifference >= 0 THEN 'older' END"
_OF_R = _GAP.replace("AgeDifference", "r.AgeDifference")


@query("report_banded_factor", _report_sql(
    keys=("TermType", "UWYear", "Gap"), premium=f", {_OF_R} AS Gap", quote=f", {_OF_R} AS Gap",
    join=" JOIN src_rating r ON r.VehicleFixedID=p.SourceSystemVehicleID AND r.JobID=p.TransactionJobID"))
def _(i):
    banded = [Factor("Gap", _GAP, "rating")]
    return _report(i, replace(P, rate_factors=("Gap",)), FactorPlan(banded, banded))


_BAND_OF_R = f"(SELECT {_BANDS} FROM (SELECT r.AgeDifference AS a))"


@query("report_age_bands", _report_sql(
    keys=("TermType", "UWYear", "YNP_Group"), premium=f", {_BAND_OF_R} AS YNP_Group", quote=f", {_BAND_OF_R} AS YNP_Group",
    join=" JOIN src_rating r ON r.VehicleFixedID=p.SourceSystemVehicleID AND r.JobID=p.TransactionJobID"))
def _(i):
    bands = [Factor("YNP_Group", band, source="AgeDifference")]
    return _report(i, replace(P, rate_factors=("YNP_Group",)), FactorPlan(bands, bands))


@query("report_adjusted", _report_sql(
    keys=("TermType", "UWYear", "State"), premium=", p.PolicyStateCode_F AS State, a.ADJ_WP_BI, a.ADJ_WP_COL",
    quote=", v.PolicyStateCode_F AS State", join=_ADJ_JOIN, adjusted=("BI", "COL")))
def _(i):
    state = Factor("State", "PolicyStateCode_F", "reporting")
    driver = [Factor("PrimAge", "PrimaryDriverAge", "reporting"), Factor("PrimGen", "PrimaryDriverGender", "reporting")]
    return _report(i, replace(P, rate_factors=("State",)), FactorPlan([state, *driver], [state]),
                   adjustments=i.view_of_terms("src_adjustment"), adjustment_key=_ADJ_KEY)


def _sorted_sql():
    keys = ", ".join(f"{k} NULLS FIRST" for k in o.KEYS)
    return f"SELECT *, row_number() OVER (ORDER BY {keys}) AS position FROM ({o.summary_sql()})"


@query("summary_sorted", _sorted_sql())
def _(i):
    """The summary as it is stored for readers, with its position in key order."""
    return positioned_by_keys(pricing_summary(i.base, i.quotes, P), P.keys, Store.temporary(i.spark))


# ---------------------------------------------------------------- facts

_BOUNDS_SQL = """SELECT min(PolicyTermStartEffDate) AS p0, max(PolicyTermStartEffDate) AS p1, min(CancellationDate) AS q0 FROM fx_pm"""
_LABEL = "upper(strftime({}, '%d%b%y'))".format
_KEY_ROWS = list(enumerate(["TermType", "UWYear", "PolicyStateCode_F", "Segment_F", "var5", "var6", "var7", "var8", "var9", "var10"], 3))


def _params_of(i):
    """A run over all terms there are."""
    days = i.view("fx_pm").agg(F.min("PolicyTermStartEffDate").alias("first"), F.max("PolicyTermStartEffDate").alias("last"),
                               F.min("CancellationDate").alias("cancelled")).first()
    return replace(P, prem_loss_start=days["first"], end=days["last"], sale_quote_start=days["cancelled"])


@query("facts", o.with_([*view_ctes("fx_pm"), f"b AS ({_BOUNDS_SQL})"], f"""
SELECT 1 AS position, concat({_LABEL('p0')}, ' - ', {_LABEL('p1')}) AS value FROM b
UNION ALL SELECT 2, concat({_LABEL('q0')}, ' - ', {_LABEL('p1')}) FROM b
""" + "\n".join(f"UNION ALL SELECT {n}, '{key}'" for n, key in _KEY_ROWS)))
def _(i):
    return facts_plan.facts(i.spark, _params_of(i))


@query("facts_row", o.with_([*view_ctes("fx_pm"), f"b AS ({_BOUNDS_SQL})"], f"""
SELECT concat({_LABEL('p0')}, ' - ', {_LABEL('p1')}) AS fact1, concat({_LABEL('q0')}, ' - ', {_LABEL('p1')}) AS fact2, """
    + ", ".join(f"'{key}' AS fact{n}" for n, key in _KEY_ROWS) + " FROM b"))
def _(i):
    return facts_plan.facts_row(facts_plan.facts(i.spark, _params_of(i)))
