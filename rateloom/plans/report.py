"""A whole run: source tables in, summary and facts out."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field, fields, replace
from datetime import date
from getpass import getuser

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rateloom.operators.base import START_MONTH, by_month, premium_columns, premium_loss_base
from rateloom.operators.checks import guarded_key, require_bounded_growth
from rateloom.operators.extracts import (
    HISTORY_START,
    Factor,
    amounts_within,
    factor_names,
    factors_of,
    ibnr_extract,
    loss_extract,
    premium_extract,
    premium_factors,
    quoted_vehicles,
    quotes_of,
)
from rateloom.operators.factors import ADJUSTMENT_KEY, attach_adjustments, attach_factors
from rateloom.operators.losses import with_caps
from rateloom.params import PricingParams, as_date
from rateloom.plans.facts import facts
from rateloom.plans.summary import columns_read, pricing_summary, quote_reach, reach
from rateloom.sources.sinks import publish_result, run_label, sorted_by_keys
from rateloom.sources.store import Entry, Store, fingerprint, source_state
from rateloom.sources.tables import read_table

RATED = "_rated"


@dataclass(frozen=True)
class Sources:
    """The seven source tables."""

    pm: DataFrame
    reporting: DataFrame
    losses: DataFrame
    ibnr: DataFrame
    rating: DataFrame
    rating_sup: DataFrame
    dim_quote: DataFrame

    @classmethod
    def from_catalog(cls, spark: SparkSession, prefix: str = "") -> Sources:
        names = ("PM", "PM_Reporting", "TransactionLoss", "SummaryIBNR", "PCRating", "PCRatingSup", "DimQuote")
        return cls(*[read_table(spark, f"{prefix}{name}") for name in names])


@dataclass(frozen=True)
class FactorPlan:
    """Which rating factors to fetch for premium and quotes, and constants for quotes.

    A factor is the name of a column, or a ``Factor`` with an expression and the table it is made from.
    """

    premium: list[str | Factor] = field(default_factory=list)
    quote: list[str | Factor] = field(default_factory=list)
    quote_constants: dict[str, object] = field(default_factory=dict)
    quote_key: str | list[str] = "RowKey"
    quoted_from: date | str | None = None  # the sale start of the run
    accept_growth: bool = False  # the join of quotes and their factors may have more rows than both together


@dataclass(frozen=True)
class PricingInputs:
    """What a summary is made of, and the dates found on the way."""

    base: DataFrame
    quotes: DataFrame | None
    factors: DataFrame | None
    earned_as_of: date | None
    retained_as_of: date | None

    def summary(self, params: PricingParams, plan: FactorPlan) -> DataFrame:
        if params.retained_as_of is None and self.retained_as_of is not None:
            params = replace(params, retained_as_of=self.retained_as_of)
        return pricing_summary(self.base, self.quotes, params, self.factors, plan.quote_key)


def rated_premium(sources: Sources, plan: FactorPlan, history_start=HISTORY_START, check_keys: bool = True, wanted: str = "true",
                  needed: Collection[str] | None = None) -> DataFrame:
    """Premium rows with their factors; ``rated`` says whether the rating tables know the vehicle-term.

    Rows that are not ``wanted`` have no amounts, and of the descriptive columns there are those ``needed``.
    """
    s = sources
    premium = premium_extract(s.pm, s.reporting, history_start, wanted)
    premium = premium.selectExpr(*premium_columns(premium, needed=needed))
    factors = premium_factors(s.reporting, s.rating, s.rating_sup, plan.premium)
    if check_keys:
        premium = guarded_key(premium, "VehicleTermKey", "premium extract")
        factors = guarded_key(factors, "VehicleTermKey", "premium factors")
    return attach_factors(premium, factors.withColumn(RATED, F.lit(True)), how="left")


def stored_rated_premium(store: Store, rated: DataFrame, wanted: str = "true") -> tuple[DataFrame, dict[str, date | None]]:
    """Store the rated rows; the latest dates that the run needs are observed while they are written.

    The latest earned date is that of all premium rows, the latest retention date that of the rated ones. Of these the
    ``wanted`` rows are stored.
    """
    seen = Observation("premium dates")
    day = {"earned": F.col("EarnedAsOfDate"), "retained": F.when(F.col(RATED), F.col("RetainedAsOfDate"))}
    rows = rated.observe(seen, *[F.max(c.cast("date")).alias(name) for name, c in day.items()])
    _, stored = store.write(rows.where(RATED).where(wanted).drop(RATED), "rated_premium", bucket_by="VehicleTermKey")
    return stored, seen.get


def pricing_inputs(
    sources: Sources,
    plan: FactorPlan,
    history_start=HISTORY_START,
    with_quotes: bool = True,
    check_keys: bool = True,
    store: Store | None = None,
    earned_as_of: date | None = None,
    adjustments: DataFrame | None = None,
    adjustment_key: Sequence[str] = ADJUSTMENT_KEY,
    versions: Mapping[str, str] | None = None,
    wanted: str = "true",
    quoted: str = "true",
    needed: Collection[str] | None = None,
) -> PricingInputs:
    """Premium base with factors, quote base, quote factors.

    The rows are the same whatever factors are listed: bound terms and unbound jobs that the rating tables know.
    ``adjustments`` holds ADJ_WP_* multipliers by ``adjustment_key``, columns of the base or premium factors.

    The rated premium and the quoted vehicles are stored first, in the folder that executors share: each source is joined
    once, and the two latest dates are found while the premium is written. Repeated vehicle-terms, which would multiply
    premium, fail the job that meets them (``check_keys``). The join of quotes and factors on the job must not have more
    rows than both sides together, unless ``plan.accept_growth``.

    With a ``store`` the finished tables are kept there, the premium base by start month, and are found by later runs whose
    sources, floors and factors are the same: those runs only read what is stored. Sources that are not read from
    files need a version of theirs, by the names in ``Sources``, or they count as changed.

    A run without a ``store`` may need some premium rows only: ``wanted`` is a condition on the dates of their terms. Keys are
    checked and the latest dates found over all rows. It may need the amounts of some quotes only, ``quoted`` being a
    condition on their dates, and some descriptive columns of the premium, those ``needed``.
    """
    if store is not None and (wanted, quoted, needed) != ("true", "true", None):
        raise ValueError("a store keeps all premium rows for later runs")
    quoted_from = plan.quoted_from or history_start
    key = None
    if store is not None:
        key = _inputs_fingerprint(sources, plan, history_start, quoted_from, with_quotes, check_keys, earned_as_of, adjustments,
                                  adjustment_key, versions or {})
        if key and (found := store.find("pricing inputs", key)):
            return _found_inputs(found)

    s, spark = sources, sources.pm.sparkSession
    work = Store.temporary(spark)
    rated, latest = stored_rated_premium(work, rated_premium(s, plan, history_start, check_keys, wanted, needed), wanted)
    earned = F.lit(earned_as_of or latest["earned"]).cast("date")
    ibnr = ibnr_extract(s.ibnr)
    if check_keys:
        ibnr = guarded_key(ibnr, "VehicleTermKey", "IBNR")
    base = premium_loss_base(rated, loss_extract(s.losses), ibnr, keep=tuple(factor_names(plan.premium)), earned_as_of=earned,
                             caps=store is None)
    if adjustments is not None:
        if check_keys:
            adjustments = guarded_key(adjustments, list(adjustment_key), "adjustments")
        base = attach_adjustments(base, adjustments, adjustment_key)

    quotes = factors = None
    if with_quotes:
        floor = min(as_date(history_start), as_date(quoted_from))
        vehicles = quoted_vehicles(s.reporting, s.rating, s.rating_sup, s.dim_quote, floor, plan.quote)
        _, vehicles = work.write(vehicles if quoted == "true" else amounts_within(vehicles, quoted), "quoted_vehicles")
        quotes = quotes_of(vehicles, s.pm, history_start)
        factors = factors_of(vehicles, plan.quote, plan.quote_constants, quoted_from)
        if not plan.accept_growth:
            require_bounded_growth(quotes, factors, plan.quote_key, "join of quotes and their factors")
    if store is None:
        return PricingInputs(base, quotes, factors, earned_as_of or latest["earned"], latest["retained"])

    # The rows move by month without their capped losses.
    tables = {"premium_base": store.write(with_caps(by_month(base)), "premium_base", partition_by=[START_MONTH])}
    if with_quotes:
        tables["quote_base"] = store.write(quotes.repartitionByRange("QuoteVersionDate", "RowKey").sortWithinPartitions("QuoteVersionDate"),
                                           "quote_base")
        tables["quote_factors"] = store.write(factors, "quote_factors")
    dates = {"earned_as_of": earned_as_of or latest["earned"], "retained_as_of": latest["retained"]}
    entry = store.publish("pricing inputs", tables, key or "", dates)
    work.drop()
    return _found_inputs(entry)


def _found_inputs(entry: Entry) -> PricingInputs:
    dates = {k: date.fromisoformat(v) if v else None for k, v in entry.facts.items()}
    tables = {name: entry.read(name) for name in entry.tables}
    return PricingInputs(tables["premium_base"], tables.get("quote_base"), tables.get("quote_factors"), **dates)


def _inputs_fingerprint(sources: Sources, plan: FactorPlan, history_start, quoted_from, with_quotes, check_keys, earned_as_of,
                        adjustments, adjustment_key, versions) -> str | None:
    """None if a source can't tell whether it changed, or a factor is made by a function."""
    tables = {f.name: getattr(sources, f.name) for f in fields(sources)}
    if adjustments is not None:
        tables["adjustments"] = adjustments
    states = {name: source_state(df, versions.get(name)) for name, df in tables.items()}
    chosen = [Factor(f) if isinstance(f, str) else f for f in (*plan.premium, None, *plan.quote) if f is not None]
    if not all(states.values()) or any(callable(f.expression) for f in chosen):
        return None
    return fingerprint(
        layout=1, states=states, premium=[repr(f) for f in plan.premium], quote=[repr(f) for f in plan.quote],
        constants=plan.quote_constants, key=plan.quote_key, floors=[str(history_start), str(quoted_from)], quotes=with_quotes,
        checks=check_keys, growth=plan.accept_growth, earned=str(earned_as_of), adjusted_by=list(adjustment_key))


def pricing_report(
    sources: Sources,
    params: PricingParams,
    plan: FactorPlan | None = None,
    out: str | None = None,
    run_id: str | None = None,
    fmt: str = "parquet",
    **inputs,
) -> tuple[DataFrame, DataFrame]:
    """Run everything; returns (facts, summary). Further arguments go to ``pricing_inputs``.

    With ``out`` both are written and published together, under a label of user and time if no ``run_id`` is given, and
    what is returned are the stored tables. Quote factors are read from the sale start on, unless the plan says otherwise.
    """
    plan = plan or FactorPlan()
    plan = replace(plan, quoted_from=plan.quoted_from or params.sale_quote_start)
    if inputs.get("store") is None:
        inputs.setdefault("wanted", reach(params))
        inputs.setdefault("quoted", quote_reach(params))
        inputs.setdefault("needed", columns_read(params) | set(inputs.get("adjustment_key", ADJUSTMENT_KEY)))
    summary = pricing_inputs(sources, plan, **inputs).summary(params, plan)
    page = facts(sources.pm.sparkSession, params)
    if out:
        entry = publish_result({"facts": page, "summary": sorted_by_keys(summary, params.keys)}, out, run_id or run_label(getuser()), fmt)
        page, summary = entry.read("facts"), entry.read("summary")
    return page, summary
