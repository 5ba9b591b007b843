"""The pricing summary: all branches in one pass over the premium and the quote base."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateloom.coverages import LOSS_COVERAGES, PREMIUM_COVERAGES
from rateloom.functions.dates import lookback_year
from rateloom.functions.measures import Parts
from rateloom.functions.recode import term_type
from rateloom.operators.base import START_MONTH, in_months
from rateloom.operators.factors import ROW_WEIGHT, folded_factors
from rateloom.params import MAX_RATING_FACTORS, RUN_KEYS, PricingParams
from rateloom.plans.branches import (
    ALL_STATS,
    KEPT_SLOT,
    NUMBER_SLOTS,
    PREMIUM_STATS,
    QUOTE_STATS,
    RETAINED,
    SLOTS,
    VEHICLE_STATS,
    any_of,
    bit_of,
    or_bits,
    premium_conditions,
    quote_conditions,
    row_bits,
    shared_conditions,
    sql_day,
)
from rateloom.sources.tables import require_columns

LINE, ROWS, SPOILT, UNKNOWN, SHARE, CELLS = "_line", "_rows", "_spoilt", "_unknown", "_share", "_cells"
# The lines of a row are made as a column and taken apart afterwards. An expression of that size inside ``inline`` is walked
# node by node for every row; as a column it is compiled, in pieces. ``inline_outer``, as no row is without lines and the plain
# form would build them once more to look whether there are any.
LINES = "_lines"

# COMP_CAT has losses only and BIFEE premium only, so the lines are the union of both lists.
COVERAGE_LINES = (*PREMIUM_COVERAGES, *(c for c in LOSS_COVERAGES if c not in PREMIUM_COVERAGES))
# The columns of the base that a coverage line carries, by the name they have on the line.
LINE_FIELDS = {
    "wp": "WP", "ep": "EP", "ee": "EE", "clep": "CLEP", "adj": "ADJ_WP", "cc": "LOSS_CC",
    "loss_25": "LOSS_25", "loss_100": "LOSS_100", "loss_ri": "LOSS_RI",
}
KEPT = "kept"  # a field of vehicle lines only: retained vehicles
# The field a slot adds up, where it is not a count.
_SLOT_FIELD = {s.slot: s.measure if s.measure in LINE_FIELDS else None for s in PREMIUM_STATS} | {KEPT_SLOT: KEPT}
_DATES = ("PolicyTermStartEffDate", "PolicyTermExpirationEffDate", "CancellationDate")
_MEASURE_FIELDS = {"sold": ("wp",), "share": ("wp",), "generated": ("wp",), "taken": ("wp", "ep")}


def with_run_keys(base: DataFrame, params: PricingParams) -> DataFrame:
    """Premium base with TermType as NB/RN, UWYear as look-back year, and times of day cut off its dates."""
    return base.withColumns({
        **{c: F.col(c).cast("date") for c in _DATES if c in base.columns},
        "TermType": term_type(F.col("TermType"), F.col("TransactionType")),
        "UWYear": lookback_year(F.col("PolicyTermStartEffDate"), params.end),
    })


def reach(params: PricingParams) -> str:
    """The premium rows that any figure looks at, by their dates."""
    start, expiry = (f"CAST({c} AS DATE)" for c in ("PolicyTermStartEffDate", "PolicyTermExpirationEffDate"))
    end = sql_day(params.end)
    return f"{start} >= {sql_day(params.earliest_start)} AND ({start} < {end} OR {expiry} < {end})"


def columns_read(params: PricingParams) -> set[str]:
    """The columns of the premium extract that the figures are made from, besides its amounts."""
    conditions = [*premium_conditions(params).values(), *shared_conditions(params).values()]
    words = re.findall(r"\w+", " ".join([*conditions, *(s.measure.removesuffix("_if_bi") for s in VEHICLE_STATS)]))
    return {*words, *params.keys, *_DATES, "VehicleTermKey", "TermType", "TransactionType", "FinanceChannel_F", "VehicleCount",
            "EarnedAsOfDate", "RetainedAsOfDate"}


def quote_reach(params: PricingParams) -> str:
    """The quotes that any figure looks at, by their date."""
    conditions = quote_conditions(params)
    return any_of(conditions[s.rows] for s in QUOTE_STATS)


def _q(name: str) -> str:
    return f"`{name}`"


def _high(slot: str) -> str:
    return f"_{slot}_high"


def _named_struct(values: dict[str, str]) -> str:
    return "struct(" + ", ".join(f"{value} AS {_q(name)}" for name, value in values.items()) + ")"


def _mask(stats, *measures) -> int:
    return sum(bit_of(s.slot) for s in stats if s.strict and s.measure in measures)


def _in_bits(slot: str) -> str:
    return f"({ROWS} & {bit_of(slot)}) != 0"


def _vehicle_line(name: str, stats, conditions, strict: bool) -> dict[str, str]:
    """A line with the figures of a vehicle, shaped like a coverage line.

    Premium is 1, so that a counting slot counts whenever its bit is set; measures that are
    added up sit where a coverage has its claims, exposure and adjusted premium.
    """
    values, rows, spoilt = {"wp": "1", "ep": "1"}, [], []
    for stat in (s for s in stats if s.line == name):
        met, bit = conditions[stat.rows], bit_of(stat.slot)
        if stat.strict:
            spoilt.append(f"IF(({met}) AND WP_BI IS NULL, {bit}, 0)")
        if stat.measure == "sold_bi":
            met = f"({met}) AND WP_BI >= 1"
        elif stat.measure.endswith("_if_bi"):
            number = f"try_cast({stat.measure[:-6]} AS DOUBLE)"
            met = f"({met}) AND WP_BI > 0"
            spoilt.append(f"IF({met} AND {number} IS NULL, {bit}, 0)")
            values[_SLOT_FIELD[stat.slot]] = number
        elif stat.measure != "one":
            values[_SLOT_FIELD[stat.slot]] = stat.measure
        rows.append(f"IF({met}, {bit}, 0)")
    return {**values, ROWS: or_bits(rows), SPOILT: or_bits(spoilt) if strict else "0"}


def _coverage_field(base_columns, field: str, coverage: str) -> str | None:
    """The base column a coverage line carries under ``field``, if that coverage has it."""
    if field == KEPT:
        return None
    of_losses = {s.measure for s in PREMIUM_STATS if s.coverages is LOSS_COVERAGES}
    if coverage not in (LOSS_COVERAGES if field in of_losses else PREMIUM_COVERAGES):
        return None
    name = f"{LINE_FIELDS[field]}_{coverage}"
    if field == "adj":
        multiplier = name if name in base_columns else "1.0D"
        return f"{multiplier} * CAST(WP_{coverage} AS DOUBLE)"
    return name


_WHOLE_DIGITS = {"boolean": 3, "tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


def widest_type(base: DataFrame, columns: list[str]) -> str:
    """The type that holds the values of all these columns; counts are long.

    Among decimals, as many digits before and behind the point as any of them has; where those are over 38 together, digits
    at the end are given up, but no more than leaves six. Double where there is a float.
    """
    found = [base.schema[c].dataType for c in dict.fromkeys(columns) if c in base.columns]
    if any(isinstance(t, (T.FloatType, T.DoubleType, T.StringType)) for t in found):
        return "double"
    decimals = [t for t in found if isinstance(t, T.DecimalType)]
    if not decimals:
        return "bigint"
    scale = max(t.scale for t in decimals)
    whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _WHOLE_DIGITS.get(t.simpleString(), 0) for t in found)
    kept = min(scale, 38 - whole)
    return f"decimal({whole + kept},{kept})" if kept >= min(scale, 6) else "double"


def premium_lines(base: DataFrame, params: PricingParams, stats) -> DataFrame:
    """Unpivot the premium rows any of ``stats`` looks at into lines of slots."""
    by_coverage = [s for s in stats if s in PREMIUM_STATS]
    by_vehicle = [s for s in stats if s in VEHICLE_STATS]
    keys = [_q(k) for k in params.keys]
    conditions = premium_conditions(params)
    strict = params.nulls == "strict"

    rows = with_run_keys(in_months(base, params.earliest_start, params.end), params).where(reach(params))
    if any(s.rows == "six_months" for s in by_vehicle):
        # Of the whole base, also of rows that no branch looks at.
        known = params.retained_as_of
        latest = F.lit(known) if known else base.agg(F.max("RetainedAsOfDate")).scalar()
        rows = rows.withColumn(RETAINED, latest)
    # The bits of the coverage lines stand beside the shared conditions, with those written out: the row is as wide as the base
    # and every step over it copies all its amounts.
    shared = shared_conditions(params)
    bits = re.sub(r"\b_(?:pb|qb|sale|renewal)\b", lambda found: f"({shared[found[0]]})", row_bits(by_coverage, conditions))
    rows = rows.selectExpr("*", *[f"{sql} AS {name}" for name, sql in shared.items()], f"{bits} AS _coverage_rows")
    rows = rows.where(any_of(conditions[s.rows] for s in stats))

    fields = [f for f in (*LINE_FIELDS, KEPT)
              if any(f in _MEASURE_FIELDS.get(s.measure, (s.measure,)) for s in by_coverage)
              or any(f == _SLOT_FIELD[s.slot] or f == "wp" or f == "ep" for s in by_vehicle)]

    # Whatever a line has no use for is NULL. All lines have the same types from the start,
    # so that building them needs no conversion.
    base_types = {f.name: f.dataType.simpleString() for f in base.schema}
    types = {ROWS: "int", SPOILT: "int"}
    for f in fields:
        carried = [c for c in (_coverage_field(base_types, f, cov) for cov in COVERAGE_LINES) if c]
        carried += [s.measure for s in by_vehicle if _SLOT_FIELD[s.slot] == f and s.measure in base_types]
        types[f] = "double" if f == "adj" else widest_type(base, carried)

    def line(name, values):
        typed = {}
        for f, sql_type in types.items():
            value = values.get(f)
            given = base_types.get(value, "int" if value == "_coverage_rows" else None)
            typed[f] = value if given == sql_type else f"CAST({value or 'NULL'} AS {sql_type})"
        made = _named_struct({LINE: f"'{name}'", **typed})
        return made if name == first else f"IF({_tells_something(name, typed)}, {made}, NULL)"

    base_columns = set(base_types)
    first = COVERAGE_LINES[0] if by_coverage else by_vehicle[0].line
    lines = []
    if by_coverage:
        for cov in COVERAGE_LINES:
            values = {f: _coverage_field(base_columns, f, cov) for f in fields}
            lines.append(line(cov, {ROWS: "_coverage_rows", **values}))
    for name in dict.fromkeys(s.line for s in by_vehicle):
        lines.append(line(name, _vehicle_line(name, by_vehicle, conditions, strict)))

    unpivoted = rows.selectExpr(
        *keys, f"try_divide(1.0D, VehicleCount) AS {SHARE}", f"array({', '.join(lines)}) AS {LINES}"
    ).selectExpr(*keys, SHARE, f"inline_outer({LINES})")
    return unpivoted.where(f"{LINE} IS NOT NULL").selectExpr(*keys, LINE, *_premium_slots(by_coverage, by_vehicle, strict))


def _tells_something(name: str, values: dict[str, str]) -> str:
    """Whether a line with these values adds anything: a coverage without premium, exposure and losses adds nothing to any figure.
    One line of a row, the first, always stays, as it says that the row's key is there."""
    of_premium = name in PREMIUM_COVERAGES or name not in COVERAGE_LINES
    missing = {"wp": of_premium, "ep": of_premium}  # a missing premium can spoil a count
    used = [f"coalesce({value} != 0, {str(missing.get(f, False)).lower()})" for f, value in values.items() if f not in (ROWS, SPOILT)]
    any_row = f"(({values[ROWS]}) | coalesce({values[SPOILT]}, 0)) != 0"
    return f"{any_row}{' AND (' + ' OR '.join(used) + ')' if used else ''}"


_TESTS = {"sold": "wp >= 1", "generated": "wp > 0", "taken": "ep > 0 AND wp > 0", "share": "wp >= 1"}


def _premium_slots(by_coverage, by_vehicle, strict: bool) -> list[str]:
    used = {s.slot for s in by_coverage} | {s.slot for s in by_vehicle}
    columns = []
    for stat in (s for s in PREMIUM_STATS if s.slot in used):
        value = {"share": SHARE}.get(stat.measure, "1" if stat.measure in _TESTS else stat.measure)
        test = f" AND {_TESTS[stat.measure]}" if stat.measure in _TESTS else ""
        columns.append(f"IF({_in_bits(stat.slot)}{test}, {value}, NULL) AS {stat.slot}")
    if KEPT_SLOT in used:
        columns.append(f"IF({_in_bits(KEPT_SLOT)}, {KEPT}, NULL) AS {KEPT_SLOT}")

    nulls = [
        (_mask(by_coverage, "sold", "generated", "share"), "wp IS NULL"),
        (_mask(by_coverage, "taken"), "(ep > 0 AND wp > 0) IS NULL"),
        (_mask(by_coverage, "share"), f"wp >= 1 AND {SHARE} IS NULL"),
    ]
    unknown = or_bits(f"IF({test}, {ROWS} & {mask}, 0)" for mask, test in nulls if mask and strict)
    return [*columns, f"coalesce({SPOILT}, {unknown}) AS {UNKNOWN}"]


def quote_lines(
    quotes: DataFrame,
    params: PricingParams,
    stats,
    factors: DataFrame | None = None,
    factor_key: str | list[str] = "RowKey",
) -> DataFrame:
    """Unpivot quotes into lines of slots.

    With ``factors``, a table keyed by job rather than by vehicle, quotes are added up per
    job first and equal factor rows of a job are counted. What is joined is then a few
    rows per job on either side, where joining vehicles would write out every pair.
    """
    conditions = quote_conditions(params)
    job = [factor_key] if isinstance(factor_key, str) else list(factor_key)
    brought = [] if factors is None else [f for f in params.rate_factors if f not in quotes.columns]
    keys = [_q(k) for k in params.keys]
    own = [_q(k) for k in params.keys if k not in brought]

    share = "try_divide(1.0D, VehicleCount)"
    counted, policies = _mask(stats, "sold", "share"), _mask(stats, "share")

    def figures(cov):
        wp = f"WP_{cov}"
        spoilt = f"CASE WHEN {wp} IS NULL THEN {counted} WHEN {wp} >= 1 AND {share} IS NULL THEN {policies} ELSE 0 END"
        return {
            f"sold_{cov}": f"IF({wp} >= 1, 1, 0)",
            f"share_{cov}": f"IF({wp} >= 1, {share}, NULL)",
            f"unknown_{cov}": spoilt if params.nulls == "strict" else "0",
        }

    columns = {name: sql for cov in PREMIUM_COVERAGES for name, sql in figures(cov).items()}
    rows = (
        quotes.where(any_of(conditions[s.rows] for s in stats))
        .withColumns({"TermType": F.lit("NB"), "UWYear": lookback_year(F.col("QuoteVersionDate"), params.end)})
    )
    figured = [f"{row_bits(stats, conditions)} AS {ROWS}", *[f"{sql} AS {name}" for name, sql in columns.items()]]
    if factors is None:
        weight = ROW_WEIGHT if ROW_WEIGHT in quotes.columns else f"1 AS {ROW_WEIGHT}"
        rows = rows.selectExpr(*own, weight, *figured)
    else:
        totals = [f"{'bit_or' if name.startswith('unknown_') else 'sum'}({name}) AS {name}" for name in columns]
        rows = (
            rows.selectExpr(*dict.fromkeys([*map(_q, job), *own]), *figured)
            .groupBy(*dict.fromkeys([*map(_q, job), *own]), ROWS)
            .agg(*[F.expr(total) for total in totals])
            .join(folded_factors(factors, job, brought), job)
        )

    lines = [
        _named_struct({LINE: f"'Q_{cov}'", "sold": f"sold_{cov}", "share": f"share_{cov}", "spoilt": f"unknown_{cov}"})
        for cov in PREMIUM_COVERAGES
    ]
    slots = [f"IF({_in_bits(s.slot)}, {s.measure} * {ROW_WEIGHT}, NULL) AS {s.slot}" for s in stats]
    unpivoted = rows.selectExpr(*keys, ROWS, ROW_WEIGHT, f"array({', '.join(lines)}) AS {LINES}")
    return unpivoted.selectExpr(*keys, ROWS, ROW_WEIGHT, f"inline_outer({LINES})").selectExpr(
        *keys, LINE, *slots, f"{ROWS} & spoilt AS {UNKNOWN}"
    )


def _figure(line: str, slot: str, strict: bool) -> str:
    value = f"coalesce(`{line}`.{slot}, 0)"
    if strict:
        value = f"IF((coalesce(`{line}`.{UNKNOWN}, 0) & {bit_of(slot)}) != 0, 0, {value})"
    return f"CAST({value} AS DOUBLE)" if slot in NUMBER_SLOTS else value


def _stat_columns(stats) -> list[str]:
    columns = []
    for stat in stats:
        if stat in VEHICLE_STATS:
            columns.append(f"{_figure(stat.line, stat.slot, stat.strict)} AS {stat.name}")
        else:
            prefix = "Q_" if stat in QUOTE_STATS else ""
            columns += [f"{_figure(prefix + cov, stat.slot, stat.strict)} AS {stat.column(cov)}"
                        for cov in stat.coverages]
    return columns


def stat_table(
    base: DataFrame | None,
    quotes: DataFrame | None,
    params: PricingParams,
    names: list[str],
    quote_factors: DataFrame | None = None,
    quote_factor_key: str | list[str] = "RowKey",
) -> DataFrame:
    """The named figures by run keys; a key is present if any of them has rows for it.

    Figures a key has no rows for are 0. Missing key values group together.
    """
    by_name = {s.name: s for s in ALL_STATS}
    unknown = [name for name in names if name not in by_name]
    if unknown:
        raise ValueError(f"no such figures: {unknown}")
    stats = [by_name[name] for name in dict.fromkeys(names)]
    own = {c.lower() for c in (*output_columns(), *LINE_FIELDS, KEPT, START_MONTH, *SLOTS, *map(_high, SLOTS), LINE, ROWS, SPOILT, UNKNOWN, SHARE, CELLS, LINES, *COVERAGE_LINES, "V1", "V2", ROW_WEIGHT, "sold")}
    clashes = [f for f in params.rate_factors if f.lower() in own]
    if clashes:
        raise ValueError(f"{clashes} are names of figures and cannot be rating factors")
    from_quotes = [s for s in stats if s in QUOTE_STATS]
    from_premium = [s for s in stats if s not in QUOTE_STATS]

    sides = []
    if from_premium:
        require_columns(base, params.rate_factors, "premium base")
        sides.append(premium_lines(base, params, from_premium))
    if from_quotes and quotes is not None:
        known = [*quotes.columns, *(quote_factors.columns if quote_factors is not None else [])]
        missing = [f for f in params.rate_factors if f not in known]
        if missing:
            raise ValueError(f"quotes lack the rating factors {missing}; attach them or a constant for them")
        sides.append(quote_lines(quotes, params, from_quotes, quote_factors, quote_factor_key))
    if not sides:
        raise ValueError("nothing to summarise: no premium figures asked for and no quotes given")

    lines = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    names_of_lines = []
    if any(s in PREMIUM_STATS for s in from_premium):
        names_of_lines += COVERAGE_LINES
    names_of_lines += sorted({s.line for s in from_premium if s in VEHICLE_STATS})
    if len(sides) > bool(from_premium):
        names_of_lines += [f"Q_{cov}" for cov in PREMIUM_COVERAGES]
    slots = [s for s in SLOTS if s in lines.columns]
    # One row per group and line that has rows; then a group's lines as a map, which holds only those there are, and from
    # it a struct per line. Amounts add up in two parts where those are longs.
    kinds = {s: lines.schema[s].dataType for s in slots}
    parts = {s: Parts.of(kind) for s, kind in kinds.items() if Parts.of(kind)}
    taken_apart = [sql for s, p in parts.items() for sql in (f"{p.high(s)} AS {_high(s)}", f"{p.low(s, p.high(s))} AS {s}")]
    lines = lines.selectExpr(*map(_q, params.keys), LINE, UNKNOWN, *[s for s in slots if s not in parts], *taken_apart)
    totals = {s: f"CAST({p.total(f'sum({_high(s)})', f'sum({s})')} AS {p.sum_type})" for s, p in parts.items()}
    sums = lines.groupBy(*params.keys, LINE).agg(
        *[F.expr(totals.get(s, f"sum({s})")).alias(s) for s in slots], F.bit_or(UNKNOWN).alias(UNKNOWN))
    by_group = sums.groupBy(*params.keys).agg(
        F.map_from_entries(F.collect_list(F.struct(LINE, F.struct(*slots, UNKNOWN).alias("sums")))).alias(CELLS))
    cells = by_group.selectExpr(*[_q(k) for k in params.keys], *[f"try_element_at({CELLS}, '{name}') AS `{name}`" for name in names_of_lines])
    available = [s for s in stats if quotes is not None or s not in QUOTE_STATS]
    absent = [f"CAST(0 AS {'DOUBLE' if s.slot in NUMBER_SLOTS else 'BIGINT'}) AS {c}"
              for s in stats if s not in available for c in s.columns]
    return cells.selectExpr(*[_q(k) for k in params.keys], *_stat_columns(available), *absent)


def output_columns() -> list[str]:
    """The figures of the summary in output order, after the ten keys."""
    stats = {s.name: s for s in ALL_STATS}
    order = [
        "PCVQ_QB", "WVQ_QB", "AVQ_QB", "TPQ_QB",
        "PCVS_QB", "WVS_QB", "AVS_QB", "TPS_QB", "TVS_PB", "TPS_PB",
        "VGEN_QB", "VGEN_PB", "VREN_QB", "VREN_PB",
        "BMAge23_WP_BI", "BMGender_WP_BI", "BMRTPlus_WP_BI", "BMVeh2015_WP_BI",
        "BMMinLimit_WP_BI", "BMLiaOnly_WP_BI", "BMPayFull_WP_BI",
        "WP_QB", "WP_PB", "ADJ_WP", "EE", "EP", "CLEP",
        "Month6Total", "Month6Active",
        "Total1Year", "CXX_QBTotal", "CXX_PBTotal", "Cancels_Other", "Cancels_Fraud",
        "Cancels_NonPay", "CXX_ThreeDays_QB", "CXX_ThreeDays_Total",
        "LOSS_CC_TOTAL", "LOSS_CC", "LOSS_25", "LOSS_100", "LOSS_RI",
    ]
    return ["NetPolQuotes", *(c for name in order for c in stats[name].columns)]


def padded_keys(params: PricingParams) -> list[str]:
    """The ten key columns: the run keys and as many unused ones as it takes."""
    width = len(RUN_KEYS) + MAX_RATING_FACTORS
    return [*params.keys, *(f"var{i}" for i in range(len(params.keys) + 1, width + 1))]


def pricing_summary(
    base: DataFrame,
    quotes: DataFrame | None,
    params: PricingParams,
    quote_factors: DataFrame | None = None,
    quote_factor_key: str | list[str] = "RowKey",
) -> DataFrame:
    """The 365-column summary by look-back year, term type and rating factors.

    Without quotes the quote columns are 0. Rows come unordered; sort where they are
    written (``rateloom.sources.sinks.sorted_by_keys``).
    """
    names = [s.name for s in ALL_STATS]
    figures = stat_table(base, quotes, params, names, quote_factors, quote_factor_key)
    keys = [_q(k) if k in params.keys else f"'.' AS {k}" for k in padded_keys(params)]
    fixed = {"NetPolQuotes": "0.0D AS NetPolQuotes"}
    return figures.selectExpr(*keys, *[fixed.get(c, c) for c in output_columns()])
