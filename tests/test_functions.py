from datetime import date

from pyspark.sql import functions as F

from rateloom.functions.dates import lookback_year, minus_months_or_null, window_label
from rateloom.functions.measures import capped, distinct_with_null, strict_count, strict_sum
from rateloom.functions.recode import band, catastrophe_coverage, channel, coverage_code, one_against_rest, term_type


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_channel_keeps_missing(spark):
    df = spark.createDataFrame([("PriceComparison",), ("WebOnly",), ("Broker",), (None,)], "c string")
    assert column(df, channel(F.col("c"))) == ["PC", "Web", "Agent", None]


def test_term_type_follows_transaction_first(spark):
    rows = [("New Business", "Renewal"), ("Renewal", "New Business"), (None, "Change"), ("Renewal", "Change"),
            ("Rewrite", "Change"), (None, None)]
    df = spark.createDataFrame(rows, "term string, transaction string")
    assert column(df, term_type(F.col("term"), F.col("transaction"))) == ["RN", "NB", "NB", "RN", "Rewrite", "NB"]


def test_catastrophe_claims(spark):
    rows = [(2, "Comprehensive"), (1, "Comprehensive"), (None, "Comprehensive"), (2, "Collision"), (2, None)]
    df = spark.createDataFrame(rows, "k int, c string")
    assert column(df, catastrophe_coverage(F.col("c"), F.col("k"))) == [
        "COMP_CAT", "Comprehensive", "Comprehensive", "Collision", None]


def test_coverage_codes(spark):
    df = spark.createDataFrame([("BodilyInjury",), ("PIPLostWages",), ("Unknown",), ("Glass",), (None,)], "c string")
    assert column(df, coverage_code(F.col("c"))) == ["BI", "PIPWAGE", "UNK", None, None]


def test_months_back_without_that_day_is_null(spark):
    df = spark.createDataFrame([(date(2019, 4, 30),), (date(2019, 4, 28),), (date(2019, 12, 31),), (None,)], "d date")
    assert column(df, minus_months_or_null(F.col("d"), 2)) == [None, date(2019, 2, 28), date(2019, 10, 31), None]


def test_lookback_year(spark):
    days = [date(2002, 1, 1), date(2000, 7, 1), date(2000, 6, 30), date(1999, 7, 1), date(1999, 6, 30), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert column(df, lookback_year(F.col("d"), date(2001, 7, 1))) == [1, 1, 2, 2, 3, None]


def test_window_label(spark):
    df = spark.createDataFrame([(date(2016, 9, 30), date(2019, 1, 5))], "a date, b date")
    assert column(df, window_label(F.col("a"), F.col("b"))) == ["30SEP16 - 05JAN19"]


def test_bands_leave_fractions_between_edges_out(spark):
    df = spark.createDataFrame([(-26.0,), (-12.5,), (0.0,), (0.5,), (25.0,), (26.0,), (None,)], "a double")
    assert column(df, band(F.col("a"))) == [
        "a) Less than -25", None, "g) -1 to 0", None, "l) 13 to 25", "m) More than 25", "z) Single Driv"]
    states = spark.createDataFrame([("MD",), ("VA",), (None,)], "s string")
    assert column(states, one_against_rest(F.col("s"), "MD")) == ["MD", "CW", "CW"]


def test_strict_and_distinct_aggregates(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), ("a", 7), ("b", 1), ("b", 1)], "k string, v int")
    rows = df.groupBy("k").agg(
        strict_sum(F.col("v")).alias("s"), strict_count(F.col("v") >= 1).alias("n"), distinct_with_null(F.col("v")).alias("d")
    ).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("a", None, None, 3), ("b", 2, 2, 1)]


def test_caps_keep_missing(spark):
    df = spark.createDataFrame([(30000,), (200000,), (-50,), (None,)], "v int")
    assert column(df, F.expr(capped("v", 25000))) == [25000, 25000, -50, None]
