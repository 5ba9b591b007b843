"""Columns keep their own types: no digit is cut, whatever types the sources hold."""

import pytest
from pyspark.sql import functions as F

from rateloom.operators.losses import develop
from rateloom.plans.summary import widest_type


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def _ibnr(spark, **amounts):
    from rateloom.coverages import IBNR_COVERAGES

    row = spark.range(1).withColumn("VehicleTermKey", F.lit(1).cast("long")).drop("id")
    return row.withColumns({f"IBNR_{c}": F.expr(amounts.get(c, "CAST(0 AS DECIMAL(18,2))")) for c in IBNR_COVERAGES})


def _losses(spark, **amounts):
    from rateloom.coverages import LOSS_COVERAGES

    row = spark.range(1).withColumn("VehicleTermKey", F.lit(1).cast("long")).drop("id")
    row = row.withColumns({f"LOSS_RI_{c}": F.expr(amounts.get(c, "CAST(0 AS DECIMAL(18,2))")) for c in LOSS_COVERAGES})
    return row.withColumns({f"LOSS_CC_{c}": F.lit(0).cast("long") for c in (*LOSS_COVERAGES, "TOTAL")})


def test_large_losses_with_many_digits_stay(spark, ansi):
    got = develop(_ibnr(spark, BI="CAST(0.46 AS DECIMAL(18,2))"), _losses(spark, BI="CAST(250000000 AS DECIMAL(38,10))")).first()
    assert float(got["LOSS_RI_BI"]) == 250000000.46


def test_ibnr_keeps_the_digits_of_each_coverage(spark, ansi):
    got = develop(_ibnr(spark, PD="CAST(0.4567 AS DECIMAL(18,4))"), _losses(spark, PD="CAST(5 AS DECIMAL(18,2))")).first()
    assert str(got["LOSS_RI_PD"]) == "5.4567"


@pytest.mark.parametrize("types,expected", [
    (("int", "double"), "double"), (("decimal(18,0)", "decimal(18,2)"), "decimal(20,2)"), (("int", "tinyint"), "bigint"),
    (("boolean", "int"), "bigint"), (("bigint", "decimal(3,1)"), "decimal(21,1)"),
])
def test_widest_type(spark, types, expected):
    base = spark.range(1).select(*(F.lit(None).cast(t).alias(f"c{i}") for i, t in enumerate(types)))
    assert widest_type(base, base.columns) == expected
