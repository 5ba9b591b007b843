from datetime import date
from decimal import Decimal

import pytest

from rateloom.coverages import IBNR_COVERAGES
from rateloom.operators.checks import join_growth, repeated_keys, require_unique
from rateloom.operators.losses import develop, loss_by_vehicle, loss_summary, losses_as_of, total_claims, with_caps

LOSS = ("VehicleTermKey long, ClaimNumber string, TransactionDate date, CoverageType string, "
        "NetPaidClaims decimal(18,2), NetCaseReserves decimal(18,2)")
D = Decimal


@pytest.fixture(scope="module")
def losses(spark):
    day = date(2001, 1, 1)
    return spark.createDataFrame([
        (1, "A", day, "BodilyInjury", D("100.00"), D("0.00")),
        (1, "A", day, "BodilyInjury", D("20.00"), D("5.00")),
        (1, "A", day, "PropertyDamage", D("7.00"), D("0.00")),
        (1, None, day, "BodilyInjury", D("1.00"), D("1.00")),
        (1, "G", day, "Glass", D("9.00"), D("0.00")),
        (2, "B", day, "Collision", D("100.00"), None),
        (2, "C", day, "Collision", D("50.00"), D("10.00")),
        (3, "E", day, "Unknown", D("3.00"), D("0.00")),
        (4, "H", day, "COMP_CAT", D("300000.00"), D("0.00")),
    ], LOSS)


@pytest.fixture(scope="module")
def ibnr(spark):
    names = [f"IBNR_{c}" for c in IBNR_COVERAGES]
    rows = [(1, *[D("2.00")] * 12), (2, *[None] * 12), (9, *[D("1.00")] * 12)]
    return spark.createDataFrame(rows, "VehicleTermKey long, " + ", ".join(f"{n} decimal(18,2)" for n in names))


def by_key(df):
    return {r["VehicleTermKey"]: r for r in df.collect()}


def test_summary_and_totals(losses):
    cells = {(r.VehicleTermKey, r.Coverage): (r.LOSS_RI, r.LOSS_CC) for r in loss_summary(losses).collect()}
    assert cells[1, "BI"] == (D("127.00"), 2)
    assert cells[1, "PD"] == (D("7.00"), 1)
    assert cells[1, None] == (D("9.00"), 1)
    assert cells[2, "COL"] == (None, 2)
    assert cells[3, "UNK"] == (D("3.00"), 1)
    totals = {r.VehicleTermKey: r.LOSS_CC_TOTAL for r in total_claims(losses).collect()}
    assert totals == {1: 3, 2: 2, 3: 1, 4: 1}


def test_pivot_agrees_with_summary(losses):
    wide = by_key(loss_by_vehicle(losses))
    assert (wide[1].LOSS_RI_BI, wide[1].LOSS_CC_BI, wide[1].LOSS_CC_PD, wide[1].LOSS_CC_TOTAL) == (D("127.00"), 2, 1, 3)
    assert (wide[2].LOSS_RI_COL, wide[2].LOSS_CC_COL) == (None, 2)
    assert (wide[3].LOSS_RI_BI, wide[3].LOSS_CC_TOTAL) == (D("0.00"), 1)
    assert wide[1].LOSS_RI_COMP_CAT == D("0.00")


def test_development_and_caps(losses, ibnr):
    rows = by_key(with_caps(develop(ibnr, loss_by_vehicle(losses))))
    assert sorted(rows) == [1, 2, 9]
    assert (rows[1].LOSS_RI_BI, rows[1].LOSS_RI_TOW) == (D("129.00"), D("0.00"))
    assert (rows[2].LOSS_RI_COL, rows[2].LOSS_CC_COL) == (D("0.00"), 2)
    assert (rows[9].LOSS_RI_BI, rows[9].LOSS_CC_TOTAL) == (D("1.00"), 0)
    kept = by_key(with_caps(develop(ibnr, loss_by_vehicle(losses), orphan_losses="keep")))
    assert sorted(kept) == [1, 2, 3, 4, 9]
    assert (kept[4].LOSS_RI_COMP_CAT, kept[4].LOSS_25_COMP_CAT, kept[4].LOSS_100_COMP_CAT) == (
        D("300000.00"), D("25000.00"), D("100000.00"))
    with pytest.raises(ValueError):
        develop(ibnr, losses, orphan_losses="maybe")


def test_losses_add_up_exactly_as_longs(spark):
    """Large, negative and broken amounts, within a claim and over claims; no sum is over a wide decimal."""
    day, top = date(2001, 1, 1), D("9999999999999999.99")
    given = [("A", top, top), ("A", D("-0.01"), D("0.00")), ("B", D("-1000000.00"), D("999999.99")), ("B", -top, D("0.07")), ("C", top, top)]
    rows = [(1, claim, day, "BodilyInjury", paid, reserve) for claim, paid, reserve in given for _ in range(3)]
    found = loss_by_vehicle(spark.createDataFrame(rows, LOSS))
    assert found.schema["LOSS_RI_BI"].dataType.simpleString() == "decimal(37,2)"
    assert found.first()["LOSS_RI_BI"] == 3 * sum(paid + reserve for _, paid, reserve in given)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(unscaledvalue(low_" in plan.lower() and "sum(incurred" not in plan


def test_losses_of_more_digits_and_doubles_add_up_as_they_are(spark):
    day = date(2001, 1, 1)
    for kind, one, other, total in (("decimal(30,10)", D("1234567890123456789.0000000001"), D("0.0000000009"), D("2469135780246913578.000000002")),
                                    ("double", 0.5, 0.25, 1.5)):
        rows = [(1, "A", day, "BodilyInjury", one, other)] * 2
        found = loss_by_vehicle(spark.createDataFrame(rows, LOSS.replace("decimal(18,2)", kind)))
        assert found.first()["LOSS_RI_BI"] == total


def test_as_of_cut(spark, losses):
    premium = spark.createDataFrame([(date(2000, 12, 31),), (None,)], "EarnedAsOfDate date")
    assert losses_as_of(losses, premium).count() == 0
    later = spark.createDataFrame([(date(2001, 1, 1),)], "EarnedAsOfDate date")
    assert losses_as_of(losses, later).count() == 9


def test_one_vehicle_with_a_third_of_all_claims(spark):
    hot = spark.range(30000).selectExpr(
        "IF(id % 3 = 0, 1, id) AS VehicleTermKey", "concat('c', id % 5000) AS ClaimNumber", "DATE'2001-01-01' AS TransactionDate",
        "'BodilyInjury' AS CoverageType", "CAST(1 AS DECIMAL(18,2)) AS NetPaidClaims", "CAST(1 AS DECIMAL(18,2)) AS NetCaseReserves")
    row = by_key(loss_by_vehicle(hot).where("VehicleTermKey = 1"))[1]
    claims = {i % 5000 for i in range(30000) if i % 3 == 0 or i == 1}
    assert row.LOSS_CC_TOTAL == len(claims)
    assert row.LOSS_RI_BI == D("2.00") * (10000 + 1)


def test_key_checks(spark, ibnr):
    twice = ibnr.unionAll(ibnr.where("VehicleTermKey = 1"))
    assert [tuple(r) for r in repeated_keys(twice, "VehicleTermKey").collect()] == [(1, 2)]
    with pytest.raises(ValueError, match="IBNR"):
        require_unique(twice, "VehicleTermKey", "IBNR")
    assert require_unique(ibnr, "VehicleTermKey", "IBNR") is ibnr
    left = spark.createDataFrame([(1,)] * 4 + [(2,)], "k int")
    right = spark.createDataFrame([(1,)] * 3 + [(3,)], "k int")
    assert tuple(join_growth(left, right, "k").first()) == (5, 4, 12, True)
