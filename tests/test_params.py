from datetime import date

import pytest

from rateloom.params import PricingParams, months_back, years_back
from rateloom.plans.summary import padded_keys

DAYS = dict(prem_loss_start="1998-07-01", end="2001-07-01", sale_quote_start="2000-07-01", renewal_start="2000-07-01")


@pytest.mark.parametrize("n", [0, 3, 8])
def test_keys_are_padded_to_ten(n):
    keys = padded_keys(PricingParams(**DAYS, rate_factors=[f"f{i}" for i in range(n)]))
    assert len(keys) == 10
    assert keys[: n + 2] == ["TermType", "UWYear", *[f"f{i}" for i in range(n)]]
    assert keys[n + 2:] == [f"var{i}" for i in range(n + 3, 11)]


@pytest.mark.parametrize("factors", [[f"f{i}" for i in range(9)], ["a", "a"], ["UWYear"], ["TermType"]])
def test_bad_factor_lists_are_rejected(factors):
    with pytest.raises(ValueError):
        PricingParams(**DAYS, rate_factors=factors)


def test_leap_day_end_is_rejected():
    with pytest.raises(ValueError, match="one year earlier"):
        PricingParams(**{**DAYS, "end": "2020-02-29"})


def test_unknown_null_policy_is_rejected():
    with pytest.raises(ValueError, match="strict"):
        PricingParams(**DAYS, nulls="ignore")


def test_month_and_year_arithmetic():
    assert months_back(date(2019, 8, 31), 6) == date(2019, 2, 28)
    assert months_back(date(2019, 1, 15), 6) == date(2018, 7, 15)
    assert years_back(date(2020, 2, 29), 1) is None
    assert years_back(date(2019, 7, 1), 1) == date(2018, 7, 1)


def test_leap_day_sale_start_has_no_cancellation_year():
    p = PricingParams(**{**DAYS, "sale_quote_start": "2000-02-29"})
    assert p.cancel_start is None
    assert p.earliest_start == date(1998, 7, 1)
