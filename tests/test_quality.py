from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from base_helpers import rows
from test_star import cleaned_rows

from priceflow.operators import quality


def found(report):
    return {r.metric: (r.value, r.passed) for r in report.collect()}


def test_duplicates_count_every_member_and_take_nulls_as_equal(spark):
    cleaned = cleaned_rows(spark, {}, {}, {}, {"date": None}, {"date": None}, {"market_id": 9})
    assert rows(quality.check_duplicate_keys(cleaned)) == [("duplicate_keys", "duplicates", "5", False)]
    assert rows(quality.check_duplicate_keys(cleaned.limit(1))) == [("duplicate_keys", "duplicates", "0", True)]


def test_prices_dates_and_nulls(spark):
    old = datetime.date(1999, 12, 31)
    cleaned = cleaned_rows(spark, {}, {"price": Decimal(0)}, {"usd_price": Decimal(-1)}, {"price": None, "date": old})
    assert found(quality.check_positive_prices(cleaned)) == {"negative_prices": ("1", False), "negative_usd_prices": ("1", False)}
    assert found(quality.check_date_range(cleaned)) == {"min_date": ("1999-12-31", False), "max_date": ("2020-01-04", False)}
    assert found(quality.check_null_critical(cleaned))["null_price"] == ("1", False)
    assert found(quality.check_date_range(cleaned_rows(spark, {"date": None})))["min_date"] == (None, False)


@pytest.mark.parametrize(
    ("values", "outliers", "passed"),
    [([5], 0, True), ([5, 5, 5], 0, True), ([None, None], 0, True), ([1] * 40 + [99], 1, False), ([1] * 200 + [99], 1, True)],
)
def test_outliers(spark, values, outliers, passed):
    cleaned = cleaned_rows(spark, *[{"price_per_kg": None if v is None else Decimal(v)} for v in values])
    assert found(quality.check_price_outliers(cleaned)) == {"outliers": (str(outliers), passed)}


def test_report_and_gates(spark):
    good = quality.quality_report(cleaned_rows(spark, {})).collect()
    assert all(r.passed for r in good) and good[-1].check == "overall"
    quality.apply_gate(good, "strict")
    repeated = quality.quality_report(cleaned_rows(spark, {}, {})).collect()
    quality.apply_gate(repeated, "critical")
    with pytest.raises(quality.QualityCheckError, match="duplicate_keys"):
        quality.apply_gate(repeated, "strict")
    empty = quality.quality_report(cleaned_rows(spark, {}).limit(0)).collect()
    with pytest.raises(quality.QualityCheckError, match="not_empty"):
        quality.apply_gate(empty, "critical")
