from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from base_helpers import rows

from priceflow.plans import star_queries, strict_queries


def day(year, month=1):
    return datetime.date(year, month, 15)


def raw(spark, *data):
    schema = "date date, commodity string, pricetype string, price decimal(8,2), usdprice decimal(8,2)"
    return spark.createDataFrame([(d, c, t, Decimal(p) if p else None, Decimal(1)) for d, c, t, p in data], schema)


def test_sharpest_increase_puts_the_unknown_first(spark):
    df = raw(
        spark, (day(2019), "Beans", "Retail", "3"), (day(2019), "Beans", "Retail", "3.01"), (day(2024), "Beans", "Retail", "4"),
        (day(2019), "Peas", "Retail", "1"), (day(2024), "Rice", "Retail", "1"), (day(2019), "Maize flour", "Retail", "1"),
        (day(2019), "Free", "Retail", "0.00"), (day(2020), "Beans", "Retail", "50"),
    )
    found = [tuple(r) for r in strict_queries.sharpest_increase(df).collect()]
    assert found == [
        ("Peas", Decimal("1.00"), None, None),
        ("Beans", Decimal("3.01"), Decimal("4.00"), Decimal("33.11")),
    ]


def test_like_patterns_and_price_types(spark):
    df = raw(
        spark, (day(2019), "Beans (dry)", "Retail", "2"), (day(2019), "BEANS", "wholesale", "5"), (None, "beans", "Farm", "9"),
    )
    assert rows(strict_queries.wholesale_vs_retail(df)) == [(None, None, None), (2019, Decimal("5.00"), Decimal("2.00"))]
    assert strict_queries.commodity_trend_by_year_type(df, "beans").count() == 1


def test_top_markets_break_ties_by_name(spark):
    data = [("c", m, f"k{i % 2}", f"n{i}") for m in "hgfedcba" for i in range(3)] + [("c", "z", "k", n) for n in "abcd"]
    df = spark.createDataFrame(data, "county string, market string, category string, commodity string")
    found = [tuple(r) for r in strict_queries.market_variety_top(df, 3).collect()]
    assert found == [("c", "z", 1, 4), ("c", "a", 2, 3), ("c", "b", 2, 3)]


def star(spark, *data):
    """(date, commodity id, usd price, price per kg)"""
    fact = spark.createDataFrame(
        [(d, c, 1, Decimal(u), Decimal(u), Decimal(k) if k else None) for d, c, u, k in data],
        "date_id date, commodity_id int, market_id int, price decimal(12,4), usd_price decimal(12,4), price_per_kg decimal(12,4)",
    )
    dates = fact.selectExpr("date_id", "year(date_id) AS year", "month(date_id) AS month").distinct()
    commodities = spark.createDataFrame(
        [(1, "Maize", "Cereals", "KG"), (2, "Beans", "Pulses", "KG"), (3, "Maize", "Cereals", "KG")],
        "commodity_id int, commodity string, category string, unit string",
    )
    return fact, dates, commodities


def test_price_trends_compare_with_the_previous_observed_year(spark):
    fact, dates, commodities = star(
        spark, (day(2018), 1, "0", None), (day(2019), 1, "2", "4"), (day(2021), 1, "3", None), (day(2021), 3, "2", "1"), (day(2020), 2, "1", None),
    )
    found = star_queries.price_trends(fact, dates, commodities)
    assert rows(found.where("commodity = 'Maize'"), "year", "avg_usd_price", "prev_year_usd_price", "yoy_change_pct", "observations") == [
        (2018, Decimal("0.0000"), None, None, 1),
        (2019, Decimal("2.0000"), Decimal("0.0000"), None, 1),
        (2021, Decimal("2.5000"), Decimal("2.0000"), Decimal("25.00"), 2),
    ]
    assert rows(found.where("commodity = 'Maize'"), "avg_price_per_kg_kes") == [(None,), (Decimal("1.0000"),), (Decimal("4.0000"),)]


def test_summary_of_several_ids_of_one_name(spark):
    fact, _, commodities = star(spark, (day(2019), 1, "1", None), (day(2020), 3, "3", None), (day(2020), 2, "5", None))
    found = {r.commodity: r for r in star_queries.commodity_summary(fact, commodities).collect()}
    assert (found["Maize"].stddev_usd_price, found["Maize"].total_observations) == (1.4142, 2)
    assert (found["Maize"].first_observed, found["Maize"].last_observed) == (day(2019), day(2020))
    assert found["Beans"].stddev_usd_price is None
    top = star_queries.panel_top_usd(fact, commodities, 1).collect()
    assert [tuple(r) for r in top] == [("Beans", Decimal("5.0000"))]


def test_equals_share_the_last_rank(spark):
    prices = {"a": "9", "b": "8", "c": "8", "d": "7", "e": "6", "f": "6", "g": "5"}
    staging = spark.createDataFrame(
        [(day(2020), c, Decimal(p)) for c, p in prices.items()] + [(day(2021), "a", Decimal(1))],
        "date date, commodity string, usd_price decimal(12,4)",
    )
    top = star_queries.monthly_top_commodities(staging).where("price_month = '2020-01-01'")
    assert rows(top, "commodity", "price_rank") == [("a", 1), ("b", 2), ("c", 2), ("d", 4), ("e", 5), ("f", 5)]


def test_deviation_of_groups_beyond_ten_billion_rows(spark):
    """Partial rows as a fold gives them, with counts that no test table could hold."""
    n = 30_000_000_000
    parts = [(n, f"{n}.0000", f"{n}.00000000"), (n, f"{3 * n}.0000", f"{9 * n}.00000000")]
    text = spark.createDataFrame(parts, "usd_count bigint, total string, squares string")
    folded = text.selectExpr("usd_count", "cast(total AS decimal(22,4)) AS usd_sum", "cast(squares AS decimal(38,8)) AS usd_squares")
    assert folded.agg(star_queries._deviation_of_parts("usd").alias("d")).first().d == pytest.approx(1.0, rel=1e-9)
    small = [(2, "0.0003", "0.00000005"), (1, "99999999.9999", "9999999999999980.00000001")]
    found = []
    for row in small:
        one = spark.createDataFrame([row], "usd_count bigint, total string, squares string")
        one = one.selectExpr("usd_count", "cast(total AS decimal(22,4)) AS usd_sum", "cast(squares AS decimal(38,8)) AS usd_squares")
        found.append(one.agg(star_queries._deviation_of_parts("usd").alias("d")).first().d)
    assert found == [pytest.approx(0.0000707, rel=1e-3), None]


def test_monthly_averages_fold_rows_once(spark):
    """Behind small dimensions the fact rows meet one shuffle: the fold by the attributes of the ids."""
    fact, dates, commodities = star(
        spark, (day(2019), 1, "1", "4"), (day(2019), 3, "2.0001", None), (day(2019), 2, "5", "5"), (day(2019, 2), 1, "7", None),
    )
    markets = spark.createDataFrame([(1, "Hola", "Tana")], "market_id int, market string, county string")
    found = star_queries.monthly_avg_price(fact, dates, commodities, markets)
    assert rows(found, "month", "commodity", "observation_count", "avg_usd_price", "avg_price_per_kg", "min_price", "max_price") == [
        (1, "Beans", 1, Decimal("5.0000"), Decimal("5.00"), Decimal("5.00"), Decimal("5.00")),
        (1, "Maize", 2, Decimal("1.5001"), Decimal("4.00"), Decimal("1.00"), Decimal("2.00")),
        (2, "Maize", 1, Decimal("7.0000"), None, Decimal("7.00"), Decimal("7.00")),
    ]
    folds = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line]
    assert sum("commodity" in fold for fold in folds) == 1
