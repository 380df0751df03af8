"""Queries over the raw and the strictly cleaned table.

Literals of the data (commodity names, years) are parameters. An ``orderBy`` is there for display and
for top-k; a caller that stores a result drops it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from priceflow.functions.numbers import exact_avg, exact_mean


def avg_price_per_commodity_year(cleaned: DataFrame, ordered: bool = True) -> DataFrame:
    yearly = (
        cleaned.groupBy(F.year("date").alias("price_year"), "commodity", "pricetype")
        .agg(
            F.count("*").alias("num_observations"),
            exact_avg(F.col("price"), 2).alias("avg_price_kes"),
            exact_avg(F.col("usdprice"), 4).alias("avg_price_usd"),
        )
    )
    return yearly.orderBy(F.asc_nulls_last("commodity"), F.asc_nulls_last("price_year")) if ordered else yearly


def avg_price_per_category(cleaned: DataFrame, ordered: bool = True) -> DataFrame:
    """Folds to one row per (category, commodity) in the map tasks, so that the exact distinct count
    of a category that holds most rows is a count of few rows."""
    categories = (
        cleaned.groupBy("category")
        .agg(
            F.count_distinct("commodity").alias("num_commodities"),
            F.count("*").alias("num_observations"),
            exact_avg(F.col("price"), 2).alias("avg_price_kes"),
            exact_avg(F.col("usdprice"), 4).alias("avg_price_usd"),
            F.min("price").alias("min_price_kes"),
            F.max("price").alias("max_price_kes"),
        )
    )
    return categories.orderBy(F.desc_nulls_first("avg_price_kes")) if ordered else categories


def commodity_trend_by_year_type(cleaned: DataFrame, commodity: str = "Maize (white)") -> DataFrame:
    """The yearly averages of one commodity; ``commodity`` is a LIKE pattern, case counts."""
    return avg_price_per_commodity_year(cleaned.where(F.col("commodity").like(commodity)))


def wholesale_vs_retail(raw: DataFrame, commodity: str = "%beans%") -> DataFrame:
    def average(price_type: str) -> Column:
        return exact_avg(F.when(F.lower("pricetype") == price_type, F.col("price")), 2)

    return (
        raw.where(F.lower("commodity").like(commodity))
        .groupBy(F.year("date").alias("observation_year"))
        .agg(
            average("wholesale").alias("avg_wholesale_price"),
            average("retail").alias("avg_retail_price"),
        )
        .orderBy(F.asc_nulls_last("observation_year"))
    )


def _in_year(year: int) -> Column:
    """A year as a range of dates, which the Parquet scan can skip row groups by."""
    date = F.col("date")
    return (date >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (
        date <= F.make_date(F.lit(year), F.lit(12), F.lit(31))
    )


def sharpest_increase(
    raw: DataFrame,
    from_year: int = 2019,
    to_year: int = 2024,
    exclude: Sequence[str] = ("Fuel%", "Maize%", "Bread"),
) -> DataFrame:
    """Change of the average price between two years, from averages that are not rounded yet. A
    commodity without a price in the later year comes first, with a null change."""
    kept = raw.where(_in_year(from_year) | _in_year(to_year))
    for pattern in exclude:
        kept = kept.where(~F.col("commodity").like(pattern))

    def mean(year: int) -> Column:
        return exact_mean(F.when(_in_year(year), F.col("price"))).cast("decimal(24,12)")

    before, after = F.col("before"), F.col("after")
    return (
        kept.groupBy("commodity")
        .agg(mean(from_year).alias("before"), mean(to_year).alias("after"))
        .where(before > 0)
        .select(
            "commodity",
            F.round(before, 2).alias(f"price_{from_year}"),
            F.round(after, 2).alias(f"price_{to_year}"),
            F.round((after - before) / before * 100, 2).alias("percentage_increase"),
        )
        .orderBy(F.desc_nulls_first("percentage_increase"))
    )


def commodity_yearly_wholesale(
    cleaned: DataFrame, commodity: str = "Maize (white)", price_type: str = "Wholesale"
) -> DataFrame:
    return (
        cleaned.where((F.col("commodity") == commodity) & (F.col("pricetype") == price_type))
        .groupBy(F.year("date").alias("price_year"), "commodity")
        .agg(exact_avg(F.col("price"), 2).alias("avg_yearly_price"))
        .orderBy(F.asc_nulls_last("price_year"))
    )


def widely_tracked_commodities(cleaned: DataFrame, more_than: int = 10) -> DataFrame:
    return (
        cleaned.groupBy("commodity")
        .agg(F.count_distinct("market").alias("number_of_markets"))
        .where(F.col("number_of_markets") > more_than)
        .orderBy(F.desc_nulls_first("number_of_markets"))
    )


def distinct_counts(df: DataFrame, keys: list[str], counts: dict[str, str]) -> DataFrame:
    """The number of different values (not null) of several columns in each group, named by ``counts``.

    Several distinct counts in one aggregate make a row for each of them out of every row. Here rows are folded to the
    combinations that occur first, and only those are taken apart, into (number of the column, value).
    """
    columns = list(counts)
    kind, value = "_column", "_value"
    entries = F.array(*[F.struct(F.lit(n).alias(kind), F.col(c).cast("string").alias(value)) for n, c in enumerate(columns)])
    values = df.select(*keys, *columns).distinct().select(*keys, F.inline(entries)).distinct()
    held = [F.count_if((F.col(kind) == n) & F.col(value).isNotNull()).alias(counts[c]) for n, c in enumerate(columns)]
    return values.groupBy(*keys).agg(*held)


def market_variety_top(cleaned: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` markets with most commodities; the names decide between equals. Rows are folded once to the sets
    of names of a market, in the map tasks first, and only ``k`` rows per task reach the final order."""
    counts = {"category": "total_categories", "commodity": "unique_commodities_sold"}
    return (
        distinct_counts(cleaned, ["county", "market"], counts)
        .orderBy(F.desc("unique_commodities_sold"), F.asc_nulls_last("county"), F.asc_nulls_last("market"))
        .limit(k)
    )
