"""Queries over the star schema and the staging table.

Dimensions carry no broadcast hint: read from Parquet, they have a known size, and Catalyst broadcasts
those below the threshold; a larger one is joined by a shuffle that AQE splits where a key is hot.
Where the answer can be put together from sums per commodity or market id, the fact table is folded by
id before the join, which then joins few rows whatever the dimension's size and however many rows one
id holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from priceflow.functions.dates import month_start
from priceflow.functions.numbers import exact_avg, exact_mean


def _parts(*measures: str) -> list[Column]:
    """Sum and count of each measure, which can be added up again."""
    return [
        part
        for m in measures
        for part in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_count"))
    ]


def _avg(measure: str, digits: int) -> Column:
    """The total keeps 20 digits before the point, which leaves the quotient 18 behind it."""
    return F.round(F.try_divide(F.sum(measure).cast("decimal(24,4)"), F.count(measure)), digits)


def _avg_of_parts(measure: str, digits: int) -> Column:
    """The total keeps 20 digits before the point, which leaves the quotient 18 behind it."""
    total = F.sum(f"{measure}_sum").cast("decimal(24,4)")
    return F.round(F.try_divide(total, F.sum(f"{measure}_count")), digits)


def monthly_avg_price(
    fact: DataFrame, dim_date: DataFrame, dim_commodity: DataFrame, dim_market: DataFrame
) -> DataFrame:
    """Folded by month and attributes at once, behind the joins. A month, commodity and market have hardly more than one row for each
    price type, so a fold by the ids would shuffle nearly all rows, with their sums, once more.
    """
    dated = fact.join(dim_date.select("date_id", "year", "month"), "date_id")
    month = month_start(F.col("date_id")).alias("price_month")
    return (
        dated.join(dim_commodity.select("commodity_id", "commodity", "category"), "commodity_id")
        .join(dim_market.select("market_id", "county"), "market_id")
        .groupBy("year", "month", month, "county", "commodity", "category")
        .agg(
            F.count("*").alias("observation_count"),
            _avg("price", 2).alias("avg_price_kes"),
            _avg("usd_price", 4).alias("avg_usd_price"),
            _avg("price_per_kg", 2).alias("avg_price_per_kg"),
            F.round(F.min("price"), 2).alias("min_price"),
            F.round(F.max("price"), 2).alias("max_price"),
        )
        .orderBy(F.desc_nulls_first("price_month"), F.asc_nulls_last("county"), F.asc_nulls_last("commodity"))
    )


def price_trends(fact: DataFrame, dim_date: DataFrame, dim_commodity: DataFrame) -> DataFrame:
    """Yearly averages and the change against the previous observed year, both from values already
    rounded to 4 places. The category decides the order of rows of one commodity and year."""
    yearly = (
        fact.join(dim_date.select("date_id", "year"), "date_id")
        .groupBy("year", "commodity_id")
        .agg(*_parts("usd_price", "price_per_kg"), F.count("*").alias("rows"))
        .join(dim_commodity.select("commodity_id", "commodity", "category"), "commodity_id")
        .groupBy("year", "commodity", "category")
        .agg(
            _avg_of_parts("usd_price", 4).cast("decimal(18,4)").alias("avg_usd_price"),
            _avg_of_parts("price_per_kg", 4).cast("decimal(18,4)").alias("avg_price_per_kg_kes"),
            F.sum("rows").alias("observations"),
        )
    )
    previous = F.lag("avg_usd_price").over(Window.partitionBy("commodity").orderBy("year", "category"))
    change = F.try_divide(F.col("avg_usd_price") - F.col("prev_year_usd_price"), F.col("prev_year_usd_price"))
    return (
        yearly.withColumn("prev_year_usd_price", previous)
        .withColumn("yoy_change_pct", F.round(change * 100, 2))
        .orderBy(F.asc_nulls_last("commodity"), F.asc_nulls_last("year"))
    )


def commodity_summary(fact: DataFrame, dim_commodity: DataFrame) -> DataFrame:
    """Per commodity, category and unit. Counts, sums and sums of squares add up, exactly, as decimals."""
    usd = F.col("usd_price")
    ids = fact.groupBy("commodity_id").agg(
        *_parts("price", "usd_price"),
        F.sum((usd * usd).cast("decimal(28,8)")).alias("usd_price_squares"),
        F.count("*").alias("rows"),
        F.min(usd).alias("lowest"),
        F.max(usd).alias("highest"),
        F.min("date_id").alias("first_date"),
        F.max("date_id").alias("last_date"),
    )
    return (
        ids.join(dim_commodity.select("commodity_id", "commodity", "category", "unit"), "commodity_id")
        .groupBy("commodity", "category", "unit")
        .agg(
            F.sum("rows").alias("total_observations"),
            _avg_of_parts("price", 2).alias("avg_price_kes"),
            _avg_of_parts("usd_price", 4).alias("avg_usd_price"),
            F.round(_deviation_of_parts("usd_price"), 4).alias("stddev_usd_price"),
            F.min("lowest").alias("min_usd_price"),
            F.max("highest").alias("max_usd_price"),
            F.min("first_date").alias("first_observed"),
            F.max("last_date").alias("last_observed"),
        )
        .orderBy(F.desc_nulls_first("avg_usd_price"))
    )


def _deviation_of_parts(measure: str) -> Column:
    """The sample deviation, from exact sums: it does not depend on how the rows are split.

    Squares are taken around a pivot, the mean to 4 places: that sum is exact for 10**13 rows of prices below 10**8, and
    what the pivot is off the mean is a small correction.
    """
    n = F.sum(f"{measure}_count")
    total = F.sum(f"{measure}_sum").cast("decimal(25,4)")
    squares = F.sum(f"{measure}_squares").cast("decimal(37,8)")
    pivot = F.round(F.try_divide(total, n), 4).cast("decimal(12,4)")
    count = n.cast("decimal(13,0)")
    # n p p - 2 p total, then the squares: scales of 8 digits are kept at every step.
    moved = (count * (pivot * pivot).cast("decimal(24,8)")).cast("decimal(36,8)") - (2 * (pivot * total).cast("decimal(35,8)")).cast("decimal(36,8)")
    around = (squares + moved.cast("decimal(37,8)")).cast("double")
    off = (total - (count * pivot).cast("decimal(25,4)")).cast("double")
    variance = (around - off * off / n.cast("double")) / (n.cast("double") - 1)
    return F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), variance)))


def panel_monthly_retail_trend(
    staging: DataFrame,
    commodity: str = "%Maize%",
    price_type: str = "Retail",
    label: str = "Avg Maize Price (KES)",
) -> DataFrame:
    return (
        staging.where(F.col("commodity").ilike(commodity) & (F.col("price_type") == price_type))
        .groupBy(month_start(F.col("date")).alias("time"))
        .agg(exact_avg(F.col("price"), 2).alias(label))
        .orderBy(F.asc_nulls_last("time"))
    )


def panel_top_usd(fact: DataFrame, dim_commodity: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` dearest commodities; the name decides between equals."""
    return (
        fact.groupBy("commodity_id")
        .agg(*_parts("usd_price"))
        .join(dim_commodity.select("commodity_id", "commodity"), "commodity_id")
        .groupBy("commodity")
        .agg(_avg_of_parts("usd_price", 4).alias("Avg USD Price"))
        .orderBy(F.desc_nulls_first("Avg USD Price"), F.asc_nulls_last("commodity"))
        .limit(k)
    )


def panel_observations_by_county(fact: DataFrame, dim_market: DataFrame) -> DataFrame:
    return (
        fact.groupBy("market_id")
        .agg(F.count("*").alias("rows"))
        .join(dim_market.select("market_id", "county"), "market_id")
        .groupBy("county")
        .agg(F.sum("rows").alias("Observations"))
        .orderBy(F.desc("Observations"))
    )


def monthly_commodity_usd(fact: DataFrame, dim_commodity: DataFrame) -> DataFrame:
    return (
        fact.groupBy(month_start(F.col("date_id")).alias("price_month"), "commodity_id")
        .agg(*_parts("usd_price"))
        .join(dim_commodity.select("commodity_id", "commodity"), "commodity_id")
        .groupBy("price_month", "commodity")
        .agg(_avg_of_parts("usd_price", 4).alias("avg_usd_price"))
        .orderBy(F.asc_nulls_last("price_month"), F.asc_nulls_last("commodity"))
    )


def monthly_top_commodities(staging: DataFrame, k: int = 5) -> DataFrame:
    """Ranks below ``k`` in every month, by averages that are not rounded; equals share a rank."""
    month = month_start(F.col("date")).alias("price_month")
    averages = staging.groupBy(month, "commodity").agg(exact_mean(F.col("usd_price")).alias("mean"))
    place = F.rank().over(Window.partitionBy("price_month").orderBy(F.desc_nulls_first("mean")))
    return (
        averages.withColumn("price_rank", place)
        .where(F.col("price_rank") <= k)
        .select("price_month", "commodity", F.round("mean", 4).alias("avg_usd_price"), "price_rank")
        .orderBy(F.asc_nulls_last("price_month"), "price_rank")
    )


def high_water_mark(staging: DataFrame) -> DataFrame:
    """One row: the last date that is loaded, null when there is none."""
    return staging.agg(F.max("date").alias("last_processed_date"))
