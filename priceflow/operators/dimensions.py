"""Dimension rows: distinct dates, first row per key, insert where the key is not there yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from priceflow.session import hand_off
from priceflow.sources.prices import ROW_SEQ

# The order of the cleaned rows, which decides which row of a key comes first.
CLEANED_ORDER = ("date", "market", "commodity", ROW_SEQ)


def date_dimension(cleaned: DataFrame) -> DataFrame:
    """One row per date. Days are numbered from Monday = 0."""
    day = F.weekday("date_id")
    return (
        cleaned.where(F.col("date").isNotNull())
        .select(F.col("date").alias("date_id"))
        .distinct()
        .select(
            "date_id",
            F.year("date_id").alias("year"),
            F.month("date_id").alias("month"),
            F.date_format("date_id", "MMMM").alias("month_name"),
            F.quarter("date_id").alias("quarter"),
            day.alias("day_of_week"),
            (day >= 5).alias("is_weekend"),
        )
    )


def commodity_dimension(cleaned: DataFrame, work_dir: str, order: Sequence[str] = CLEANED_ORDER) -> DataFrame:
    attributes = ["commodity", "category", "unit"]
    return first_per_key(cleaned, "commodity_id", attributes, order, f"{work_dir}/commodity_first")


def market_dimension(cleaned: DataFrame, work_dir: str, order: Sequence[str] = CLEANED_ORDER) -> DataFrame:
    attributes = ["market", "region", "county", "latitude", "longitude"]
    return first_per_key(cleaned, "market_id", attributes, order, f"{work_dir}/market_first")


def first_per_key(
    df: DataFrame, key: str, attributes: Sequence[str], order: Sequence[str], work_dir: str
) -> DataFrame:
    """``key`` and ``attributes`` of the first row of each key in ``order``, nulls last.

    A key nearly always has one version of its attributes, or one that is alone on the key's first
    value of ``order[0]``. A hash aggregate over narrow rows finds those without looking at the rest
    of the order. Only the keys it leaves open go through the full comparison, and only with the rows
    that can still be first. A key with very many rows is folded in each map task either way.
    """
    lead = order[0]
    versions = hand_off(
        df.where(F.col(key).isNotNull()).groupBy(key, *attributes).agg(F.min(lead).alias("_lead")),
        f"{work_dir}/versions",
    )
    by_lead = Window.partitionBy(key).orderBy(F.col("_lead").asc_nulls_last())
    leading = (
        versions.withColumn("_place", F.rank().over(by_lead))
        .where("_place = 1")
        .withColumn("_rivals", F.count("*").over(Window.partitionBy(key)))
    )
    settled = leading.where("_rivals = 1").select(key, *attributes)
    contested = leading.where("_rivals > 1").select(
        F.col(key).alias("_key"), F.col("_lead").alias("_first_lead")
    )
    if contested.isEmpty():
        return settled

    contested = hand_off(contested.distinct(), f"{work_dir}/contested")
    contenders = df.join(
        contested, (F.col(key) == F.col("_key")) & F.col(lead).eqNullSafe(F.col("_first_lead"))
    )
    first = F.min_by(F.struct(*attributes), F.struct(*[_nulls_last(c) for c in order[1:]])).alias("_first")
    resolved = contenders.groupBy(key).agg(first).select(key, *[f"_first.{c}" for c in attributes])
    return settled.unionByName(resolved)


def _nulls_last(column: str) -> Column:
    """Structs compare nulls first, so whether the value is null is compared before the value."""
    return F.struct(F.col(column).isNull().alias("absent"), F.col(column).alias("value")).alias(f"by_{column}")


def insert_if_absent(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """The candidates to append: a key that is there already keeps its row."""
    return candidates.join(existing.select(key), key, "left_anti").select(*candidates.columns)


def merge_if_absent(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    return existing.unionByName(insert_if_absent(existing, candidates, key))
