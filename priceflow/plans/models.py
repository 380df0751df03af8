"""The aggregate models over a warehouse, published as views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from priceflow.plans import star_queries
from priceflow.sources.warehouse import Warehouse


def build_models(warehouse: Warehouse) -> dict[str, DataFrame]:
    fact, dates = warehouse.read("fact_prices"), warehouse.read("dim_date")
    commodities, markets = warehouse.read("dim_commodity"), warehouse.read("dim_market")
    return {
        "agg_monthly_avg_price": star_queries.monthly_avg_price(fact, dates, commodities, markets),
        "agg_price_trends": star_queries.price_trends(fact, dates, commodities),
        "agg_commodity_summary": star_queries.commodity_summary(fact, commodities),
    }


def publish_models(warehouse: Warehouse) -> None:
    """Temp views: Catalyst plans them together with the query that reads them."""
    warehouse.register_views()
    for name, model in build_models(warehouse).items():
        model.createOrReplaceTempView(name)


# Columns that the models and their sources declare as tests.
NOT_NULL = (
    ("agg_monthly_avg_price", "price_month"),
    ("agg_monthly_avg_price", "commodity"),
    ("agg_monthly_avg_price", "avg_price_kes"),
    ("agg_price_trends", "year"),
    ("agg_price_trends", "commodity"),
    ("agg_commodity_summary", "commodity"),
    ("fact_prices", "fact_id"),
    ("fact_prices", "date_id"),
    ("fact_prices", "commodity_id"),
    ("fact_prices", "market_id"),
    ("dim_date", "date_id"),
    ("dim_commodity", "commodity_id"),
    ("dim_market", "market_id"),
)
UNIQUE = (
    ("agg_commodity_summary", "commodity"),
    ("fact_prices", "fact_id"),
    ("dim_date", "date_id"),
    ("dim_commodity", "commodity_id"),
    ("dim_market", "market_id"),
)


def tested_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    sources = ("fact_prices", "dim_date", "dim_commodity", "dim_market")
    return build_models(warehouse) | {name: warehouse.read(name) for name in sources}
