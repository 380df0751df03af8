"""The enriching cleaning: every row with prices stays, gaps are filled and names made uniform."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F, types as T

from priceflow.functions.dates import parse_date
from priceflow.functions.text import strip, title_case
from priceflow.operators.geofill import COORDINATES, geo_fill
from priceflow.schemas import STANDARD_RENAMES, UNIT_KG

TITLE_COLUMNS = ("region", "county", "market", "category", "commodity")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename the source's columns; names that are not there are passed over."""
    return df.withColumnsRenamed(STANDARD_RENAMES)


def parse_dates(df: DataFrame, formats: tuple[str, ...] = ("iso", "dmy")) -> DataFrame:
    """Text to date, plus year and month. A bad date becomes null and the row stays."""
    date = F.col("date")
    if isinstance(df.schema["date"].dataType, T.StringType):
        date = parse_date(date, formats)
    return df.withColumn("date", date.cast("date")).withColumns(
        {"year": F.year("date"), "month": F.month("date")}
    )


def fill_places(df: DataFrame) -> DataFrame:
    present = [c for c in ("region", "county") if c in df.columns]
    return df.fillna("Unknown", subset=present)


def drop_unpriced(df: DataFrame) -> DataFrame:
    return df.where("price IS NOT NULL AND usd_price IS NOT NULL")


def handle_missing(df: DataFrame, work_dir: str) -> DataFrame:
    """Unknown places, coordinates by market, and only then the rows without a price go: their
    coordinates count for the fill."""
    present = tuple(c for c in COORDINATES if c in df.columns)
    filled = geo_fill(df, work_dir, coordinates=present) if present else df
    return drop_unpriced(fill_places(filled))


def standardize_names(df: DataFrame) -> DataFrame:
    """Trim and title-case the names, upper-case the currency. Null stays null."""
    stripped = df.withColumns({c: strip(F.col(c)) for c in (*TITLE_COLUMNS, "currency") if c in df.columns})
    # Title case looks at a name several times, so the stripped names are columns of their own first.
    names = {c: title_case(F.col(c)) for c in TITLE_COLUMNS if c in df.columns}
    if "currency" in df.columns:
        names["currency"] = F.upper("currency")
    return stripped.withColumns(names)


def unit_kg(unit: Column) -> Column:
    """Kilograms per unit; null for a unit that is unknown or has no weight. Exact spelling only."""
    weights = {u: kg for u, kg in UNIT_KG.items() if kg is not None and kg > 0}
    pairs = chain.from_iterable((F.lit(u), F.lit(kg).cast("decimal(4,1)")) for u, kg in weights.items())
    return F.try_element_at(F.create_map(*pairs), unit)


def price_per_kg(df: DataFrame) -> DataFrame:
    """Both prices per kilogram, to 4 places. The 14 units are a constant in the expression."""
    kg = unit_kg(F.col("unit"))
    return df.withColumns(
        {
            "price_per_kg": F.round(F.col("price") / kg, 4),
            "usd_price_per_kg": F.round(F.col("usd_price") / kg, 4),
        }
    )


def clean(df: DataFrame, work_dir: str, date_formats: tuple[str, ...] = ("iso", "dmy")) -> DataFrame:
    """The whole chain. The result is not sorted: readers that need an order name it."""
    return price_per_kg(clean_without_derived(df, work_dir, date_formats))


def clean_without_derived(df: DataFrame, work_dir: str, date_formats: tuple[str, ...] = ("iso", "dmy")) -> DataFrame:
    """The chain up to ``price_per_kg``, which follows from single rows: who shuffles them adds it afterwards."""
    return (
        df.transform(standardize_columns)
        .transform(parse_dates, date_formats)
        .transform(handle_missing, work_dir)
        .transform(standardize_names)
    )
