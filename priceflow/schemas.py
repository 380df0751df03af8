"""Table layouts. ``VarcharType`` lengths, decimal precisions and nullability are the declared
constraints: they drive ``operators.constraints``, while reads and writes use ``storage_schema``."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T


def _table(*columns: tuple) -> T.StructType:
    """Columns as (name, type) for nullable ones and (name, type, "required") for the others."""
    return T.StructType([T.StructField(c[0], c[1], len(c) == 2) for c in columns])


_text = T.VarcharType
_int = T.IntegerType()
_coordinate = T.DecimalType(8, 4)
_raw_money = T.DecimalType(8, 2)
_money = T.DecimalType(12, 4)

RAW = _table(
    ("date", T.DateType()),
    ("admin1", _text(50)),
    ("admin2", _text(50)),
    ("market", _text(100)),
    ("market_id", _int),
    ("latitude", _coordinate),
    ("longitude", _coordinate),
    ("category", _text(50)),
    ("commodity", _text(100)),
    ("commodity_id", _int),
    ("unit", _text(50)),
    ("priceflag", _text(50)),
    ("pricetype", _text(50)),
    ("currency", _text(10)),
    ("price", _raw_money),
    ("usdprice", _raw_money),
)

# Renames of the two pipelines: the strict one keeps the source's flag, type and price names.
STRICT_RENAMES = {"admin1": "region", "admin2": "county"}
STANDARD_RENAMES = STRICT_RENAMES | {
    "priceflag": "price_flag",
    "pricetype": "price_type",
    "usdprice": "usd_price",
}

CLEANED = T.StructType(
    [T.StructField(STRICT_RENAMES.get(f.name, f.name), f.dataType, False) for f in RAW.fields]
)

STAGING = _table(
    ("id", T.LongType(), "required"),
    ("date", T.DateType(), "required"),
    ("region", _text(80)),
    ("county", _text(80)),
    ("market", _text(120)),
    ("market_id", _int),
    ("latitude", _coordinate),
    ("longitude", _coordinate),
    ("category", _text(80)),
    ("commodity", _text(120)),
    ("commodity_id", _int),
    ("unit", _text(20)),
    ("price_flag", _text(30)),
    ("price_type", _text(20)),
    ("currency", _text(10)),
    ("price", _money),
    ("usd_price", _money),
    ("year", _int),
    ("month", _int),
    ("price_per_kg", _money),
    ("usd_price_per_kg", _money),
    ("loaded_at", T.TimestampType()),
)

DIM_DATE = _table(
    ("date_id", T.DateType(), "required"),
    ("year", _int, "required"),
    ("month", _int, "required"),
    ("month_name", _text(20), "required"),
    ("quarter", _int, "required"),
    ("day_of_week", _int),
    ("is_weekend", T.BooleanType()),
)

DIM_COMMODITY = _table(
    ("commodity_id", _int, "required"),
    ("commodity", _text(120), "required"),
    ("category", _text(80), "required"),
    ("unit", _text(20), "required"),
)

DIM_MARKET = _table(
    ("market_id", _int, "required"),
    ("market", _text(120), "required"),
    ("region", _text(80), "required"),
    ("county", _text(80), "required"),
    ("latitude", _coordinate),
    ("longitude", _coordinate),
)

FACT = _table(
    ("fact_id", T.LongType(), "required"),
    ("date_id", T.DateType(), "required"),
    ("commodity_id", _int, "required"),
    ("market_id", _int, "required"),
    ("price_type", _text(20)),
    ("price_flag", _text(30)),
    ("currency", _text(10)),
    ("price", _money),
    ("usd_price", _money),
    ("price_per_kg", _money),
    ("usd_price_per_kg", _money),
    ("loaded_at", T.TimestampType()),
)

# Kilograms per unit of sale. None marks a unit that has no weight.
UNIT_KG = {
    "KG": Decimal("1.0"),
    "90 KG": Decimal("90.0"),
    "50 KG": Decimal("50.0"),
    "13 KG": Decimal("13.0"),
    "64 KG": Decimal("64.0"),
    "126 KG": Decimal("126.0"),
    "400 G": Decimal("0.4"),
    "200 G": Decimal("0.2"),
    "L": Decimal("1.0"),
    "500 ML": Decimal("0.5"),
    "200 ML": Decimal("0.2"),
    "Unit": None,
    "Bunch": None,
    "Head": None,
}

# The texts a typed CSV read takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def storage_schema(schema: T.StructType, *extra: T.StructField) -> T.StructType:
    """The same columns with plain strings, all nullable, as Parquet files hold them."""
    plain = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType)
        for f in schema.fields
    ]
    return T.StructType(plain + list(extra))


def text_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.VarcharType)]
