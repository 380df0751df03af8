from __future__ import annotations

import random
from decimal import Decimal

import pandas as pd
import pytest
from base_helpers import rows
from pyspark.sql import functions as F

from priceflow.operators import enrich, strict
from priceflow.operators.geofill import geo_fill
from priceflow.schemas import RAW, STAGING

TEXT_ROW = {
    "date": "2015-01-15", "admin1": "Coast", "admin2": "Tana", "market": " Hola ", "market_id": "1854",
    "latitude": "-1.5", "longitude": "40.02", "category": "cereals", "commodity": "Maize", "commodity_id": "67",
    "unit": "KG", "priceflag": "actual", "pricetype": "Retail", "currency": "KES", "price": "35.0",
    "usdprice": "0.38",
}


def text_rows(spark, *changes):
    schema = ", ".join(f"{c} string" for c in RAW.names)
    return spark.createDataFrame([tuple((TEXT_ROW | c)[n] for n in RAW.names) for c in changes], schema)


def test_typed_cleaning_trims_and_drops(spark):
    text = text_rows(
        spark, {}, {"market": "Hola", "price": "35.00"}, {"unit": " nan"}, {"price": "x"}, {"date": "soon"}, {"admin1": None}
    )
    cleaned = strict.clean_strict_typed(text)
    assert cleaned.columns[1:3] == ["region", "county"]
    assert rows(cleaned, "market", "price") == [("Hola", 35.0)]


def test_strict_cleaning_compares_typed_values(spark):
    from priceflow.sources.prices import type_columns

    raw = type_columns(text_rows(spark, {}, {"price": "35.004"}, {"price": "35.006"}, {"longitude": None}))
    assert rows(strict.clean_strict(raw), "market", "price") == [(" Hola ", Decimal("35.00")), (" Hola ", Decimal("35.01"))]


def test_null_profile(spark):
    raw = text_rows(spark, {}, {"admin1": None, "price": None}, {"price": None})
    found = {r.column_name: r.nulls for r in strict.null_profile(raw).collect()}
    assert found == {c: 0 for c in RAW.names} | {"admin1": 1, "price": 2, "total": 3}
    assert strict.rows_with_nulls(raw).count() == 2


SEQ = "row_seq struct<file: string, block: bigint, row: bigint>"


def test_geo_fill_cases(spark, work):
    values = [
        *[("moving", v) for v in (None, 5, None, 7, None)],
        *[("empty", None)] * 2,
        *[(None, 3), (None, None)],
        *[("still", v) for v in (None, 4, None)],
    ]
    data = [(m, None if v is None else Decimal(v), ("f", 0, i)) for i, (m, v) in enumerate(values)]
    df = spark.createDataFrame(data, f"market string, latitude decimal(8,4), {SEQ}")
    filled = geo_fill(df, work, coordinates=("latitude",)).orderBy("row_seq.row").collect()
    assert [int(r.latitude) for r in filled] == [5, 5, 5, 7, 7, 0, 0, 0, 0, 4, 4, 4]


@pytest.mark.parametrize("seed, pieces", [(0, {}), (1, {}), (2, {"piece_rows": 7}), (3, {"piece_rows": 1}), (4, {"by_range": True})])
def test_geo_fill_is_that_of_pandas(spark, work, seed, pieces):
    """Several files and blocks, and one market that holds a third of the rows; blocks in one piece, many, or cut by range."""
    by_range = pieces.pop("by_range", False)
    draw = random.Random(seed)
    data = []
    for file in ("a", "b"):
        for block in (0, 100, 1000):
            for row in range(draw.randrange(1, 60)):
                market = "hot" if draw.random() < 0.33 else draw.choice(["x", "y", "still", None])
                known = draw.random() < 0.3
                lat = (1.0 if market == "still" else float(draw.randrange(1, 9))) if known else None
                lon = float(draw.randrange(1, 9)) if draw.random() < 0.2 else None
                data.append((market, lat, lon, (file, block, row)))
    expected = pd.DataFrame([(*d[:3], str(d[3])) for d in data], columns=["market", "latitude", "longitude", "at"])
    for c in ("latitude", "longitude"):
        expected[c] = expected.groupby("market")[c].transform(lambda s: s.ffill().bfill()).fillna(0)
    shuffled = data[:]
    draw.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, f"market string, latitude double, longitude double, {SEQ}").repartition(5)
    if by_range:
        df = df.withColumn("row_seq", F.col("row_seq").withField("row", F.struct("row_seq.row")))
    filled = geo_fill(df, work, **pieces).withColumn("row_seq", F.col("row_seq").withField("row", F.expr("row_seq.row" + ".row" * by_range)))
    filled = {str(tuple(r.row_seq)): (r.latitude, r.longitude) for r in filled.collect()}
    assert filled == {r.at: (r.latitude, r.longitude) for r in expected.itertuples()}


def test_one_market_in_one_block_is_cut_into_pieces(spark, work):
    """No window of the fill holds more than a piece, however the rows are numbered."""
    n = 40_000
    place = F.struct(F.lit("f").alias("file"), F.lit(0).alias("block"), F.col("id").alias("row"))
    df = spark.range(n).select(F.lit("hot").alias("market"), F.when(F.col("id") % 5 == 2, F.col("id").cast("double")).alias("latitude"), place.alias("row_seq"))
    wrong = F.col("latitude") != F.greatest(F.lit(2), (F.col("row_seq.row") - 2) - (F.col("row_seq.row") - 2) % 5 + 2)
    assert geo_fill(df, work, coordinates=("latitude",), piece_rows=1000).where(wrong).count() == 0
    by_range = df.withColumn("row_seq", F.col("row_seq").withField("row", F.struct("row_seq.row")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        filled = geo_fill(by_range, work, coordinates=("latitude",)).withColumn("row_seq", F.col("row_seq").withField("row", F.col("row_seq.row.row")))
        assert filled.where(wrong).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in spark.read.parquet(f"{work}/pieces").groupBy("_piece").count().collect()]
    assert len(sizes) > 3 and max(sizes) < n / 3


def test_price_per_kg(spark):
    units = ["KG", "90 KG", "400 G", "kg", "Bunch", "Crate", None]
    df = spark.createDataFrame([(u, Decimal("35.00"), Decimal("1.00")) for u in units], "unit string, price decimal(12,4), usd_price decimal(12,4)")
    found = {r.unit: (r.price_per_kg, r.usd_price_per_kg) for r in enrich.price_per_kg(df).collect()}
    nothing = (None, None)
    assert found == {
        "KG": (Decimal("35"), Decimal("1")), "90 KG": (Decimal("0.3889"), Decimal("0.0111")),
        "400 G": (Decimal("87.5"), Decimal("2.5")), "kg": nothing, "Bunch": nothing, "Crate": nothing, None: nothing,
    }


def test_names_and_columns(spark):
    df = spark.createDataFrame([("\tmurang'a ", None, " kes", "x")], "admin1 string, market string, currency string, other string")
    uniform = enrich.standardize_names(enrich.standardize_columns(df))
    assert uniform.columns == ["region", "market", "currency", "other"]
    assert rows(uniform) == [("Murang'A", None, "KES", "x")]


def test_clean_keeps_bad_dates_and_drops_missing_prices(spark, work):
    from priceflow.sources.prices import type_columns

    changes = [{}, {"date": "soon", "admin1": None}, {"price": None}, {"usdprice": None}]
    typed = type_columns(text_rows(spark, *changes), price=(12, 4), date_formats=None)
    typed = typed.withColumn("row_seq", F.struct(F.lit("f").alias("file"), F.lit(0).alias("block"), F.monotonically_increasing_id().alias("row")))
    cleaned = enrich.clean(typed, work)
    assert set(STAGING.names) - set(cleaned.columns) == {"id", "loaded_at"}
    assert rows(cleaned, "date", "year", "region") == [(None, None, "Unknown"), (__import__("datetime").date(2015, 1, 15), 2015, "Coast")]
