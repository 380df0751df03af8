from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pandas as pd
import pytest
from base_helpers import rows

from priceflow.operators import constraints, dimensions
from priceflow.plans import load
from priceflow.schemas import DIM_COMMODITY, RAW
from priceflow.sources.warehouse import Warehouse

CLEANED = (
    "date date, region string, county string, market string, market_id int, latitude decimal(8,4), "
    "longitude decimal(8,4), category string, commodity string, commodity_id int, unit string, price_flag string, "
    "price_type string, currency string, price decimal(12,4), usd_price decimal(12,4), year int, month int, "
    "price_per_kg decimal(14,4), usd_price_per_kg decimal(14,4), "
    "row_seq struct<file: string, block: bigint, row: bigint>"
)


def cleaned_rows(spark, *changes):
    base = {
        "date": datetime.date(2020, 1, 4), "region": "Coast", "county": "Tana", "market": "Hola", "market_id": 1,
        "latitude": Decimal(1), "longitude": Decimal(2), "category": "Cereals", "commodity": "Maize",
        "commodity_id": 67, "unit": "KG", "price_flag": "actual", "price_type": "Retail", "currency": "KES",
        "price": Decimal(35), "usd_price": Decimal("0.38"), "price_per_kg": Decimal(35),
        "usd_price_per_kg": Decimal("0.38"),
    }
    data = []
    for i, change in enumerate(changes):
        row = base | change
        day = row["date"]
        row |= {"year": day.year if day else None, "month": day.month if day else None, "row_seq": ("f", 0, i)}
        data.append(tuple(row[c.split()[0]] for c in CLEANED.split(", ")[:20]) + (row["row_seq"],))
    return spark.createDataFrame(data, CLEANED)


def test_date_dimension_counts_days_from_monday(spark):
    days = [datetime.date(2020, 1, d) for d in (3, 4, 5, 6)]
    dates = dimensions.date_dimension(cleaned_rows(spark, *[{"date": d} for d in [*days, days[0], None]]))
    assert rows(dates, "date_id", "month_name", "quarter", "day_of_week", "is_weekend") == [
        (days[0], "January", 1, 4, False), (days[1], "January", 1, 5, True),
        (days[2], "January", 1, 6, True), (days[3], "January", 1, 0, False),
    ]


def test_first_row_wins(spark, work):
    later, sooner = datetime.date(2020, 2, 1), datetime.date(2020, 1, 1)
    cleaned = cleaned_rows(
        spark,
        {"commodity": "Later", "date": later},
        {"commodity": "Undated", "date": None},
        {"commodity": "B", "date": sooner, "market": "Z"},
        {"commodity": "C", "date": sooner, "market": "A", "unit": "first"},
        {"commodity": "C", "date": sooner, "market": "A", "unit": "second"},
        {"commodity_id": 2, "commodity": "Only", "date": None},
    )
    first = dimensions.commodity_dimension(cleaned, work)
    assert rows(first, "commodity_id", "commodity", "unit") == [(2, "Only", "KG"), (67, "C", "first")]


@pytest.mark.parametrize("seed", range(3))
def test_first_row_is_that_of_a_sorted_frame(spark, work, seed):
    draw = random.Random(seed)
    days = [None, *[datetime.date(2020, 1, d) for d in range(1, 4)]]
    changes = [
        {
            "commodity_id": 1 if draw.random() < 0.33 else draw.randrange(2, 30), "date": draw.choice(days),
            "market": draw.choice("AB"), "commodity": draw.choice("XYZ"), "unit": draw.choice("uvw"),
        }
        for _ in range(300)
    ]
    frame = pd.DataFrame(changes).sort_values(["date", "market", "commodity"], kind="stable")
    frame = frame.drop_duplicates(subset=["commodity_id"])
    expected = sorted(zip(frame.commodity_id, frame.commodity, frame.unit))
    found = dimensions.commodity_dimension(cleaned_rows(spark, *changes).repartition(3), work)
    assert sorted(tuple(r) for r in found.select("commodity_id", "commodity", "unit").collect()) == expected


def one_load(spark, warehouse, work, load_id, *changes, **options):
    return load.load_star(cleaned_rows(spark, *changes), warehouse, f"{work}/{load_id}", load_id, **options)


def test_loads_append_and_existing_keys_stay(spark, tmp_path, work):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    assert warehouse.high_water_mark() is None and warehouse.read("fact_prices").count() == 0
    counts = one_load(spark, warehouse, work, "a", {}, {"market_id": 2})
    assert counts == {"staging": 2, "dim_date": 1, "dim_commodity": 1, "dim_market": 2, "fact_prices": 2, "rejected": 0}
    day = datetime.date(2021, 5, 1)
    one_load(spark, warehouse, work, "b", {"commodity": "Renamed", "date": day}, {"commodity_id": 68})
    assert rows(warehouse.read("dim_commodity"), "commodity_id", "commodity") == [(67, "Maize"), (68, "Maize")]
    assert warehouse.read("dim_date").count() == 2
    assert warehouse.high_water_mark() == day
    ids = [r.fact_id for r in warehouse.read("fact_prices").collect()]
    assert len(ids) == len(set(ids)) == 4 and min(ids) >= 1


def test_a_published_load_is_not_loaded_again(spark, tmp_path, work):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    first = one_load(spark, warehouse, work, "a", {})
    assert one_load(spark, warehouse, work, "a", {}, {}) == first
    assert warehouse.read("fact_prices").count() == 1


def test_an_interrupted_load_is_invisible_and_can_be_repeated(spark, tmp_path, work, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    one_load(spark, warehouse, work, "a", {})
    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            one_load(spark, warehouse, work, "b", {"commodity_id": 68}, {})
    assert warehouse.read("fact_prices").count() == 1 and warehouse.read("dim_commodity").count() == 1
    one_load(spark, warehouse, work, "b", {"commodity_id": 68}, {})
    assert warehouse.read("fact_prices").count() == 3 and warehouse.read("dim_commodity").count() == 2


def test_full_reload_replaces_facts_and_keeps_dimensions(spark, tmp_path, work):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    one_load(spark, warehouse, work, "a", {}, {"commodity_id": 68})
    one_load(spark, warehouse, work, "b", {"commodity": "Renamed"}, full_reload=True)
    assert warehouse.read("fact_prices").count() == 1 and warehouse.read("stg_cleaned_prices").count() == 1
    assert rows(warehouse.read("dim_commodity"), "commodity_id", "commodity") == [(67, "Maize"), (68, "Maize")]
    assert (tmp_path / "w" / "fact_prices" / "load_id=a").exists()


def test_readers_outlive_a_full_reload_until_the_vacuum(spark, tmp_path, work, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    one_load(spark, warehouse, work, "a", {}, {"commodity_id": 68})
    opened = warehouse.read("fact_prices")
    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            one_load(spark, warehouse, work, "crashed", {})
    one_load(spark, warehouse, work, "b", {}, full_reload=True)
    assert opened.count() == 2
    assert warehouse.vacuum() == []
    removed = warehouse.vacuum(datetime.timedelta(0))
    assert {"fact_prices/load_id=a", "stg_cleaned_prices/load_id=a", "fact_prices/load_id=crashed"} <= set(removed)
    assert not any(name.endswith("=b") or name in ("dim_market/load_id=a", "dim_date/load_id=a") for name in removed)
    assert warehouse.read("fact_prices").count() == 1 and warehouse.read("dim_commodity").count() == 2


def test_attributes_come_from_the_first_row_of_a_key(spark, tmp_path, work):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    later = {"date": datetime.date(2020, 2, 1), "unit": None, "category": None, "county": None}
    counts = one_load(spark, warehouse, work, "a", {}, later)
    assert (counts["fact_prices"], counts["rejected"]) == (2, 0)
    assert rows(warehouse.read("dim_commodity"), "commodity_id", "category", "unit") == [(67, "Cereals", "KG")]
    lacking = ({"commodity_id": 70, "unit": None}, {"commodity_id": 70}, {"commodity_id": 71})
    with pytest.raises(load.ConstraintViolation, match="dim_commodity"):
        one_load(spark, warehouse, work, "b", {"commodity_id": 70, "unit": None, "date": datetime.date(2019, 1, 1)}, {"commodity_id": 71})
    first = {"commodity_id": 70, "unit": None, "date": datetime.date(2019, 1, 1)}
    counts = one_load(spark, warehouse, work, "c", first, *lacking[1:], on_violation="reject")
    assert (counts["fact_prices"], counts["rejected"], counts["dim_commodity"]) == (1, 2, 1)
    assert rows(warehouse.read_rejected(), "commodity_id", "broken") == [(70, ["dim_commodity.attributes"])] * 2


def test_declared_widths_and_lengths(spark, tmp_path, work):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    wide = cleaned_rows(spark, {}, {"unit": "u" * 200}, {"currency": "c" * 17}, {"commodity_id": 68})
    columns = ("price", "usd_price", "price_per_kg", "usd_price_per_kg", "latitude", "longitude")
    wide = wide.withColumns({c: wide[c].cast("decimal(28,10)") for c in columns})
    wide = wide.withColumn("price", wide.price + (wide.commodity_id - 67).cast("decimal(1,0)") * 250_000_000)
    with pytest.raises(load.ConstraintViolation, match=r"currency.max_length \(1 rows\), price.fits_type \(1 rows\), unit.max_length"):
        load.load_star(wide, warehouse, f"{work}/a", "a")
    counts = load.load_star(wide, warehouse, f"{work}/b", "b", on_violation="reject")
    assert (counts["staging"], counts["rejected"]) == (1, 3)
    assert {tuple(r.broken) for r in warehouse.read_rejected().collect()} == {
        ("unit.max_length",), ("currency.max_length",), ("price.fits_type",)
    }


def test_rows_without_required_values(spark, tmp_path, work):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(load.ConstraintViolation, match="1 rows"):
        one_load(spark, warehouse, work, "a", {}, {"date": None})
    counts = one_load(spark, warehouse, work, "b", {}, {"date": None}, on_violation="reject")
    assert (counts["staging"], counts["fact_prices"], counts["rejected"]) == (1, 1, 1)


def test_referential_and_declared_tests(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (3,), (3,)], "k int")
    assert rows(constraints.referential(fact, {"k": dim})) == [("k", 1)]
    tables = {"fact": fact, "dim": dim}
    assert rows(constraints.not_null(tables, [("fact", "k"), ("dim", "k")])) == [("dim", "k", 0), ("fact", "k", 1)]
    assert rows(constraints.unique(tables, [("fact", "k"), ("dim", "k")])) == [("dim", "k", 1), ("fact", "k", 1)]


def test_column_constraints(spark):
    df = spark.createDataFrame(
        [("67", "x" * 121, None, "KG"), ("2147483648", "é" * 120, "c", "KG"), ("x", "m", "c", "KG")],
        "commodity_id string, commodity string, category string, unit string",
    )
    found = {(r.column_name, r.rule): r.violations for r in constraints.column_constraints(df, DIM_COMMODITY).collect()}
    assert found == {
        ("commodity_id", "not_null"): 0, ("commodity_id", "fits_type"): 2, ("commodity", "not_null"): 0,
        ("commodity", "max_length"): 1, ("category", "not_null"): 1, ("category", "max_length"): 0,
        ("unit", "not_null"): 0, ("unit", "max_length"): 0,
    }
    prices = spark.createDataFrame([("999999.99",), ("1000000",), (None,)], "price string")
    assert rows(constraints.column_constraints(prices, RAW)) == [("price", "fits_type", 1)]


def test_a_row_with_a_null_text_is_no_rejected_row(spark, work, tmp_path):
    """The length of a null is null: beside a rejected row it neither breaks a rule nor gets lost."""
    warehouse = Warehouse(spark, str(tmp_path / "nulls"))
    counts = one_load(spark, warehouse, work, "a", {"price_flag": None}, {"date": None, "price_flag": None}, on_violation="reject")
    assert (counts["staging"], counts["fact_prices"], counts["rejected"]) == (1, 1, 1)
    assert rows(warehouse.read_rejected(), "broken") == [(["date.not_null"],)]
