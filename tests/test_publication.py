"""Several writers, compaction, and tables that are replaced together."""

from __future__ import annotations

import datetime

import pytest
from base_helpers import rows
from test_star import cleaned_rows, one_load

from priceflow.plans import load, pipeline
from priceflow.schemas import RAW
from priceflow.session import put_if_absent
from priceflow.sources.versions import VersionedTables
from priceflow.sources.warehouse import TABLES, Warehouse

FACTS = ("commodity_id", "market_id", "date_id")


def test_a_name_is_given_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    assert put_if_absent(spark, path, "first") and not put_if_absent(spark, path, "second")
    assert open(path).read() == "first"
    assert [f.name for f in (tmp_path / "log").iterdir() if not f.name.endswith(".crc")] == ["1.json"]


def interleave(monkeypatch, other):
    """``other`` runs between the writing and the publishing of the next load."""
    publish, waiting = Warehouse.publish, [other]

    def late(warehouse, row):
        if waiting:
            waiting.pop()()
        return publish(warehouse, row)

    monkeypatch.setattr(Warehouse, "publish", late)


def test_the_loser_of_two_writers_tries_again(spark, tmp_path, work, monkeypatch):
    mine, theirs = (Warehouse(spark, str(tmp_path / "w")) for _ in range(2))
    assert mine.loads() == theirs.loads() == []
    interleave(monkeypatch, lambda: one_load(spark, theirs, work, "theirs", {"commodity": "Theirs"}, {"commodity": "Theirs", "market_id": 2}))
    counts = one_load(spark, mine, work, "mine", {"commodity": "Mine"}, {"market_id": 3}, {"commodity_id": 68})
    assert [r.load_id for r in mine.loads()] == ["theirs", "mine"] and counts["fact_prices"] == 3
    for table, key, n in (("fact_prices", "fact_id", 5), ("stg_cleaned_prices", "id", 5), ("dim_date", "date_id", 1),
                          ("dim_commodity", "commodity_id", 2), ("dim_market", "market_id", 3)):
        keys = [r[0] for r in mine.read(table).select(key).collect()]
        assert len(keys) == len(set(keys)) == n, table
    assert rows(mine.read("dim_commodity").where("commodity_id = 67"), "commodity") == [("Theirs",)]


def test_a_late_incremental_load_drops_what_the_other_has(spark, tmp_path, work, monkeypatch):
    mine, theirs = (Warehouse(spark, str(tmp_path / "w")) for _ in range(2))
    mine.loads()
    interleave(monkeypatch, lambda: one_load(spark, theirs, work, "theirs", {}))
    later = datetime.date(2020, 1, 5)
    counts = one_load(spark, mine, work, "mine", {}, {"date": later}, incremental=True)
    assert counts["fact_prices"] == 1 and mine.high_water_mark() == later
    assert mine.read("fact_prices").count() == 2


def test_a_load_published_by_another_run_is_left_alone(spark, tmp_path, work):
    mine, theirs = (Warehouse(spark, str(tmp_path / "w")) for _ in range(2))
    mine.loads()
    first = one_load(spark, theirs, work, "b", {})
    mine.refresh()
    assert one_load(spark, mine, work, "b", {}, {}) == first


def test_compaction_keeps_rows_readers_and_marks(spark, tmp_path, work):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    assert load.compact(warehouse) == 0
    for i in range(4):
        one_load(spark, warehouse, work, f"l{i}", {"commodity_id": i, "date": datetime.date(2019 + i % 2, 1, 1 + i)}, {})
    assert load.compact(warehouse, "c1") == 4
    before = {table: rows(Warehouse(spark, warehouse.root).read(table)) for table in TABLES}
    opened = warehouse.read("fact_prices")
    one_load(spark, warehouse, work, "l4", {"commodity_id": 9})
    assert warehouse.live_loads("fact_prices") == ["c1", "l4"] and opened.count() == len(before["fact_prices"]) == 8
    mark = warehouse.high_water_mark()
    assert load.compact(warehouse, "c2") == 2
    assert all(warehouse.live_loads(table) == ["c2"] for table in TABLES) and warehouse.high_water_mark() == mark
    assert set(before["fact_prices"]) < set(rows(warehouse.read("fact_prices")))
    ids = [r.fact_id for r in warehouse.read("fact_prices").collect()]
    assert len(set(ids)) == len(ids) == 9 and opened.count() == 8
    held = {table: rows(warehouse.read(table)) for table in TABLES}
    assert warehouse.vacuum() == []
    removed = warehouse.vacuum(datetime.timedelta(0))
    assert "fact_prices/load_id=l0" in removed and "dim_market/load_id=c1" in removed
    assert not any(name.endswith("=c2") for name in removed)
    assert {table: rows(Warehouse(spark, warehouse.root).read(table)) for table in TABLES} == held
    one_load(spark, warehouse, work, "l5", {}, full_reload=True)
    assert warehouse.live_loads("fact_prices") == ["l5"] and warehouse.live_loads("dim_date") == ["c2", "l5"]
    assert one_load(spark, warehouse, work, "l0", {})["fact_prices"] == 2 and warehouse.read("fact_prices").count() == 1


@pytest.mark.parametrize("full_reload", [False, True])
def test_compaction_beside_a_writer(spark, tmp_path, work, monkeypatch, full_reload):
    mine, theirs = (Warehouse(spark, str(tmp_path / "w")) for _ in range(2))
    for i in range(2):
        one_load(spark, mine, work, f"l{i}", {"commodity_id": i})
    interleave(monkeypatch, lambda: one_load(spark, theirs, work, "theirs", {"commodity_id": 7}, full_reload=full_reload))
    assert load.compact(mine, "c") == (3 if full_reload else 2)
    assert rows(mine.read("fact_prices"), "commodity_id") == ([(7,)] if full_reload else [(0,), (1,), (7,)])
    assert rows(mine.read("dim_commodity"), "commodity_id") == [(0,), (1,), (7,)]


def strict_source(folder, *prices):
    folder.mkdir()
    line = "2020-01-01,Coast,Tana,Hola,7,1,2,cereals,maize,67,KG,actual,Retail,KES,{},0.5"
    (folder / "p.csv").write_text("\n".join([",".join(RAW.names), *(line.format(p) for p in prices)]) + "\n")
    return str(folder)


def test_strict_tables_are_replaced_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    names = ("raw", "cleaned", "avg_price_per_commodity_year", "avg_price_per_category")
    tables = VersionedTables(spark, root)
    with pytest.raises(FileNotFoundError):
        tables.read("raw")
    pipeline.run_strict(spark, [strict_source(tmp_path / "one", 90)], root)
    opened = {name: tables.read(name) for name in names}
    before = {name: rows(df) for name, df in opened.items()}
    second = strict_source(tmp_path / "two", 10, 20)
    with monkeypatch.context() as broken:
        broken.setattr(pipeline.strict_queries, "avg_price_per_category", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            pipeline.run_strict(spark, [second], root)
    assert {name: rows(tables.read(name)) for name in names} == before
    assert pipeline.run_strict(spark, [second], root)["rows_raw"] == 2
    assert tables.read("raw").count() == 2 and {name: rows(df) for name, df in opened.items()} == before
    assert tables.vacuum() == [] and len(tables.vacuum(datetime.timedelta(0))) == 2
    assert tables.read("cleaned").count() == 2


def test_compaction_reads_year_by_year_without_a_shuffle(spark, tmp_path, work):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for i in range(3):
        one_load(spark, warehouse, work, f"l{i}", *({"date": datetime.date(2019 + y, 1, 1 + i)} for y in range(2)))
    for table in ("fact_prices", "stg_cleaned_prices"):
        gathered = load.gathered_by_year(warehouse, table)
        assert "Exchange" not in gathered._jdf.queryExecution().executedPlan().toString()
        assert rows(gathered) == rows(warehouse.read(table)) and gathered.count() == 6
        assert 2 <= gathered.rdd.getNumPartitions() <= 4
    assert load.compact(warehouse, "c") == 3
    for table in ("fact_prices", "stg_cleaned_prices"):
        files = sorted(f.parent.name for f in (tmp_path / "w" / table / "load_id=c").rglob("*.parquet"))
        assert set(files) == {"year=2019", "year=2020"} and len(files) <= 4
