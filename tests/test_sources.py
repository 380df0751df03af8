from __future__ import annotations

import datetime
import gzip
from decimal import Decimal

import pytest
from base_helpers import rows

from priceflow.schemas import RAW
from priceflow.session import hand_off
from priceflow.sources import prices

HEADER = ",".join(RAW.names)
LINE = '{date},,,"Hola ""old"" (Tana, River)",1854,,"",cereals and tubers,Maize (white),67,KG,actual,Retail,KES,35.0,0.38'


@pytest.fixture
def csv(tmp_path):
    def write(*lines, header=HEADER, name="prices.csv"):
        path = tmp_path / name
        path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        return str(path)

    return write


def test_positional_scan_reads_quotes_and_empty_fields(spark, csv):
    path = csv(LINE.format(date="15/01/2015"), LINE.format(date="2015-01-15"), header=",".join("x" * 16))
    first, second = sorted(prices.read_raw(spark, path).collect(), key=lambda r: r.date is None)
    assert first.date == datetime.date(2015, 1, 15) and second.date is None
    assert first.market == 'Hola "old" (Tana, River)'
    assert (first.admin1, first.latitude, first.longitude) == (None, None, None)
    assert (first.market_id, first.price) == (1854, Decimal("35.00"))


def test_named_scan_follows_the_header_and_reads_missing_tokens(spark, csv):
    path = csv("n/a,KES,2015-01-15", "Meru,NULL,nan", header="market,currency,date")
    assert rows(prices.scan_named(spark, path)) == [(None, "KES", "2015-01-15"), ("Meru", None, None)]
    assert rows(prices.scan_named(spark, path, missing=[""]), "market") == [("Meru",), ("n/a",)]
    typed = prices.type_columns(prices.scan_named(spark, path))
    assert rows(typed, "date") == [(None,), (datetime.date(2015, 1, 15),)]


def test_row_seq_follows_the_source_order(spark, csv):
    path = csv(*[f"m{i:05d},2015-01-01" for i in range(3000)], header="market,date")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        scanned = prices.scan_named(spark, path, row_seq=True)
        assert scanned.rdd.getNumPartitions() > 3
        places = [r.market for r in scanned.orderBy("row_seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert places == [f"m{i:05d}" for i in range(3000)]


def test_first_readable_falls_back(spark, csv, tmp_path):
    path = csv("Meru,2015-01-15", header="market,date")
    assert prices.first_readable(spark, [str(tmp_path / "none"), path]).count() == 1
    with pytest.raises(FileNotFoundError, match="none"):
        prices.first_readable(spark, [str(tmp_path / "none")])


def test_csv_sink_keeps_the_text(spark, tmp_path):
    df = spark.createDataFrame([("  Meru ", 'a "b", c', None)], "market string, commodity string, unit string")
    prices.write_csv(df, str(tmp_path / "out"))
    assert rows(prices.scan_named(spark, str(tmp_path / "out"))) == [("  Meru ", 'a "b", c', None)]


def test_replace_and_append(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    for write, expected in ((prices.replace_table, 3), (prices.replace_table, 3), (prices.append_table, 6)):
        write(df, path)
        assert spark.read.parquet(path).count() == expected


def test_a_source_that_is_broken_is_no_missing_source(spark, csv, tmp_path):
    path = csv("Meru,2015-01-15", header="market,date")
    source = prices.open_first(spark, [str(tmp_path / "none"), path])
    assert source.path == path and len(source.failures) == 1 and "none" in source.failures[0]
    with pytest.raises(ZeroDivisionError):
        prices.open_first(spark, [path, path], scan=lambda *_: 1 / 0)


def test_a_source_that_breaks_off_leads_on(spark, csv, tmp_path):
    good = csv("Meru,2015-01-15", header="market,date")
    packed = gzip.compress(("market,date\n" + "Hola,2015-01-16\n" * 9999 + str(list(range(5000)))).encode())
    damages = {"cut off": packed[: len(packed) // 2], "no gzip": b"not compressed", "changed": packed[:60] + b"x" * 50 + packed[110:]}
    for name, content in damages.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.csv").write_text("market,date\nHola,2015-01-15\n")
        (folder / "b.csv.gz").write_bytes(content)
    stored = []

    def store(rows, name):
        stored.append(name)
        return hand_off(rows, str(tmp_path / name))

    paths = [str(tmp_path / name) for name in damages]
    source = prices.extract_first(spark, [*paths, good], store)
    assert source.path == good and rows(source.rows) == [("Meru", "2015-01-15")]
    assert len(set(stored)) == len(stored) and len(source.failures) == 3
    assert all(path in failure and "b.csv.gz" in failure for path, failure in zip(paths, source.failures))
    with pytest.raises(FileNotFoundError, match="no gzip"):
        prices.extract_first(spark, paths, store)


def test_another_header_is_raised_not_passed_over(spark, csv, tmp_path):
    good = csv("Meru,2015-01-15", header="market,date")
    folder = tmp_path / "many"
    folder.mkdir()
    for name, header in (("a", "market,date"), ("b", "date,market")):
        (folder / f"{name}.csv").write_text(f"{header}\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        prices.extract_first(spark, [str(folder), good], lambda rows, name: hand_off(rows, str(tmp_path / name)))


def test_line_breaks_inside_quotes(spark, csv, tmp_path):
    path = csv('"Ho\nla",2015-01-15', "Meru,2015-01-16", header="market,date")
    assert rows(prices.scan_named(spark, path, multi_line=True), "market") == [("Ho\nla",), ("Meru",)]
    assert prices.ragged_rows(spark, path, multi_line=True).first().ragged == 0
    assert prices.ragged_rows(spark, path).first().ragged > 0
    out = str(tmp_path / "out")
    prices.write_csv(prices.scan_named(spark, path, multi_line=True), out)
    assert rows(prices.scan_named(spark, out, multi_line=True), "market") == [("Ho\nla",), ("Meru",)]


def test_files_of_different_headers_are_refused(spark, csv, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for name, header in (("a", "market,usdprice,price"), ("b", "market,price,usdprice")):
        (folder / f"{name}.csv").write_text(f"{header}\nMeru,1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        prices.scan_named(spark, str(folder)).collect()


def test_ragged_rows_are_counted(spark, csv):
    path = csv("Meru,2015-01-15", "Meru", "Meru,2015-01-15,more", header="market,date")
    assert prices.ragged_rows(spark, path).first().ragged == 2


def test_unread_texts_cost_no_second_conversion(spark, tmp_path):
    path = tmp_path / "three-columns.csv"
    path.write_text("date,market,price\n2020-01-01,Wakulima,12\n")
    typed = prices.type_columns(prices.scan_named(spark, str(path)), price=prices.WIDE, date_formats=None, unread="unread")
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") == 1
    assert typed.columns[-1] == "unread" and rows(typed, "price", "unread") == [(Decimal("12.0000000000"), None)]


def test_compressed_csv_holds_the_same_rows_in_small_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prices, "COMPRESSED_ROWS", 10)
    df = spark.range(25).selectExpr("concat(' ', id, ',\"') AS market").coalesce(1)
    prices.write_csv(df, str(tmp_path / "out"), compression="gzip")
    assert len(list((tmp_path / "out").glob("*.csv.gz"))) == 3
    assert rows(prices.scan_named(spark, str(tmp_path / "out"))) == rows(df)


def test_unread_texts_are_kept_and_counted(spark, csv):
    path = csv("12,x,1e3", "250000000,3,", "1854.5,4,1", header="price,usdprice,market_id")
    typed = prices.type_columns(prices.scan_named(spark, path), price=prices.WIDE, date_formats=None, unread="unread")
    assert rows(typed, "price", "unread")[0] == (Decimal("12.0000000000"), {"usdprice": "x"})
    assert rows(prices.unread_counts(typed, "unread")) == [("usdprice", 1)]
    assert typed.where("price = 250000000").count() == 1


def test_dates_with_a_time(spark, csv):
    texts = ["2015-01-15 00:00:00", "2015-01-15T10:30:00.5Z", "15/01/2015 10:30", "2015-01-15 noon"]
    path = csv(*(f"Meru,{t}" for t in texts), header="market,date")
    day = datetime.date(2015, 1, 15)
    assert rows(prices.type_columns(prices.scan_named(spark, path)), "date") == [(None,), (day,), (day,), (day,)]


def test_large_numbers_stand_beside_the_usual_ones(spark, csv):
    texts = ["12.5", "99999999.99999999994", "99999999.99999999995", "-123456789012.25", "x", "1e30", ""]
    path = csv(*(f"{t},1" for t in texts), header="price,usdprice")
    text = prices.scan_named(spark, path)
    typed = prices.type_columns(text, price=prices.LONG, coordinate=prices.LONG, date_formats=None, unread="unread", beside=prices.WIDE)
    counts = typed.agg(*prices.large_numbers(typed).values()).first().asDict()
    assert counts == {"price": 2, "usdprice": 0}
    found = prices.widened(typed, ["price"])
    assert [found.schema[c].dataType.simpleString() for c in ("price", "usdprice")] == ["decimal(28,10)", "decimal(18,10)"]
    wide = prices.type_columns(text, price=prices.WIDE, coordinate=prices.WIDE, date_formats=None, unread="unread")
    assert found.columns == wide.columns and rows(found) == rows(wide)
    assert rows(prices.unread_counts(typed, "unread")) == [("price", 2)]
