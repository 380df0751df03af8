from __future__ import annotations

import datetime
import gzip
import re
from decimal import Decimal

import pytest
from base_helpers import rows
from pyspark.sql import functions as F, types as T

from priceflow.operators.enrich import clean_without_derived, price_per_kg
from priceflow.operators.quality import QualityCheckError
from priceflow.plans import pipeline
from priceflow.plans.load import BROKEN, ConstraintViolation, load_star, mark_broken
from priceflow.plans.models import publish_models
from priceflow.plans.pipeline import incremental_filter, run_pipeline, run_strict
from priceflow.schemas import RAW, storage_schema
from priceflow.session import hand_off
from priceflow.sources.prices import LONG, type_columns
from priceflow.sources.warehouse import Warehouse


@pytest.fixture
def source(tmp_path):
    """Writes a CSV of (date, commodity id, price) and gives its path."""

    def write(name, *observations):
        lines = [",".join(RAW.names)]
        lines += [
            f"{date},Coast,Tana, hola (tana),7,,,cereals,maize (white),{commodity},90 KG,actual,Retail,kes,{price},0.5"
            for date, commodity, price in observations
        ]
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def facts(spark, root):
    return rows(Warehouse(spark, root).read("fact_prices").selectExpr("date_id", "commodity_id", "cast(price AS int) AS price"))


D1, D2, D3 = (datetime.date(2020, 1, d) for d in (1, 2, 3))


def test_batches_keep_what_is_newer_than_the_mark(spark, source, tmp_path):
    root = str(tmp_path / "w")
    first = run_pipeline(spark, [source("one.csv", ("2020-01-01", 1, 90), ("02/01/2020", 1, 180))], root)
    assert first["status"] == "success" and first["rows_extracted"] == first["rows_cleaned"] == 2
    assert first["load"]["staging"] == first["load"]["fact_prices"] == 2
    second = [("2020-01-01", 2, 5), ("2020-01-02", 2, 6), ("soon", 2, 7), ("2020-01-03", 2, 8)]
    path = source("two.csv", *second)
    summary = run_pipeline(spark, [str(tmp_path / "gone.csv"), path], root)
    assert summary["rows_extracted"] == 1 and summary["source"] == path and len(summary["source_failures"]) == 1
    assert summary["unread"] == {}
    assert facts(spark, root) == [(D1, 1, 90), (D2, 1, 180), (D3, 2, 8)]
    assert run_pipeline(spark, [path], root)["status"] == "no_new_data"
    assert not (tmp_path / "w" / "_work").exists() or not list((tmp_path / "w" / "_work").iterdir())

    staged = Warehouse(spark, root).read("stg_cleaned_prices").where("commodity_id = 1").orderBy("date").first()
    assert (staged.market, staged.commodity, staged.currency, staged.latitude) == ("Hola (Tana)", "Maize (White)", "KES", 0)
    assert (float(staged.price_per_kg), staged.year, staged.month) == (1.0, 2020, 1)
    publish_models(Warehouse(spark, root))
    assert spark.table("agg_commodity_summary").count() == 1
    assert spark.sql("SELECT sum(observation_count) AS n FROM agg_monthly_avg_price").first().n == 3


def test_a_damaged_source_leaves_no_rows(spark, source, tmp_path):
    root = str(tmp_path / "w")
    damaged = tmp_path / "damaged"
    damaged.mkdir()
    days = [(f"2020-{m:02d}-{d:02d}", 5, 50 + m * d) for m in range(1, 13) for d in range(1, 29)]
    whole = open(source("a.csv", *days)).read()
    (damaged / "a.csv").write_text(whole)
    (damaged / "b.csv.gz").write_bytes(gzip.compress(whole.encode())[:-200])
    path = source("good.csv", ("2020-01-02", 1, 90))
    summary = run_pipeline(spark, [str(damaged), path], root)
    assert summary["status"] == "success" and summary["source"] == path and summary["rows_extracted"] == 1
    assert len(summary["source_failures"]) == 1 and "b.csv.gz" in summary["source_failures"][0]
    assert facts(spark, root) == [(D2, 1, 90)]
    strict = run_strict(spark, [str(damaged), path], str(tmp_path / "strict"))
    assert strict["rows_raw"] == 1 and len(strict["source_failures"]) == 1


def test_full_reload_and_plain_append(spark, source, tmp_path):
    root, path = str(tmp_path / "w"), source("one.csv", ("2020-01-01", 1, 90))
    for options, expected in (({}, 1), ({"incremental": False}, 2), ({"full_reload": True}, 1), ({"full_reload": True}, 1)):
        assert run_pipeline(spark, [path], root, **options)["status"] == "success"
        assert len(facts(spark, root)) == expected


def test_dry_run_gates_and_constraints(spark, source, tmp_path):
    root = str(tmp_path / "w")
    twice = source("twice.csv", ("2020-01-01", 1, 90), ("2020-01-01", 1, 90))
    dry = run_pipeline(spark, [twice], root, dry_run=True)
    assert dry["status"] == "dry_run_complete" and Warehouse(spark, root).loads() == []
    assert {r["metric"]: r["value"] for r in dry["quality_report"]}["duplicates"] == "2"
    with pytest.raises(QualityCheckError):
        run_pipeline(spark, [twice], root, gate="strict")
    unpriced = source("unpriced.csv", ("2020-01-01", 1, ""))
    assert run_pipeline(spark, [unpriced], root)["status"] == "quality_check_failed"
    with pytest.raises(ConstraintViolation):
        run_pipeline(spark, [source("undated.csv", ("soon", 1, 90))], root)
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, [str(tmp_path / "gone.csv")], root)
    assert Warehouse(spark, root).loads() == []


def test_incremental_filter_prunes_years(spark, tmp_path):
    df = spark.createDataFrame([(D1, 2020), (D2, 2020), (None, None)], "date date, year int")
    df.write.partitionBy("year").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    newer = incremental_filter(stored, D1)
    assert rows(newer, "date") == [(D2,)]
    assert "PartitionFilters: [isnotnull(year" in newer._jdf.queryExecution().toString()
    assert incremental_filter(stored, None).count() == 3


def test_broken_records_are_routed_by_file(spark, source, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, *observations, change=lambda text: text):
        path = source(name, *observations)
        (folder / name).write_text(change(open(path).read()))

    write("a.csv", ("2020-01-01", 1, 90), ("2020-01-02", 1, 91))
    write("b.csv", ("2020-01-01", 2, 90), ("2020-01-03", 2, 92), change=lambda t: t.replace(" hola (tana)", '"hola\n(tana, ""old"")"', 1))
    write("c.csv", ("2020-01-01", 3, 90), ("2020-01-02", 3, 91), ("2020-01-03", 3, 91), change=lambda t: t.replace(",kes,91,", ",91,", 1))
    write("d.csv", ("2020-01-01", 4, 90), ("2020-01-02", 4, 91), ("2020-01-03", 4, 92), change=lambda t: t.replace("cereals", '"cereals', 1))
    root = str(tmp_path / "w")
    summary = run_pipeline(spark, [str(folder)], root)
    names = lambda files: [f.rsplit("/", 1)[1] for f in files]
    assert summary["status"] == "success" and names(summary["multi_line_files"]) == ["b.csv"]
    assert sorted(zip(names(summary["ragged"]), summary["ragged"].values())) == [("c.csv", 1), ("d.csv", 1)]
    assert [(c, str(d)) for d, c, _ in sorted(facts(spark, root), key=lambda r: (r[1], r[0]))] == [
        (1, "2020-01-01"), (1, "2020-01-02"), (2, "2020-01-01"), (2, "2020-01-03"),
        (3, "2020-01-01"), (3, "2020-01-03"), (4, "2020-01-02"), (4, "2020-01-03"),
    ]
    kept = spark.read.parquet(f"{root}/broken_records").select("file", "reason").collect()
    assert sorted((names([r.file])[0], r.reason) for r in kept) == [("c.csv", "wrong number of fields"), ("d.csv", "open quote")]
    later = run_pipeline(spark, [str(folder)], root)
    assert later["status"] == "no_new_data" and len(later["ragged"]) == 2


def test_usual_numbers_are_longs_and_large_ones_stay_exact(spark, source, tmp_path, monkeypatch):
    """Cleaned numbers are wide only in columns that hold a large one, and the load looks at the rules once."""
    seen = []

    def load(cleaned, *options):
        seen.append(cleaned)
        return load_star(cleaned, *options)

    monkeypatch.setattr(pipeline, "load_star", load)
    root = str(tmp_path / "w")
    first = run_pipeline(spark, [source("usual.csv", ("2020-01-01", 1, "90.5"), ("soon", 2, 91))], root, on_violation="reject")
    assert (first["load"]["staging"], first["load"]["rejected"]) == (1, 1)
    large = source("large.csv", ("2020-01-02", 1, "123456789012.25"), ("2020-01-02", 2, "1e30"), ("2020-01-03", 1, 45))
    second = run_pipeline(spark, [large], root, on_violation="reject")
    assert second["unread"] == {"price": 1} and (second["load"]["staging"], second["load"]["rejected"]) == (1, 1)
    kinds = [[c.schema[name].dataType.simpleString() for name in ("price", "usd_price")] for c in seen]
    assert kinds == [["decimal(18,10)", "decimal(18,10)"], ["decimal(28,10)", "decimal(18,10)"]]
    kept = rows(Warehouse(spark, root).read_rejected(), "price", "price_per_kg", "broken")
    assert kept == [
        (Decimal("123456789012.25"), Decimal("1371742100.1361"), ["price.fits_type", "price_per_kg.fits_type"]),
        (Decimal("91"), Decimal("1.0111"), ["date.not_null"]),
    ]
    assert facts(spark, root) == [(D1, 1, 90), (D3, 1, 45)]
    passed = seen[0].where(F.col(BROKEN).isNull()).select("date")._jdf.queryExecution().optimizedPlan().toString()
    assert "cast" not in passed and "char_length" not in passed


def test_generated_methods_can_be_compiled(spark, tmp_path):
    """The JVM interprets methods of 8,000 bytes and more, which doubles the time of a cleaning step."""
    text = spark.createDataFrame([(None,) * 16], storage_schema(T.StructType([T.StructField(f.name, T.StringType()) for f in RAW.fields])))
    typed = type_columns(text, price=LONG, coordinate=LONG, date_formats=None).withColumn("row_seq", F.expr("struct('f' AS file, 0L AS block, 0L AS row)"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        uniform = clean_without_derived(hand_off(typed, str(tmp_path / "raw")), str(tmp_path / "work"))
        marked = mark_broken(price_per_kg(hand_off(uniform, str(tmp_path / "uniform")))).sortWithinPartitions("year", "date")
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        for step in (uniform, marked):
            sizes = re.findall(r"maxMethodCodeSize:(\d+)", step._jdf.queryExecution().explainString(mode))
            assert sizes and max(map(int, sizes)) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
