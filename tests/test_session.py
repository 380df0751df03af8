from __future__ import annotations

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from priceflow import session
from priceflow.operators import strict
from priceflow.plans.strict_queries import distinct_counts
from priceflow.schemas import RAW, storage_schema
from priceflow.session import hand_off, path_exists, scratch_path, scratch_scope
from priceflow.sources.versions import VersionedTables


def test_tables_of_a_scope_go_with_it(spark):
    before = scratch_path(spark, "result")
    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        with scratch_scope(spark):
            nested = scratch_path(spark, "nested")
            hand_off(spark.range(3), nested)
        assert not path_exists(spark, nested)
        table = hand_off(spark.range(5), inner)
        result = hand_off(table.where("id > 1"), before)
        assert path_exists(spark, inner)
    assert not path_exists(spark, inner) and result.count() == 3
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        failed = scratch_path(spark, "failed")
        hand_off(spark.range(1), failed)
        1 / 0
    assert not path_exists(spark, failed)
    assert os.path.dirname(scratch_path(spark, "after")) == os.path.dirname(before)


def test_an_application_leaves_nothing_in_the_shared_folder(tmp_path):
    """Only what the user wrote to a path of their own is there when the driver has ended."""
    code = f"""
from pyspark.sql import SparkSession
from priceflow.session import hand_off, scratch_path
session = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
spark = session.config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate()
rows = hand_off(spark.range(5), scratch_path(spark, "kept-until-the-end"))
hand_off(rows, "{tmp_path}/shared/result")
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=120)
    shared = tmp_path / "shared"
    until = time.monotonic() + 30  # the JVM ends after the script
    while (left := {p.relative_to(shared).parts[0] for p in shared.rglob("*") if p.is_file()}) != {"result"} and time.monotonic() < until:
        time.sleep(0.2)
    assert left == {"result"}


def test_several_distinct_counts_without_doubling_rows(spark):
    data = [(k, None if a == 3 else a, None if b == 5 else f"b{b}") for k in ("x", "y", None) for a in range(4) for b in range(6)]
    df = spark.createDataFrame([*data, *data, ("z", None, None)], "k string, a int, b string")
    counts = distinct_counts(df, ["k"], {"a": "as", "b": "bs"})
    expected = df.groupBy("k").agg(F.count_distinct("a").alias("as"), F.count_distinct("b").alias("bs"))
    assert sorted(map(str, counts.collect())) == sorted(map(str, expected.collect()))
    assert "Expand" not in counts._jdf.queryExecution().toString()
    assert distinct_counts(df.where("false"), ["k"], {"a": "as", "b": "bs"}).count() == 0


def test_large_tables_are_read_in_bounded_splits(spark, tmp_path, monkeypatch):
    key = "spark.sql.files.maxPartitionBytes"
    monkeypatch.setattr(session, "SPLIT_BYTES", 1 << 18)
    usual = spark.conf.get(key)
    try:
        spark.conf.set(key, "128MB")
        values = spark.range(0, 400_000, numPartitions=1).select("id", F.rand(1).alias("value"))
        version = VersionedTables(spark, str(tmp_path / "v")).new_version()
        for stored in (session.store_table(values, str(tmp_path / "t")), version.write("t", values)):
            per_task = stored.groupBy(F.spark_partition_id().alias("task")).count().collect()
            assert sum(r["count"] for r in per_task) == 400_000 and max(r["count"] for r in per_task) <= 100_000
        spark.conf.set(key, "64k")
        session.bound_splits(spark)
        assert spark.conf.get(key) == "64k"
        spark.conf.set(key, "128MB")
        strict.clean_strict(spark.createDataFrame([], storage_schema(RAW)))
        assert int(spark.conf.get(key)) == 1 << 18
    finally:
        spark.conf.set(key, usual)


def test_stored_paths_have_no_ranges(spark, tmp_path):
    """Two comparisons of a long path for every row are spared; other columns keep what scans prune by."""
    rows = spark.range(10).selectExpr("id", "struct('file:/a/long/path' AS file, id AS row) AS row_seq", "'file:/a/long/path' AS _source_file")
    stored = session.store_table(rows.coalesce(1), str(tmp_path / "t"))
    assert stored.where("_source_file = 'file:/a/long/path' AND row_seq.file = _source_file").count() == 10
    parquet = pytest.importorskip("pyarrow.parquet")
    (file,) = (tmp_path / "t").glob("*.parquet")
    group = parquet.ParquetFile(file).metadata.row_group(0)
    ranged = {group.column(i).path_in_schema for i in range(group.num_columns) if group.column(i).statistics is not None}
    assert ranged == {"id", "row_seq.row"}
