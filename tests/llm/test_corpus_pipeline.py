from __future__ import annotations

import glob
import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from priceflow.llm import oracle, queries
from llm_helpers import SCHEMA, prose

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytest.importorskip("tokenizers")


def test_every_operator_is_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert (queries.QUERIES.keys() | {"pipeline"}) <= contract.queries().keys()
    assert oracle.SQL.keys() <= contract.oracle_sql().keys()
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_gives_what_its_sql_gives(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(file).removesuffix('.parquet')} AS SELECT * FROM '{file}'")
    expected = connection.sql(oracle.SQL[name])
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(expected.columns)
    assert sorted(map(str, map(tuple, found.select(*expected.columns).collect()))) == sorted(map(str, expected.fetchall()))


def test_stages_take_effect(spark, tmp_path):
    good = [(i, prose(i, 100), "en", "s1", 1) for i in range(40)]
    bad = [(100 + i, "BUY!! NOW!! " * 60, "en", "s2", 1) for i in range(20)]
    copies = [(200 + i, prose(i, 100) + " tail", "en", "s1", 1) for i in range(5)]
    leaks = [(300, prose(60, 50) + " " + prose(999, 20) + " " + prose(61, 50), "en", "s1", 1)]
    shared = [(400 + i, prose(500 + i, 80) + "\nall rights reserved by us\n" + prose(600 + i, 80), "en", "s1", 1) for i in range(4)]
    spark.createDataFrame(good + bad + copies + leaks + shared, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(999, 20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == columns
        left[name] = {r.doc_id: r.text for r in docs.collect()}
    clean = {r[0] for r in good} | {r[0] for r in shared}
    assert left["quality classifier"].keys() == clean | {r[0] for r in copies} | {300}
    assert "all rights" in left["line dedup"][400] and "all rights" not in left["line dedup"][401]
    assert left["MinHash near-dedup"].keys() == clean | {300}
    assert left["benchmark decontamination"].keys() == clean
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == clean
