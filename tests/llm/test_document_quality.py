from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from priceflow.llm import divergence, oracle, quality_bayes
from llm_helpers import SCHEMA, prose

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    good = [(i, prose(i, 120), "en", f"src{i % 3}", 1) for i in range(120)]
    bad = [(1000 + i, ("BUY!! NOW## " * 40) + prose(i, 5), "en", "spam" if i % 2 else "src1", 1) for i in range(40)]
    odd = [(2000, "", "en", "src1", 0), (2001, None, None, None, None), (None, prose(5, 90), None, "src2", 1)]
    labels = [(i, 1, 0) for i in range(0, 120, 2)] + [(1000 + i, 0, 0) for i in range(0, 40, 2)] + [(None, 1, 0), (1, None, 0)]
    return spark.createDataFrame(good + bad + odd, SCHEMA), spark.createDataFrame(labels, LABELS)


def test_held_out_documents_are_told_apart(corpus):
    docs, labels = corpus
    rows = {r.doc_id: r for r in quality_bayes.op1_quality(docs, labels).collect()}
    assert all(rows[i].kept for i in range(120))
    assert not any(rows[1000 + i].kept for i in range(40))
    assert not rows[2000].kept and not rows[2001].kept and rows[None].kept
    assert rows[2000].score == 0


def test_sites_shrink_towards_what_is_above_them(spark):
    groups = [("a", 200.0, 180.0), ("b", 200.0, 100.0), ("c", 2.0, 0.0)]
    frame = spark.createDataFrame(groups, "host string, n double, s double").withColumn("mean", F.lit(282 / 402))
    weight = quality_bayes.prior_weight(frame, "mean", 402.0, 0.2, 3)
    assert 0 < weight < 50
    even = frame.withColumn("s", F.col("n") * 0.7)
    assert quality_bayes.prior_weight(even.withColumn("mean", F.lit(0.7)), "mean", 402.0, 0.2, 3) == 1e9


def test_no_labels_and_no_documents(corpus):
    docs, labels = corpus
    rows = quality_bayes.op1_quality(docs, labels.where("false")).collect()
    assert {r.kept for r in rows if r.doc_id != 2000 and r.doc_id != 2001} == {True}
    assert quality_bayes.op1_quality(docs.where("false"), labels).count() == 0
    assert quality_bayes.op1_quality(docs.where("doc_id = 2000"), labels).collect()[0].kept is False


def test_good_documents_keep_their_columns(corpus):
    docs, labels = corpus
    wide = docs.selectExpr("*", "1 AS _rejected", "2 AS score", "3 AS host")
    kept = quality_bayes.good_documents(wide, labels)
    assert kept.columns == wide.columns
    assert kept.count() == 121


def test_rules_are_those_of_their_sql(corpus, tmp_path):
    docs, _ = corpus
    strange = docs.sparkSession.createDataFrame(
        [(3000, "a b c a b c a b c", "en", "s", 1), (3001, "x y", "en", "s", 1), (3002, "l\n l\nl\n\n\n", "zz", "s", 1),
         (3003, "la maison de la ville et le jour " * 20, "fr", "s", 1), (3003, "la maison", "fr", "s", 1)], SCHEMA
    )
    rows = docs.unionByName(strange)
    rows.coalesce(1).write.parquet(str(tmp_path / "d"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    expected = connection.sql(oracle.SQL["op2_divergence_rules"])
    found = divergence.op2_rules(rows).select(*expected.columns).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected.fetchall(), key=str)
    assert divergence.op2_rules(rows.where("false")).count() == 0
