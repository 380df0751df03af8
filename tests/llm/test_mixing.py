from __future__ import annotations

import random
from fractions import Fraction

import duckdb
import pytest

from priceflow.llm import mixing, oracle
from llm_helpers import SCHEMA, prose


def targets_of(sizes: dict[str | None, int]) -> dict[str | None, Fraction]:
    """Clamp, reshare by weight, repeat: one source after the other, with fractions."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, Fraction(3, 2) * sum(sizes.values()), set(order)
    while free:
        shares = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if shares[s] > 2 * sizes[s]]
        if not over:
            return target | shares
        for s in over:
            target[s] = Fraction(2 * sizes[s])
            left -= target[s]
            free.discard(s)
    return target


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, s, t in rows], SCHEMA)


@pytest.fixture
def many():
    draw = random.Random(3)
    return [(i, draw.choice(["a", "a", "a", "b", "é", "z", "Z", None, f"s{i % 11}"]), prose(i, draw.randint(0, 60))) for i in range(600)]


def test_targets_are_those_of_clamping_one_by_one(spark, many):
    found = mixing.op11_mixture(table_of(spark, many)).collect()
    sizes: dict = {}
    for _, source, text in many:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    expected = targets_of(sizes)
    assert len(found) == len(many)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(expected[r.source]), abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    # Only documents of the cut cell are rounded.
    assert all(abs(taken[s] - expected[s]) <= 4 for s in sizes)


def test_sql_gives_the_same_and_reruns_agree(spark, many, tmp_path):
    docs = table_of(spark, many)
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    expected = db.sql(oracle.MIXTURE)
    found = mixing.op11_mixture(docs).select(*expected.columns)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected.fetchall(), key=str)
    again = mixing.op11_mixture(docs.repartition(7)).select(*expected.columns)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(expected.fetchall(), key=str)


def test_the_mix_holds_the_words_taken(spark, many):
    docs = table_of(spark, many).withColumn("size", docs_extra := mixing.F.lit("x")).withColumn("cell", docs_extra)
    taken = {r.doc_id: r.taken for r in mixing.op11_mixture(docs).collect()}
    texts: dict = {}
    whole = {i: t for i, _, t in many}
    for r in mixing.mixed(docs).collect():
        assert whole[r.doc_id].startswith(r.text) and r["size"] == "x"
        texts.setdefault(r.doc_id, []).append((r.repetition, len(r.text.split())))
    for i, n in taken.items():
        got = sorted(texts.get(i, []))
        assert sum(words for _, words in got) == n and [p for p, _ in got] == list(range(len(got)))


def test_odd_rows(spark):
    assert mixing.op11_mixture(table_of(spark, []).where("false")).count() == 0
    blank = mixing.op11_mixture(table_of(spark, [(1, "a", None), (2, None, ""), (None, "a", " \n")])).collect()
    assert {(r.size, r.target, r.taken) for r in blank} == {(0, 0.0, 0)}
    one = mixing.op11_mixture(table_of(spark, [(1, None, "a b"), (1, None, "a b"), (None, None, "a b c d")])).collect()
    assert sum(r.taken for r in one) == 12 and {r.target for r in one} == {12.0}
    long = "word " * 300_000
    found = {r.doc_id: r for r in mixing.op11_mixture(table_of(spark, [(1, "a", long), (2, "b", "x"), (3, "c", "y")])).collect()}
    assert found[1]["size"] == 300_000 and found[2].taken == found[3].taken == 2
    assert found[1].taken in (449_999, 450_000)
    with pytest.raises(ValueError):
        mixing.mixed(table_of(spark, [(1, "a", "b")]).withColumnRenamed("lang", "repetition"))


def test_every_source_is_clamped_where_the_mix_is_larger_than_all_epochs(spark):
    rows = [(i, "ab"[i % 2], prose(i, 20)) for i in range(10)]
    found = mixing.mixture(table_of(spark, rows), share=(5, 1), epochs=3).collect()
    assert {(r.taken, r.target) for r in found} == {(60, 300.0)}
