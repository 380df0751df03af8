from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from priceflow.llm import secrets

ASSIGN = re.compile(secrets.ASSIGN)


def brute_force(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_base_spans_are_those_of_brute_force(docs_of):
    rng = random.Random(3)
    parts = ["password", "Token", "api_key", "APIKEY", "=", ":", " ", "'", '"', "abc", "abcdef1", "AKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "é", "\U0001f600", "\n", "secret"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(400)] + ["", None]
    for row in secrets.op9_secrets(docs_of(*texts)).collect():
        expected = brute_force(texts[row.doc_id] or "")
        assert row.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert set(filter(None, expected.split(","))) <= set(row.spans.split(","))
        assert [row.n_assign, row.n_access, row.n_hex] == [expected.count(k) for k in ("assign:", "access:", "hex:")]


def test_random_strings_are_found_and_words_left(spark, docs_of):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(letters) for _ in range(40)) + "7a" for _ in range(150)]
    plain = ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "0000000000000000000000000000000000000000x", "thisisalongidentifierwithwordsandone1number"]
    texts = [f"key {k} here" for k in keys] + [f"word {p} here" for p in plain for _ in range(40)]
    rows = {r.doc_id: r.spans for r in secrets.op9_secrets(docs_of(*texts)).collect()}
    assert sum("random" in rows[i] for i in range(150)) >= 130
    assert sum("random" in rows[i] for i in range(150, 270)) == 0
    assert rows[0] in ("", "random:4:46")
    assert secrets.op9_secrets(docs_of((1, "x")).where("false")).count() == 0


def test_p_values_of_random_strings_are_even(spark):
    rng = random.Random(6)
    rows = [("".join(rng.choice("0123456789abcdef") for _ in range(64)),) for _ in range(600)]
    tests = secrets.tested(spark.createDataFrame(rows, "found string"))
    for name in ("p_uniform", "p_runs", "p_serial", "p"):
        low, mid = tests.agg(F.avg((F.col(name) < 0.1).cast("int")), F.avg((F.col(name) < 0.5).cast("int"))).first()
        assert low < 0.2 and 0.35 < mid < 0.65, name


def test_few_keys_are_found_among_any_number_of_words(spark):
    cases = [(1, 28), (1, 29), (1, 1000), (3, 1000), (10, 1000), (30, 0), (100, 0)]
    rng = random.Random(7)
    # 100 bands of each case; words have p-values of about 0, keys have uniform ones.
    keys = [(f"{n} {w}", band, f"{band} {i}", rng.random()) for n, w in cases for band in range(100) for i in range(n)]
    keys = spark.createDataFrame(keys, "alphabet string, band int, found string, p double")
    words = [spark.range(100 * w).selectExpr(f"'{n} {w}'", "cast(id % 100 as int)", "cast(id as string)", "0D") for n, w in cases if w]
    tests = keys
    for some in words:
        tests = tests.union(some)
    limits = secrets.thresholds(tests)
    found = keys.join(limits, ["alphabet", "band"]).groupBy("alphabet").agg(F.avg((F.col("p") >= F.col("least_p")).cast("int")).alias("share"))
    assert {r.alphabet: r.share for r in found.collect() if r.share < 0.88} == {}
    # Copies of a key change nothing, and many different words between 0.1 and 0.3 are no keys.
    copies = spark.range(1000).selectExpr("'copies' alphabet", "0 band", "'same' found", "0.3D p")
    alike = spark.range(1000).selectExpr("'words' alphabet", "0 band", "cast(id as string) found", "0.1D + id % 20 / 100D p")
    least = {r.alphabet: r.least_p for r in secrets.thresholds(copies.union(alike)).collect()}
    assert least["copies"] <= 0.3 and least["words"] >= 0.25
