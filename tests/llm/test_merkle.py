from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from priceflow.llm import merkle, oracle
from llm_helpers import SCHEMA, prose


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def way(tree, i):
    """(left, right) of each level."""
    out = []
    for level in tree[:-1]:
        first = i // 8 * 8
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 8])))
        i //= 8
    return out


def leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    fields = (doc_id, source, lang, n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def brute_force(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf(r)))) for x in langs}
    trees = {x: levels([leaf(r) for r in order[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for at, x in enumerate(langs):
        for i, r in enumerate(order[x]):
            path = way(trees[x], i) + way(top, at)
            text = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for left, right in path:
                text = sha(left + text + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], proof, text, text == top[-1][0]))
    return sorted(out, key=str)


def found(spark, rows, **more):
    return sorted(map(tuple, merkle.op13_proofs(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


@pytest.mark.parametrize("height, leaves", [(0, 1), (1, 1), (1, 8), (2, 9), (3, 300), (4, 1), (4, 4096), (4, 2500), (5, 700)])
def test_layout_is_the_recursive_one(height, leaves):
    def laid_out(low, high, first, last):
        """Nodes (level, index) of levels low to high under the nodes first to last of level high, top tree first."""
        counts = [-(-leaves // 8**level) for level in range(height + 1)]
        if low == high:
            return [(low, i) for i in range(first, last)]
        n_levels = high - low + 1
        cut = low + n_levels - n_levels // 2  # the lowest level of the top tree
        out = laid_out(cut, high, first, last)
        roots_first, roots_last = first * 8 ** (high - cut + 1), min(last * 8 ** (high - cut + 1), counts[cut - 1])
        for i in range(roots_first, roots_last):
            out += laid_out(low, cut - 1, i, i + 1)
        return out

    expected = laid_out(0, height, 0, 1)
    places = merkle.addresses(height, leaves)
    assert {(level, i): at for at, (level, i) in enumerate(expected)} == {
        (level, i): at for level, row in enumerate(places) for i, at in enumerate(row)
    }


def test_proofs_are_those_of_whole_trees(spark):
    draw = random.Random(4)
    rows = [(i, prose(i, 5).title() if i % 4 else None, draw.choice(["en", "en", "fr", None, "é"]), f"s{i % 3}", i) for i in range(300)]
    rows += [(1000 + i, "Xy", f"l{i:02}", None, None) for i in range(12)]
    draw.shuffle(rows)
    got = found(spark, rows)
    assert got == brute_force(rows)
    wrong = [r for r in got if not r[-1]]
    assert wrong and all(zlib.crc32(str(r[0]).encode()) % 3 == 0 for r in wrong)


@pytest.mark.parametrize("height", [1, 2])
def test_trees_of_several_tiers(spark, height):
    rows = [(i, f"Text {i}", "en" if i % 5 else "fr", "s", i) for i in range(700)] + [(900 + i, "A", f"l{i:02}", "s", 1) for i in range(70)]
    leaves, blocks, proofs = merkle.manifest(spark.createDataFrame(rows, SCHEMA), merkle.tampered(), height)
    assert sorted(map(tuple, proofs.collect()), key=str) == brute_force(rows)
    assert leaves.count() == 770 and blocks.agg({"leaves": "sum"}).first()[0] == 770 and blocks.agg({"leaves": "max"}).first()[0] == 8**height


def test_sql_gives_the_same(spark, tmp_path):
    rows = [(i, f"Text é {i}" if i % 7 else None, ["en", "fr", None][i % 5 % 3], f"s{i % 3}", i) for i in range(150)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.toPandas().astype({"n_chars": "Int64"}).to_parquet(tmp_path / "documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    assert sorted(db.sql(oracle.MERKLE).fetchall(), key=str) == brute_force(rows)


def test_a_full_and_a_started_block(spark):
    rows = [(i, f"T{i}", "en", "s", i) for i in range(4097)] + [(9000 + i, "x", "de", "s", i) for i in range(9)]
    assert found(spark, rows) == brute_force(rows)


def test_odd_rows(spark):
    assert merkle.op13_proofs(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = [(7, "Only", None, None, None)]
    assert found(spark, lone) == brute_force(lone)
    odd = [(None, None, None, None, None), (None, "", None, None, None), (None, "", None, None, None), (3, "", "", "", 0), (3, "B", "", "", 0)]
    odd += [(5, "Long " * 200_000, "en", "s", 1)]
    assert found(spark, odd) == brute_force(odd)
    more = spark.createDataFrame(lone, SCHEMA).selectExpr("*", "1 AS n", "2 AS tree", "3 AS _place", "4 AS digest", "5 AS path")
    assert merkle.op13_proofs(more).count() == 1
