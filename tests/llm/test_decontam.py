from __future__ import annotations

import numpy as np

from priceflow.llm import decontam
from llm_helpers import prose


def least_edits(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(words):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_hits_are_those_of_brute_force(spark, docs_of):
    rng = np.random.default_rng(1)
    items = [prose(i, 12 + 4 * i) for i in range(10)] + [prose(3, 24), "too short", None, ""]
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = []
    for i in range(60):
        words = items[i % 10].split()
        for _ in range(i % 9):
            at, kind = int(rng.integers(len(words))), i % 3
            words[at : at + (kind != 0)] = [] if kind == 1 else [f"new{i}"]
        texts.append(prose(500 + i, 30) + " " + " ".join(words).upper() + "\n" + prose(900 + i, 20))
    texts += [items[0], prose(77, 300), "", None, " ".join(items[:3])]
    got = {r.doc_id: (r.item_ids, r.kept) for r in decontam.op7_contamination(docs_of(*texts), frame).collect()}
    for doc_id, body in enumerate(texts):
        words = (body or "").lower().split()
        expected = [
            i for i, item in enumerate(items)
            if item and len(item.split()) >= 8 and least_edits(item.split(), words) <= int(len(item.split()) * 0.2)
        ]
        assert got[doc_id] == (expected, not expected)


def test_blocks_give_the_same_and_columns_pass(spark, docs_of):
    items = [(None if i == 3 else i, prose(i, 20)) for i in range(9)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(*(prose(i, 20) + " end" for i in range(12)), "", (None, None)).selectExpr("*", "1 AS _hits", "2 AS row")
    whole = {(r.doc_id, str(sorted(h.item_id or 0 for h in r._hits))) for r in decontam.with_hits(docs.drop("_hits"), frame).collect()}
    parts = {(r.doc_id, str(sorted(h.item_id or 0 for h in r._hits))) for r in decontam.with_hits(docs.drop("_hits"), frame, block_words=70).collect()}
    assert whole == parts
    clean = decontam.decontaminated(docs, frame)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id or -1, r._hits, r.row) for r in clean.collect()) == [(-1, 1, 2), (9, 1, 2), (10, 1, 2), (11, 1, 2), (12, 1, 2)]
    assert decontam.op7_contamination(docs, frame.where("false")).where("kept").count() == 14
    assert decontam.op7_contamination(docs.where("false"), frame).count() == 0


def test_recall_of_edited_copies():
    words = [np.random.default_rng(i).integers(1, 1 << 62, 40, dtype=np.uint64) for i in range(50)]
    items = decontam.prepared(list(range(50)), words)
    rng = np.random.default_rng(99)
    found = 0
    for i in range(50):
        noise = rng.integers(1, 1 << 62, 100, dtype=np.uint64)
        text = np.concatenate([noise[:50], decontam.edited(words[i], 8, rng), noise[50:]])
        found += i in decontam.matches(text, items)
    assert found >= 48


def test_long_items_are_found_among_many_short_ones():
    sizes = [10] * 300 + [400] * 5 + [200] * 5 + [100] * 5
    words = [np.random.default_rng(i).integers(1, 1 << 62, n, dtype=np.uint64) for i, n in enumerate(sizes)]
    items = decontam.prepared(list(range(len(sizes))), words)
    rng = np.random.default_rng(98)
    found = []
    for i in [*range(300, 315)] * 2:
        noise = rng.integers(1, 1 << 62, 100, dtype=np.uint64)
        text = np.concatenate([noise[:50], decontam.edited(words[i], sizes[i] // 5, rng), noise[50:]])
        hit = decontam.matches(text, items)
        assert all(hit[j][2] == least_edits(words[j].tolist(), text.tolist()) for j in hit)
        found.append(i in hit)
    assert sum(found) >= 29 and all(f for f, i in zip(found, [*range(300, 315)] * 2) if i < 310)


def test_short_items_are_those_of_brute_force(spark, docs_of):
    items = ["one", "two words", "a b c", "all of these four", "five words of an item", "this item holds six words", "and seven words are in this one", " ", "b c"]
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"{prose(i, 20)} {item} {prose(40 + i, 20)}" for i, item in enumerate(items)]
    texts += ["a b x c", "five words of item", "Five WORDS of\nsome item", "five words item", "item this holds six words", "One", "", None]
    got = {r.doc_id: (r.item_ids, r.kept) for r in decontam.op7_contamination(docs_of(*texts), frame).collect()}
    for doc_id, body in enumerate(texts):
        words = (body or "").lower().split()
        expected = [i for i, item in enumerate(items) if item.split() and least_edits(item.split(), words) <= len(item.split()) // 5]
        assert got[doc_id] == (expected, not expected)
    long = decontam.with_hits(docs_of(*texts), frame, min_words=8)
    assert long.where("size(_hits) > 0").count() == 0
