from __future__ import annotations

import random
from collections import defaultdict

from priceflow.llm import near_dup
from llm_helpers import prose


def brute_force(pairs):
    sets = []
    for _, body in pairs:
        words = (body or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = {i: i for i, _ in pairs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(pairs):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((root(a), root(pairs[j][0])))
                parent[y] = x
    return {(i, len(s), root(i)) for (i, _), s in zip(pairs, sets)}


def found(df):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()}


def test_links_are_those_of_brute_force(docs_of):
    rng = random.Random(5)
    texts = [prose(1, 60), prose(2, 12), prose(3, 3), prose(4, 400), "", " \n", "one", "ONE", prose(9, 5)]
    passage = prose(77, 60)
    texts += [prose(100 + i, 8) + " " + passage + " " + prose(200 + i, rng.randint(0, 12)) for i in range(25)]
    for base in texts[:4] + texts[9:12]:
        for _ in range(8):
            words = base.split()
            for _ in range(rng.randint(0, 1 + len(words) // 40)):
                words[rng.randrange(len(words))] = rng.choice("uvwxyz") * 4
            texts.append(" ".join(words))
    texts += texts[:5]
    pairs = list(enumerate(texts))
    rng.shuffle(pairs)
    assert found(near_dup.op3_near_duplicates(docs_of(*pairs))) == brute_force(pairs)


def test_a_chain_of_edits_is_one_component(docs_of):
    words = prose(3, 200).split()
    texts = []
    for i in range(20):
        words[10 * i] = f"changed{i}"
        texts.append(" ".join(words))
    assert found(near_dup.op3_near_duplicates(docs_of(*texts))) == brute_force(list(enumerate(texts)))


def test_odd_rows(spark, docs_of):
    same = prose(1, 30)
    rows = near_dup.op3_near_duplicates(docs_of((None, same), (5, same), (5, prose(2, 30)), (7, prose(2, 30)), (8, None))).collect()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add((r.component_id, r.kept))
    assert by_id == {None: {(None, True)}, 5: {(5, True)}, 7: {(5, False)}, 8: {(8, True)}}
    empty = docs_of((1, "x")).where("false")
    assert near_dup.op3_near_duplicates(empty).count() == 0
    clashing = docs_of((1, same), (2, same)).selectExpr("*", "1 AS _gone", "2 AS kept", "3 AS component")
    assert [(r.doc_id, r._gone, r.kept) for r in near_dup.one_of_each(clashing).collect()] == [(1, 1, 2)]
