from __future__ import annotations

import hashlib
import random

from priceflow.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(WHITE))


def brute_force(pairs):
    first = {}
    holders = {}
    for i, body in pairs:
        for line in (body or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    first = {k: min(ids) for k, ids in holders.items() if len(k) >= 10 and len(ids) >= 2}
    out = set()
    for i, body in pairs:
        lines = (body or "").split("\n")
        left = [x for x in lines if first.get(key(x), i) == i]
        out.add((i, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return out


def test_lines_are_those_of_brute_force(docs_of):
    rng = random.Random(2)
    lines = ["a common line here", "  A Common LINE here\t", "short", "ééééééééé", "éééééééééé", "ÉÉÉÉÉÉÉÉÉÉ", "", "   ", "another line of text", "0123456789"]
    pairs = [(i, "\n".join(rng.choice(lines) + rng.choice(["", "", f" {rng.randint(0, 5)}"]) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    pairs += [(60, None), (61, "")]
    rng.shuffle(pairs)
    got = {tuple(r) for r in line_dedup.op4_lines(docs_of(*pairs)).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()}
    assert got == brute_force(pairs)


def test_documents_keep_their_columns(docs_of):
    docs = docs_of((1, "the very same line\nown"), (2, "The Very same line \nother"), (2, "The Very same line \nother"), (None, "the very same line"))
    docs = docs.selectExpr("*", "1 AS row", "2 AS kept", "3 AS lost", "4 AS n_lines")
    out = line_dedup.deduplicated(docs)
    assert out.dtypes == docs.dtypes
    got = sorted(((r.doc_id or 0, r.text, r.n_chars, r.row, r.kept, r.lost, r.n_lines) for r in out.collect()), key=str)
    assert got == sorted(
        [(0, "the very same line", 18, 1, 2, 3, 4), (1, "the very same line\nown", 22, 1, 2, 3, 4)] + 2 * [(2, "other", 5, 1, 2, 3, 4)], key=str
    )
    assert line_dedup.deduplicated(docs.where("false")).count() == 0
