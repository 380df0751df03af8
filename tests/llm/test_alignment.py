from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from priceflow.llm import alignment
from llm_helpers import prose

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
path = pytest.importorskip("public_tokenizers").path
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(1, 12))
def test_pieces_give_what_one_merge_gives(ends_a, ends_b, piece):
    a, b = (np.array(sorted(ends | {61})) for ends in (ends_a, ends_b))
    links, groups, i, j = [], [], 0, 0
    while i < len(a):
        links.append((i, j))
        i, j = i + (a[i] <= b[j]), j + (b[j] <= a[i])
        if i and j and a[i - 1] == b[j - 1]:
            groups.append((i, j))
    link_a, link_b, group_a, group_b = alignment.align(a, b, piece)
    assert list(zip(link_a.tolist(), link_b.tolist())) == links
    assert list(zip(group_a.tolist(), group_b.tolist())) == groups
    starts_a, starts_b = alignment.merge_path(a, b, piece)
    assert (np.diff(starts_a + starts_b)[:-1] == piece).all()


def brute_force(pairs):
    first = tokenizers.Tokenizer.from_file(path(A))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=path(B))
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(x): x for x in seen} | {chr(0x100 + i): x for i, x in enumerate(x for x in range(256) if x not in seen)}

    def piece_bytes(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    held = []
    for doc_id, text in pairs:
        ids = [first.encode(" " + (text or ""), add_special_tokens=False).ids, second.encode(text or "")] if text else [[], []]
        parts = [[bytes(letters[c] for c in first.id_to_token(i)) for i in ids[0]], [piece_bytes(i) for i in ids[1]]]
        if text and any(b"".join(p) != (" " + text).encode() for p in parts):
            ids = [[], []]
        spans = []
        for tokens, sizes in zip(ids, parts):
            at, out = 0, []
            for i, size in zip(tokens, map(len, sizes)):
                out.append((i, at, at + size))
                at += size
            spans.append(out)
        links = [(x, y) for x, s, e in spans[0] for y, s2, e2 in spans[1] if s < e2 and s2 < e]
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [[[str(i) for i, _, e in side if low < e <= high] for side in spans] for low, high in zip([0, *ends], ends)]
        held.append((doc_id, spans, links, ";".join("|".join(",".join(side) for side in g) for g in groups), len(groups)))
    counts = Counter(pair for _, _, links, _, _ in held for pair in set(links))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    return [
        (doc_id, len(spans[0]), len(spans[1]), n_groups, len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(text.encode()).hexdigest() if text else "")
        for doc_id, spans, links, text, n_groups in held
    ]


def found(docs):
    return sorted(map(tuple, alignment.op12_alignment(docs, A, B).collect()), key=str)


def test_numbers_are_those_of_brute_force(docs_of):
    rng = random.Random(8)
    parts = ["The", "don't", " word", "  ", "\n", "\n\n", ".", "!?", "é", "12", "中", "\U0001f600", "<|endoftext|>", "<s>", "a▁b", "\t", "unhappiness", "\xa0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(150)]
    texts += [prose(i, 60) for i in range(20)] + [None, "", " ", "\n", "▁", "x"]
    pairs = list(enumerate(texts)) + [(7, "again"), (None, "again"), (None, "again")]
    assert found(docs_of(*pairs).repartition(3)) == sorted(brute_force(pairs), key=str)


def test_a_long_text_in_many_pieces():
    text = " ".join(prose(i, 50) + ".\n" for i in range(400))
    whole = alignment.Batch(pa.array([text, "x", text]), A, B, 1 << 30)
    pieces = alignment.Batch(pa.array([text, "x", text]), A, B, 1000)
    for name in ("link_a", "link_b", "group_a", "group_b", "groups_before", "links_before"):
        assert (getattr(whole, name) == getattr(pieces, name)).all()
    assert [len(t) > 0 for t in pieces.group_texts()] == [True] * 3


def test_odd_tables(docs_of):
    assert found(docs_of((1, "x")).where("false")) == []
    zeros = [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
    assert found(docs_of((1, None), (2, ""))) == zeros
    clashing = docs_of((1, "a b"), (2, "a b")).selectExpr("*", "1 AS batch", "2 AS place", "3 AS pair", "4 AS n_a")
    assert [r[1:] for r in found(clashing)] == [r[1:] for r in brute_force([(1, "a b"), (2, "a b")])]
