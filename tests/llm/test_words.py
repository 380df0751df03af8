from __future__ import annotations

import random

import pyarrow as pa

from priceflow.llm import text


def hashed(texts):
    out = []
    for first, before, words, starts, ends in text.word_runs(pa.array(texts, pa.string())):
        for i, (a, b) in enumerate(zip(before, before[1:])):
            data = (texts[first + i] or "").encode()
            out.append([(data[s:e].lower(), int(h)) for s, e, h in zip(starts[a:b], ends[a:b], words[a:b])])
    return out


def test_words_are_those_of_bytes_split():
    rng = random.Random(1)
    parts = ["Abc", "é", "\x85", " ", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "x" * 40, "", "9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", "  "]
    found = hashed(texts)
    assert [[w for w, _ in row] for row in found] == [(t or "").encode().lower().split() for t in texts]
    by_word = {}
    for row in found:
        for word, value in row:
            assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_long_texts_are_cut_at_white_space(monkeypatch):
    body = " ".join(f"word{i}" for i in range(3000)) + " " + "y" * 5000 + " end"
    whole = hashed([body, "short one"])
    monkeypatch.setattr(text, "CHUNK", 1000)
    monkeypatch.setattr(text, "_tables", [])
    assert hashed([body, "short one"]) == whole
