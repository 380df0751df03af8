from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from priceflow.llm import tokens

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
path = pytest.importorskip("public_tokenizers").path

PARTS = [
    "a", "The", "don't", "x's", " ", " ", "  ", "\n", "\n\n", ".", ",", "!?", "\u00e9", "e\u0301", "\u0130", "\u03a3", "12", "\t", "\r\n", "\xa0", "\x1c",
    "\u200b", "\u4e2d", "\U0001f600", "\x85", "\u00d7", "\u00f7.", "\u2581", "<", "<s>", "<unk>", "\x00", "#.", "\u3000", "\u0344",
]
SPECIAL = "<|endoftext|>"


def texts(special: bool) -> list[str]:
    rng = random.Random(4)
    parts = [*PARTS, SPECIAL] if special else PARTS
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]


def ids(encoded) -> list[list[int]]:
    return [np.frombuffer(x, "<u4").tolist() for x in encoded.of_each()]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("plain", [False, True])
def test_ids_are_those_of_the_library(name, plain):
    library = tokenizers.Tokenizer.from_file(path(name))
    if plain:
        library.encode_special_tokens = True
    given_texts = texts(True)
    found = ids(tokens.Encoder(path(name), plain).encode(pa.array(given_texts)))
    assert found == [library.encode(t, add_special_tokens=False).ids for t in given_texts]


def test_pieces_are_those_of_the_model():
    model = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    given_texts = [t for t in texts(True) if t]
    encoder = tokens.piece_encoder("piece_bpe_32k.model")
    found = encoder.encode(pa.array([" " + t for t in given_texts]))
    assert ids(found) == [model.encode(t) for t in given_texts]
    joined = [b"".join(encoder.bytes_of[i] for i in x) for x in ids(found)]
    assert found.exact.tolist() == [j == (" " + t).encode() for j, t in zip(joined, given_texts)]
    assert not all(found.exact) and any(found.exact)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(given_texts):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = tokens.encoder(name)
        expected = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in given_texts]
        assert ids(encoder.encode(pa.array(given_texts, pa.string()))) == expected


def test_slices_nulls_and_forgetting(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE", 7)
    encoder = tokens.Encoder(path("byte_bpe_50k.json"))
    encoder.memory.most = 5
    given_texts = [None, *texts(False)[:300], ""]
    array = pa.array(["skipped", *given_texts]).slice(1)
    assert ids(encoder.encode(array)) == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in given_texts]
    assert ids(encoder.encode(pa.array([], pa.string()))) == []
