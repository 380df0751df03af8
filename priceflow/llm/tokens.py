"""Token ids of whole texts by public tokenizers, with the ids of repeated pieces remembered.

A text is cut where no token of these tokenizers can reach across: before white space behind a visible character, behind a lone line
end, and between a letter or digit and a punctuation mark. So the ids of a text are those of its pieces, one after the other.
A batch is cut as one array of bytes and its pieces are numbered by Arrow; only different pieces that a worker process has not
seen yet reach the tokenizer, and the ids of all pieces are taken by index. Each process remembers up to ``MOST_PIECES`` pieces.

Where an added token of the tokenizer stands in a text, that text is encoded whole, unless these strings are to be plain text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_PIECES = 600_000
AT_ONCE = 4096
#: Pieces of a long text that are looked up at a time.
SLICE = 1 << 20

_VISIBLE, _WORD, _MARK, _LATIN = (np.zeros(256, bool) for _ in range(4))
_VISIBLE[0x21:0x7F] = True
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK[list(b".,;:!?")] = True
_LATIN[0xC3:0xCA] = True  # first bytes of Latin letters beyond ASCII, and of two signs
_LINE, _SPACE = 10, 32

#: A space or none, then letters on whose kind and small form all libraries agree.
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, and the number of pieces before each text (and at the end)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1 + texts.offset)[texts.offset :] if n else np.zeros(1, np.int64)
    held = texts.buffers()[2] if n else None
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.empty(0, np.uint8)
    starts = offsets - offsets[0]
    edge = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        before, now = data[:-1], data[1:]
        # The second byte of a Latin letter is known by its first.
        latin = np.zeros(len(before), bool)
        latin[1:] = _LATIN[data[:-2]] & (before[1:] >= 0x80)
        visible = _VISIBLE[before] | latin
        sign = np.zeros(len(before), bool)
        sign[1:] = (data[:-2] == 0xC3) & ((before[1:] == 0x97) | (before[1:] == 0xB7))
        sign[1:] |= (data[:-2] == 0xC4) & (before[1:] == 0xB0)  # its small letter ends in a mark
        edge[1:-1] = visible & ((now == _SPACE) | (now == _LINE))
        edge[2:-1] |= edge[1:-2] & (before[1:] == _LINE) & _VISIBLE[now[1:]]
        edge[1:-1] |= (_WORD[before] | (latin & ~sign)) & _MARK[now]
    edge[starts] = True
    edge[len(data)] = True
    ends = np.flatnonzero(edge)
    pieces = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return pieces, np.searchsorted(ends, starts)


class Memory:
    """Ids of different pieces, all in one array, and whether the ids' bytes (``bytes_of``, if given) are those of the piece.

    ``encode`` gives the ids of some pieces, one after the other, and how many each has.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[list[int], list[int]]], bytes_of: list[bytes] | None, most: int = MOST_PIECES) -> None:
        self.encode, self.bytes_of, self.most = encode, bytes_of, most
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.starts, self.sizes, self.exact = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, bool)

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece; new ones are encoded."""
        if len(self.numbers) > self.most:
            self._clear()
        numbers = self.numbers
        new = [p for p in pieces if p not in numbers]
        if new:
            self._add(new)
        return np.fromiter(map(numbers.__getitem__, pieces), np.int32, len(pieces))

    def _add(self, pieces: list[str]) -> None:
        parts = [self.encode(pieces[i : i + AT_ONCE]) for i in range(0, len(pieces), AT_ONCE)]
        sizes = np.concatenate([np.array(n, np.int32) for _, n in parts])
        ids = np.concatenate([np.array(found, np.uint32) for found, _ in parts])
        exact = np.ones(len(pieces), bool)
        if self.bytes_of:
            at, known = 0, ids.tolist()
            for i, (piece, n) in enumerate(zip(pieces, sizes.tolist())):
                exact[i] = b"".join([self.bytes_of[x] for x in known[at : at + n]]) == piece.encode()
                at += n
        first = len(self.numbers)
        self.numbers.update(zip(pieces, range(first, first + len(pieces))))
        self.starts = np.concatenate([self.starts, (len(self.ids) + np.cumsum(sizes) - sizes).astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        self.sizes, self.exact = np.concatenate([self.sizes, sizes]), np.concatenate([self.exact, exact])


def _ids_of(memory: Memory, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of the pieces, how many each has, and whether they are exact."""
    ids, sizes, exact = [np.empty(0, np.uint32)], [np.empty(0, np.int32)], [np.empty(0, bool)]
    for at in range(0, len(pieces), SLICE):
        coded = pieces.slice(at, SLICE).dictionary_encode()
        numbers = memory.look_up(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        n = memory.sizes[numbers]
        until = np.cumsum(n, dtype=np.int32)
        index = np.repeat(memory.starts[numbers] - until + n, n)
        index += np.arange(len(index), dtype=np.int32)
        ids.append(memory.ids[index])
        sizes.append(n)
        exact.append(memory.exact[numbers])
    return np.concatenate(ids), np.concatenate(sizes), np.concatenate(exact)


class Encoded:
    """The ids of a batch of texts: ids, offsets (of each text's first id, and the end), exact (of each text)."""

    def __init__(self, memory: Memory, texts: pa.Array) -> None:
        pieces, rows = cut(texts)
        self.ids, sizes, exact = _ids_of(memory, pieces)
        before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        self.offsets = before[rows]
        wrong = np.concatenate([[0], np.cumsum(~exact)])
        self.exact = wrong[rows[1:]] == wrong[rows[:-1]]

    def of_each(self) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        data = self.ids.astype("<u4").tobytes()
        bounds = (4 * self.offsets).tolist()
        return (data[a:b] for a, b in zip(bounds, bounds[1:]))


class Encoder:
    """A file of the tokenizers library. By default its added tokens stand for themselves in a text, as in the library."""

    def __init__(self, path: str, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.added = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.byte_level = self.tokenizer.normalizer is None
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.bytes_of = [_byte_level(name) for name in names] if self.byte_level else None
        self.memory = Memory(self._encode, self.bytes_of if plain else None)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        """The ids of pieces. A plain word is one piece for the library too and goes to its model at once."""
        plain = [_PLAIN.fullmatch(piece) is not None for piece in pieces]
        others = iter(self._whole([piece for piece, is_plain in zip(pieces, plain) if not is_plain]))
        words = pieces if self.byte_level else [piece.lstrip(" ").lower() for piece in pieces]
        split = self.tokenizer.model.tokenize
        ids, sizes = [], []
        for word, is_plain in zip(words, plain):
            if not is_plain:
                found = next(others).tolist()
            elif word.isascii():
                found = [t.id for t in split(word.replace(" ", _BLANK))]
            else:
                found = [t.id for t in split(word.encode().decode("latin-1").translate(_LETTERS))]
            ids += found
            sizes.append(len(found))
        return ids, sizes

    def encode(self, texts: pa.Array) -> Encoded:
        """The ids of each text; null is empty."""
        out = Encoded(self.memory, texts)
        special = np.zeros(len(texts), bool)
        for content in self.added:
            special |= pc.match_substring(texts.fill_null(""), content).to_numpy(zero_copy_only=False)
        if special.any():
            parts = np.split(out.ids, out.offsets[1:-1])
            for i in np.flatnonzero(special).tolist():
                parts[i] = self._whole([texts[i].as_py()])[0]
            out.ids = np.concatenate(parts)
            out.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return out


class PieceEncoder:
    """A model of the sentencepiece library whose pieces keep to words; texts are given with the space that it puts before them."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        found = [byte.fullmatch(name) for name in names]
        self.bytes_of = [bytes([int(m[1], 16)]) if m else name.replace("▁", " ").encode() for m, name in zip(found, names)]
        across = re.compile(r"[^▁]▁|[A-Za-z0-9À-ʯ][.,;:!?]")
        if any(across.search(name) or "\n" in name for name in names):
            raise ValueError(f"pieces of this model reach across words: {path}")
        self.memory = Memory(self._encode, self.bytes_of)

    def _encode(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        # The space before a text is put there by the model. A line end before other pieces keeps it away.
        spaced = [len(p) > 1 and p[0] == " " for p in pieces]
        found = self.model.encode([p[1:] if s else "\n" + p for p, s in zip(pieces, spaced)], num_threads=1)
        kept = [ids if s else ids[2:] for ids, s in zip(found, spaced)]
        return [x for ids in kept for x in ids], [len(ids) for ids in kept]

    def encode(self, texts: pa.Array) -> Encoded:
        return Encoded(self.memory, texts)


def _byte_level(name: str) -> bytes:
    """The bytes that a byte-level token stands for."""
    return bytes(_BYTES[c] for c in name) if all(c in _BYTES for c in name) else name.encode()


def _byte_letters() -> dict[str, int]:
    """The letter of each byte: itself where it is visible, else the next one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


_BYTES = _byte_letters()
_LETTERS = {byte: letter for letter, byte in _BYTES.items()}
_BLANK = _LETTERS[_SPACE]


@lru_cache(maxsize=4)
def encoder(name: str, plain: bool = False) -> Encoder:
    """One encoder for each file and worker process; ``name`` is a public file's name, or a path."""
    return Encoder(_path(name), plain)


@lru_cache(maxsize=2)
def piece_encoder(name: str) -> PieceEncoder:
    return PieceEncoder(_path(name))


def _path(name: str) -> str:
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name)
