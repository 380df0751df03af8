"""Token ids in Simple-8b blocks: word-aligned coding with selectors, escapes and block offsets.

A 64-bit word holds a selector (4 bits) and 60 bits with as many values as fit at one width: the
selector tells how many and how wide. Coding is greedy and works on all blocks of a chunk in step,
decoding on all words of a selector at once. Values of more than 60 bits are kept raw behind the words
of their block; an escape word points to them.

A file, all numbers little-endian:

    magic | blocks | block offsets | document ids | document lengths | footer

- A block has ``BLOCK`` values (the last one of a file may have fewer): its words, then its raw values.
- Block offsets: for each block the position of its first word and of its first raw value, counted in 64-bit
  words from the first block, so any block can be read and decoded without the ones before it.
- Documents follow one another in the values, ascending by id. The smallest 64-bit number as an id is none.

``write`` sorts documents by id over all files (range partitions), so file after file holds the whole stream.

Inputs out of the ordinary
- Null or empty text: only the end id. An empty table gives no file and no row.
- Null ids come first, as one more id. Rows with the same id follow each other in the order of their text's hash.
- A long document may span many blocks and makes its file larger than ``FILE_VALUES``. Columns other than id
  and text are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from priceflow.llm.files import new_file, read_file, task_folder, write_file
from priceflow.llm.text import bound_batches, map_batches
from priceflow.llm.tokens import encoder
from priceflow.session import hand_off, scratch_path

MAGIC = b"S8BLOCK1"
BLOCK = 1024
FILE_VALUES = 1 << 24
CHUNK_BLOCKS = 512
NO_ID = -(1 << 63)

#: Fixed values of the format: how many values of how many bits, by selector. Selector 0 is the escape.
SELECTORS = [(0, 0), (1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1)]
_COUNTS = np.array([n or 1 for n, _ in SELECTORS], np.int64)


_SMALL_WIDTHS = np.array([i.bit_length() for i in range(1 << 16)], np.int8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; those of values up to 2**16 from a table."""
    if not len(values) or values.max() < len(_SMALL_WIDTHS):
        return _SMALL_WIDTHS[values.astype(np.int64)]
    return (np.searchsorted(np.uint64(1) << np.arange(1, 64, dtype=np.uint64), values, "right") + (values > 0)).astype(np.int8)


def encode_blocks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all blocks of ``values``, and of each block the number of words and of raw values."""
    n = len(values)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    table = np.zeros((blocks, BLOCK), np.uint64)
    table.ravel()[:n] = values
    width = _widths(table.ravel()).reshape(blocks, BLOCK)
    widest = int(width.max())
    # Selectors of enough bits for all values fit anywhere; the last of them holds the most values.
    sure = max((k for k, (count, bits) in enumerate(SELECTORS) if count and bits >= widest), default=0)
    best = np.full((blocks, BLOCK), sure, np.int8)
    wide = np.zeros((blocks, BLOCK + 1), np.int32)
    for selector in range(sure + 1, len(SELECTORS)):
        count, bits = SELECTORS[selector]
        np.cumsum(width > bits, axis=1, out=wide[:, 1:])
        until = np.minimum(np.arange(BLOCK) + count, BLOCK)
        fits = np.take(wide, until, axis=1) == wide[:, :-1]
        if not fits.any():
            break  # more values of fewer bits don't fit either
        best[fits] = selector
    ends = np.full(blocks, BLOCK)
    ends[-1] = n - (blocks - 1) * BLOCK
    cursor, rows = np.zeros(blocks, np.int64), np.arange(blocks)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(rows):
        chosen = best[rows, cursor[rows]]
        steps.append((rows, cursor[rows], chosen))
        cursor[rows] += _COUNTS[chosen]
        rows = rows[cursor[rows] < ends[rows]]
    of = np.concatenate([s[0] for s in steps])
    order = np.argsort(of, kind="stable")
    of = of[order]
    at = np.concatenate([s[1] for s in steps])[order]
    selectors = np.concatenate([s[2] for s in steps])[order].astype(np.int64)
    words = np.zeros(len(of), np.uint64)
    padded = np.zeros((blocks, BLOCK + 60), np.uint64)
    padded[:, :BLOCK] = table
    for selector, (count, bits) in enumerate(SELECTORS):
        here = np.flatnonzero(selectors == selector)
        if count and len(here):
            packed = np.full(len(here), selector << 60, np.uint64)
            for j in range(count):
                packed |= padded[of[here], at[here] + j] << np.uint64(j * bits)
            words[here] = packed
    escaped = np.flatnonzero(selectors == 0)
    word_counts = np.bincount(of, minlength=blocks)
    raw_counts = np.bincount(of[escaped], minlength=blocks)
    if not len(escaped):
        return words, word_counts, raw_counts
    first_raw = np.concatenate([[0], np.cumsum(raw_counts)[:-1]])
    words[escaped] = (np.arange(len(escaped)) - first_raw[of[escaped]]).astype(np.uint64)
    raw = table[of[escaped], at[escaped]]
    bounds = np.cumsum(word_counts)[:-1], np.cumsum(raw_counts)[:-1]
    parts = zip(np.split(words, bounds[0]), np.split(raw, bounds[1]))
    return np.concatenate([x for pair in parts for x in pair]), word_counts, raw_counts


def decode_blocks(words: np.ndarray, starts: np.ndarray, raws: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of blocks. Block i: words from ``starts[i]``, raw values from ``raws[i]``, ``sizes[i]`` values."""
    if not len(starts):
        return np.empty(0, np.uint64)
    counts = raws - starts
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    of = np.repeat(np.arange(len(starts)), counts)
    index = np.repeat(starts - first, counts) + np.arange(counts.sum())
    coded = words[index.astype(np.int64)]
    selectors = (coded >> np.uint64(60)).astype(np.int64)
    held = _COUNTS[selectors]
    at = np.cumsum(held) - held
    at -= np.repeat(at[first], counts)
    base = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(base[-1]), np.uint64)
    for selector, (count, bits) in enumerate(SELECTORS):
        here = np.flatnonzero(selectors == selector)
        if not len(here):
            continue
        if selector == 0:
            out[base[of[here]] + at[here]] = words[(raws[of[here]] + coded[here].astype(np.int64))]
            continue
        mask = np.uint64((1 << bits) - 1)
        for j in range(count):
            inside = here[at[here] + j < sizes[of[here]]]
            out[base[of[inside]] + at[inside] + j] = (coded[inside] >> np.uint64(j * bits)) & mask
    return out


class Writer:
    """One file: documents in, blocks out as they fill."""

    def __init__(self, path: str) -> None:
        self.path, self.out = path, write_file(path)
        self.out.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.values = self.at = 0
        self.offsets: list[np.ndarray] = []
        self.ids: list[int] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, values: np.ndarray) -> None:
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.lengths.append(len(values))
        self.waiting.append(values.astype(np.uint64))
        self.values += len(values)
        self.n_waiting += len(values)
        if self.n_waiting >= CHUNK_BLOCKS * BLOCK:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        values = np.concatenate([np.empty(0, np.uint64), *self.waiting])
        full = len(values) if last else len(values) // BLOCK * BLOCK
        for first in range(0, full, CHUNK_BLOCKS * BLOCK):
            coded, words, raws = encode_blocks(values[first : min(first + CHUNK_BLOCKS * BLOCK, full)])
            self.out.write(coded.astype("<u8").tobytes())
            starts = self.at + np.concatenate([[0], np.cumsum(words + raws)[:-1]])
            self.offsets.append(np.stack([starts, starts + words], axis=1))
            self.at += len(coded)
        self.waiting, self.n_waiting = [values[full:]], len(values) - full

    def close(self) -> None:
        self._flush(last=True)
        offsets = np.concatenate([np.empty((0, 2), np.int64), *self.offsets]).astype("<i8")
        self.out.write(offsets.tobytes())
        self.out.write(np.array(self.ids, "<i8").tobytes())
        self.out.write(np.array(self.lengths, "<i8").tobytes())
        self.out.write(struct.pack("<QQQQ", len(offsets), len(self.ids), self.values, self.at) + MAGIC)
        self.out.close()


class Reader:
    """One file: the document directory, and values of any range of blocks."""

    def __init__(self, path: str) -> None:
        self.source = read_file(path)
        size = self.source.size()
        self.source.seek(size - 40)
        tail = self.source.read(40)
        if tail[32:] != MAGIC:
            raise ValueError(f"not a block file: {path}")
        blocks, docs, self.values, self.words = struct.unpack("<QQQQ", tail[:32])
        self.source.seek(size - 40 - 16 * docs - 16 * blocks)
        directory = np.frombuffer(self.source.read(16 * (docs + blocks)), "<i8")
        self.offsets = directory[: 2 * blocks].reshape(blocks, 2)
        self.ids, self.lengths = directory[2 * blocks : 2 * blocks + docs], directory[2 * blocks + docs :]

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The values of blocks ``first`` to ``last`` (exclusive)."""
        start = int(self.offsets[first, 0])
        end = int(self.offsets[last, 0]) if last < len(self.offsets) else self.words
        self.source.seek(len(MAGIC) + 8 * start)
        words = np.frombuffer(self.source.read(8 * (end - start)), "<u8")
        offsets = self.offsets[first:last] - start
        sizes = np.full(last - first, BLOCK)
        if last == len(self.offsets):
            sizes[-1] = self.values - (last - 1) * BLOCK
        return decode_blocks(words, offsets[:, 0], offsets[:, 1], sizes)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Ids and values of all documents, with few blocks decoded at a time."""
        have, first = np.empty(0, np.uint64), 0
        for doc_id, length in zip(self.ids.tolist(), self.lengths.tolist()):
            parts = [have]
            n = len(have)
            while n < length:
                last = min(first + CHUNK_BLOCKS, len(self.offsets))
                parts.append(self.blocks(first, last))
                n, first = n + len(parts[-1]), last
            have = np.concatenate(parts) if len(parts) > 1 else have
            yield None if doc_id == NO_ID else doc_id, have[:length]
            have = have[length:]


FILES = "part long, file_number long, path string, documents long, n_values long"


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Write the ids of all texts under ``folder``; the list of files: part, file_number, path, documents, n_values."""
    bound_batches(docs.sparkSession)
    # Rows with one id, or none, are parted by their text and, if that is the same, by their place.
    place = F.xxhash64(F.monotonically_increasing_id()).alias("place")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), place)
    order = ["doc_id", F.xxhash64("text"), "place"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, writer = TaskContext.get().partitionId(), 0, None
        encode = encoder(tokenizer).encode
        done: list[tuple] = []
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)).of_each()):
                writer = writer or Writer(new_file(folder, ".s8b"))
                writer.add(doc_id, np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)))
                if writer.values >= FILE_VALUES:
                    writer.close()
                    done.append((part, number, writer.path, len(writer.ids), writer.values))
                    number, writer = number + 1, None
        if writer:
            writer.close()
            done.append((part, number, writer.path, len(writer.ids), writer.values))
        columns = list(zip(*done)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in FILES.split(", ")])

    listed = ordered.mapInArrow(write_part, FILES)
    return hand_off(listed, scratch_path(docs.sparkSession, "token-files"))


def read(files: DataFrame, with_values: bool = True) -> DataFrame:
    """The documents of written files: doc_id, start (values before it in all files), n_values, crc32, and values.

    ``files`` is what ``write`` gives. Only this list (a row per file) is numbered in one task.
    """
    before = F.sum("n_values").over(Window.orderBy("part", "file_number")) - F.col("n_values")
    numbered = files.withColumn("start", before).select("path", "start").repartition(max(1, files.count()))

    def read_file_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            out: list[list] = [[], [], [], [], []]
            held = 0
            for doc_id, values in Reader(path).documents():
                row = (doc_id, start, len(values), zlib.crc32(values.astype("<u4").tobytes()), values.view(np.int64) if with_values else None)
                for column, value in zip(out, row):
                    column.append(value)
                start, held = start + len(values), held + len(values)
                if held > 1 << 20:
                    yield _documents(out)
                    out, held = [[], [], [], [], []], 0
            yield _documents(out)

    def _documents(out: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        return pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "start", "n_values", "crc32", "values"])

    found = map_batches(numbered, read_file_rows, "doc_id long, start long, n_values long, crc32 long, values array<long>")
    return found if with_values else found.drop("values")


def op5_tokens(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """The digest, from the files: doc_id, start, n_tokens, ids_crc32."""
    folder = task_folder(docs.sparkSession, scratch_path(docs.sparkSession, "tokens"))
    files = write(docs, tokenizer, end_id, folder)
    return read(files, with_values=False).select(
        "doc_id", "start", F.col("n_values").alias("n_tokens"), F.col("crc32").alias("ids_crc32")
    )
