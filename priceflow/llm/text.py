"""Words and word shingles of whole texts as 64-bit hashes, vectorised over the rows of an Arrow batch.

Words are runs of anything but ASCII white space; A-Z count as a-z. Work arrays are bounded by
``CHUNK`` bytes of text at a time (a longer text is cut at white space, so no word is split), whatever
the size of a batch or of one text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHUNK = 1 << 20
WHITE = b" \t\n\x0b\x0c\r"

_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True
_BASE = 0x9E3779B97F4A7C15 | 5
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_WEIGHTS = np.random.default_rng(20240229).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LETTER[65:91] = _LETTER[97:123]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_tables: list[np.ndarray] = []


def _tables_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        _tables.extend((_powers(_BASE, CHUNK + 1), _powers(_BASE_INVERSE, CHUNK + 1)))
    if n <= CHUNK:
        return _tables[0], _tables[1]
    return _powers(_BASE, n + 1), _powers(_BASE_INVERSE, n + 1)


def _hash_words(data: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word in ``data``; a word ends where a row starts."""
    solid = ~_IS_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[row_starts] = True
    before = np.empty(len(data), bool)
    before[:1] = True
    before[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = True
    after[:-1] = ~solid[1:]
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    powers, inverses = _tables_for(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * powers[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64)
    return starts, ends, mix(hashes)


def _cuts(data: np.ndarray) -> list[int]:
    """Where to cut one long text: at white space, about every ``CHUNK`` bytes."""
    cuts = [0]
    while len(data) - cuts[-1] > CHUNK:
        at = cuts[-1] + CHUNK
        while at < len(data):
            block = np.flatnonzero(_IS_WHITE[data[at : at + CHUNK]])
            if len(block):
                at += int(block[0])
                break
            at += CHUNK
        if at >= len(data):
            break
        cuts.append(at)
    return [*cuts, len(data)]


def word_runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows: the first row, the words before each row, and each word's hash, start and end.

    A row is a text; null counts as empty. Row ``first + i`` has the words ``before[i]:before[i + 1]``;
    starts and ends are byte positions within the row's text.
    """
    texts = texts.fill_null("").cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        last = min(last, len(texts))
        run, base = data[offsets[first] : offsets[last]], offsets[first]
        if last == first + 1 and len(run) > CHUNK:
            cuts = _cuts(run)
            parts = [_hash_words(run[a:b], np.zeros(1, np.int64)) for a, b in zip(cuts, cuts[1:])]
            starts = np.concatenate([p[0] + a for p, a in zip(parts, cuts)])
            ends = np.concatenate([p[1] + a for p, a in zip(parts, cuts)])
            hashes = np.concatenate([p[2] for p in parts])
        else:
            starts, ends, hashes = _hash_words(run, offsets[first:last] - base)
        before = np.searchsorted(starts, offsets[first : last + 1] - base)
        shift = np.repeat(offsets[first:last] - base, np.diff(before))
        yield first, before, hashes, starts - shift, ends - shift
        first = last


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each position on."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out += words[i : i + n] * _WEIGHTS[i]
    return mix(out)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of a text, ascending; a shorter text is one shingle, an empty one has none."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(words, min(size, len(words))))


#: Bounds of an Arrow batch that a Python worker and its executor hold, besides one row.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limits of an Arrow batch to ``BATCH``, for rows of thousands of characters."""
    for key, most in BATCH.items():
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` for a function of one batch, with batches of bounded size."""

    def run(batches):
        for batch in batches:
            yield from function(batch)

    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)
