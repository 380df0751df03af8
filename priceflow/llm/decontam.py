"""Benchmark decontamination: documents that hold a benchmark item, up to a share of edited words.

Method
1. Texts and items are sequences of words (ASCII white space between them, A-Z as a-z). An item of L words
   is found where some run of a document's words is within ``edits * L`` word edits of it.
2. Item-sized windows of a document are embedded by a random walk (CGK): the walk reads the word
   under its cursor, writes it, and moves on or stays by a random function of word and step. Two
   sequences at a small edit distance give outputs at a small Hamming distance.
3. Bit-sampling LSH on the outputs: a few written words at sampled steps make a key, with ``samples`` keys per
   walk. Windows that have a key in common with an item are candidates. The number of walks is raised until
   edited copies of the items, with as many edits as allowed, are found with the target recall. Each
   band of item lengths has a number of its own, since longer items need more walks.
4. Candidates are verified by the exact edit distance of the item to the best run of words there.

By the pigeonhole principle an item with at most k edits keeps one of k + 1 parts whole, so a window can
only match near such a part. Only windows there are embedded; this loses nothing and leaves few windows.

Items of fewer than ``WALK_WORDS`` or at least ``DIRECT_WORDS`` words, and bands that ``MOST_WALKS`` walks are too few for, are not embedded. An
item of L words keeps at least L + 1 - (k + 1) q of its runs of q words, on diagonals at most k apart; places with
as many are verified directly, so none of these items is missed.

The items are the query set: they are taken in blocks of at most ``BLOCK_WORDS`` words, each of which is
sent to the executors; all documents run against every block, in one pass and without a shuffle.
Memory is bounded by an Arrow batch, one text, and a block of items.

Inputs out of the ordinary
- Null, empty or blank text: holds no item. An item without words, or null, is in no document.
- Short items: one of fewer than 5 words must stand whole. A common word as an item is in most documents; ``min_words``
  leaves such items out, by default none.
- Repeated items are all reported, an item without id as null. An empty benchmark leaves all documents.
- Repeated rows and ids: each row is judged by its own text. Other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from priceflow.llm.text import map_batches, mix, shingle_hashes, word_runs

EDITS = 0.2
#: Shorter items hold 0 or 1 edits and are verified directly.
WALK_WORDS = 8
BLOCK_WORDS = 1_000_000
RECALL = 0.98
SAMPLED_STEPS = 3
SAMPLES = 6
MOST_WALKS = 48
#: Edited copies that a band's number of walks is fitted on; a bound, not a share of the data.
FIT_COPIES = 600
#: From as many words on, verifying directly takes less time than walks, and loses nothing.
DIRECT_WORDS = 128
WINDOWS_AT_ONCE = 4096
HITS = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:bigint>>"


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as rows of a matrix, zero behind their end, and their lengths."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    out = np.zeros((len(sequences), int(lengths.max(initial=0)) + 1), np.uint64)
    for row, sequence in zip(out, sequences):
        row[: len(sequence)] = sequence
    return out, lengths


@dataclass
class Embedding:
    """Random walks and the steps sampled from each, the same for items and windows."""

    walks: int
    seed: int = 7
    fractions: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        self.fractions = rng.random((MOST_WALKS, SAMPLES, SAMPLED_STEPS))

    def keys(self, windows: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """LSH keys of windows for items of ``sizes`` words: one row per window, walks * samples columns.

        ``windows`` has a column more than the longest window; ``lengths`` are the windows' own lengths.
        """
        n, rows = len(windows), np.arange(len(windows))
        steps = 2 * int(sizes.max(initial=1))
        out = np.empty((n, self.walks * SAMPLES), np.uint64)
        for walk in range(self.walks):
            cursor = np.zeros(n, np.int64)
            written = np.empty((n, steps), np.uint64)
            for step in range(steps):
                word = windows[rows, cursor]
                written[:, step] = word
                salt = np.uint64((self.seed * 1_000_003 + walk * 10_007 + step) * 0x9E3779B97F4A7C15 % (1 << 64))
                move = ((word ^ salt) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63)
                cursor = np.minimum(cursor + move.astype(np.int64), lengths)
            for sample in range(SAMPLES):
                at = (self.fractions[walk, sample][None, :] * (2 * sizes)[:, None]).astype(np.int64)
                key = sizes.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(walk * SAMPLES + sample + 1)
                for j in range(SAMPLED_STEPS):
                    key = mix(key ^ written[rows, at[:, j]])
                out[:, walk * SAMPLES + sample] = key
        return out


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """``words`` after random substitutions, insertions and deletions."""
    out = list(words)
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(out) + 1))
        fresh = rng.integers(1, 1 << 63, dtype=np.uint64)
        if kind == 0 or at == len(out):
            out.insert(at, fresh)
        elif kind == 1:
            out[at] = fresh
        elif len(out) > 1:
            del out[at]
    return np.array(out, np.uint64)


@dataclass
class Items:
    """A block of items, ready for the executors."""

    ids: list[int | None]
    words: list[np.ndarray]
    most_edits: np.ndarray
    #: Of each item; 0 for those that are verified directly.
    walks: np.ndarray
    key_values: np.ndarray
    key_items: np.ndarray
    parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    seen: dict[int, np.ndarray]


def part_size(size: int, most_edits: int) -> int:
    """Words of a part of an item of ``size`` words, one of which stays whole."""
    return max(1, size // (most_edits + 1))


def prepared(ids: list[int | None], words: list[np.ndarray], edits: float = EDITS, recall: float = RECALL) -> Items:
    """Parts, embedding and keys of the items, with as many walks as the target recall needs."""
    sizes = np.array([len(w) for w in words], np.int64)
    most = (sizes * edits + 1e-9).astype(np.int64)
    walks = _fitted(words, sizes, most, recall)
    found_values, found_items = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for n in np.unique(walks[walks > 0]).tolist():
        chosen = np.flatnonzero(walks == n)
        matrix, lengths = _padded([words[i] for i in chosen])
        keys = Embedding(n).keys(matrix, lengths, sizes[chosen])
        found_values.append(keys.ravel())
        found_items.append(np.repeat(chosen, keys.shape[1]))
    values, items = np.concatenate(found_values), np.concatenate(found_items)
    order = np.argsort(values, kind="stable")
    grams: dict[int, list[tuple[np.ndarray, int]]] = {}
    for i, sequence in enumerate(words):
        size = part_size(len(sequence), int(most[i]))
        grams.setdefault(size, []).append((shingle_hashes(sequence, size), i))
    parts, seen = {}, {}
    for size, found in grams.items():
        hashes = np.concatenate([h for h, _ in found])
        owners = np.concatenate([np.full(len(h), i) for h, i in found])
        places = np.concatenate([np.arange(len(h)) for h, _ in found])
        by_hash = np.argsort(hashes, kind="stable")
        parts[size] = (hashes[by_hash], owners[by_hash], places[by_hash])
        table = np.zeros(1 << 22, bool)
        table[(hashes >> np.uint64(42)).astype(np.int64)] = True
        seen[size] = np.packbits(table)
    return Items(ids, words, most, walks, values[order], items[order], parts, seen)


def _fitted(words: list[np.ndarray], sizes: np.ndarray, most: np.ndarray, recall: float) -> np.ndarray:
    """Of each item, the fewest walks that find the target share of copies of its length band; 0 where none do."""
    walks = np.zeros(len(words), np.int64)
    bands = np.floor(2 * np.log2(np.maximum(sizes, 1))).astype(np.int64)
    walked = (sizes >= WALK_WORDS) & (sizes < DIRECT_WORDS)
    for band in np.unique(bands[walked]).tolist():
        members = np.flatnonzero((bands == band) & walked)
        walks[members] = _walks_of([words[i] for i in members], sizes[members], most[members], recall)
    return walks


def _walks_of(words: list[np.ndarray], sizes: np.ndarray, most: np.ndarray, recall: float) -> int:
    """The fewest walks whose keys find the target share of copies with as many edits as allowed, or 0."""
    rng = np.random.default_rng(11)
    chosen = rng.integers(len(words), size=min(FIT_COPIES, 20 * len(words)))
    copies = [edited(words[i], int(most[i]), rng)[: sizes[i]] for i in chosen]
    full = Embedding(MOST_WALKS)
    items, lengths = _padded([words[i] for i in chosen])
    ours = full.keys(items, lengths, sizes[chosen])
    matrix, lengths = _padded(copies)
    width = max(matrix.shape[1], int(sizes[chosen].max()) + 1)
    matrix = np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))
    equal = (full.keys(matrix, lengths, sizes[chosen]) == ours).reshape(len(chosen), MOST_WALKS, SAMPLES).any(axis=2)
    reached = np.maximum.accumulate(equal, axis=1).mean(axis=0) >= recall
    return int(np.argmax(reached)) + 1 if reached.any() else 0


def part_hits(words: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``words`` where a part of an item stands, and the start of the item there: item, start."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for size, (hashes, owners, places) in items.parts.items():
        here = shingle_hashes(words, size)
        slot = (here >> np.uint64(42)).astype(np.int64)
        maybe = np.flatnonzero(items.seen[size][slot >> 3] & (128 >> (slot & 7)).astype(np.uint8))
        low, high = (np.searchsorted(hashes, here[maybe], side) for side in ("left", "right"))
        counts = high - low
        at = np.repeat(maybe, counts)
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        found.append((owners[entry], at - places[entry]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def best_run(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least number of edits between ``item`` and a run of ``text``, and the end of such a run."""
    index = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - index) + index
    end = int(np.argmin(row))
    return int(row[end]), end


def direct_regions(owners: np.ndarray, starts: np.ndarray, items: Items) -> Iterator[tuple[int, int, int]]:
    """Where items without walks may stand: item, and start and end of the words to verify, in order."""
    order = np.lexsort((starts, owners))
    owners, starts = owners[order], starts[order]
    edges = np.flatnonzero(np.diff(owners, prepend=-1, append=-1))
    for begin, end in zip(edges, edges[1:]):
        item, at = int(owners[begin]), starts[begin:end]
        size, k = len(items.words[item]), int(items.most_edits[item])
        # As many parts stay whole at least, on diagonals that are at most k apart.
        least = max(1, size + 1 - (k + 1) * part_size(size, k))
        first = np.flatnonzero(at[least - 1 :] - at[: max(0, len(at) - least + 1)] <= k)
        low, high = np.maximum(0, at[first] - k), at[first + least - 1] + size + 2 * k
        apart = np.flatnonzero(low[1:] >= np.maximum.accumulate(high)[:-1]) + 1
        for part in np.split(np.arange(len(first)), apart) if len(first) else ():
            yield item, int(low[part[0]]), int(high[part].max())


def matches(words: np.ndarray, items: Items) -> dict[int, tuple[int, int, int]]:
    """The items that a text holds: item, and start and end (in words) and the edits of its best run."""
    owners, starts = part_hits(words, items)
    if not len(owners):
        return {}
    sizes, most = np.array([len(w) for w in items.words]), items.most_edits
    direct = items.walks[owners] == 0
    regions = list(direct_regions(owners[direct], starts[direct], items))
    windows: set[tuple[int, int, int]] = set()
    for owner, start in set(zip(owners[~direct].tolist(), starts[~direct].tolist())):
        for shift in range(-int(most[owner]), int(most[owner]) + 1):
            if -most[owner] <= start + shift < len(words):
                windows.add((int(items.walks[owner]), max(0, start + shift), int(sizes[owner])))
    candidates: set[tuple[int, int]] = set()
    for walks in sorted({w for w, _, _ in windows}):
        chosen = sorted((s, n) for w, s, n in windows if w == walks)
        for first in range(0, len(chosen), WINDOWS_AT_ONCE):
            some = chosen[first : first + WINDOWS_AT_ONCE]
            matrix, lengths = _padded([words[s : s + n] for s, n in some])
            wanted = np.array([n for _, n in some], np.int64)
            matrix = np.pad(matrix, ((0, 0), (0, max(0, int(wanted.max()) + 1 - matrix.shape[1]))))
            keys = Embedding(walks).keys(matrix, lengths, wanted)
            low, high = (np.searchsorted(items.key_values, keys, side) for side in ("left", "right"))
            for row, column in zip(*np.nonzero(high > low)):
                for item in items.key_items[low[row, column] : high[row, column]]:
                    candidates.add((int(item), some[row][0]))
    for item, start in sorted(candidates):
        k = int(most[item])
        regions.append((item, max(0, start - 2 * k), start + int(sizes[item]) + 2 * k))
    found: dict[int, tuple[int, int, int]] = {}
    for item, low, high in regions:
        if item in found and found[item][2] == 0:
            continue
        region = words[low:high]
        edits, end = best_run(items.words[item], region)
        if edits <= most[item] and (item not in found or edits < found[item][2]):
            reverse, length = best_run(items.words[item][::-1], region[:end][::-1])
            found[item] = (low + end - length, low + end, edits)
    return found


def item_blocks(items: DataFrame, edits: float, min_words: int, block_words: int) -> Iterator[Items]:
    """The items with at least ``min_words`` words, in blocks that the executors can hold."""
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // (6 * block_words))
    for block in range(blocks):
        ids: list[int | None] = []
        words: list[np.ndarray] = []
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        for _, before, hashes, _, _ in word_runs(pa.array([r.text for r in rows], pa.string())):
            words += [hashes[a:b] for a, b in zip(before, before[1:])]
        ids = [r.item_id for r in rows]
        chosen = [i for i, w in enumerate(words) if len(w) >= max(1, min_words)]
        if chosen:
            yield prepared([ids[i] for i in chosen], [words[i] for i in chosen], edits)


def with_hits(
    docs: DataFrame, items: DataFrame, edits: float = EDITS, min_words: int = 1, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` with ``_hits``: the items that the text holds, with start and end in words, and edits."""
    names = list(docs.columns)
    place = names.index("text")
    hit_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "edits")]))
    found = docs.withColumn("_hits", F.array().cast(HITS))
    out = found.schema
    for block in item_blocks(items, edits, min_words, block_words):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def search(batch: pa.RecordBatch, sent=sent) -> Iterator[pa.RecordBatch]:
            hits = batch.column(batch.num_columns - 1).to_pylist()
            known = sent.value
            for first, before, words, _, _ in word_runs(batch.column(place)):
                # Most runs of rows hold no part of any item; the rows of the others are looked at one by one.
                at = np.flatnonzero(_part_places(words, known))
                for row in np.unique(np.searchsorted(before, at, "right") - 1):
                    for item, (start, end, n) in matches(words[before[row] : before[row + 1]], known).items():
                        hits[first + row].append({"item_id": known.ids[item], "start": start, "end": end, "edits": n})
            yield pa.record_batch([*batch.columns[:-1], pa.array(hits, hit_type)], [*names, "_hits"])

        found = map_batches(found, search, out)
    return found


def _part_places(words: np.ndarray, items: Items) -> np.ndarray:
    """Where a part of some item may start, by a table of hash prefixes."""
    out = np.zeros(len(words), bool)
    for size in items.parts:
        slot = (shingle_hashes(words, size) >> np.uint64(42)).astype(np.int64)
        out[: len(slot)] |= (items.seen[size][slot >> 3] & (128 >> (slot & 7)).astype(np.uint8)) > 0
    return out


def op7_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest: doc_id, n_items, item_ids (ascending), kept."""
    found = with_hits(docs.select("doc_id", "text"), items)
    ids = F.sort_array(F.transform("_hits", lambda hit: hit["item_id"]))
    return found.select("doc_id", F.size("_hits").cast("long").alias("n_items"), ids.alias("item_ids"), (F.size("_hits") == 0).alias("kept"))


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    # The other columns travel as one, so their names can't meet those used here.
    others = [c for c in docs.columns if c != "text"]
    found = with_hits(docs.select("text", F.struct(*others).alias("row")), items).where(F.size("_hits") == 0)
    return found.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
