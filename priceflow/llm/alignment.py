"""Alignment of the tokens of two tokenizers by merge-path partitioning.

Method
1. Texts are encoded by both tokenizers, with the text's byte range of each token. A batch's texts lie behind one another, so each
   tokenizer gives one rising list of ends.
2. The merge of the two lists is divided into pieces of ``PIECE`` ends, whatever the lengths of texts and tokens: binary searches along
   the diagonals of the merge find how many ends of each list lie before a piece's start. A piece is merged by itself: between
   neighbouring ends lies the overlap of one token of each side, and where both lists have the same end a group of tokens ends.
3. Equal ends that a border between pieces parts are stitched: the overlap counts once, and the group ends there. A group
   that spans pieces goes on until a piece closes it.
4. A pair of ids is counted in each document that links it: batches fold their documents, one group-by folds the batches. Only
   different pairs of a batch are shuffled; their counts come back to the batch by its number and meet its documents there.

A batch is bounded by bytes (one text may be longer), and so is what a task or a group of step 4 holds.

Inputs out of the ordinary
- Null or empty text, and texts whose tokens' bytes differ from the text with a space before it (one that holds U+2581, say): no
  tokens, all numbers 0, groups_sha256 empty. They count in no pair. An empty table gives no row.
- Rows with one id, or without, are documents of their own. Strings of special tokens are text like any other.
- Very long texts are encoded whole and merged in pieces. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from priceflow.llm.text import bound_batches
from priceflow.llm.tokens import encoder, piece_encoder
from priceflow.session import hand_off, scratch_path

PIECE = 1 << 16


# --- merge path ------------------------------------------------------------------------------------


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and of ``b`` lie before each piece's start, and at the end; equal ends of ``a`` come first."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (low < high).any():
        going = low < high
        middle = (low + high) // 2
        # Is the end in the middle of ``a`` among the first of the diagonal? Settled searches look anywhere.
        other = np.clip(diagonals - 1 - middle, 0, max(0, len(b) - 1))
        first = a[np.minimum(middle, len(a) - 1)] <= b[other]
        low, high = np.where(going & first, middle + 1, low), np.where(going & ~first, middle, high)
    return low, diagonals - low


def merge_piece(a: np.ndarray, b: np.ndarray, i: int, j: int, last_i: int, last_j: int) -> tuple[np.ndarray, ...]:
    """Overlaps (a token of each side) that end in a piece, and the tokens of each side up to the common ends in it."""
    mine, others = a[i:last_i], b[j:last_j]
    ends = np.union1d(mine, others)
    in_a, in_b = np.searchsorted(mine, ends), np.searchsorted(others, ends)
    common = np.isin(ends, mine, assume_unique=True) & np.isin(ends, others, assume_unique=True)
    return i + in_a, j + in_b, i + in_a[common] + 1, j + in_b[common] + 1


def align(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The overlaps, as a token of each side, and the groups, as the number of tokens of each side up to their ends.

    ``a`` and ``b`` are rising and have the same last end.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    starts_a, starts_b = merge_path(a, b, piece)
    borders = list(zip(starts_a.tolist(), starts_b.tolist()))
    for (i, j), (last_i, last_j) in zip(borders, borders[1:]):
        link_a, link_b, group_a, group_b = merge_piece(a, b, i, j, last_i, last_j)
        if i and j < last_j and a[i - 1] == b[j]:
            # The border parts equal ends: the piece before has the overlap, and here the group ends.
            link_a, link_b = link_a[1:], link_b[1:]
            group_a, group_b = np.append(i, group_a), np.append(j + 1, group_b)
        parts.append((link_a, link_b, group_a, group_b))
    empty = np.empty(0, np.int64)
    return tuple(np.concatenate([empty, *(p[k] for p in parts)]) for k in range(4))


# --- one batch -------------------------------------------------------------------------------------

_DIGITS = 10


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to n - 1, and how many each has."""
    texts = np.arange(n).astype(f"S{_DIGITS}")
    return texts.view(np.uint8).reshape(n, _DIGITS), np.char.str_len(texts).astype(np.int64)


class Side:
    """The tokens of one tokenizer in a batch: ids, ends (in the joined bytes) and the tokens before each text."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, kept: np.ndarray) -> None:
        counts = np.where(kept, np.diff(offsets), 0)
        self.ids = ids[np.repeat(kept, np.diff(offsets))].astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.ends = np.cumsum(lengths[self.ids])


class Batch:
    """The aligned tokens of some texts."""

    def __init__(self, texts: pa.Array, tokenizer: str, pieces: str, piece: int = PIECE) -> None:
        spaced = pc.binary_join_element_wise(pa.scalar(" "), texts.fill_null(""), pa.scalar(""))
        first, second = encoder(tokenizer, True), piece_encoder(pieces)
        found = first.encode(spaced), second.encode(spaced)
        filled = pc.greater(pc.binary_length(texts.fill_null("")), 0).to_numpy(zero_copy_only=False)
        kept = filled & found[0].exact & found[1].exact
        lengths = [np.array([len(x) for x in e.bytes_of], np.int64) for e in (first, second)]
        self.a, self.b = (Side(f.ids, f.offsets, n, kept) for f, n in zip(found, lengths))
        self.link_a, self.link_b, self.group_a, self.group_b = align(self.a.ends, self.b.ends, piece)
        self.groups_before = np.searchsorted(self.group_a, self.a.before, "right")
        self.links_before = np.searchsorted(self.link_a, self.a.before, "left")

    def group_texts(self) -> Iterator[bytes]:
        """For each text ``a1,a2|b1;a3|b2,b3``: the ids of its groups."""
        sizes_a, sizes_b = (np.diff(g, prepend=0) for g in (self.group_a, self.group_b))
        n_a, n_b = len(self.a.ids), len(self.b.ids)
        # In a group the ids of one side come before those of the other.
        at_a = np.arange(n_a) + np.repeat(self.group_b - sizes_b, sizes_a)
        at_b = np.arange(n_b) + np.repeat(self.group_a, sizes_b)
        ids, marks = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[at_a], ids[at_b] = self.a.ids, self.b.ids
        marks[at_a[self.group_a - 1]], marks[at_b[self.group_b - 1]] = ord("|"), ord(";")
        digits, lengths = _decimals(int(ids.max(initial=0)) + 1)
        n = lengths[ids]
        ends = np.cumsum(n + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        out[ends - 1] = marks
        starts = ends - 1 - n
        for k in range(int(n.max(initial=0))):
            here = np.flatnonzero(n > k)
            out[starts[here] + k] = digits[ids[here], k]
        bounds = np.concatenate([[0], ends])[self.a.before + self.b.before].tolist()
        data = out.tobytes()
        return (data[first : max(first, last - 1)] for first, last in zip(bounds, bounds[1:]))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The different pairs of ids (a * 2**32 + b) and in how many texts each is linked; then for each text, one
        behind the other: places of its pairs among them, how often it links each, and before each text how many."""
        codes, places = np.unique((self.a.ids[self.link_a] << 32) | self.b.ids[self.link_b], return_inverse=True)
        texts = np.repeat(np.arange(len(self.links_before) - 1), np.diff(self.links_before))
        own, often = np.unique(texts * max(1, len(codes)) + places, return_counts=True)
        of, place = np.divmod(own, max(1, len(codes)))
        return codes, np.bincount(place, minlength=len(codes)), place, often, np.searchsorted(of, np.arange(len(self.links_before)))


_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, often binary"
_ROWS = f"batch long, {_DOCUMENT}, place int, pair long, documents long"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _rows(values: dict[str, list | np.ndarray], n: int) -> pa.RecordBatch:
    """Rows with nulls in the columns that are not given."""
    fields = [field.split() for field in _ROWS.split(", ")]
    arrays = [pa.array(values[name], _KINDS[kind]) if name in values else pa.nulls(n, _KINDS[kind]) for name, kind in fields]
    return pa.record_batch(arrays, [name for name, _ in fields])


def aligned(docs: DataFrame, tokenizer: str, pieces: str) -> DataFrame:
    """A stored table of two kinds of rows, both with batch: documents with their links, and the batches' pairs (place not null).

    ``places`` are the numbers of a document's pairs in its batch (32 bits each), ``often`` how often it links each.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches):
            n = batch.num_rows
            if not n:
                continue
            found = Batch(batch.column(1), tokenizer, pieces)
            codes, documents, place, often, before = found.pairs()
            counts = {"n_a": found.a.before, "n_b": found.b.before, "n_groups": found.groups_before, "n_links": found.links_before}
            values = {name: np.diff(of_each) for name, of_each in counts.items()}
            values["groups_sha256"] = [hashlib.sha256(t).hexdigest() if t else "" for t in found.group_texts()]
            bounds = (4 * before).tolist()
            for name, numbers in (("places", place), ("often", often)):
                data = numbers.astype("<i4").tobytes()
                values[name] = [data[a:b] for a, b in zip(bounds, bounds[1:])]
            yield _rows(values | {"batch": np.full(n, first + number), "doc_id": batch.column(0)}, n)
            for at in range(0, len(codes), 10_000):
                part = slice(at, at + 10_000)
                size = len(codes[part])
                given = {"batch": np.full(size, first + number), "place": np.arange(at, at + size), "pair": codes[part], "documents": documents[part]}
                yield _rows(given, size)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return hand_off(rows.mapInArrow(run, _ROWS), scratch_path(docs.sparkSession, "aligned"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """Of each linked pair: pair, a, b, documents (that link it), best (no pair of the same ``a`` has more), as a stored table."""
    spark = rows.sparkSession
    counts = rows.where("place IS NOT NULL").groupBy("pair").agg(F.sum("documents").alias("documents"))
    counts = counts.select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "documents")
    counts = hand_off(counts, scratch_path(spark, "pair-counts"))
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))  # a row for each id of a vocabulary
    best = counts.join(most, "a").select(*counts.columns, (F.col("documents") == F.col("most")).alias("best"))
    return hand_off(best, scratch_path(spark, "pair-best"))


_SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _score(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over the links of the documents of one batch."""
    size = int(pc.max(pairs.column("place")).as_py()) + 1 if pairs.num_rows else 0
    counts, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    places = pairs.column("place").to_numpy()
    counts[places], best[places] = pairs.column("total").to_numpy(), pairs.column("best").to_numpy()
    n_best, sums = [], []
    for held, often in zip(documents.column("places").to_pylist(), documents.column("often").to_pylist()):
        at, times = np.frombuffer(held, "<i4"), np.frombuffer(often, "<i4").astype(np.int64)
        n_best.append(int((best[at] * times).sum()))
        sums.append(int((counts[at] * times).sum()))
    given = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
    names = [field.split()[0] for field in _SCORED.split(", ")]
    return pa.table([given[name] if name in given else documents.column(name) for name in names], names)


def alignment(docs: DataFrame, tokenizer: str, pieces: str) -> tuple[DataFrame, DataFrame]:
    """The documents' numbers (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and the table of pairs."""
    rows = aligned(docs, tokenizer, pieces)
    counts = pair_counts(rows)
    total = counts.select("pair", F.col("documents").alias("total"), F.col("best").cast("long").alias("best"))
    back = rows.where("place IS NOT NULL").select("batch", "place", "pair").join(total, "pair").select(F.col("batch").alias("of"), "place", "total", "best")
    documents = rows.where("place IS NULL").select("batch", *[field.split()[0] for field in _DOCUMENT.split(", ")])
    scored = documents.groupBy("batch").cogroup(back.groupBy("of")).applyInArrow(_score, _SCORED)
    return scored, counts


def op12_alignment(docs: DataFrame, tokenizer: str, pieces: str) -> DataFrame:
    """The digest: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return alignment(docs, tokenizer, pieces)[0]
