"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

Method
1. Documents become token ids with an end id. Those longer than a sequence are cut into whole sequences, the
   first piece being what is left over; whole sequences need no packing.
2. The other pieces are dealt to partitions of about ``PART_PIECES`` and packed there by best-fit decreasing.
3. Dual feasible functions give a lower bound of the bins that a partition's pieces need: pieces are
   re-weighted so that no bin of any packing weighs more than one. Equal to the bound, a packing is certified.
4. Partitions with a gap keep their full bins and put the pieces of the others into exchange; certified ones exchange
   only what lies in bins with much room. Exchanged pieces are dealt anew to fewer partitions and
   packed again, as long as that saves sequences: until their number is the bound of all pieces, or one partition holds
   everything in exchange, or a round saves none (then the bins of the round before stay). ``certificate`` reports the bound and
   the gap that is left.

A task holds one partition's pieces and nothing grows with the table: partitions have a bounded size, and the
driver sees a few sums per round. Pieces carry their columns through the rounds, so repeated rows stay apart.

Inputs out of the ordinary
- Null or empty text: one piece that holds the end id. An empty table gives no piece.
- Rows with the same id, or without one, are separate documents.
- Very long texts become many pieces of one row each. Equal rows are dealt by their place, so they spread over partitions.
- Columns other than id and text are not looked at; ``pack`` passes any further columns of its pieces through, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from priceflow.llm.text import bound_batches, map_batches
from priceflow.llm.tokens import encoder
from priceflow.session import hand_off, scratch_path

CAPACITY = 1024
PART_PIECES = 20_000
#: Room, as a share of a sequence, beyond which a bin of a certified partition is given up for another try.
MUCH_ROOM = 1 / 16


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and ids (little-endian unsigned 32-bit integers) if wanted."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    n_columns = len(names) if with_ids else len(names) - 1

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([end_id], "<u4").tobytes()
        out: list[list] = [[] for _ in names]
        for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)).of_each()):
            ids += end
            n = len(ids) // 4
            start, piece, until = 0, 0, n % capacity or min(n, capacity)
            while start < n:
                part = ids[4 * start : 4 * until]
                row = (doc_id, piece, start, until - start, zlib.crc32(part), part)
                for column, value in zip(out, row[:n_columns]):
                    column.append(value)
                start, piece, until = until, piece + 1, until + capacity
        yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds[:n_columns])], names[:n_columns])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_batches(rows, cut, schema + (", ids binary" if with_ids else ""))


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The most bins that dual feasible functions prove to be needed, from the number of pieces of each length."""
    counts, size = counts.astype(object), np.arange(capacity + 1)  # exact, of any size
    best = -(-int((counts * size).sum()) // capacity)
    # Pieces over capacity - t fill a bin, those under t count as nothing.
    sums = np.concatenate([[0], np.cumsum(counts * size)])
    numbers = np.concatenate([[0], np.cumsum(counts)])
    for t in range(1, capacity // 2 + 1):
        large = int(numbers[capacity + 1] - numbers[capacity - t + 1])
        middle = int(sums[capacity - t + 1] - sums[t])
        best = max(best, large + -(-middle // capacity))
    # Lengths rounded down to multiples of capacity / (k + 1), unless they are such a multiple.
    for k in range(1, 33):
        scaled = (k + 1) * size
        weight = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * weight).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each piece, and the room left in each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []
    open_rooms = 0  # bit r: some bin has room r
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = open_rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            room, chosen = capacity, len(rooms)
            rooms.append(capacity)
        bins[i], offsets[i] = chosen, capacity - room
        left = rooms[chosen] = room - length
        if left:
            by_room[left].append(chosen)
            open_rooms |= 1 << left
    return bins, offsets, np.array(rooms, np.int64)


_PLACED = (("sequence_id", "long"), ("offset", "long"), ("_kept", "boolean"), ("_bins", "long"), ("_kept_bins", "long"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """``pieces`` (a stored table with a column length, 1 to ``capacity``) with sequence_id and offset, which replace columns of these names."""
    spark = pieces.sparkSession
    bound_batches(spark)
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.select(F.col("length").cast("int").alias("length"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    out = StructType([*rows.schema.fields, StructField("n", LongType())])
    for name, kind in _PLACED:
        out = out.add(name, kind)

    def pack_part(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            held = list(batches)
            if not held:
                return
            table = pa.Table.from_batches(held)
            lengths = table.column("length").to_numpy().astype(np.int64)
            bins, offsets, rooms = best_fit(lengths, capacity)
            gap = len(rooms) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
            keep = rooms <= (0 if gap else MUCH_ROOM * capacity)
            first = (turn << 56) + (TaskContext.get().partitionId() << 32)
            once = np.arange(len(bins)) == 0
            added = (first + bins, offsets, keep[bins], np.where(once, len(rooms), 0), np.where(once, keep.sum(), 0))
            for (name, _), values in zip(_PLACED, added):
                table = table.append_column(name, pa.array(values))
            yield from table.to_batches(10_000)

        return run

    placed = [F.col("row." + f"`{c}`").alias(c) for c in names] + [F.col("sequence_id"), F.col("offset")]
    # Equal rows are dealt to different partitions by the place where they were read.
    numbered = rows.withColumn("n", F.monotonically_increasing_id())
    whole = numbered.where(F.col("length") == capacity)
    done = whole.withColumn("sequence_id", -1 - F.col("n")).withColumn("offset", F.lit(0).cast("long")).select(*placed)
    bound, finished = bound_of(pieces, capacity), whole.count()
    todo, open_bins, least, turn = numbered.where(F.col("length") < capacity), None, None, 0
    while n := todo.count():
        parts = -(-n // part_pieces)
        dealt = todo.repartition(parts, F.xxhash64("n", F.lit(turn))) if parts > 1 else todo.coalesce(1)
        packed = hand_off(dealt.mapInArrow(pack_part(turn), out), scratch_path(spark, "packed"))
        bins, kept = packed.agg(F.sum("_bins"), F.sum("_kept_bins")).first()
        if least is not None and finished + bins >= least:
            # Nothing gained: the bins of the round before stay as they are.
            return done.unionByName(open_bins.select(*placed))
        least = finished + bins
        if parts == 1 or least == bound:
            return done.unionByName(packed.select(*placed))
        done = done.unionByName(packed.where("_kept").select(*placed))
        finished, open_bins, turn = finished + kept, packed.where("NOT _kept"), turn + 1
        todo = open_bins.select("length", "row", "n")
    return done


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, bound (no packing of these pieces needs fewer), gap (sequences above the bound)."""
    bound = F.lit(bound_of(packed, capacity)).cast("long")
    used = packed.where("offset = 0").agg(F.count("*").alias("sequences"))  # every sequence has one first piece
    return used.select("sequences", bound.alias("bound"), (F.col("sequences") - bound).alias("gap"))


def bound_of(pieces: DataFrame, capacity: int = CAPACITY) -> int:
    """A lower bound of the sequences that all pieces need, from the counts of their lengths."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    return lower_bound(counts, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, doc_ids. ``packed`` has ids; a group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, part: F.concat(all_, part["ids"]))
    return grouped.select("sequence_id", joined.alias("ids"), F.transform("parts", lambda part: part["doc_id"]).alias("doc_ids"))


def op8_packing(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """The digest: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs.select("doc_id", "text"), tokenizer, end_id, capacity)
    return pack(hand_off(pieces, scratch_path(docs.sparkSession, "pieces")), capacity)
