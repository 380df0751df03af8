from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from priceflow.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(lengths, capacity):
    """The fewest bins, by trying all ways to fill the bin of the first piece."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    for n in range(len(rest) + 1):
        for some in combinations(range(len(rest)), n):
            if first + sum(rest[i] for i in some) <= capacity:
                best = min(best, 1 + fewest([x for i, x in enumerate(rest) if i not in some], capacity))
    return best


def test_bounds_and_bins():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = rng.integers(1, 21, int(rng.integers(1, 8)))
        bound = packing.lower_bound(np.bincount(lengths, minlength=21), 20)
        bins, offsets, rooms = packing.best_fit(lengths, 20)
        assert bound <= fewest(sorted(lengths.tolist(), reverse=True), 20) <= len(rooms)
        for b in range(len(rooms)):
            held = sorted(zip(offsets[bins == b], lengths[bins == b]))
            assert [int(o) for o, _ in held] == [sum(int(n) for _, n in held[:i]) for i in range(len(held))]
            assert sum(n for _, n in held) == 20 - rooms[b]
    assert packing.lower_bound(np.bincount([11] * 5 + [7] * 5, minlength=21), 20) == 5
    assert packing.lower_bound(np.zeros(21, int), 20) == 0


@pytest.mark.parametrize("part_pieces", [20, 20_000])
def test_documents_are_packed_whole(docs_of, part_pieces):
    rng = np.random.default_rng(2)
    texts = [" ".join(["word"] * int(n)) for n in rng.integers(0, 60, 150)]
    pairs = [*enumerate(texts), (7, texts[7]), (None, "no id"), (200, None), (201, "many words " * 400)]
    plain = tokenizers.Tokenizer.from_file(PATH)
    pieces = packing.token_pieces(docs_of(*pairs), PATH, capacity=64, with_ids=True).cache()
    packed = packing.pack(pieces, 64, part_pieces)
    rows = packed.collect()
    assert sorted(map(tuple, packed.select(*pieces.columns).collect()), key=str) == sorted(map(tuple, pieces.collect()), key=str)
    by_sequence, by_id = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_id[r.doc_id].append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    long = sorted(by_id[201], key=lambda r: r.piece)
    ids = plain.encode("many words " * 400, add_special_tokens=False).ids + [2]
    assert b"".join(r.ids for r in long) == np.array(ids, "<u4").tobytes()
    assert [r.length for r in long[1:]] == [64] * (len(long) - 1)
    assert [r.start for r in long] == [sum(x.length for x in long[:i]) for i in range(len(long))]
    bound = packing.bound_of(pieces, 64)
    assert bound <= len(by_sequence) <= 1.05 * bound + 2
    sequences = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert all(len(sequences[s]) == 4 * sum(n for _, n in held) for s, held in by_sequence.items())


def test_equal_rows_are_spread_and_the_gap_is_reported(spark):
    rows = spark.range(0, 30_000, 1, 3).selectExpr("cast(null AS long) AS doc_id", "37 AS length", "'x' AS sequence_id", "1 AS n", "2 AS row", "3 AS _kept")
    spread: list[int] = []
    dealt = packing.F.xxhash64(packing.F.monotonically_increasing_id(), packing.F.lit(0))
    spread = [r["count"] for r in rows.repartition(6, dealt).groupBy(packing.F.spark_partition_id()).count().collect()]
    assert len(spread) == 6 and max(spread) < 6000
    packed = packing.pack(rows, 64, 5000)
    assert packed.columns == ["doc_id", "length", "n", "row", "_kept", "sequence_id", "offset"]
    assert packing.certificate(packed, 64).collect() == [(30_000, 30_000, 0)]
    halves = spark.range(1001).selectExpr("id AS doc_id", "32 AS length")
    assert packing.certificate(packing.pack(halves, 64, 100), 64).collect() == [(501, 501, 0)]


def test_empty_table(docs_of):
    assert packing.op8_packing(docs_of((1, "x")).where("false"), PATH).count() == 0
