from __future__ import annotations

import zlib

import numpy as np
import pytest

from priceflow.llm import simple8b

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("most", [1, 2, 40_000, 1 << 60, (1 << 64) - 1])
def test_blocks_round_trip(n, most):
    values = np.random.default_rng(n).integers(0, most, n, dtype=np.uint64)
    values[::3] = 0
    words, counts, raws = simple8b.encode_blocks(values)
    starts = np.cumsum(counts + raws) - counts - raws
    sizes = np.minimum(simple8b.BLOCK, n - simple8b.BLOCK * np.arange(len(counts)))
    assert (simple8b.decode_blocks(words, starts, starts + counts, sizes) == values).all()
    if len(counts) > 1:
        # Any block alone.
        one = words[starts[1] : starts[1] + counts[1] + raws[1]]
        alone = simple8b.decode_blocks(one, np.zeros(1, int), counts[1:2], sizes[1:2])
        assert (alone == values[1024 : 1024 + sizes[1]]).all()


def test_files_round_trip(tmp_path, monkeypatch):
    monkeypatch.setattr(simple8b, "CHUNK_BLOCKS", 2)
    rng = np.random.default_rng(3)
    docs = [(i - 2 if i else None, rng.integers(0, 50_000, size, dtype=np.uint64)) for i, size in enumerate([0, 1, 5000, 3, 2048, 0, 700])]
    writer = simple8b.Writer(str(tmp_path / "x" / "f.s8b"))
    for doc_id, values in docs:
        writer.add(doc_id, values)
    writer.close()
    read = list(simple8b.Reader(writer.path).documents())
    assert [i for i, _ in read] == [i for i, _ in docs]
    assert all((a == b).all() and len(a) == len(b) for (_, a), (_, b) in zip(read, docs))


def test_documents_come_back_in_order(docs_of):
    texts = [(7, "some words here"), (None, "no id"), (3, None), (5, "é " * 3000), (3, ""), (9, "an <|endoftext|> in the text")]
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = sorted(simple8b.op5_tokens(docs_of(*texts), path).collect(), key=lambda r: r.start)
    plain = tokenizers.Tokenizer.from_file(path)
    start, left = 0, {(i, zlib.crc32(np.array(plain.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())) for i, t in texts}
    for row in rows:
        assert row.start == start
        assert (row.doc_id, row.ids_crc32) in left
        start += row.n_tokens
    assert [r.doc_id for r in rows] == [None, 3, 3, 5, 7, 9]
    assert simple8b.op5_tokens(docs_of((1, "x")).where("false"), path).count() == 0


def test_folders_are_named_for_tasks(spark, tmp_path):
    from priceflow.llm import files

    assert files.task_folder(spark, f"{tmp_path}/a b") == files.task_folder(spark, f"file:{tmp_path}/a b") == f"{tmp_path}/a b"
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.tests.link./a", f"file:{tmp_path}")
    with pytest.raises(ValueError, match="viewfs://tests/a"):
        files.task_folder(spark, "viewfs://tests/a/b")
