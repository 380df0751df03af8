from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib

import pytest

from priceflow.llm import warc


def archive(n):
    payloads = [b"", b"<p>\r\n\r\nWARC/1.1\r\n</p>", bytes(range(256)) * 3000, "é\n".encode() * 50]
    return [warc.record(i, f"http://x/{i}?a b", payloads[i % 4], warc.digest(payloads[i % 4]), 99 if i == 5 else None) for i in range(n)]


@pytest.mark.parametrize("members", [1, 3])
def test_normaliser_rewrites_each_record(members):
    parts = archive(9)
    step = -(-len(parts) // members)
    whole = b"".join(gzip.compress(b"".join(parts[i : i + step])) for i in range(0, len(parts), step))
    out = io.BytesIO()
    index = warc.normalise(io.BytesIO(whole), out)
    data = out.getvalue()
    assert [zlib.decompress(data[a : a + n], 31) for _, a, n in index] == parts
    assert gzip.decompress(data) == b"".join(parts)
    assert sum(n for _, _, n in index) == len(data)
    assert [name for name, _, _ in index] == [f"<urn:page:{i}>" for i in range(9)]


def test_broken_archives_are_refused():
    data = gzip.compress(b"".join(archive(3)))
    with pytest.raises(ValueError):
        warc.normalise(io.BytesIO(data[:-20]), io.BytesIO())
    with pytest.raises(ValueError):
        warc.normalise(io.BytesIO(gzip.compress(archive(1)[0][:-30])), io.BytesIO())


def test_pages_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 200)
    pages = [(1, "http://a/", "same"), (2, None, None), (3, "u\n", "same"), (4, "u", ""), (5, "u", "é" * 300), (None, "u", "same"), (None, "u", "lonely"), (3, "v", "same")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS refers_to", "2 AS path")
    got = sorted(map(tuple, warc.op6_archives(frame).collect()), key=str)

    def expected(page_id, html):
        data = (html or "").encode()
        last = max((i for i, _, h in pages if (h or "") == (html or "") and i is not None), default=None)
        repeats = last is not None and page_id != last
        name = base64.b32encode(hashlib.sha1(data).digest()).decode()
        return page_id, len(data), name, "revisit" if repeats else "response", last if repeats else None

    assert got == sorted((expected(i, h) for i, _, h in pages), key=str)
    assert warc.op6_archives(frame.where("false")).count() == 0
