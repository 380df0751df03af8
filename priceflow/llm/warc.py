"""WARC archives: pages to archives, a normaliser for monolithic gzip files, and reading by index.

``write_monolithic`` writes archives the way careless tools do, all records in one gzip stream, which can
only be read from its start. ``normalise`` inflates such a file once, from end to end, rewrites each record
as a gzip member of its own, and writes an offset index beside it: any record can then be read alone.
Both hold one record at a time, whatever the size of a file; inflating goes on in steps of ``STEP`` bytes.

Pages with equal payloads are stored once: the one with the largest page_id is a response, the others
are revisits that name it. Only digests and ids are shuffled to find them, pre-aggregated by digest.

Inputs out of the ordinary
- Null html: an empty payload, which counts as a payload like others (``min_bytes`` 0).
- Null url: the record has no target URI. A url with line breaks is written percent-encoded.
- Repeated rows of the largest page_id are all responses. A null page_id is smaller than all others; rows
  without id whose payload no page with an id has are all responses.
- Columns other than page_id, url and html are not looked at. An empty table gives no file.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from priceflow.llm.files import new_file, read_file, task_folder, write_file
from priceflow.llm.text import bound_batches, map_batches
from priceflow.session import hand_off, scratch_path

STEP = 1 << 18
FILE_BYTES = 64 << 20
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """One WARC record: the whole response, or a revisit with the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=%~-._")))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The page that a record stands for; the digest of a response is that of its bytes."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    own = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
    other = fields.get("WARC-Refers-To", "").removeprefix("<urn:page:").removesuffix(">")
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": None if own == "none" else int(own),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(stated["Content-Length"]) if revisit else len(payload),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else digest(payload),
        "record_type": fields["WARC-Type"],
        "refers_to": int(other) if other else None,
        "payload": None if revisit else payload,
    }


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in steps."""
    inflater = None
    while data := source.read(STEP):
        while data:
            inflater = inflater or zlib.decompressobj(31)
            while data and not inflater.eof:
                yield inflater.decompress(data, STEP)
                data = inflater.unconsumed_tail
            if inflater.eof:
                data, inflater = inflater.unused_data, None
    while inflater is not None:  # what a step's limit has held back
        part = inflater.decompress(b"", STEP)
        if inflater.eof:
            inflater = None
        elif not part:
            raise ValueError("the gzip stream ends early")
        yield part


def records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated archive, one at a time."""
    held, wanted, end = bytearray(), 0, -1
    for part in stream:
        held += part
        while True:
            if end < 0:
                at = held.find(b"\r\n\r\n", max(0, wanted))
                if at < 0:
                    wanted = len(held) - 3
                    break
                head = bytes(held[:at]).decode()
                length = next(line for line in head.split("\r\n") if line.lower().startswith("content-length:"))
                end = at + 4 + int(length.split(":", 1)[1]) + 4
            if len(held) < end:
                break
            yield bytes(held[:end])
            del held[:end]
            wanted, end = 0, -1
    if held.strip():
        raise ValueError("the archive ends within a record")


def normalise(source: BinaryIO, out: BinaryIO, level: int = LEVEL) -> list[tuple[str, int, int]]:
    """Rewrite a monolithic archive, each record its own member; record id, offset and length of each."""
    index, at = [], 0
    for data in records(inflated(source)):
        deflater = zlib.compressobj(level, wbits=31)
        member = deflater.compress(data) + deflater.flush()
        out.write(member)
        name = data[: data.find(b"\r\n\r\n")].split(b"WARC-Record-ID: ", 1)[1].split(b"\r\n", 1)[0].decode()
        index.append((name, at, len(member)))
        at += len(member)
    return index


def with_origin(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, payload_digest (20 bytes) and refers_to: which page's payload each page repeats."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    rows = rows.withColumn("payload_digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    large = rows.where(F.octet_length("html") >= min_bytes)
    last = large.groupBy("payload_digest").agg(F.max("page_id").alias("last_id"), F.count("*").alias("n")).where("n > 1")
    found = rows.join(last, "payload_digest", "left")
    repeats = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return found.select("page_id", "url", "html", "payload_digest", F.when(repeats, F.col("last_id")).alias("refers_to"))


def write_monolithic(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = LEVEL) -> DataFrame:
    """Write the records of ``with_origin`` rows to archives of one gzip stream each; the list of files: path, n_records."""
    bound_batches(pages.sparkSession)

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, int]] = []
        out = deflater = path = None
        written = n = 0
        for batch in batches:
            for page_id, url, html, key, refers_to in zip(*(c for c in batch.columns)):
                if out is None:
                    path, written, n = new_file(folder, ".warc.gz"), 0, 0
                    out, deflater = write_file(path), zlib.compressobj(level, wbits=31)
                payload = html.as_py().encode()
                name = base64.b32encode(key.as_py()).decode()
                data = record(page_id.as_py(), url.as_py(), payload, name, refers_to.as_py())
                out.write(deflater.compress(data))
                written, n = written + len(data), n + 1
                if written >= file_bytes:
                    out.write(deflater.flush())
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.write(deflater.flush())
            out.close()
            done.append((path, n))
        paths, counts = zip(*done) if done else ((), ())
        yield pa.record_batch([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["path", "n_records"])

    listed = pages.select("page_id", "url", "html", "payload_digest", "refers_to").mapInArrow(write_part, "path string, n_records long")
    return hand_off(listed, scratch_path(pages.sparkSession, "archives"))


INDEX = "path string, record_id string, offset long, length long"


def normalise_all(files: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Normalise each listed file into ``folder`` with its sidecar; the index of all: path, record_id, offset, length."""

    def rewrite(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for source in batch.column(0).to_pylist():
            path = new_file(folder, ".warc.gz")
            with read_file(source) as inside, write_file(path) as outside:
                index = normalise(inside, outside, level)
            with write_file(f"{path}.idx") as sidecar:
                sidecar.write("".join(f"{offset}\t{length}\t{name}\n" for name, offset, length in index).encode())
            names, offsets, lengths = zip(*index)
            columns = [pa.array([path] * len(index)), pa.array(names), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.record_batch(columns, ["path", "record_id", "offset", "length"])

    spread = files.select("path").repartition(max(1, files.count()))
    return hand_off(map_batches(spread, rewrite, INDEX), scratch_path(files.sparkSession, "archive-index"))


PAGE = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(index: DataFrame) -> DataFrame:
    """The records that the index names, each read and inflated alone."""
    names = [f.split()[0] for f in PAGE.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out, path, source = [], None, None
        for row in batch.to_pylist():
            if row["path"] != path:
                if source:
                    source.close()
                path, source = row["path"], read_file(row["path"])
            source.seek(row["offset"])
            page = parsed(zlib.decompress(source.read(row["length"]), 31))
            out.append([page[n] for n in names])
        if source:
            source.close()
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return map_batches(index.select("path", "offset", "length"), read_rows, PAGE)


def op6_archives(pages: DataFrame) -> DataFrame:
    """The digest, from the archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    files = write_monolithic(with_origin(pages), task_folder(spark, scratch_path(spark, "monolithic")))
    index = normalise_all(files, task_folder(spark, scratch_path(spark, "normalised")))
    return read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
