"""Line dedup: lines that other documents hold too stay only in the document with the smallest id.

Lines are exploded and normalised (ASCII white space stripped at both ends, A-Z as a-z), hashed to 128
bits, and documents are counted per hash. A document loses its lines of every hash that at least
``min_documents`` documents hold, unless its own id is the smallest of them. What is left is put
together in the order of the lines. Only hashes and ids are shuffled for the counts; each text moves
once, to meet the hashes that it loses.

- Null or empty text: one empty line, which is kept. Lines shorter than ``min_chars`` after
  normalisation always stay.
- Rows that share an id are one document in the count, so they keep or lose lines alike. Rows without
  id are no document: they lose nothing and no line counts because of them.
- Columns other than the id and the text are passed through by ``deduplicated`` and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from priceflow.llm.text import WHITE, map_batches
from priceflow.session import hand_off, scratch_path

MIN_CHARS = 10
MIN_DOCUMENTS = 2


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The hash of a line's normal form, none if that is too short to count."""
    key = line.strip(WHITE)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())


def document_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The distinct line hashes of each row: doc_id, line_hash."""

    def explode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, hashes = [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = {line_key(line, min_chars) for line in (text.as_py() or b"").split(b"\n")} - {None}
            ids += [doc_id] * len(found)
            hashes += found
            if len(ids) > 50_000:
                yield _lines(ids, hashes)
                ids, hashes = [], []
        yield _lines(ids, hashes)

    def _lines(ids: list, hashes: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(hashes, pa.binary())], ["doc_id", "line_hash"])

    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return map_batches(rows, explode, "doc_id long, line_hash binary")


def lost_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The hashes that each document loses: doc_id, lost (an array, at most one entry per line)."""
    lines = hand_off(document_lines(docs, min_chars), scratch_path(docs.sparkSession, "lines"))
    one_each = lines if min_documents <= 2 else lines.distinct()
    counted = one_each.groupBy("line_hash").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("documents")
    )
    # Two documents differ when smallest and largest id do, which needs no distinct rows.
    shared = counted.where("first_id < last_id" if min_documents <= 2 else F.col("documents") >= min_documents)
    lost = lines.join(shared.select("line_hash", "first_id"), "line_hash").where("doc_id > first_id")
    return lost.groupBy("doc_id").agg(F.collect_set("line_hash").alias("lost"))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` (doc_id, text and any column ``row``) with kept, the text that is left, n_lines and n_dropped."""
    lost = lost_lines(docs.select("doc_id", "text"), min_chars, min_documents).withColumnRenamed("doc_id", "lost_id")
    joined = docs.join(lost, F.col("doc_id").cast("long") == F.col("lost_id"), "left").drop("lost_id")
    names = list(docs.columns)
    place = names.index("text")

    def rebuild(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept, n_lines, n_dropped = [], [], []
        for value, hashes in zip(batch.column(place), batch.column(batch.num_columns - 1)):
            body = value.as_py()
            lines = (body or "").split("\n")
            drop = set(hashes.as_py() or ())
            left = [x for x in lines if line_key(x.encode(), min_chars) not in drop] if drop else lines
            kept.append(body if len(left) == len(lines) else "\n".join(left))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
        added = [pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
        yield pa.record_batch([*batch.columns[: len(names)], *added], [*names, "kept", "n_lines", "n_dropped"])

    added = StructType().add("kept", "string").add("n_lines", "long").add("n_dropped", "long")
    return map_batches(joined.select(*names, "lost"), rebuild, StructType(docs.schema.fields + added.fields))


def op4_lines(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, n_lines, n_dropped, kept_sha256."""
    kept = drop_lines(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with their remaining text; n_chars, where there is one, follows it."""
    # The other columns travel as one, so their names can't meet those used here.
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    kept = drop_lines(docs.select("doc_id", F.col("text").cast("string"), others))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("kept").alias(name)
        value = F.col("row")[name]
        if name == "n_chars":
            value = F.when(F.col("n_dropped") > 0, F.length("kept")).otherwise(value).cast(docs.schema[name].dataType)
        return value.alias(name)

    return kept.select(*map(column, docs.columns))
