"""Personal data: known forms as seeds, and contexts learned from them that discover further identifiers.

Method
1. Emails, IP addresses, card and phone numbers of known form are found in every whole text; their spans stay.
2. Every span, and every other token with a digit or an at sign, is an occurrence of an instance (its text).
   Its contexts are two lexical patterns: the two words before it, and the words on both sides.
3. Patterns and instances make a weighted graph, one edge per pair, pre-aggregated over the corpus. Seeds are
   certain of their kind. In each round a pattern's score for a kind is the share of its occurrences whose
   instances are known to be of that kind, where unknown ones count by ``UNKNOWN`` and others in full, and an instance's confidence is the noisy-or of the
   scores of the patterns it occurs in.
4. After ``ROUNDS`` rounds, patterns with a score of ``CONFIDENT`` or more that at least ``SUPPORT`` different instances
   of the kind support are trusted: other tokens that occur in them, and that have a confidence of ``DISCOVERED`` or
   more, are added as spans of the kind.

All statistics cover all documents. The graph is joined edge by edge; the scores have one row per pattern or
instance, so a very common pattern or instance is pre-aggregated and its edges can be split. Patterns with
fewer instances than ``SUPPORT`` can't become trusted and leave the graph first.

Positions are code points. Memory is bounded by an Arrow batch and one text; time is linear in a text's length.

Inputs out of the ordinary
- Null or empty text: no span, the digest of the empty string. Null doc_id: reported like others.
- Repeated rows are each reported; their occurrences count each, their instances once.
- Columns other than id and text are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from priceflow.llm.text import map_batches
from priceflow.session import hand_off, scratch_path

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
SUPPORT = 4
SMOOTHING = 1.0
UNKNOWN = 0.25
CONFIDENT = 0.75
DISCOVERED = 0.5
MIN_TOKEN = 5
MOST_TOKEN = 100
CONTEXT = 80

# The known forms. Possessive repeats and the look-behind give the same leftmost matches as
# plain repeats, in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_EDGES = ".,;:!?\"'()[]{}<>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index in ``KINDS``, end) of the known forms, in order."""
    found = [(a, 0, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() < 12:
                continue
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _word(word: str) -> str:
    return _DIGIT.sub("0", word.strip(_EDGES).lower())


def contexts(text: str, start: int, end: int) -> tuple[str | None, str | None]:
    """The two words before a span, and the words on both its sides; none at a border of the text."""
    before = text[max(0, start - CONTEXT) : start].split()[-2:]
    after = text[end : end + CONTEXT].split()[:1]
    left = [_word(w) for w in before]
    right = [_word(w) for w in after]
    if len(left) < 2:
        return None, None
    return f"{left[0]} {left[1]} _", f"{left[1]} _ {right[0]}" if right and right[0] else None


def occurrences(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int | None]]:
    """Spans of known form, and other tokens with a digit or an at sign: start, end, kind if known."""
    for start, kind, end in spans:
        yield start, end, kind
    starts = [s for s, _, _ in spans]
    ends: list[int] = []
    for _, _, end in spans:
        ends.append(max(end, ends[-1]) if ends else end)
    at = 0
    for m in _TOKEN.finditer(text):
        raw = m[0]
        token = raw.strip(_EDGES)
        if not MIN_TOKEN <= len(token) <= MOST_TOKEN:
            continue
        start = m.start() + len(raw) - len(raw.lstrip(_EDGES))
        end = start + len(token)
        while at < len(starts) and ends[at] <= start:
            at += 1
        if at < len(starts) and starts[at] < end:
            continue
        yield start, end, None


SPANS = "array<struct<start:int,kind:int,end:int>>"
FOUND = "array<struct<start:int,end:int,kind:int,instance:string,before:string,around:string>>"


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, base and occurrences of each row."""
    kinds = [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]
    parts = [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("instance", pa.string()), ("before", pa.string()), ("around", pa.string())]
    quick = re.compile(rb"[0-9@]")

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        base: list[list[dict]] = []
        found: list[list[dict]] = []
        for value in batch.column(1):
            base.append([])
            found.append([])
            data = value.as_py()
            if not data or not quick.search(data):
                continue
            text = data.decode()
            spans = base_spans(text)
            base[-1] = [{"start": a, "kind": k, "end": b} for a, k, b in spans]
            for start, end, kind in occurrences(text, spans):
                before, around = contexts(text, start, end)
                instance = text[start:end].lower()
                found[-1].append({"start": start, "end": end, "kind": kind, "instance": instance, "before": before, "around": around})
        columns = [batch.column(0), pa.array(base, pa.list_(pa.struct(kinds))), pa.array(found, pa.list_(pa.struct(parts)))]
        yield pa.record_batch(columns, ["doc_id", "base", "found"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return map_batches(rows, scan, f"doc_id long, base {SPANS}, found {FOUND}")


def trusted(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Trusted patterns (pattern, kind) and the kinds of instances that are no seeds (instance, kind, confidence)."""
    spark = found.sparkSession

    def keep(df: DataFrame, name: str) -> DataFrame:
        return hand_off(df, scratch_path(spark, f"pii-{name}"))

    patterns = found.select("instance", "kind", F.explode(F.array_compact(F.array("before", "around"))).alias("pattern"))
    edges = patterns.groupBy("pattern", "instance").agg(F.count("*").cast("double").alias("n"), F.max("kind").alias("kind"))
    edges = keep(edges, "edges")
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"), F.count("*").alias("instances")).where(F.col("instances") >= support)
    edges = keep(edges.join(totals.select("pattern", "total"), "pattern"), "graph")
    seeds = found.where("kind IS NOT NULL").groupBy("instance").agg(F.min("kind").alias("kind"))
    known = seeds.withColumn("confidence", F.lit(1.0)).withColumn("seed", F.lit(True))
    known = seeds_only = keep(known, "seeds")
    strong = None
    for _ in range(rounds):
        of = known.withColumnRenamed("kind", "of_kind")
        weighed = edges.join(of, "instance").groupBy("pattern", "total").agg(F.array(*map(_support_of, range(len(KINDS)))).alias("kinds"))
        all_kinds = F.aggregate("kinds", F.lit(0.0), lambda a, k: a + k["weight"])
        each = weighed.select("pattern", "total", all_kinds.alias("known"), F.explode("kinds").alias("k")).select("pattern", "total", "known", "k.*")
        # Instances of other kinds count against a pattern in full, unknown ones in part.
        unknown = F.greatest(F.lit(0.0), F.col("total") - F.col("known"))
        score = F.col("weight") / (F.col("known") + UNKNOWN * unknown + SMOOTHING)
        strong = keep(each.where(F.col("supporters") >= support).select("pattern", "kind", score.alias("score")), "patterns")
        scores = strong.where(F.col("score") >= DISCOVERED).withColumnRenamed("kind", "of_kind")
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-6), 1 - F.col("score")))))
        guessed = edges.where("kind IS NULL").join(scores, "pattern").groupBy("instance", "of_kind").agg((1 - doubt).alias("confidence"))
        best = guessed.groupBy("instance").agg(F.max(F.struct("confidence", -F.col("of_kind"))).alias("best"))
        guesses = best.join(seeds_only.select("instance"), "instance", "left_anti")
        guesses = guesses.select("instance", (-F.col("best.col2")).alias("kind"), F.col("best.confidence").alias("confidence"), F.lit(False).alias("seed"))
        known = keep(seeds_only.unionByName(guesses), "instances")
    return strong.where(F.col("score") >= CONFIDENT).select("pattern", "kind"), known.where("NOT seed AND confidence >= " + str(DISCOVERED))


def _support_of(kind: int) -> Column:
    own = F.col("of_kind") == kind
    weight = F.coalesce(F.sum(F.when(own, F.col("n") * F.col("confidence"))), F.lit(0.0))
    supporters = F.count(F.when(own & (F.col("confidence") >= DISCOVERED), 1))
    return F.struct(F.lit(kind).alias("kind"), weight.alias("weight"), supporters.alias("supporters"))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base and all spans (in order) of each row of ``docs``."""
    spark = docs.sparkSession
    rows = hand_off(scanned(docs).withColumn("row", F.monotonically_increasing_id()), scratch_path(spark, "pii-rows"))
    found = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("o")).select("row", "o.*")
    patterns, instances = trusted(found)
    places = found.where("kind IS NULL").drop("kind").withColumn("pattern", F.explode(F.array_compact(F.array("before", "around"))))
    places = places.select("row", "start", "end", "instance", "pattern").join(patterns, "pattern")
    places = places.join(instances.select("instance", F.col("kind").alias("of_kind")), "instance").where("kind = of_kind")
    added = places.groupBy("row").agg(F.collect_set(F.struct("start", "kind", "end")).alias("added"))
    joined = rows.select("row", "doc_id", "base").join(added, "row", "left")
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(SPANS))))
    return joined.select("doc_id", "base", every.alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def op10_personal_data(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = personal_data(docs.select("doc_id", "text"))
    numbers = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *numbers, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
