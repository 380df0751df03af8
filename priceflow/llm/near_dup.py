"""Near-duplicate documents by bottom-k sketches of one hash function.

Method
1. A document's set holds the hashes of its distinct five-word shingles. Documents with equal sets form
   a class; one of them, the smallest id, stands for it from here on. Its sketch keeps the ``k``
   smallest hashes, or the whole set up to ``whole`` hashes. Sets of which one has up to ``whole * s`` hashes are
   compared by whole sketches, larger ones by their ``k`` smallest, so any two similar sets are compared in one way.
2. Inverted lists of retained values generate overlaps. Two similar sets share at least ``c`` retained
   values, so a list is needed only for the rarest few of a sketch: whoever shares ``c`` of ``r`` values
   shares one of the ``r - c + 1`` rarest. Values that only one class retains use up places of that prefix, so documents
   without relatives leave here, and a very common passage makes a list only of documents that hold little else.
3. First most of the groups: in each of ``ROUNDS`` rounds, documents with lists meet at the sketch value that is smallest under the round's
   order, and each is compared with one of them, the hub: the one with the smallest share of unshared values, the smallest set, or the smallest id. Similar documents
   share a round's value with a probability of their similarity, so these rounds leave little between different components.
4. What is then unconnected is compared as well: members of different components in one list, but only in the list of the rarest value
   that both hold, where no rarer values leave room for enough overlap, and where whole sketches, or bitmaps of the full sets, show that they can be similar. Before that, members that are too large for the smallest
   member of another component lose their place in a list, and lists that are left with one component go. So a group
   of near copies, or of documents around one passage, costs about as many comparisons as it has members.
5. Pairs pass the sketch of the union (how many of its ``k`` smallest values both hold), then the exact similarity
   of the full sets. The result is the components of the links that pass.

For whole sketches ``c`` and all bounds are exact. For the others ``c`` lies four standard deviations under the number of
values that two sets at the threshold share, so a link at exactly the threshold is missed about once in
30,000, and one at 0.9 practically never.

Inputs out of the ordinary
- Null, empty or blank text: an empty set, linked with nothing.
- Rows that share an id are one document with several texts; they are linked through the id.
- Rows without id are linked with nothing: component_id is null, kept is true.
- Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from priceflow.llm.components import connected_components
from priceflow.llm.text import map_batches, shingle_set, word_runs
from priceflow.session import hand_off, scratch_path, scratch_scope

SHINGLE = 5
SIMILARITY = (75, 100)
K = 48
WHOLE = 170
ROUNDS = 6
BITS = 4096


def retained_in_common(k: int, similarity: tuple[int, int]) -> int:
    """The values that two sketches of ``k`` share at least, but for four standard deviations."""
    s = similarity[0] / similarity[1]
    return max(1, math.floor(s * k - 4.1 * math.sqrt(k * s * (1 - s))))


def _signed(values: np.ndarray) -> np.ndarray:
    """Unsigned words as signed ones of the same order."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, k: int = K, whole: int = WHOLE) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the whole set, null if empty) and sketch of each row."""

    def batch_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, keys, sketches = [], [], []
        for _, before, words, _, _ in word_runs(batch.column(1)):
            for a, b in zip(before, before[1:]):
                found = shingle_set(words[a:b], shingle)
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sketches.append(_signed(found if len(found) <= whole else found[:k]))
        lengths = np.concatenate([[0], np.cumsum([len(x) for x in sketches])]).astype(np.int32)
        values = pa.array(np.concatenate([np.empty(0, np.int64), *sketches]))
        yield pa.record_batch(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(lengths, values)],
            ["doc_id", "n_shingles", "set_key", "sketch"],
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, batch_rows, "doc_id long, n_shingles long, set_key binary, sketch array<long>")


def bitmap(values: np.ndarray) -> np.ndarray:
    """``BITS`` bits in signed words, each set if a value falls on it."""
    bits = np.zeros(BITS, np.uint8)
    bits[values & np.uint64(BITS - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def full_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, shingles and bits: the whole set of each row, and its bitmap."""

    def batch_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, before, words, _, _ in word_runs(batch.column(1)):
            found = [shingle_set(words[a:b], shingle) for a, b in zip(before, before[1:])]
            lengths = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            sets = pa.ListArray.from_arrays(lengths, pa.array(np.concatenate(found).view(np.int64)))
            words_of_each = np.arange(len(found) + 1, dtype=np.int32) * (BITS // 64)
            bits = pa.ListArray.from_arrays(words_of_each, pa.array(np.concatenate([bitmap(x) for x in found])))
            yield pa.record_batch([batch.column(0).slice(first, len(found)), sets, bits], ["doc_id", "shingles", "bits"])

    return map_batches(docs.select("doc_id", "text"), batch_rows, "doc_id long, shingles array<long>, bits array<long>")


LIST = ["kind", "value"]


def sketch_lists(classes: DataFrame, k: int, whole: int, similarity: tuple[int, int]) -> DataFrame:
    """The inverted lists: kind (0 whole, 1 the k smallest), value, node, n_shingles, retained, rarer.

    ``classes`` has node, set_key, n_shingles and sketch; rarer is the number of the sketch's values before this one.
    """
    low, high = similarity
    columns = ["node", "set_key", "n_shingles"]
    small = classes.where(F.col("n_shingles") <= whole).select(*columns, F.lit(0).alias("kind"), F.explode("sketch").alias("value"))
    large = classes.where(high * F.col("n_shingles") > low * whole)
    large = large.select(*columns, F.lit(1).alias("kind"), F.explode(F.slice("sketch", 1, k)).alias("value"))
    values = small.unionByName(large)
    shared = values.groupBy(*LIST).agg(F.count("*").alias("holders")).where("holders > 1")
    held = values.join(shared, LIST).groupBy(*columns, "kind")
    held = held.agg(F.sort_array(F.collect_list(F.struct("holders", "value"))).alias("held"))
    whole_set = F.col("kind") == 0
    held = held.withColumn("retained", F.when(whole_set, F.col("n_shingles")).otherwise(F.least(F.col("n_shingles"), F.lit(k))).cast("int"))
    common = F.when(whole_set, F.ceil(F.col("retained") * low / high)).otherwise(F.lit(retained_in_common(k, similarity)))
    held = held.withColumn("alone", F.col("retained") - F.size("held"))
    held = held.withColumn("places", (F.col("retained") - common + 1 - F.col("alone")).cast("int")).where("places > 0")
    entries = held.select(*columns, "kind", "retained", "alone", F.posexplode(F.slice("held", F.lit(1), F.col("places"))).alias("at", "entry"))
    return entries.select("kind", "entry.value", "node", "n_shingles", "retained", (F.col("alone") + F.col("at")).alias("rarer"))


def _least_overlap(similarity: tuple[int, int], n: Column, m: Column) -> Column:
    """The retained values that similar members of a list, with ``n`` and ``m`` shingles, have in common at least.

    Of the larger of two sets of similarity s, the share s / (1 + s) * (1 + n / m) or more lies in the smaller one. That is exact
    for whole sketches; of others as many of the ``retained`` values are common, but for four standard deviations.
    """
    s = similarity[0] / similarity[1]
    share = s / (1 + s) * (1 + F.least(n, m) / F.greatest(n, m))
    expected = F.col("retained") * share
    chance = 4.1 * F.sqrt(F.greatest(F.lit(0.0), expected * (1 - share)))
    return F.when(F.col("kind") == 0, s / (1 + s) * (n + m)).otherwise(expected - chance) - 1e-9


def _may_link(similarity: tuple[int, int]) -> Column:
    """Whether two members of a list, the second one in ``other``, can be similar without sharing a rarer value."""
    low, high = similarity
    n, m = F.col("n_shingles"), F.col("other.n_shingles")
    mine, others = F.col("retained") - F.col("rarer"), F.col("other.retained") - F.col("other.rarer")
    return (high * F.least(n, m) >= low * F.greatest(n, m)) & (F.least(mine, others) >= _least_overlap(similarity, n, m))


_MEMBER = ["node", "component", "n_shingles", "retained", "rarer"]


def hub_pairs(classes: DataFrame, k: int, rounds: int = ROUNDS) -> DataFrame:
    """Pairs (a < b) of documents and the hubs that they meet in each round: a, b."""
    bottom = F.slice("sketch", 1, k)

    def smallest(turn: int) -> Column:
        return F.array_min(F.transform(bottom, lambda x: F.xxhash64(x, F.lit(turn))))

    met = classes.select("node", "n_shingles", "unshared", F.posexplode(F.array(*map(smallest, range(rounds)))).alias("turn", "key"))
    # The origin of edited copies has the least that nobody shares; small sets suit documents around a passage.
    by_turn = F.when(F.col("turn") % 3 == 1, F.col("n_shingles").cast("double")).when(F.col("turn") % 3 == 0, F.col("unshared"))
    order = F.struct(by_turn, F.col("node"))
    hubs = met.groupBy("turn", "key").agg(F.min(order)["node"].alias("hub"), F.count("*").alias("n")).where("n > 1")
    pairs = met.join(hubs, ["turn", "key"]).where("node <> hub")
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def open_lists(lists: DataFrame, components: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Members of lists that may still link with another component in their list, with the component of each."""
    low, high = similarity
    known = lists.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    n = F.col("n_shingles")
    # Enough values that are no rarer than the list's, given the partner's least size.
    able = known.where(F.col("retained") - F.col("rarer") >= _least_overlap(similarity, n, F.ceil(n * low / high)))
    several = able.groupBy(*LIST).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return able.join(several.select(*LIST), LIST).select(*LIST, *_MEMBER)


def pruned(members: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``members`` without those that the smallest set of another component in their list is too large for already."""
    low, high = similarity
    sizes = members.groupBy(*LIST, "component").agg(F.min("n_shingles").alias("size"))
    first = sizes.groupBy(*LIST).agg(F.min(F.struct("size", "component")).alias("first"))
    second = sizes.join(first, LIST).where("component <> first.component").groupBy(*LIST, "first").agg(F.min("size").alias("second"))
    known = members.join(second, LIST)
    n = F.col("n_shingles")
    other = F.when(F.col("component") == F.col("first.component"), F.col("second")).otherwise(F.col("first.size"))
    # Of whole sketches the overlap that is needed rises with the other's size; of others it is least at the limits.
    partner = F.greatest(F.ceil(n * low / high), F.when(F.col("kind") == 0, other).otherwise(F.lit(0)))
    able = (high * n >= low * other) & (F.col("retained") - F.col("rarer") >= _least_overlap(similarity, n, partner))
    return known.where(able).select(*members.columns)


def with_sets(members: DataFrame, held: DataFrame) -> DataFrame:
    """``members`` with prefix, the values of the node's lists from the rarest on, and held: its whole sketch, or the bitmap of its
    set. ``held`` has node, sketch and bits."""
    prefix = members.groupBy("node", "kind").agg(F.sort_array(F.collect_list(F.struct("rarer", "value"))).alias("own"))
    prefix = prefix.join(held, "node").select(
        "node",
        "kind",
        F.transform("own", lambda x: x["value"]).alias("prefix"),
        F.when(F.col("kind") == 0, F.col("sketch")).otherwise(F.col("bits")).alias("held"),
    )
    return members.join(prefix, ["node", "kind"])


def remaining_pairs(full: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a < b) of one list and different components that can be similar, each from the rarest value both hold: a, b.

    ``full`` comes from ``with_sets``. Whole sketches tell the overlap. The bitmaps of other sets differ in no more places than
    the sets in values, so pairs whose bitmaps differ too much can't be similar.
    """
    low, high = similarity
    others = full.select(*LIST, F.struct(*_MEMBER, "prefix", "held").alias("other"))
    rarest = F.get(F.array_intersect("prefix", "other.prefix"), F.lit(0)) == F.col("value")
    both = F.col("n_shingles") + F.col("other.n_shingles")
    common = F.size(F.array_intersect("held", "other.held"))
    places = F.zip_with("held", "other.held", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differing = F.aggregate(places, F.lit(0), lambda x, y: x + y)
    similar = F.when(F.col("kind") == 0, (low + high) * common >= low * both).otherwise((low + high) * differing <= (high - low) * both)
    apart = (F.col("node") < F.col("other.node")) & (F.col("component") != F.col("other.component"))
    joined = full.join(others, LIST).where(apart & _may_link(similarity) & rarest & similar)
    return joined.select(F.col("node").alias("a"), F.col("other.node").alias("b")).distinct()


def verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, k: int, similarity: tuple[int, int]) -> DataFrame:
    """The pairs that the union's sketch lets through and the full sets confirm: u, v."""
    low, high = similarity
    sides = [classes.select(F.col("node").alias(s), F.col("sketch").alias(f"s_{s}")) for s in "ab"]
    near = pairs.join(sides[0], "a").join(sides[1], "b")
    # Both sketches together hold the union's k smallest values; those in both sets are in both sketches.
    for side in ("s_a", "s_b"):
        near = near.withColumn(side, F.slice(side, 1, k))
    union = F.slice(F.sort_array(F.array_union("s_a", "s_b")), 1, k)
    near = near.withColumn("union", union).withColumn("both", F.array_intersect("s_a", "s_b"))
    least = F.least(F.lit(retained_in_common(k, similarity)), F.ceil(F.size("union") * low / high))
    near = near.where(F.size(F.array_intersect("union", "both")) >= least).select("a", "b")
    sides = [sets.select(F.col("doc_id").alias(s), F.col("shingles").alias(f"f_{s}")) for s in "ab"]
    full = near.join(sides[0], "a").join(sides[1], "b")
    full = full.withColumn("both", F.size(F.array_intersect("f_a", "f_b")))
    full = full.where(high * F.col("both") >= low * (F.size("f_a") + F.size("f_b") - F.col("both")))
    return full.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY, k: int = K, whole: int = WHOLE
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id, component_id, kept.

    class_id is the smallest id with the same set, component_id the smallest id that links reach. Of the tables written on
    the way, only the classes of rows and the components of classes last, which the result reads.
    """
    spark = docs.sparkSession
    lasting = {name: scratch_path(spark, f"near-{name}") for name in ("members", "groups")}

    def keep(df: DataFrame, name: str) -> DataFrame:
        return hand_off(df, scratch_path(spark, f"near-{name}"))

    with scratch_scope(spark):
        prints = keep(fingerprints(docs, shingle, k, whole), "fingerprints")
        usable = prints.where("doc_id IS NOT NULL AND n_shingles > 0")
        own = [F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in ("n_shingles", "sketch"))]
        classes = keep(usable.groupBy("set_key").agg(*own), "classes")
        named = classes.select("set_key", F.col("node").alias("class_id"))
        mapped = hand_off(prints.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left").drop("set_key"), lasting["members"])

        lists = keep(sketch_lists(classes, k, whole, similarity), "lists")
        several = lists.groupBy(*LIST).agg(F.count("*").alias("n")).where("n > 1")
        nodes = lists.join(several, LIST).groupBy("node").agg(F.min(F.col("rarer") / F.col("retained")).alias("unshared"))
        related = keep(classes.join(nodes, "node").select("node", "n_shingles", "sketch", "unshared"), "related")
        wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        sets = keep(full_sets(wanted.join(related.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"), shingle), "sets")

        # An id with several texts is one document: its classes are linked.
        known = mapped.where("class_id IS NOT NULL AND doc_id IS NOT NULL")
        ranges = known.groupBy("doc_id").agg(F.min("class_id").alias("u"), F.max("class_id").alias("high")).where("u < high")
        shared = known.join(ranges, "doc_id").select("u", F.col("class_id").alias("v"))
        met = verified(hub_pairs(related, k), related, sets, k, similarity)
        components = connected_components(keep(met.unionByName(shared), "links"))
        left = keep(pruned(open_lists(lists, components, similarity), similarity), "open-lists")
        if left.count():
            held = related.select("node", "sketch").join(sets.select(F.col("doc_id").alias("node"), "bits").distinct(), "node")
            # Short plans: one for all of this takes much of the driver's memory when every step has many tasks.
            left = keep(pruned(left, similarity), "open-members")
            full = keep(with_sets(left, held), "open-sets")
            pairs = keep(remaining_pairs(full, similarity), "remaining")
            links = verified(pairs, related, sets, k, similarity)
            for side in "uv":
                label = components.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
                links = links.join(label, side, "left").withColumn(side, F.coalesce(f"of_{side}", side)).drop(f"of_{side}")
            joined = connected_components(keep(links, "late-links"))
            joined = joined.select(F.col("component").alias("joined"), F.col("node").alias("component"))
            late = components.join(joined, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
            lone = joined.join(components.select(F.col("node").alias("component")), "component", "left_anti")
            components = late.unionByName(lone.select(F.col("component").alias("node"), F.col("joined").alias("component")))
        components = hand_off(components, lasting["groups"])

    result = mapped.join(components.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id")).alias("component_id"),
    )
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op3_near_duplicates(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, n_shingles, component_id, kept, class_id."""
    return near_duplicates(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id", "kept", "class_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that a smaller id of their component stands for."""
    gone = near_duplicates(docs.select("doc_id", "text")).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
