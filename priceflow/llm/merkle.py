"""A Merkle manifest of a dataset: hash trees in van Emde Boas layout, with proofs for every row.

Method
1. Every row is a leaf: the hash of its fields. Leaves of one tree (a language) are numbered by id: sorted by range, counted per
   tree and range, and moved on by the counts before. No tree passes through one task.
2. A block is an aligned subtree of up to ``HEIGHT`` levels above 8 ** ``HEIGHT`` leaves (a parameter). It is stored as one array of digests in van Emde
   Boas layout: the tree is split at half its height into a top tree and the bottom trees under it, the top tree comes
   first, then the bottom trees from left to right, and each of them is laid out in the same way. So a path from a leaf to the root
   touches few runs of neighbouring digests, whatever the size of a cache line or page. ``addresses`` is that arithmetic; it
   also holds for subtrees whose last runs are short, without gaps.
3. Construction recurses over block roots: the roots of one tier's blocks are the leaves of the next, until each tree has
   one root. These, in the order of the trees' names, are the leaves of one more tree. A tier has a 4096th of the rows below.
4. Proofs go the other way. A block hands the siblings on the way from its root to the top down to its leaves, and a leaf reads its
   own from its block, so every block is read once.

Digests are SHA-256; where they are hashed they are written as lowercase hex text. Runs are 8 consecutive nodes, the last one
maybe shorter; also a run of one node is hashed, while there is more than one run in the tree or more than one node in the run.

Inputs out of the ordinary
- Null fields are ``-``; an empty text has its length 0, so the two differ. Very long texts are hashed whole. An empty table gives no row.
- Rows with one id (or none) are ordered by their leaves; those without id come first. Equal rows are leaves of their own.
- A null language is a tree of its own, before the others. Columns other than the five hashed ones are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from priceflow.llm.text import bound_batches
from priceflow.session import hand_off, scratch_path

FAN = 8
HEIGHT = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


def levels_of(n: int) -> int:
    """How often ``n`` nodes are hashed in runs until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


# --- layout ----------------------------------------------------------------------------------------


def _full(levels: int) -> int:
    return (FAN**levels - 1) // (FAN - 1)


def _size(levels: int, leaves: int) -> int:
    """The nodes of a tree of so many levels of nodes."""
    total = 0
    for _ in range(levels):
        total, leaves = total + leaves, -(-leaves // FAN)
    return total


def address(levels: int, leaves: int, level: int, index: int) -> int:
    """Where node ``index`` of a level (0 are the leaves) lies in a tree of so many levels with ``leaves`` leaves."""
    at = 0
    while levels > 1:
        bottom = levels - levels // 2
        tops = -(-leaves // FAN**bottom)
        if level >= bottom:
            levels, leaves, level = levels - bottom, tops, level - bottom
            continue
        # Bottom trees hang below the top tree's leaves, up to eight from each; all but the last are full.
        span = FAN ** (bottom - 1)
        tree, index = divmod(index, span // FAN**level)
        at += _size(levels - bottom, tops) + tree * _full(bottom)
        levels, leaves = bottom, min(leaves - tree * span, span)
    return at + index


@lru_cache(maxsize=64)
def addresses(height: int, leaves: int) -> list[list[int]]:
    """The addresses of all nodes of a tree of ``height`` levels above the leaves, by level."""
    out = []
    n = leaves
    for level in range(height + 1):
        out.append([address(height + 1, leaves, level, i) for i in range(n)])
        n = -(-n // FAN)
    return out


def build_block(leaves: Sequence[bytes], height: int) -> bytes:
    """The digests of the tree above ``leaves``, in layout order; its root comes first."""
    places = addresses(height, len(leaves))
    nodes = bytearray(DIGEST * sum(map(len, places)))
    texts = [leaf.hex() for leaf in leaves]
    digests = list(leaves)
    for level in places:
        for at, digest in zip(level, digests):
            nodes[DIGEST * at : DIGEST * (at + 1)] = digest
        digests = [hashlib.sha256("".join(texts[i : i + FAN]).encode()).digest() for i in range(0, len(texts), FAN)]
        texts = [digest.hex() for digest in digests]
    return bytes(nodes)


def siblings(nodes: bytes, height: int, leaves: int, index: int) -> list[tuple[str, str]]:
    """Of each level, from leaf ``index`` to below the root: the hex digests left and right of it in its run."""
    out, n = [], leaves
    places = addresses(height, leaves)
    for level in range(height):
        first = index // FAN * FAN
        run = places[level][first : min(first + FAN, n)]
        texts = [nodes[DIGEST * at : DIGEST * (at + 1)].hex() for at in run]
        out.append(("".join(texts[: index - first]), "".join(texts[index - first + 1 :])))
        index, n = index // FAN, -(-n // FAN)
    return out


def fold(leaf: bytes, path: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and the digests beside it lead to."""
    text = leaf.hex()
    for left, right in path:
        text = hashlib.sha256((left + text + right).encode()).hexdigest()
    return text


# --- leaves ----------------------------------------------------------------------------------------


def _field(value: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(changed: dict[str, Column] | None = None) -> Column:
    """The hash of a row's fields, some of them replaced."""
    fields = {name: F.col(name).cast("string") for name in FIELDS} | (changed or {})
    return F.unhex(F.sha2(F.concat(*[_field(fields[name]) for name in FIELDS]).cast("binary"), 256))


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` as a stored table with n, from 0 on in each tree by ``order``. Needs a column ``tree`` without nulls.

    Rows are sorted by range; a mark of their place in the input parts rows that are equal otherwise.
    """
    spark = rows.sparkSession
    names = rows.columns
    marked = rows.withColumn("_mark", F.xxhash64(F.monotonically_increasing_id()))
    keys = [tree, *order, "_mark"]
    placed = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*names, F.monotonically_increasing_id().alias("_place"))
    placed = hand_off(placed, scratch_path(spark, "merkle-placed"))
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(F.col(tree).alias("_tree"), part.alias("_part")).agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    before = F.sum("_rows").over(Window.partitionBy("_tree").orderBy("_part")) - F.col("_rows")
    offsets = hand_off(counts.select("_tree", "_part", (before - F.col("_first")).alias("_shift")), scratch_path(spark, "merkle-offsets"))
    joined = placed.join(offsets, (F.col(tree) == F.col("_tree")) & (part == F.col("_part")))
    return joined.select(*names, (F.col("_place") + F.col("_shift")).alias("n"))


# --- tiers of blocks -------------------------------------------------------------------------------

_BLOCKS = "tree string, block long, leaves long, height int, nodes binary"


def _blocks(leaves: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """The blocks of ``most`` levels above ``leaves`` (tree, n, digest); ``sizes`` has tree and total, the leaves of each tree."""
    span = FAN**most

    def build(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("n").to_numpy())
        digests = group.column("digest").to_pylist()
        ordered = [digests[i] for i in order.tolist()]
        total = group.column("total")[0].as_py()
        height = most if total > span else levels_of(total)
        row = (group.column("tree")[0].as_py(), group.column("block")[0].as_py(), len(ordered), height, build_block(ordered, height))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], ["tree", "block", "leaves", "height", "nodes"])

    rows = leaves.join(sizes, "tree").select("tree", F.expr(f"n div {span}").alias("block"), "n", "digest", "total")
    return rows.groupBy("tree", "block").applyInArrow(build, _BLOCKS)


def tiers(leaves: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The stored tables of blocks, from the one above ``leaves`` (tree, n, digest) up: tree, block, leaves, height, nodes.

    The last block of a tree is the only one of its tier. Trees with few leaves end below the last tier.
    """
    spark = leaves.sparkSession
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("total"))
    out = []
    while True:
        sizes = hand_off(sizes, scratch_path(spark, "merkle-sizes"))
        most = sizes.agg(F.max("total")).first()[0]
        if not most or (out and most == 1):
            return out
        if out:  # a tree that has one block is done
            sizes = sizes.where("total > 1")
        out.append(hand_off(_blocks(leaves, sizes, height), scratch_path(spark, "merkle-blocks")))
        leaves = out[-1].select("tree", F.col("block").alias("n"), F.substring("nodes", 1, DIGEST).alias("digest"))
        sizes = sizes.select("tree", F.expr(f"(total + {FAN**height - 1}) div {FAN**height}").alias("total"))


def roots(built: list[DataFrame]) -> DataFrame:
    """tree, digest: the root of each tree."""
    out = None
    for tier, blocks in enumerate(built):
        last = blocks.groupBy("tree").agg(F.count("*").alias("blocks"), F.min_by(F.substring("nodes", 1, DIGEST), "block").alias("digest"))
        last = last.where("blocks = 1").select("tree", "digest", F.lit(tier).alias("tier"))
        out = last if out is None else out.unionByName(last)
    return out.groupBy("tree").agg(F.min_by("digest", "tier").alias("digest"))


_PATH = "array<struct<left: string, right: string>>"


def paths(built: list[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Every block of the first tier, with ``path``: the digests beside the way from its root up. ``above``: those of trees' roots.

    From the last tier down: a block's path is what its parent block holds beside its root, and the parent's own path.
    """
    spark = above.sparkSession
    reached = None
    for blocks in reversed(built):
        only = blocks.groupBy("tree").agg(F.count("*").alias("blocks")).where("blocks = 1").select("tree")
        tops = blocks.join(only, "tree", "left_semi").join(above, "tree").select(*blocks.columns, "path")
        with_path = tops
        if reached is not None:
            below = _paths_of_leaves(reached, height)
            inner = blocks.join(below, ["tree", "block"]).select(*blocks.columns, "path")
            with_path = inner.unionByName(tops.join(below.select("tree").distinct(), "tree", "left_anti"))
        reached = hand_off(with_path, scratch_path(spark, "merkle-paths"))
    return reached


def _path_column(found: list[list[tuple[str, str]]]) -> pa.Array:
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.array([[{"left": left, "right": right} for left, right in path] for path in found], kind)


def _path(value: list[dict]) -> list[tuple[str, str]]:
    return [(step["left"], step["right"]) for step in value]


def _paths_of_leaves(blocks: DataFrame, height: int) -> DataFrame:
    """For each leaf of each block: tree, block (the number of the block below that leaf), path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                rest, n = _path(block["path"]), block["leaves"]
                for first in range(0, n, 512):
                    some = range(first, min(first + 512, n))
                    found = [siblings(block["nodes"], block["height"], n, i) + rest for i in some]
                    numbers = pa.array([block["block"] * FAN**height + i for i in some], pa.int64())
                    yield pa.record_batch([pa.array([block["tree"]] * len(some)), numbers, _path_column(found)], ["tree", "block", "path"])

    return blocks.mapInArrow(run, f"tree string, block long, path {_PATH}")


# --- the manifest ----------------------------------------------------------------------------------

_PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(height: int):
    """Proofs of the rows of one block: the digest of all siblings, and the root that the given leaf folds to."""

    def run(rows: pa.Table, block: pa.Table) -> pa.Table:
        held = block.to_pylist()[0]
        nodes, levels, n, rest = held["nodes"], held["height"], held["leaves"], _path(held["path"])
        subroot, root = held["subroot"].hex(), held["root"].hex()
        beside = "".join(left + right for left, right in rest).encode()
        out: list[list] = [[] for _ in range(7)]
        for row in rows.select(["doc_id", "n", "digest", "given"]).to_pylist():
            own = siblings(nodes, levels, n, row["n"] % FAN**height)
            proof = hashlib.sha256("".join(left + right for left, right in own).encode() + beside).hexdigest()
            folded = fold(row["given"], own + rest)
            values = (row["doc_id"], row["digest"].hex(), subroot, root, proof, folded, folded == root)
            for column, value in zip(out, values):
                column.append(value)
        kinds = (pa.int64(), *[pa.string()] * 5, pa.bool_())
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], [c.split()[0] for c in _PROOFS.split(", ")])

    return run


def manifest(docs: DataFrame, given: Column | None = None, height: int = HEIGHT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The numbered leaves, the first tier's blocks with their paths and roots, and the proofs.

    ``given`` is the leaf that is presented for a row (its own by default); proofs tell whether it verifies. Leaves:
    doc_id, tree, n, digest, given. Blocks: tree, block, leaves, height, nodes (in layout order), path, subroot, root.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    own = leaf_digest()
    # Trees in the order of their names, the one of rows without first.
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        own.alias("digest"),
        F.coalesce(given, own).alias("given") if given is not None else own.alias("given"),
    )
    rows = hand_off(rows, scratch_path(spark, "merkle-digests"))  # sorting by range reads its input twice
    leaves = hand_off(numbered(rows, "tree", ["doc_id", "digest"]), scratch_path(spark, "merkle-leaves"))
    built = tiers(leaves.select("tree", "n", "digest"), height)
    if not built:
        blocks = spark.createDataFrame([], f"{_BLOCKS}, path {_PATH}, subroot binary, root binary")
        return leaves, blocks, spark.createDataFrame([], _PROOFS)
    subroots = hand_off(roots(built).withColumnsRenamed({"tree": "name", "digest": "subroot"}), scratch_path(spark, "merkle-subroots"))
    tops = numbered(subroots.withColumn("tree", F.lit("")), "tree", ["name"])
    tops = hand_off(tops, scratch_path(spark, "merkle-tops"))
    upper = tiers(tops.select("tree", "n", F.col("subroot").alias("digest")), height)
    top = roots(upper).select(F.col("digest").alias("root"))
    nothing = spark.range(1).select(F.lit("").alias("tree"), F.array().cast(_PATH).alias("path"))
    nothing = hand_off(nothing, scratch_path(spark, "merkle-top"))
    of_tops = _paths_of_leaves(paths(upper, nothing, height), height).select(F.col("block").alias("n"), "path")
    names = tops.join(of_tops, "n").select(F.col("name").alias("tree"), "subroot", "path")
    names = hand_off(names, scratch_path(spark, "merkle-names"))
    root = top.first()["root"]
    reached = paths(built, names.select("tree", "path"), height).join(names.select("tree", "subroot"), "tree")
    blocks = hand_off(reached.withColumn("root", F.lit(bytes(root))), scratch_path(spark, "merkle-manifest"))
    by_block = leaves.withColumn("block", F.expr(f"n div {FAN**height}")).groupBy("tree", "block")
    proofs = by_block.cogroup(blocks.groupBy("tree", "block")).applyInArrow(_prove(height), _PROOFS)
    return leaves, blocks, proofs


def tampered() -> Column:
    """The leaf with the text's A-Z lower-cased, where 3 divides the checksum of the id; the row's own elsewhere."""
    lower = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    third = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0
    return F.when(third, leaf_digest({"text": lower}))


def op13_proofs(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    return manifest(docs, tampered())[2]
