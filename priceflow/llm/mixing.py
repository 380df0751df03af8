"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Only DataFrame functions are used, so all of it runs in the JVM.

Method
1. The mix has ``share`` times the words of all documents. Sources get them in proportion to their weights, but none more than
   ``epochs`` times its own words: sources above that are clamped, and what they can't take goes to the others in
   proportion to their weights, until none is above. Each round is one sum over the table of sources; the water level
   rises from round to round, and a source is clamped when its weight times the level reaches its cap.
2. A target is so many whole repetitions of the source and a rest. Documents fall into ``CELLS`` cells by a seeded hash. Cells in
   ascending order take part in the rest until it is used up: those before the last one with all words, the last one with the
   share of every document's words that is still needed, rounded up or down by the hash. So a source's words miss its target by no
   more than these roundings, whatever the sizes of its documents, and one of ``CELLS`` cells is cut.

The text is read once; then only sizes and hashes move. Sums per source and cell are folded before they are shuffled, so a source
that holds most documents costs no more than any other. Documents get their source's plan by a join that Catalyst plans
by the size of the table of sources: it is broadcast below the threshold only, and AQE splits a hot source beyond it.

Inputs out of the ordinary
- Null, empty or blank text: size 0, nothing is taken. A null source is a source, the last one. An empty table gives no row.
- Where all words are none, all targets are 0. Where ``share`` is above ``epochs``, every source is clamped.
- Rows without id are told apart by their text. Rows of the same id (or without id, of the same text) share a cell; each counts.
- Very long texts: words are counted, nothing else is made of them. Columns other than doc_id, source and text are not looked at; ``mixed``
  passes all columns through, and refuses names that it adds (repetition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from priceflow.session import hand_off, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Words of the mix and most words of a source, as fractions of the words there are.
SHARE = (3, 2)
EPOCHS = 2
SEED = "mix"
CELLS = 4096


def sized(docs: DataFrame, seed: str = SEED, *further: Column) -> DataFrame:
    """doc_id, source, size, cell (0 to ``CELLS`` - 1) and draw (48 bits), the last two by the hash of seed and id."""
    text = F.col("text").cast("string")
    own = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.md5(text.cast("binary")), F.lit(""))
    digest = F.md5(F.concat_ws(":", F.lit(seed), own).cast("binary"))
    number = lambda at, n: F.conv(F.substring(digest, at, n), 16, 10).cast("long")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        number(1, 3).alias("cell"),
        number(4, 12).alias("draw"),
        *further,
    )


def ranked_sources(cells: DataFrame, weights: Sequence[int], name: str) -> DataFrame:
    """source, source_size, weight: the weights in turn, by the sources' order (null last).

    Sources are sorted by range and counted per range; only the counts, a row for each range, pass through one window.
    """
    spark = cells.sparkSession
    sums = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranges = sums.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = hand_off(ranges, scratch_path(spark, f"{name}-ranges"))
    part = F.shiftright("place", 33).alias("part")
    counts = placed.groupBy(part).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("part"), F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    turn = (rank % len(weights) + 1).cast("int")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn)
    found = placed.withColumn("part", part).join(offsets, "part")
    return hand_off(found.select("source", "source_size", weight.alias("weight")), scratch_path(spark, f"{name}-sources"))


def _above(level: tuple[int, int], epochs: int) -> Column:
    """Whether a source is clamped at the level, compared as whole numbers of any size."""
    wide = lambda c: c.cast("decimal(38,0)")
    up, down = (F.lit(n).cast("decimal(24,0)") for n in level)
    return wide(epochs * F.col("source_size")) * down <= F.col("weight").cast("decimal(12,0)") * up


def water_level(sources: DataFrame, share: tuple[int, int], epochs: int) -> tuple[int, int]:
    """The level as a fraction: a source's target is its weight times the level, or its cap if that is less.

    (1, 0), an endless level, if all sources are clamped. Every round adds clamped sources, so there is an end.
    """
    up, down = share
    total = int(sources.agg(F.sum("source_size").alias("n")).first().n or 0)
    level = None
    while True:
        clamped = F.lit(False) if level is None else _above(level, epochs)
        sums = sources.agg(F.sum(F.when(clamped, epochs * F.col("source_size"))), F.sum(F.when(~clamped, F.col("weight"))))
        taken, weight = sums.first()
        if not weight:
            return 1, 0
        new = up * total - down * int(taken or 0), down * int(weight)
        if level is not None and new[0] * level[1] <= level[0] * new[1]:
            return level
        level = new


def _target(level: tuple[int, int], epochs: int) -> tuple[Column, Column]:
    """A source's target, and its whole words."""
    cap = epochs * F.col("source_size")
    if not level[1]:
        return cap.cast("double"), cap
    free = F.col("weight") * F.lit(level[0]).cast("long")
    whole = F.expr(f"(weight * {level[0]}L) div {level[1]}L")
    above = _above(level, epochs)
    return F.when(above, cap.cast("double")).otherwise(free.cast("double") / F.lit(float(level[1]))), F.when(above, cap).otherwise(whole)


def plan(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """Of each source: source_size, target, repeats (whole ones), and the cell that is cut with its words and those needed.

    ``sizes`` is what ``sized`` gives, as a stored table.
    """
    spark = sizes.sparkSession
    cells = hand_off(sizes.groupBy("source", "cell").agg(F.sum("size").alias("cell_size")), scratch_path(spark, "mix-cells"))
    sources = ranked_sources(cells, weights, "mix")
    target, words = _target(water_level(sources, share, epochs), epochs)
    plans = sources.select("source", "source_size", target.alias("target"), words.alias("words"))
    plans = plans.withColumn("repeats", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0).cast("long")))
    plans = plans.withColumn("rest", F.col("words") - F.col("repeats") * F.col("source_size"))
    along = Window.partitionBy("source").orderBy("cell")
    known = cells.withColumn("until", F.sum("cell_size").over(along)).withColumnRenamed("source", "of")
    cut = known.join(plans.select("source", "rest"), F.col("of").eqNullSafe(F.col("source")))
    cut = cut.where((F.col("rest") > 0) & (F.col("rest") < F.col("until")) & (F.col("rest") >= F.col("until") - F.col("cell_size")))
    cut = cut.select("of", F.col("cell").alias("cut"), "cell_size", (F.col("rest") - F.col("until") + F.col("cell_size")).alias("needed"))
    found = plans.join(cut, F.col("source").eqNullSafe(F.col("of")), "left").drop("of", "words", "rest")
    return hand_off(found, scratch_path(spark, "mix-plan"))


def _with_parts(sizes: DataFrame, plans: DataFrame) -> DataFrame:
    """``sizes`` with their source's plan and part: how many words of one more repetition a document takes part with."""
    rows = sizes.join(plans.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    # A share of a document's words, rounded by its draw; never more than all.
    share = F.expr("(size * needed + draw % cell_size) div cell_size")
    part = F.when(F.col("cell") < F.col("cut"), F.col("size")).when(F.col("cell") == F.col("cut"), share)
    return rows.withColumn("part", F.coalesce(part, F.lit(0).cast("long")))


def mixture(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS, seed: str = SEED
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, repeats, part (words of one more), taken."""
    sizes = hand_off(sized(docs, seed), scratch_path(docs.sparkSession, "mix-sizes"))
    rows = _with_parts(sizes, plan(sizes, weights, share, epochs))
    taken = F.col("repeats") * F.col("size") + F.col("part")
    return rows.select("doc_id", "source", "size", "source_size", "target", "repeats", "part", taken.alias("taken"))


def mixed(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS, seed: str = SEED
) -> DataFrame:
    """The mix itself: the rows of ``docs`` once per repetition (numbered from 0), the last one cut after the words it gives."""
    if "repetition" in docs.columns:
        raise ValueError("the mix adds a column named repetition")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = hand_off(sized(docs, seed, own), scratch_path(docs.sparkSession, "mix-rows"))
    rows = _with_parts(kept, plan(kept.drop("row"), weights, share, epochs))
    words = F.concat(F.array_repeat("size", F.col("repeats").cast("int")), F.array("part"))
    rows = rows.select("row", "size", F.posexplode(F.filter(words, lambda n: n > 0)).alias("repetition", "words"))
    text = F.col("row")["text"].cast("string")
    spaced = F.regexp_extract_all(text, F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1))
    first = F.array_join(F.slice(spaced, F.lit(1), F.col("words").cast("int")), "")
    given = F.when(F.col("words") < F.col("size"), first).otherwise(text)
    columns = [(given if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]
    return rows.select(*columns, "repetition")


def op11_mixture(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, size, source_size, target, taken, source, repeats."""
    return mixture(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")
