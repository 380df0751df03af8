"""Quality rules: base counts, and divergence of a document's histograms from those of its language.

Only DataFrame functions are used, so all of it runs in the JVM.

Method
1. Base counts of the whole text: words, characters in words, symbols, repeated lines, words in repeated
   three-word windows. Too few words or too many repeated ones fail a document.
2. Two histograms: characters by class (``CLASSES``), and words by the common words of the document's
   language (``COMMON_WORDS``), with all other words in one more bin.
3. The language's references are the sums of these histograms over all documents of the language that do not
   fail the base rules: one grouped sum per language, pre-aggregated where the documents are.
4. The Jensen-Shannon distance (base 2, 0 to 1) of each histogram to its reference must not exceed a limit. Short
   texts say little: below ``MIN_CHARS`` characters or ``MIN_WORDS`` words the distance is not judged.

Windows are compared by 64-bit hashes within one text.

Inputs out of the ordinary
- Null or empty text: no words, so it fails the base rules. Null doc_id: judged like others.
- Null lang is a language of its own. A language without common words, or without a document that passes
  the base rules, is judged by what it has: characters, or nothing.
- Repeated rows are judged alike, though they count twice in the reference. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from priceflow.session import hand_off, scratch_path

WHITE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
BASE_WORDS = 50
BASE_REPEATED_PERCENT = 50
MIN_CHARS = 300
MIN_WORDS = 100
CLASS_LIMIT = 0.3
WORD_LIMIT = 0.3

#: Character classes; the last bin holds what no class has.
CLASSES = ["[a-z]", "[A-Z]", "[0-9]", WHITE, SYMBOLS, "[.,;:?!\"'()-]", r"[^\x00-\x7F]"]
#: Common words by language, none of which has white space or capitals.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on with as be at by this are from".split(),
    "fr": "le la les de des du et en un une que qui dans est pour au sur par pas avec".split(),
    "de": "der die das und in den von zu mit sich auf ist im dem nicht ein eine als auch für".split(),
    "es": "el la los las de del y en un una que por con se para es al lo como su".split(),
}


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the characters of each class.

    Classes have no character in common, so each is counted in what the ones before it leave of the text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    rest, counts = "text", []
    for i, kind in enumerate(CLASSES):
        rows = rows.withColumn(f"rest{i}", F.regexp_replace(rest, f"{kind}+", ""))
        counts.append((F.length(rest) - F.length(f"rest{i}")).cast("long"))
        rest = f"rest{i}"
    rows = rows.withColumn("classes", F.array(*counts)).drop(*(f"rest{i}" for i in range(len(CLASSES))))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    window = lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(3)))
    windows = F.when(F.col("n_words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window))
    rows = rows.withColumn("windows", F.coalesce(windows, F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    entries = F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    rows = rows.withColumn("entries", F.when(repeats, F.sort_array(entries)))
    twice = lambda x, at: (F.get("entries", at - 1)["w"] == x["w"]) | (F.get("entries", at + 1)["w"] == x["w"])
    places = F.transform(F.filter("entries", lambda x, at: F.coalesce(twice(x, at), F.lit(False))), lambda x: x["i"])
    rows = rows.withColumn("places", F.sort_array(places))
    # A window covers its three words, or those up to the next repeated window.
    covered = F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3))))
    n_repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0))
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEATED_PERCENT * F.col("n_words"))
    return rows.select(
        "doc_id",
        "lang",
        "text",
        "n_words",
        (F.length("text") - F.get("classes", F.lit(CLASSES.index(WHITE)))).cast("long").alias("word_chars"),
        F.get("classes", F.lit(CLASSES.index(SYMBOLS))).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeat.cast("long").alias("n_repeat_words"),
        "classes",
    ).withColumn("base_failed", failed)


def histograms(rows: DataFrame, common: dict[str, list[str]]) -> DataFrame:
    """``rows`` with classes and common in place of the text: the counts of each bin."""
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    known = F.create_map(*(F.lit(x) for lang, words in common.items() for x in (lang, words))) if common else F.create_map().cast("map<string,array<string>>")
    # Runs of letters between double spaces; those longer than any common word are left out.
    longest = max((len(w) for words in common.values() for w in words), default=0)
    runs = rf"\p{{L}}{{{longest + 1},}}|[^\p{{L}}]+"
    spaced = F.concat(F.lit("  "), F.regexp_replace(F.lower("text"), runs, "  "), F.lit("  "))
    rows = rows.withColumn("spaced", spaced).withColumn("listed", F.coalesce(known[F.col("lang")], F.array().cast("array<string>")))

    def times(word: Column) -> Column:
        left = F.length(F.replace(F.col("spaced"), F.concat(F.lit(" "), word, F.lit(" ")), F.lit("")))
        return F.floor((F.length("spaced") - left) / (F.length(word) + 2))

    rows = rows.withColumn("common", F.transform("listed", times))
    total = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda a, b: a + b)
    other = lambda name, n: F.concat(name, F.array(F.greatest(F.lit(0).cast("long"), F.col(n) - total(name))))
    return rows.withColumns({"classes": other("classes", "n_chars"), "common": other("common", "n_words")}).drop("spaced", "listed", "text")


def references(rows: DataFrame, most_words: int) -> DataFrame:
    """The summed histograms of each language: lang, class_reference, common_reference."""
    sums = lambda name, n: F.array(*(F.coalesce(F.sum(F.get(name, F.lit(i))), F.lit(0)).cast("double") for i in range(n)))
    passed = rows.where("NOT base_failed").groupBy("lang")
    return passed.agg(sums("classes", len(CLASSES) + 1).alias("class_reference"), sums("common", most_words + 1).alias("common_reference"))


def distance(p: str, q: str) -> Column:
    """The Jensen-Shannon distance of two histograms of shares (``shares``); null if one of them is."""

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    def term(a: Column, b: Column) -> Column:
        a, b = F.coalesce(a, F.lit(0.0)), F.coalesce(b, F.lit(0.0))
        return (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2

    divergence = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(F.lit(0.0), divergence))


def shares(rows: DataFrame, *names: str) -> DataFrame:
    """The named histograms as shares of their sums, null where that is 0."""
    total = lambda name: F.aggregate(name, F.lit(0.0), lambda a, b: a + b)
    rows = rows.withColumns({f"{name}_total": total(name) for name in names})

    def of_all(name: str) -> Column:
        sum_ = F.col(f"{name}_total")
        return F.when(sum_ > 0, F.transform(name, lambda x: x / sum_))

    rows = rows.withColumns({name: of_all(name) for name in names})
    return rows.drop(*(f"{name}_total" for name in names))


def judged(docs: DataFrame, common: dict[str, list[str]] = COMMON_WORDS, class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """The base columns, class_distance, word_distance (null where not judged) and kept."""
    counted = hand_off(histograms(base_counts(docs), common), scratch_path(docs.sparkSession, "histograms"))
    known = references(counted, max((len(w) for w in common.values()), default=0)).withColumnRenamed("lang", "of")
    known = shares(known, "class_reference", "common_reference")
    counted = shares(counted.withColumn("worded", (F.col("n_words") >= MIN_WORDS) & (F.size("common") > 1)), "classes", "common")
    rows = counted.join(known, F.col("lang").eqNullSafe(F.col("of")), "left")
    rows = rows.withColumn("class_distance", F.when(F.col("n_chars") >= MIN_CHARS, distance("classes", "class_reference")))
    rows = rows.withColumn("word_distance", F.when(F.col("worded"), distance("common", "common_reference")))
    far = (F.coalesce("class_distance", F.lit(0.0)) > class_limit) | (F.coalesce("word_distance", F.lit(0.0)) > word_limit)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance",
    )


def op2_rules(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, the base columns, base_failed, kept."""
    return judged(docs.select("doc_id", "lang", "text")).drop("class_distance", "word_distance")
