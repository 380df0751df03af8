"""Secret scans: known forms, and a battery of randomness tests on key-like strings.

Only DataFrame functions are used, so all of it runs in the JVM.

Method
1. Known forms (``BASE``) are found in every whole text; their spans always stay.
2. Candidates are runs of ``[A-Za-z0-9+/_-]`` of at least ``MIN_LENGTH`` characters with a letter and a digit.
   The alphabet is inferred from the characters: hex, base 32, base 36, base 62, base 64 or its URL form.
3. Three tests ask whether a candidate may be drawn uniformly from its alphabet: chi-squared of the character
   counts, the number of runs above and below the alphabet's middle, and lag-one serial correlation.
   Fisher's method combines their p-values; strings of words or counters give values near zero.
4. False discovery control, per alphabet and length band, over all different candidates: random strings have uniform
   p-values, so those over one half tell how many random ones there are. A threshold is set as low
   as it can be with at most ``FALSE_SHARE`` of the strings above it in excess of the random ones expected there. From
   ``LEAST_P`` on, an excess within ``NOISE`` standard deviations of what random strings alone would show raises no
   threshold, so a few keys among any number of words are judged as keys without words are. Short
   bands, where words pass the tests more easily, so get a stricter threshold, of one half at most.
5. Candidates over their band's threshold that no base span overlaps are added as kind ``random``.

Positions are code points; no text is shuffled, only candidates' p-values in bins and short spans.

Inputs out of the ordinary
- Null or empty text: no span, the digest of the empty string. Null doc_id: reported like others.
- Repeated rows are reported each; a string counts once in its band, however often it is copied. Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from priceflow.session import hand_off, scratch_path

MIN_LENGTH = 20
MIN_ASSIGNED = 6
FALSE_SHARE = 0.05
BINS = 50
#: From LEAST_P on, an excess over the random strings expected must be over NOISE standard deviations to count.
NOISE = 3.0
LEAST_P = 0.05
MOST_LENGTH_BAND = 6


def _either_case(text: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)


#: The known forms, in the order of kinds. Hex and access runs are maximal, so a least length
#: in the pattern equals dropping short matches; assignments are dropped by the length of group 2.
_NAMES = "|".join(_either_case(x) for x in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}"

#: Alphabets in the order of their symbols' values, smallest first.
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {
    "hex": (_DIGITS + "abcdef", "^[0-9a-f]+$"),
    "hex_upper": (_DIGITS + "ABCDEF", "^[0-9A-F]+$"),
    "base32": (_UPPER + "234567", "^[A-Z2-7]+$"),
    "base36": (_DIGITS + _LOWER, "^[0-9a-z]+$"),
    "base36_upper": (_DIGITS + _UPPER, "^[0-9A-Z]+$"),
    "base62": (_DIGITS + _UPPER + _LOWER, "^[0-9A-Za-z]+$"),
    "base64": (_UPPER + _LOWER + _DIGITS + "+/", "^[A-Za-z0-9+/]+$"),
    "base64_url": (_UPPER + _LOWER + _DIGITS + "-_", "^[A-Za-z0-9_-]+$"),
}


SPANS = "array<struct<start:int,rank:int,kind:string,end:int,found:string,part:string>>"


def spans(text: Column, pattern: str, kind: str, rank: int, group: int | None = None) -> Column:
    """Leftmost non-overlapping matches: array of (start, rank, kind, end, found, group), null without a match.

    The texts between matches and the matches alternate, so their lengths give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)
    entries = F.arrays_zip(found.alias("found"), groups.alias("part"), F.slice(between, 1, F.size(found)).alias("gap"))

    def place(state: Column, entry: Column) -> Column:
        start = state["at"] + F.length(entry["gap"])
        end = start + F.length(entry["found"])
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), entry["found"].alias("found"), entry["part"].alias("part"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(one)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), _none().alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(entries, start, place)["spans"])


def _none() -> Column:
    return F.array().cast(SPANS)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, base (kept spans of the known forms, in order) and candidates of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found = [
        F.filter(F.coalesce(spans(F.col("text"), ASSIGN, "assign", 0, 2), _none()), lambda s: F.length(s["part"]) >= MIN_ASSIGNED),
        F.coalesce(spans(F.col("text"), BASE["access"], "access", 1), _none()),
        F.coalesce(spans(F.col("text"), BASE["hex"], "hex", 2), _none()),
    ]
    likely = F.filter(
        F.coalesce(spans(F.col("text"), CANDIDATE, "random", 3), _none()),
        lambda s: s["found"].rlike("[0-9]") & s["found"].rlike("[A-Za-z]"),
    )
    return rows.select("doc_id", F.array_sort(F.concat(*found)).alias("base"), likely.alias("candidates"))


def upper_tail(z: Column) -> Column:
    """The chance of a standard normal value above ``z``, by a logistic approximation (error below 2e-4)."""
    return 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), 1.5976 * z + 0.070565992 * z * z * z))))


def tested(candidates: DataFrame) -> DataFrame:
    """``candidates`` (with found) with alphabet, size, length band, and the tests' p-values and their combination."""
    alphabet = reduce(lambda rest, kind: F.when(F.col("found").rlike(ALPHABETS[kind][1]), kind).otherwise(rest), reversed(ALPHABETS), F.lit("mixed"))
    order = F.create_map(*(F.lit(x) for kind, (symbols, _) in ALPHABETS.items() for x in (kind, symbols)))
    rows = candidates.withColumn("alphabet", alphabet)
    everything = F.lit(ALPHABETS["base64"][0] + "-_")
    rows = rows.withColumn("symbols", F.coalesce(order[F.col("alphabet")], everything))
    rows = rows.withColumn("n", F.length("found").cast("double")).withColumn("size", F.length("symbols").cast("double"))
    rows = rows.withColumn("characters", F.split("found", ""))
    rows = rows.withColumn("values", F.expr("transform(characters, c -> cast(locate(c, symbols) - 1 as double))"))
    total = lambda array: F.aggregate(array, F.lit(0.0), lambda a, b: a + b)
    # Chi-squared of the counts, with its exact mean and variance under uniformity.
    squares = F.expr("aggregate(array_distinct(characters), 0D, (a, c) -> a + pow(n - length(replace(found, c, '')), 2))")
    rows = rows.withColumn("chi", squares * F.col("size") / F.col("n") - F.col("n"))
    spread = F.sqrt(2 * (F.col("size") - 1) * (F.col("n") - 1) / F.col("n"))
    rows = rows.withColumn("p_uniform", upper_tail((F.col("chi") - (F.col("size") - 1)) / spread))
    # Runs above and below the middle of the alphabet.
    rows = rows.withColumn("high", F.transform("values", lambda v: (v >= F.col("size") / 2).cast("double")))
    rows = rows.withColumn("n_high", total("high"))
    changes = F.expr("aggregate(sequence(1, size(high) - 1), 0D, (a, i) -> a + if(high[i] <> high[i - 1], 1D, 0D))")
    product = 2 * F.col("n_high") * (F.col("n") - F.col("n_high"))
    mean = product / F.col("n") + 1
    variance = (mean - 1) * (mean - 2) / (F.col("n") - 1)
    runs_z = (changes + 1 - mean) / F.sqrt(F.greatest(variance, F.lit(1e-9)))
    rows = rows.withColumn("p_runs", F.when(product > 0, 2 * upper_tail(F.abs(runs_z))).otherwise(F.lit(1e-9)))
    # Correlation of each symbol's value with the next one's.
    rows = rows.withColumn("mean", total("values") / F.col("n"))
    rows = rows.withColumn("off", F.transform("values", lambda v: v - F.col("mean")))
    power = total(F.transform("off", lambda v: v * v))
    lagged = F.expr("aggregate(sequence(1, size(off) - 1), 0D, (a, i) -> a + off[i] * off[i - 1])")
    serial_z = (lagged / F.greatest(power, F.lit(1e-9)) + 1 / F.col("n")) * F.sqrt("n")
    rows = rows.withColumn("p_serial", F.when(power > 0, 2 * upper_tail(F.abs(serial_z))).otherwise(F.lit(1e-9)))
    bounded = lambda name: F.greatest(F.lit(1e-12), F.least(F.lit(1.0), F.col(name)))
    half = -(F.log(bounded("p_uniform")) + F.log(bounded("p_runs")) + F.log(bounded("p_serial")))
    rows = rows.withColumn("half", half).withColumn("p", F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2))
    band = F.least(F.floor(F.log2(F.col("n") / MIN_LENGTH) * 2), F.lit(MOST_LENGTH_BAND)).cast("int")
    return rows.withColumn("band", band).drop("symbols", "characters", "values", "chi", "high", "n_high", "mean", "off", "half", "size", "n")


def thresholds(tests: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """The least p of a discovery per alphabet and band: alphabet, band, least_p. At most 9 * 7 rows."""
    bin_ = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")
    different = tests.select("alphabet", "band", bin_, F.xxhash64("found").alias("string")).distinct()
    counts = different.groupBy("alphabet", "band", "bin").agg(F.count("*").alias("n")).groupBy("alphabet", "band").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("bins")
    )
    at = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.coalesce(F.col("bins")[b.cast("int")], F.lit(0)).cast("double"))
    counts = counts.withColumn("at", at)
    above = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.aggregate(F.slice("at", b + 1, F.lit(BINS)), F.lit(0.0), lambda a, x: a + x))
    counts = counts.withColumn("above", above)
    random = 2 * F.get("above", F.lit(BINS // 2))

    def allowed(b: Column, deviations: float) -> Column:
        seen = F.get("above", b)
        # With random strings alone, the excess has mean 0 and variance seen * (1 - 2 * b / BINS).
        noise = deviations * F.sqrt(seen * F.greatest(F.lit(0.0), 1 - 2 * b / BINS))
        return (seen > 0) & (seen - random * (1 - b / BINS) <= false_share * seen + noise)

    def lowest(first: int, deviations: float) -> Column:
        bins = F.filter(F.sequence(F.lit(first), F.lit(BINS - 1)), lambda b: allowed(b, deviations))
        # One half is always allowed if any string lies above it.
        return F.coalesce(F.array_min(bins), F.lit(BINS // 2)) / BINS

    clear = F.greatest(lowest(0, 0.0), F.lit(1 / BINS))
    in_doubt = F.greatest(lowest(int(LEAST_P * BINS), NOISE), F.lit(LEAST_P))
    return counts.select("alphabet", "band", F.least(clear, in_doubt).alias("least_p"))


def _joined(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base and all spans (in order) of each row of ``docs``."""
    spark = docs.sparkSession
    rows = scanned(docs).withColumn("row", F.monotonically_increasing_id())
    rows = hand_off(rows, scratch_path(spark, "secrets"))
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    free = rows.where(F.size("candidates") > 0).select("row", F.explode(F.filter("candidates", apart)).alias("span"))
    tests = hand_off(tested(free.withColumn("found", F.col("span.found"))), scratch_path(spark, "randomness"))
    limits = thresholds(tests).withColumnsRenamed({"alphabet": "in_alphabet", "band": "in_band"})
    judged = tests.join(F.broadcast(limits), (F.col("alphabet") == F.col("in_alphabet")) & (F.col("band") == F.col("in_band")))
    added = judged.where("p >= least_p").groupBy("row").agg(F.collect_list("span").alias("added"))
    joined = rows.join(added.withColumnRenamed("row", "of"), F.col("row") == F.col("of"), "left")
    every = F.array_sort(F.concat("base", F.coalesce("added", _none())))
    return joined.select("doc_id", "base", every.alias("spans"))


def op9_secrets(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    found = secrets(docs.select("doc_id", "text"))
    return found.select("doc_id", *map(number, BASE), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
