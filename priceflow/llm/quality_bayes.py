"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes.

Method
1. Each whole text gives a dozen numbers (``FEATURES``). A logistic regression, fitted on at most
   ``FIT_ROWS`` labelled documents, turns them into log odds of good quality: the document's evidence.
2. Grouped sums of the documents' probabilities give the mean of every host and of every path on it. All
   documents count.
3. How far means of hosts differ beyond chance, over all hosts, says how many documents the global prior is worth; likewise
   for paths within hosts. A host's posterior is its own mean shrunk towards the global one by that weight,
   a path's is shrunk towards its host's, so sparse sites take over what is known above them.
4. A document's own share is taken out of its site's sums. Its score adds the site's log odds, relative to
   the global ones, to its evidence; it is kept at a probability of at least one half.

Sums per path are pre-aggregated where the documents are, and joined back as one row per path, so a host
with a third of all documents costs no more than others. The driver sees the labelled rows of the fit and
a few global sums.

Inputs out of the ordinary
- Null, empty or blank text: no evidence of quality, score 0, rejected. It counts in no mean.
- Null host or path: a host or path of its own.
- No labels, or labels of one class only: no evidence, every document with words scores one half and is kept.
- Repeated labels of one id: their least; labels without id or value are left out. Repeated documents are scored alike.
- Columns other than id, text, host and path are passed through by ``good_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from priceflow.llm.text import map_batches, shingle_hashes, word_runs
from priceflow.session import hand_off, scratch_path

FIT_ROWS = 20_000
RIDGE = 1e-3
MOST_ODDS = 12.0

#: What is measured of each text; shares are of its bytes, words or windows.
FEATURES = [
    "log_words", "word_length", "distinct_words", "commonest_word", "word_repeats", "distinct_triples",
    "upper", "digits", "symbols", "other_punctuation", "beyond_ascii", "line_breaks", "long_words",
]

_CLASS = np.zeros(256, np.int64)
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[ord(c) for c in "#*$%&|<>=_~^@\\{}[]!"]] = 3
_CLASS[[ord(c) for c in ".,;:?\"'()-/"]] = 4
_CLASS[128:] = 5
_CLASS[ord("\n")] = 6


def text_features(data: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> list[float]:
    """``FEATURES`` of a text with at least one word: its bytes, and its words' hashes and lengths."""
    n, size = len(words), len(data)
    counts = np.unique(words, return_counts=True)[1]
    triples = shingle_hashes(words, 3)
    classes = np.bincount(_CLASS[data], minlength=7) / size
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        len(counts) / n,
        float(counts.max()) / n,
        float((words[1:] == words[:-1]).sum()) / n,
        len(np.unique(triples)) / len(triples) if len(triples) else 1.0,
        *classes[1:7].tolist(),
        float((lengths > 24).sum()) / n,
    ]


def features(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, row_key, host, path, n_words, and a column for each of ``FEATURES`` (null without words)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id, host, path = F.col("doc_id").cast("long"), host.cast("string"), path.cast("string")
    rows = docs.select(doc_id.alias("doc_id"), row_key(doc_id, text, host, path).alias("row_key"), host.alias("host"), path.alias("path"), text.alias("text"))

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(4)
        counts: list[int] = []
        table: list[list[float] | None] = []
        for first, before, words, starts, ends in word_runs(texts):
            for i, (a, b) in enumerate(zip(before, before[1:])):
                counts.append(int(b - a))
                data = np.frombuffer(texts[first + i].as_buffer(), np.uint8) if b > a else None
                table.append(None if data is None else text_features(data, words[a:b], ends[a:b] - starts[a:b]))
        columns = list(zip(*((None,) * len(FEATURES) if row is None else row for row in table))) or [()] * len(FEATURES)
        yield pa.record_batch(
            [*batch.columns[:4], pa.array(counts, pa.int64()), *(pa.array(c, pa.float64()) for c in columns)],
            ["doc_id", "row_key", "host", "path", "n_words", *FEATURES],
        )

    schema = "doc_id long, row_key long, host string, path string, n_words long, "
    return map_batches(rows, measure, schema + ", ".join(f"{name} double" for name in FEATURES))


def row_key(doc_id: Column, text: Column, host: Column, path: Column) -> Column:
    """Rows with one key are equal in all that the score depends on."""
    return F.xxhash64(doc_id, text, F.coalesce(host, F.lit("\0")), F.coalesce(path, F.lit("\0")))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton steps, on standardised columns with a small penalty."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge * len(x))
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / spread, float(w[-1] - (w[:-1] * mean / spread).sum())


def evidence(measured: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Column:
    """Log odds of good quality, fitted on the labelled rows with the ``fit_rows`` smallest hashed ids."""
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    chosen = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    known = measured.where("n_words > 0").join(chosen, "doc_id").dropDuplicates(["doc_id", "row_key"])
    rows = known.select("quality", *FEATURES).orderBy("row_key").limit(2 * fit_rows).collect()
    y = np.array([r["quality"] > 0 for r in rows], float)
    if not 0 < y.sum() < len(y):
        return F.lit(0.0)
    weights, intercept = logistic_fit(np.array([r[1:] for r in rows], float), y)
    odds = sum((F.col(name) * float(w) for name, w in zip(FEATURES, weights)), F.lit(intercept))
    return F.greatest(F.lit(-MOST_ODDS), F.least(F.lit(MOST_ODDS), odds))


def _sums(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))


def prior_weight(groups: DataFrame, mean: str, n: float, within: float, n_groups: int) -> float:
    """How many documents the prior of ``groups`` (columns n, s and ``mean``) is worth, by the method of moments."""
    if n_groups < 2 or within <= 0:
        return 1e9
    apart = F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(mean), F.lit(2)))
    row = groups.agg(apart.alias("apart"), F.sum(F.col("n") * F.col("n")).alias("squares")).first()
    between = (row["apart"] - (n_groups - 1) * within) / max(n - row["squares"] / n, 1e-9)
    return min(1e9, within / between) if between > 0 else 1e9


def _log_odds(p: Column) -> Column:
    bounded = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(bounded / (1 - bounded))


def scores(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, row_key, host, path, evidence, site (its log odds relative to the global ones), score, kept."""
    spark = docs.sparkSession
    measured = hand_off(features(docs, host, path), scratch_path(spark, "features"))
    odds = evidence(measured, labels)
    judged = measured.select("doc_id", "row_key", "host", "path", "n_words", odds.alias("evidence"))
    judged = judged.withColumn("p", F.when(F.col("n_words") > 0, 1 / (1 + F.exp(-F.col("evidence")))))
    per_path = judged.where("p IS NOT NULL").groupBy("host", "path").agg(
        F.count("*").cast("double").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")
    )
    per_path = hand_off(per_path, scratch_path(spark, "paths"))
    per_host = _sums(per_path, "host")
    total = _sums(per_path).withColumn("paths", F.lit(per_path.count())).withColumn("hosts", F.lit(per_host.count())).first()
    if not total["n"]:
        return judged.select("doc_id", "row_key", "host", "path", "evidence", F.lit(0.0).alias("site"), F.lit(0.0).alias("score"), F.lit(False).alias("kept"))
    n, mean = total["n"], total["s"] / total["n"]
    within = max(total["q"] / n - mean * mean, 0.0)
    host_weight = prior_weight(per_host.withColumn("mean", F.lit(mean)), "mean", n, within, total["hosts"])
    hosts = per_host.select(F.col("host").alias("h"), ((F.col("s") + host_weight * mean) / (F.col("n") + host_weight)).alias("host_mean"))
    paths = per_path.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h", "q")
    path_weight = prior_weight(paths, "host_mean", n, within, total["paths"])

    sites = paths.withColumnsRenamed({"host": "h", "path": "on_path"})
    joined = judged.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("on_path")), "left")
    others = (F.col("s") - F.col("p") + path_weight * F.col("host_mean")) / (F.col("n") - 1 + path_weight)
    site = _log_odds(others) - _log_odds(F.lit(mean))
    scored = joined.withColumn("site", F.coalesce(site, F.lit(0.0)))
    score = F.when(F.col("p").isNull(), 0.0).otherwise(1 / (1 + F.exp(-F.col("evidence") - F.col("site"))))
    scored = scored.withColumn("score", F.round(score, 9))
    return scored.select("doc_id", "row_key", "host", "path", "evidence", "site", "score", (F.col("score") >= 0.5).alias("kept"))


def _site_of(docs: DataFrame) -> tuple[Column, Column]:
    return F.col("source").cast("string"), F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")))


def op1_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, host, path, evidence, site, score and kept of each document; a path is a language on its source."""
    return scores(docs, labels, *_site_of(docs)).drop("row_key")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the classifier rejects."""
    host, path = _site_of(docs)
    rejected = scores(docs, labels, host, path).where("NOT kept").select(F.col("row_key").alias("_rejected")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = row_key(F.col("doc_id").cast("long"), text, host, path)
    return docs.join(rejected, key == rejected["_rejected"], "left_anti")
