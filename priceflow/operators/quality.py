"""Quality checks on cleaned prices. Every check gives rows of (check, metric, value, passed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DUPLICATE_KEY = ("date", "market_id", "commodity_id", "price_type")
CRITICAL_COLUMNS = ("date", "market", "commodity", "price", "usd_price")

# The plausible dates, and the share of all rows that may be outliers.
FIRST_DATE, LAST_DATE = "2000-01-01", "2030-12-31"
Z_THRESHOLD = 5.0
OUTLIER_SHARE = "0.01"


class QualityCheckError(Exception):
    """A check failed that the gate does not let pass."""


_DATES = ("min_date", "max_date")
_NEGATIVES = ("negative_prices", "negative_usd_prices")
_MOMENTS = ("rows", "mean", "std")


# Each check folds ``cleaned`` to a few facts, and makes report rows of one row that holds the facts.
# The facts are scalar subqueries: nothing is joined, and each pass over ``cleaned`` runs once.


def _p(fact: str) -> Column:
    return F.col(f"profile.{fact}")


def _profile(cleaned: DataFrame, *wanted: str) -> Column:
    """A scalar subquery with the ``wanted`` facts, all from one pass over the columns they need."""
    value = F.col("price_per_kg").cast("double")
    facts = {
        "rows": F.count("*"),
        "min_date": F.min("date"),
        "max_date": F.max("date"),
        "negative_prices": F.count_if(F.col("price") <= 0),
        "negative_usd_prices": F.count_if(F.col("usd_price") <= 0),
        "mean": F.avg(value),
        "std": F.stddev_samp(value),
    }
    facts |= {f"null_{c}": F.count_if(F.col(c).isNull()) for c in CRITICAL_COLUMNS}
    chosen = F.struct(*[facts[name].alias(name) for name in wanted])
    return cleaned.agg(chosen.alias("profile")).scalar()


def _duplicates(cleaned: DataFrame) -> Column:
    """All members of every group that has the same key, nulls being equal."""
    key = [c for c in DUPLICATE_KEY if c in cleaned.columns]
    repeated = cleaned.groupBy(*key).count().where(F.col("count") > 1)
    return repeated.agg(F.coalesce(F.sum("count"), F.lit(0))).scalar()


def _outliers(cleaned: DataFrame, profile: Column, threshold: float) -> Column:
    """Rows further than ``threshold`` standard deviations from the mean; without a deviation, none."""
    values = cleaned.select(F.col("price_per_kg").cast("double").alias("value"), profile.alias("profile"))
    distance = F.abs(F.col("value") - _p("mean")) / F.nullif(_p("std"), F.lit(0.0))
    return values.agg(F.count_if(distance > threshold)).scalar()


def _row(check: str, metric: str, value: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(metric).alias("metric"),
        value.cast("string").alias("value"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def _not_empty_rows() -> list[Column]:
    return [_row("not_empty", "rows", _p("rows"), _p("rows") > 0)]


def _date_range_rows(first: str, last: str) -> list[Column]:
    inside = (_p("min_date") >= F.lit(first).cast("date")) & (_p("max_date") <= F.lit(last).cast("date"))
    return [_row("date_range", m, _p(m), inside) for m in _DATES]


def _positive_rows() -> list[Column]:
    none = (_p(_NEGATIVES[0]) == 0) & (_p(_NEGATIVES[1]) == 0)
    return [_row("positive_prices", m, _p(m), none) for m in _NEGATIVES]


def _null_metrics(cleaned: DataFrame) -> list[str]:
    return [f"null_{c}" for c in CRITICAL_COLUMNS if c in cleaned.columns]


def _null_rows(metrics: list[str]) -> list[Column]:
    none = F.lit(True)
    for m in metrics:
        none = none & (_p(m) == 0)
    return [_row("null_critical", m, _p(m), none) for m in metrics]


def _duplicate_rows() -> list[Column]:
    return [_row("duplicate_keys", "duplicates", F.col("duplicates"), F.col("duplicates") == 0)]


def _outlier_rows() -> list[Column]:
    few = F.col("outliers") < _p("rows") * F.lit(OUTLIER_SHARE).cast("decimal(3,2)")
    return [_row("price_outliers", "outliers", F.col("outliers"), few)]


def _report(cleaned: DataFrame, rows: list[Column], **facts: Column) -> DataFrame:
    held = cleaned.sparkSession.range(1).select(*[fact.alias(name) for name, fact in facts.items()])
    return held.select(F.inline(F.array(*rows)))


def check_not_empty(cleaned: DataFrame) -> DataFrame:
    return _report(cleaned, _not_empty_rows(), profile=_profile(cleaned, "rows"))


def check_duplicate_keys(cleaned: DataFrame) -> DataFrame:
    return _report(cleaned, _duplicate_rows(), duplicates=_duplicates(cleaned))


def check_date_range(cleaned: DataFrame, first: str = FIRST_DATE, last: str = LAST_DATE) -> DataFrame:
    return _report(cleaned, _date_range_rows(first, last), profile=_profile(cleaned, *_DATES))


def check_positive_prices(cleaned: DataFrame) -> DataFrame:
    return _report(cleaned, _positive_rows(), profile=_profile(cleaned, *_NEGATIVES))


def check_null_critical(cleaned: DataFrame) -> DataFrame:
    metrics = _null_metrics(cleaned)
    return _report(cleaned, _null_rows(metrics), profile=_profile(cleaned, *metrics))


def check_price_outliers(cleaned: DataFrame, threshold: float = Z_THRESHOLD) -> DataFrame:
    profile = _profile(cleaned, *_MOMENTS)
    outliers = _outliers(cleaned, profile, threshold)
    return _report(cleaned, _outlier_rows(), profile=profile, outliers=outliers)


def quality_report(
    cleaned: DataFrame, first: str = FIRST_DATE, last: str = LAST_DATE, threshold: float = Z_THRESHOLD
) -> DataFrame:
    """All checks, and ``overall``, from three passes over a few columns of ``cleaned``."""
    nulls = _null_metrics(cleaned)
    profile = _profile(cleaned, *_DATES, *_NEGATIVES, *_MOMENTS, *nulls)
    checks = [
        _not_empty_rows(),
        _duplicate_rows(),
        _date_range_rows(first, last),
        _positive_rows(),
        _null_rows(nulls),
        _outlier_rows(),
    ]
    overall = F.lit(True)
    for rows in checks:
        overall = overall & rows[0]["passed"]
    return _report(
        cleaned,
        [*[row for rows in checks for row in rows], _row("overall", "passed", overall, overall)],
        profile=profile,
        duplicates=_duplicates(cleaned),
        outliers=_outliers(cleaned, profile, threshold),
    )


def apply_gate(report: list, gate: str) -> None:
    """``strict`` stops on any failed check, ``critical`` only on an empty batch."""
    if gate not in ("strict", "critical"):
        raise ValueError(f"unknown gate: {gate}")
    blocking = "overall" if gate == "strict" else "not_empty"
    failed = sorted({r["check"] for r in report if not r["passed"]} - {"overall"})
    if any(r["check"] == blocking and not r["passed"] for r in report):
        raise QualityCheckError("quality checks failed: " + ", ".join(failed))
