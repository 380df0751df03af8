"""The whole run: read, keep what is new, clean, check, load."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from priceflow.functions.dates import parse_date
from priceflow.operators.enrich import clean_without_derived, price_per_kg
from priceflow.operators.quality import QualityCheckError, apply_gate, quality_report
from priceflow.operators.strict import clean_strict
from priceflow.plans import strict_queries
from priceflow.plans.load import load_star, mark_broken
from priceflow.schemas import CLEANED, storage_schema
from priceflow.session import hand_off, remove_path, store_table
from priceflow.sources.prices import (
    LONG, RAGGED, WIDE, extract_first, large_numbers, route_ragged, scan_named, scan_text, type_columns, unread_counts, widened,
)
from priceflow.sources.versions import VersionedTables
from priceflow.sources.warehouse import Warehouse


def incremental_filter(
    df: DataFrame, mark: datetime.date | None, date_formats: Sequence[str] = ("iso", "dmy")
) -> DataFrame:
    """Rows dated after ``mark``; rows without a readable date fall out. Without a mark, all rows."""
    if mark is None:
        return df
    date = F.col("date")
    if isinstance(df.schema["date"].dataType, T.StringType):
        date = parse_date(date, date_formats)
    newer = date > F.lit(mark)
    if "year" in df.columns:
        newer = newer & (F.col("year") >= mark.year)
    return df.where(newer)


def store_cleaned(uniform: DataFrame, path: str, mark: bool = False) -> DataFrame:
    """Write the cleaned rows for the steps that share them, gathered by year into files of even
    size: a year that holds most of the rows is spread over as many tasks as it needs.

    ``uniform`` comes from ``clean_without_derived``. The month and prices per kilogram are added behind the shuffle, and with ``mark`` the rules
    that a row breaks, so that the load evaluates them once."""
    gathered = uniform.drop("month").hint("rebalance", "year").withColumn("month", F.month("date"))
    cleaned = price_per_kg(gathered.select(*uniform.columns))
    cleaned = mark_broken(cleaned) if mark else cleaned
    return store_table(cleaned.sortWithinPartitions("year", "date"), path, ["year"]).select(*cleaned.columns)


def run_pipeline(
    spark: SparkSession,
    sources: Sequence[str],
    root: str,
    incremental: bool = True,
    full_reload: bool = False,
    dry_run: bool = False,
    gate: str = "critical",
    load_id: str | None = None,
    on_violation: str = "fail",
    date_formats: tuple[str, ...] = ("iso", "dmy"),
) -> dict:
    """One batch into the warehouse at ``root``, from the first of ``sources`` that can be read to its end.

    The summary names the source, the sources that failed before it, and how many texts of each column
    could not be read as numbers. Files with line breaks inside quotes are read as such (``multi_line_files``); records that
    have too many or too few fields all the same are counted by file (``ragged``) and kept, with a reason, in the table ``broken_records``.

    Rows dated at or before the last load are dropped, also when they are new: the mark is a date.
    ``gate="critical"`` ends the run on an empty batch only, with a status; ``"strict"`` raises when
    any check fails.
    """
    warehouse = Warehouse(spark, root)
    load_id = load_id or uuid4().hex
    work_dir = f"{warehouse.root}/_work/{load_id}"
    summary = {"status": "started", "load_id": load_id}
    try:
        mark = warehouse.high_water_mark() if incremental and not full_reload else None

        def extracted(rows: DataFrame) -> DataFrame:
            """Typed and new rows, and all ragged records: their dates may be those of other fields."""
            typed = type_columns(rows, price=LONG, date_formats=None, coordinate=LONG, unread="unread", beside=WIDE)
            if mark is None:
                return typed
            kept = incremental_filter(typed.where(F.col(RAGGED).isNull()), mark, date_formats)
            return kept.unionByName(typed.where(F.col(RAGGED).isNotNull()))

        source = extract_first(
            spark, sources, lambda rows, name: store_table(extracted(rows), f"{work_dir}/{name}"), row_seq=True, mark_ragged=True
        )
        summary |= {"source": source.path, "source_failures": list(source.failures)}
        raw, broken, found = route_ragged(
            source.rows,
            lambda files: scan_named(spark, files, row_seq=True, multi_line=True, mark_ragged=True),
            lambda rows: hand_off(extracted(rows), f"{work_dir}/raw-multi-line"),
        )
        summary |= found
        if found["ragged"] and not dry_run:
            broken.write.mode("overwrite").parquet(warehouse.path("broken_records", load_id))
        counted = raw.agg(F.count("*").alias("_rows"), *large_numbers(raw).values()).first().asDict()
        summary["rows_extracted"] = counted.pop("_rows")
        summary["unread"] = {r["column_name"]: r["rows"] for r in unread_counts(raw, "unread").collect()}
        raw = widened(raw.drop("unread"), [c for c, n in counted.items() if n])
        if not summary["rows_extracted"]:
            return summary | {"status": "no_new_data"}

        cleaned = store_cleaned(clean_without_derived(raw, work_dir, date_formats), f"{work_dir}/cleaned", mark=True)
        summary["rows_cleaned"] = cleaned.count()

        report = quality_report(cleaned).collect()
        summary["quality_report"] = [r.asDict() for r in report]
        try:
            apply_gate(report, gate)
        except QualityCheckError as failure:
            if gate == "strict":
                raise
            return summary | {"status": "quality_check_failed", "failure": str(failure)}

        if dry_run:
            return summary | {"status": "dry_run_complete"}
        summary["load"] = load_star(cleaned, warehouse, work_dir, load_id, full_reload, on_violation, incremental)
        return summary | {"status": "success"}
    finally:
        remove_path(spark, work_dir)


def run_strict(
    spark: SparkSession, sources: Sequence[str], root: str, date_formats: tuple[str, ...] = ("iso", "dmy")
) -> dict:
    """The strict pipeline as one job: raw, cleaned and both aggregate tables of ``VersionedTables(spark, root)``, replaced
    together at the end. A run that fails before leaves all four as they were.

    Aggregates are stored without the order of their queries; readers that need one name it. The summary counts the
    texts that could not be read, which the strict cleaning drops with their rows.
    """
    tables = VersionedTables(spark, root)
    version = tables.new_version()

    def typed(rows: DataFrame, _: str) -> DataFrame:
        return version.write("raw", type_columns(rows, date_formats=date_formats, unread="unread"))

    source = extract_first(spark, sources, typed, scan=scan_text)
    raw = source.rows
    unread = {r["column_name"]: r["rows"] for r in unread_counts(raw, "unread").collect()}
    cleaned = version.write("cleaned", clean_strict(raw))
    declared = [(f.name, f.dataType) for f in storage_schema(CLEANED).fields]
    if [(f.name, f.dataType) for f in cleaned.schema.fields] != declared:
        raise TypeError(f"the cleaned table is not as declared: {cleaned.schema.simpleString()}")
    for name in ("avg_price_per_commodity_year", "avg_price_per_category"):
        version.write(name, getattr(strict_queries, name)(cleaned, ordered=False))
    summary = {
        "source": source.path,
        "source_failures": list(source.failures),
        "unread": unread,
        "rows_raw": raw.count(),
        "rows_cleaned": cleaned.count(),
    }
    tables.publish(version)
    return summary
