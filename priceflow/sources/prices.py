"""Price observations from CSV text, and the writers that go with them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from priceflow.functions.dates import parse_date
from priceflow.functions.numbers import to_decimal, to_int
from priceflow.schemas import MISSING_TOKENS, RAW

_TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW.names])

# A quote inside a quoted field is written twice.
_CSV = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}

ROW_SEQ = "row_seq"
RAGGED, SOURCE_FILE = "_ragged", "_source_file"


# Wide enough for any price or coordinate that a source may hold; declared widths are checked at the load.
WIDE = (28, 10)

#: Numbers of at most 18 digits are held as longs by Spark and Parquet, wider ones as big integers, which take several times as long. So
#: ``type_columns`` can read the usual numbers in this type and the larger ones of ``WIDE`` beside them, and ``widened`` puts them together.
LONG = (18, 10)
_BESIDE = "_wide_"


def scan_text(
    spark: SparkSession, path: str | list[str], row_seq: bool = False, multi_line: bool = False
) -> DataFrame:
    """The 16 columns by position, as text; an empty field is null. The header line is skipped.

    ``multi_line`` reads line breaks inside quotes; a file is then one task and can't be split.
    """
    lines = spark.read.schema(_TEXT_SCHEMA).options(**_CSV, multiLine=multi_line).csv(path)
    fields = [F.nullif(F.col(c), F.lit("")).alias(c) for c in _TEXT_SCHEMA.names]
    return lines.select(*fields, *_row_seq(row_seq))


def scan_named(
    spark: SparkSession,
    path: str | list[str],
    missing: Sequence[str] = MISSING_TOKENS,
    row_seq: bool = False,
    multi_line: bool = False,
    mark_ragged: bool = False,
) -> DataFrame:
    """The columns that the header names, as text; every spelling in ``missing`` is null.

    All files of ``path`` must have the same header; one that differs fails the query that reads it.
    ``multi_line`` reads line breaks inside quotes; a file is then one task and can't be split. ``mark_ragged`` adds
    ``RAGGED``, the text of a record with more or fewer fields than the header (null of others), and ``SOURCE_FILE``.
    """
    reader = spark.read.options(**_CSV, multiLine=multi_line, enforceSchema=False)
    names = reader.csv(path).columns
    marks = []
    if mark_ragged:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, RAGGED]])
        # All columns are parsed: a parser that skips some does not see that a record is short.
        reader = reader.schema(schema).options(columnNameOfCorruptRecord=RAGGED, columnPruning=False)
        marks = [F.col(RAGGED), F.col("_metadata.file_path").alias(SOURCE_FILE)]
    fields = [F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in names]
    return reader.csv(path).select(*fields, *marks, *_row_seq(row_seq))


def route_ragged(
    plain: DataFrame, reread: Callable[[list[str]], DataFrame], store: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame, dict]:
    """The rows of whole records, the records set apart, and what was found, from a stored scan with ``mark_ragged``.

    A file with ragged records may have line breaks inside quotes, which parts its records. Such files, and no others, are read
    again with ``reread`` (a scan of files with ``multi_line``) and stored by ``store``. Each file keeps the reading that has fewer ragged
    records: an open quote that nobody closes would swallow the records behind it. What is ragged then is set apart with
    its file and a reason. The driver sees one row for each file with ragged records.
    """

    def ragged_by_file(rows: DataFrame) -> dict[str, int]:
        counts = rows.where(F.col(RAGGED).isNotNull()).groupBy(SOURCE_FILE).agg(F.count("*").alias("n"))
        return {r[SOURCE_FILE]: r.n for r in counts.collect()}

    before = ragged_by_file(plain)
    rows, joined = plain, []
    if before:
        again = store(reread(sorted(before)))
        after = ragged_by_file(again)
        joined = sorted(file for file in before if after.get(file, 0) < before[file])
        if joined:
            rows = plain.where(~F.col(SOURCE_FILE).isin(joined)).unionByName(again.where(F.col(SOURCE_FILE).isin(joined)))
    quotes = F.length(RAGGED) - F.length(F.replace(F.col(RAGGED), F.lit('"'), F.lit("")))
    reason = F.when(quotes % 2 == 1, "open quote").otherwise("wrong number of fields")
    apart = rows.where(F.col(RAGGED).isNotNull())
    apart = apart.select(F.col(SOURCE_FILE).alias("file"), reason.alias("reason"), F.col(RAGGED).alias("record"))
    left = ragged_by_file(rows) if before else {}
    found = {"multi_line_files": joined, "ragged": left}
    return rows.where(F.col(RAGGED).isNull()).drop(RAGGED, SOURCE_FILE), apart, found


def ragged_rows(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Rows of (file, keys, ragged): values in the first column, and records with more or fewer fields than the header.

    An open quote, as a line break inside quotes leaves it without ``multi_line``, counts as ragged as well.
    """
    columns = spark.read.options(**_CSV, multiLine=multi_line).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_ragged"]])
    # All columns are parsed: a parser that skips some does not see that a record is short.
    options = _CSV | {"multiLine": multi_line, "columnNameOfCorruptRecord": "_ragged", "columnPruning": False}
    lines = spark.read.schema(schema).options(**options).csv(path)
    by_file = lines.groupBy(F.col("_metadata.file_path").alias("file"))
    return by_file.agg(F.count(f"`{columns[0]}`").alias("keys"), F.count("_ragged").alias("ragged"))


def _row_seq(wanted: bool) -> list:
    """Where a row stood in the source: file, start of the split, then place within the split.

    Spark packs splits into tasks by size, so ``monotonically_increasing_id`` alone follows the
    source order only inside one split.
    """
    if not wanted:
        return []
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return [place.alias(ROW_SEQ)]


def type_columns(
    df: DataFrame,
    price: tuple[int, int] = (8, 2),
    date_formats: Sequence[str] | None = ("iso", "dmy"),
    coordinate: tuple[int, int] = (8, 4),
    unread: str | None = None,
    beside: tuple[int, int] | None = None,
) -> DataFrame:
    """Text to the given types; what does not convert becomes null and the row stays.

    ``date_formats=None`` leaves the date as text, for pipelines that parse it later. ``unread`` names a
    column to add: a map from the columns of the row that have text but no value to that text, null if all have one.
    ``beside`` is a wider type of as many decimals: numbers too large for ``price`` or ``coordinate`` stand in columns of their own, see ``widened``.
    """
    typed, decimals = {}, []
    for field in RAW.fields:
        column = F.col(field.name)
        if field.name not in df.columns:
            continue
        if isinstance(field.dataType, T.IntegerType):
            typed[field.name] = to_int(column)
        elif field.name in ("price", "usdprice"):
            typed[field.name] = to_decimal(column, *price)
            decimals.append(field.name)
        elif isinstance(field.dataType, T.DecimalType):
            typed[field.name] = to_decimal(column, *coordinate)
            decimals.append(field.name)
        elif field.name == "date" and date_formats is not None:
            typed[field.name] = parse_date(column, date_formats)
    if not unread and not beside:
        return df.withColumns(typed)
    # Values are columns of their own first, so that what is unread is found without converting again.
    values = {c: f"_value_{c}" for c in typed}
    known = df.withColumns({values[c]: value for c, value in typed.items()})
    lost = {c: F.col(c).isNotNull() & F.col(v).isNull() for c, v in values.items()}
    large = [f"{_BESIDE}{c}" for c in decimals] if beside else []
    if large:
        known = known.withColumns({f"{_BESIDE}{c}": F.when(lost[c], to_decimal(F.col(c), *beside)) for c in decimals})
        lost |= {c: lost[c] & F.col(f"{_BESIDE}{c}").isNull() for c in decimals}
    texts = [F.when(no, F.struct(F.lit(c).alias("column"), F.col(c).alias("text"))) for c, no in lost.items()]
    entries = F.when(reduce(or_, lost.values()), F.map_from_entries(F.array_compact(F.array(*texts))))
    columns = [F.col(values[c]).alias(c) if c in values else F.col(f"`{c}`") for c in df.columns]
    return known.select(*columns, *large, *([entries.alias(unread)] if unread else []))


def large_numbers(typed: DataFrame) -> dict[str, Column]:
    """How many numbers stand beside each column that ``type_columns`` read with ``beside``."""
    return {c: F.count(f"{_BESIDE}{c}").alias(c) for c in typed.columns if f"{_BESIDE}{c}" in typed.columns}


def widened(typed: DataFrame, large: Sequence[str]) -> DataFrame:
    """The numbers that ``type_columns`` read with ``beside`` in one column each again: in the wider type for the columns in ``large``, and
    in the narrow one for the others, which must have nothing beside them."""
    kept = [c for c in typed.columns if c not in {f"{_BESIDE}{name}" for name in large_numbers(typed)}]
    wider = {c: typed.schema[f"{_BESIDE}{c}"].dataType for c in large}
    return typed.select(
        *[F.coalesce(f"{_BESIDE}{c}", F.col(c).cast(wider[c])).alias(c) if c in wider else F.col(f"`{c}`") for c in kept]
    )


def unread_counts(typed: DataFrame, unread: str) -> DataFrame:
    """Rows of (column_name, rows): how many texts of each column did not convert."""
    return typed.select(F.explode(unread).alias("column_name", "text")).groupBy("column_name").agg(F.count("*").alias("rows"))


def read_raw(spark: SparkSession, path: str, date_formats: Sequence[str] = ("dmy",)) -> DataFrame:
    """Scan by position and type: the rows of the raw table."""
    return type_columns(scan_text(spark, path), date_formats=date_formats)


@dataclass(frozen=True)
class Source:
    """An opened source: its rows, where they come from, and what was tried before."""

    rows: DataFrame
    path: str
    failures: tuple[str, ...]


def open_first(
    spark: SparkSession,
    paths: Sequence[str],
    scan: Callable[..., DataFrame] = scan_named,
    **options,
) -> Source:
    """The first of ``paths`` that is there; the later ones are fallbacks.

    Only a path that is missing, or a store that can't be reached, leads on to the next one. Everything else,
    such as a wrong option or a missing permission, is raised.
    """
    return _first_that(paths, lambda path: scan(spark, path, **options), _is_absent)


def extract_first(
    spark: SparkSession,
    paths: Sequence[str],
    store: Callable[[DataFrame, str], DataFrame],
    scan: Callable[..., DataFrame] = scan_named,
    **options,
) -> Source:
    """The first of ``paths`` that can be read to its end, with the rows that ``store`` gives back.

    ``store`` writes the rows of a source to a folder of the given name, a new one for each source, and reads them back. So a
    source with a file that is damaged or gone, or whose store fails on the way, leads on to the next one as well, and none of
    its rows stay in the result. A file with another header, or a missing permission, is raised.
    """

    def stored(path: str) -> DataFrame:
        return store(scan(spark, path, **options), f"source-{uuid4().hex}")

    return _first_that(paths, stored, lambda failure: _is_absent(failure) or _is_unreadable(spark, failure))


def _first_that(paths: Sequence[str], read: Callable[[str], DataFrame], leads_on: Callable[[Exception], bool]) -> Source:
    failures: list[str] = []
    for path in paths:
        try:
            return Source(read(path), path, tuple(failures))
        except (AnalysisException, Py4JJavaError, IllegalArgumentException) as failure:
            if not leads_on(failure):
                raise
            failures.append(f"{path}: {_reason(failure)}")
    raise FileNotFoundError("no price source can be read: " + "; ".join(failures))


def _causes(failure: Exception) -> Iterator:
    """The Java exception and those that caused it, the outermost first."""
    cause = failure.java_exception if isinstance(failure, Py4JJavaError) else None
    while cause is not None:
        yield cause
        cause = cause.getCause()


def _reason(failure: Exception) -> str:
    causes = [str(cause.getMessage()).splitlines()[0] for cause in _causes(failure)]
    return ": ".join(causes) or str(failure).splitlines()[0]


def _is_unreadable(spark: SparkSession, failure: Exception) -> bool:
    """Whether a task failed to read a file, for another reason than a header or a permission."""
    kind = spark._jvm.java.lang.Class.forName
    causes = list(_causes(failure))
    for outer, cause in zip(causes, causes[1:]):
        if "FAILED_READ_FILE" in str(outer.getMessage()) and kind("java.io.IOException").isInstance(cause):
            return "AccessControlException" not in cause.getClass().getName()
    return False


_ABSENT = (
    "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FileNotFoundException", "UnknownHostException", "ConnectException",
    "SocketTimeoutException", "NoRouteToHostException", "UnsupportedFileSystemException", "No FileSystem for scheme",
)


def _is_absent(failure: Exception) -> bool:
    return any(sign in str(failure) for sign in _ABSENT)


def first_readable(
    spark: SparkSession,
    paths: Sequence[str],
    scan: Callable[..., DataFrame] = scan_named,
    **options,
) -> DataFrame:
    """The rows of ``open_first``."""
    return open_first(spark, paths, scan, **options).rows


#: Compressed text can't be split, so its files are kept this small: a file is one task of the reader.
COMPRESSED_ROWS = 1 << 20


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """CSV with a header, text exactly as it is; the writer would trim it by default. Compressed files hold at most
    ``COMPRESSED_ROWS`` records each."""
    limit = {} if compression == "none" else {"maxRecordsPerFile": COMPRESSED_ROWS}
    (
        df.write.mode(mode)
        .options(**_CSV, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression, **limit)
        .csv(path)
    )


def replace_table(df: DataFrame, path: str) -> None:
    """Full replace; running it again gives the same table. ``df`` must not read ``path``."""
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Plain append, without a check for rows that are there already."""
    df.write.mode("append").parquet(path)
