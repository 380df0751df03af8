"""The strict cleaning: a row with any null goes, and so does a repeated row."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, functions as F

from priceflow.functions.dates import parse_date
from priceflow.functions.numbers import to_double, to_int
from priceflow.functions.text import strip
from priceflow.schemas import RAW, STRICT_RENAMES, text_columns
from priceflow.session import bound_splits


def clean_strict(raw: DataFrame) -> DataFrame:
    """Raw table to cleaned table. Copies collapse in the map tasks before they are shuffled, so a
    large group of equal rows costs no more than any other. A map task holds the different rows of its split, so splits are bounded."""
    bound_splits(raw.sparkSession)
    return complete_rows(raw.select(*RAW.names)).withColumnsRenamed(STRICT_RENAMES).distinct()


def clean_strict_typed(text: DataFrame) -> DataFrame:
    """The same from text: also trims, takes the text ``nan`` as missing, compares prices as doubles."""
    columns = {"date": parse_date(F.col("date"))}
    columns |= {c: to_int(F.col(c)) for c in ("market_id", "commodity_id")}
    columns |= {c: to_double(F.col(c)) for c in ("latitude", "longitude", "price", "usdprice")}
    columns |= {c: F.nullif(strip(F.col(c)), F.lit("nan")) for c in text_columns(RAW)}
    # As a row of a generated table the values are computed once: filters can't be moved below it and repeat the conversions.
    typed = text.select(F.inline(F.array(F.struct(*[columns[c].alias(c) for c in RAW.names]))))
    return complete_rows(typed).distinct().withColumnsRenamed(STRICT_RENAMES)


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without a null, as a conjunction that a Parquet scan can use to skip row groups."""
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in df.columns]))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, and in all columns together as ``total``, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns]
    rows.append(F.struct(F.lit("total").alias("column_name"), total.alias("nulls")))
    return counts.select(F.inline(F.array(*rows)))


def rows_with_nulls(df: DataFrame) -> DataFrame:
    return df.where(reduce(or_, [F.col(c).isNull() for c in df.columns]))
