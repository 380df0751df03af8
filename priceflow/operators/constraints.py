"""Declared table constraints as queries: Spark does not enforce them, so they are counted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def not_null(tables: Mapping[str, DataFrame], declared: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of (table_name, column_name, failures) for each declared (table, column); each table is read once."""
    reports = []
    for name in dict.fromkeys(table for table, _ in declared):
        columns = [c for table, c in declared if table == name]
        counts = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        rows = [_failures(name, c, F.col(c)) for c in columns]
        reports.append(counts.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionAll, reports)


def unique(tables: Mapping[str, DataFrame], declared: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of (table_name, column_name, failures): how many values occur more than once."""
    reports = []
    for name, column in declared:
        values = tables[name].where(F.col(column).isNotNull()).groupBy(column).count()
        repeated = values.where(F.col("count") > 1).agg(F.count("*").alias("failures"))
        reports.append(
            repeated.select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "failures")
        )
    return reduce(DataFrame.unionAll, reports)


def _failures(table: str, column: str, count: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), count.alias("failures")
    )


def referential(fact: DataFrame, keys: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of (column_name, orphans): fact rows whose key the dimension does not have.

    The fact is folded to one row per key before it meets the dimension, so neither the size of the
    dimension nor a key that holds many rows matters. A null key refers to nothing and is no orphan.
    """
    reports = []
    for key, dimension in keys.items():
        used = fact.where(F.col(key).isNotNull()).groupBy(key).count()
        lost = used.join(dimension.select(key), key, "left_anti")
        reports.append(
            lost.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("orphans")).select(
                F.lit(key).alias("column_name"), "orphans"
            )
        )
    return reduce(DataFrame.unionAll, reports)


def column_constraints(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of (column_name, rule, violations) for the declared columns of ``df``, in one pass.

    Numbers are checked for whether they fit the declared type, so hand in text or wider types.
    """
    rules = declared_rules(schema, df.columns)
    counts = df.agg(*[F.count_if(broken).alias(f"{name}.{rule}") for name, rule, broken in rules])
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(rule).alias("rule"),
            F.col(f"`{name}.{rule}`").alias("violations"),
        )
        for name, rule, _ in rules
    ]
    return counts.select(F.inline(F.array(*rows)))


def declared_rules(schema: T.StructType, columns: Sequence[str]) -> list[tuple[str, str, Column]]:
    """(column, rule, whether a row breaks it) for those of ``columns`` that the schema declares."""
    fields = [field for field in schema.fields if field.name in columns]
    return [(field.name, rule, broken) for field in fields for rule, broken in _rules(field)]


def _rules(field: T.StructField) -> list[tuple[str, Column]]:
    value = F.col(field.name)
    rules = []
    if not field.nullable:
        rules.append(("not_null", value.isNull()))
    if isinstance(field.dataType, T.VarcharType):
        # No text has more characters than bytes, whose number is known without counting.
        longer = (F.octet_length(value) > field.dataType.length) & (F.char_length(value) > field.dataType.length)
        rules.append(("max_length", longer))
    elif isinstance(field.dataType, (T.DecimalType, T.IntegerType, T.LongType)):
        fits = value.try_cast(field.dataType)
        rules.append(("fits_type", value.isNotNull() & fits.isNull()))
    return rules


def required(schema: T.StructType, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable and f.name not in skip]
