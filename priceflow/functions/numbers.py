from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    """Null when the text is not a number or does not fit."""
    return text.try_cast(f"decimal({precision},{scale})")


def to_int(text: Column) -> Column:
    """Null when the text is not a whole number; ``1854.0`` is one. Only texts that are no plain integers take the
    way over a wide decimal, which costs several times as much."""
    number = to_decimal(text, 38, 18)
    return F.coalesce(text.try_cast("int"), F.when(number == F.floor(number), number.try_cast("int")))


def to_double(text: Column) -> Column:
    """Null when the text is not a number. Java would also read the suffixes of ``1d`` and ``1f``."""
    number = F.when(~text.rlike(r"[dDfF]\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(number), number)


def exact_avg(value: Column, digits: int) -> Column:
    """Average of a decimal, rounded half away from zero once, at the end.

    Sums are exact decimals, so the result depends neither on the order of the rows nor on how they
    are split into tasks. A sum of ``decimal(8,2)`` runs on longs.
    """
    return F.round(exact_mean(value), digits)


def exact_mean(value: Column) -> Column:
    """The average before rounding, to 20 places or so; null when there is no value."""
    return F.try_divide(F.sum(value), F.count(value))
