from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Accepted spellings of a date: what the text looks like, and its ISO spelling. A cast of that takes less time than a parser
# of patterns. There is no year 0, which the cast would read. A time of day may follow, and is dropped.
_TIME = r"([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?Z?)?$"
DATE_FORMATS = {
    "iso": (r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}" + _TIME, lambda day: day),
    "dmy": (r"^\d{1,2}/\d{1,2}/(?!0000)\d{4}" + _TIME, lambda day: _reversed(day, "/")),
}


def parse_date(text: Column, formats: Sequence[str] = ("iso", "dmy")) -> Column:
    """The date, or null when ``text`` is a date in none of ``formats``."""
    day = F.substring_index(F.substring_index(text, "T", 1), " ", 1)
    return F.coalesce(
        *[
            F.when(text.rlike(shape), spelling(day).try_cast("date"))
            for shape, spelling in (DATE_FORMATS[name] for name in formats)
        ]
    )


def _reversed(day: Column, sign: str) -> Column:
    """``d/M/yyyy`` as ``yyyy-M-d``."""
    middle = F.substring_index(F.substring_index(day, sign, 2), sign, -1)
    return F.concat_ws("-", F.substring_index(day, sign, -1), middle, F.substring_index(day, sign, 1))


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")
