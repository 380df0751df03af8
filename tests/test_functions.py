from __future__ import annotations

import datetime
import random
from decimal import Decimal

from pyspark.sql import functions as F

from priceflow.functions.dates import month_start, parse_date
from priceflow.functions.numbers import exact_avg, to_decimal, to_double, to_int
from priceflow.functions.text import strip, title_case


def applied(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_title_case_of_names(spark):
    names = ["maize (white, dry)", "murang'a", "ÉONI-x 1st", "aß中b", "ªbc dªe", "", None, "3rd AVE", "o'neil  mcDONALD"]
    expected = [None if n is None else n.title() for n in names]
    assert applied(spark, names, title_case) == expected


def test_strip_and_title_case_are_those_of_python(spark):
    """On random texts. Left out is a capital sigma: before an inner point or apostrophe, Python does
    not take it for the end of a word."""
    draw = random.Random(1)
    alphabet = "aBzé Ñσ1'(-.,ßøЖж中\t "
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(13))) for _ in range(5000)]
    assert applied(spark, texts, strip) == [t.strip() for t in texts]
    assert applied(spark, texts, title_case) == [t.title() for t in texts]


def test_strip_covers_all_white_space(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert applied(spark, [s + "x" + s for s in spaces], strip) == ["x"] * len(spaces)


def test_parse_date(spark):
    day = datetime.date(2015, 1, 5)
    texts = ["2015-01-05", "05/01/2015", "5/1/2015", "n/a", "2015-02-30", "31/02/2015", None, "20150105", ""]
    assert applied(spark, texts, parse_date) == [day, day, day] + [None] * 6
    assert applied(spark, texts[:2], lambda c: parse_date(c, ("dmy",))) == [None, day]
    assert applied(spark, ["2015-01-05"], lambda c: month_start(parse_date(c))) == [datetime.date(2015, 1, 1)]


def test_numbers_from_text(spark):
    assert applied(spark, ["12", "1854.0", "12.5", "x", None, " 7 "], to_int) == [12, 1854, None, None, None, 7]
    assert applied(spark, ["1.5", "1e3", "1d", "2F", "NaN", "x", None], to_double) == [1.5, 1000.0] + [None] * 5
    assert applied(spark, ["999999.99", "1000000.00", "0.005"], lambda c: to_decimal(c, 8, 2)) == [
        Decimal("999999.99"), None, Decimal("0.01")
    ]


def test_plain_integers_take_no_decimal(spark):
    texts = ["12", " 7 ", "+5", "1.5", "1.", "12.0", "1e3", "99999999999", "-2147483648", "", "x", None]
    assert applied(spark, texts, to_int) == [12, 7, 5, None, 1, 12, 1000, None, -2147483648, None, None, None]
    plan = spark.createDataFrame([("1",)], "v string").select(to_int(F.col("v")))._jdf.queryExecution().toString()
    assert "coalesce(try_cast(v" in plan


def test_dates_are_read_without_a_parser_of_patterns(spark):
    """The same dates as by patterns, also at the edges of months and years."""
    edges = ["29/02/2020", "29/02/2021", "2020-2-9", "1/13/2020", "0/1/2020", "2020-00-10", "0000-01-01", "1/1/0000",
             "9999-12-31", "31/12/0001", "2020-01-01T10:30", "1/1/2020 10:30:15.5", "2020-01-01 x", "01-02-2020", "2020/1/1"]
    d = datetime.date
    expected = [d(2020, 2, 29), None, d(2020, 2, 9)] + [None] * 5 + [d(9999, 12, 31), d(1, 12, 31), d(2020, 1, 1), d(2020, 1, 1)] + [None] * 3
    assert applied(spark, edges, parse_date) == expected
    rows = spark.createDataFrame([("x",)], "v string").select(parse_date(F.col("v")))
    assert "gettimestamp" not in rows._jdf.queryExecution().executedPlan().toString().lower()


def test_exact_avg_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame(
        [("a", "0.01"), ("a", "0.02"), ("b", "-0.01"), ("b", "-0.02"), ("c", None), ("d", "1.00"), ("d", None)],
        "k string, v string",
    ).withColumn("v", F.col("v").cast("decimal(8,2)"))
    found = {r.k: r.m for r in df.groupBy("k").agg(exact_avg(F.col("v"), 2).alias("m")).collect()}
    assert found == {"a": Decimal("0.02"), "b": Decimal("-0.02"), "c": None, "d": Decimal("1.00")}
