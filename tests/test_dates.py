"""Dates in text: shapes, whole-column order of day and month, and texts that are no dates."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillstat.functions import dates
from quillstat.operators import prepare as D
from quillstat.operators import profile as P


@pytest.mark.parametrize("text, month_first, day_first", [
    ("2024-01-05", (2024, 1, 5), None), ("2024/1/5", (2024, 1, 5), None), ("2024-01-05T10:30:00Z", (2024, 1, 5, 10, 30), None),
    ("2024-01-05 10:30", (2024, 1, 5, 10, 30), None), ("1/5/2024", (2024, 1, 5), (2024, 5, 1)), ("31.12.2024", "none", (2024, 12, 31)),
    ("05-Jan-2024", (2024, 1, 5), None), ("5 MAY 2024 9:07", (2024, 5, 5, 9, 7), None), ("September 5, 2024", (2024, 9, 5), None),
    ("2024-01-05 23:59:59.5-03:00", (2024, 1, 5, 23, 59, 59, 500000), None), ("2024-01-05 10:30:00+0530", (2024, 1, 5, 10, 30), None),
    ("2024-02-29", (2024, 2, 29), None), ("2023-02-29", "none", None), ("2024-13-01", "none", None), ("2024-01-05T24:00:00", "none", None),
    ("2024-01/05", "none", None), ("Sept 5 2024", "none", None), ("2024-01-05\n", "none", None), (" 2024-01-05", "none", None),
    ("", "none", None), (None, "none", None), ("5", "none", None), ("2024-01-05 about", "none", None), ("1 " * 100_000, "none", None), ("٢٠٢٤-٠١-٠٥", "none", None),
])
def test_wall_time(spark, text, month_first, day_first):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(dates.wall_time(F.col("t")).alias("m"), dates.wall_time(F.col("t"), True).alias("d")).first()
    want = None if month_first == "none" else datetime(*month_first)
    assert got.m == want and got.d == (datetime(*day_first) if day_first else want)


def typed(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    kind = P.profile(df).first()["semantic_type"]
    first = "t" in dates.day_first_columns(df, ["t"])
    parts = D.date_parts(df, "t", first)
    return kind, [tuple(r) for r in df.select(*[parts[f"t_{p}"] for p in ("year", "month", "day")]).collect()]


def test_column_settles_day_and_month(spark):
    assert typed(spark, ["1/5/2024", "12/31/2024", None]) == ("datetime", [(2024, 1, 5), (2024, 12, 31), (None, None, None)])
    assert typed(spark, ["1/5/2024", "31/12/2024"]) == ("datetime", [(2024, 5, 1), (2024, 12, 31)])
    assert typed(spark, ["1/5/2024", "2/6/2024"])[1] == [(2024, 1, 5), (2024, 2, 6)]          # a tie is read month first
    assert typed(spark, ["12/31/2024", "31/12/2024"])[0] != "datetime"                       # no one order fits


def test_one_layout_a_column(spark):
    assert typed(spark, ["2024-01-05", "2024-01-05 10:00"])[0] != "datetime"
    assert typed(spark, ["2024-01-05 10:00:00", "2024-01-05 10:00:00.25"])[0] == "datetime"   # fractions may be left out
    assert typed(spark, ["2024-01-05 10:00:00+01:00", "2024-07-05 10:00:00-02:30"])[0] == "datetime"
    assert typed(spark, ["May 5, 2024", "June 5, 2024"])[0] == "datetime"
    assert typed(spark, ["2024-01-05", "soon"])[0] != "datetime"
    assert typed(spark, [None, None])[0] == "datetime" and dates.day_first_columns(spark.range(1), []) == set()


def test_preprocess_reads_day_first(spark):
    df = spark.createDataFrame([(float(i), f"{1 + i % 28}/{1 + i % 12}/2024") for i in range(60)], "x double, when string")
    out, _ = D.preprocess(df, P.collect_info(P.profile(df)))
    got = {(r["when_day"], r["when_month"]) for r in out.collect()}
    assert got == {(1 + i % 28, 1 + i % 12) for i in range(60)}


def test_layouts_are_counted_from_one_number_a_value(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-01/05",), ("auguſt 5, 2024",), ("31.12.2024",), (None,)], "t string")
    cut = df.select(dates.pieces(F.col("t")).alias("p"))
    assert cut.schema["p"].dataType.simpleString() == "bigint"
    got = cut.select("p", dates.is_date(F.col("p")).alias("m"), dates.is_date(F.col("p"), True).alias("d")).collect()
    assert [(r.m, r.d) for r in got] == [(True, True), (False, False), (False, False), (False, True), (False, False)]
    assert [r.p is None for r in got] == [False, True, True, False, True]


def test_date_parts_read_a_text_once(spark):
    df = spark.createDataFrame([("1/5/2024",), ("31/12/2024 23:59:59.9999999",)], "t string")
    parts = D.date_parts(df, "t", True)
    out = df.select(*[e.alias(n) for n, e in parts.items()])
    assert [tuple(r) for r in out.collect()] == [(2024, 5, 1), (2025, 1, 1)]    # fractions are rounded to microseconds
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    reading = [line for line in plan.splitlines() if "EvalPython" in line]
    assert len(reading) == 1 and reading[0].count("_day_first_times(") == 1
