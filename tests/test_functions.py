"""Expression helpers and FIXTURES.md section 3 cases."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions.metrics import error_aggregates, extended_aggregates
from shelfcast.functions.stats import histogram_bin, inverse_normal
from shelfcast.functions.text import lenient_double, normalize_text, pipe_piece_count, text_to_bool
from shelfcast.operators import clean


def test_interpolation_edges(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([None, 1.0, None, None, 4.0, None])], "i int, p double")
    out = df.select("i", clean.linear_interpolate(F.col("p"), F.col("i"), F.col("i"), []).alias("v"))
    assert [r.v for r in out.orderBy("i").collect()] == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_all_null_price(spark):
    df = spark.createDataFrame([(0, None), (1, None)], "i int, p double")
    v = clean.linear_interpolate(F.col("p"), F.col("i"), F.col("i"), [])
    out = df.select("i", v.alias("v")).select(
        "i", "v", clean.first_difference(F.col("v"), F.col("i"), []).alias("d"))
    rows = out.orderBy("i").collect()
    assert [r.v for r in rows] == [None, None] and [r.d for r in rows] == [0.0, 0.0]


def test_text_normalization(spark):
    df = spark.createDataFrame([("  Work  \tDay",), (None,), ("\x1fA\x1c b ",)], "s string")
    assert [r.n for r in df.select(normalize_text("s").alias("n")).collect()] == ["work day", "", "a b"]


def test_lenient_and_bool(spark):
    df = spark.createDataFrame([("1.5", "TRUE"), ("abc", None), (None, "no")], "x string, b string")
    rows = df.select(lenient_double("x").alias("x"), text_to_bool("b").alias("b")).collect()
    assert [r.x for r in rows] == [1.5, None, None]
    assert [r.b for r in rows] == [True, False, False]


def test_pipe_piece_count(spark):
    df = spark.createDataFrame([("",), ("a",), ("a|b|c",), (None,)], "s string")
    assert [r.c for r in df.select(pipe_piece_count("s").alias("c")).collect()] == [0, 1, 3, 0]


def test_metrics_fixture(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 2.2), (3.0, 2.8)], "y double, p double")
    r = df.agg(*error_aggregates("y", "p")).first()
    assert abs(r.mae - 0.1666667) < 1e-6
    assert abs(r.rmse - 0.1732051) < 1e-6
    expect = math.sqrt(sum((math.log1p(a) - math.log1p(b)) ** 2 for a, b in [(1, 1.1), (2, 2.2), (3, 2.8)]) / 3)
    assert abs(r.rmsle - expect) < 1e-12


def test_extended_metrics_constant_truth(spark):
    exact = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, p double").agg(*extended_aggregates("y", "p"))
    assert exact.first().r2 == 1.0
    off = spark.createDataFrame([(2.0, 1.0), (2.0, 2.0)], "y double, p double").agg(*extended_aggregates("y", "p"))
    assert off.first().r2 == 0.0


def test_histogram_bin_closed_last(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    b = df.select(histogram_bin(F.col("x"), F.lit(0.0), F.lit(10.0), 50).alias("b"))
    assert [r.b for r in b.collect()] == [1, 26, 50]


def test_inverse_normal(spark):
    df = spark.createDataFrame([(0.975,), (0.5,), (0.01,)], "p double")
    v = [r.q for r in df.select(inverse_normal(F.col("p")).alias("q")).collect()]
    assert abs(v[0] - 1.959964) < 1e-5 and abs(v[1]) < 1e-12 and abs(v[2] + 2.326348) < 1e-5


def test_calendar_iso_week(spark):
    from shelfcast.functions.calendar import with_calendar
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2017, 3, 31),)], "date date")
    rows = with_calendar(df).orderBy("date").collect()
    assert rows[0].week_of_year == 52 and rows[0].day_of_week == 6 and rows[0].is_weekend == 1
    assert rows[1].is_quarter_end == 1 and rows[1].is_month_end == 1
