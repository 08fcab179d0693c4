import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import columns as C


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    "word, flag",
    [("Да", 1), (" да ", 1), ("True", 1), ("TRUE", 1), ("Нет", 0), ("False", 0), ("-", 0), ("", 0),
     (None, 0), ("1", 1), ("0", 0), ("2", 1), ("0.0", 0), ("NaN", 0), ("maybe", 0)],
)
def test_clean_flag(spark, word, flag):
    assert values(spark, [(word,)], "w string", C.clean_flag(F.col("w"))) == [flag]


def test_clean_card(spark):
    rows = [("12",), ("  ",), ("",), (None,), ("x1",), (" 7 ",), ("12.0",)]
    assert values(spark, rows, "c string", C.clean_card(F.col("c"))) == [12, 0, 0, 0, 0, 7, 12]


def test_discount_edges(spark):
    rows = [(80.0, 100.0), (0.0, 0.0), (120.0, 100.0), (-5.0, 100.0), (None, 100.0), (5.0, None)]
    got = values(spark, rows, "p double, b double", C.real_discount(F.col("p"), F.col("b")))
    assert got == pytest.approx([0.2, 0.0, 0.0, 1.0, 0.0, 0.0])


def test_forecast_value(spark):
    rows = [(2.5, 0), (3.5, 0), (-1.0, 0), (2.55, 1), (-0.1, 1), (None, 0)]
    got = values(spark, rows, "p double, w int", C.forecast_value(F.col("p"), F.col("w")))
    assert got == [2.0, 4.0, 0.0, 2.55, 0.0, None]


def test_day_first_date(spark):
    rows = [("03.02.2024",), ("2024-02-03",), ("soon",), (None,)]
    day = dt.date(2024, 2, 3)
    assert values(spark, rows, "d string", C.day_first_date(F.col("d"))) == [day, day, None, None]


def test_log_target(spark):
    got = values(spark, [(-3.0,), (0.0,), (None,)], "y double", C.log_target(F.col("y")))
    assert got == [0.0, 0.0, None]


def test_month_edges(spark):
    parts = C.month_edges(F.col("d"))
    days = [dt.date(2024, 1, n) for n in (1, 5, 6, 14, 16, 17, 25, 29, 31)]
    rows = [(d,) for d in days]
    assert values(spark, rows, "d date", parts["payday"]) == [1, 0, 0, 1, 1, 0, 0, 1, 1]
    assert values(spark, rows, "d date", parts["month_start"]) == [1, 1, 0, 0, 0, 0, 0, 0, 0]
    assert values(spark, rows, "d date", parts["month_end"]) == [0, 0, 0, 0, 0, 0, 1, 1, 1]
