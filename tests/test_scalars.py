import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.functions import scalars as s

D = dt.date


def one(spark, ddl, row, *columns):
    return tuple(spark.createDataFrame([row], ddl).select(*columns).first())


def test_mixed_date(spark, rows):
    df = spark.createDataFrame([("2024-02-29",), ("29/02/2024",), ("2023-02-29",), ("2/29/2024",), ("",), (None,)], "d STRING")
    got = [r[0] for r in df.select(s.mixed_date("d")).collect()]
    assert got == [D(2024, 2, 29), D(2024, 2, 29), None, None, None, None]


def test_names_and_shares(spark):
    assert one(spark, "a STRING, b STRING", ("A", None), s.full_name("a", "b")) == ("A ",)
    cells = one(spark, "p DECIMAL(10,2), w DECIMAL(10,2), z DECIMAL(10,2)", (Decimal("1"), Decimal("3"), Decimal("0")),
                s.share_pct(F.col("p"), F.col("w")), s.share_pct(F.col("p"), F.col("z")))
    assert cells == (Decimal("33.33"), None)


def test_ranges(spark, rows):
    df = spark.createDataFrame([(D(2022, 12, 31),), (D(2023, 1, 1),), (D(2023, 12, 31),), (D(2024, 1, 1),)], "d DATE")
    assert rows(df.filter(s.in_year("d", 2023))) == [(D(2023, 1, 1),), (D(2023, 12, 31),)]
    assert rows(df.filter(s.in_month("d", 2023, 12))) == [(D(2023, 12, 31),)]
    near = df.filter(s.within_days("d", F.lit(D(2022, 12, 31)), 1))
    assert rows(near) == [(D(2022, 12, 31),), (D(2023, 1, 1),)]


def test_mean_date(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),)], "d DATE")
    day, at = df.agg(s.mean_day("d"), s.mean_date("d")).first()
    assert day == (D(2024, 1, 1) - D(1970, 1, 1)).days + 0.5 and at == dt.datetime(2024, 1, 1, 12)


def test_times(spark):
    got = one(spark, "m STRING, x STRING, t TIMESTAMP", ("1704067200123", "x", dt.datetime(2024, 1, 1, 0, 0, 5, 900000)),
              s.millis_to_timestamp("m"), s.millis_to_timestamp("x"), s.epoch_second("t"))
    assert got == (dt.datetime(2024, 1, 1, 0, 0, 0, 123000), None, 1704067205)


def test_descending_puts_nulls_last(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v INT")
    assert [r[0] for r in df.orderBy(*s.descending("v")).collect()] == [3, 1, None]
