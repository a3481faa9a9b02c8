import pytest

from tidemart.operators.joins import exists_in, not_in


@pytest.mark.parametrize(
    "right,expected",
    [
        ([(1,), (1,)], [(2,)]),            # the null key is unknown, so it goes
        ([(1,), (None,)], []),             # one null empties the answer
        ([], [(None,), (1,), (2,)]),       # nothing to be in
        ([(None,)], []),
    ],
)
def test_not_in_follows_sql(spark, rows, right, expected):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    other = spark.createDataFrame(right, "k INT")
    got = rows(not_in(left, "k", other))
    assert got == expected
    left.createOrReplaceTempView("l")
    other.createOrReplaceTempView("r")
    assert rows(spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)")) == got


def test_not_in_with_other_name(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, n STRING")
    right = spark.createDataFrame([(2,)], "other INT")
    assert rows(not_in(left, "k", right, "other")) == [(1, "a")]


def test_exists_in_keeps_rows_once(spark, rows):
    left = spark.createDataFrame([(1,), (2,)], "k INT")
    right = spark.createDataFrame([(1,)] * 5, "k INT")
    assert rows(exists_in(left, "k", right)) == [(1,)]
