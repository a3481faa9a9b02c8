"""Sliced ordering against plain Python, on data with a value held by a third of the rows."""

import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.operators.ordered import neighbour, numbered, ranked, strictly_before, tiles, top_ranks

SLICE = 40  # rows per slice, so that 300 rows need several


def sample_rows(seed, n=300, groups=("a", "b", None)):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        value = 7 if i % 3 == 0 else (None if i % 17 == 0 else rng.randint(-20, 20))
        out.append((i, rng.choice(groups), value, Decimal(rng.randint(0, 500)) / 100))
    rng.shuffle(out)
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "id INT, g STRING, v INT, m DECIMAL(10,2)").repartition(3)


def key(row):
    return (row[2] is None, row[2] if row[2] is not None else 0)


@pytest.mark.parametrize("within", [[], ["g"]])
@pytest.mark.parametrize("seed", [1, 2])
def test_rank_and_sums(spark, within, seed):
    data = sample_rows(seed)
    got = strictly_before(
        frame(spark, data), by=F.col("v"), tie="id", within=within,
        measures={"n": None, "s": F.col("m")}, rows_per_slice=SLICE,
    ).collect()
    assert len(got) == len(data)
    for r in got:
        earlier = [d for d in data if (not within or d[1] == r["g"]) and key(d) < key((0, 0, r["v"]))]
        assert r["n"] == len(earlier)
        assert r["s"] == sum((d[3] for d in earlier), Decimal(0))


@pytest.mark.parametrize("within", [[], ["g"]])
def test_row_numbers(spark, within):
    data = sample_rows(3)
    got = numbered(frame(spark, data), by=-F.col("v"), tie="id", within=within, out="n", rows_per_slice=SLICE).collect()
    for g in {d[1] for d in data} if within else {0}:
        mine = sorted(
            (d for d in data if not within or d[1] == g), key=lambda d: (d[2] is None, -(d[2] or 0), d[0])
        )
        expected = {d[0]: i for i, d in enumerate(mine, 1)}
        assert {r["id"]: r["n"] for r in got if not within or r["g"] == g} == expected


def test_all_rows_equal(spark):
    data = [(i, "a", 5, Decimal(1)) for i in range(200)]
    got = ranked(frame(spark, data), by=F.col("v"), tie="id", out="r", rows_per_slice=10)
    assert [r[0] for r in got.select("r").distinct().collect()] == [1]
    assert got.count() == 200


def test_slices_are_used(spark):
    data = sample_rows(4)
    plan = ranked(frame(spark, data), by=F.col("v"), tie="id", out="r", rows_per_slice=SLICE)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_slice" in text
    assert text.count("SinglePartition") == 1  # the table of slice totals


@pytest.mark.parametrize("step", [-1, 1])
@pytest.mark.parametrize("slice_rows", [SLICE, 1000])
def test_neighbours(spark, step, slice_rows):
    data = sample_rows(5)
    got = neighbour(frame(spark, data), by="v", tie="id", value="m", out="x", step=step, rows_per_slice=slice_rows)
    order = sorted(data, key=lambda d: (*key(d), d[0]))
    for r in got.collect():
        at = next(i for i, d in enumerate(order) if d[0] == r["id"]) + step
        assert r["x"] == (order[at][3] if 0 <= at < len(order) else None)


def test_neighbour_with_null_values(spark):
    data = [(i, "a", i, None if i % 2 else Decimal(i)) for i in range(100)]
    got = neighbour(frame(spark, data), by="v", tie="id", value="m", out="x", step=-1, rows_per_slice=9).collect()
    assert {r["id"]: r["x"] for r in got} == {i: (data[i - 1][3] if i else None) for i in range(100)}


@pytest.mark.parametrize("n,buckets", [(300, 4), (7, 4), (3, 10), (1, 4)])
def test_tiles(spark, n, buckets):
    data = sample_rows(6, n)
    got = tiles(frame(spark, data), by=-F.col("v"), tie="id", buckets=buckets, out="t", rows_per_slice=SLICE).collect()
    order = sorted(data, key=lambda d: (d[2] is None, -(d[2] or 0), d[0]))
    size, larger = divmod(n, buckets)
    expected, start = {}, 0
    for tile in range(1, buckets + 1):
        width = size + (tile <= larger)
        expected.update({d[0]: tile for d in order[start:start + width]})
        start += width
    assert {r["id"]: r["t"] for r in got} == expected


@pytest.mark.parametrize("within", [[], ["g"]])
@pytest.mark.parametrize("lowest,highest", [(1, 3), (2, 2), (3, 3), (1, 1)])
def test_top_ranks(spark, within, lowest, highest):
    data = sample_rows(7)
    got = top_ranks(frame(spark, data), by="v", within=within, lowest=lowest, highest=highest, out="r").collect()
    expected = {}
    for d in data:
        mine = [e for e in data if not within or e[1] == d[1]]
        low = -10**9
        rank = 1 + sum((e[2] if e[2] is not None else low) > (d[2] if d[2] is not None else low) for e in mine)
        if lowest <= rank <= highest:
            expected[d[0]] = rank
    assert {r["id"]: r["r"] for r in got} == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=60), width=st.integers(2, 25))
def test_any_values(spark, values, width):
    data = [(i, "a", v, Decimal(1)) for i, v in enumerate(values)]
    got = ranked(frame(spark, data), by=F.col("v"), tie="id", out="r", rows_per_slice=width).collect()
    assert {r["id"]: r["r"] for r in got} == {d[0]: 1 + sum(key(e) < key(d) for e in data) for d in data}
