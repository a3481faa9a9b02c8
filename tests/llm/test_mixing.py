"""Targets against sharing by hand, and the mix against its promises."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import mixing


def shared(sizes, weights, repeats):
    """Share the total by weight; what is above a limit is shared again among the rest."""
    total, targets, free = sum(sizes), [0.0] * len(sizes), {k for k, s in enumerate(sizes) if s}
    left = total
    while free and left > 1e-9:
        part = {k: left * weights[k % len(weights)] / sum(weights[j % len(weights)] for j in free) for k in free}
        over = {k for k in free if targets[k] + part[k] > repeats * sizes[k]}
        if not over:
            for k in free:
                targets[k] += part[k]
            break
        for k in free - over:
            targets[k] += part[k]
        left = sum(targets[k] + part[k] - repeats * sizes[k] for k in over)
        for k in over:
            targets[k] = float(repeats * sizes[k])
        free -= over
    return targets


@pytest.mark.parametrize("sizes", [[100, 5, 700], [1, 1, 1, 1000], [10, 0, 10], [0, 0], [7], [3, 900, 2, 2, 500, 1, 40]])
def test_targets(spark, sizes):
    names = [*(f"s{k}" for k in range(len(sizes) - 1)), None]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert [got[n] for n in names] == pytest.approx(shared(sizes, (1, 2, 3), 3), rel=1e-9, abs=1e-6)


def documents(spark):
    rng = np.random.default_rng(4)
    rows = [(int(k), " ".join(["w"] * int(rng.integers(0, 200))), ["a", "b", "c", None, "tiny"][min(4, int(rng.integers(0, 9)) // 2)]) for k in range(600)]
    rows += [(1, "x y", "a"), (1, "x y", "a"), (None, "q r s", "b"), (2000, None, "c"), (2001, "", "only empty")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def test_taken_words(spark):
    docs = documents(spark)
    got = mixing.taken_words(docs, block=8, shard=64).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, rel=0.03, abs=16)
    assert sum(r.target for r in {r.source: r for r in got}.values()) == pytest.approx(sum(r.size for r in got))
    again = mixing.taken_words(docs.repartition(5), block=8, shard=64).collect()
    key = lambda r: (r.doc_id or -1, r.size, r.source or "", r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_spans_fill_the_slots(spark):
    mixed = mixing.mix_sources(documents(spark), block=8, shard=64)
    spans = mixed.spans()
    filled = spans.groupBy("shard", "slot").agg(F.sum("words").alias("n"), F.count_distinct("rank", "block").alias("blocks"))
    assert filled.filter("n > 8 or blocks <> 1").count() == 0
    assert spans.agg(F.sum("words")).first()[0] == mixed.taken().agg(F.sum("taken")).first()[0]
    assert mixed.slots.groupBy("rank", "epoch", "block").count().filter("count > 1").count() == 0


def test_mixed_documents_keep_columns_and_limits(spark):
    docs = documents(spark).filter("doc_id < 600").dropDuplicates(["doc_id"]).withColumns(
        {"rank": F.lit("x"), "times": F.lit("y"), "copy": F.lit("z")})
    got = mixing.mixed_documents(docs, block=8, shard=64)
    assert got.columns == docs.columns
    assert got.groupBy("doc_id").count().filter("count > 4").count() == 0
    assert 0 < got.select("doc_id").distinct().count() < docs.count()


def test_no_words_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.taken_words(docs).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.taken_words(docs.limit(0)).count() == 0


def test_permutations():
    for size in (1, 2, 3, 10, 1000):
        for key in (1, 2):
            got = mixing.permuted(np.arange(size), np.full(size, size), np.full(size, key, np.uint64))
            assert sorted(got.tolist()) == list(range(size))
