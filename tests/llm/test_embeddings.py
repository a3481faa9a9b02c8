"""The pigeonhole join against all cosines, and components against a plain search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import embeddings
from tidemart.llm.components import components


def plain(data, cosine):
    good = {}
    for k, (i, v) in enumerate(data):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links = {k: [j for j in good if j != k and len(good[j]) == len(good[k]) and good[j] @ good[k] >= cosine] for k in good}
    least = {k: data[k][0] for k in range(len(data))}
    for _ in data:
        for k, js in links.items():
            least[k] = min([least[k], *(least[j] for j in js)])
    return sorted(((i, len(links.get(k, [])), least[k], None if i is None else least[k] == i) for k, (i, _) in enumerate(data)),
                  key=lambda r: (r[0] is not None, r))


@pytest.mark.parametrize(("size", "tile", "cosine"), [(20, 8, 0.95), (64, 4096, 0.95), (3, 5, 0.8)])
def test_same_as_all_cosines(spark, rows, monkeypatch, size, tile, cosine):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rng = np.random.default_rng(size)
    vectors = [rng.standard_normal(size) for _ in range(25)]
    for _ in range(60):
        near = vectors[rng.integers(len(vectors))]
        vectors.append(near * rng.uniform(0.1, 9) + rng.standard_normal(size) * np.linalg.norm(near) * rng.uniform(0, 0.4) / np.sqrt(size))
    vectors += [vectors[3], vectors[3], vectors[30] * 2]
    data = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)]
    data += [(1000, None), (1001, [0.0] * size), (1002, [float("nan")] * size), (1003, [None] * size), (1004, []),
             (1005, [float("inf")] + [0.0] * (size - 1)), (1006, [1.0, 0.0]), (None, data[3][1]), (1007, [-0.0, 1.0]), (1008, [0.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(3)
    got = rows(embeddings.near_duplicates(df, cosine), "vec_id", "n_links", "component_id", "kept")
    assert got == plain(data, cosine)


def test_rounds_send_about_the_table_each_and_change_no_result(spark, rows, monkeypatch):
    rng = np.random.default_rng(7)
    vectors = [rng.standard_normal(20) for _ in range(40)]
    vectors += [v + rng.standard_normal(20) * 0.02 for v in vectors * 3]
    data = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    planned, written = [], []
    plan, clean = embeddings._planned, embeddings.shuffles_deleted
    monkeypatch.setattr(embeddings, "TILE", 40)
    monkeypatch.setattr(embeddings, "ROUND_BYTES", 0)
    monkeypatch.setattr(embeddings, "_planned", lambda held: planned.append(plan(held)) or planned[-1])
    monkeypatch.setattr(embeddings, "shuffles_deleted", lambda s: written.append(s) or clean(s))
    got = rows(embeddings.near_duplicates(df), "vec_id", "n_links", "component_id", "kept")
    assert got == plain(data, embeddings.COSINE)
    pairs, rounds = planned[0]
    assert rounds > 3 and len(written) == 2  # the distinct vectors, and all rounds
    dealt = rows(pairs)
    assert len({r[:-1] for r in dealt}) == len(dealt) and {r[-1] for r in dealt} <= set(range(rounds))


def test_ids_that_repeat_take_the_class_of_their_vector(spark, rows):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    data = [(5, a), (5, b), (2, b), (9, b), (5, None), (7, c), (7, c), (8, a[::-1])]
    got = rows(embeddings.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<float>")))
    # c and the turned a are one vector of three copies, b has three, a one; the row without a vector has no link.
    assert got == sorted([(5, 0, 5, True), (5, 2, 2, False), (2, 2, 2, True), (9, 2, 2, False), (5, 0, 5, True), (7, 2, 7, True), (7, 2, 7, True), (8, 2, 7, False)])


@pytest.mark.parametrize(("size", "least", "most"), [(8, 16384, 16384), (64, 16384, 16384), (128, 8192, 8192), (4096, 4096, 4096)])
def test_tiles_of_wide_vectors_hold_fewer(spark, size, least, most):
    assert least <= spark.range(1).select(embeddings._tile_rows(F.lit(size))).first()[0] <= most


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_blocks_share_the_whole_budget():
    for size in (1, 15, 16, 17, 64, 100):
        spans = embeddings.blocks_of(size)
        assert spans[0][0] == 0 and spans[-1][1] == size and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_components_of_chains_stars_and_loops(spark, rows):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 130)]
    links = chain + star + [(200, 200), (301, 300), (300, 301), (5, 6)]
    got = rows(components(spark.createDataFrame(links, "a long, b long")))
    assert got == [(k, 0) for k in range(1, 41)] + [(k, 100) for k in range(101, 130)] + [(301, 300)]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
