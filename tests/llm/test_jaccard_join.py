"""The shingle join against a comparison of all pairs."""

import random
import re

import numpy as np
import pytest

from tidemart.llm import jaccard_join, rounds

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, width, percent):
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        if len(words) < width:
            sets.append({tuple(words)} if words else set())
        else:
            sets.append({tuple(words[k:k + width]) for k in range(len(words) - width + 1)})
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, _), s in zip(rows, sets):
        for (j, _), t in zip(rows, sets):
            if i is not None and j is not None and s and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted(((i, len(s), find(i)) for (i, _), s in zip(rows, sets)), key=lambda r: (r[0] is not None, r))


def texts(rng):
    def words(n):
        return [rng.choice("the of and to in a is on by it x y z".split()) + rng.choice(["", "", "s", "ing"]) for _ in range(n)]

    passage = words(30)
    found = [None, "", " \t", "one", "One", "two words", "a b c d", "A  b\nc d", "É é x y", "é é x y"]
    for _ in range(12):
        base = words(rng.randint(4, 80))
        found.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            near = list(base)
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(len(near))] = rng.choice(["new", "word"])
            found.append(" ".join(near))
    for _ in range(10):  # a passage that unlike documents share
        found.append(" ".join(words(rng.randint(0, 40)) + passage + words(rng.randint(0, 10))))
    centre = words(120)
    for _ in range(15):  # a larger group of near copies
        near = list(centre)
        for _ in range(3):
            near[rng.randrange(len(near))] = "e" + str(rng.randint(0, 9))
        found.append(" ".join(near))
    return found


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_same_as_all_pairs(spark, rows, many_chunks, width, percent):
    data = list(enumerate(texts(random.Random(width))))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = rows(jaccard_join.link(df, width=width, percent=percent), "doc_id", "n_shingles", "component_id")
    assert got == plain(data, width, percent)


def test_null_ids_repeated_rows_and_other_columns(spark, rows):
    data = [(None, "a b c d e", 1), (3, "a b c d e", 1), (2, "a b c d e", 1), (2, "a b c d e", 1), (9, None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, n long").withColumnRenamed("n", "chunk")
    assert rows(jaccard_join.link(df)) == [(None, 2, None), (2, 2, 2), (2, 2, 2), (3, 2, 2), (9, 0, 9)]


@pytest.mark.parametrize("chunks", [False, True])
def test_rows_of_one_id_with_other_texts_are_one_node(spark, rows, monkeypatch, chunks):
    if chunks:
        monkeypatch.setattr(rounds, "CHUNK_BYTES", 600)
        monkeypatch.setattr(rounds, "RANGE_BYTES", 300)
    data = [(k * 7 % 31, t) for k, t in enumerate(texts(random.Random(5)))]
    data += [(40, "p q r s t"), (41, "p q r s t"), (41, "u v w x y"), (42, "u v w x y"), (43, ""), (43, "u v w x y")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert rows(jaccard_join.link(df), "doc_id", "n_shingles", "component_id") == plain(data, 4, 85)


def test_a_set_is_named_once_per_chunk(spark, rows, monkeypatch):
    asked, answer = [], rounds.answer
    monkeypatch.setattr(rounds, "answer", lambda rows_, how: (asked.append(rows_), answer(rows_, how))[1])
    df = spark.createDataFrame([(k, "a b c d e") for k in range(200)] + [(200, "x")], "doc_id long, text string")
    assert rows(jaccard_join.link(df)) == [(k, 2, 0) for k in range(200)] + [(200, 1, 200)]
    named = asked[0].filter("kind = 1").collect()
    assert sum(rounds.unpack(bytes(r.blob), np.uint64).size // 3 for r in named) == 2


def test_empty_table(spark):
    assert jaccard_join.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_prefix_bounds_hold_for_every_size():
    for percent in (50, 80, 85, 100):
        for size in range(1, 400):
            need = jaccard_join.least_overlap(size, percent)
            assert percent * size <= 100 * need and need <= size
            assert 1 <= jaccard_join.filter_need(size, percent) <= jaccard_join.filter_length(size, percent) <= size
