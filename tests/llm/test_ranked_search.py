"""Ranked search against scoring all documents, and reads that end early."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tidemart.llm import ranked_search
from tidemart.llm.oracles import ORACLES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top):
    bags = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(b.values()) for b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for b in bags for t in b)
    rows = []
    for item, text in items:
        scores = []
        for (doc, _), bag, size in zip(docs, bags, sizes, strict=True):
            m = 75 + (25 * size * n) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                for t in terms(text) if bag[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        rows += [(item, k, doc, -score) for k, (score, _, doc) in enumerate(sorted(scores)[:top], 1)]
    return rows


def corpus(rng, count):
    words = [f"w{k}" for k in range(40)] + ["Été", "日本", "x1", "the", "the", "the", "the"]
    return [
        (k, " ".join(rng.choices(words, k=rng.choice([1, 5, 30, 200]))) + rng.choice(["", ".", "_the", "\x00THE"])) for k in range(count)
    ]


def as_rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("top", [1, 3, 20])
def test_all_scores(spark, top):
    rng = random.Random(top)
    docs = corpus(rng, 300)
    docs += [(7, docs[8][1]), (9, docs[8][1]), (8, docs[8][1]), (None, docs[8][1]), (500, None), (501, ""), (502, "...")]
    items = [*((f"i{k}", t) for k, t in corpus(rng, 12)), ("none", None), ("empty", "!"), ("unknown", "nowhere"), ("i0", "the the w1")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score int").repartition(5)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id string, text string, rank int")
    assert as_rows(ranked_search.search(d, i, top=top)) == sorted(plain(docs, items, top), key=str)


def test_many_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 400)
    rng = random.Random(11)
    docs, items = corpus(rng, 200), [(k, t) for k, t in corpus(rng, 6)] + [(0, "the w3 w4")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(20)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert as_rows(ranked_search.search(d, i, top=4)) == sorted(plain(docs, items, 4), key=str)


def test_intervals_with_ties_bars_and_chunks_of_windows(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(ranked_search, "FIRST_STEP", 1)
    for _ in range(200):
        n, top = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        lists, sums = [], defaultdict(int)
        for _ in range(int(rng.integers(1, 6))):
            docs = rng.permutation(n)[:int(rng.integers(0, n + 1))]
            impacts = -np.sort(-rng.integers(1, 5, len(docs)))
            lists.append((docs, impacts))
            for d, x in zip(docs.tolist(), impacts.tolist(), strict=True):
                sums[d] += x
        bar = int(rng.integers(0, 6))
        want = sorted((-s, d) for d, s in sums.items())[:top]
        assert ranked_search.best_of_chunk(lists, n, top, bar) == [(-s, d) for s, d in want if -s >= bar]


def test_reading_ends_early():
    class Counted(np.ndarray):
        """Remembers how far it was read."""

        most = 0

        def __getitem__(self, key):
            if isinstance(key, slice) and key.stop:
                Counted.most = max(Counted.most, int(key.stop))
            return np.asarray(super().__getitem__(key))

    n = 10_000
    impacts = np.concatenate(([1_000_000] * 20, np.full(n - 20, 5)))
    assert len(ranked_search.best_of_chunk([(np.arange(n).view(Counted), impacts)], n, 20)) == 20
    assert Counted.most < 200


def test_long_texts_are_read_in_windows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ranked_search, "WINDOW_BYTES", 40)
    long = "The cat, the dog; " * 50 + "x" * 100 + " cat"
    wanted = pa.array(["cat", "the", "x" * 100], pa.large_string())
    chunk = ranked_search._chunk(pa.array([1, 2]), pa.array([long, "cat"], pa.large_string()), np.array([len(long), 3]), wanted)
    assert ranked_search.unpack(chunk.column(1)[0].as_py(), np.int64).tolist() == [202, 1]
    assert ranked_search.unpack(chunk.column(5)[0].as_py(), np.int64).tolist() == [51, 1, 100, 1]


def test_statement(spark):
    rng = random.Random(2)
    docs, items = corpus(rng, 120), [(k, t) for k, t in corpus(rng, 5)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(d, t.replace("\x00", " ")) for d, t in docs])
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    want = sorted(con.execute(ORACLES["op13_ranked_search"]).fetchall(), key=str)
    assert want == sorted(plain([(d, t.replace("\x00", " ")) for d, t in docs], items, 20), key=str)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.search(d.limit(0), i).count() == 0
    assert ranked_search.search(d, i.limit(0)).count() == 0
    assert ranked_search.search(d, i).count() == 1
