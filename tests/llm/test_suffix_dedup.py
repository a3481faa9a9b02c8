"""Repeated strings against a count of every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemart.llm import rounds, suffix_dedup


def plain(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        found.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def texts(seed):
    rng = random.Random(seed)

    def some(n):
        return " ".join(rng.choice(["the", "of", "änd", "x", "yy", "zzz", "qu"]) for _ in range(n))

    passages = [some(30) for _ in range(3)]
    found = [None, "", "a" * 300, "ab" * 100, "short"]
    found += [some(rng.randint(0, 60)) + rng.choice([*passages, ""]) + some(rng.randint(0, 20)) for _ in range(40)]
    found += [passages[0] + str(k) for k in range(20)]  # more contexts of one gram than are compared pair by pair
    return [*found, found[10], found[10], found[20][:-3] + "Q"]


@pytest.mark.parametrize(("length", "gram"), [(40, 10), (40, 40), (12, 5)])
def test_same_as_every_window(spark, rows, many_chunks, length, gram):
    data = texts(length)
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(4)
    got = rows(suffix_dedup.remove_repeats(df, length=length, gram=gram).drop("spans"))
    assert got == [(k, *r) for k, r in enumerate(plain(data, length))]


@pytest.mark.parametrize("hot", [0, 3, 15])
def test_very_frequent_grams_give_the_same(spark, rows, many_chunks, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    for length, gram in ((40, 10), (12, 5)):
        data = texts(length)
        df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(4)
        got = rows(suffix_dedup.remove_repeats(df, length=length, gram=gram).drop("spans"))
        assert got == [(k, *r) for k, r in enumerate(plain(data, length))]


def test_contexts_of_a_frequent_gram_do_not_meet(spark, rows, many_chunks, monkeypatch):
    rng = random.Random(4)
    passage, length, gram = "".join(rng.choice("abcdefgh") for _ in range(60)), 40, 10
    data = ["".join(rng.choice("ijklmnop") for _ in range(50)) + passage + str(k) * 30 for k in range(200)]
    asked, answer = [], rounds.answer
    monkeypatch.setattr(rounds, "answer", lambda rows_, how: (asked.append(rows_), answer(rows_, how))[1])
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    got = rows(suffix_dedup.remove_repeats(df, length=length, gram=gram).drop("spans"))
    assert got == [(k, *r) for k, r in enumerate(plain(data, length))]
    met = Counter()
    for row in asked[1].filter("kind = 2").collect():
        met.update(s[:gram] for s in suffix_dedup.Run.unpack(bytes(row.blob))[0].after)
    assert max(met.values(), default=0) <= 20


def test_kept_bytes_spans_null_ids_and_repeated_rows(spark):
    text = "0123456789" * 3
    df = spark.createDataFrame([(None, text), (None, text), (4, text[:20] + "xyz")], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, length=20, gram=5, with_text=True).collect()
    assert sorted((r.doc_id is None, bytes(r.kept)) for r in got) == [(False, b"xyz"), (True, b""), (True, b"")]
    assert [[0, 20]] in [r.spans for r in got]


def test_passages_of_over_50_words_go_from_400_bytes_on(spark, rows):
    rng = random.Random(6)

    def some(n):
        return "".join(rng.choice("abcdefghij") for _ in range(n))

    below, enough = (" ".join([some(6) for _ in range(55)] + [some(n)]) for n in (14, 15))
    assert [len(p) for p in (below, enough)] == [399, 400]
    alone = [f"{k}{some(900)}" for k in range(4)]
    planted = [f"{some(300)}{k}{p}{'KLMN'[k]}{some(300)}" for p in (below, enough) for k in range(4)]
    data = [*alone, *planted, " ".join([some(420)] * 2)]
    got = rows(suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")).drop("spans"))
    assert got == [(k, *r) for k, r in enumerate(plain(data, suffix_dedup.LENGTH))]
    assert [r[2] for r in got] == [0] * 8 + [400] * 4 + [840]


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_anchors_do_not_depend_on_segments(monkeypatch):
    text = [t.encode() for t in texts(1) if t] * 3
    whole = suffix_dedup.anchors(text, 30, 7)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 50)
    cut = suffix_dedup.anchors(text, 30, 7)

    def windows(a):
        return sorted((t, s, p, int(g)) for t, p, f, l, g in zip(a.text, a.place, a.first, a.last, a.gram) for s in range(f, l + 1))

    assert windows(whole) == windows(cut)
    assert len(windows(whole)) == sum(max(0, len(t) - 29) for t in text)


def test_loser_tree_merges_and_knows_common_prefixes():
    rng = random.Random(3)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 12))) for _ in range(5)]
    coded = [suffix_dedup.front_coded(r)[0].tolist() for r in runs]
    merged = list(suffix_dedup.merge(runs, coded))
    strings = [runs[r][k] for r, k, _ in merged]
    assert strings == sorted(s for r in runs for s in r)
    for before, after, (_, _, shared) in zip([b"", *strings], strings, merged):
        assert shared == suffix_dedup.common(before, after, 0)


def test_least_of_windows():
    keys = np.random.default_rng(2).integers(0, 99, 57, np.uint64)
    for width in (1, 2, 9, 57):
        want = [keys[k:k + width].min() for k in range(len(keys) - width + 1)]
        assert suffix_dedup.least_of_windows(keys, width).tolist() == want
