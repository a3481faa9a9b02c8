"""The distributed model against one counted in a dictionary."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemart.llm import kneser_ney

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def discounts(values):
    seen = Counter(values)
    a, b, c, d = (seen[k] for k in (1, 2, 3, 4))
    if min(a, b, c, d) == 0:
        return [0.0, 0.5, 0.75, 0.75]
    y = a / (a + 2 * b)
    found = [1 - 2 * y * b / a, 2 - 3 * y * c / b, 3 - 4 * y * d / c]
    return [0.0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(found, 1))]


def plain(data):
    tokens = [[*WORD.findall((t or "").lower()), "</s>"] for _, t, _ in data]
    count, pairs = Counter(), Counter()
    for (_, _, learns), ts in zip(data, tokens):
        if learns:
            count.update(ts)
            pairs.update(zip(["<s>", *ts], ts))
    total, kinds, follows = Counter(), defaultdict(Counter), Counter()
    for (a, b), n in pairs.items():
        total[a] += n
        kinds[a][min(n, 3)] += 1
        follows[b] += 1
    d2, d1 = discounts(pairs.values()), discounts(follows.values())
    known, words, types = sum(count.values()), len(count), len(pairs)
    spread = sum(d1[min(n, 3)] for n in follows.values()) / types if types else 1.0

    def single(w):
        own = (follows[w] - d1[min(follows[w], 3)]) / types if types else 0.0
        return own + spread / (words + 1)

    def given(a, w):
        if not total[a]:
            return single(w)
        n = pairs[a, w]
        return (n - d2[min(n, 3)]) / total[a] + sum(d2[k] * kinds[a][k] for k in (1, 2, 3)) / total[a] * single(w)

    found = []
    for (i, _, _), ts in zip(data, tokens):
        score = sum(math.log10(given(a, w)) for a, w in zip(["<s>", *ts], ts))
        base = sum(math.log10((count[w] + 0.1) / (known + 0.1 * (words + 1))) for w in ts)
        found.append((i, len(ts), sum(count[w] > 0 for w in ts), known, base, score))
    every = sum(given("a", w) for w in count) + (1 - sum(given("a", w) for w in count))
    assert every == pytest.approx(1)
    return found


@pytest.mark.parametrize("learned", [0.8, 0.0])
def test_same_as_a_dictionary(spark, rows, many_chunks, learned):
    rng = random.Random(7)
    vocabulary = [a + b for a in "a b c d e f".split() for b in ["", "x", "Y", "é"]]
    data = [(k, " ".join(rng.choice(vocabulary[:rng.randint(1, 24)]) for _ in range(rng.randint(0, 60))), rng.random() < learned)
            for k in range(60)]
    data += [(60, None, learned > 0), (61, "", False), (62, "never seen", False)]
    data = [(i, t, b) for i, t, b in data]
    df = spark.createDataFrame(data, "doc_id long, text string, fit boolean").repartition(3)
    got = rows(kneser_ney.score(df, F.col("fit")).drop("learns"))
    for mine, theirs in zip(got, plain([(i, t and t.replace("É", "é"), b) for i, t, b in data]), strict=True):
        assert mine[:4] == theirs[:4]
        assert mine[4:] == pytest.approx(theirs[4:], rel=1e-9)


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b", None), (1, "a b", True), (1, "a b", True)], "doc_id long, text string, fit boolean")
    got = kneser_ney.score(df, F.col("fit")).collect()
    assert sorted((r.doc_id or 0, r.learns, r.n_tokens, r.train_tokens) for r in got) == [(0, False, 3, 6), (1, True, 3, 6), (1, True, 3, 6)]
    assert kneser_ney.score(df.limit(0), F.col("fit")).count() == 0
