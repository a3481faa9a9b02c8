"""Template windows against a plain count of them, and consistent slots."""

import random

import pytest
from pyspark.sql import functions as F

from tidemart import session
from tidemart.llm import decontaminate

ITEM = "If Anna has 5 apples and buys 3 kg of pears, how many does Anna have left after two days?"
SCHEMA = "item_id long, text string"


def found(spark, texts, items=((1, ITEM),), **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.matches(docs, spark.createDataFrame(list(items), SCHEMA), **options).collect()}


def test_templates(spark):
    df = spark.createDataFrame([("He met Bob Ray. The 3.5km walk, 12 of\n5 Miles \u0001 and İ x",), (None,), ("",)], "t string")
    got = [r.w for r in df.select(decontaminate.template(F.col("t")).alias("w")).collect()]
    n, name, unit = decontaminate.NUMBER, decontaminate.NAME, decontaminate.UNIT
    assert got[0] == ["he", "met", name, name, "the", n, unit, "walk", n, "of", n, unit, "and", name, "x"]
    assert got[1:] == [[], []]
    both = df.select(F.size(decontaminate.template(F.col("t"))) == F.size(decontaminate.values(F.col("t"))))
    assert [r[0] for r in both.collect()] == [True] * 3


def test_other_numbers_names_and_units_are_found(spark):
    same = "Question: If Bert has 17 apples and buys 2.5 miles of pears, how many does Bert have left after nine days? Yes."
    other = "If Bert has 17 apples and buys 2 kg of pears, how many does Carl have left after two days?"
    got = found(spark, [ITEM, "So. " + same, other, "Nothing of the kind is in this text, which goes on for some words.", None, ""])
    assert sorted(d for d, _ in got) == [0, 1, 2]
    assert got[0, 1].coverage == got[1, 1].coverage == 1.0 > got[2, 1].coverage
    strict = found(spark, [ITEM, same, other], coverage=0.95)
    assert sorted(d for d, _ in strict) == [0, 1]


def test_same_as_counting_windows(spark):
    rng = random.Random(2)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(3, 25)))) for k in range(12)]
    texts = []
    for _ in range(40):
        own = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.6:
            part = rng.choice(items)[1].split()
            own[3:3] = part[: rng.randint(1, len(part))]
        texts.append(" ".join(own))
    got = found(spark, texts, items)
    want = {}
    for d, text in enumerate(texts):
        own = text.split()
        for k, item in items:
            parts = item.split()
            width = min(decontaminate.WIDTH, len(parts))
            windows = [tuple(parts[i:i + width]) for i in range(len(parts) - width + 1)]
            have = {tuple(own[i:i + width]) for i in range(len(own) - width + 1)}
            matched = sum(w in have for w in windows)
            if matched >= min(decontaminate.LEAST, len(windows)) and matched >= decontaminate.COVERAGE * len(windows):
                want[d, k] = (matched, len(windows))
    assert {key: (r.matched, r.windows) for key, r in got.items()} == want


def test_documents_without_leaks_stay(spark):
    docs = spark.createDataFrame([(1, ITEM, "a"), (2, "clean", "b"), (None, None, "c"), (None, ITEM, "d"), (2, "clean", "b")],
                                 "doc_id long, text string, hash string")
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "")], SCHEMA)
    kept = decontaminate.without_contaminated(docs.filter("doc_id is not null or text is null"), bench)
    assert sorted((r.doc_id or 0, r.hash) for r in kept.collect()) == [(0, "c"), (2, "b"), (2, "b")]
    assert kept.columns == docs.columns
    assert decontaminate.without_contaminated(docs, bench.limit(0)).count() == 5
    assert decontaminate.without_contaminated(docs.limit(0), bench).count() == 0


def test_short_items_leave_other_documents(spark):
    items = [(1, ITEM), (2, "42"), (3, "Yes"), (4, "In 1990"), (5, "Anna Bo has 7 km, 8 km and 9 km"), (6, "!"), (7, None)]
    texts = [
        "He paid 17 of them, yes, and left in 5 hours. Yes.", "42", "A line\r\n  yes!\nmore", "in 1990", "In 1991", "so in 1990 it was",
        "Anna Bo has 7 km, 8 km and 9 km.", "Anna Bo has 7 km, 8 km and 6 km.", "", None, "42\n42", ITEM,
    ]
    got = found(spark, texts, items)
    assert sorted(got) == [(1, 2), (2, 3), (3, 4), (6, 5), (10, 2), (11, 1)]
    assert [(r.matched, r.windows, r.coverage) for key, r in got.items() if key[1] != 1] == [(1, 1, 1.0)] * 5
    assert sorted(found(spark, texts, items[1:])) == [(1, 2), (2, 3), (3, 4), (6, 5), (10, 2)]
    assert found(spark, texts, items[5:]) == {}


def test_only_dataframe_functions_on_the_main_path(spark):
    docs, bench = spark.createDataFrame([(1, ITEM)], "doc_id long, text string"), spark.createDataFrame([(1, ITEM)], SCHEMA)
    plan = decontaminate.matches(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_filter_grows_with_the_windows():
    assert [decontaminate.filter_bits(n) for n in (0, 1000, 65_536, 65_537, 1_000_000, 10 ** 9)] == [1 << 20] * 3 + [1 << 21, 1 << 24, 1 << 24]


def test_large_filters_find_the_same(spark, monkeypatch):
    words = ["".join(chr(97 + int(d)) for d in str(100 + k)) for k in range(80)]
    docs = spark.createDataFrame([(k, "some words of " + " ".join(words[k:k + 12])) for k in range(0, 60, 2)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words[20:32]))], "item_id long, text string")
    few = sorted(decontaminate.matches(docs, items).collect())
    monkeypatch.setattr(decontaminate, "LEAST_BITS", 1 << 23)
    assert sorted(decontaminate.matches(docs, items).collect()) == few and {r.doc_id for r in few} >= {18, 20, 22}


def test_a_template_is_made_once_and_only_small_windows_are_joined(spark, monkeypatch):
    plans, batches, before = {}, {}, spark.conf.get(session.READER_ROWS)

    def pin(df, label="pin", *codec):
        batches[label] = int(spark.conf.get(session.READER_ROWS))
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return session.pin(df, label, *codec)

    monkeypatch.setattr(decontaminate, "pin", pin)
    long = "The quick brown fox jumps over the lazy dog near the old river bank. " * 3
    docs = spark.createDataFrame([(1, long), (2, "Something else."), (None, long), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, long[:70]), (2, "42")], "item_id long, text string")
    found = decontaminate.matches(docs, items)
    once = spark.range(1).select(decontaminate.template(F.lit("x").substr(F.lit(1), F.col("id").cast("int"))))
    each = once._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace")
    assert each and plans["template-hits"].count("regexp_replace(") <= each + 1  # a template, and the values of its slots
    assert batches["template-hits"] == batches["line-hits"] == 256 < int(before) == int(spark.conf.get(session.READER_ROWS))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 1), (None, 1)}


@pytest.mark.parametrize("most", [0, 10])
def test_contaminated_documents_are_dropped_by_broadcast_if_they_are_few(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", most)
    text = "Anna has twelve red apples and gives away seven of them before the long winter comes."
    docs = spark.createDataFrame([(1, text), (2, "Nothing of the kind."), (None, "Something."), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = decontaminate.without_contaminated(docs, items)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (most > 0) and ("SortMergeJoin" in plan) == (most == 0)
        assert {r.doc_id for r in kept.collect()} == {2, 3, None}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
