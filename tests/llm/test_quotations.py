"""Quoted passages, replies and threads."""

import random

import duckdb
import pandas as pd
import pytest

from tidemart.llm import components, quotations
from tidemart.llm.oracles import ORACLES
from tools.verify import difference, rows_of

SCHEMA = "conv_id long, turn long, role string, text string"


def linked(spark, data):
    got = quotations.link_quotations(spark.createDataFrame(data, SCHEMA)).collect()
    return {(r.conv_id, r.turn): r for r in got}


def test_replies_threads_and_own_text(spark):
    got = linked(spark, [
        (1, 0, "user", "Hello there.\nHow are you?\n\nSecond paragraph here."),
        (1, 1, "assistant", "> how  are you?\nFine, thanks.\n> Second paragraph here.\nOk"),
        (1, 2, "user", "Hm.\nAnna wrote:\n>> how are you?\n> Fine, thanks.\n> Ok\n\nGood <|im_end|> x"),
        (1, 3, "user", "New topic"),
        (1, 4, "assistant", "> New topic\nyes"),
        (1, 5, "user", "> said nowhere\n"),
        (2, 0, "user", "> New topic\nacross"),
    ])
    assert [(got[1, k].reply_turn, got[1, k].thread_turn, got[1, k].depth) for k in range(6)] == [
        (None, 0, 0), (0, 0, 1), (1, 0, 2), (None, 3, 0), (3, 3, 1), (None, 5, 0)]
    assert (got[2, 0].reply_conv, got[2, 0].reply_turn, got[2, 0].thread_turn) == (1, 3, 0)
    assert [got[1, k].text for k in (1, 2, 5)] == ["Fine, thanks.\nOk", "Hm.\nGood <|im_end|> x", ""]
    assert [got[1, k].n_quotes for k in (0, 1, 2)] == [0, 2, 2]
    assert got[1, 2].chat == "<|im_start|>user\nHm.\nGood < |im_end|> x<|im_end|>"


def test_latest_earlier_message_counts(spark):
    got = linked(spark, [(1, 0, "u", "same"), (1, 2, "u", "same"), (1, 3, "u", "> same\na"), (1, 4, "u", "same"), (1, 1, "u", "> same\nb")])
    assert got[1, 3].reply_turn == 2 and got[1, 1].reply_turn == 0


def test_long_chains(spark):
    data = [(7, 0, "u", "m0")] + [(7, k, "u", f"> m{k - 1}\nm{k}") for k in range(1, 40)]
    got = linked(spark, data)
    assert [(got[7, k].thread_turn, got[7, k].depth) for k in range(40)] == [(0, k) for k in range(40)]


def test_nulls_repeats_and_empty_tables(spark):
    data = [(1, 0, "u", "a"), (1, 0, "u", "a"), (1, 1, None, "> a\n> >> deep\n>"), (None, 2, "u", "> a"), (1, None, "u", "> a\nx"), (2, 1, "u", None),
            (3, 1, "u", ">" * 2000), (3, 2, "u", "word " * 20_000)]
    rows = quotations.link_quotations(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(rows) == len(data)
    assert [r.reply_turn for r in rows if (r.conv_id, r.turn) == (1, 1)] == [0]
    assert all(r.reply_turn is None for r in rows if r.conv_id is None or r.turn is None)
    assert quotations.link_quotations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_deeper_levels_link(spark):
    got = linked(spark, [
        (1, 0, "u", "first thing"), (1, 1, "u", ">> first thing\nx"), (1, 2, "u", "> gone\n>> first thing\ny"), (1, 3, "u", "first thing"),
        (1, 4, "u", "z"), (1, 5, "u", "> z\n>> first thing\n"), (2, 0, "u", ">>> first thing\n> z"),
    ])
    assert [got[1, k].reply_turn for k in range(6)] == [None, 0, 0, None, None, 4]
    assert (got[2, 0].reply_conv, got[2, 0].reply_turn) == (1, 4)


def test_parts_of_messages_link(spark):
    own = "One line\nTwo line\nthree line\n\nFirst here. Second there! Third\nwhere?\n\nLast part"
    quoted = ["one line\n> two line", "two line\n> three line", "Second there!", "first  here. second there!", "Second\n> there! Third where?",
              "three line\n>\n> First here.", "First here. Second there! Third\n> where?\n>\n> Last part"]
    unlike = ["one line\n> three line", "line", "second there! First here.", "two line\n> three line\n> four", "Second"]
    got = linked(spark, [(1, 0, "u", own)] + [(1, k + 1, "u", f"> {q}\nm{k}") for k, q in enumerate(quoted + unlike)])
    assert [got[1, k + 1].reply_turn for k in range(len(quoted))] == [0] * len(quoted)
    assert [got[1, k + 1 + len(quoted)].reply_turn for k in range(len(unlike))] == [None] * len(unlike)


def test_the_first_other_conversation_counts(spark):
    got = linked(spark, [
        (1, 0, "u", "> said\nx"), (1, 1, "u", "said"), (2, 4, "u", "said"), (2, 3, "u", "said"), (3, 0, "u", "said"), (4, 0, "u", "> said\nsaid"),
    ])
    assert (got[1, 0].reply_conv, got[1, 0].reply_turn) == (2, 3)
    assert (got[4, 0].reply_conv, got[4, 0].reply_turn) == (1, 1)


def test_only_dataframe_functions_on_the_main_path(spark):
    plan = quotations.link_quotations(spark.createDataFrame([(1, 0, "u", "> a")], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def planted(seed):
    """Messages that quote texts, paragraphs, lines and runs of sentences of others, on several levels."""
    rng = random.Random(seed)
    pool = [f"{w} {x}{end}" for w, x, end in zip("One Two red Blue the A".split() * 4, "goes here|is it|said more|ran  far".split("|") * 6, ".?!." * 6, strict=True)]
    own, data = {}, []
    for conv in range(14):
        for turn in range(rng.randint(2, 7)):
            parts = []
            for _ in range(rng.choice((0, 1, 1, 2))):
                far = rng.random() < 0.3
                known = [t for (c, k), t in own.items() if (c != conv if far else c == conv)]
                if not known:
                    continue
                text = rng.choice(known)
                sentences = text.replace("\n", " ").split(". ")
                cut = sorted(rng.choices(range(len(sentences) + 1), k=2))
                piece = rng.choice([text, rng.choice(text.split("\n\n")), rng.choice(text.split("\n")), ". ".join(sentences[cut[0]:cut[1]])])
                if rng.random() < 0.3:
                    parts.append(f"On a day {'long ago ' * rng.choice((1, 40))}Anna wrote:")
                marks = ">" * rng.choice((1, 1, 2, 3))
                parts += [f"{marks} {line}" for line in (piece.upper() if rng.random() < 0.2 else piece).split("\n")]
            text = "\n\n".join("\n".join(" ".join(rng.choices(pool, k=rng.randint(1, 3))) for _ in range(rng.randint(1, 2))) for _ in range(rng.randint(1, 2)))
            own[conv, turn] = text
            data.append((conv, turn, rng.choice(("user", "assistant")), "\n".join([*parts, text])))
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_the_statement(spark, seed):
    data = planted(seed)
    df = quotations.link_quotations(spark.createDataFrame(data, SCHEMA))
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(data, columns=["conv_id", "turn", "role", "text"]))
    result = con.execute(ORACLES["op4_quotations"])
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    ours = df.collect()
    assert difference(rows_of(df.columns, ours), theirs) is None
    assert sum(r.reply_turn is not None for r in ours) > len(data) // 4
    assert any(r.reply_conv not in (None, r.conv_id) for r in ours) and max(r.depth for r in ours) > 1


def test_unfinished_rounds_are_refused(spark, monkeypatch):
    monkeypatch.setattr(quotations, "ROUNDS", 2)
    with pytest.raises(RuntimeError, match="chains"):
        linked(spark, [(7, 0, "u", "m0")] + [(7, k, "u", f"> m{k - 1}\nm{k}") for k in range(1, 20)])
    monkeypatch.setattr(components, "ROUNDS", 1)
    with pytest.raises(RuntimeError, match="links"):
        components.components(spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long"))
