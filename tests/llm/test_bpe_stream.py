"""Streamed byte-pair encoding and decoding against the tokenizer's library."""

import hashlib
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemart.llm import bpe_stream
from tidemart.llm.queries import MERGES, TOKENIZER

ALPHABETS = [
    "abcdef'st ", "etainos", "'!s. ", "éàÅ漢字가ᅡᆨ̌̇JHTia'", "aA1<|endoftext|> ", "  \x1ea b", "mojaicyclbythan",
]
EDGES = [
    "", " ", "\n\t", "J̌ Å", "Don't!!' 'll x'll. I'M", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>", " ", "a b",
    "日本語 テスト。", "🙂🙃 👍🏽", "word " * 3000,
]


@pytest.fixture(scope="module")
def own():
    return bpe_stream.Encoder(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def texts(count, most):
    rng = random.Random(count)
    return ["".join(rng.choices(rng.choice(ALPHABETS), k=rng.randint(0, most))) for _ in range(count)]


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_ids_and_decoded_texts(own, library):
    some = [*texts(1500, 60), *texts(20, 3000), *EDGES]
    ids, decoded = own.texts(pa.array(some, pa.large_string()))
    for k, text in enumerate(some):
        assert (ids[k].as_py(), decoded[k].as_py()) == expected(library, text)


def test_smallest_blocks_segments_and_windows(own, library, monkeypatch):
    """The lookahead is sufficient: with one symbol beyond it at a time, all tokens are still the library's."""
    monkeypatch.setattr(bpe_stream, "BLOCK", 1)
    monkeypatch.setattr(bpe_stream, "SEGMENT", 7)
    monkeypatch.setattr(bpe_stream, "WINDOW_BYTES", 50)
    for text in [*texts(600, 60), *texts(12, 2500), *EDGES]:
        want = expected(library, text)
        assert list(own.ids(text)) == want[0]
        ids, decoded = own.long_text(text.encode())
        assert (ids[0].as_py(), decoded[0].as_py()) == want


def test_memory_is_constant(own):
    machine = bpe_stream.Transducer(own.merges)
    most, count = 0, 0
    symbols = own.merges.symbols("".join(random.Random(3).choices("etaoinshr", k=50_000)), True)
    for _ in machine.feed(symbols):
        count += 1
        most = max(most, len(machine.held))
    assert count > 15_000 and most <= bpe_stream.BLOCK + own.merges.lookahead


def test_lookahead_by_hand():
    vocab = {t: i for i, t in enumerate(["a", "b", "c", "d", "cd", "bc", "ab", "abc"])}
    # (c, d) comes first and can take c from (b, c), which can take b from (a, b).
    chain = bpe_stream.Merges(vocab, [("c", "d"), ("b", "c"), ("a", "b")])
    assert chain.lookahead == 3
    assert bpe_stream.Merges(vocab, [("a", "b"), ("b", "c"), ("c", "d")]).lookahead == 1
    with pytest.raises(ValueError, match="which no rule before it makes"):
        _ = bpe_stream.Merges(vocab, [("a", "bc"), ("b", "c")]).lookahead


def test_greatest_ranks_win_whatever_the_length(own):
    ids = own.merges.symbols("".join(random.Random(5).choices("etaoinshrmojaicyl", k=4000)), True)
    assert own.merges._merge_long(ids.copy()) == own.merges._merge_short(ids.copy())


def test_byte_level_machine_holds_unfinished_characters():
    library = Tokenizer.from_file(MERGES)
    vocab = {i: t for t, i in library.get_vocab().items()}
    machine = bpe_stream.Detokenizer(vocab, byte_level=True)
    for text in ("naïve 日本語 🙂 done", "", "x" * 50):
        ids = library.encode(text).ids
        assert "".join(machine.feed([i]) for i in ids) + machine.finish() == text
    broken = library.encode("🙂").ids[:-1]
    assert machine.feed(broken) + machine.finish() == library.decode(broken, skip_special_tokens=False)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="white space"):
        bpe_stream.Encoder(MERGES)


def test_table(spark, library):
    some = [*EDGES, None, "again", "again", "x" * 300_000, "long text, " * 500_000]
    rows = [(k if k else None, t, "other") for k, t in enumerate(some)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in bpe_stream.digests(bpe_stream.encode(docs, TOKENIZER)).collect()}
    assert len(got) == len(some)
    for doc_id, text, _ in rows:
        ids, decoded = expected(library, text)
        assert got[doc_id] == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(),
        )
    assert bpe_stream.encode(docs.limit(0), TOKENIZER).count() == 0
