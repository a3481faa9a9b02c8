"""Words, hashes and the exchange between chunks and hash ranges."""

import numpy as np
import pyarrow as pa

from tidemart.llm import rounds
from tidemart.llm.text import chained, hashed_words, slices, split_words

TEXTS = ["", " Ab  cd\t\nAB ", "é x y", "\x0b", "one", "a" * 50 + " b", "ab ab\x1cc"]


def large(texts):
    return pa.array(texts, pa.large_string())


def test_words_are_cut_at_ascii_white_space_only():
    words, bounds = split_words(large(TEXTS))
    cut = [words.to_pylist()[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert cut == [[], ["Ab", "cd", "AB"], ["é", "x y"], [], ["one"], ["a" * 50, "b"], ["ab", "ab\x1cc"]]


def test_hashes_tell_words_apart_and_ignore_ascii_case():
    marks, bounds = hashed_words(large(TEXTS))
    words, same = split_words(large(TEXTS))
    assert bounds.tolist() == same.tolist()
    by_word = {}
    for word, mark in zip((w.lower() for w in words.to_pylist()), marks.tolist()):
        assert by_word.setdefault(word, mark) == mark
    assert len(set(by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_the_slice_or_segment(monkeypatch):
    every, _ = hashed_words(large(TEXTS))
    apart = np.concatenate([hashed_words(large(TEXTS).slice(k, 1))[0] for k in range(len(TEXTS))])
    assert every.tolist() == apart.tolist()
    monkeypatch.setattr("tidemart.llm.text._SEGMENT", 3)
    assert hashed_words(large(TEXTS))[0].tolist() == every.tolist()


def test_chained_hashes_depend_on_order_and_width():
    x = np.array([1, 2, 3], np.uint64)
    assert len(chained(x, 4)) == 0 and len(chained(x, 3)) == 1
    assert chained(x, 3)[0] != chained(x[::-1].copy(), 3)[0]


def test_packing_round_trips():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 500, np.uint64))
    assert (rounds.unpack_sorted(rounds.pack_sorted(keys)) == keys).all()
    assert (rounds.unpack(rounds.pack(keys), np.uint64) == keys).all()
    assert rounds.split_blobs(rounds.join_blobs([b"", b"ab", b"c"])) == [b"", b"ab", b"c"]
    at = rounds.cuts(keys, 7)
    assert at[0] == 0 and at[-1] == len(keys) and (np.diff(at) > 0).all()


def test_slices_hold_every_row():
    assert slices(np.array([5, 0, 9, 1, 1]), 6) == [(0, 2), (2, 3), (3, 5)]
    assert slices(np.array([], np.int64), 6) == []
