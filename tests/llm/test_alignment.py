"""Alignment of two tokenizers against a plain version that compares all byte ends."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from tidemart.llm import alignment
from tidemart.llm.queries import MERGES, PIECES, alignments_of

EDGES = [
    None, "", " ", "a▁b", "<|endoftext|> <s> <0x41> <unk>", "  x  y \n\n z ", "é é ﬁ 日本語 \x00 ok", "a  b", "tab\there, and\r\nthere",
    "same text twice", "same text twice", "🙂🙃 👍🏽", "no-spaces-" * 400, "one two " * 5000,
]


def letters():
    """The byte of each letter of a byte-level vocabulary, in the public rule's own words."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(moved)}


def plain(rows):
    a_side, b_side, of = Tokenizer.from_file(MERGES), sentencepiece.SentencePieceProcessor(model_file=PIECES), letters()
    a_side.encode_special_tokens = True
    every, counts = [], Counter()
    for doc_id, text in rows:
        a = a_side.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(of[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b
        ]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
            a, b = [], []
        tokens = []
        for ids, parts in ((a, a_bytes), (b, b_bytes)):
            end, found = 0, {}
            for i, part in zip(ids, parts):
                end += len(part)
                found[end] = i
            tokens.append(found)
        groups, links, start = [], [], 0
        for end in sorted(set(tokens[0]) & set(tokens[1])):
            groups.append("|".join(",".join(str(i) for e, i in side.items() if start < e <= end) for side in tokens))
            links.append((tokens[0][end], tokens[1][end]))
            start = end
        counts.update(links)
        every.append((doc_id, len(a), len(b), ";".join(groups), links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted((
        (d, na, nb, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), groups)
        for d, na, nb, groups, links in every
    ), key=str)


def texts(count):
    rng = random.Random(count)
    words = ["the", "of", "naïve", "tokenizers", "a", "I'm", "1234", "x.y", "日本", "\n", "", "", "ét", "Zürich,", "aaaaaaab"]
    return [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(count)]


def test_table(spark):
    rows = [(k if k else None, t) for k, t in enumerate([*EDGES, *texts(150)])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, links int").repartition(3)
    got = alignment.align(docs, MERGES, PIECES).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    want = [tuple(w) for w in plain([r for r in rows if len(r[1] or "") < 20_000])]
    mine = sorted((tuple(r) for r in got.collect()), key=str)
    long = {k for k, t in rows if t and len(t) >= 20_000}
    assert len(mine) == len(rows)
    # The long text is only too slow for the plain version's notation; its counts are held in the others' sums.
    assert [m[:5] for m in mine if m[0] not in long] == [w[:5] for w in want]
    assert [m[7] for m in mine if m[0] not in long] == [w[7] for w in want]


def test_counts_over_many_chunks(spark):
    rows = list(enumerate([*EDGES[:-2], *texts(300)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)  # a chunk each
    got = alignments_of(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    want = [(*w[:7], sha256(w[7].encode()).hexdigest() if w[7] else "") for w in plain(rows)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_nothing_depends_on_what_is_remembered(monkeypatch):
    some = pa.array([t or "" for t in [*EDGES, *texts(100)]], pa.large_string())
    want = alignment.Pair(MERGES, PIECES).align(some)
    for limits in ({"REMEMBERED": 3}, {"WINDOWS": 2}, {"LONG": 0}):
        for name, value in limits.items():
            monkeypatch.setattr(alignment, name, value)
        own = alignment.Pair(MERGES, PIECES)
        for _ in range(2):
            got = own.align(some)
            assert all(list(got[c]) == list(want[c]) for c in want)


def test_empty_table(spark):
    assert alignments_of(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bytes_that_neither_gives_back():
    own = alignment.Pair(MERGES, PIECES)
    assert own.align(pa.array(["a▁b"], pa.large_string()))["n_groups"].tolist() == [0]
