"""Alignment of two tokenizers' tokens: windows between white-space anchors, each aligned once.

Each text, with a space before it, is tokenised whole by a byte-level merge
list (A) and by a piece model (B). Where both have a token that ends at the
same byte and both next tokens begin with a space, the text has an anchor; the
tokens between two anchors are a window. A window's alignment depends on its
token ids alone, so it is remembered under them: byte ends that both share cut
it into groups, and at each shared end one token of A links to one of B.
Before anything is aligned, the bytes of A's and of B's tokens are verified
against the text, stretch by stretch; a text that either does not give back has no tokens here.

How often a pair of ids is linked in the corpus is asked once per chunk of
documents: chunks send their distinct pairs with counts, Spark adds them up and
finds each B id's highest, and the sums go back to the chunks that asked, so a
pair that all texts hold costs a row per chunk. Links themselves stay with
their documents, as places among the chunk's pairs.

Null and empty texts have no tokens. Repeated rows are documents of their own
and count each; ties for the highest count are all best. An empty table gives
no rows. No token of either vocabulary goes on beyond a single space between
other characters, so texts are tokenised by the stretches between such spaces
and equal stretches once, however long a text is. Columns other than the two
named ones are not touched.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tidemart.llm.bpe_stream import Merges, token_bytes
from tidemart.llm.rounds import pack, unpack
from tidemart.llm.text import column, slices, texts_of
from tidemart.session import pin

#: Bytes of text in a chunk, and tokenised at a time.
CHUNK_BYTES, STEP_BYTES = 16 << 20, 2 << 20
#: Distinct stretches and windows that a worker remembers, and the ids in the longest window.
REMEMBERED, WINDOWS, LONG = 250_000, 60_000, 64
#: A single space that ends a token of both sides: between letters, digits or printable ASCII.
_CUT = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
# The setting and the pattern of byte-level pieces.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Pair:
    """Two tokenizers with the bytes of each of their tokens."""

    def __init__(self, merges_path: str, pieces_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives each task its core
        self.a = Tokenizer.from_file(merges_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        about = json.loads(Path(merges_path).read_text(encoding="utf-8"))
        vocab = about["model"]["vocab"] | {t["content"]: t["id"] for t in about["added_tokens"]}
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = token_bytes(token)
        self.plain = _same_merges(merges_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        if any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(len(b_bytes))):
            raise ValueError(f"{pieces_path} has pieces with a space after other characters")
        self.bytes = a_bytes, b_bytes
        self.sizes = tuple([len(t) for t in side] for side in self.bytes)
        self.names = [str(i) for i in range(max(map(len, self.bytes)))]
        self.spaced = tuple([t[:1] == b" " for t in side] for side in self.bytes)
        self.stretches: dict[str, tuple[int, int, int, str, bytes] | None] = {}
        self.known: dict[tuple[tuple[int, ...], tuple[int, ...]], tuple[str, bytes]] = {}

    def remember(self, new: list[str]) -> None:
        """Tokenise, verify and align stretches that are not known yet."""
        spaced = [f" {s}" for s in new]
        quick = [self.plain is not None and s.isascii() for s in new]
        rest = iter(self.a.encode_batch_fast([s for s, q in zip(spaced, quick, strict=True) if not q], add_special_tokens=False))
        side_a, side_b = self.bytes
        for s, own, q, b in zip(new, spaced, quick, self.b.encode(new, num_threads=1), strict=True):
            a = self.plain(own) if q else next(rest).ids
            content = own.encode()
            if content == b"".join([side_a[i] for i in a]) == b"".join([side_b[i] for i in b]):
                groups, links = self.aligned(a, b)
                self.stretches[s] = len(a), len(b), len(links) // 8, groups, links
            else:
                self.stretches[s] = None

    def aligned(self, a: list[int], b: list[int]) -> tuple[str, bytes]:
        """Groups and links of verified tokens, window by window."""
        spaced_a, spaced_b = self.spaced
        if not any([spaced_a[i] for i in a[1:]]):  # no anchor but the end
            return self.window(tuple(a), tuple(b))
        size_a, size_b = self.sizes
        found, ahead, first_a, first_b, at_b = [], 0, 0, 0, 0
        for at_a, i in enumerate(a, 1):
            ahead += size_a[i]
            while ahead > 0:
                ahead -= size_b[b[at_b]]
                at_b += 1
            if not ahead and (at_a == len(a) or spaced_a[a[at_a]] and spaced_b[b[at_b]]):
                found.append(self.window(tuple(a[first_a:at_a]), tuple(b[first_b:at_b])))
                first_a, first_b = at_a, at_b
        return ";".join([groups for groups, _ in found]), b"".join([links for _, links in found])

    def window(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[str, bytes]:
        """A window's groups in notation, and its links as packed pairs of ids."""
        if found := self.known.get((a, b)):
            return found
        groups, links = [], []
        names, (size_a, size_b) = self.names, self.sizes
        ahead, first_a, first_b, at_b = 0, 0, 0, 0  # bytes by which A's tokens so far go beyond B's
        for at_a, i in enumerate(a, 1):
            ahead += size_a[i]
            while ahead > 0:
                ahead -= size_b[b[at_b]]
                at_b += 1
            if not ahead:
                left = names[i] if at_a - first_a == 1 else ",".join([names[t] for t in a[first_a:at_a]])
                last = b[at_b - 1]
                right = names[last] if at_b - first_b == 1 else ",".join([names[t] for t in b[first_b:at_b]])
                groups.append(f"{left}|{right}")
                links.append(i | last << 32)
                first_a, first_b = at_a, at_b
        found = ";".join(groups), array("Q", links).tobytes()
        if len(a) + len(b) <= LONG:
            if len(self.known) >= WINDOWS:
                self.known.clear()
            self.known[a, b] = found
        return found

    def align(self, texts: pa.Array) -> dict[str, np.ndarray | pa.Array]:
        """Per text: numbers of tokens and groups (as many links) and the groups' notation; all texts' links.

        Both tokenise the stretches between single spaces apart, and each such
        space is an anchor, so equal stretches are tokenised, verified and
        aligned once; A's space stands before a stretch, B adds it.
        """
        cut = [_CUT.split(text) if text else [] for text in texts.to_pylist()]
        places: dict[str, int] = {}
        codes = np.array([places.setdefault(s, len(places)) for own in cut for s in own], np.int64)
        if new := [s for s in places if s not in self.stretches]:
            if len(self.stretches) + len(new) > REMEMBERED:
                self.stretches = {s: self.stretches[s] for s in places if s in self.stretches}
            self.remember(new)
        known = [self.stretches[s] or (0, 0, 0, "", b"") for s in places]
        of = np.repeat(np.arange(len(cut)), [len(own) for own in cut])
        fits = np.array([bool(own) for own in cut], bool)
        fits[of[np.array([k[0] == 0 for k in known], bool)[codes]]] = False
        codes, of = codes[fits[of]], of[fits[of]]
        sizes = np.array([k[:3] for k in known], np.int64).reshape(-1, 3)
        n_a, n_b, n_groups = (np.bincount(of, sizes[codes, c], len(cut)).astype(np.int64) for c in range(3))
        notes = pa.array([k[3] for k in known], pa.string()).take(pa.array(codes))
        per_text = np.searchsorted(of, np.arange(len(cut) + 1))
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
            "groups": pc.binary_join(pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), notes), ";"),
            "links": gather(np.frombuffer(b"".join([k[4] for k in known]), np.uint64), sizes[:, 2], codes),
        }


def _same_merges(path: str) -> Callable[[str], list[int]] | None:
    """A quicker encoder of ASCII texts, if it provably does the same as the file.

    It joins any two tokens that together are a token, by that token's id. The
    rules do the same if ids follow rank and every token's own text comes out
    as this one token: tokens x, y that together are t, with nothing across
    t's ends, arise from t's own text alone, and there t's rule is the last.
    """
    merges = Merges.load(path)
    made = [merges.pairs[merges.vocab[x], merges.vocab[y]][1] for x, y in merges.rules]
    if merges.suffix or made != sorted(made) or json.loads(Path(path).read_text(encoding="utf-8"))["pre_tokenizer"] != _BYTE_LEVEL:
        return None
    if any(merges.merge(merges.symbols(token, True)) != [i] for token, i in merges.vocab.items()):
        return None
    ranks = {token_bytes(token): i for token, i in merges.vocab.items()}
    return tiktoken.Encoding("merges", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def gather(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The parts of ``flat`` with these places, one after the other; ``sizes`` are those of all parts."""
    starts, ends = np.cumsum(sizes) - sizes, np.cumsum(sizes[codes])
    return flat[np.repeat(starts[codes] - (ends - sizes[codes]), sizes[codes]) + np.arange(ends[-1] if len(ends) else 0)]


@functools.lru_cache(maxsize=1)
def pair(merges_path: str, pieces_path: str) -> Pair:
    return Pair(merges_path, pieces_path)


class Places:
    """A chunk's distinct pairs in the order they are first seen, and how often each occurs."""

    def __init__(self) -> None:
        self.of: dict[int, int] = {}
        self.times: list[int] = []

    def add(self, links: np.ndarray) -> np.ndarray:
        """The place of each link's pair."""
        pairs, where, times = np.unique(links, return_inverse=True, return_counts=True)
        places = [self.of.setdefault(pair, len(self.of)) for pair in pairs.tolist()]
        self.times += [0] * (len(self.of) - len(self.times))
        for place, count in zip(places, times.tolist(), strict=True):
            self.times[place] += count
        return np.array(places, np.uint32)[where]


def tokens_and_windows(docs: DataFrame, merges_path: str, pieces_path: str, id_column: str, text_column: str) -> DataFrame:
    """A row per document with its links as places among its chunk's pairs, and a row per chunk with these."""
    kept = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField(id_column, docs.schema[id_column].dataType),
        *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")),
        *(T.StructField(c, kind) for c, kind in (("groups", T.StringType()), ("links", T.BinaryType()))),
        *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("a", "b", "times")),
    ])
    shape = to_arrow_schema(kept)

    def table(chunk: int, **columns: pa.Array) -> pa.RecordBatch:
        rows = len(next(iter(columns.values())))
        values = {"chunk": pa.array(np.full(rows, chunk)), **columns}
        return pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(rows, f.type)).cast(f.type) for f in shape], schema=shape)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, numbers = pair(merges_path, pieces_path), itertools.count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            texts = texts_of(batch, text_column)
            sizes = np.asarray(pc.binary_length(texts))
            for first, last in slices(sizes, CHUNK_BYTES):
                chunk, places = next(numbers), Places()
                for start, end in slices(sizes[first:last], STEP_BYTES):
                    got = own.align(texts.slice(first + start, end - start))
                    links = np.split(places.add(got.pop("links")), np.cumsum(got["n_groups"])[:-1])
                    yield table(
                        chunk, **{id_column: column(batch, id_column).slice(first + start, end - start)},
                        links=pa.array([pack(own_links) for own_links in links], pa.binary()), **{c: pa.array(v) for c, v in got.items()},
                    )
                pairs = np.fromiter(places.of, np.uint64, len(places.of))
                low = pairs & np.uint64(0xFFFFFFFF)
                yield table(chunk, **{
                    c: pa.array([v]) for c, v in (("a", low), ("b", pairs >> np.uint64(32)), ("times", np.array(places.times)))
                })

    return docs.select(id_column, text_column).mapInArrow(aligned, kept)


def align(docs: DataFrame, merges_path: str, pieces_path: str, *, id_column: str = "doc_id", text_column: str = "text",
          notes: dict[str, Column] | None = None) -> DataFrame:
    """Each document with ``n_a``, ``n_b``, ``n_groups``, ``groups``, ``n_links``, ``n_best`` and ``count_sum``.

    ``groups`` is the notation ``a1,a2|b1;a3|b2,b3``; ``notes`` keeps columns
    made of it instead. ``n_best`` counts the links whose pair is the most
    frequent one of its B id in all documents, ``count_sum`` adds up how often
    the pair of each link occurs in all documents.
    """
    notes = {"groups": F.col("groups")} if notes is None else notes
    found = tokens_and_windows(docs, merges_path, pieces_path, id_column, text_column)
    counts = ("n_a", "n_b", "n_groups")
    table = pin(found.select("chunk", id_column, *counts, *(c.alias(n) for n, c in notes.items()), "links", "a", "b", "times"), "alignments")
    texts, chunks = table.filter("links IS NOT NULL").drop("a", "b", "times"), table.filter("links IS NULL")
    asked = chunks.select("chunk", F.posexplode(F.arrays_zip("a", "b", "times"))).select("chunk", F.col("pos").alias("place"), "col.*")
    pairs = pin(asked.groupBy("b", "a").agg(F.sum("times").alias("n")), "pairs")
    # A B id has at most as many pairs as there are A ids.
    best = pairs.groupBy("b").agg(F.max("n").alias("most"))
    told = asked.select("chunk", "place", "b", "a").join(pairs.join(best, "b"), ["b", "a"])
    answers = told.select(F.col("chunk").alias("asker"), "place", "n", (F.col("n") == F.col("most")).alias("best"))
    names = [id_column, *counts, *notes]
    kept = T.StructType([*(texts.schema[n] for n in names), *(T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum"))])
    shape = to_arrow_schema(kept)

    def counted(rows: pa.Table, answered: pa.Table) -> pa.Table:
        place = np.asarray(column(answered, "place"))
        n, best = (np.zeros(len(place), kind) for kind in (np.int64, np.int64))
        n[place], best[place] = np.asarray(column(answered, "n")), np.asarray(column(answered, "best"))
        links = [unpack(blob.as_py(), np.uint32) for blob in column(rows, "links")]
        sums = [[len(own) for own in links], *([int(v[own].sum()) for own in links] for v in (best, n))]
        return pa.Table.from_arrays([*(column(rows, c) for c in names), *(pa.array(v, pa.int64()) for v in sums)], schema=shape)

    return texts.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(counted, kept)
