"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a state machine.

A merge rule can only be disturbed from its right by rules of higher rank that
take a part of its right token away, and these in turn only by rules of still
higher rank. So the merge list itself says how many symbols to the right of a
token can have any influence on it: its sufficient lookahead, computed once
from the rules (``Merges.lookahead``). A ``Transducer`` holds one block of
symbols and that lookahead; tokens that end further than the lookahead from
what has been read are stable, are emitted and forgotten. Nothing ever crosses
the end of a stable token, so the rest is encoded as if it began there.

Texts are read in windows that end at white space, which no piece crosses.
Pieces are encoded once per window at most, and remembered up to a fixed
number, so beyond a text and its result memory does not depend on its length;
one word longer than a window goes through the transducer segment by segment.

Decoding feeds ids to a state machine: byte-level tokenizers turn bytes into
text, holding back an unfinished UTF-8 sequence; a tokenizer without decoder
joins its tokens by one space, as its library does.

Null and empty texts have no ids and an empty decoded text. Repeated rows give
equal rows, there are no ties, an empty table gives no rows, and columns other
than the two named ones are not touched.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import json
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemart.llm.text import SPACE_BYTES, column, slices, split_words, strings, texts_of, windows, word_codes

#: Bytes of text in a window, and characters of a longer word in a segment.
WINDOW_BYTES, SEGMENT = 4 << 20, 1 << 16
#: Symbols that a transducer reads before it looks for stable tokens, besides the lookahead.
BLOCK = 1024
#: Distinct pieces that a worker remembers, and the longest of them in characters.
REMEMBERED, LONG = 250_000, 200
#: Characters up to which a piece may be something else than a run of one kind.
CLOSED = 4
#: Up to so many symbols the best pair is looked for in all of them; beyond, in a heap.
SHORT = 48
#: A word without special tokens' signs that ends in ASCII punctuation after a letter or digit.
_TAIL = r"^([^<|]*[A-Za-z0-9])[!-/:-@\[-`{-~]+$"


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


LETTERS = byte_letters()
BYTES = {letter: b for b, letter in enumerate(LETTERS)}


@dataclass
class Merges:
    """A vocabulary with its merge rules in order of rank; ``suffix`` marks the last symbol of a piece."""

    vocab: dict[str, int]
    rules: list[tuple[str, str]]
    suffix: str = ""
    pairs: dict[tuple[int, int], tuple[int, int]] = field(init=False)

    def __post_init__(self) -> None:
        self.pairs = {
            (self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(self.rules)
        }

    @classmethod
    def load(cls, path: str) -> Merges:
        model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
        if model["type"] != "BPE" or model["dropout"] or model["ignore_merges"] or model["continuing_subword_prefix"]:
            raise ValueError(f"{path} is not a plain list of merges")
        return cls(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"] or "")

    def _symbols(self, token: str) -> int:
        return len(token) - (len(self.suffix) if self.suffix and token.endswith(self.suffix) else 0)

    @functools.cached_property
    def lengths(self) -> dict[int, int]:
        """Symbols in each token."""
        return {i: self._symbols(token) for token, i in self.vocab.items()}

    @functools.cached_property
    def lookahead(self) -> int:
        """Symbols after a token's end that can have influence on it.

        For a rule (x, y) these are y itself and, for each token z at y's right
        end (y, its right part, the right part of that ...), what the rules
        (z, ...) need that rank before the rule by which z becomes part of y,
        or of the pair. Ranks fall at each step, so one pass over the rules in
        order of rank is enough.
        """
        made: dict[str, list[int]] = {}
        known: dict[str, tuple[list[int], list[int]]] = {}  # by left token: ranks, greatest need so far
        greatest = 0
        for rank, (x, y) in enumerate(self.rules):
            for part in (x, y):
                if self._symbols(part) > 1 and part not in made:
                    raise ValueError(f"rule {rank} uses {part!r}, which no rule before it makes")
            beyond, ends = 0, [(y, rank)]
            while ends:
                z, before = ends.pop()
                ranks, needs = known.get(z, ((), ()))
                if at := bisect_left(ranks, before):
                    beyond = max(beyond, needs[at - 1])
                ends += [(self.rules[r][1], r) for r in made.get(z, ()) if r < before]
            need = self._symbols(y) + beyond
            ranks, needs = known.setdefault(x, ([], []))
            ranks.append(rank)
            needs.append(max(need, needs[-1] if needs else 0))
            made.setdefault(x + y, []).append(rank)
            greatest = max(greatest, need)
        return greatest

    def symbols(self, letters: str, ends: bool) -> list[int]:
        """Ids of single letters; the last one carries the suffix if the piece ends there."""
        ids = [self.vocab[c] for c in letters]
        if ends and self.suffix and ids:
            ids[-1] = self.vocab[letters[-1] + self.suffix]
        return ids

    def merge(self, ids: list[int]) -> list[int]:
        """All rules applied, the best-ranked pair first and from the left."""
        return self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        pairs, none = self.pairs, (len(self.rules), 0)
        ranks = [pairs.get(p, none) for p in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best is none:
                break
            at = ranks.index(best)
            ids[at:at + 2] = [best[1]]
            del ranks[at]
            if at:
                ranks[at - 1] = pairs.get((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = pairs.get((ids[at], ids[at + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        pairs, n = self.pairs, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*found, k, ids[k]) for k in range(n - 1) if (found := pairs.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        heap_pop, heap_push = heapq.heappop, heapq.heappush
        while heap:
            rank, made, k, left = heap_pop(heap)
            right = after[k]
            if ids[k] != left or right >= n or pairs.get((left, ids[right]), (-1, 0))[0] != rank:
                continue
            ids[k], ids[right] = made, -1
            after[k] = following = after[right]
            if following < n:
                before[following] = k
                if found := pairs.get((made, ids[following])):
                    heap_push(heap, (*found, k, made))
            if (previous := before[k]) >= 0 and (found := pairs.get((ids[previous], made))):
                heap_push(heap, (*found, previous, ids[previous]))
        return [i for i in ids if i >= 0]


class Transducer:
    """Symbols of one piece in, tokens out as soon as nothing to come can change them."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.held: list[int] = []

    def feed(self, symbols: Iterable[int]) -> Iterator[int]:
        for symbol in symbols:
            self.held.append(symbol)
            if len(self.held) >= BLOCK + self.merges.lookahead:
                yield from self._stable()

    def _stable(self) -> list[int]:
        most, end, tokens = len(self.held) - self.merges.lookahead, 0, []
        for token in self.merges.merge(self.held.copy()):
            if end + self.merges.lengths[token] > most:
                break
            tokens.append(token)
            end += self.merges.lengths[token]
        del self.held[:end]
        return tokens

    def whole(self, symbols: Iterable[int]) -> Iterator[int]:
        yield from self.feed(symbols)
        yield from self.finish()

    def finish(self) -> list[int]:
        tokens, self.held = self.merges.merge(self.held), []
        return tokens


class Detokenizer:
    """Ids in, text out: a machine whose state is an unfinished character, or whether a token came before."""

    def __init__(self, tokens: dict[int, str], byte_level: bool) -> None:
        self.tokens, self.byte_level = tokens, byte_level
        self.restart()

    def restart(self) -> None:
        self.began = False
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        tokens = [self.tokens[i] for i in ids]
        if self.byte_level:
            return self.bytes.decode(b"".join(map(token_bytes, tokens)))
        text = " ".join(tokens)
        if tokens and self.began:
            text = f" {text}"
        self.began |= bool(tokens)
        return text

    def finish(self) -> str:
        rest = self.bytes.decode(b"", True)
        self.restart()
        return rest


def token_bytes(token: str) -> bytes:
    """The bytes of a byte-level token; a token of other letters stands for its own text."""
    try:
        return bytes(BYTES[c] for c in token)
    except KeyError:
        return token.encode()


class Encoder:
    """One tokenizer file: its own normalisation and pieces, this module's merging."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges.load(path)
        about = json.loads(Path(path).read_text(encoding="utf-8"))
        decoder = (about["decoder"] or {}).get("type")
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"{path} has a decoder of another kind: {decoder}")
        self.byte_level = decoder == "ByteLevel"
        self.special = {t["content"]: t["id"] for t in about["added_tokens"]}
        if any(t[k] for t in about["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has added tokens that do not stand for their exact text")
        parts = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.cut = re.compile(f"({parts})") if parts else re.compile("((?!))")
        self.tokens = {i: t for t, i in self.merges.vocab.items()} | {i: t for t, i in self.special.items()}
        if self._normal("A") != "a" or [p for p, _ in self._pieces("a b")] != ["a", "b"]:
            raise ValueError(f"{path} does not lower-case, or has pieces that hold white space")
        self.by_piece: dict[str, tuple[bytes, str]] = {}
        self.machine = Detokenizer(self.tokens, self.byte_level)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of some ids alone."""
        return self.machine.feed(ids) + self.machine.finish()

    def _pieces(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(text)

    def _normal(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text

    def _symbols(self, text: str, ends: bool) -> list[int]:
        return self.merges.symbols("".join([LETTERS[b] for b in text.encode()]), ends)

    def _piece(self, letters: str) -> Iterable[int]:
        symbols = self.merges.symbols(letters, True)
        if len(symbols) < BLOCK:  # nothing would be emitted before its end
            return self.merges.merge(symbols)
        return Transducer(self.merges).whole(symbols)

    def ids(self, text: str) -> Iterator[int]:
        """Ids of any text, as they become stable."""
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                yield self.special[part]
            elif len(part) <= SEGMENT:
                for piece, _ in self._pieces(self._normal(part)):
                    yield from self._piece(piece)
            else:
                yield from self._streamed(part)

    def _streamed(self, text: str) -> Iterator[int]:
        """A long text by segments; a run open at a segment's end goes on in the next one.

        A piece of over ``CLOSED`` characters at the end is a run of characters
        of one kind and may go on. It is fed but for its last character; this
        one, twice, begins the next segment, so that the pattern of pieces
        continues the run. Shorter pieces at the end wait for the next segment.
        """
        machine, waiting = None, ""
        for segment in _segments(text):
            lead = (waiting * 2 if machine else waiting) + self._normal(segment)
            waiting = ""
            for piece, (start, end) in self._pieces(lead):
                run = lead[start + 1:end] if machine else lead[start:end]
                if end == len(lead) and not machine and len(run) <= CLOSED:
                    waiting = run
                elif end == len(lead):
                    machine = machine or Transducer(self.merges)
                    yield from machine.feed(self._symbols(run[:-1], False))
                    waiting = run[-1]
                elif machine:
                    yield from machine.feed(self._symbols(run, True))
                    yield from machine.finish()
                    machine = None
                else:
                    yield from self._piece(piece)
        if machine:
            yield from machine.feed(self._symbols(waiting, True))
            yield from machine.finish()
        else:
            for piece, _ in self._pieces(waiting):
                yield from self._piece(piece)

    def _remembered(self, word: str) -> tuple[bytes, str]:
        found = self.by_piece.get(word)
        if found is None:
            lower = word.isascii() and word.isalpha() and word.islower()
            ids = list(self._piece(word) if lower else self.ids(word))
            found = array("I", ids).tobytes(), self.decode(ids)
            if len(word) <= LONG:
                if len(self.by_piece) >= REMEMBERED:
                    self.by_piece.clear()
                self.by_piece[word] = found
        return found

    def words(self, words: pa.Array) -> tuple[list[bytes], list[str]]:
        """Ids and decoded text of each of some words without white space."""
        # The strings of special tokens count as they are written, and marks join before letters are lowered.
        plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<|")))
        lower = pc.if_else(plain, pc.ascii_lower(words), words)
        heads = strings(pc.replace_substring_regex(lower, _TAIL, r"\1"))
        ids, texts = [], []
        known = self._remembered
        for head, word in zip(heads, strings(lower), strict=True):
            a, b = known(head)
            if len(head) < len(word):
                c, d = known(word[len(head):])
                a, b = a + c, f"{b} {d}"
            ids.append(a)
            texts.append(b)
        return ids, texts

    def texts(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Ids and decoded texts of whole texts, none of which is longer than a window by much."""
        words, bounds = split_words(texts)
        codes, distinct = word_codes(words)
        pieces, decoded = self.words(distinct)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        if len(sizes) and not sizes.all():  # words of other white space have no tokens
            real = sizes[codes] > 0
            before = np.concatenate(([0], np.cumsum(real)))
            codes, bounds = codes[real], before[bounds]
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(pieces), np.uint32)
        long = sizes[codes]
        ends = np.cumsum(long)
        ids = flat[np.repeat(starts[codes] - (ends - long), long) + np.arange(ends[-1] if len(ends) else 0)]
        per_text = np.concatenate(([0], ends))[bounds]
        parts = pa.array(decoded, pa.string()).take(pa.array(codes))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), parts), " ")
        listed = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), pa.array(ids.astype(np.int32)))
        return listed, joined

    def long_text(self, text: pa.Buffer | bytes) -> tuple[pa.Array, pa.Array]:
        """One text of any length, window by window."""
        ids, texts = [], []
        for start, end in windows(text, WINDOW_BYTES, SPACE_BYTES):
            window = pa.array([memoryview(text)[start:end]], pa.large_binary()).cast(pa.large_string())
            a, b = self.texts(window)
            if len(a.values):
                ids.append(a.values)
                texts.append(b[0].as_py())
        every = pa.concat_arrays(ids) if ids else pa.array([], pa.int32())
        return pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every), pa.array([" ".join(texts)], pa.string())


def _segments(text: str) -> Iterator[str]:
    """Parts that normal forms do not join: no cut before a mark or a Korean vowel or final."""
    at = 0
    while at < len(text):
        end = at + SEGMENT
        while end < len(text) and (
            unicodedata.category(text[end])[0] == "M" or 0x1160 <= ord(text[end]) < 0x1200 or text[end] in "\U00016D63\U00016D67"
        ):
            end += 1
        yield text[at:end]
        at = end


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, tokenizer: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, token ``ids`` and the ``decoded`` text of each row of ``docs``.

    ``tokenizer`` is a byte-level merge list whose pieces end at white space
    and hold none of it, with lower-casing. Rows stay where they are: nothing
    is shuffled.
    """
    kind = docs.schema[id_column].dataType
    schema = T.StructType([
        T.StructField(id_column, kind), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("decoded", T.StringType()),
    ])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            texts = texts_of(batch, text_column)
            lengths = np.asarray(pc.binary_length(texts))
            for start, end in slices(lengths, WINDOW_BYTES):
                some = texts.slice(start, end - start)
                if lengths[start] > WINDOW_BYTES:
                    ids, decoded = own.long_text(some[0].as_buffer())
                else:
                    ids, decoded = own.texts(some)
                rows = column(batch, id_column).slice(start, end - start)
                yield pa.RecordBatch.from_arrays([rows, ids, decoded], [id_column, "ids", "decoded"])

    return docs.select(id_column, text_column).mapInArrow(encoded, schema)


def digests(encoded: DataFrame, *, id_column: str = "doc_id") -> DataFrame:
    """Number of tokens, and SHA-256 of the decimal ids joined by one space and of the decoded text."""
    return encoded.select(
        id_column, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
