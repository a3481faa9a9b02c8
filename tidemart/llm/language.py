"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An
n-gram's vector binds the permuted vectors of its letters (each rotated by its
distance from the end, then multiplied); a text's vector bundles (adds) those
of its n-grams; a language's prototype bundles the texts learned for it. A
text's language is the prototype with the greatest cosine.

Texts are lower-cased; whatever is not a letter is a gap, and gaps count as
one. Bundling is linear, so learning sums n-gram counts per language in each
step; Spark then sums the languages' vectors by dimension. For the same reason
a very long text is taken in parts whose vectors are added: memory is that of
a step of text and a block of n-gram vectors, whatever the text's length.

Nulls and texts without letters have language ``und`` and score 0, as has
every text if nothing could be learned. Texts or languages that are null are
not learned from. Ties go to the language first by code point. Rows keep their
number, repeated ones too; further columns are kept as they are, but for those
named like the two results, which these replace.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.text import column, slices, strings, texts_of

UNKNOWN = "und"
DIMENSIONS = 1024
GRAM = 3
SEED = 6
#: Languages whose prototypes are sent to every task; more than these are refused.
LANGUAGES = 4096
#: Bytes of text taken at a time; a row counts for some bytes besides, as it has a vector.
STEP_BYTES, ROW_BYTES = 1 << 20, 1 << 10
#: N-grams whose vectors are bound at a time.
BLOCK = 4096
#: What stands for whatever is not a letter, and bits of a code point in an n-gram's number.
GAP, CODE_BITS = 32, 21


@functools.lru_cache(maxsize=20_000)
def letter(code: int) -> np.ndarray:
    """The random vector of a letter."""
    return np.random.default_rng((SEED, code)).integers(0, 2, DIMENSIONS, np.int8) * 2 - 1


@functools.lru_cache(maxsize=100_000)
def is_letter(code: int) -> bool:
    return chr(code).isalpha()


#: The distinct n-grams of a text in order, and how often each occurs.
Counts = tuple[np.ndarray, np.ndarray]


def lowered(text: str) -> str:
    # Lower case depends on a letter's neighbours for this letter alone; so texts may be cut anywhere.
    return text.replace("\u03a3", "\u03c3").lower()


def counted(padded: list[str]) -> tuple[list[Counts], np.ndarray]:
    """N-grams of texts that begin and end with a gap, and the letters and gaps of all of them."""
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in padded], np.empty(0, np.int64)
    seen = np.flatnonzero(np.bincount(codes))
    letters = np.full(int(seen[-1]) + 1, GAP, np.int64)
    known = [int(c) for c in seen if is_letter(int(c))]
    letters[known] = known
    marks = letters[codes]
    keep = np.ones(len(marks), bool)
    keep[1:] = (marks[1:] != GAP) | (marks[:-1] != GAP)
    before = np.concatenate(([0], np.cumsum(keep)))
    ends = before[np.cumsum([0, *map(len, padded)])]
    marks = marks[keep]
    grams = marks[:max(0, len(marks) - GRAM + 1)].copy()
    for k in range(1, GRAM):
        grams = (grams << CODE_BITS) | marks[k:k + len(grams)]
    counts = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        # The gap that a text begins with may be the one that ends the text before it.
        a = max(0, a - 1)
        counts.append(np.unique(grams[a:max(a, b - GRAM + 1)], return_counts=True))
    return counts, marks


def steps(texts: pa.Array) -> Iterator[tuple[int, list[Counts]]]:
    """N-gram counts of neighbouring texts, with the first one's row.

    A text longer than a step comes in several steps, each with its row; the
    last letters of one step stand before the next, so no n-gram is lost.
    """
    sizes = np.asarray(pc.binary_length(texts))
    for start, end in slices(sizes + ROW_BYTES, STEP_BYTES):
        if end - start > 1 or sizes[start] <= STEP_BYTES:
            yield start, counted([f" {lowered(t)} " for t in strings(texts.slice(start, end - start))])[0]
            continue
        data, at, before = memoryview(texts[start].as_buffer()), 0, " "
        while at < len(data):
            to = min(len(data), at + STEP_BYTES)
            while to < len(data) and data[to] & 0xC0 == 0x80:  # inside a character
                to -= 1
            after = " " if to == len(data) else ""
            counts, marks = counted([before + lowered(str(data[at:to], "utf-8")) + after])
            yield start, counts
            before, at = "".join(map(chr, marks[1 - GRAM:])), to


def bind(grams: np.ndarray) -> np.ndarray:
    """The vectors of n-grams: their letters' vectors, rotated by the distance from the end and multiplied."""
    vectors = np.ones((len(grams), DIMENSIONS), np.int8)
    for k in range(GRAM):
        letters, place = np.unique((grams >> (CODE_BITS * k)) & ((1 << CODE_BITS) - 1), return_inverse=True)
        vectors *= np.roll(np.stack([letter(int(c)) for c in letters]), k, axis=1)[place]
    return vectors.astype(np.float32)


def bundle(texts: list[Counts]) -> np.ndarray:
    """A vector per text: the sum of its n-grams' vectors, which are bound in blocks and not kept."""
    sums = np.zeros((len(texts), DIMENSIONS))
    distinct = np.unique(np.concatenate([g for g, _ in texts])) if texts else np.empty(0, np.int64)
    for at in range(0, len(distinct), BLOCK):
        block = distinct[at:at + BLOCK]
        vectors = bind(block)
        for k, (grams, counts) in enumerate(texts):
            a, b = np.searchsorted(grams, (block[0], block[-1] + 1))
            if a < b:
                sums[k] += counts[a:b].astype(np.float32) @ vectors[np.searchsorted(block, grams[a:b])]
    return sums


def merged(texts: list[Counts]) -> Counts:
    """The counts of several texts as those of one."""
    grams, place = np.unique(np.concatenate([g for g, _ in texts]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([c for _, c in texts]), len(grams)).astype(np.int64)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes of the languages of ``docs``: one vector per language, summed over all rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = column(batch, "lang").to_pylist()
            for start, texts in steps(texts_of(batch)):
                of: dict[str, list[Counts]] = {}
                for k, counts in enumerate(texts):
                    of.setdefault(langs[start + k], []).append(counts)
                vectors = bundle([merged(counts) for counts in of.values()])
                for name, vector in zip(of, vectors, strict=True):
                    sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["lang", "vector"]
            )

    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).dropna()
    parts = rows.mapInArrow(summed, "lang string, vector array<double>")
    by_place = parts.select("lang", F.posexplode("vector").alias("place", "value"))
    sums = by_place.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    vectors = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("vector"))
    found = vectors.select("lang", F.col("vector.value").alias("vector")).limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages; their prototypes would not fit in every task")
    return {r.lang: np.array(r.vector) for r in sorted(found, key=lambda r: r.lang)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine with that language's prototype."""
    names = list(prototypes)
    units = np.stack([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-300) for n in names]) if names else None
    docs = docs.drop("lang_pred", "score")

    def told(vectors: np.ndarray) -> Iterator[tuple[str, float]]:
        if units is None:
            yield from [(UNKNOWN, 0.0)] * len(vectors)
            return
        sizes = np.linalg.norm(vectors, axis=1)
        cosines = (vectors @ units.T) / np.maximum(sizes, 1e-300)[:, None]
        for size, row, best in zip(sizes, cosines, np.argmax(cosines, axis=1), strict=True):
            yield (names[best], min(1.0, max(0.0, float(row[best])))) if size > 0 else (UNKNOWN, 0.0)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, float]] = []
            rest = None
            for start, counts in steps(texts_of(batch, text)):
                vectors = bundle(counts)
                if start < len(found):  # more of a long text
                    vectors[0] += rest
                    found.pop()
                rest = vectors[-1]
                found.extend(told(vectors))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    added = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(compared, added)


def fold(key: Column, folds: int) -> Column:
    """The remainder of the crc32 of a key written as text."""
    return F.crc32(key.cast("string").cast("binary")) % folds
