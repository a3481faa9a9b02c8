"""Reading tables, cutting texts into words and hashing them, for the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]"
#: The same as a table of bytes.
SPACE_BYTES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    """One column of a batch or table as a single array."""
    values = batch.column(batch.schema.get_field_index(name))
    return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values


def texts_of(batch: pa.RecordBatch | pa.Table, name: str = "text") -> pa.Array:
    """The texts, null as empty, with 64-bit offsets so that no batch is too long."""
    return pc.fill_null(column(batch, name).cast(pa.large_string()), "")


def slices(lengths: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges whose lengths sum to about ``most``; a longer row has a range of its own."""
    total = np.concatenate(([0], np.cumsum(lengths)))
    cuts, start = [], 0
    while start < len(lengths):
        end = max(start + 1, int(np.searchsorted(total, total[start] + most, side="right")) - 1)
        cuts.append((start, end))
        start = end
    return cuts


def windows(text: pa.Buffer | bytes, most: int, gap: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of one long text, each of up to ``most`` bytes and ending after a ``gap`` byte.

    A longer stretch without any gap is a range of its own.
    """
    data, at = np.frombuffer(text, np.uint8), 0
    while at < len(data):
        end = at + most
        if end >= len(data):
            end = len(data)
        elif len(found := np.flatnonzero(gap[data[at:end]])):
            end = at + int(found[-1]) + 1
        else:
            while end < len(data) and not len(found := np.flatnonzero(gap[data[end:end + most]])):
                end += most
            end = min(len(data), end + int(found[0]) + 1) if end < len(data) else len(data)
        yield at, end
        at = end


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and where each text's words begin and end."""
    parts = pc.ascii_split_whitespace(texts)
    words = parts.flatten()
    ends = np.asarray(parts.offsets, dtype=np.int64)
    ends = ends - ends[0]
    real = np.asarray(pc.greater(pc.binary_length(words), 0))
    if real.all():
        return words, ends
    before = np.concatenate(([0], np.cumsum(real)))
    return words.filter(pa.array(real)), before[ends]


def word_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each word its place among the distinct words, and these."""
    coded = words.dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary


def strings(values: pa.Array) -> list:
    """The values as Python objects; quicker than ``to_pylist``."""
    return values.to_numpy(zero_copy_only=False).tolist()


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def chained(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` neighbouring word hashes, one per position where they fit."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        value = mix(words[:count] + np.uint64(width))
        for k in range(1, width):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + words[k:count + k])
    return value


def powers(base: int, count: int) -> np.ndarray:
    """Powers of an odd number among 64-bit numbers, from the zeroth."""
    values = np.full(count, base, np.uint64)
    values[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(values)


class Powers:
    """Powers of a base and of its inverse, made once per worker."""

    BASE = 0x9E3779B97F4A7C15
    up = down = np.empty(0, np.uint64)

    @classmethod
    def of(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < count:
            cls.up, cls.down = powers(cls.BASE, count), powers(pow(cls.BASE, -1, 1 << 64), count)
        return cls.up[:count], cls.down[:count]


def part_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the parts of ``values`` (not zero, as unsigned 64-bit numbers) from starts to ends."""
    up, down = Powers.of(len(values) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


_IS_SPACE = SPACE_BYTES
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
#: Bytes whose hashes are made at a time; a longer word is taken whole.
_SEGMENT = 1 << 20


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and where each text's words begin and end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    if first == last:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first:last]
    edges = (offsets - first)[:-1]
    edges = edges[edges < len(data)]
    gap = _IS_SPACE[data]
    begins = np.ones(len(data), bool)
    begins[1:] = gap[:-1]
    begins[edges] = True
    stops = np.ones(len(data), bool)
    stops[:-1] = gap[1:]
    stops[edges[edges > 0] - 1] = True
    starts, ends = np.flatnonzero(begins & ~gap), np.flatnonzero(stops & ~gap) + 1
    found = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _SEGMENT, side="right")))
        a, b = int(starts[at]), int(ends[to - 1])
        found[at:to] = part_hashes(_LOWER[data[a:b]], starts[at:to] - a, ends[at:to] - a)
        at = to
    return found, np.searchsorted(starts, offsets - first)
