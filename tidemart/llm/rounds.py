"""Questions from chunks of documents to ranges of hashes, and their answers.

Several operators must know, for every hash in a document, something about
that hash in all documents: how often it occurs, or whether it occurs
elsewhere. Documents are dealt into chunks of bounded size. A chunk sorts its
distinct hashes and sends each range of them as one packed array, so a hash
is sent once per chunk however often it occurs there. The task of a range
merges the arrays of all chunks and answers each in the order it was asked.
The chunk then meets its answers. Documents are shuffled once: Spark uses that
exchange again where the chunks ask and where they get their answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.text import column

#: Bytes that a row counts for besides its text, so that many short texts share no chunk.
ROW_BYTES = 64
#: Bytes of text in a chunk, and of packed hashes in a range, on average.
CHUNK_BYTES = 6 << 20
RANGE_BYTES = 8 << 20

_ASKED = "range long, chunk long, kind int, blob binary"
_ANSWERED = "chunk long, range long, kind int, blob binary"


@dataclass(frozen=True)
class Chunks:
    """Documents dealt by ``chunk``; ``weight`` is the bytes of their texts and rows."""

    rows: DataFrame
    number: int
    weight: int

    def ranges(self, share: float) -> int:
        """Ranges so that each gets ``RANGE_BYTES`` if all of them get ``share`` of the weight."""
        return max(1, int(self.weight * share) // RANGE_BYTES)


def deal(rows: DataFrame, measure: str) -> Chunks:
    """``rows`` dealt into chunks by a hash of all columns; ``measure`` is the column whose bytes count."""
    each = F.coalesce(F.octet_length(measure), F.lit(0)).cast("long") + ROW_BYTES
    weight = rows.agg(F.coalesce(F.sum(each), F.lit(0)).alias("w")).first().w
    number = max(1, -(-weight // CHUNK_BYTES))
    chunk = F.pmod(F.xxhash64(*rows.columns), F.lit(number))
    return Chunks(rows.withColumn("chunk", chunk).repartition(number, "chunk"), number, weight)


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit numbers as differences, byte by byte: the high bytes vanish in compression."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return squeeze(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(expand(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack(values: np.ndarray) -> bytes:
    """Fixed-width numbers, byte by byte."""
    width = values.dtype.itemsize
    return squeeze(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(expand(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def join_blobs(parts: Iterable[bytes]) -> bytes:
    parts = list(parts)
    return np.array([len(parts), *map(len, parts)], "<u8").tobytes() + b"".join(parts)


def split_blobs(data: bytes) -> list[bytes]:
    count = int(np.frombuffer(data, "<u8", 1)[0])
    sizes = np.frombuffer(data, "<u8", count, 8).astype(np.int64)
    ends = 8 + 8 * count + np.cumsum(sizes)
    return [data[e - s:e] for s, e in zip(sizes, ends, strict=True)]


def cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where the hash ranges begin and end in sorted ``keys``."""
    edges = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


#: What a chunk asks: (kind, range, blob) each.
Ask = Callable[[pa.Table], Iterator[tuple[int, int, bytes]]]
#: Answers for one kind and range: the blobs of all chunks in, one blob for each out.
Answer = Callable[[int, list[bytes]], list[bytes]]


def ask(chunks: DataFrame, questions: Ask) -> DataFrame:
    def asked(key: tuple, table: pa.Table) -> pa.Table:
        found = list(questions(table))
        return pa.table({
            "range": pa.array([r for _, r, _ in found], pa.int64()),
            "chunk": pa.array([key[0].as_py()] * len(found), pa.int64()),
            "kind": pa.array([k for k, _, _ in found], pa.int32()),
            "blob": pa.array([b for _, _, b in found], pa.binary()),
        })

    return chunks.groupBy("chunk").applyInArrow(asked, _ASKED)


def answer(asked: DataFrame, answers: Answer) -> DataFrame:
    def answered(key: tuple, table: pa.Table) -> pa.Table:
        blobs = answers(key[1].as_py(), [b.as_py() for b in column(table, "blob")])
        return pa.table({
            "chunk": column(table, "chunk"), "range": column(table, "range"), "kind": column(table, "kind"),
            "blob": pa.array(blobs, pa.binary()),
        })

    return asked.groupBy("range", "kind").applyInArrow(answered, _ANSWERED)


class Answers(dict):
    """A chunk's answers by kind, each as the blobs of the ranges it asked, in order."""

    def __init__(self, table: pa.Table) -> None:
        super().__init__()
        rows = zip(column(table, "kind").to_pylist(), column(table, "range").to_pylist(),
                   (b.as_py() for b in column(table, "blob")), strict=True)
        for kind, _, blob in sorted(rows, key=lambda r: r[:2]):
            self.setdefault(kind, []).append(blob)


def meet(chunks: DataFrame, answered: DataFrame, finish: Callable[[pa.Table, Answers], pa.Table], schema: str) -> DataFrame:
    """Each chunk with the answers it got."""

    def met(table: pa.Table, answers: pa.Table) -> pa.Table:
        return finish(table, Answers(answers))

    return chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(met, schema)
