"""Token-ID output: one zstandard frame per document, a trailing seek table, checksums.

A file is a sequence of independent zstandard frames, one per document, each
with zstandard's own content checksum and holding the document's token ids as
little-endian unsigned 32-bit integers. Two skippable frames follow: the index
(file order, then doc_id, whether it is null, and number of ids per document)
and the seek table of the public zstandard seekable format, with sizes and a
32-bit checksum of each frame's content. Any zstandard decoder reads the file;
a reader that has the seek table decompresses only the documents it wants.

Files are written and read by Spark, so any store that Spark reaches will do.
Spark's text writer puts a line separator after each row; each file has one
row, and the separator is the magic number that ends a seek table.

Rows are ordered by doc_id (nulls first), then text. Null texts are empty and
give the end id alone; repeated rows and repeated ids are kept; an empty table
gives no files. Columns other than the two named ones are not touched.
"""

from __future__ import annotations

import functools
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm.text import column, slices, split_words, strings, texts_of, word_codes
from tidemart.session import pin

# Fixed values of the zstandard seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
CHECKSUMS_PRESENT = 0x80

#: Bytes of token ids, uncompressed, after which a new file begins.
FILE_BYTES = 32 << 20
#: Bytes of text encoded at a time.
STEP_BYTES = 4 << 20
#: Distinct words whose ids a task remembers, at most.
REMEMBERED = 200_000
#: A word without special tokens' signs that ends in ASCII punctuation after a letter or digit.
_TAIL = r"^([^<|]*[a-z0-9])[!-/:-@\[-`{-~]+$"


class WordEncoder:
    """Ids of words, each distinct word encoded once and remembered.

    The tokenizer lower-cases, and its pieces never cross white space, so a
    text's ids are those of its words in order. Trailing ASCII punctuation
    after a letter or digit is a piece of its own. Words of ASCII letters go
    straight to the tokenizer's model; all others take its whole path.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}

    def _ids(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            ids = [token.id for token in self.tokenizer.model.tokenize(word)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _remembered(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            if len(self.known) >= REMEMBERED:
                self.forget()
            ids = self.known[word] = self._ids(word)
        return ids

    def forget(self) -> None:
        """Give back what words took; a worker that Spark uses again does other work next."""
        self.known = {"": b""}

    def distinct(self, words: pa.Array) -> list[bytes]:
        # The strings of special tokens count as they are written.
        lower = pc.if_else(pc.match_substring(words, "<|"), words, pc.ascii_lower(words))
        heads = strings(pc.replace_substring_regex(lower, _TAIL, r"\1"))
        found = []
        for head, word in zip(heads, strings(lower), strict=True):
            ids = self._remembered(head)
            if len(head) < len(word):
                ids += self._remembered(word[len(head):])
            found.append(ids)
        return found

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each text followed by ``end_id``, and the texts' bounds."""
        words, bounds = split_words(texts)
        codes, distinct = word_codes(words)
        pieces = [*self.distinct(distinct), np.array([end_id], np.uint32).tobytes()]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(pieces), np.uint32)
        codes = np.insert(codes, bounds[1:], len(pieces) - 1)
        long = sizes[codes]
        ends = np.cumsum(long)
        ids = flat[np.repeat(starts[codes] - (ends - long), long) + np.arange(ends[-1] if len(ends) else 0)]
        per_text = np.concatenate(([0], ends))[bounds + np.arange(len(bounds))]
        return ids, per_text


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pack_file(order: tuple[int, int], doc_ids: list[int | None], documents: list[bytes]) -> bytes:
    """One file's bytes without the last four, which are the seek table's magic number."""
    compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
    frames = [compressor.compress(d) for d in documents]
    index = struct.pack("<QQ", *order) + np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    index += np.array([d is None for d in doc_ids], "u1").tobytes()
    index += np.array([len(d) // 4 for d in documents], "<u4").tobytes()
    frames.append(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
    entries = b"".join(
        struct.pack("<III", len(f), len(d), xxhash.xxh64_intdigest(d) & 0xFFFFFFFF)
        for f, d in zip(frames, [*documents, b""], strict=True)
    )
    footer = struct.pack("<IB", len(frames), CHECKSUMS_PRESENT)
    table = struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(entries) + len(footer) + 4) + entries + footer
    return b"".join((*frames, table))


class TokenFile:
    """A file's documents by place or doc_id; decompresses only what is asked for."""

    def __init__(self, content: bytes) -> None:
        self.content = memoryview(content)
        count, flags, magic = struct.unpack_from("<IBI", content, len(content) - 9)
        if magic != SEEK_TABLE_MAGIC or not flags & CHECKSUMS_PRESENT:
            raise ValueError("not a token file: no seek table with checksums at its end")
        self.entries = np.frombuffer(content, "<u4", 3 * count, len(content) - 9 - 12 * count).reshape(count, 3)
        ends = np.cumsum(self.entries[:, 0], dtype=np.int64)
        self.starts = ends - self.entries[:, 0]
        n, at = count - 1, int(self.starts[-1]) + 8
        self.order = struct.unpack_from("<QQ", content, at)
        ids = np.frombuffer(content, "<i8", n, at + 16)
        missing = np.frombuffer(content, "u1", n, at + 16 + 8 * n)
        self.doc_ids = [None if gone else int(d) for d, gone in zip(ids, missing, strict=True)]
        self.lengths = np.frombuffer(content, "<u4", n, at + 16 + 9 * n).astype(np.int64)

    def raw(self, place: int) -> bytes:
        size, plain, checksum = (int(x) for x in self.entries[place])
        frame = self.content[self.starts[place]:self.starts[place] + size]
        data = zstandard.ZstdDecompressor().decompress(frame, max_output_size=plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {place} does not match its checksum")
        return data

    def ids(self, place: int) -> np.ndarray:
        return np.frombuffer(self.raw(place), "<u4")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, *, id_column: str = "doc_id",
                      text_column: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Encode all texts and write them in ascending id order; files are ordered by their index."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        documents: list[bytes] = []
        held = 0
        own = encoder(tokenizer)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack_file((part, number), ids, documents)], pa.binary())], ["blob"])

        for batch in batches:
            keys, texts = column(batch, "key").to_pylist(), texts_of(batch)
            for start, end in slices(np.asarray(pc.binary_length(texts)), STEP_BYTES):
                tokens, bounds = own.encode(texts.slice(start, end - start), end_id)
                for k in range(end - start):
                    documents.append(tokens[bounds[k]:bounds[k + 1]].astype("<u4").tobytes())
                    ids.append(keys[start + k])
                    held += len(documents[-1])
                    if held >= file_bytes:
                        yield row()
                        ids, documents, held, number = [], [], 0, number + 1
        if documents:
            yield row()
        own.forget()
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("key"), F.col(f"`{text_column}`").alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    blobs = ordered.mapInArrow(files, "blob binary").select(F.col("blob").cast("string").alias("value"))
    separator = struct.pack("<I", SEEK_TABLE_MAGIC).decode("latin-1")
    writer = blobs.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", separator)
    writer.option("compression", "none").text(path)


_READ = "file_part long, file_number long, place int, doc_id long, n_tokens long, ids_crc32 long"


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None, *,
                     with_ids: bool = False) -> DataFrame:
    """A row per document in the files, every frame checked; ``doc_ids`` names the only ones to decompress."""
    wanted = None if doc_ids is None else frozenset(doc_ids)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in column(batch, "content"):
                file = TokenFile(content.as_py())
                places = [k for k, d in enumerate(file.doc_ids) if wanted is None or d in wanted]
                for at in range(0, len(places), 1000):
                    some = places[at:at + 1000]
                    raw = [file.raw(k) for k in some]
                    columns = [
                        pa.array([file.order[0]] * len(some), pa.int64()),
                        pa.array([file.order[1]] * len(some), pa.int64()), pa.array(some, pa.int32()),
                        pa.array([file.doc_ids[k] for k in some], pa.int64()),
                        pa.array(file.lengths[some], pa.int64()), pa.array([zlib.crc32(d) for d in raw], pa.int64()),
                    ]
                    names = ["file_part", "file_number", "place", "doc_id", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([np.frombuffer(d, "<u4").astype(np.int64) for d in raw], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    schema = _READ + (", ids array<long>" if with_ids else "")
    try:
        stored = spark.read.format("binaryFile").load(path).select("content")
    except AnalysisException:  # a folder without any file
        return spark.createDataFrame([], schema)
    return stored.mapInArrow(documents, schema)


def with_starts(read: DataFrame) -> DataFrame:
    """``read`` with the number of ids in all documents before each one.

    The running sum over documents stays within a file; across files it runs
    over one row per file.
    """
    rows = pin(read, "token-rows")
    in_file = Window.partitionBy("file_part", "file_number").orderBy("place")
    files = rows.groupBy("file_part", "file_number").agg(F.sum("n_tokens").alias("tokens"))
    over_files = Window.orderBy("file_part", "file_number")
    files = files.select("file_part", "file_number",
                         (F.sum("tokens").over(over_files) - F.col("tokens")).alias("before"))
    local = rows.withColumn("local", F.sum("n_tokens").over(in_file) - F.col("n_tokens"))
    joined = local.join(files, ["file_part", "file_number"])
    return joined.withColumn("start", F.col("before") + F.col("local")).drop("before", "local")
