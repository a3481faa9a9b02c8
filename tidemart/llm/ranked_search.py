"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, score intervals, no random access.

Documents stay in the order they are read and are packed into chunks of
bounded size. For a block of items (queries), a chunk holds for each of their
terms the documents with it. With the table's counts known, each posting has
its final integer impact; a chunk sorts each term's postings by impact and
reads all lists of an item from their beginnings in steps that double. What a
document has got so far is its lower score, and what the unread parts of its
unseen lists could still add makes its upper score. Reading goes on until no
other document can reach the best ones, ties included, and the scores of these
are final. A task carries each item's current last score from chunk to chunk
as a bar, so later chunks read less. A last window merges the tasks' best.

The items are the stated query set: blocks of them, bounded in bytes, are sent
to all tasks, and each block reads the documents once. Counts of a term cross
the network once per chunk, postings never do.

Terms: maximal runs of ASCII letters and digits and of characters beyond
ASCII, A-Z lower-cased. Null and empty texts have no terms; an item without
terms has no rows. Equal scores rank by document id, null ids last; repeated
rows are documents of their own and rank next to each other, repeated items
give rows each. An empty table gives no rows. Very long texts are read in
windows. Columns other than the named ones are not touched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemart.llm.rounds import pack, unpack
from tidemart.llm.text import column, slices, split_words, texts_of, windows
from tidemart.session import pin

#: Rows of the result per item.
TOP = 20
#: Bytes of text in a chunk and in a window, and of the items' texts in a block, on average.
CHUNK_BYTES, WINDOW_BYTES, BLOCK_BYTES = 16 << 20, 4 << 20, 2 << 20
#: Postings that the first step reads of each list.
FIRST_STEP = 32

_BYTE = np.arange(256)
_LETTER = (_BYTE >= 0x80) | ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE | 0x20) >= 0x61) & ((_BYTE | 0x20) <= 0x7A) & (_BYTE >= 0x41)
#: Bytes between terms become spaces, A-Z small letters.
_FOLDED = np.where(_LETTER, np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE), 0x20).astype(np.uint8)

_CHUNK = "ids binary, lengths binary, terms binary, holders binary, docs binary, times binary, n_docs long, n_terms long"


def folded_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts in order, and where each text's terms begin and end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    again = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_FOLDED[data]))
    return split_words(again)


@dataclass(frozen=True)
class Items:
    """A block of items: their ids, each item's term numbers and how often it has them, and all terms."""

    ids: list
    wanted: list[tuple[np.ndarray, np.ndarray]]
    terms: pa.Array

    @classmethod
    def of(cls, texts: list[str | None], ids: list) -> Items:
        places: dict[str, int] = {}
        wanted = []
        for text in texts:
            words, _ = folded_terms(pa.array([text or ""], pa.large_string()))
            counts = Counter(words.to_pylist())
            wanted.append((
                np.array([places.setdefault(w, len(places)) for w in counts], np.int64),
                np.array(list(counts.values()), np.int64),
            ))
        return cls(ids, wanted, pa.array(list(places), pa.large_string()))


def _chunks(batches: Iterator[pa.RecordBatch], names: tuple[str, str], terms: pa.Array) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_id = pc.sort_indices(column(batch, names[0]))  # nulls last
        ids = column(batch, names[0]).take(by_id)
        texts = texts_of(batch, names[1]).take(by_id)
        sizes = np.asarray(pc.binary_length(texts))
        for start, end in slices(sizes, CHUNK_BYTES):
            yield _chunk(ids.slice(start, end - start), texts.slice(start, end - start), sizes[start:end], terms)


def _chunk(ids: pa.Array, texts: pa.Array, sizes: np.ndarray, terms: pa.Array) -> pa.RecordBatch:
    n = len(ids)
    lengths, keys, times = np.zeros(n, np.int64), [], []
    for start, end in slices(sizes, WINDOW_BYTES):
        for some in _windows(texts.slice(start, end - start)):
            words, bounds = folded_terms(some)
            if end - start == 1:
                lengths[start] += len(words)
            else:
                lengths[start:end] = np.diff(bounds)
            found = pc.index_in(words, terms)
            held = np.asarray(found.is_valid())
            of = np.repeat(np.arange(start, end), np.diff(bounds))[held]
            key, count = np.unique(np.asarray(found.drop_null(), np.int64) * n + of, return_counts=True)
            keys.append(key)
            times.append(count)
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    tf = np.zeros(len(key), np.int64)
    np.add.at(tf, place, np.concatenate(times))
    term, holders = np.unique(key // n, return_counts=True)
    names = pa.record_batch([ids], ["id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, names.schema) as stream:
        stream.write_batch(names)
    return pa.RecordBatch.from_pydict({
        "ids": [sink.getvalue().to_pybytes()], "lengths": [pack(lengths)], "terms": [pack(term)],
        "holders": [pack(holders)], "docs": [pack((key % n).astype(np.uint32))], "times": [pack(tf)],
        "n_docs": [int((lengths > 0).sum())], "n_terms": [int(lengths.sum())],
    }, schema=_CHUNK_ARROW)


_CHUNK_ARROW = pa.schema([
    *((name, pa.binary()) for name in ("ids", "lengths", "terms", "holders", "docs", "times")),
    ("n_docs", pa.int64()), ("n_terms", pa.int64()),
])


def _windows(texts: pa.Array) -> Iterator[pa.Array]:
    if len(texts) > 1 or texts[0].as_buffer().size <= WINDOW_BYTES:
        yield texts
        return
    whole = texts[0].as_buffer()
    for start, end in windows(whole, WINDOW_BYTES, ~_LETTER):
        yield pa.array([memoryview(whole)[start:end]], pa.large_binary()).cast(pa.large_string())


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for terms, holders in zip(column(batch, "terms"), column(batch, "holders"), strict=True):
            yield pa.RecordBatch.from_pydict({
                "term": unpack(terms.as_py(), np.int64), "holders": unpack(holders.as_py(), np.int64),
            })


def best_of_chunk(lists: list[tuple[np.ndarray, np.ndarray]], n: int, top: int, bar: int = 0) -> list[tuple[int, int]]:
    """(score, place) of the ``top`` best of ``n`` documents, best first, equal scores by place.

    ``lists`` are the documents and positive impacts of each term, greatest
    impact first. Documents below ``bar`` may be left out. NRA: lists are only
    read onwards; a document's score lies between what was read of it and that
    plus the last impacts read of the lists it has not been seen in.
    """
    lower = np.zeros(n, np.int64)
    last = np.array([impacts[0] if len(impacts) else 0 for _, impacts in lists], np.int64)
    read = [0] * len(lists)
    step = FIRST_STEP
    while True:
        for t, (docs, impacts) in enumerate(lists):
            if read[t] == len(docs):
                continue
            start, end = read[t], min(read[t] + step, len(docs))
            lower[docs[start:end]] += impacts[start:end]
            read[t], last[t] = end, impacts[end - 1] if end < len(docs) else 0
        met = np.flatnonzero(lower)
        rank = met[np.lexsort((met, -lower[met]))[:top]]
        least = max(bar, int(lower[rank[-1]]) if len(rank) == top else 0)
        rest = int(last.sum())
        if not rest:
            break
        # What a document can still get is all that is left but for the lists it was seen in.
        upper = lower + rest
        for t in np.flatnonzero(last):
            upper[lists[t][0][:read[t]]] -= last[t]
        unsettled = (upper > lower) & (upper >= least)
        # Documents not met at all are among these as long as all that is left reaches the last score.
        if least and not unsettled.any():
            break
        step *= 2
    return [(int(lower[d]), int(d)) for d in rank if lower[d] >= bar]


def _searcher(items: Items, weights: np.ndarray, total_docs: int, total_terms: int, top: int, schema: pa.Schema):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, object]]] = [[] for _ in items.ids]
        for batch in batches:
            for row in range(batch.num_rows):
                _search_chunk(batch.slice(row, 1), best)
        rows = [(i, doc, score) for i, found in enumerate(best) for score, doc in found]
        for start in range(0, len(rows), 50_000):
            part = rows[start:start + 50_000]
            yield pa.RecordBatch.from_arrays([
                pa.array([items.ids[i] for i, _, _ in part], schema.field(0).type),
                pa.array([doc for _, doc, _ in part], schema.field(1).type),
                pa.array([score for _, _, score in part], pa.int64()),
            ], schema=schema)

    def _search_chunk(batch: pa.RecordBatch, best: list) -> None:
        blob = {name: column(batch, name)[0].as_py() for name in ("ids", "lengths", "terms", "holders", "docs", "times")}
        ids = pa.ipc.open_stream(blob["ids"]).read_all().column(0).to_pylist()
        lengths = unpack(blob["lengths"], np.int64)
        terms, holders = unpack(blob["terms"], np.int64), unpack(blob["holders"], np.int64)
        docs, times = unpack(blob["docs"], np.uint32).astype(np.int64), unpack(blob["times"], np.int64)
        norm = 100 - 25 + (25 * lengths * total_docs) // max(total_terms, 1)
        gains = np.repeat(weights[terms], holders) * ((1_000_000_000 * times) // (1000 * times + 12 * norm[docs]))
        order = np.lexsort((docs, -gains, np.repeat(np.arange(len(terms)), holders)))
        docs, gains = docs[order], gains[order]
        starts = np.cumsum(holders) - holders
        at = dict(zip(terms.tolist(), zip(starts.tolist(), (starts + holders).tolist(), strict=True), strict=True))
        for i, (wanted, often) in enumerate(items.wanted):
            lists = []
            for t, q in zip(wanted.tolist(), often.tolist(), strict=True):
                if t in at and weights[t] > 0:
                    a, b = at[t]
                    b = a + int(np.searchsorted(-gains[a:b], 0))  # impacts of 0 add nothing
                    lists.append((docs[a:b], gains[a:b] * q))
            bar = best[i][-1][0] if len(best[i]) == top else 0
            found = [(score, ids[d]) for score, d in best_of_chunk(lists, len(ids), top, bar)]
            best[i] = sorted(best[i] + found, key=lambda f: (-f[0], f[1] is None, f[1]))[:top]

    return search


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, id_column: str = "doc_id", text_column: str = "text",
           item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_column``, ``rank``, ``id_column`` and ``score`` of each item's ``top`` documents with a score above 0."""
    asked = items.select(F.col(item_column).alias("item"), F.col(item_text).alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    texts = docs.select(id_column, text_column)
    found = []
    for b in range(blocks):
        rows = asked.filter(block == b).orderBy("item", "text").collect()
        # Repeated items are told apart by their place.
        ids = [((b << 32) + k, r.item) for k, r in enumerate(rows)]
        best = _search_block(texts, Items.of([r.text for r in rows], [k for k, _ in ids]), top, (id_column, text_column))
        kind = T.StructType([T.StructField("copy", T.LongType()), T.StructField("item", items.schema[item_column].dataType)])
        found.append(best.join(docs.sparkSession.createDataFrame(ids, kind), "copy"))
    every = reduce(DataFrame.unionByName, found)
    best = Window.partitionBy("item", "copy").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    ranked = every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item_column), "rank", F.col("doc").alias(id_column), "score")


def _search_block(texts: DataFrame, items: Items, top: int, names: tuple[str, str]) -> DataFrame:
    terms = items.terms
    chunks = pin(texts.mapInArrow(lambda batches: _chunks(batches, names, terms), _CHUNK), "search-chunks")
    total = chunks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    counted = chunks.mapInArrow(_holders, "term long, holders long").groupBy("term").agg(F.sum("holders").alias("df"))
    weights = np.zeros(len(terms), np.int64)
    for term, df in counted.collect():  # at most the terms of this block
        weights[term] = math.floor(1000 * math.log((2 * total.n + 2) / (2 * df + 1)))
    shape = T.StructType([
        T.StructField("copy", T.LongType()), T.StructField("doc", texts.schema[names[0]].dataType), T.StructField("score", T.LongType()),
    ])
    return chunks.mapInArrow(_searcher(items, weights, total.n, total.l, top, to_arrow_schema(shape)), shape)
