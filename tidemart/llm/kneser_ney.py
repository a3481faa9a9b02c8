"""Interpolated modified Kneser-Ney model, counted and applied in Spark.

The model is a bigram model: a word given the one before, interpolated with
the word's continuation probability (how many different words precede it) and
that with a uniform share for unknown words. Discounts come from the counts of
counts, one each for counts of 1, 2 and more, at both levels.

The model is never in one place. It is cut by ranges of n-gram hashes; each
range is stored as sorted arrays of hashes and counts in a file that its task
maps into memory, and looked up there. Chunks of documents ask the ranges:

1. A chunk sends its distinct bigrams with their counts in training documents;
   a range answers the counts in all of them, and tells one of the asking
   chunks to count the bigram as a type.
2. A chunk sends its distinct words with their training counts and what its
   types add to them as a context (total, types seen once, twice, more often)
   and as a continuation. A range answers the sums.
3. The chunk scores its texts.

So a frequent word or bigram is one entry per chunk. Counts of counts are
summed along the way.

Null texts are empty: one end token. Rows that do not learn are scored alike.
With no training rows at all every word is unknown, with probability 1. Rows
with the same id or text count each; null ids are scored but not learned from.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import rounds
from tidemart.llm.text import column, hashed_words, mix, texts_of

#: Hashes of the end of a text and of what comes before its first word.
END, START = np.uint64(0xE5D0C3B1A2948677), np.uint64(0x5A17B2C4D6E8F091)
#: Added to the count of every word in the base score.
BASE_ADD = 0.1

_BIGRAMS, _WORDS, _TOLD = 0, 1, 10
#: Numbers summed over the corpus: bigram types seen 1, 2, 3 and 4 times; words preceded by 1, 2, 3, 4
#: and by more than 2 different words; training tokens; distinct training tokens; bigram types.
_SUMS = 12


class Stored:
    """Sorted hashes and their counts in a file of the worker's own, mapped into memory."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.file = tempfile.TemporaryFile()
        self.file.write(keys.tobytes())
        self.file.write(np.ascontiguousarray(counts).tobytes())
        self.file.flush()
        self.keys = np.memmap(self.file, np.uint64, "r", 0, keys.shape)
        self.counts = np.memmap(self.file, counts.dtype, "r", keys.nbytes, counts.shape)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys that are known to be there."""
        return np.searchsorted(self.keys, keys)

    def close(self) -> None:
        del self.keys, self.counts
        self.file.close()


class Tokens:
    """A chunk's tokens: word hashes with an end after each text, and the bigram each token ends."""

    def __init__(self, table: pa.Table) -> None:
        words, bounds = hashed_words(texts_of(table))
        lengths = np.diff(bounds) + 1
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.words = np.insert(words, bounds[1:], END)
        self.before = np.empty_like(self.words)
        self.before[1:] = self.words[:-1]
        self.before[self.starts] = START
        with np.errstate(over="ignore"):
            self.pairs = mix(mix(self.before) * np.uint64(0x9E3779B97F4A7C15) + self.words)
        learns = np.asarray(column(table, "learns").to_numpy(zero_copy_only=False), bool)
        self.learns = np.repeat(learns, lengths)

    @staticmethod
    def counted(every: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All distinct keys in order, and how often each is among the learned ones."""
        some, times = np.unique(learned, return_counts=True)
        keys = np.unique(every)
        counts = np.zeros(len(keys), np.uint64)
        counts[np.searchsorted(keys, some)] = times
        return keys, counts


def _discounts(ones: float, twos: float, threes: float, fours: float) -> np.ndarray:
    """Discounts for counts of 0, 1, 2 and more; the usual halves where counts of counts are too few."""
    if min(ones, twos, threes, fours) <= 0:
        return np.array([0.0, 0.5, 0.75, 0.75])
    y = ones / (ones + 2 * twos)
    found = np.array([0.0, 1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes])
    return np.clip(found, [0.0, 0.05, 0.05, 0.05], [0.0, 0.95, 1.95, 2.95])


def _discounted(counts: np.ndarray, discounts: np.ndarray) -> np.ndarray:
    return counts - discounts[np.minimum(counts, 3).astype(np.int64)]


def score(docs: DataFrame, learns: Column, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, learns, n_tokens, n_known, train_tokens, base_score and score.

    ``learns`` is true for the rows that the model is made of.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"),
                       F.coalesce(learns, F.lit(False)).alias("learns"))
    chunks = rounds.deal(rows, "text")
    ranges = chunks.ranges(0.6)

    def questions(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
        tokens = Tokens(table)
        keys, counts = Tokens.counted(tokens.pairs, tokens.pairs[tokens.learns])
        cut = rounds.cuts(keys, ranges)
        for k in range(ranges):
            some = slice(cut[k], cut[k + 1])
            if cut[k] < cut[k + 1]:
                yield _BIGRAMS, k, rounds.join_blobs([rounds.pack_sorted(keys[some]), rounds.pack(counts[some])])

    def answers(kind: int, blobs: list[bytes]) -> list[bytes]:
        if kind == _TOLD:
            return blobs
        parts = [rounds.split_blobs(b) for b in blobs]
        asked = [rounds.unpack_sorted(p[0]) for p in parts]
        keys = np.unique(np.concatenate(asked))
        if kind == _BIGRAMS:
            totals = np.zeros(len(keys), np.uint64)
            taken = np.zeros(len(keys), bool)
            mine = []
            for own, p in zip(asked, parts, strict=True):
                counts, at = rounds.unpack(p[1], np.uint64), np.searchsorted(keys, own)
                totals[at] += counts
                # The first chunk that has learned a bigram counts it as a type.
                mine.append((counts > 0) & ~taken[at])
                taken[at] |= counts > 0
            model = Stored(keys, totals)
            sums = np.zeros(_SUMS)
            sums[:4] = [(totals == k).sum() for k in (1, 2, 3, 4)]
            replies = []
            for k, (own, types) in enumerate(zip(asked, mine, strict=True)):
                told = np.asarray(model.counts[model.of(own)])
                replies.append(rounds.join_blobs([rounds.pack(told), rounds.squeeze(np.packbits(types).tobytes()),
                                                  (sums if k == 0 else np.zeros(_SUMS)).tobytes()]))
            model.close()
            return replies
        totals = np.zeros((len(keys), 6), np.uint64)
        sums = np.zeros(_SUMS)
        for own, p in zip(asked, parts, strict=True):
            totals[np.searchsorted(keys, own)] += rounds.unpack(p[1], np.uint64).reshape(6, -1).T
            sums += np.frombuffer(p[2])
        count, follows = totals[:, 0], totals[:, 5]
        sums[4:12] += [*((follows == k).sum() for k in (1, 2, 3, 4)), (follows > 2).sum(), count.sum(), (count > 0).sum(), follows.sum()]
        model = Stored(keys, totals)
        replies = [
            rounds.join_blobs([rounds.pack(np.ascontiguousarray(model.counts[model.of(own)].T).ravel()),
                               (sums if k == 0 else np.zeros(_SUMS)).tobytes()])
            for k, own in enumerate(asked)
        ]
        model.close()
        return replies

    def types_of(told: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [rounds.split_blobs(b) for b in told]
        counts = [rounds.unpack(p[0], np.uint64) for p in parts]
        mine = [np.unpackbits(np.frombuffer(rounds.expand(p[1]), np.uint8), count=len(c)).astype(bool)
                for p, c in zip(parts, counts, strict=True)]
        return np.concatenate(counts), np.concatenate(mine), sum(np.frombuffer(p[2]) for p in parts)

    def ask_words(table: pa.Table, told: rounds.Answers) -> pa.Table:
        tokens = Tokens(table)
        totals, mine, sums = types_of(told[_BIGRAMS])
        keys, first = np.unique(tokens.pairs, return_index=True)
        words, counts = Tokens.counted(np.append(tokens.words, START), tokens.words[tokens.learns])
        added = np.zeros((6, len(words)), np.uint64)
        added[0] = counts
        first, totals_mine = first[mine], totals[mine]
        context = np.searchsorted(words, tokens.before[first])
        for row, weight in ((1, totals_mine), (2, totals_mine == 1), (3, totals_mine == 2), (4, totals_mine > 2)):
            added[row] = np.bincount(context, weight, len(words)).astype(np.uint64)
        added[5] = np.bincount(np.searchsorted(words, tokens.words[first]), minlength=len(words)).astype(np.uint64)
        chunk = int(column(table, "chunk")[0].as_py())
        cut = rounds.cuts(words, ranges)
        found = []
        for k in range(ranges):
            some = slice(cut[k], cut[k + 1])
            if cut[k] < cut[k + 1]:
                found.append((k, _WORDS, rounds.join_blobs(
                    [rounds.pack_sorted(words[some]), rounds.pack(np.ascontiguousarray(added[:, some]).ravel()),
                     (np.zeros(_SUMS) if found else sums).tobytes()])))
        # The bigrams' counts come along, under a range of the chunk's own.
        found.append((-1 - chunk, _TOLD, rounds.pack(totals)))
        return pa.table({
            "range": pa.array([r for r, _, _ in found], pa.int64()), "chunk": pa.array([chunk] * len(found), pa.int64()),
            "kind": pa.array([k for _, k, _ in found], pa.int32()), "blob": pa.array([b for _, _, b in found], pa.binary()),
        })

    def finish(table: pa.Table, told: rounds.Answers, sums: np.ndarray) -> pa.Table:
        tokens = Tokens(table)
        keys, words = np.unique(tokens.pairs), np.unique(np.append(tokens.words, START))
        totals = rounds.unpack(told[_TOLD][0], np.uint64)
        about = np.concatenate([rounds.unpack(rounds.split_blobs(b)[0], np.uint64).reshape(6, -1) for b in told[_WORDS]], axis=1)
        count, total, once, twice, more, follows = about
        known, vocabulary, types = sums[9], sums[10], sums[11]
        of_bigram, of_word = _discounts(*sums[:4]), _discounts(*sums[4:8])
        if types > 0:
            spread = (of_word[1] * sums[4] + of_word[2] * sums[5] + of_word[3] * sums[8]) / types
            single = _discounted(follows, of_word) / types + spread / (vocabulary + 1)
        else:
            single = np.full(len(words), 1 / (vocabulary + 1))
        seen = np.maximum(total, 1)
        weight = np.where(total > 0, (of_bigram[1] * once + of_bigram[2] * twice + of_bigram[3] * more) / seen, 1.0)
        base = np.log10((count + BASE_ADD) / (known + BASE_ADD * (vocabulary + 1)))
        place, context = np.searchsorted(words, tokens.words), np.searchsorted(words, tokens.before)
        pair = _discounted(totals, of_bigram)[np.searchsorted(keys, tokens.pairs)] / seen[context]
        logs = np.log10(pair + weight[context] * single[place])
        at = tokens.starts
        return pa.table({
            "doc_id": column(table, "doc_id"), "learns": column(table, "learns"),
            "n_tokens": pa.array(tokens.ends - tokens.starts, pa.int64()),
            "n_known": pa.array(np.add.reduceat((count > 0)[place].astype(np.int64), at), pa.int64()),
            "train_tokens": pa.array(np.full(len(at), int(known)), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base[place], at)), "score": pa.array(np.add.reduceat(logs, at)),
        })

    def parts_of_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(_SUMS)
        for batch in batches:
            for blob in column(batch, "blob"):
                held += np.frombuffer(rounds.split_blobs(blob.as_py())[1])
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in held], [f"s{k}" for k in range(_SUMS)])

    told = rounds.answer(rounds.ask(chunks.rows, questions), answers)
    words = rounds.meet(chunks.rows, told, ask_words, "range long, chunk long, kind int, blob binary")
    answered = rounds.answer(words, answers)
    # One row of twelve numbers for the whole corpus, as a scalar beside every answer.
    parts = answered.filter(F.col("kind") == _WORDS).select("blob").mapInArrow(
        parts_of_sums, ", ".join(f"s{k} double" for k in range(_SUMS))
    )
    sums = parts.agg(F.array(*[F.coalesce(F.sum(f"s{k}"), F.lit(0.0)) for k in range(_SUMS)]).alias("sums"))
    beside = answered.withColumn("sums", sums.scalar())

    def met(table: pa.Table, told_rows: pa.Table) -> pa.Table:
        return finish(table, rounds.Answers(told_rows), np.array(column(told_rows, "sums")[0].as_py()))

    schema = "doc_id long, learns boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chunks.rows.groupBy("chunk").cogroup(beside.groupBy("chunk")).applyInArrow(met, schema)
