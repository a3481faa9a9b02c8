"""Removal of repeated byte strings with sparse suffix arrays and a merge sort that knows common prefixes.

Every byte that lies in a string of ``length`` bytes that also starts anywhere
else, in another document or the same one, is removed. Overlaps count, and
strings are judged on the input.

Sorting every suffix would move the corpus many times, so only suffixes at
anchors are sorted. The anchor of a window of ``length`` bytes is the first of
its k-byte grams with the least hash; it depends on the window's bytes alone,
so equal windows have their anchors at equal places. Windows with the same
anchor are neighbours, and about one suffix in 150 is an anchor's.

1. Chunks ask which of their anchors' grams occur elsewhere, which occur very
   often, and which of their texts do. Repeated texts are removed whole; one of
   each goes on.
2. Each chunk sorts the suffixes at anchors that occur elsewhere, with what
   stands before the anchor, and sends them as front-coded sorted runs.
3. The runs of a range of grams are merged by a loser tree that keeps, for each
   contender, its common prefix with the last winner: contenders with unlike
   prefixes are decided without a look at their bytes, and bytes known to be
   equal are never compared again. The merge yields the common prefixes of
   neighbours, and with the left contexts sorted the same way, the windows
   that are equal.
   All contexts of a gram meet in one task. Of grams that occur very often chunks
   send 128-bit prints of their distinct windows instead, over all ranges.
4. Chunks get back which of their windows occur elsewhere.

Null texts are empty; texts shorter than ``length`` lose nothing of their own.
Rows with the same text or id, and null ids, are kept, a row each. Long texts
are read in segments. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import rounds
from tidemart.llm.text import column, mix, part_hashes

LENGTH, GRAM = 400, 100
#: Bytes whose grams are hashed at a time.
SEGMENT = 1 << 20
#: Classes with more members are matched window place by window place, smaller ones pair by pair.
PAIRWISE = 12
#: Anchors of a gram, in all chunks, above which its windows are printed: contexts have up to 0.7 KB each.
HOT = 1 << 13

_KINDS = {"grams": 0, "texts": 1, "runs": 2, "windows": 3, "told grams": 10, "told texts": 11}


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes at each place where they fit."""
    starts = np.arange(len(data) - gram + 1)
    return part_hashes(data.astype(np.uint64) + np.uint64(1), starts, starts + gram)


def least_of_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring keys."""
    count = len(keys) - width + 1
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = keys
    table = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1:width - 1 + count])


@dataclass
class Anchors:
    """Anchors of some texts: text, place, first and last window start they stand for, and the gram's hash."""

    text: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Anchors:
    segments: list[list[tuple[int, int, int]]] = [[]]
    held = 0
    for k, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, SEGMENT):
            end = min(len(text), start + SEGMENT + length - 1)
            if held and held + end - start > SEGMENT:
                segments.append([])
                held = 0
            segments[-1].append((k, start, end))
            held += end - start
    found: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)]
    for group in segments:
        if not group:
            continue
        data = np.frombuffer(b"".join(texts[k][a:b] for k, a, b in group), np.uint8)
        hashed = gram_hashes(data, gram)
        # Order by hash, and among equals by place: the low bits hold the place. Anchors have small
        # hashes, so they are mixed again to spread over the ranges.
        bits = np.uint64(max(1, int(len(hashed)).bit_length()))
        keys = ((hashed >> bits) << bits) | np.arange(len(hashed), dtype=np.uint64)
        least = (least_of_windows(keys, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        at = 0
        for k, a, b in group:
            windows = least[at:at + b - a - length + 1]
            change = np.concatenate(([0], np.flatnonzero(np.diff(windows)) + 1))
            place = windows[change]
            found.append((np.full(len(change), k), place - at + a, change + a,
                          np.append(change[1:], len(windows)) - 1 + a, mix(hashed[place] + np.uint64(1))))
            at += b - a
    return Anchors(*(np.concatenate(x) for x in zip(*found, strict=True)))


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    most = min(len(a), len(b))
    at = known
    while at < most:
        step = min(64, most - at)
        if a[at:at + step] == b[at:at + step]:
            at += step
            continue
        while step > 1:
            half = step >> 1
            if a[at:at + half] == b[at:at + half]:
                at += half
                step -= half
            else:
                step = half
        return at
    return at


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Sorted strings as the length of what each shares with the one before, and the rest."""
    shared = np.zeros(len(strings), np.uint16)
    rest = []
    before = b""
    for k, s in enumerate(strings):
        shared[k] = n = common(before, s, 0)
        rest.append(s[n:])
        before = s
    return shared, rest


def merge(runs: list[list[bytes]], shared: list[list[int]]) -> Iterator[tuple[int, int, int]]:
    """Sorted runs merged: run, place in it, and the common prefix with the string before.

    ``known[r]`` is the common prefix of run r's head with the last winner. Of
    two heads the one that shares more with it is smaller; only heads that
    share equally much are compared, from there on.
    """
    leaves = 1 << max(0, (len(runs) - 1).bit_length())
    heads: list[bytes | None] = [run[0] if run else None for run in runs] + [None] * (leaves - len(runs))
    at, known = [0] * len(runs), [0] * leaves

    def wins(a: int, b: int) -> bool:
        x, y = heads[a], heads[b]
        if y is None or x is None:
            return x is not None
        if known[a] != known[b]:
            return known[a] > known[b]
        n = common(x, y, known[a])
        first = n == len(x) or n < len(y) and x[n] < y[n]
        if n == len(x) == len(y):
            first = a < b
        known[b if first else a] = n
        return first

    losers = [0] * leaves
    winners = [0] * leaves + list(range(leaves))
    for node in range(leaves - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if wins(a, b) else (b, a)
    best = winners[1] if leaves > 1 else 0
    while heads[best] is not None:
        yield best, at[best], known[best]
        at[best] += 1
        run = runs[best]
        if at[best] < len(run):
            heads[best], known[best] = run[at[best]], shared[best][at[best]]
        else:
            heads[best] = None
        node = (best + leaves) >> 1
        while node:
            other = losers[node]
            if wins(other, best):
                losers[node], best = best, other
            node >>= 1


@dataclass
class Run:
    """A chunk's contexts in one range, sorted: what follows an anchor and what precedes it, reversed.

    ``after`` reaches to the end of the anchor's last window and ``before`` to
    the start of its first one. ``twice``: the chunk has the context twice.
    """

    after: list[bytes]
    before: list[bytes]
    twice: np.ndarray

    def pack(self) -> bytes:
        shared, rest = front_coded(self.after)
        sizes = [np.array([len(s) for s in x], np.uint16) for x in (rest, self.before)]
        return rounds.join_blobs([
            rounds.pack(shared), *(rounds.pack(s) for s in sizes), rounds.squeeze(b"".join(rest)),
            rounds.squeeze(b"".join(self.before)), rounds.squeeze(np.packbits(self.twice).tobytes()),
        ])

    @staticmethod
    def unpack(blob: bytes) -> tuple[Run, list[int]]:
        parts = rounds.split_blobs(blob)
        shared, of_rest, of_before = (rounds.unpack(p, np.uint16).tolist() for p in parts[:3])
        rest, before, bits = (rounds.expand(p) for p in parts[3:])
        strings, lefts, last, a, b = [], [], b"", 0, 0
        for n, r, l in zip(shared, of_rest, of_before, strict=True):
            last = last[:n] + rest[a:a + r]
            strings.append(last)
            lefts.append(before[b:b + l])
            a, b = a + r, b + l
        twice = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(strings)).astype(bool)
        return Run(strings, lefts, twice), shared


def repeated(after: list[bytes], before: list[bytes], shared: list[int], twice: list[bool], length: int) -> list[np.ndarray]:
    """For each context of one gram, which of its windows another context has too.

    Contexts are sorted by what follows the gram, ``shared`` being the common
    prefixes of neighbours. Windows go by the number of their bytes before the
    gram, from the fewest.
    """
    count = len(after)
    low, high = [length - len(s) for s in after], [len(s) for s in before]
    found = [np.full(h - l + 1, t, bool) for l, h, t in zip(low, high, twice, strict=True)]
    if count == 1:
        return found
    if count <= PAIRWISE:
        for i in range(count):
            right = length
            for j in range(i + 1, count):
                right = min(right, shared[j])
                start = max(length - right, low[i], low[j])
                end = min(high[i], high[j])
                if start <= end:
                    end = min(end, common(before[i], before[j], 0))
                    if start <= end:
                        found[i][start - low[i]:end - low[i] + 1] = True
                        found[j][start - low[j]:end - low[j] + 1] = True
        return found
    right = np.array(shared, np.int64)
    right[0] = -1
    order = sorted(range(count), key=before.__getitem__)
    left, last = np.empty(count, np.int64), b""
    for k, i in enumerate(order):
        left[k] = common(last, before[i], 0) if k else -1
        last = before[i]
    rank = np.empty(count, np.int64)
    rank[order] = np.arange(count)
    lows, highs = np.array(low), np.array(high)
    for place in range(min(low), max(high) + 1):
        here = np.flatnonzero((lows <= place) & (place <= highs))
        alike = np.cumsum(right < length - place) * count + np.cumsum(left < place)[rank]
        _, which, times = np.unique(alike[here], return_inverse=True, return_counts=True)
        for i in here[times[which] > 1].tolist():
            found[i][place - low[i]] = True
    return found


def _solve(blobs: list[bytes], length: int, gram: int) -> list[bytes]:
    """Merge the runs of a range; for each, which windows of its contexts occur elsewhere."""
    runs, shared = zip(*(Run.unpack(b) for b in blobs), strict=True)
    found: list[list[np.ndarray]] = [[np.empty(0, bool)] * len(r.after) for r in runs]
    members: list[tuple[int, int, int]] = []

    def close() -> None:
        windows = repeated(
            [runs[r].after[k] for r, k, _ in members], [runs[r].before[k] for r, k, _ in members],
            [n for _, _, n in members], [bool(runs[r].twice[k]) for r, k, _ in members], length,
        )
        for (r, k, _), some in zip(members, windows, strict=True):
            found[r][k] = some

    for r, k, n in merge([r.after for r in runs], list(shared)):
        if members and n < gram:
            close()
            members = []
        members.append((r, k, n))
    if members:
        close()
    return [rounds.squeeze(np.packbits(np.concatenate(f)).tobytes()) for f in found]


def _distinct(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of 128-bit prints: first row of each distinct one in sorted order, each row's place there, how often each occurs."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (pairs[order[1:]] != pairs[order[:-1]]).any(axis=1)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place, np.bincount(place, minlength=int(new.sum()))


@dataclass
class Windows:
    """A chunk's windows at anchors of very frequent grams.

    ``pairs`` are their distinct prints in order, ``twice`` whether the chunk
    has one twice; ``place`` says for the windows of each context where they
    are there, and ``stands`` which anchors a context stands for.
    """

    pairs: np.ndarray
    twice: np.ndarray
    place: list[np.ndarray]
    stands: list[list[int]]

    @staticmethod
    def of(texts: list[bytes], found: Anchors, use: np.ndarray, length: int) -> Windows:
        held: dict[tuple[bytes, int], list[int]] = {}
        for i in use.tolist():
            first, last = int(found.first[i]), int(found.last[i])
            # Contexts also differ if the same bytes have their anchor elsewhere.
            held.setdefault((texts[found.text[i]][first:last + length], int(found.place[i]) - first), []).append(i)
        prints = [xxhash.xxh3_128_digest(b[k:k + length]) for b, _ in held for k in range(len(b) - length + 1)]
        pairs = np.frombuffer(b"".join(prints), "<u8").reshape(-1, 2).astype(np.uint64)
        sizes = [len(b) - length + 1 for b, _ in held]
        first, place, _ = _distinct(pairs)
        stands = list(held.values())
        times = np.bincount(place, np.repeat([len(x) for x in stands], sizes) if stands else None, len(first))
        return Windows(pairs[first], times > 1, np.split(place, np.cumsum(sizes)[:-1]) if stands else [], stands)


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, id_column: str = "doc_id",
                   text_column: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (starts and ends).

    With ``with_text`` also ``kept``, the remaining bytes.
    """
    if not 1 <= gram <= length <= 0xFFFF:
        raise ValueError("the gram must fit into the length, and the length into 16 bits")
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit("")).cast("binary")
    chunks = rounds.deal(docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("text")), "text")
    gram_ranges, run_ranges = chunks.ranges(0.06), chunks.ranges(1.0)
    hot = HOT

    def texts_in(table: pa.Table) -> list[bytes]:
        return [t.as_py() for t in column(table, "text")]

    def prints(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct 128-bit prints of the texts, whether the chunk has one twice, each text's place, firsts."""
        pairs = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t) for t in texts), "<u8").reshape(-1, 2)
        _, first, place, times = np.unique(pairs, axis=0, return_index=True, return_inverse=True, return_counts=True)
        return pairs[first].astype(np.uint64), times > 1, place.ravel(), first

    def whole(texts: list[bytes]) -> tuple[Anchors, np.ndarray, np.ndarray]:
        """Anchors of the chunk's distinct texts, with its distinct gram hashes and each anchor's place there."""
        _, _, place, first = prints(texts)
        some = anchors([t if first[p] == k else b"" for k, (t, p) in enumerate(zip(texts, place, strict=True))], length, gram)
        keys, at = np.unique(some.gram, return_inverse=True)
        return some, keys, at.ravel()

    def questions(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
        texts = texts_in(table)
        _, keys, at = whole(texts)
        counts = np.bincount(at, minlength=len(keys)).astype(np.uint32)
        cut = rounds.cuts(keys, gram_ranges)
        for k in range(gram_ranges):
            some = slice(cut[k], cut[k + 1])
            if cut[k] < cut[k + 1]:
                yield _KINDS["grams"], k, rounds.join_blobs([rounds.pack_sorted(keys[some]), rounds.pack(counts[some])])
        pairs, twice, _, _ = prints(texts)
        cut = rounds.cuts(pairs[:, 0], gram_ranges)
        for k in range(gram_ranges):
            some = slice(cut[k], cut[k + 1])
            if cut[k] < cut[k + 1]:
                yield _KINDS["texts"], k, rounds.join_blobs(
                    [rounds.pack(pairs[some].T.ravel()), rounds.squeeze(np.packbits(twice[some]).tobytes())])

    def bits(blob: bytes, count: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(rounds.expand(blob), np.uint8), count=count).astype(bool)

    def answers(kind: int, blobs: list[bytes]) -> list[bytes]:
        if kind == _KINDS["runs"]:
            return _solve(blobs, length, gram)
        if kind >= _KINDS["told grams"]:
            return blobs
        parts = [rounds.split_blobs(b) for b in blobs]
        if kind == _KINDS["grams"]:
            asked = [rounds.unpack_sorted(p[0]) for p in parts]
            counts = np.concatenate([rounds.unpack(p[1], np.uint32) for p in parts])
            _, place = np.unique(np.concatenate(asked), return_inverse=True)
            times = np.bincount(place, counts)[place]
            # Twice as many bits: whether the gram occurs elsewhere, and whether very often.
            told = np.stack([times > 1, times > hot], 1)
        elif kind == _KINDS["windows"]:
            asked = [rounds.unpack(p[0], np.uint64).reshape(2, -1).T for p in parts]
            twice = np.concatenate([bits(p[1], len(a)) for p, a in zip(parts, asked, strict=True)])
            _, place, times = _distinct(np.concatenate(asked))
            told = (times[place] > 1) | twice
        else:
            pairs = [rounds.unpack(p[0], np.uint64).reshape(2, -1).T for p in parts]
            asked = [p[:, 0] for p in pairs]
            twice = np.concatenate([bits(p[1], len(a)) for p, a in zip(parts, asked, strict=True)])
            _, first, place, times = np.unique(np.concatenate(pairs), axis=0, return_index=True, return_inverse=True,
                                               return_counts=True)
            place = place.ravel()
            again = times > 1
            again[place[twice]] = True
            # Twice as many bits: whether the text is repeated, and whether this chunk goes on with it.
            told = np.stack([again[place], first[place] == np.arange(len(place))], 1)
        ends = np.cumsum([len(a) for a in asked])
        return [rounds.squeeze(np.packbits(told[e - len(a):e]).tobytes()) for a, e in zip(asked, ends, strict=True)]

    def contexts(texts: list[bytes], told: rounds.Answers) -> tuple[
            list[tuple[int, Run, list[list[int]]]], Windows, Anchors, np.ndarray]:
        """Runs by range with the anchors that each context stands for, windows of very frequent grams, all anchors,
        and which texts are repeated."""
        found, keys, at = whole(texts)
        of_gram = _by_range(told.get(_KINDS["told grams"], []), rounds.cuts(keys, gram_ranges), 2, bits)
        pairs, _, place, _ = prints(texts)
        about = _by_range(told.get(_KINDS["told texts"], []), rounds.cuts(pairs[:, 0], gram_ranges), 2, bits)
        again, mine = about[place, 0], about[place, 1]
        use = np.flatnonzero(of_gram[at, 0] & (mine | ~again)[found.text]) if len(at) else np.empty(0, np.int64)
        often = of_gram[at[use], 1]
        windows, use = Windows.of(texts, found, use[often], length), use[~often]
        use = use[np.argsort(found.gram[use], kind="stable")]
        cut = rounds.cuts(found.gram[use], run_ranges)
        runs = []
        for k in range(run_ranges):
            held: dict[tuple[bytes, bytes], list[int]] = {}
            for i in use[cut[k]:cut[k + 1]].tolist():
                text, here = texts[found.text[i]], found.place[i]
                key = text[here:found.last[i] + length], text[found.first[i]:here][::-1]
                held.setdefault(key, []).append(i)
            if held:
                ordered = sorted(held)
                stands = [held[key] for key in ordered]
                runs.append((k, Run([a for a, _ in ordered], [b for _, b in ordered], np.array([len(x) > 1 for x in stands])), stands))
        return runs, windows, found, again

    def send_runs(table: pa.Table, told: rounds.Answers) -> pa.Table:
        passed = rounds.Answers.__new__(rounds.Answers)
        passed.update({_KINDS["told grams"]: told.get(0, []), _KINDS["told texts"]: told.get(1, [])})
        runs, windows, _, _ = contexts(texts_in(table), passed)
        rows = [(k, _KINDS["runs"], run.pack()) for k, run, _ in runs]
        cut = rounds.cuts(windows.pairs[:, 0], run_ranges)
        for k in range(run_ranges):
            some = slice(cut[k], cut[k + 1])
            if cut[k] < cut[k + 1]:
                rows.append((k, _KINDS["windows"], rounds.join_blobs(
                    [rounds.pack(windows.pairs[some].T.ravel()), rounds.squeeze(np.packbits(windows.twice[some]).tobytes())])))
        chunk = int(column(table, "chunk")[0].as_py())
        # What was told comes along, under a range of the chunk's own.
        rows += [(-1 - chunk, kind, rounds.join_blobs(blobs)) for kind, blobs in passed.items()]
        return pa.table({
            "range": pa.array([r for r, _, _ in rows], pa.int64()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
            "kind": pa.array([k for _, k, _ in rows], pa.int32()), "blob": pa.array([b for _, _, b in rows], pa.binary()),
        })

    def finish(table: pa.Table, told: rounds.Answers) -> pa.Table:
        texts = texts_in(table)
        for kind in (_KINDS["told grams"], _KINDS["told texts"]):
            told[kind] = rounds.split_blobs(told[kind][0])
        runs, windows, found, again = contexts(texts, told)
        starts: dict[int, list[np.ndarray]] = {}
        elsewhere = _by_range(told.get(_KINDS["windows"], []), rounds.cuts(windows.pairs[:, 0], run_ranges), 1, bits).ravel()
        for place, stands in zip(windows.place, windows.stands, strict=True):
            places = np.flatnonzero(elsewhere[place])
            for i in stands if len(places) else []:
                starts.setdefault(int(found.text[i]), []).append(found.first[i] + places)
        for (_, run, stands), blob in zip(runs, told.get(_KINDS["runs"], []), strict=True):
            sizes = np.array([len(b) - (length - len(a)) + 1 for a, b in zip(run.after, run.before, strict=True)])
            ends = np.cumsum(sizes)
            flags = bits(blob, int(ends[-1]))
            for k in np.flatnonzero(np.add.reduceat(flags, ends - sizes)).tolist():
                places = length - len(run.after[k]) + np.flatnonzero(flags[ends[k] - sizes[k]:ends[k]])
                for i in stands[k]:
                    starts.setdefault(int(found.text[i]), []).append(found.place[i] - places)
        rows = []
        for k, (doc_id, text) in enumerate(zip(column(table, "doc_id").to_pylist(), texts, strict=True)):
            spans = np.empty((0, 2), np.int64)
            if again[k] and len(text) >= length:
                spans = np.array([[0, len(text)]])
            elif k in starts:
                at = np.sort(np.concatenate(starts[k]))
                ends = at + length
                new = np.concatenate(([True], at[1:] > ends[:-1]))
                spans = np.stack([at[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]], 1)
            edges = [0, *spans.ravel().tolist(), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            row = (doc_id, len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), hashlib.sha256(kept).hexdigest(),
                   spans.tolist())
            rows.append((*row, kept) if with_text else row)
        columns = list(zip(*rows, strict=True))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=False)})

    told = rounds.answer(rounds.ask(chunks.rows, questions), answers)
    run_rows = rounds.meet(chunks.rows, told, send_runs, "range long, chunk long, kind int, blob binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    return rounds.meet(chunks.rows, rounds.answer(run_rows, answers), finish, schema + (", kept binary" if with_text else ""))


def _by_range(blobs: list[bytes], cut: np.ndarray, width: int, bits: object) -> np.ndarray:
    """The answers of all asked ranges as one table of bits."""
    seen = iter(blobs)
    parts = [bits(next(seen), width * int(b - a)).reshape(-1, width) for a, b in zip(cut[:-1], cut[1:], strict=True) if a < b]
    return np.concatenate([np.empty((0, width), bool), *parts])
