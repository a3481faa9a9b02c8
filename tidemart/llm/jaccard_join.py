"""N-gram Jaccard join of documents by grouped prefixes.

A document's set has its distinct word shingles as 64-bit hashes. Two
documents link when their sets' Jaccard similarity reaches the threshold, so
each must share all but a known number of its shingles; the first few shingles
of each, in an order common to all, must then meet.

1. Document filter. In hash order, linked documents share a known number of
   the shingles of slightly longer prefixes. Documents in whose prefix too few
   shingles occur anywhere else have no link and leave. Documents with the
   same set are one from here on; a chunk names each of its sets once.
2. Prefixes. Among the rest shingles are ordered by frequency, rarest first.
   Documents with the same prefix and size form a group.
3. Stars. Each group is verified against the first group of the posting it
   shares most shingles with, and its members against its first one; verified
   links give first components. A large group of near copies becomes one
   component here, in linear time.
4. Group pairs. Groups that share a prefix shingle and lie in different
   components are filtered by size, position and, member by member, by
   bitmaps of their sets; what remains is verified exactly. Pairs inside a
   component are never made, as they cannot change the result.

Texts that are null or have no words have an empty set and link with nothing.
Rows with a null id link with nothing and have no component. Rows with the
same id are one node, also if their texts differ: all that any of them links
with is one component. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import rounds
from tidemart.llm.components import components
from tidemart.llm.text import chained, column, hashed_words, texts_of
from tidemart.session import pin

WIDTH, PERCENT = 4, 85
#: How many shared shingles the document filter asks for, as a share of the set.
FILTER_SHARE = 0.2
#: 64-bit words of a set's bitmap, and of the shorter one it folds to.
BITMAP, FOLDED = 16, 4


def sets_of(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes. Only A-Z are lower-cased."""
    marks, bounds = hashed_words(texts)
    shingles = chained(marks, width)
    found = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= width:
            found.append(np.unique(shingles[a:b - width + 1]))
        else:
            found.append(chained(marks[a:b], b - a) if b > a else shingles[:0])
    return found


def least_overlap(size: int, percent: int) -> int:
    """Shingles that a set must share with any set it links with."""
    return -(-percent * size // 100)


def _asked_for(size: int) -> int:
    return int(FILTER_SHARE * size) + 1


def filter_length(size: int, percent: int) -> int:
    need = least_overlap(size, percent)
    return min(size, size - need + min(need, _asked_for(size)))


def filter_need(size: int, percent: int) -> int:
    """Shared shingles in the filter prefix of a set that links with some other one."""
    smallest = least_overlap(size, percent)
    return min(least_overlap(smallest, percent), _asked_for(smallest))


def _filtered(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, rep and, for first documents of a set that may link, the set."""
    chunks = rounds.deal(docs, "text")
    ranges = chunks.ranges(0.35)

    def prefixes(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        sets = sets_of(texts_of(table), width)
        lengths = np.array([filter_length(len(s), percent) for s in sets], np.int64)
        heads = np.concatenate([s[:k] for s, k in zip(sets, lengths, strict=True)]) if sets else np.empty(0, np.uint64)
        return sets, lengths, heads

    def prints(table: pa.Table, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct 128-bit prints of the sets that may link, the smallest id of each, and each row's place there or -1."""
        ids = column(table, "doc_id").to_pylist()
        rows = [k for k, (s, i) in enumerate(zip(sets, ids, strict=True)) if len(s) and i is not None]
        digests = b"".join(xxhash.xxh3_128_digest(sets[k].tobytes()) for k in rows)
        pairs = np.frombuffer(digests, "<u8").reshape(-1, 2).astype(np.uint64)
        some = np.array([ids[k] for k in rows], np.int64)
        order = np.lexsort((some, pairs[:, 1], pairs[:, 0]))
        new = np.ones(len(order), bool)
        new[1:] = (pairs[order[1:]] != pairs[order[:-1]]).any(axis=1)
        place = np.full(len(sets), -1, np.int64)
        place[np.array(rows, np.int64)[order]] = np.cumsum(new) - 1
        return pairs[order[new]], some[order[new]], place

    def questions(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
        sets, _, heads = prefixes(table)
        keys, counts = np.unique(heads, return_counts=True)
        at = rounds.cuts(keys, ranges)
        for k in range(ranges):
            some = slice(at[k], at[k + 1])
            if at[k] < at[k + 1]:
                yield 0, k, rounds.join_blobs([rounds.pack_sorted(keys[some]), rounds.squeeze(np.packbits(counts[some] > 1).tobytes())])
        pairs, ids, _ = prints(table, sets)
        at = rounds.cuts(pairs[:, 0], ranges)
        for k in range(ranges):
            some = slice(at[k], at[k + 1])
            if at[k] < at[k + 1]:
                yield 1, k, rounds.pack(np.concatenate([pairs[some, 0], pairs[some, 1], ids[some].view(np.uint64)]))

    def answers(kind: int, blobs: list[bytes]) -> list[bytes]:
        if kind == 0:
            parts = [rounds.split_blobs(b) for b in blobs]
            asked = [rounds.unpack_sorted(p[0]) for p in parts]
            twice = [np.unpackbits(np.frombuffer(rounds.expand(p[1]), np.uint8), count=len(a)).astype(bool)
                     for p, a in zip(parts, asked, strict=True)]
            every = np.sort(np.concatenate([*asked, *(a[t] for a, t in zip(asked, twice, strict=True))]))
            shared = np.unique(every[1:][every[1:] == every[:-1]])
            return [rounds.squeeze(np.packbits(_among(a, shared)).tobytes()) for a in asked]
        asked = [rounds.unpack(b, np.uint64).reshape(3, -1) for b in blobs]
        every = np.concatenate(asked, axis=1)
        ids = every[2].view(np.int64)
        order = np.lexsort((ids, every[1], every[0]))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(every[0][order]) != 0) | (np.diff(every[1][order]) != 0)
        reps = np.empty(len(order), np.int64)
        reps[order] = ids[order][first][np.cumsum(first) - 1]
        ends = np.cumsum([a.shape[1] for a in asked])
        return [rounds.pack(reps[e - a.shape[1]:e]) for a, e in zip(asked, ends, strict=True)]

    def finish(table: pa.Table, answered: rounds.Answers) -> pa.Table:
        sets, lengths, heads = prefixes(table)
        keys = np.unique(heads)
        at, shared, seen = rounds.cuts(keys, ranges), np.zeros(len(keys), bool), iter(answered.get(0, []))
        for k in range(ranges):
            if at[k] < at[k + 1]:
                bits = np.frombuffer(rounds.expand(next(seen)), np.uint8)
                shared[at[k]:at[k + 1]] = np.unpackbits(bits, count=at[k + 1] - at[k]).astype(bool)
        marks = np.concatenate(([0], np.cumsum(shared[np.searchsorted(keys, heads)])))
        ends = np.cumsum(lengths)
        counts = marks[ends] - marks[ends - lengths]
        sizes = np.array([len(s) for s in sets], np.int64)
        _, ids, place = prints(table, sets)
        reps = np.concatenate([rounds.unpack(b, np.int64) for b in answered.get(1, [])]) if len(ids) else ids
        doc_ids = column(table, "doc_id").to_pylist()
        rep_of = [int(reps[p]) if p >= 0 else i for p, i in zip(place, doc_ids, strict=True)]
        may = [i is not None and n > 0 and c >= filter_need(int(n), percent) for i, n, c in zip(doc_ids, sizes, counts, strict=True)]
        kept, done = [], set()
        for s, m, i, r, p in zip(sets, may, doc_ids, rep_of, place.tolist(), strict=True):
            kept.append(rounds.pack_sorted(s) if m and r == i and p not in done else None)
            if r == i:
                done.add(p)
        return pa.table({
            "doc_id": pa.array(doc_ids, pa.int64()), "n": pa.array(sizes, pa.int64()),
            "rep": pa.array(rep_of, pa.int64()),
            "shingles": pa.array(kept, pa.binary()),
        })

    answered = rounds.answer(rounds.ask(chunks.rows, questions), answers)
    return rounds.meet(chunks.rows, answered, finish, "doc_id long, n long, rep long, shingles binary")


def _among(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Each bit is the parity of the shingles it stands for: sets differ in no fewer shingles than bits."""
    bits = 64 * BITMAP
    places = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((places & 1).astype(np.uint8)).view(np.int64)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """doc_id, n, a hash of the prefix, its shingles that others have too with their places, and the bitmap."""
    chunks = rounds.deal(sets, "shingles")
    ranges = chunks.ranges(1.0)

    def all_of(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        own = [rounds.unpack_sorted(b.as_py()) for b in column(table, "shingles")]
        keys, counts = np.unique(np.concatenate(own), return_counts=True)
        return own, keys, counts.astype(np.uint32)

    def questions(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
        _, keys, counts = all_of(table)
        at = rounds.cuts(keys, ranges)
        for k in range(ranges):
            some = slice(at[k], at[k + 1])
            if at[k] < at[k + 1]:
                yield 0, k, rounds.join_blobs([rounds.pack_sorted(keys[some]), rounds.pack(counts[some])])

    def answers(kind: int, blobs: list[bytes]) -> list[bytes]:
        parts = [rounds.split_blobs(b) for b in blobs]
        asked = [rounds.unpack_sorted(p[0]) for p in parts]
        counts = np.concatenate([rounds.unpack(p[1], np.uint32) for p in parts]).astype(np.int64)
        _, place = np.unique(np.concatenate(asked), return_inverse=True)
        sums = np.zeros(int(place.max()) + 1, np.int64)
        np.add.at(sums, place, counts)
        ends = np.cumsum([len(a) for a in asked])
        return [rounds.pack(sums[place[e - len(a):e]]) for a, e in zip(asked, ends, strict=True)]

    def finish(table: pa.Table, answered: rounds.Answers) -> pa.Table:
        own, keys, _ = all_of(table)
        frequency = np.concatenate([rounds.unpack(b, np.int64) for b in answered[0]])
        prints, tokens, places, maps = [], [], [], []
        for s in own:
            of = frequency[np.searchsorted(keys, s)]
            order = np.lexsort((s, of))[:len(s) - least_overlap(len(s), percent) + 1]
            prints.append(xxhash.xxh3_64_intdigest(s[order].tobytes()))
            shared = np.flatnonzero(of[order] > 1)
            tokens.append(s[order][shared].view(np.int64))
            places.append(shared)
            maps.append(bitmap(s))
        return pa.table({
            "doc_id": column(table, "doc_id"), "n": column(table, "n"),
            "prefix": pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64()),
            "tokens": pa.array(tokens, pa.list_(pa.int64())), "places": pa.array(places, pa.list_(pa.int64())),
            "bits": pa.array(maps, pa.list_(pa.int64())),
        })

    answered = rounds.answer(rounds.ask(chunks.rows, questions), answers)
    schema = "doc_id long, n long, prefix long, tokens array<long>, places array<long>, bits array<long>"
    return rounds.meet(chunks.rows, answered, finish, schema).filter(F.size("tokens") > 0)


def _overlap(n: Column, m: Column, percent: int) -> Column:
    """Shingles that two sets of these sizes must share to link."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sets reach the threshold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(column(batch, "set_a"), column(batch, "set_b"), strict=True):
                x, y = rounds.unpack_sorted(one.as_py()), rounds.unpack_sorted(two.as_py())
                both = int(_among(x, y).sum())
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b")], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    joined = pairs.join(two, "b").join(one, "a").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(check, "a long, b long")


def _near(bits: str, other: str, n: Column, m: Column, percent: int, words: int = BITMAP) -> Column:
    """Whether the bitmaps of two sets of these sizes differ in no more bits than linked sets may."""
    differ = F.lit(0)
    for k in range(words):
        differ = differ + F.bit_count(F.col(bits)[k].bitwiseXOR(F.col(other)[k]))
    return differ <= n + m - 2 * _overlap(n, m, percent)


def _may_link(one: str, two: str, percent: int) -> Column:
    """Whether what is known of two sides allows a link: sizes, shingles left at the shared one, bitmaps."""
    low_a, high_a, reach_a, fold_a = (F.col(f"{c}{one}") for c in ("low", "high", "reach", "fold"))
    low_b, high_b, reach_b, fold_b = (F.col(f"{c}{two}") for c in ("low", "high", "reach", "fold"))
    sizes = (100 * high_a >= percent * low_b) & (100 * high_b >= percent * low_a)
    places = F.least(reach_a, reach_b) >= _overlap(low_a, low_b, percent)
    bitmaps = fold_a.isNull() | fold_b.isNull() | _near(f"fold{one}", f"fold{two}", low_a, low_b, percent, FOLDED)
    return sizes & places & bitmaps


def _folded(bits: str) -> Column:
    """The bitmap folded to fewer words, each bit again the parity of its shingles."""
    words = []
    for k in range(FOLDED):
        word = F.col(bits)[k]
        for more in range(k + FOLDED, BITMAP, FOLDED):
            word = word.bitwiseXOR(F.col(bits)[more])
        words.append(word)
    return F.array(*words)


def _postings(groups: DataFrame, *more: str) -> DataFrame:
    each = F.explode(F.arrays_zip("tokens", "places")).alias("e")
    return groups.select("gid", "n", *more, each).select(
        "gid", "n", *more, F.col("e.tokens").alias("token"), F.col("e.places").alias("place")
    )


def link(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    if width < 1 or not 1 <= percent <= 100:
        raise ValueError("shingles need a word at least, and the threshold is 1 to 100 percent")
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    every = pin(_filtered(rows, width, percent), "shingle-sets")
    sets = every.filter("shingles is not null").select("doc_id", "n", "shingles")
    heads = pin(_prefixes(sets, percent), "prefixes")

    # Groups of the same prefix and size, named by their first member.
    names = heads.groupBy("n", "prefix").agg(F.min("doc_id").alias("gid"))
    members = pin(heads.join(names, ["n", "prefix"]), "members")
    postings = _postings(members.filter("doc_id = gid"))
    least = postings.groupBy("token").agg(F.min("gid").alias("first"), F.count(F.lit(1)).alias("held"))
    shared = postings.join(least.filter("held > 1"), "token").filter("gid > first").groupBy("gid", "first").agg(
        F.count(F.lit(1)).alias("common")
    )
    star = shared.groupBy("gid").agg(F.min_by("first", F.struct(-F.col("common"), F.col("first"))).alias("first"))
    bits = members.select(F.col("doc_id").alias("id"), "n", "bits")
    star = star.select(F.col("gid").alias("a"), F.col("first").alias("b")).unionByName(
        members.filter("doc_id > gid").select(F.col("doc_id").alias("a"), F.col("gid").alias("b"))
    )
    first_links = pin(verified(_close(star, bits, percent), sets, percent), "star-links")
    component = components(first_links)

    # Across components: groups are cut by component, and pairs of components share a shingle.
    placed = members.join(component.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    larger = component.select("component", F.lit(True).alias("larger")).distinct()
    placed = placed.drop("gid").join(larger, "component", "left")
    cut = placed.groupBy("n", "prefix", "component").agg(F.min("doc_id").alias("part"), F.count(F.lit(1)).alias("members"))
    parts = pin(placed.join(cut, ["n", "prefix", "component"]), "parts")
    # A group of one document has its bitmap beside each of its shingles, a component of one beside each posting.
    named = parts.filter("doc_id = part").select(
        "*", F.col("part").alias("gid"), F.when(F.col("members") == 1, _folded("bits")).alias("fold"), F.col("larger").isNull().alias("alone")
    )
    posted = pin(_postings(named, "component", "fold", "alone"), "postings")
    held = posted.groupBy("token", "component").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("reach"),
        # Rows of one id may have several sets.
        F.when(F.count(F.lit(1)) == 1, F.first(F.when(F.col("alone"), F.col("fold")))).alias("fold"),
    )
    several = held.groupBy("token").agg(F.count(F.lit(1)).alias("components")).filter("components > 1").select("token")
    held = pin(held.join(several, "token"), "held")
    columns = ("component", "low", "high", "reach", "fold")
    one = held.select("token", *[F.col(c).alias(f"{c}_c") for c in columns])
    two = held.select(F.col("token").alias("token_d"), *[F.col(c).alias(f"{c}_d") for c in columns])
    met = one.join(two, (F.col("token") == F.col("token_d")) & (F.col("component_c") < F.col("component_d"))
                   & _may_link("_c", "_d", percent)).drop("token_d", "low_c", "high_c", "reach_c", "fold_c")
    # From components to their groups, one side after the other, each time with what is known of both.
    exact = [F.col("n").alias("low"), F.col("n").alias("high"), (F.col("n") - F.col("place")).alias("reach"), "fold", "gid"]
    left = posted.select(F.col("token").alias("token_g"), F.col("component").alias("of_g"), *exact).withColumnsRenamed(
        {c: f"{c}_g" for c in (*columns[1:], "gid")})
    right = posted.select(F.col("token").alias("token_h"), F.col("component").alias("of_h"), *exact).withColumnsRenamed(
        {c: f"{c}_h" for c in (*columns[1:], "gid")})
    half = met.join(left, (F.col("token") == F.col("token_g")) & (F.col("component_c") == F.col("of_g")) & _may_link("_g", "_d", percent))
    whole = half.join(right, (F.col("token") == F.col("token_h")) & (F.col("component_d") == F.col("of_h")) & _may_link("_g", "_h", percent))
    group_pairs = pin(whole.select(F.col("gid_g").alias("g"), F.col("gid_h").alias("h")).distinct(), "group-pairs")
    inside = parts.select("part", "doc_id", "n", "bits")
    mine = inside.select(F.col("part").alias("g"), F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    theirs = inside.select(F.col("part").alias("h"), F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    expanded = group_pairs.join(mine, "g").join(
        theirs, (group_pairs.h == theirs.h) & _near("bits_a", "bits_b", F.col("n_a"), F.col("n_b"), percent)
    ).select("a", "b")
    more_links = verified(expanded, sets, percent)
    # Ids whose rows have different sets hold together what those link with.
    unlike = every.groupBy("doc_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least < most").select("doc_id")
    same_id = every.join(unlike, "doc_id").filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    final = components(first_links.unionByName(more_links).unionByName(same_id))
    of_rep = final.select(F.col("node").alias("rep"), F.col("component").alias("found"))
    return every.join(of_rep, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("found", "rep").alias("component_id")
    )


def _close(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and bitmaps allow a link."""
    one = bits.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = bits.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    near = _near("bits_a", "bits_b", F.col("n_a"), F.col("n_b"), percent)
    return pairs.join(one, "a").join(two, "b").filter(near).select("a", "b")
