"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine c lie at squared distance 2 - 2c. A random rotation
spreads that distance evenly; the rotated vectors are split into blocks. If
two vectors are within the budget, at least one block of them is within the
block's share of it (its dimensions over all dimensions), so the union of the
blocks' range joins has every pair. Each block is range-joined by slabs: rows
are dealt by their first rotated coordinate of the block into slabs as wide as
the block's radius, and only equal and neighbouring slabs are compared. Slabs
are cut into tiles of bounded size; a task compares two tiles. A large table has
many pairs of tiles, and each sends its vectors: pairs are dealt into rounds that
send about the table once each, and a round's shuffle files go when it ends, so
the disk does not grow with the number of pairs. Candidates of a block are kept if no earlier block has them too, then verified on the given
vectors in double precision.

Exact copies are compared once and counted with their number. A task returns
counts per vector and the links that connect what it has found, not pairs, so
a large group of near copies costs comparisons but no rows.

Vectors that are null, zero, empty or hold null or non-finite components link
with nothing, nor do vectors of different length. Vectors with a null id are
kept but link with nothing; a repeated id counts as another vector of that id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.components import components
from tidemart.llm.text import column
from tidemart.session import SMALLEST, fresh_path, pin, shuffles_deleted

COSINE = 0.95
#: Dimensions in a block; the last block may have fewer.
BLOCK = 16
#: Most vectors in a tile on average; a task compares two tiles.
TILE = 16384
#: Vectors of more dimensions than that have smaller tiles, down to LEAST_TILE.
TILE_SIZE, LEAST_TILE = 64, 4096
#: Rows compared at a time with a whole tile.
STEP = 256
#: Bytes that a round sends at least, and bytes of a sent row besides its vector.
ROUND_BYTES, ROW_BYTES = 256 << 20, 80
SEED = 5
#: Allowance for rounding in the range join; the exact check follows.
SLACK = 1e-4

_GROUP = ["size", "block", "slab", "tile", "other_slab", "other_tile"]


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng((SEED, size)).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def blocks_of(size: int) -> list[tuple[int, int]]:
    return [(a, min(a + BLOCK, size)) for a in range(0, size, BLOCK)]


def _matrix(values: pa.Array, size: int) -> np.ndarray:
    return np.asarray(values.flatten(), np.float64).reshape(-1, size)


def _units(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class _Labels:
    """Least ids reached so far; every change is noted as a link, so connections are never lost."""

    def __init__(self, ids: np.ndarray) -> None:
        self.least = ids.copy()
        self.noted: list[np.ndarray] = []

    def lower(self, rows: np.ndarray | slice, to: np.ndarray) -> bool:
        was = self.least[rows]
        less = to < was
        if not less.any():
            return False
        self.noted.append(np.unique(np.stack([was[less], to[less]], 1), axis=0))
        self.least[rows] = np.minimum(was, to)
        return True


def compare(ids: np.ndarray, other_ids: np.ndarray, units: np.ndarray, other_units: np.ndarray, block: int,
            cosine: float, copies: np.ndarray, other_copies: np.ndarray, same: bool,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of links for both tiles' vectors and the links that connect them, for candidates of ``block``."""
    turned = rotation(units.shape[1])
    a, b = (units @ turned).astype(np.float32), (other_units @ turned).astype(np.float32)
    budget, spans = 2 - 2 * cosine, blocks_of(units.shape[1])
    most = [budget * (e - s) / units.shape[1] + SLACK for s, e in spans]
    squares = [((a[:, s:e] ** 2).sum(1), (b[:, s:e] ** 2).sum(1)) for s, e in spans]

    def near(k: int, rows: slice, cols: np.ndarray | slice) -> np.ndarray:
        s, e = spans[k]
        return squares[k][0][rows, None] + squares[k][1][None, cols] - 2 * (a[rows, s:e] @ b[cols, s:e].T) <= most[k]

    counts, other_counts = np.zeros(len(ids), np.int64), np.zeros(len(other_ids), np.int64)
    mine, theirs = _Labels(ids), _Labels(other_ids)
    far = np.iinfo(np.int64).max
    for start in range(0, len(ids), STEP):
        rows = slice(start, min(start + STEP, len(ids)))
        candidates = near(block, rows, slice(None))
        if same:
            candidates &= np.arange(rows.start, rows.stop)[:, None] < np.arange(len(other_ids))[None, :]
        cols = np.flatnonzero(candidates.any(0))
        if not len(cols):
            continue
        candidates = candidates[:, cols]
        for earlier in range(block):
            candidates &= ~near(earlier, rows, cols)
        linked = candidates & (units[rows] @ other_units[cols].T >= cosine)
        if not linked.any():
            continue
        counts[rows] += linked @ other_copies[cols]
        other_counts[cols] += copies[rows] @ linked
        changed = True
        while changed:
            to = np.where(linked, theirs.least[None, cols], far).min(1)
            changed = mine.lower(rows, to)
            to = np.where(linked, mine.least[rows, None], far).min(0)
            changed |= theirs.lower(cols, to)
    noted = mine.noted + theirs.noted
    return counts, other_counts, np.concatenate(noted) if noted else np.empty((0, 2), np.int64)


def _tile_rows(size: Column) -> Column:
    return F.greatest(F.least(F.lit(TILE), F.floor(F.lit(TILE * TILE_SIZE) / size)), F.lit(min(TILE, LEAST_TILE)))


def _planned(held: DataFrame) -> tuple[DataFrame, int]:
    """Pairs of tiles that are compared, each with its round, and the number of rounds.

    A tile meets itself, the others of its slab, and those of the next slab.
    """
    keys, each = ["size", "block", "slab"], F.col("held") / F.col("tiles")
    after = held.select("size", "block", (F.col("slab") - 1).alias("slab"), F.col("tiles").alias("other_tiles"), each.alias("other_rows"))
    first = held.select(*keys, each.alias("rows"), "tiles", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    same = first.select(*keys, "tile", F.col("slab").alias("other_slab"), "rows", F.col("rows").alias("other_rows"),
                        F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("other_tile"))
    following = first.join(after, keys).select(*keys, "tile", (F.col("slab") + 1).alias("other_slab"), "rows", "other_rows",
                                               F.explode(F.sequence(F.lit(0), F.col("other_tiles") - 1)).alias("other_tile"))
    width = 8 * F.col("size") + ROW_BYTES
    whole = F.sum(F.when(F.col("block") == 0, F.col("held") * width))
    table = held.agg(F.coalesce(whole, F.lit(0)).alias("bytes")).first().bytes
    pairs = pin(same.unionByName(following), "tile-pairs")
    total = pairs.agg(F.coalesce(F.sum((F.col("rows") + F.col("other_rows")) * width), F.lit(0.0)).alias("bytes")).first().bytes
    rounds = max(1, math.ceil(total / max(table, ROUND_BYTES)))
    return pairs.select(*_GROUP, F.pmod(F.xxhash64(*_GROUP), F.lit(rounds)).alias("round")), rounds


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_column: str = "vec_id",
                    vector_column: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must be above 0 and at most 1")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"),
                          F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    # Adding 0.0 makes -0.0 and 0.0 one value.
    exact = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = pin(rows.select("vec_id", F.when(F.coalesce(usable, F.lit(False)), exact).alias("vector")), "vectors", SMALLEST)
    copies = rows.filter("vector is not null").groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    copies = copies.withColumn("size", F.size("vector")).select("size", "rep", "copies", "vector")
    schema = "size int, rep long, copies long, vector array<double>, slabs array<int>"

    def slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(column(batch, "size"))
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                turned = _units(_matrix(column(some, "vector"), int(size))) @ rotation(int(size))
                spans = blocks_of(int(size))
                radii = [np.sqrt((2 - 2 * cosine) * (end - start) / size + SLACK) for start, end in spans]
                slab = np.floor(turned[:, [start for start, _ in spans]] / radii).astype(np.int32)
                ends = np.arange(len(slab) + 1, dtype=np.int32) * len(spans)
                yield pa.RecordBatch.from_arrays(
                    [*(column(some, c) for c in ("size", "rep", "copies", "vector")),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(slab.ravel()))],
                    ["size", "rep", "copies", "vector", "slabs"],
                )

    with shuffles_deleted(spark):
        copies = pin(copies.mapInArrow(slabs, schema), "distinct-vectors", SMALLEST)
    placed = copies.select("size", "rep", "copies", "vector", F.posexplode("slabs").alias("block", "slab"))
    # One row per length, block and slab: a coordinate of a unit vector has few slabs.
    held = placed.groupBy("size", "block", "slab").agg(F.count(F.lit(1)).alias("held"))
    held = pin(held.withColumn("tiles", F.ceil(F.col("held") / _tile_rows(F.col("size"))).cast("int")), "slabs")
    planned, rounds = _planned(held)
    tiles = F.broadcast(held.select("size", "block", "slab", "tiles"))
    tiled = placed.join(tiles, ["size", "block", "slab"]).withColumn(
        "tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    ).drop("tiles")

    def sent(number: int) -> DataFrame:
        """Rows once for each pair of tiles of a round that theirs is in."""
        pairs = planned.filter(F.col("round") == number).select(*_GROUP)
        mine = pairs.select("size", "block", "slab", "tile", F.struct(*_GROUP[2:], F.lit(True).alias("first")).alias("pair"))
        theirs = pairs.filter("slab <> other_slab or tile <> other_tile").select(
            "size", "block", F.col("other_slab").alias("slab"), F.col("other_tile").alias("tile"),
            F.struct(*_GROUP[2:], F.lit(False).alias("first")).alias("pair"))
        each = mine.unionByName(theirs).groupBy("size", "block", "slab", "tile").agg(F.collect_list("pair").alias("pairs"))
        # A round has so few pairs, of whole tiles, that they are broadcast.
        meeting = tiled.join(F.broadcast(each), ["size", "block", "slab", "tile"])
        return meeting.select("size", "block", F.explode("pairs").alias("p"), "rep", "copies", "vector").select(
            "size", "block", "p.*", "rep", "copies", "vector")

    def task(key: tuple, table: pa.Table) -> pa.Table:
        size, block, slab, tile, other_slab, other_tile = (k.as_py() for k in key)
        alike = slab == other_slab and tile == other_tile
        ids, copied = np.asarray(column(table, "rep")), np.asarray(column(table, "copies"))
        units, first = _units(_matrix(column(table, "vector"), size)), np.asarray(column(table, "first").to_numpy(False), bool)
        one, two = (np.arange(len(ids)),) * 2 if alike else (np.flatnonzero(first), np.flatnonzero(~first))
        order = [x[np.argsort(ids[x], kind="stable")] for x in (one, two)]
        counts, other_counts, noted = compare(
            ids[order[0]], ids[order[1]], units[order[0]], units[order[1]], block, cosine,
            copied[order[0]], copied[order[1]], alike,
        )
        found = np.concatenate([counts, other_counts])
        who = np.concatenate([ids[order[0]], ids[order[1]]])
        some = found > 0
        return pa.table({
            "a": pa.array(np.concatenate([who[some], noted[:, 0]]), pa.int64()),
            "b": pa.array(np.concatenate([who[some], noted[:, 1]]), pa.int64()),
            "found": pa.array(np.concatenate([found[some], np.zeros(len(noted), np.int64)]), pa.int64()),
        })

    path, links = fresh_path(spark, "embedding-links"), "a long, b long, found long"
    with shuffles_deleted(spark):
        for number in range(rounds):
            sent(number).groupBy(*_GROUP).applyInArrow(task, links).write.mode("append").parquet(path)
    results = spark.read.schema(links).parquet(path)
    linked = results.groupBy(F.col("a").alias("rep")).agg(F.sum("found").alias("found"))
    least = components(results).select(F.col("node").alias("rep"), "component")
    links_of = (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    component = F.coalesce("component", "rep").alias("component_id")
    # Only copies are joined by their vectors; a vector without copies has its id's class, so few vectors move.
    several = copies.filter("copies > 1").join(linked, "rep", "left").join(least, "rep", "left").select(
        F.col("vector").alias("of"), links_of, component)
    # Several vectors of one id have one class.
    single = copies.filter("copies = 1").select("rep", "copies").distinct().join(linked, "rep", "left").join(least, "rep", "left").select(
        "rep", links_of.alias("single_links"), component.alias("single_component"))
    alone = F.when(F.col("vector").isNotNull() & F.col("of").isNull(), F.col("vec_id")).alias("alone")
    copied = rows.join(several, rows.vector == several.of, "left").select("vec_id", alone, "n_links", "component_id")
    every = copied.join(single, copied.alone == single.rep, "left")
    component = F.coalesce("component_id", "single_component", "vec_id")
    return every.select("vec_id", F.coalesce("n_links", "single_links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
