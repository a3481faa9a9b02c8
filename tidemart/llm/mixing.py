"""Mixing sources to target weights, block by block.

The words of a source, its documents in a pseudorandom order, are packed into
blocks of fixed length. The mix has as many words as all documents; a source's
target is its weight's share of them, at most ``repeats`` times its size, what
is above being shared again by weight. Output is dealt in shards of a fixed
number of slots. Each shard draws its counts per source: the whole part of the
expected count, and the rest by a multinomial draw. The q-th slot of a source
takes block ``permutation(q mod blocks)`` of epoch ``q div blocks``, each epoch
with a permutation of its own, so a block comes once an epoch and at most
``repeats`` times; slots past that stay empty. Slots and blocks are joined by
index.

Running sums over a source's documents and over shards go in two steps, inside
buckets and over buckets, so a source with a third of all rows is not summed
in one task.

Null texts and texts without words have size 0 and are never taken. A null
source is a source. Equal rows count each; null ids are kept. With no words at
all every target is 0. Draws depend on the data and the seed alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.text import column, mix
from tidemart.session import pin

WEIGHTS = (1, 2, 3)
REPEATS = 3
#: Words in a block, and blocks in an output shard.
BLOCK, SHARD = 32, 2048
SEED = 3
#: Slots that one task makes from their counts, about.
SLOTS = 200_000
#: Documents in a bucket of a running sum, on average.
BUCKET = 1_000
#: Sources whose shares are sent to every task; more than these are refused.
SOURCES = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``sources``: rank, source, source_size, weight, target, blocks, share.
    ``documents``: rank, first (place of its first word in the source), doc_id, size.
    ``slots``: shard, rank, epoch, block, one row per filled slot."""

    sources: DataFrame
    documents: DataFrame
    slots: DataFrame
    block: int

    def pieces(self) -> DataFrame:
        """Which words of which document are in a block: rank, block, first, doc_id, size, from_word, words."""
        last = F.col("first") + F.col("size") - 1
        each = self.documents.filter("size > 0").withColumn(
            "block", F.explode(F.sequence(_div("first", self.block), F.floor(last / self.block)))
        )
        start = F.greatest("first", F.col("block") * self.block)
        end = F.least(last + 1, (F.col("block") + 1) * self.block)
        return each.select("rank", "block", "first", "doc_id", "size", (start - F.col("first")).alias("from_word"),
                           (end - start).alias("words"))

    def spans(self) -> DataFrame:
        """The mix itself: shard, slot and the words of documents that fill it, in block order."""
        order = Window.partitionBy("shard").orderBy(F.xxhash64("shard", "rank", "epoch", "block"), "rank", "epoch", "block")
        slots = self.slots.withColumn("slot", F.row_number().over(order) - 1)
        return slots.join(self.pieces(), ["rank", "block"])

    def taken(self) -> DataFrame:
        """rank, first, doc_id, size and the words the mix takes of each document, repeats counted."""
        times = self.slots.groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
        some = self.pieces().join(times, ["rank", "block"])
        sums = some.groupBy("rank", "first", "doc_id", "size").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        keys = ["rank", "first", "size"]
        here = self.documents.alias("d").join(
            sums.alias("s"), [F.col(f"d.{k}") == F.col(f"s.{k}") for k in keys] + [F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))],
            "left",
        )
        return here.select("d.*", F.coalesce("s.taken", F.lit(0)).cast("long").alias("taken"))


def _div(name: str, by: int) -> F.Column:
    return F.floor(F.col(name) / by)


def running(df: DataFrame, group: str, bucket: str, order: list[str], value: str, into: str) -> DataFrame:
    """``df`` with the sum of ``value`` over what comes before in the group, buckets first."""
    sums = df.groupBy(group, bucket).agg(F.sum(value).alias("held"))
    earlier = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, bucket, F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("_earlier"))
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(sums, [group, bucket]).withColumn(into, (F.col("_earlier") + F.col("_local")).cast("long")).drop(
        "_earlier", "_local", bucket
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK) -> DataFrame:
    """One row per source of ``sizes`` (source, size): its rank, weight, target, blocks and share of the slots."""
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = pin(sums.withColumn("rank", F.row_number().over(by_name).cast("long")).withColumn("weight", weight), "sources")
    limit = F.col("source_size") * float(repeats)
    # Sources reach their limit in the order of limit over weight; at the level where the total is
    # spent, those before have their limit and the others the level times their weight.
    ladder = ranked.withColumn("limit", limit).withColumn("step", F.col("limit") / F.col("weight"))
    order = Window.orderBy("step", "rank")
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - (F.sum("limit").over(order) - F.col("limit"))) / (
        F.sum("weight").over(Window.partitionBy()) - (F.sum("weight").over(order) - F.col("weight"))
    )
    ladder = ladder.withColumn("level", level)
    level = ladder.filter("level <= step").agg(F.coalesce(F.min_by("level", F.struct("step", "rank")), F.max("step")).alias("found"))
    # Rounding may leave no row at or below its step when every source is at its limit.
    found = level.first().found
    target = F.least(limit, F.col("weight") * F.lit(float(found) if found is not None else float("inf")))
    sources = ranked.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(F.lit(0.0)))
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    slots = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    return pin(sources.withColumn("share", slots), "targets")


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Each index below its size to its place in the permutation named by its key.

    A four-round Feistel network over the next even power of two, walked until
    the place is below the size again.
    """
    half = (np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)) / 2))).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    place = index.astype(np.uint64)
    walking = np.arange(len(place))
    while len(walking):
        high, low = place[walking] >> half[walking], place[walking] & mask[walking]
        for step in range(4):
            with np.errstate(over="ignore"):
                turn = mix(low + key[walking] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step + 1)) & mask[walking]
            high, low = low, high ^ turn
        place[walking] = (high << half[walking]) | low
        walking = walking[place[walking] >= size[walking].astype(np.uint64)]
    return place.astype(np.int64)


def mix_sources(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK,
                shard: int = SHARD, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text",
                source_column: str = "source") -> Mix:
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(f"`{text_column}`"), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = pin(docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                            F.col(f"`{source_column}`").alias("source"), size.alias("size")), "sizes")
    sources = targets(sizes, weights, repeats, block)
    plan = sources.select("rank", "blocks", "share").orderBy("rank").limit(SOURCES + 1).collect()
    if len(plan) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources; their shares would not fit in every task")

    rows = sizes.join(sources.select("source", "rank"), sizes.source.eqNullSafe(sources.source)).select("rank", "doc_id", "size")
    buckets = max(1, sizes.count() // BUCKET)
    # Equal rows share a place in the order: one row stands for them in the sums.
    equal = rows.groupBy("rank", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    keyed = equal.withColumn("mark", F.xxhash64(F.lit(seed), "doc_id", "size"))
    # Buckets are ranges of the mark, so that they follow one another in its order.
    width = 2.0 ** 64 / buckets
    keyed = keyed.withColumn("bucket", F.floor((F.col("mark") + 2.0 ** 63) / width)).withColumn("words", F.col("size") * F.col("copies"))
    placed = running(keyed, "rank", "bucket", ["mark", "doc_id", "size"], "words", "start")
    each = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    documents = pin(each.select("rank", (F.col("start") + F.col("copy") * F.col("size")).alias("first"), "doc_id", "size"), "places")

    ranks = np.array([r["rank"] for r in plan], np.int64)
    share = np.array([r["share"] for r in plan], float)
    total = int(round(share.sum()))
    part = share / share.sum() if total else share

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in column(batch, "id").to_pylist():
                here = min(shard, total - number * shard)
                whole = np.floor(here * part).astype(np.int64)
                rest = here * part - whole
                left = here - int(whole.sum())
                if left > 0:
                    chance = rest if rest.sum() > 0 else part
                    whole = whole + np.random.default_rng((seed, number)).multinomial(left, chance / chance.sum())
                some = np.flatnonzero(whole)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), number)), pa.array(ranks[some]), pa.array(whole[some])], ["shard", "rank", "count"]
                )

    shards = -(-total // shard)
    drawn = spark.range(shards).mapInArrow(draw, "shard long, rank long, count long").withColumn("bucket", _div("shard", 4096))
    counted = running(pin(drawn, "draws"), "rank", "bucket", ["shard"], "count", "before")
    limits = sources.select("rank", "blocks")
    # Few counts become many slots: they are spread first, whole shards to a task.
    spread = counted.join(limits, "rank").repartition(max(1, -(-total // SLOTS)), "shard")
    each = spread.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    number = F.col("before") + F.col("k")
    each = each.select("shard", "rank", "blocks", F.floor(number / F.col("blocks")).alias("epoch"),
                       (number % F.col("blocks")).alias("turn")).filter(F.col("epoch") < repeats)

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, epoch = np.asarray(column(batch, "rank")), np.asarray(column(batch, "epoch"))
            key = mix((rank * 64 + epoch + seed * 2 ** 40).astype(np.uint64))
            block_of = permuted(np.asarray(column(batch, "turn")), np.asarray(column(batch, "blocks")), key)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "shard"), column(batch, "rank"), column(batch, "epoch"), pa.array(block_of)],
                ["shard", "rank", "epoch", "block"],
            )

    slots = each.mapInArrow(permute, "shard long, rank long, epoch long, block long")
    return Mix(sources, documents, slots, block)


def taken_words(docs: DataFrame, **options: object) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target and the words taken."""
    mixed = mix_sources(docs, **options)
    sources = mixed.sources.select("rank", "source", "source_size", "target")
    return mixed.taken().join(sources, "rank").select("doc_id", "size", "source", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, *, seed: int = SEED, **options: object) -> DataFrame:
    """``docs`` in the mix's proportions: each row as often as its words were taken, in whole documents.

    A document taken 1.3 times comes twice for three in ten of such documents,
    by a hash of its id, and once otherwise; so sources keep their targets.
    Rows that share an id are taken alike.
    """
    taken = mix_sources(docs, seed=seed, **options).taken()
    chance = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    times = taken.groupBy("doc_id").agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("times"))
    times = times.select("doc_id", F.floor(F.col("times") + chance).cast("int").alias("times"))
    times = pin(times.filter("times > 0"), "times")
    # A column name that documents have not got.
    copy = "copy" + "_" * max(map(len, docs.columns))
    joined = docs.join(times, docs["doc_id"].cast("long").eqNullSafe(times["doc_id"]))
    repeated = joined.select(*(docs[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), times["times"])).alias(copy))
    return repeated.drop(copy)
