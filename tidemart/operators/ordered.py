"""Ordered analytics without a single-task window.

A window function without ``partitionBy``, or over a group that holds a large
part of the table, sorts all its rows in one task. The functions here cut the
ordering into slices of about equal size instead. The cut points are rows drawn
in a seeded sample, so a slice is a plain column expression: every use of it
agrees, and rows shuffle once, by slice. Equal values may fall into several
slices, because a unique ``tie`` column is part of the cut key.

There are as many slices as shuffle partitions, so a slice is what a task would
sort in any other shuffle, and the cuts follow the cluster and not the table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import pin

SAMPLES_PER_SLICE = 20


def _partitions(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _slices(df: DataFrame, rows: int, rows_per_slice: int | None) -> int:
    return max(1, math.ceil(rows / rows_per_slice)) if rows_per_slice else _partitions(df)


class Cuts(NamedTuple):
    """Sorted cut rows as constant arrays: their keys, and what else they carry."""

    keys: Column
    carried: Column
    count: int


def _cut_points(table: DataFrame, keys: Mapping[str, Column], rows: int, slices: int,
                carried: Mapping[str, Column] | None = None) -> Cuts:
    """Cut rows from a seeded sample.

    The sample, and so what the driver sees, grows with the number of slices
    and not with the table.
    """
    carried = carried or {}
    entry = table.select(F.struct(*(c.alias(n) for n, c in {**keys, **carried}.items())).alias("k"))
    fraction = min(1.0, slices * SAMPLES_PER_SLICE / max(rows, 1))
    step = F.greatest(F.lit(1), F.floor(F.size("s") / F.lit(slices)))
    sample = entry.sample(fraction=fraction, seed=17).agg(F.sort_array(F.collect_list("k")).alias("s"))
    chosen = sample.select(F.filter("s", lambda _, i: (i > 0) & (i % step == 0)).alias("cuts"))
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    options = {"timestampFormat": stamp, "timestampNTZFormat": stamp}
    text, count = chosen.select(F.to_json("cuts", options), F.size("cuts")).first()
    fields = entry.schema["k"].dataType

    def constant(names: Mapping[str, Column]) -> Column:
        shape = T.ArrayType(T.StructType([fields[n] for n in names]))
        return F.from_json(F.lit(text), shape, options)

    return Cuts(constant(keys), constant(carried), count)


def _with_slice(df: DataFrame, keys: Mapping[str, Column], cuts: Cuts, cut_opens: bool) -> DataFrame:
    """Add ``_slice``: how many cuts lie before the row, found by halving steps.

    ``cut_opens`` says whether a cut row is the first of its slice or the last
    of the slice before. Each step is a plain compiled expression.
    """
    key = F.struct(*(c.alias(n) for n, c in keys.items()))
    placed = df.withColumn("_slice", F.lit(0))
    for step in (1 << bit for bit in reversed(range(cuts.count.bit_length()))):
        ahead = F.col("_slice") + step
        cut = F.get(cuts.keys, ahead - 1)
        passed = F.coalesce(cut <= key if cut_opens else cut < key, F.lit(False))  # null behind the last cut
        placed = placed.withColumn("_slice", F.when(passed, ahead).otherwise(F.col("_slice")))
    return placed


def strictly_before(
    df: DataFrame,
    *,
    by: Column,
    tie: str,
    measures: Mapping[str, Column | None],
    within: Sequence[str] = (),
    tie_orders: bool = False,
    pinned: bool = False,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Add, per measure, its sum over the rows that come strictly before.

    Rows are ordered by ``by`` ascending, nulls last, inside each ``within``
    group; rows with an equal value are peers and do not count for each other,
    unless ``tie_orders`` makes the tie part of the order. ``tie`` must make
    ``(within, by, tie)`` unique. The measure ``None`` counts rows, which gives
    ``rank() - 1``, or ``row_number() - 1`` with ``tie_orders``.
    """
    table = df if pinned else pin(df)
    rows = table.count()
    own = {n: F.lit(1) if m is None else F.coalesce(m, F.lit(0)) for n, m in measures.items()}
    sums = {n: c.alias(f"_m_{n}") for n, c in own.items() if measures[n] is not None}
    work = table.select("*", by.isNull().alias("_n"), by.alias("_v"), *sums.values())
    slices = _slices(table, rows, rows_per_slice)
    keys = {**{f"w{i}": F.col(w) for i, w in enumerate(within)}, "n": F.col("_n"), "v": F.col("_v")}
    group = [*within]
    if slices > 1:
        keys_and_tie = {**keys, "t": F.col(tie)}
        cuts = _cut_points(work, keys_and_tie, rows, slices)
        work = _with_slice(work, keys_and_tie, cuts, cut_opens=True)
        group = ["_slice", *within]
    local = _before_in_group(work, measures, group, tie if tie_orders else None)
    if slices > 1:
        peers = keys_and_tie if tie_orders else keys
        local = _add_earlier_slices(work, local, own, within, peers, cuts)
    return local.select(*df.columns, *measures)


def _before_in_group(work: DataFrame, measures: Mapping[str, Column | None], group: Sequence[str],
                     tie: str | None) -> DataFrame:
    """The sums before each row inside its slice and group."""
    each = Window.partitionBy(*group)
    counting = each.orderBy(F.col("_v").asc_nulls_last(), *([tie] if tie else []))
    summing = each.orderBy("_n", "_v", *([tie] if tie else []))
    peers = Window.partitionBy(*group, "_n", "_v")
    local = work
    for name, measure in measures.items():
        if measure is None:
            before = (F.row_number() if tie else F.rank()).over(counting) - 1
        else:
            mine = F.col(f"_m_{name}")
            before = F.sum(mine).over(summing) - (mine if tie else F.sum(mine).over(peers))
        local = local.withColumn(name, before)
    return local


def _add_earlier_slices(sliced: DataFrame, local: DataFrame, own: Mapping[str, Column], within: Sequence[str],
                        peers: Mapping[str, Column], cuts: Cuts) -> DataFrame:
    """Add what earlier slices hold to the sums inside a slice.

    A value that a slice shares with the next is known beforehand: it is that
    of the cut between them. Its rows in the next slice must not count those in
    this one, so they take over the sum at which the value began.
    """

    def shares(cut: Column) -> Column:
        here = F.struct(*(column.alias(field) for field, column in peers.items()))
        there = F.struct(*(cut[field].alias(field) for field in peers))
        return cut.isNotNull() & there.eqNullSafe(here)

    next_cut = F.get(cuts.keys, F.col("_slice"))
    spills = shares(next_cut)
    totals = sliced.groupBy("_slice", *within).agg(
        F.max(spills).alias("_spills"),
        *(F.sum(m).alias(f"_all_{n}") for n, m in own.items()),
        *(F.sum(F.when(spills, m).otherwise(0)).alias(f"_tail_{n}") for n, m in own.items()),
    )
    # From here on one row per slice and group: a bounded table.
    in_order = Window.partitionBy(*within).orderBy("_slice")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, -1)
    edge = totals.withColumns({f"_off_{n}": F.coalesce(F.sum(f"_all_{n}").over(so_far), F.lit(0)) for n in own})
    edge = edge.withColumns({f"_c_{f}": next_cut[f] for f in peers})
    run = Window.partitionBy(*within, *(f"_c_{f}" for f in peers), "_spills").orderBy("_slice")
    edge = edge.withColumns({
        f"_run_{n}": F.first(F.col(f"_off_{n}") + F.col(f"_all_{n}") - F.col(f"_tail_{n}")).over(run) for n in own
    })
    adjoins = F.lag("_slice").over(in_order) == F.col("_slice") - 1
    edge = edge.withColumns({
        "_continued": F.coalesce(F.lag("_spills").over(in_order) & adjoins, F.lit(False)),
        **{f"_carry_{n}": F.lag(f"_run_{n}").over(in_order) for n in own},
    }).select(
        F.col("_slice").alias("_es"), *(F.col(w).alias(f"_ew{i}") for i, w in enumerate(within)),
        "_continued", *(f"_off_{n}" for n in own), *(f"_carry_{n}" for n in own),
    )
    match = F.col("_slice") == F.col("_es")
    for i, w in enumerate(within):
        match = match & F.col(w).eqNullSafe(F.col(f"_ew{i}"))
    head = F.col("_continued") & shares(F.get(cuts.keys, F.col("_slice") - 1))
    return local.join(edge, match).withColumns({
        n: F.when(head, F.col(f"_carry_{n}")).otherwise(F.col(n) + F.col(f"_off_{n}")) for n in own
    })


def ranked(df: DataFrame, *, by: Column, tie: str, out: str, within: Sequence[str] = (),
           rows_per_slice: int | None = None) -> DataFrame:
    """``rank()`` by ``by`` ascending (negate a number to rank from the top)."""
    before = strictly_before(df, by=by, tie=tie, within=within, measures={out: None},
                             rows_per_slice=rows_per_slice)
    return before.withColumn(out, (F.col(out) + 1).cast("int"))


def numbered(df: DataFrame, *, by: Column, tie: str, out: str, within: Sequence[str] = (),
             pinned: bool = False, rows_per_slice: int | None = None) -> DataFrame:
    """``row_number()`` by ``by`` ascending, nulls last, then by the unique ``tie``."""
    before = strictly_before(df, by=by, tie=tie, within=within, measures={out: None},
                             tie_orders=True, pinned=pinned, rows_per_slice=rows_per_slice)
    return before.withColumn(out, (F.col(out) + 1).cast("int"))


def tiles(df: DataFrame, *, by: Column, tie: str, buckets: int, out: str,
          rows_per_slice: int | None = None) -> DataFrame:
    """``ntile(buckets)`` over the whole table: the first tiles take the remainder."""
    table = pin(df)
    size, larger = divmod(table.count(), buckets)
    placed = numbered(table, by=by, tie=tie, out="_pos", pinned=True, rows_per_slice=rows_per_slice)
    zero = F.col("_pos") - 1
    edge = larger * (size + 1)
    tile = F.when(zero < edge, F.floor(zero / (size + 1))).otherwise(
        larger + F.floor((zero - edge) / max(size, 1))
    )
    return placed.withColumn(out, (tile + 1).cast("int")).drop("_pos")


def neighbour(df: DataFrame, *, by: str, tie: str, value: str, out: str, step: int,
              rows_per_slice: int | None = None) -> DataFrame:
    """``lag`` (``step=-1``) or ``lead`` (``step=1``) over the whole table.

    Cut rows carry their value, and close a slice for lag or open one for lead,
    so a slice's missing neighbour is the cut itself: no second pass.
    """
    table = pin(df)
    rows = table.count()
    slices = _slices(table, rows, rows_per_slice)
    shift = F.lag if step < 0 else F.lead
    if slices <= 1:
        order = Window.orderBy(F.col(by).asc_nulls_last(), tie)
        return table.withColumn(out, shift(value).over(order))
    key_fields = {"n": F.col(by).isNull(), "v": F.col(by), "t": F.col(tie)}
    cuts = _cut_points(table, key_fields, rows, slices, carried={"value": F.col(value)})
    sliced = _with_slice(table, key_fields, cuts, cut_opens=step > 0)
    order = Window.partitionBy("_slice").orderBy(F.col(by).asc_nulls_last(), tie)
    inside = shift(F.struct(F.col(value).alias("value"))).over(order)
    beyond = F.get(cuts.carried, F.col("_slice") - 1 if step < 0 else F.col("_slice"))
    found = F.when(inside.isNotNull(), inside["value"]).otherwise(beyond["value"])
    return sliced.withColumn(out, found).drop("_slice")


def top_ranks(df: DataFrame, *, by: str, highest: int, out: str, lowest: int = 1,
              within: Sequence[str] = ()) -> DataFrame:
    """Rows whose descending ``rank()`` by ``by`` lies in ``lowest..highest``.

    Rows are first dealt into salted groups. A row can only stand among the
    first of all if it does so in its group, and that limit already applies
    before the shuffle. Of the rows left only distinct values are ranked, with
    how many rows share each, so a value shared by most of the table is one
    row. All tied rows come back.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(_partitions(df))))
    best = F.col(by).desc_nulls_last()
    near = salted.withColumn("_r", F.rank().over(Window.partitionBy(*within, "_salt").orderBy(best)))
    table = pin(near.filter(F.col("_r") <= highest).select(*df.columns))
    order = Window.partitionBy(*within).orderBy(best)
    counts = table.groupBy(*within, by).agg(F.count(F.lit(1)).alias("_rows"))
    leading = counts.withColumn("_pos", F.row_number().over(order)).filter(F.col("_pos") <= highest)
    earlier = F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1))
    standing = leading.withColumn(out, (F.coalesce(earlier, F.lit(0)) + 1).cast("int")).filter(
        F.col(out).between(lowest, highest)
    ).select(F.col(by).alias("_by"), *(F.col(w).alias(f"_w{i}") for i, w in enumerate(within)), out)
    if not within:
        standing = F.broadcast(standing)  # at most `highest` rows
    match = F.col(by).eqNullSafe(F.col("_by"))
    for i, w in enumerate(within):
        match = match & F.col(w).eqNullSafe(F.col(f"_w{i}"))
    return table.join(standing, match).select(*df.columns, out)
