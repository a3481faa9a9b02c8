"""Rolling statistics inside the stream: a two-sided interval join, and keyed state with event-time timers.

Both give what ``plans.market.volatility`` gives for ticks whose second the
watermark has passed, over rows that come in any order, and drop what comes
behind the watermark. Neither reads a log again: what they remember is Spark's
own state, checkpointed with the query and bounded by the span.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemart.operators.rolling import SPAN
from tidemart.schemas import CONTRACTS

_RESULT = CONTRACTS["volatility_metrics"].schema


def _seconds(ticks: DataFrame) -> DataFrame:
    """Moments per symbol and second, with the second's ticks; ``at`` is the second as an event time."""
    grouped = ticks.groupBy("symbol", F.window("timestamp", "1 second")).agg(
        F.count("price").alias("n"), F.coalesce(F.avg("price"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop("price") * F.count("price"), F.lit(0.0)).alias("m2"),
        F.collect_list(F.struct("timestamp", "price")).alias("ticks"),
    )
    # A struct compares null symbols as equal, and is still a key to join by.
    return grouped.select(F.struct("symbol").alias("key"), F.window_time("window").alias("at"), "n", "mean", "m2", "ticks")


def _pieces(ticks: DataFrame, piece: int) -> DataFrame:
    """Moments per symbol and ``piece`` seconds, with those of its seconds; ``past_at`` is its end as an event time."""
    each = F.struct("at", "n", "mean", "m2")
    grouped = _seconds(ticks).groupBy("key", F.window("at", f"{piece} seconds")).agg(F.collect_list(each).alias("seconds"))
    # Two passes over at most ``piece`` rows: distances from the mean keep the squares small.
    n = F.aggregate("seconds", F.lit(0).cast("long"), lambda a, x: a + x.n)
    mean = F.aggregate("seconds", F.lit(0.0), lambda a, x: a + x.n * x.mean) / F.greatest("n", F.lit(1))
    m2 = F.aggregate("seconds", F.lit(0.0), lambda a, x: a + x.m2 + x.n * (x.mean - F.col("mean")) * (x.mean - F.col("mean")))
    return grouped.select(F.col("key").alias("past_key"), F.window_time("window").alias("past_at"), "seconds").withColumn(
        "n", n).withColumn("mean", mean).withColumn("m2", m2).select(
        "past_key", "past_at", "seconds", F.struct(F.col("past_at").alias("at"), "n", "mean", "m2").alias("whole"))


def joined_volatility(ticks: DataFrame, span: int = SPAN) -> DataFrame:
    """Each tick of a watermarked stream with the mean and deviation of its last ``span`` seconds, by a self-join.

    Ticks are combined per second first, and on the past side seconds into
    pieces of the root of the span: a second meets about that many pieces
    however many ticks there are. A piece inside the span counts by its sums, one
    at an edge by those of its seconds that are inside. Time is also cut into
    blocks as long as the span, and pieces stand under each block that looks
    back on them: so a row is compared with two blocks of its symbol, not with
    all of it, and a symbol's blocks spread over the tasks.

    The range of the join lets Spark drop a piece from the state once the
    watermark is a span beyond it. A second comes out, with all its ticks, when
    the watermark has passed it by a span: only then can no row of the join
    with this time follow.
    """
    piece = max(math.isqrt(span), 1)
    reach, rest = (F.make_dt_interval(secs=F.lit(s)) for s in (span, piece - 1))

    def block(seconds: Column) -> Column:
        return F.floor(seconds / (span + 1))

    own = _seconds(ticks).withColumn("block", block(F.unix_seconds("at")))
    end = F.unix_seconds("past_at")
    past = _pieces(ticks, piece).withColumn("past_block", F.explode(F.sequence(block(end - (piece - 1)), block(end + span))))
    pairs = own.join(
        past, (F.col("key") == F.col("past_key")) & (F.col("block") == F.col("past_block"))
        & (F.col("past_at") <= F.col("at") + rest) & (F.col("past_at") >= F.col("at") - reach)
    )
    first = F.col("past_at") - rest
    inside = F.filter("seconds", lambda x: (x.at <= F.col("at")) & (x.at >= F.col("at") - reach))
    counted = F.when((F.col("past_at") <= F.col("at")) & (first >= F.col("at") - reach), F.array("whole")).otherwise(inside)
    # Distances from the second's own mean keep the squares small.
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))

    def add(a: Column, x: Column) -> Column:
        gap = x.mean - F.col("mean")
        return F.struct((a.n + x.n).alias("n"), (a.s + x.n * gap).alias("s"), (a.q + x.m2 + x.n * gap * gap).alias("q"))

    # One of a second's pairs carries its ticks: that with the piece it lies in.
    mine = F.when((F.col("at") <= F.col("past_at")) & (F.col("at") >= first), F.col("ticks"))
    sums = pairs.select("key", "at", "mean", mine.alias("ticks"), F.aggregate(counted, zero, add).alias("p")).groupBy(
        "key", F.window("at", "1 second")
    ).agg(
        F.sum("p.n").alias("n"), F.sum("p.s").alias("s"), F.sum("p.q").alias("q"),
        F.max("mean").alias("mean"), F.any_value("ticks", True).alias("ticks"),
    )
    stats = sums.select(
        F.col("key.symbol").alias("symbol"), "ticks",
        F.when(F.col("n") > 0, F.col("mean") + F.col("s") / F.col("n")).alias("rolling_avg"),
        F.when(
            F.col("n") > 1,
            F.sqrt(F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0)) / (F.col("n") - 1)),
        ).alias("rolling_stddev"),
    )
    each = stats.select("symbol", F.explode("ticks").alias("t"), "rolling_avg", "rolling_stddev")
    percent = F.try_divide(F.col("rolling_stddev"), F.col("rolling_avg")) * 100
    return each.select("symbol", "t.timestamp", "t.price", "rolling_avg", "rolling_stddev", percent.alias("volatility_pct"))


def seconds_of(us: np.ndarray, price: np.ndarray) -> np.ndarray:
    """Ticks as rows (second, n, mean, m2), one per second in order; a missing price counts nothing."""
    second, place = np.unique(us // 1_000_000, return_inverse=True)
    real = ~np.isnan(price)
    n = np.bincount(place[real], minlength=len(second))
    mean = np.bincount(place[real], price[real], len(second)) / np.maximum(n, 1)
    m2 = np.bincount(place[real], (price - mean[place])[real] ** 2, len(second))
    return np.column_stack([second, n, mean, m2]).astype(float)


def rolled(rows: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of the last ``span`` seconds at each of the rows' seconds.

    A frame is the beginning of its block of ``span + 1`` seconds and the end
    of the block before. Sums run over each block once, forward and backward,
    about the block's own level, so nothing is subtracted from longer sums.
    """
    second, n, mean, m2 = rows.T
    _, first, place = np.unique(second // (span + 1), return_index=True, return_inverse=True)
    level = np.bincount(place, mean) / np.bincount(place)
    gap = mean - level[place]
    moments = np.column_stack([n, n * gap, m2 + n * gap * gap])
    forward, backward = np.empty_like(moments), np.empty_like(moments)
    for a, b in zip(first, [*first[1:], len(rows)], strict=True):
        forward[a:b] = np.cumsum(moments[a:b], axis=0)
        backward[a:b] = np.cumsum(moments[a:b][::-1], axis=0)[::-1]
    begin = np.searchsorted(second, second - span)
    before = np.where((begin < first[place])[:, None], backward[begin], 0.0)

    def part(sums: np.ndarray, about: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        count, s, q = sums.T
        some = np.maximum(count, 1)
        return count, about + s / some, np.maximum(q - s * s / some, 0.0)

    (n1, mean1, q1), (n2, mean2, q2) = part(forward, level[place]), part(before, level[place[begin]])
    count = n1 + n2
    apart = np.where((n1 > 0) & (n2 > 0), mean2 - mean1, 0.0)
    some = np.maximum(count, 1)
    middle = np.where(n1 > 0, mean1 + apart * n2 / some, mean2)
    spread = q1 + q2 + apart * apart * n1 * n2 / some
    deviation = np.sqrt(spread / np.maximum(count - 1, 1))
    return np.where(count > 0, middle, np.nan), np.where(count > 1, deviation, np.nan)


class ReleaseInOrder(StatefulProcessor):
    """Holds a symbol's ticks until the watermark passes their second, then gives them out in event-time order.

    State: the ticks not yet released, and a row per second of the last span.
    A timer stands at the end of the earliest second held; when it fires, all
    seconds that are complete are released together.
    """

    def __init__(self, span: int) -> None:
        self.span = span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "us BIGINT, price DOUBLE")
        self.past = handle.getValueState("past", "rows BINARY")
        self.timer = handle.getValueState("timer", "at BIGINT")

    def _wake(self, at: int, watermark: int) -> None:
        standing = self.timer.get()
        at = max(at, watermark + 1)
        if standing is not None and watermark < standing[0] <= at:
            return
        if standing is not None:
            self.handle.deleteTimer(standing[0])
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for some in rows:
            us = some["us"].to_numpy(np.int64)
            if len(us):
                self.held.appendList([(int(u), None if p != p else float(p)) for u, p in zip(us, some["price"], strict=True)])
                earliest = int(us.min()) if earliest is None else min(earliest, int(us.min()))
        if earliest is not None:
            self._wake((earliest // 1_000_000 + 1) * 1000, timerValues.getCurrentWatermarkInMs())
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        held = list(self.held.get())
        us = np.array([h[0] for h in held], np.int64)
        price = np.array([np.nan if h[1] is None else h[1] for h in held], float)
        due = (us // 1_000_000 + 1) * 1000 <= watermark
        if not due.all():
            rest = [h for h, out in zip(held, due, strict=True) if not out]
            self.held.put([tuple(h) for h in rest])
            self._wake((int(us[~due].min()) // 1_000_000 + 1) * 1000, watermark)
        else:
            self.held.clear()
        order = np.argsort(us[due], kind="stable")
        us, price = us[due][order], price[due][order]
        if not len(us):
            return
        stored = self.past.get()
        before = np.frombuffer(stored[0], float).reshape(-1, 4) if stored is not None else np.empty((0, 4))
        rows = np.concatenate([before, seconds_of(us, price)])
        average, deviation = rolled(rows, self.span)
        at = np.searchsorted(rows[:, 0], us // 1_000_000)
        self.past.update((rows[rows[:, 0] >= rows[-1, 0] - self.span].tobytes(),))
        yield pd.DataFrame({
            "symbol": pd.Series([key[0]] * len(us), dtype=object), "us": us, "price": price,
            "rolling_avg": average[at], "rolling_stddev": deviation[at],
        })

    def close(self) -> None:
        pass


def released_volatility(ticks: DataFrame, span: int = SPAN) -> DataFrame:
    """Each tick of a watermarked stream with the mean and deviation of its last ``span`` seconds, by keyed state.

    Ticks come out in event-time order per symbol, as soon as the watermark has
    passed their second. A symbol's state lives in one partition: a row for
    each of the last ``span`` seconds, and the ticks of the allowed lateness.
    """
    packed = ticks.select("symbol", F.unix_micros("timestamp").alias("us"), "price", "timestamp")
    out = packed.groupBy("symbol").transformWithStateInPandas(
        ReleaseInOrder(span), "symbol STRING, us BIGINT, price DOUBLE, rolling_avg DOUBLE, rolling_stddev DOUBLE", "Append", "EventTime"
    )

    def known(name: str):
        return F.when(~F.isnan(name), F.col(name)).alias(name)

    named = out.select("symbol", F.timestamp_micros("us").alias("timestamp"), known("price"), known("rolling_avg"), known("rolling_stddev"))
    percent = F.try_divide(F.col("rolling_stddev"), F.col("rolling_avg")) * 100
    return named.withColumn("volatility_pct", percent).select(*_RESULT.names)


