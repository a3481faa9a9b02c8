"""Rolling statistics over a time range, per tick."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.scalars import epoch_second

SPAN = 3600  # seconds looked back, current second included


def rolling_seconds(ticks: DataFrame, span: int = SPAN) -> DataFrame:
    """Mean and sample deviation of the last ``span`` seconds, per symbol and second.

    The frame ends at the current second with all its ticks, so the answer
    depends on the second only. Ticks are first combined per second, before
    any shuffle. Time is cut into blocks as long as a frame: a frame is then
    the end of one block and the beginning of the next, whose sums run once
    over each block, backward and forward. So every second is added twice
    however long the frame, nothing is ever subtracted, and a busy symbol
    spreads over as many tasks as it has blocks.
    """
    seconds = ticks.filter(F.col("timestamp").isNotNull()).groupBy(
        "symbol", epoch_second("timestamp").alias("second")
    ).agg(
        F.count("price").alias("n"),
        F.avg("price").alias("mean"),
        (F.var_pop("price") * F.count("price")).alias("m2"),
    )
    block = F.floor(F.col("second") / (span + 1))
    # Each second also asks the block before what it holds from ``span`` seconds ago on.
    both = F.explode(F.array(F.struct(block.alias("block"), F.col("second").alias("at"), F.lit(False).alias("asks")),
                             F.struct((block - 1).alias("block"), (F.col("second") - span).alias("at"), F.lit(True).alias("asks"))))
    placed = seconds.withColumn("e", both).select(
        "symbol", "second", "e.*", *(F.when(~F.col("e.asks"), F.col(c)).alias(c) for c in ("n", "mean", "m2"))
    )
    whole = Window.partitionBy("symbol", "block")
    # Deviations from a nearby level keep the squares small.
    level = placed.withColumn("level", F.avg("mean").over(whole))
    gap = F.col("mean") - F.col("level")
    moments = level.withColumn("s", F.col("n") * gap).withColumn("q", F.col("m2") + F.col("n") * gap * gap)

    def sums(frame: Window, asks: bool) -> DataFrame:
        each = [F.sum(c).over(frame).alias(f"f{c}") for c in ("n", "s", "q")]
        side = moments.select("symbol", "second", "asks", "level", *each).filter(F.col("asks") == asks)
        mean = F.col("level") + F.col("fs") / F.col("fn")
        return side.filter((F.col("fn") > 0) | ~F.col("asks")).select(
            "symbol", "second", F.coalesce("fn", F.lit(0)).alias("n"), F.when(F.col("fn") > 0, mean).alias("mean"),
            F.greatest(F.col("fq") - F.col("fs") * F.col("fs") / F.col("fn"), F.lit(0.0)).alias("m2"),
        )

    forward, backward = whole.orderBy("at"), whole.orderBy(F.desc("at"))
    halves = sums(forward, asks=False).unionByName(sums(backward, asks=True))
    # At most two halves each, combined by the distance of their means.
    part = F.struct("mean", "n")
    joined = halves.groupBy("symbol", "second").agg(
        F.sum("n").alias("n"), F.sum("m2").alias("m2"), F.count("mean").alias("halves"),
        F.min(F.when(F.col("mean").isNotNull(), part)).alias("a"), F.max(F.when(F.col("mean").isNotNull(), part)).alias("b"),
    )
    apart = F.when(F.col("halves") > 1, F.col("b.mean") - F.col("a.mean")).otherwise(F.lit(0.0))
    spread = F.col("m2") + apart * apart * F.col("a.n") * F.col("b.n") / F.col("n")
    return joined.select(
        "symbol",
        "second",
        (F.col("a.mean") + apart * F.col("b.n") / F.col("n")).alias("rolling_avg"),
        F.when(F.col("n") > 1, F.sqrt(spread / (F.col("n") - 1))).alias("rolling_stddev"),
    )


def rolling_volatility(ticks: DataFrame, span: int = SPAN) -> DataFrame:
    """Every tick that has a time with the rolling mean, deviation and volatility in percent."""
    stats = rolling_seconds(ticks, span).withColumnsRenamed({"symbol": "_symbol", "second": "_second"})
    keyed = ticks.filter(F.col("timestamp").isNotNull()).withColumn("_at", epoch_second("timestamp"))
    joined = keyed.join(stats, keyed["symbol"].eqNullSafe(stats["_symbol"]) & (F.col("_at") == F.col("_second")))
    return joined.withColumn(
        "volatility_pct", F.try_divide(F.col("rolling_stddev"), F.col("rolling_avg")) * 100
    ).drop("_symbol", "_second", "_at")
