"""Tumbling-window aggregates (STR-1..4, AGG-4..9, PRJ-4, SRC-3).

Batch frames group by an integer bucket; streams group by ``window()`` so that the watermark can close
windows. Both give the same rows. Every aggregate here is partial before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import fixed_point, from_fixed_point, null_if_nan, tick_units, time_bucket
from tickloom.operators.latest import latest_value

SECOND_MS = 1_000


def _average(price: Column, digits: int | None) -> Column:
    """AGG-5. With ``digits`` the prices are summed as whole units, so row order cannot change the result."""
    if digits is None:
        return F.avg(price)
    return F.sum(tick_units(price, digits)) / (F.count(price) * F.lit(float(10**digits)))


def window_stats(
    prices: DataFrame,
    size_ms: int = SECOND_MS,
    *,
    delay: str | None = None,
    digits: int | None = None,
    with_last: bool = False,
) -> DataFrame:
    """STR-2: (symbol, count, avg_price, timestamp) per symbol and window, ``timestamp`` the window start.

    ``count`` counts rows without a price too; a NaN price is none. ``with_last`` adds the highest-offset price of the window.
    A stream needs ``event_time`` and the watermark ``delay`` (STR-7); its result keeps the ``window``
    column so that ``summary`` can be chained to it without another read (SRC-3).
    """
    prices = prices.where(F.col("symbol").isNotNull()).withColumn("price", null_if_nan(F.col("price")))
    aggregates = [F.count("*").alias("count"), _average(F.col("price"), digits).alias("avg_price")]
    if with_last:
        aggregates.append(latest_value("price").alias("last_price"))

    if prices.isStreaming:
        if delay is None:
            raise ValueError("a stream needs a watermark delay")
        stats = (
            prices.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", f"{size_ms} milliseconds"), "symbol")
            .agg(*aggregates)
            .withColumn("timestamp", F.unix_millis("window.start"))
        )
        tail = ["window"]
    else:
        clock = F.unix_millis("event_time") if "event_time" in prices.columns else F.col("timestamp")
        stats = prices.groupBy(time_bucket(clock, size_ms).alias("timestamp"), "symbol").agg(*aggregates)
        tail = []
    last = ["last_price"] if with_last else []
    return stats.select("symbol", "count", "avg_price", "timestamp", *last, *tail)


def summary(stats: DataFrame, size_ms: int = SECOND_MS, *, digits: int | None = None) -> DataFrame:
    """STR-3: (timestamp, total_price, symbols) per window over the symbols that traded in it.

    The input has one row per symbol and window, so the list is as long as the set of symbols in the
    window and has no repeats. It is sorted: arrival order is lost in any shuffle. With ``digits`` the
    averages are summed at that many decimal places, so row order cannot change the total.
    """
    total = F.sum("avg_price")
    if digits is not None:
        total = from_fixed_point(F.sum(fixed_point(F.col("avg_price"), digits)), digits)
    if stats.isStreaming:
        groups = [F.window(F.window_time("window"), f"{size_ms} milliseconds"), F.col("timestamp")]
    else:
        groups = [F.col("timestamp")]
    return (
        stats.groupBy(*groups)
        .agg(
            total.alias("total_price"),
            F.array_sort(F.collect_list("symbol")).alias("symbols"),
        )
        .select("timestamp", "total_price", "symbols")
    )
