"""Completion in the order in which two topics arrive (JOIN-5, AGG-10, AGG-11).

A consumer reads latest prices and summaries as one sequence. It remembers the last price of each symbol, and
completes each summary with the prices, as known at that place, of the symbols that are not in it. The sum of all last
prices is a prefix sum of changes, so a summary needs only that sum and the last prices of its own symbols.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.functions import fixed_point, from_fixed_point, null_if_nan
from tickloom.operators.asof import CHUNK_ROWS, as_of

# Numbers of the sequence that one task accumulates.
SPAN = 1_000_000


def _bucket(span: int) -> Column:
    return F.expr(f"position div {span}L - if(position % {span}L < 0, 1, 0)")


def _changes(prices: DataFrame, digits: int, chunk: int | None, carry: DataFrame | None) -> DataFrame:
    """(position, change, new): what each price adds to the sum of all last prices, and whether its symbol is new."""
    # the price before a record is the one in force just before its place
    asked = prices.select("symbol", (F.col("position") - 1).alias("position"), F.col("position").alias("place"), "units")
    known = prices.select("symbol", "position", F.col("units").alias("before"))
    old = None if carry is None else carry.select("symbol", fixed_point(F.col("last_price"), digits).alias("before"))
    found = as_of(asked, known, "symbol", ["before"], order="position", chunk=chunk, carry=old)
    return found.select(
        F.col("place").alias("position"),
        (F.col("units") - F.coalesce("before", F.lit(0))).alias("change"),
        F.col("before").isNull().cast("bigint").alias("new"),
    )


def completed_in_order(
    prices: DataFrame,
    summaries: DataFrame,
    *,
    digits: int,
    span: int = SPAN,
    chunk: int | None = CHUNK_ROWS,
    carry: DataFrame | None = None,
    base: tuple[Column, Column] | None = None,
) -> DataFrame:
    """(position, timestamp, total, known) of each summary.

    ``prices`` has position, symbol and last_price; ``summaries`` position, timestamp, total_price and symbols (an array).
    ``position`` is the place in the sequence of both, unique (``sequence.consumed_sequence``). The total is total_price plus the
    last price before that place of every known symbol that the summary does not have; ``known`` counts the symbols known then and
    those of the summary. A symbol listed twice counts once; a price that is null or NaN, or without a symbol, tells nothing. Sums are of
    whole units of ``digits`` decimal places.

    Of a stream's earlier slices, ``carry`` has the last price of each symbol (those of this slice are enough), and ``base`` the sum
    of all last prices, in units, and the number of their symbols.
    """
    units = fixed_point(null_if_nan(F.col("last_price")), digits).alias("units")
    prices = prices.where("symbol IS NOT NULL AND position IS NOT NULL").select("position", "symbol", units).where("units IS NOT NULL")
    steps = _changes(prices, digits, chunk, carry)

    # the sum of all prices before each summary: inside spans of the sequence, and one row per span
    asked = summaries.where("position IS NOT NULL").select("position", F.lit(True).alias("asked"))
    laid = steps.unionByName(asked, allowMissingColumns=True).withColumn("span", _bucket(span))
    so_far = W.partitionBy("span").orderBy("position").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = laid.select(
        "position", "span", "asked",
        F.coalesce(F.sum("change").over(so_far), F.lit(0)).alias("change"), F.coalesce(F.sum("new").over(so_far), F.lit(0)).alias("new"),
    ).where("asked")
    spans = laid.groupBy("span").agg(F.sum("change").alias("change"), F.sum("new").alias("new"))
    earlier = W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.select(
        "span", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("all_before"), F.coalesce(F.sum("new").over(earlier), F.lit(0)).alias("known_before")
    )
    sums = running.join(spans, "span", "left").select(
        "position", (F.col("change") + F.col("all_before")).alias("all"), (F.col("new") + F.col("known_before")).alias("known")
    )

    # the last prices of a summary's own symbols
    own = summaries.where("position IS NOT NULL").select("position", F.explode(F.array_distinct("symbols")).alias("symbol"))
    old = None if carry is None else carry.select("symbol", fixed_point(F.col("last_price"), digits).alias("units"))
    own = as_of(own, prices, "symbol", ["units"], order="position", chunk=chunk, carry=old)
    own = own.where("symbol IS NOT NULL").groupBy("position").agg(
        F.coalesce(F.sum("units"), F.lit(0)).alias("own"), F.count("units").alias("own_known"), F.count("*").alias("listed")
    )
    found = summaries.select("position", "timestamp", "total_price").join(sums, "position").join(own, "position", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    everything, known = F.col("all") - zero("own"), F.col("known") - zero("own_known") + zero("listed")
    if base is not None:
        everything, known = everything + base[0], known + base[1]
    total = fixed_point(F.coalesce(null_if_nan(F.col("total_price")), F.lit(0.0)), digits) + everything
    return found.select("position", "timestamp", from_fixed_point(total, digits).alias("total"), known.cast("bigint").alias("known"))
