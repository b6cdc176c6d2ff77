"""Completed total (CMP-1, AGG-10, JOIN-5): per window, the averages of the symbols that traded plus the
last known price of every other symbol seen so far.

The total is a step function, so it is computed from its steps and not from a windows x symbols grid.
A symbol with average ``a`` and last price ``l`` in window ``w`` adds ``a - p`` at ``w``, ``p`` being its
last price before (0 for a new symbol), and ``l - a`` one window later, when it falls back to ``l``.
Steps are summed per window and accumulated over time.

Neither the look-back nor the accumulation puts one symbol, or all windows, into one task: both run inside
chunks of ``chunk`` windows, and only one row per chunk (and symbol) crosses chunk borders. Everything is
computed once: the two uses of the rows, and of the sums per window, share their shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.functions import fixed_point, from_fixed_point, time_bucket

# A window function keeps a group of up to 4096 rows in memory; larger ones go through a spillable sorter.
CHUNK = 4_096


def _step(at: Column, change: Column, *, new: Column | None = None, traded: int = 0) -> Column:
    """One change of the total; ``new`` is 1 where its symbol becomes known."""
    return F.struct(
        at.alias("at"),
        change.alias("change"),
        (F.lit(0) if new is None else new).cast("bigint").alias("new"),
        F.lit(traded).cast("bigint").alias("traded"),
    )


def _inline(df: DataFrame, *steps: Column) -> DataFrame:
    """One row per step that is not null."""
    rows = df.select(F.inline(F.array(*steps))).where("at IS NOT NULL")
    return rows.withColumnRenamed("at", "timestamp")


def _fall_back(row: str, size_ms: int) -> Column:
    """The step from the average of a window to its last price, one window later, if they differ."""
    change = F.col(f"{row}.last") - F.col(f"{row}.avg")
    return F.when(change != 0, _step(F.col(f"{row}.timestamp") + F.lit(size_ms), change))


def _heads(rows: DataFrame, carry: DataFrame | None) -> DataFrame:
    """Per symbol and chunk: its first window, its last row, and the symbol's price before the chunk."""
    heads = (
        rows.groupBy("symbol", "chunk")
        .agg(
            F.min("timestamp").alias("head"),
            F.max("timestamp").alias("timestamp"),
            F.max_by("avg", "timestamp").alias("avg"),
            F.max_by("last", "timestamp").alias("last"),
        )
        .select("symbol", "head", "last", F.struct("timestamp", "avg", "last").alias("tail"))
    )
    if carry is not None:
        carried = carry.select("symbol", F.col("timestamp").alias("head"), "last")
        heads = heads.unionByName(carried, allowMissingColumns=True)
    return heads.withColumn("before", F.lag("last").over(W.partitionBy("symbol").orderBy("head")))


def _steps(rows: DataFrame, heads: DataFrame, size_ms: int) -> DataFrame:
    """All steps: those inside chunks, and those that need the neighbouring chunk."""
    before = F.lag(F.struct("timestamp", "avg", "last")).over(W.partitionBy("symbol", "chunk").orderBy("timestamp"))
    inside = _inline(
        rows.withColumn("before", before),
        _step(F.col("timestamp"), F.col("avg") - F.coalesce(F.col("before.last"), F.lit(0)), traded=1),
        _fall_back("before", size_ms),
    )
    # A chunk's first row took its symbol for a new one, so its price before the chunk is taken off here. A
    # carried price has no row of its own and enters here.
    new = F.col("before").isNull()
    own = F.when(F.col("tail").isNull(), F.col("last")).otherwise(F.lit(0))
    change = own - F.coalesce(F.col("before"), F.lit(0))
    first = _inline(heads, _step(F.col("head"), change, new=new.cast("int")), _fall_back("tail", size_ms))
    return inside.unionAll(first)


def _first_seen(heads: DataFrame) -> DataFrame:
    """Per window, the symbols that become known in it."""
    new = heads.where("before IS NULL")
    return new.groupBy(F.col("head").alias("timestamp")).agg(F.collect_list("symbol").alias("seen"))


def _accumulate(
    steps: DataFrame, span_ms: int, digits: int, first_seen: DataFrame | None, others: tuple[Column, Column] | None
) -> DataFrame:
    """Running totals over windows, two-level: inside a chunk, plus what all earlier chunks add up to.

    A list of known symbols is accumulated in the same way; each symbol enters it once.
    """
    symbols = first_seen is not None
    sums = [F.sum(name).alias(name) for name in ("change", "new", "traded")]
    per_window = steps.groupBy("timestamp").agg(*sums).where("change <> 0 OR new <> 0 OR traded > 0")
    if symbols:
        per_window = per_window.join(first_seen, "timestamp", "left")
    per_window = per_window.withColumn("chunk", time_bucket(F.col("timestamp"), span_ms))

    so_far = W.partitionBy("chunk").orderBy("timestamp").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = {"total": F.sum("change").over(so_far), "known": F.sum("new").over(so_far)}
    if symbols:
        running["recent"] = F.flatten(F.collect_list("seen").over(so_far))
    windows = per_window.withColumns(running).where("traded > 0")

    # One row per chunk: as many as the time range has chunks, which fits one task.
    per_chunk = per_window.groupBy("chunk").agg(
        *sums[:2], *([F.flatten(F.collect_list("seen")).alias("seen")] if symbols else [])
    )
    earlier = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    base = per_chunk.select(
        "chunk",
        F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("base_total"),
        F.coalesce(F.sum("new").over(earlier), F.lit(0)).alias("base_known"),
        *([F.flatten(F.collect_list("seen").over(earlier)).alias("older")] if symbols else []),
    )
    # A left join: an inner one would add a filter to one use of per_window, and its shuffle would no
    # longer be shared.
    total, known = F.col("total") + F.col("base_total"), F.col("known") + F.col("base_known")
    if others is not None:
        total, known = total + others[0], known + others[1]
    return windows.join(base, "chunk", "left").select(
        "timestamp",
        from_fixed_point(total, digits).alias("total"),
        known.cast("bigint").alias("known"),
        *([F.array_sort(F.concat("older", "recent")).alias("all_symbols")] if symbols else []),
    )


def completed_total(
    stats: DataFrame,
    size_ms: int,
    *,
    digits: int = 18,
    chunk: int = CHUNK,
    carry: DataFrame | None = None,
    others: tuple[Column, Column] | None = None,
    symbols: bool = False,
) -> DataFrame:
    """(timestamp, total, known) for every window with trades; ``symbols`` adds ``all_symbols``.

    The list repeats all symbols in every window and is put together in one task: it is for a few hundred
    symbols. ``known_since`` and ``missing_intervals`` hold the same in one row per symbol or gap.

    ``stats`` has one row per symbol and window with ``avg_price`` and ``last_price``, both null (or NaN) when
    none of its trades had a price; such a row counts as no trade. Event time decides between windows, the
    offset decides inside one. Sums are exact at ``digits`` decimal places; up to 9 they run on integers.
    ``carry`` holds (symbol, timestamp, last_price) known from earlier windows, all before the first one in
    ``stats``. Symbols that do not occur in ``stats`` may be left out of it if ``others`` gives the sum of their
    last prices (as ``fixed_point``) and their number.
    """
    span_ms = size_ms * chunk
    rows = (
        _traded(stats)
        .select(
            "symbol",
            "timestamp",
            fixed_point(F.col("avg_price"), digits).alias("avg"),
            fixed_point(F.col("last_price"), digits).alias("last"),
            time_bucket(F.col("timestamp"), span_ms).alias("chunk"),
        )
        # One shuffle for both the look-back and the heads.
        .repartition("symbol", "chunk")
    )
    if carry is not None:
        carry = carry.select("symbol", "timestamp", fixed_point(F.col("last_price"), digits).alias("last"))
    heads = _heads(rows, carry)
    first_seen = _first_seen(heads) if symbols else None
    return _accumulate(_steps(rows, heads, size_ms), span_ms, digits, first_seen, others)


def known_since(stats: DataFrame) -> DataFrame:
    """DST-2: (symbol, known_since), the first window of every symbol with a price: one row per symbol.

    The symbols known in a window are those with ``known_since`` at or before it, so no window needs a list.
    """
    return _traded(stats).groupBy("symbol").agg(F.min("timestamp").alias("known_since"))


def missing_intervals(stats: DataFrame, size_ms: int, *, chunk: int = CHUNK) -> DataFrame:
    """SET-2: (symbol, missing_from, missing_until): the times in which a known symbol did not trade.

    One row per gap between two windows of a symbol, and one after its last window, with no end. A symbol is missing
    in the windows that start in [missing_from, missing_until). Inside a chunk of windows the next window is
    looked up directly; only one row per symbol and chunk crosses chunk borders.
    """
    rows = _traded(stats).select("symbol", "timestamp", time_bucket(F.col("timestamp"), size_ms * chunk).alias("chunk"))
    rows = rows.repartition("symbol", "chunk")
    after = F.lead("timestamp").over(W.partitionBy("symbol", "chunk").orderBy("timestamp"))
    inside = rows.select("symbol", "timestamp", after.alias("next")).where("next IS NOT NULL")
    ends = rows.groupBy("symbol", "chunk").agg(F.min("timestamp").alias("head"), F.max("timestamp").alias("timestamp"))
    across = ends.select("symbol", "timestamp", F.lead("head").over(W.partitionBy("symbol").orderBy("head")).alias("next"))
    start = F.col("timestamp") + F.lit(size_ms)
    gaps = inside.unionAll(across).where((F.col("next") > start) | F.col("next").isNull())
    return gaps.select("symbol", start.alias("missing_from"), F.col("next").alias("missing_until"))


def _traded(stats: DataFrame) -> DataFrame:
    return stats.where("avg_price IS NOT NULL AND NOT isnan(avg_price)")


def last_prices(stats: DataFrame) -> DataFrame:
    """(symbol, timestamp, last_price) after the windows in ``stats``: the carry for what follows."""
    return stats.where("last_price IS NOT NULL AND NOT isnan(last_price)").groupBy("symbol").agg(
        F.max_by("last_price", "timestamp").alias("last_price"), F.max("timestamp").alias("timestamp")
    )
