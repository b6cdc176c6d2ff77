"""Late trades applied as deltas to window statistics, summaries and completed totals (STR-7, STR-2, STR-3, CMP-1).

Trades that come after their window has closed go to a side table. What they change is found from the windows they touch and their
symbols' neighbouring windows alone:

- the statistics of a touched window are kept as parts that add up (``window_parts``), so old and late parts merge;
- a symbol's contribution to the completed total is a step function; only the steps of a touched window, and the step into the symbol's
  next window, differ. Their differences, summed per time, are the delta;
- the running sum of the deltas is what each later total changes by. It goes back to zero where the symbols have traded again, so
  the totals that are rewritten are those between.

All amounts are whole units of ``digits`` decimal places, as in ``completed.completed_total``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.functions import fixed_point, from_fixed_point, null_if_nan, tick_units, time_bucket
from tickloom.operators.asof import as_of
from tickloom.operators.completed import CHUNK


def window_parts(prices: DataFrame, size_ms: int, price_digits: int) -> DataFrame:
    """(symbol, timestamp, count, priced, units, last) per symbol and window: parts that ``merged`` adds up. last is the place and price
    of the highest offset with a price."""
    prices = prices.where("symbol IS NOT NULL AND timestamp IS NOT NULL").withColumn("price", null_if_nan(F.col("price")))
    last = F.when(F.col("price").isNotNull(), F.struct("offset", "price"))
    return prices.groupBy("symbol", time_bucket(F.col("timestamp"), size_ms).alias("timestamp")).agg(
        F.count("*").alias("count"), F.count("price").alias("priced"),
        F.coalesce(F.sum(tick_units(F.col("price"), price_digits)), F.lit(0)).cast("bigint").alias("units"), F.max(last).alias("last"),
    )


def merged(parts: DataFrame) -> DataFrame:
    """One row per symbol and window of several parts."""
    return parts.groupBy("symbol", "timestamp").agg(
        F.sum("count").alias("count"), F.sum("priced").alias("priced"), F.sum("units").alias("units"), F.max("last").alias("last")
    )


def parts_stats(parts: DataFrame, price_digits: int) -> DataFrame:
    """(symbol, count, avg_price, timestamp, last_price) as ``windows.window_stats`` gives them."""
    average = F.col("units") / (F.col("priced") * F.lit(float(10**price_digits)))
    return parts.select("symbol", "count", F.when(F.col("priced") > 0, average).alias("avg_price"), "timestamp", F.col("last.price").alias("last_price"))


@dataclass(frozen=True)
class Repair:
    """What late trades change. ``parts`` replace those of the same symbol and window; ``summary`` and ``totals`` those of the same window."""

    parts: DataFrame
    summary: DataFrame
    totals: DataFrame


def settled_totals(stats: DataFrame, totals: DataFrame, digits: int) -> DataFrame:
    """``totals`` (timestamp, total, known) as ``repair`` keeps them: (timestamp, units, known, settled). settled is the sum of all last
    prices after the window: the total with its averages replaced by its last prices."""
    priced = stats.where("avg_price IS NOT NULL AND NOT isnan(avg_price)")
    falls = priced.groupBy("timestamp").agg(F.sum(_units("last_price", digits) - _units("avg_price", digits)).alias("fall"))
    rows = totals.select("timestamp", _units("total", digits).alias("units"), "known").join(falls, "timestamp", "left")
    return rows.select("timestamp", "units", "known", (F.col("units") + F.coalesce("fall", F.lit(0))).alias("settled"))


def _units(price: str, digits: int) -> Column:
    return fixed_point(F.col(price), digits)


def read_totals(kept: DataFrame, digits: int) -> DataFrame:
    """(timestamp, total, known) of the table that ``settled_totals`` and ``repair`` keep."""
    return kept.select("timestamp", from_fixed_point(F.col("units"), digits).alias("total"), "known")


def repair(parts: DataFrame, totals: DataFrame, late: DataFrame, size_ms: int, *, price_digits: int, digits: int, chunk: int = CHUNK) -> Repair:
    """The rows of the three tables that the trades of ``late`` change.

    ``parts`` is the table of ``window_parts``, ``totals`` that of ``settled_totals``; ``late`` has the columns of trades. A late
    trade without a price adds to its window's count only. summary is (timestamp, total_price, symbols) of the touched windows.
    """
    new = window_parts(late, size_ms, price_digits)
    touched = new.select("symbol", "timestamp")
    spread = time_bucket(F.col("timestamp"), size_ms * chunk)
    old = parts.join(touched.select("symbol").distinct(), "symbol", "left_semi")
    both = old.withColumn("late", F.lit(False)).unionByName(new.withColumn("late", F.lit(True)))
    rows = both.groupBy("symbol", "timestamp").agg(
        F.sum("count").alias("count"), F.sum("priced").alias("priced"), F.sum("units").alias("units"), F.max("last").alias("last"),
        F.max("late").alias("late"),
        F.sum(F.when(~F.col("late"), F.col("priced"))).alias("old_priced"), F.sum(F.when(~F.col("late"), F.col("units"))).alias("old_units"),
        F.max(F.when(~F.col("late"), F.col("last"))).alias("old_last"),
    )
    changed = rows.where("late").select("symbol", "timestamp", "count", "priced", "units", "last")

    deltas = _deltas(rows.withColumn("chunk", spread), size_ms, price_digits, digits)
    windows = touched.select("timestamp").distinct()
    whole = parts.join(windows, "timestamp", "left_semi").join(changed.select("symbol", "timestamp"), ["symbol", "timestamp"], "left_anti")
    current = parts_stats(whole.unionByName(changed), price_digits)
    summary = current.groupBy("timestamp").agg(
        from_fixed_point(F.sum(_units("avg_price", digits)), digits).alias("total_price"), F.array_sort(F.collect_list("symbol")).alias("symbols")
    )
    traded = changed.where("priced > 0").select("timestamp").distinct()
    return Repair(changed, summary, _repaired(totals, deltas, traded, size_ms, chunk))


def _deltas(rows: DataFrame, size_ms: int, price_digits: int, digits: int) -> DataFrame:
    """(timestamp, change, fall, new): by how much the steps of the total differ at each time; fall is the part of them by which windows that end
    then fall back to last prices, new the difference of known symbols."""
    average = lambda units, priced: fixed_point(F.col(units) / (F.col(priced) * F.lit(float(10**price_digits))), digits)
    now = F.when(F.col("priced") > 0, F.struct(average("units", "priced").alias("avg"), _units("last.price", digits).alias("last")))
    was = F.when(F.col("old_priced") > 0, F.struct(average("old_units", "old_priced").alias("avg"), _units("old_last.price", digits).alias("last")))
    rows = rows.select("symbol", "timestamp", "chunk", "late", now.alias("now"), was.alias("was")).where("now IS NOT NULL")
    # the last price before a window, as it is and as it was, and whether the window before is touched: inside a chunk, then across
    state = F.struct(F.col("now.last").alias("now"), F.col("late").alias("late"))
    before = W.partitionBy("symbol", "chunk").orderBy("timestamp").rowsBetween(W.unboundedPreceding, -1)
    inside = rows.select(
        "*", F.last(state).over(before).alias("prior"), F.last("was.last", ignorenulls=True).over(before).alias("old"),
    )
    tails = rows.groupBy("symbol", "chunk").agg(
        F.max_by(state, "timestamp").alias("prior"), F.max_by("was.last", F.when(F.col("was").isNotNull(), F.col("timestamp"))).alias("old"),
    )
    earlier = W.partitionBy("symbol").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    tails = tails.select(
        "symbol", "chunk", F.last("prior").over(earlier).alias("far_prior"), F.last("old", ignorenulls=True).over(earlier).alias("far_old")
    )
    rows = inside.join(tails, ["symbol", "chunk"]).select(
        "timestamp", "late", "now", "was", F.coalesce("prior", "far_prior").alias("prior"), F.coalesce("old", "far_old").alias("old")
    )
    rows = rows.where(F.col("late") | F.coalesce("prior.late", F.lit(False)) | F.coalesce(F.col("prior.now") != F.col("old"), F.col("prior").isNotNull()))
    zero = lambda c: F.coalesce(c, F.lit(0))
    rise = (F.col("now.avg") - zero(F.col("prior.now"))) - F.when(F.col("was").isNotNull(), F.col("was.avg") - zero(F.col("old"))).otherwise(0)
    fall = (F.col("now.last") - F.col("now.avg")) - F.when(F.col("was").isNotNull(), F.col("was.last") - F.col("was.avg")).otherwise(0)
    fresh = F.col("prior").isNull().cast("bigint") - (F.col("was").isNotNull() & F.col("old").isNull()).cast("bigint")
    none = F.lit(0)
    steps = F.array(
        F.struct(F.col("timestamp"), rise.alias("change"), none.alias("fall"), fresh.alias("new")),
        F.struct((F.col("timestamp") + F.lit(size_ms)).alias("timestamp"), fall.alias("change"), fall.alias("fall"), none.cast("bigint").alias("new")),
    )
    found = rows.select(F.inline(steps)).groupBy("timestamp").agg(F.sum("change").alias("change"), F.sum("fall").alias("fall"), F.sum("new").alias("new"))
    return found.where("change <> 0 OR fall <> 0 OR new <> 0")


def _repaired(totals: DataFrame, deltas: DataFrame, traded: DataFrame, size_ms: int, chunk: int) -> DataFrame:
    """(timestamp, units, known, settled) of the windows whose totals change, and of windows that had no trade before."""
    # the running sum of the deltas, two-level, at each window and each end of one
    at = totals.select("timestamp").unionByName(traded).distinct()
    asked = at.select("timestamp", F.lit(True).alias("asked"))
    laid = deltas.unionByName(asked, allowMissingColumns=True).withColumn("chunk", time_bucket(F.col("timestamp"), size_ms * chunk))
    so_far = W.partitionBy("chunk").orderBy("timestamp").rangeBetween(W.unboundedPreceding, W.currentRow)
    inside = laid.select(
        "timestamp", "chunk", "asked", F.coalesce(F.sum("change").over(so_far), F.lit(0)).alias("sum"), F.coalesce(F.sum("new").over(so_far), F.lit(0)).alias("new")
    ).where("asked")
    chunks = laid.groupBy("chunk").agg(F.sum("change").alias("change"), F.sum("new").alias("new"))
    earlier = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = chunks.select(
        "chunk", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("base"), F.coalesce(F.sum("new").over(earlier), F.lit(0)).alias("base_new")
    )
    moved = inside.join(chunks, "chunk").select("timestamp", (F.col("sum") + F.col("base")).alias("moved"), (F.col("new") + F.col("base_new")).alias("more"))
    falls = deltas.select((F.col("timestamp") - F.lit(size_ms)).alias("timestamp"), F.col("fall").alias("falls"))
    moved = moved.join(falls, "timestamp", "left").withColumn("falls", F.coalesce("falls", F.lit(0)))

    # a window that had no row takes the sum of last prices of the row before it
    one = F.lit(0).alias("_all")
    missing = traded.join(totals.select("timestamp"), "timestamp", "left_anti").select("timestamp", one)
    before = totals.select("timestamp", one, "settled", "known")
    found = as_of(missing, before, "_all", ["settled", "known"], order="timestamp", chunk=size_ms * chunk)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    new = found.select("timestamp", zero("settled").alias("units"), zero("known").alias("known"), zero("settled").alias("settled"))
    rows = totals.withColumn("fresh", F.lit(False)).unionByName(new.withColumn("fresh", F.lit(True))).join(moved, "timestamp")
    rows = rows.where("fresh OR moved <> 0 OR more <> 0 OR falls <> 0")
    return rows.select(
        "timestamp", (F.col("units") + F.col("moved")).alias("units"), (F.col("known") + F.col("more")).alias("known"),
        (F.col("settled") + F.col("moved") + F.col("falls")).alias("settled"),
    )


def applied(table: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` with the rows of ``changed`` instead of those of the same keys."""
    return table.join(changed.select(*keys), keys, "left_anti").unionByName(changed.select(*table.columns))
