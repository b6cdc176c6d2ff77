"""Late trades as deltas: the repaired tables equal those of all trades, and nothing else is rewritten."""

import random

import pytest

from tickloom.operators.completed import completed_total
from tickloom.operators.repair import applied, merged, parts_stats, read_totals, repair, settled_totals, window_parts
from tickloom.operators.windows import summary, window_stats

SIZE = 1000


def trades(seed, n):
    rng = random.Random(seed)
    rows, now = [], 50_000
    for offset in range(n):
        now += rng.choice([100, 400, 900, 5000])
        price = rng.choice([None, float("nan")]) if rng.random() < 0.15 else round(rng.uniform(1, 50), 2)
        rows.append((rng.choice(["a", "a", "a", "b", "c", "d", None]), price, now, offset))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "symbol string, price double, timestamp bigint, offset bigint")


def stored(df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def tables(spark, rows, folder, name):
    parts = stored(window_parts(frame(spark, rows), SIZE, 2), folder, f"{name}-parts")
    stats = parts_stats(parts, 2)
    return parts, stored(settled_totals(stats, completed_total(stats, SIZE, digits=6), 6), folder, f"{name}-totals")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def batch(spark, rows):
    stats = window_stats(frame(spark, rows), SIZE, digits=2, with_last=True)
    return stats, completed_total(stats, SIZE, digits=6)


STATS = ("symbol", "timestamp", "count", "avg_price", "last_price")


@pytest.mark.parametrize("seed, chunk", [(1, 4096), (2, 3), (3, 20)])
def test_repairs_equal_all_trades(spark, folder, seed, chunk):
    """Two repairs, one after the other: late trades in old windows, in windows without a trade, before all others, without a price."""
    rows = trades(seed, 160)
    rng = random.Random(seed)
    groups = [[], [], []]
    for r in rows:
        groups[rng.choice([0, 0, 0, 1, 2])].append(r)
    groups[1] += [("z", 5.0, 10_000, 1000), ("a", None, 20_000, 1001), ("q", None, 20_000, 1002)]
    groups[2] += [("a", 7.0, rows[3][2], -1), ("z", 6.0, 9_999_000, 1003)]
    parts, totals = tables(spark, groups[0], folder, "first")
    seen = list(groups[0])
    for k in (1, 2):
        found = repair(parts, totals, frame(spark, groups[k]), SIZE, price_digits=2, digits=6, chunk=chunk)
        old = {r[0]: r for r in got(totals, *totals.columns)}
        new = got(found.totals, *totals.columns)
        assert all(old.get(r[0]) != r for r in new), "a row is rewritten as it was"
        keys = {(r["symbol"], r["timestamp"]) for r in found.parts.collect()}
        assert keys == {(s, t - t % SIZE) for s, _, t, _ in groups[k] if s is not None}
        sums = applied(summary(parts_stats(parts, 2), SIZE, digits=6), found.summary, ["timestamp"])
        seen += groups[k]
        stats, total = batch(spark, seen)
        assert got(sums, "timestamp", "total_price", "symbols") == got(summary(stats, SIZE, digits=6), "timestamp", "total_price", "symbols")
        parts = stored(applied(parts, found.parts, ["symbol", "timestamp"]), folder, f"parts-{k}")
        totals = stored(applied(totals, found.totals, ["timestamp"]), folder, f"totals-{k}")
        assert got(parts_stats(parts, 2), *STATS) == got(stats, *STATS)
        assert got(read_totals(totals, 6), "timestamp", "total", "known") == got(total, "timestamp", "total", "known")


def test_only_windows_until_the_next_trade_are_rewritten(spark, folder):
    rows = [("a", 1.0, 1000 * k, k) for k in range(1, 20)] + [("b", 5.0, 2000, 100), ("b", 6.0, 9000, 101)]
    parts, totals = tables(spark, rows, folder, "t")
    found = repair(parts, totals, frame(spark, [("b", 8.0, 5500, 102)]), SIZE, price_digits=2, digits=6)
    assert [(r["timestamp"], r["units"], r["known"]) for r in found.totals.orderBy("timestamp").collect()] == [
        (t, 9_000_000, 2) for t in (5000, 6000, 7000, 8000)
    ]


def test_no_late_trades_change_nothing(spark, folder):
    parts, totals = tables(spark, trades(4, 30), folder, "t")
    found = repair(parts, totals, frame(spark, []), SIZE, price_digits=2, digits=6)
    assert found.parts.count() == found.summary.count() == found.totals.count() == 0
    found = repair(parts.limit(0), totals.limit(0), frame(spark, [("a", 2.0, 1500, 1)]), SIZE, price_digits=2, digits=6)
    assert got(read_totals(found.totals, 6), "timestamp", "total", "known") == [(1000, 2.0, 1)]


def test_parts_add_up(spark):
    rows = trades(5, 80)
    pieces = window_parts(frame(spark, rows[::2]), SIZE, 2).unionByName(window_parts(frame(spark, rows[1::2]), SIZE, 2))
    whole = window_parts(frame(spark, rows), SIZE, 2)
    assert got(merged(pieces), *whole.columns) == got(whole, *whole.columns)
