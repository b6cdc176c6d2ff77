import random

import pytest
from pyspark.sql import functions as F

from tests.brute import completed
from tickloom.operators.completed import completed_total, known_since, last_prices, missing_intervals
from tickloom.operators.latest import company_symbols, latest_by_offset, latest_prices
from tickloom.operators.windows import summary, window_stats
from tickloom.plans.market import backfill

TRADES = "symbol string, price double, timestamp bigint, offset bigint"
SMALL = [("a", 10.0, 100, 1), ("a", 12.0, 900, 2), ("b", 5.0, 500, 3), ("a", 14.0, 1200, 4)]


def frame(spark, rows):
    return spark.createDataFrame(rows, TRADES)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def totals_of(df, listed=True):
    return sorted((r["timestamp"], round(r["total"], 6), r["all_symbols"] if listed else r["known"]) for r in df.collect())


def test_latest_skips_nulls_and_ignores_event_time(spark):
    rows = [("a", 1.0, 500, 1), ("a", None, 100, 2), ("b", None, 7, 1), (None, 9.0, 1, 3), ("c", 1.0, 900, 1), ("c", 2.0, 800, 2)]
    latest = latest_prices(frame(spark, rows))
    assert rows_of(latest, "symbol", "last_price", "timestamp") == [("a", 1.0, 100), ("b", 0.0, 7), ("c", 2.0, 800)]


def test_latest_by_several_keys(spark):
    rows = spark.createDataFrame([("a", 1, 5, 1), ("a", 1, 6, 2), ("a", 2, 7, 3), (None, 2, 8, 4)], "s string, k int, v int, offset bigint")
    latest = latest_by_offset(rows, ["s", "k"], {"v": "newest"})
    assert rows_of(latest, "s", "k", "newest") == [("a", 1, 6), ("a", 2, 7)]


def test_company_symbols(spark):
    rows = spark.createDataFrame([("a", 5, 1), ("a", 3, 2), ("b", 1, 3), (None, 9, 4)], "symbol string, timestamp bigint, offset bigint")
    assert rows_of(company_symbols(rows), "symbol", "timestamp") == [("a", 3), ("b", 1)]


def test_window_stats(spark):
    stats = window_stats(frame(spark, SMALL))
    expected = [("a", 1, 14.0, 1000), ("a", 2, 11.0, 0), ("b", 1, 5.0, 0)]
    assert rows_of(stats, "symbol", "count", "avg_price", "timestamp") == expected


def test_window_edges_nulls_and_times_before_the_epoch(spark):
    rows = [("a", 1.0, 999, 1), ("a", 2.0, 1000, 2), ("a", None, 1001, 3), (None, 5.0, 0, 4), ("a", 3.0, -1, 5), ("n", None, 5, 6)]
    stats = window_stats(frame(spark, rows))
    expected = [("a", 1, 1.0, 0), ("a", 1, 3.0, -1000), ("a", 2, 2.0, 1000), ("n", 1, None, 0)]
    assert rows_of(stats, "symbol", "count", "avg_price", "timestamp") == sorted(expected, key=str)


def test_exact_average_does_not_depend_on_order(spark):
    prices = [0.1, 0.2, 0.3, 1e9, 0.7, 123456.78]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(prices)
        rows = frame(spark, [("a", p, 0, i) for i, p in enumerate(prices)]).repartition(3)
        results.add(window_stats(rows, digits=2).first()["avg_price"])
    assert len(results) == 1
    assert results.pop() == pytest.approx(sum(prices) / len(prices))


def test_arrival_time_windows(spark):
    rows = frame(spark, SMALL).withColumn("event_time", F.timestamp_millis(F.lit(5500)))
    assert rows_of(window_stats(rows), "symbol", "count", "timestamp") == [("a", 3, 5000), ("b", 1, 5000)]


def test_summary(spark):
    totals = summary(window_stats(frame(spark, SMALL)))
    assert rows_of(totals, "timestamp", "total_price", "symbols") == [(0, 16.0, ["a", "b"]), (1000, 14.0, ["a"])]


def test_completed_total(spark):
    stats = window_stats(frame(spark, SMALL), with_last=True)
    assert totals_of(completed_total(stats, 1000, symbols=True)) == [(0, 16.0, ["a", "b"]), (1000, 19.0, ["a", "b"])]


def test_completed_total_out_of_order(spark):
    rows = frame(spark, [("a", 14.0, 1200, 1), ("a", 10.0, 100, 2), ("b", 5.0, 2500, 3)])
    stats = window_stats(rows, with_last=True)
    assert totals_of(completed_total(stats, 1000, symbols=True)) == [(0, 10.0, ["a"]), (1000, 14.0, ["a"]), (2000, 19.0, ["a", "b"])]
    assert latest_prices(rows).where("symbol = 'a'").first()["last_price"] == 10.0


def test_windows_without_a_price_are_no_trades(spark):
    rows = frame(spark, [("a", 2.0, 0, 1), ("a", None, 1500, 2), ("b", 1.0, 2500, 3)])
    stats = window_stats(rows, with_last=True)
    assert totals_of(completed_total(stats, 1000, symbols=True)) == [(0, 2.0, ["a"]), (2000, 3.0, ["a", "b"])]


def random_trades(seed, n=120, symbols="abcde", span=60_000):
    rng = random.Random(seed)
    rows = []
    for offset in range(n):
        price = None if rng.random() < 0.1 else round(rng.uniform(0.01, 50), 2)
        # A third of the rows belong to one symbol, and many share a window.
        symbol = "a" if rng.random() < 0.33 else rng.choice(symbols)
        rows.append((symbol, price, rng.randrange(-span // 4, span), offset))
    return rows


@pytest.mark.parametrize("seed, chunk", [(1, 1), (2, 2), (3, 3), (4, 7), (5, 86_400)])
def test_completed_total_against_brute_force(spark, seed, chunk):
    trades = random_trades(seed)
    stats = window_stats(frame(spark, trades), with_last=True)
    expected = completed(trades, 1000)
    assert totals_of(completed_total(stats, 1000, chunk=chunk, symbols=True)) == expected
    counted = [(w, t, len(s)) for w, t, s in expected]
    assert totals_of(completed_total(stats, 1000, chunk=chunk), listed=False) == counted


@pytest.mark.parametrize("chunk", [2, 86_400])
def test_completed_total_continues_from_a_carry(spark, chunk):
    trades = random_trades(11)
    stats = window_stats(frame(spark, trades), with_last=True).cache()
    cut = 20_000
    before, after = stats.where(f"timestamp < {cut}"), stats.where(f"timestamp >= {cut}")
    first = completed_total(before, 1000, chunk=chunk, symbols=True)
    second = completed_total(after, 1000, chunk=chunk, carry=last_prices(before), symbols=True)
    assert totals_of(first) + totals_of(second) == completed(trades, 1000)
    stats.unpersist()


def test_backfill_composes_the_chain(spark):
    prices = frame(spark, SMALL)
    market = backfill(prices, prices.select("symbol", "timestamp", "offset"), list_symbols=True)
    assert rows_of(market.company_symbols, "symbol", "timestamp") == [("a", 1200), ("b", 500)]
    assert rows_of(market.latest_prices, "symbol", "last_price") == [("a", 14.0), ("b", 5.0)]
    assert market.window_stats.count() == 3
    assert rows_of(market.summary, "timestamp", "total_price") == [(0, 16.0), (1000, 14.0)]
    assert totals_of(market.completed_total) == [(0, 16.0, ["a", "b"]), (1000, 19.0, ["a", "b"])]


NAN = float("nan")
UNPRICED = [("a", 10.0, 0, 1), ("b", 5.0, 10, 2), ("b", NAN, 1000, 3), ("a", 10.0, 2000, 4), ("b", 7.0, 3000, 5), ("a", 10.0, 4000, 6)]


@pytest.mark.parametrize("digits", [2, 6, 9, 18])
def test_nan_is_no_price(spark, digits):
    market = backfill(frame(spark, UNPRICED), frame(spark, UNPRICED).select("symbol", "timestamp", "offset"), total_digits=digits)
    totals = sorted((r["timestamp"], r["total"]) for r in market.completed_total.collect())
    assert totals == [(0, 15.0), (2000, 15.0), (3000, 17.0), (4000, 17.0)]
    assert rows_of(market.latest_prices, "symbol", "last_price") == [("a", 10.0), ("b", 7.0)]
    exact = window_stats(frame(spark, UNPRICED), digits=digits if digits <= 9 else None)
    assert ("b", 1, None, 1000) in rows_of(exact, "symbol", "count", "avg_price", "timestamp")


@pytest.mark.parametrize("digits", [9, 18])
def test_a_price_that_does_not_fit_is_an_error(spark, digits):
    rows = [("a", 1e25, 0, 1)]
    stats = window_stats(frame(spark, rows), with_last=True)
    with pytest.raises(Exception):
        completed_total(stats, 1000, digits=digits).collect()


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_missing_intervals(spark, chunk):
    rng = random.Random(5)
    rows = [(rng.choice("aab"), 1.0, rng.randrange(40) * 1000, i) for i in range(60)] + [("c", 1.0, 0, 99), ("n", None, 0, 98)]
    stats = window_stats(frame(spark, rows))
    windows = {s: sorted({t for x, p, t, _ in rows if x == s and p is not None}) for s in "abc"}
    expected = [
        (s, t + 1000, after) for s, own in windows.items() for t, after in zip(own, [*own[1:], None]) if after is None or after > t + 1000
    ]
    found = missing_intervals(stats, 1000, chunk=chunk)
    assert rows_of(found, "symbol", "missing_from", "missing_until") == sorted(expected, key=str)
    assert rows_of(known_since(stats), "symbol", "known_since") == [(s, own[0]) for s, own in windows.items()]
