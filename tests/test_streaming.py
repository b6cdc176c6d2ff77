import os
import random

import pytest
from pyspark.sql import functions as F

from tests.brute import completed, window_rows
from tickloom.operators.frames import with_event_time
from tickloom.operators.joins import with_company_symbols
from tickloom.operators.latest import latest_prices
from tickloom.operators.windows import summary, window_stats
from tickloom.schemas import DATASETS, LATEST_PRICES, SUMMARY, WINDOW_STATS
from tickloom.sources.topics import read_topics
from tickloom.streaming.jobs import (
    LateRows, MarketTables, late_rows, start_final, start_latest_prices, start_market, start_publish, start_push,
    start_summary_changes,
)
from tickloom.streaming.tables import KeyedTable, SliceTable

TRADES = "symbol string, price double, timestamp bigint, offset bigint"


class Feed:
    """Files of trades, added one by one and read as a stream."""

    def __init__(self, spark, folder):
        self.spark, self.path, self.base = spark, folder + "/in", folder

    def add(self, rows):
        self.spark.createDataFrame(rows, TRADES).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return with_event_time(self.spark.readStream.schema(TRADES).parquet(self.path))


@pytest.fixture
def feed(spark, folder):
    return Feed(spark, folder)


def in_order(seed, n, step=700):
    rng = random.Random(seed)
    rows, now = [], 1_000_000
    for offset in range(n):
        now += rng.randrange(step)
        symbol = "a" if rng.random() < 0.33 else rng.choice("bcdef")
        rows.append((symbol, round(rng.uniform(1, 50), 2), now, offset))
    return rows


def closed(rows, size_ms, delay_ms):
    end = max(r[2] for r in rows) - delay_ms
    return lambda window: window + size_ms <= end


def finals(rows, size_ms, delay_ms):
    keep = closed(rows, size_ms, delay_ms)
    return {k: round(v[0], 6) for k, v in window_rows(rows, size_ms).items() if keep(k[0])}


def test_final_windows_over_restarts_equal_batch(spark, feed):
    rows = in_order(1, 90)
    for part in (rows[:30], rows[30:60], rows[60:]):
        random.Random(2).shuffle(part)
        feed.add(part)
        stats = window_stats(feed.stream(), 1000, delay="2 seconds").drop("window")
        start_final(stats, feed.base + "/out", feed.base + "/cp").awaitTermination()
    result = spark.read.parquet(feed.base + "/out").collect()
    assert {(r["timestamp"], r["symbol"]): round(r["avg_price"], 6) for r in result} == finals(rows, 1000, 2000)
    assert len(result) == len(finals(rows, 1000, 2000))


def test_final_summary_is_chained(spark, feed):
    rows = in_order(3, 60)
    for part in (rows[:30], rows[30:]):
        feed.add(part)
        totals = summary(window_stats(feed.stream(), 1000, delay="1 second"), 1000)
        start_final(totals, feed.base + "/out", feed.base + "/cp").awaitTermination()
    expected = {}
    for (window, symbol), average in finals(rows, 1000, 1000).items():
        total, symbols = expected.get(window, (0.0, []))
        expected[window] = (total + average, sorted([*symbols, symbol]))
    result = {r["timestamp"]: (r["total_price"], r["symbols"]) for r in spark.read.parquet(feed.base + "/out").collect()}
    assert {w: (pytest.approx(t, abs=1e-4), s) for w, (t, s) in expected.items()} == result


def test_late_rows_are_dropped_and_counted(spark, feed):
    feed.add([("a", 1.0, 1_000, 0), ("a", 2.0, 60_000, 1)])
    dropped = 0
    for part in (None, [("a", 9.0, 1_500, 2), ("a", 3.0, 120_000, 3)]):
        if part:
            feed.add(part)
        stats = window_stats(feed.stream(), 1000, delay="5 seconds").drop("window")
        query = start_final(stats, feed.base + "/out", feed.base + "/cp")
        query.awaitTermination()
        dropped += late_rows(query)
    result = spark.read.parquet(feed.base + "/out").orderBy("timestamp").collect()
    assert [(r["timestamp"], r["avg_price"]) for r in result] == [(1000, 1.0), (60000, 2.0)]
    assert dropped == 1


def test_latest_prices_are_upserted(spark, feed):
    rows = in_order(4, 80)
    rows[10] = (rows[10][0], None, rows[10][2], 10)
    table = KeyedTable(feed.base + "/latest", LATEST_PRICES, "symbol", snapshot_every=2)
    for start in range(0, 80, 20):
        feed.add(rows[start : start + 20])
        start_latest_prices(feed.stream(), table, feed.base + "/cp").awaitTermination()
    expected = latest_prices(spark.createDataFrame(rows, TRADES)).collect()
    assert sorted(table.read(spark).collect()) == sorted(expected)
    assert sorted(table.at(spark, 3).collect()) == sorted(expected)
    first = latest_prices(spark.createDataFrame(rows[:20], TRADES)).collect()
    assert sorted(table.at(spark, 0).collect()) == sorted(first)
    assert table.at(spark, -1) is None


def test_a_repeated_batch_changes_nothing(spark, folder):
    table = KeyedTable(folder + "/t", LATEST_PRICES, "symbol", snapshot_every=3)
    for batch in (0, 1, 1, 2, 3, 3, 4):
        rows = [("a", float(batch), batch), (f"k{batch}", 1.0, batch)]
        table.upsert(spark.createDataFrame(rows, LATEST_PRICES), batch)
    assert sorted(table.read(spark).collect()) == [
        ("a", 4.0, 4), ("k0", 1.0, 0), ("k1", 1.0, 1), ("k2", 1.0, 2), ("k3", 1.0, 3), ("k4", 1.0, 4)
    ]
    assert sorted(table.at(spark, 4).collect()) == sorted(table.read(spark).collect())


def test_files_read_stay_bounded(spark, folder):
    table = KeyedTable(folder + "/t", LATEST_PRICES, "symbol", snapshot_every=4)
    for batch in range(30):
        table.upsert(spark.createDataFrame([("a", float(batch), batch), (f"k{batch}", 1.0, batch)], LATEST_PRICES), batch)
    assert table.head(spark) == 29 and table.read(spark).count() == 31
    assert len({f.rsplit("/", 2)[1] for f in table.read(spark).inputFiles()}) <= 4
    assert spark.read.schema(LATEST_PRICES).parquet(folder + "/t/batch=20").count() == 0


def test_reading_stops_at_the_last_complete_batch(spark, folder):
    table = KeyedTable(folder + "/t", LATEST_PRICES, "symbol")
    assert table.read(spark).count() == 0
    table.upsert(spark.createDataFrame([("a", 1.0, 1)], LATEST_PRICES), 0)
    spark.createDataFrame([("a", 9.0, 9)], LATEST_PRICES).write.parquet(folder + "/t/batch=1")
    assert table.read(spark).collect() == [("a", 1.0, 1)]


@pytest.mark.parametrize("listed", [True, False])
def test_market_over_restarts_equals_brute_force(spark, feed, listed):
    rows = in_order(5, 100, step=900)
    tables = MarketTables.under(feed.base + "/market", symbols=listed, snapshot_every=3)
    for start in range(0, 100, 25):
        part = rows[start : start + 25]
        random.Random(start).shuffle(part)
        feed.add(part)
        start_market(feed.stream(), 1000, "3 seconds", tables, feed.base + "/cp").awaitTermination()
    keep = closed(rows, 1000, 3000)
    expected = [row for row in completed(rows, 1000) if keep(row[0])]
    got = tables.totals.read(spark).orderBy("timestamp").collect()
    if listed:
        assert [(r["timestamp"], round(r["total"], 6), r["all_symbols"]) for r in got] == expected
    else:
        assert [(r["timestamp"], round(r["total"], 6), r["known"]) for r in got] == [(w, t, len(s)) for w, t, s in expected]
    assert tables.stats.read(spark).count() == len(finals(rows, 1000, 3000))
    sums = {r["timestamp"]: len(r["symbols"]) for r in tables.summary.read(spark).collect()}
    assert sum(sums.values()) == len(finals(rows, 1000, 3000)) and len(sums) == len(expected)


def test_published_batches_are_written_again_whole(spark, feed):
    rows = in_order(6, 40)
    for part in (rows[:20], rows[20:]):
        feed.add(part)
        trades = feed.stream().withColumn("volume", F.lit(1.0))
        start_publish(trades, "trades", feed.base + "/topic", DATASETS["trades"], feed.base + "/cp").awaitTermination()
    topic = read_topics(spark, {"trades": feed.base + "/topic"})
    assert sorted(r["offset"] for r in topic.collect()) == [r[3] for r in rows]
    # a micro-batch whose commit is lost runs again
    for name in (feed.base + "/cp/commits/1", feed.base + "/cp/commits/.1.crc"):
        if os.path.exists(name):
            os.remove(name)
    start_publish(trades, "trades", feed.base + "/topic", DATASETS["trades"], feed.base + "/cp").awaitTermination()
    spark.catalog.refreshByPath(feed.base + "/topic")
    again = read_topics(spark, {"trades": feed.base + "/topic"})
    assert sorted(r["offset"] for r in again.collect()) == [r[3] for r in rows]
    assert again.columns == ["topic", "key", "value", "offset"]


def test_summary_changes_hold_open_windows(spark, feed):
    rows = in_order(8, 60)
    table = KeyedTable(feed.base + "/stats", WINDOW_STATS, ["symbol", "timestamp"], snapshot_every=2)
    changes = SliceTable(feed.base + "/changes", SUMMARY)
    for start in range(0, 60, 20):
        feed.add(rows[start : start + 20])
        start_summary_changes(feed.stream(), 1000, "1 hour", table, changes, feed.base + "/cp").awaitTermination()
    expected = {r["timestamp"]: (round(r["total_price"], 6), r["symbols"]) for r in summary(window_stats(spark.createDataFrame(rows, TRADES), 1000)).collect()}
    assert {r["timestamp"]: (round(r["total_price"], 6), r["symbols"]) for r in changes.newest(spark, "timestamp").collect()} == expected


def test_late_rows_are_counted_over_all_progress(spark, feed):
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        feed.add([("a", 1.0, 1_000, 0), ("a", 2.0, 600_000, 1)])
        for i in range(3):
            stats = window_stats(feed.stream(), 1000, delay="5 seconds").drop("window")
            start_final(stats, feed.base + "/out", feed.base + "/cp").awaitTermination()
            feed.add([("a", 9.0, 1_500, 10 + i), ("a", 9.0, 1_600, 20 + i)])
        listener.wait(5)
    finally:
        spark.streams.removeListener(listener)
    assert listener.total == 2 and len(listener.by_query) == 1


def test_push_query_emits_changes(spark, feed):
    feed.add([("a", 1.0, 1000, 0), ("b", 2.0, 1000, 1)])
    query = start_push(latest_prices(feed.stream()), "pushed", "memory", feed.base + "/cp")
    query.processAllAvailable()
    feed.add([("a", 5.0, 2000, 2)])
    query.processAllAvailable()
    query.stop()
    rows = sorted((r["symbol"], r["last_price"]) for r in spark.table("pushed").collect())
    assert rows == [("a", 1.0), ("a", 5.0), ("b", 2.0)]


def test_stream_table_join(spark, feed):
    feed.add([("a", 1.0, 1000, 0), ("z", 2.0, 1000, 1), (None, 3.0, 1000, 2)])
    table = spark.createDataFrame([("a", 7)], "symbol string, timestamp bigint")
    joined = with_company_symbols(feed.stream(), table).select("offset", "registered_at")
    start_final(joined, feed.base + "/out", feed.base + "/cp").awaitTermination()
    assert sorted(spark.read.parquet(feed.base + "/out").collect()) == [(0, 7), (1, None), (2, None)]


def test_a_stream_needs_a_delay(feed):
    feed.add([("a", 1.0, 1000, 0)])
    with pytest.raises(ValueError):
        window_stats(feed.stream(), 1000)


def test_arrival_time_of_files(spark, feed):
    feed.add([("a", 1.0, 1000, 0)])
    stream = spark.readStream.schema(TRADES).parquet(feed.path).select("*", F.col("_metadata.file_modification_time").alias("arrival"))
    timed = with_event_time(stream, "arrival", "arrival").select("symbol", "event_time")
    start_final(timed, feed.base + "/out", feed.base + "/cp").awaitTermination()
    assert spark.read.parquet(feed.base + "/out").first()["event_time"].year > 2000
