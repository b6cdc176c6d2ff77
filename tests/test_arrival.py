"""What depends on the order of arrival, against plain-Python consumers that read one record after the other."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F, types as T

from tickloom.operators.arrival import completed_in_order
from tickloom.operators.asof import as_of, running_latest
from tickloom.operators.latest import price_changes
from tickloom.operators.sequence import consumed_sequence, numbered
from tickloom.schemas import DATASETS, LATEST_PRICES
from tickloom.sinks.heads import write_head
from tickloom.sinks.offsets import NEXT_OFFSETS, REPORTS, publish_numbered
from tickloom.sources.topics import read_topics
from tickloom.streaming.arrival import (
    CHANGES, ArrivalTables, start_as_of, start_completed_in_order, start_first_messages, start_price_changes, stop_when_full,
)
from tickloom.streaming.jobs import LateRows, start_publish_numbered
from tickloom.streaming.tables import KeyedTable, SliceTable

PRICES = "offset bigint, symbol string, price double, timestamp bigint"
SEQUENCE = "position bigint, symbol string, last_price double, timestamp bigint, total_price double, symbols array<string>"


def trades(seed, n):
    rng = random.Random(seed)
    price = lambda: rng.choice([None, float("nan"), round(rng.uniform(1, 50), 2), round(rng.uniform(1, 50), 2)])
    symbol = lambda: rng.choice(["a", "a", "a", "b", "c", None])
    return [(k * 3 - 40, symbol(), price(), rng.choice([None, 1000 + k])) for k in range(n)]


def changes(rows):
    """{offset: table row} of a consumer that updates a table."""
    table, found = {}, {}
    for offset, symbol, price, at in sorted(rows, key=lambda r: r[0]):
        if symbol is not None:
            old = table.get(symbol, (None, None))
            known = price is not None and not math.isnan(price)
            table[symbol] = (price if known else old[0], at if at is not None else old[1])
            found[offset] = (symbol, table[symbol][0] if table[symbol][0] is not None else 0.0, table[symbol][1])
    return found


@pytest.mark.parametrize("chunk", [5, 1_000_000, None])
def test_price_changes_equal_a_consumer(spark, chunk):
    rows = trades(1, 120)
    random.Random(2).shuffle(rows)
    found = price_changes(spark.createDataFrame(rows, PRICES), chunk=chunk).collect()
    assert {r["offset"]: tuple(r)[1:] for r in found} == changes(rows) and len(found) == len(changes(rows))


def test_running_latest_goes_on_from_carried_rows(spark):
    rows = [(1, "a", None), (2, "b", 5.0), (3, "c", None), (None, "a", 9.0), (4, None, 9.0)]
    frame = spark.createDataFrame(rows, "offset bigint, symbol string, price double")
    carry = spark.createDataFrame([("a", 7.0), ("b", 1.0), (None, 3.0)], "symbol string, last double")
    found = running_latest(frame, "symbol", {"price": "last"}, carry=carry).collect()
    assert sorted((r["offset"], r["last"]) for r in found if r["last"]) == [(1, 7.0), (2, 5.0)] and len(found) == 3


def test_as_of_goes_on_from_carried_rows(spark):
    events = spark.createDataFrame([(1, "a"), (5, "a"), (1, "b"), (1, "z"), (2, None)], "offset bigint, symbol string")
    late = spark.createDataFrame([(3, "a", 30), (9, "b", 90)], "offset bigint, symbol string, at int")
    carry = spark.createDataFrame([("a", 7), ("b", None), ("q", 1)], "symbol string, at int")
    found = as_of(events, late, "symbol", ["at"], carry=carry).collect()
    assert sorted(map(str, [(r["offset"], r["symbol"], r["at"]) for r in found])) == sorted(
        map(str, [(1, "a", 7), (5, "a", 30), (1, "b", None), (1, "z", None), (2, None, None)])
    )


# Numbers ----------------------------------------------------------------------------------------------


def test_numbers_are_dense_over_many_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), rng.choice("xy"), rng.randrange(5)) for _ in range(900)]
    frame = spark.createDataFrame(rows, "arrival bigint, topic string, offset bigint").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = consumed_sequence(frame).collect()
        apart = numbered(frame, ["arrival"], "n", within=["topic", "offset"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["position"] for r in found) == list(range(900))
    key = lambda r: (r["arrival"] is not None, r["arrival"] or 0, r["topic"], r["offset"])
    assert [key(r) for r in sorted(found, key=lambda r: r["position"])] == sorted(map(key, found))
    groups = {}
    for r in apart:
        groups.setdefault((r["topic"], r["offset"]), []).append((r["n"], r["arrival"] is not None, r["arrival"] or 0))
    for own in groups.values():
        assert [n for n, *_ in sorted(own)] == list(range(len(own)))
        assert [x[1:] for x in sorted(own)] == sorted(x[1:] for x in own)
    assert sorted(map(str, [tuple(r)[:3] for r in found])) == sorted(map(str, rows))


def test_numbers_of_equal_rows_and_none(spark):
    frame = spark.createDataFrame([(1, [2], {"k": 1})] * 50, "a bigint, b array<int>, c map<string,int>")
    assert sorted(r["n"] for r in numbered(frame, ["a"], "n").collect()) == list(range(50))
    assert numbered(frame.limit(0), ["a"], "n").count() == 0
    assert numbered(frame.limit(0), ["a"], "n", within=["b"]).count() == 0


# Completion in order ----------------------------------------------------------------------------------


def sequence(seed, n):
    """Prices and summaries mixed; some summaries name a symbol twice, unknown ones, or none."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        if rng.random() < 0.75:
            price = rng.choice([None, float("nan")]) if rng.random() < 0.1 else round(rng.uniform(1, 50), 2)
            rows.append((2 * k, rng.choice(["a", "a", "a", "b", "c", "d", None]), price, None, None, None))
        else:
            named = [rng.choice("abcdxy") for _ in range(rng.randrange(4))]
            rows.append((2 * k, None, None, k, round(rng.uniform(1, 99), 2) if rng.random() < 0.9 else None, named))
    return rows


def consumed(rows):
    prices, found = {}, {}
    for position, symbol, price, at, total, named in sorted(rows, key=lambda r: r[0]):
        if named is None:
            if symbol is not None and price is not None and not math.isnan(price):
                prices[symbol] = price
        else:
            rest = sum(p for s, p in prices.items() if s not in named)
            found[position] = (at, round((total or 0) + rest, 2), len(prices.keys() | set(named)))
    return found


def split(frame):
    return frame.where("symbols IS NULL"), frame.where("symbols IS NOT NULL")


def result(rows):
    return {r["position"]: (r["timestamp"], round(r["total"], 2), r["known"]) for r in rows}


@pytest.mark.parametrize("span, chunk, digits", [(1_000_000, 1_000_000, 4), (7, 5, 2), (50, None, 12)])
def test_completion_equals_a_consumer(spark, span, chunk, digits):
    rows = sequence(4, 200)
    random.Random(5).shuffle(rows)
    prices, summaries = split(spark.createDataFrame(rows, SEQUENCE))
    found = completed_in_order(prices, summaries, digits=digits, span=span, chunk=chunk).collect()
    assert result(found) == consumed(rows) and len(found) == len(consumed(rows)) > 30


def test_completion_without_prices(spark):
    rows = [(1, None, None, 1, 5.0, ["a"]), (2, None, None, 2, 1.0, [])]
    prices, summaries = split(spark.createDataFrame(rows, SEQUENCE))
    assert result(completed_in_order(prices, summaries, digits=2).collect()) == {1: (1, 5.0, 1), 2: (2, 1.0, 0)}


# Streams ----------------------------------------------------------------------------------------------


class Files:
    """Parts of rows, added one by one and read as a stream."""

    def __init__(self, spark, folder, schema):
        self.spark, self.base, self.schema = spark, folder, schema

    def add(self, rows, part):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.base}/in/part={part}")

    def stream(self):
        reader = self.spark.readStream.schema(T.StructType.fromDDL(self.schema)).option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{self.base}/in/part=*")


def runs(rows, sizes):
    found, at = [], 0
    for size in sizes:
        found.append(rows[at : at + size])
        at += size
    return [*found, rows[at:]]


def test_streamed_price_changes_over_restarts(spark, folder):
    rows, files = trades(6, 90), Files(spark, folder, PRICES)
    table = KeyedTable(f"{folder}/latest", LATEST_PRICES, "symbol", 2)
    out = SliceTable(f"{folder}/out", CHANGES)
    for part, own in enumerate(runs(rows, [20, 1, 30])):
        files.add(own, part)
        if part != 1:  # two files in one start
            start_price_changes(files.stream(), table, out, f"{folder}/checkpoint").awaitTermination()
    assert {r["offset"]: tuple(r)[1:] for r in out.read(spark).collect()} == changes(rows)
    # a repeated run finds all slices complete and changes nothing
    start_price_changes(files.stream(), table, out, f"{folder}/again").awaitTermination()
    assert {r["offset"]: tuple(r)[1:] for r in out.read(spark).collect()} == changes(rows)
    last = {}
    for offset, row in sorted(changes(rows).items()):
        last[row[0]] = row[1:]
    assert {r["symbol"]: (r["last_price"] or 0.0, r["timestamp"]) for r in table.read(spark).collect()} == last


def test_streamed_as_of_sees_changes_that_have_arrived(spark, folder):
    schema = "offset bigint, symbol string, at int"
    files = Files(spark, folder, schema)
    table = KeyedTable(f"{folder}/table", T.StructType.fromDDL("symbol string, at int"), "symbol")
    out = SliceTable(f"{folder}/out", T.StructType.fromDDL("offset bigint, symbol string, at int"))
    parts = [
        [(1, "a", None), (2, "a", 20), (3, "a", None), (4, "b", None)],
        [(5, "a", None), (6, "a", 60), (7, "b", 70), (8, "a", None), (9, "z", None)],
        [(10, "a", None), (11, "b", None), (0, "z", 5), (12, "z", None), (13, None, None)],
    ]
    for part, own in enumerate(parts):
        files.add(own, part)
        rows = files.stream()
        events = rows.where("at IS NULL").select("offset", "symbol")
        start_as_of(events, rows.where("at IS NOT NULL"), "symbol", ["at"], table, out, f"{folder}/checkpoint").awaitTermination()
    found = {r["offset"]: r["at"] for r in out.read(spark).collect()}
    assert found == {1: None, 3: 20, 4: None, 5: 20, 8: 60, 9: None, 10: 60, 11: 70, 12: 5, 13: None}


def test_streamed_completion_over_restarts(spark, folder):
    rows, files = sequence(7, 150), Files(spark, folder, SEQUENCE)
    tables = ArrivalTables.under(folder, snapshot_every=2)

    def start(checkpoint):
        prices, summaries = split(files.stream())
        start_completed_in_order(prices, summaries, tables, checkpoint, digits=4).awaitTermination()

    for part, own in enumerate(runs(rows, [50, 2, 60])):
        files.add(own, part)
        if part != 1:
            start(f"{folder}/checkpoint")
    assert result(tables.totals.read(spark).collect()) == consumed(rows)
    start(f"{folder}/again")
    assert result(tables.totals.read(spark).collect()) == consumed(rows)


def test_a_stream_stops_at_its_number_of_messages(spark, folder):
    files = Files(spark, folder, "offset bigint, value string")
    out = SliceTable(f"{folder}/out", T.StructType.fromDDL("offset bigint, value string"))
    counts = SliceTable(f"{folder}/counts", T.StructType.fromDDL("n bigint"))
    for part in range(4):
        rows = [(10 * part + k, "x") for k in range(10)]
        random.Random(part).shuffle(rows)
        files.add(rows, part)
        if part in (1, 3):
            start_first_messages(files.stream(), 25, out, counts, f"{folder}/checkpoint").awaitTermination()
    assert sorted(r["offset"] for r in out.read(spark).collect()) == list(range(25))
    assert counts.read(spark).agg(F.max("n")).first()[0] == 25


def test_a_running_stream_is_stopped_when_full(spark, folder):
    files = Files(spark, folder, "offset bigint, value string")
    out = SliceTable(f"{folder}/out", T.StructType.fromDDL("offset bigint, value string"))
    counts = SliceTable(f"{folder}/counts", T.StructType.fromDDL("n bigint"))
    files.add([(k, "x") for k in range(10)], 0)
    query = start_first_messages(files.stream(), 4, out, counts, f"{folder}/checkpoint", trigger={"processingTime": "0 seconds"})
    stop_when_full(spark, query, counts, 4)
    assert not query.isActive and out.read(spark).count() == 4


# Offsets and reports ----------------------------------------------------------------------------------


def sent_rows(seed, n):
    rng = random.Random(seed)
    return [
        (k, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, 1.0, 2.0, 3.0]), 1000 + k, 1.0) for k in range(n)
    ]


SENT = "offset bigint, symbol string, price double, timestamp bigint, volume double"


def report(rows, partitions):
    """[(partition, offset, key, status)] of a producer that sends one record after the other."""
    heads, found = {}, []
    for _, symbol, price, _, _ in sorted(rows):
        lacking = [n for n, v in (("symbol", symbol), ("price", price)) if v is None]
        if lacking:
            found.append((None, None, symbol, lacking))
        else:
            part = int(hashlib.md5(symbol.encode()).hexdigest()[:8], 16) % partitions
            found.append((part, heads.get(part, 0), symbol, None))
            heads[part] = heads.get(part, 0) + 1
    return found


def as_report(rows):
    status = lambda r: None if r["status"] == "delivered" else sorted(r["status"].removeprefix("failed: ").split(","))
    return sorted([(r["partition"], r["offset"], r["key"], status(r)) for r in rows], key=str)


def wanted(rows, partitions):
    return sorted([(p, o, k, None if x is None else sorted(x)) for p, o, k, x in report(rows, partitions)], key=str)


def test_reports_of_a_batch(spark, folder):
    rows = sent_rows(1, 200)
    random.Random(2).shuffle(rows)
    found = publish_numbered(spark.createDataFrame(rows, SENT), "trades", f"{folder}/t", DATASETS["trades"], 3)
    assert as_report(found.collect()) == wanted(rows, 3)
    topic = read_topics(spark, {"trades": f"{folder}/t"}).collect()
    assert len(topic) == sum(x is None for *_, x in report(rows, 3)) and all(r["value"] for r in topic)


def test_streamed_offsets_go_on_and_stay_the_same_on_replay(spark, folder):
    rows, files = sent_rows(3, 150), Files(spark, folder, SENT)
    heads = KeyedTable(f"{folder}/heads", NEXT_OFFSETS, ["topic", "partition"], 2)
    sent = SliceTable(f"{folder}/reports", REPORTS)

    def start(checkpoint):
        start_publish_numbered(
            files.stream(), "trades", f"{folder}/t", DATASETS["trades"], 3, heads, sent, checkpoint
        ).awaitTermination()

    for part, own in enumerate(runs(rows, [60, 2, 40])):
        files.add(own, part)
        if part != 1:
            start(f"{folder}/checkpoint")
    assert as_report(sent.read(spark).collect()) == wanted(rows, 3)
    # the last micro-batch is lost after its records and reports were written, and runs again
    last = heads.head(spark)
    spark.range(1).select(F.lit(last - 1).cast("bigint").alias("version")).coalesce(1).write.mode("overwrite").parquet(f"{heads.path}-head/{last % 2}")
    write_head(spark, heads.path, last - 1)
    assert heads.head(spark) == last - 1
    start(f"{folder}/again")
    assert heads.head(spark) == last
    assert as_report(sent.read(spark).collect()) == wanted(rows, 3)


def test_missing_reports_of_late_rows_are_an_error():
    listener = LateRows()
    listener._running.add("a query that has not ended")
    with pytest.raises(TimeoutError):
        listener.wait(0.1)
