"""Registered queries of what depends on the order of arrival, in batch and on streams, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.layouts import Field, Layout, Layouts, read_versions
from tickloom.operators.arrival import completed_in_order
from tickloom.operators.completed import completed_total
from tickloom.operators.latest import price_changes
from tickloom.operators.repair import applied, parts_stats, read_totals, repair, settled_totals, window_parts
from tickloom.operators.sequence import consumed_sequence
from tickloom.operators.windows import summary, window_stats
from tickloom.plans.queries import (
    FIRST_MESSAGES, HOUR, ORACLES, PRICE_DIGITS, TOTAL_DIGITS, _MS, _SQL_DATA, _SQL_EMPTY, _as_messages, _as_trades, _millis, _publish_all,
    _purchase_price, _registrations, _sql_completed, _sql_stats, _sql_summary, _table, _trades, register,
)
from tickloom.schemas import DATASETS, LATEST_PRICES
from tickloom.session import shared_dir
from tickloom.sinks.offsets import NEXT_OFFSETS, REPORTS, publish_numbered
from tickloom.sources.messages import data_messages, parse
from tickloom.sources.topics import read_topics
from tickloom.streaming.arrival import (
    CHANGES, ArrivalTables, start_as_of, start_completed_in_order, start_first_messages, start_price_changes,
)
from tickloom.streaming.jobs import start_publish_numbered
from tickloom.streaming.tables import KeyedTable, SliceTable

# Files that the events are dealt to for a stream, in their order, and those of the first start.
PARTS, FIRST_PARTS = 3, 2


def _parts(spark: SparkSession, rows: DataFrame, base: str, order: str, start: int, stop: int) -> None:
    """Writes runs of the order, one folder after the other, as a source would add files."""
    bounds = rows.agg(F.min(order).alias("low"), F.max(order).alias("high"))
    span = (F.col("high") - F.col("low") + 1) / PARTS
    part = F.least(F.lit(PARTS - 1), F.floor((F.col(order) - bounds.select("low").scalar()) / bounds.select(span).scalar()))
    for k in range(start, stop):
        rows.where(part == k).coalesce(1).write.parquet(f"{base}/part={k}")


def _started_twice(spark: SparkSession, rows: DataFrame, order: str, base: str, start) -> None:
    """Runs ``start(stream)`` over the first files, one a trigger, and again from its checkpoint over the rest."""
    for low, high in ((0, FIRST_PARTS), (FIRST_PARTS, PARTS)):
        _parts(spark, rows, f"{base}/in", order, low, high)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/part=*")
        start(stream).awaitTermination()


# One row per record ---------------------------------------------------------------------------------

_SQL_CHANGES = f"""
    SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS symbol,
           coalesce(last_value(price IGNORE NULLS) OVER w, 0) AS last_price, {_MS} AS timestamp
    FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN value END AS price FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"""


@register("price_changes", _SQL_CHANGES)
def price_changes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_changes(_trades(spark, sf_dir, "user_id", _purchase_price()))


@register("stream_price_changes", _SQL_CHANGES)
def stream_price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream")
    table = KeyedTable(f"{base}/latest", LATEST_PRICES, "symbol")
    out = SliceTable(f"{base}/changes", CHANGES)
    trades = _trades(spark, sf_dir, "user_id", _purchase_price())
    _started_twice(spark, trades, "offset", base, lambda rows: start_price_changes(rows, table, out, f"{base}/checkpoint"))
    return out.read(spark)


@register("stream_as_of_symbol", ORACLES["as_of_symbol"])
def stream_as_of_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's registration when it arrived, over several triggers and a restart."""
    base = shared_dir(spark, "stream")
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", "ts")
    long, text = T.LongType(), T.StringType()
    fields = lambda *columns: T.StructType([T.StructField(n, t) for n, t in columns])
    table = KeyedTable(f"{base}/registered", fields(("symbol", text), ("registered_at", long)), "symbol")
    out = SliceTable(
        f"{base}/found", fields(("offset", long), ("symbol", text), ("price", T.DoubleType()), ("registered_at", long))
    )

    def start(rows: DataFrame):
        prices = _as_trades(rows, "user_id").select("offset", "symbol", "price")
        changes = _as_trades(rows.where("event_type = 'signup'"), "user_id")
        changes = changes.select("offset", "symbol", F.col("timestamp").alias("registered_at"))
        return start_as_of(prices, changes, "symbol", ["registered_at"], table, out, f"{base}/checkpoint")

    _started_twice(spark, events, "event_id", base, start)
    return out.read(spark)


# One sequence of two topics -------------------------------------------------------------------------


@register(
    "consumed_sequence",
    f"""WITH r AS (
          SELECT 'trades' AS topic, event_id AS "offset", CAST(user_id AS VARCHAR) AS key, value >= 1 OR event_type = 'error' AS live
          FROM events WHERE event_type NOT IN ('signup', 'error')
          UNION ALL
          SELECT 'symbols', event_id, CAST(user_id AS VARCHAR), true FROM events WHERE event_type = 'signup')
        SELECT row_number() OVER (ORDER BY "offset" // 10, topic, "offset") - 1 AS position, topic, "offset", key, live FROM r""",
)
def consumed_sequence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of both topics in the order in which a consumer reads them; ten offsets arrive at a time."""
    paths, _ = _publish_all(spark, sf_dir)
    records = read_topics(spark, paths).withColumn("arrival", F.floor(F.col("offset") / 10))
    found = consumed_sequence(records)
    return found.select("position", "topic", "offset", "key", F.col("value").isNotNull().alias("live"))


def _arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The trades of users as latest prices, and the hourly summaries, in one sequence: a summary comes after the first trade
    of the hour that follows, so later trades of that hour are not yet known to it."""
    trades = _trades(spark, sf_dir, "user_id")
    prices = trades.select((2 * F.col("offset")).alias("position"), "symbol", F.col("price").alias("last_price"))
    totals = summary(window_stats(trades, HOUR, digits=PRICE_DIGITS), HOUR, digits=TOTAL_DIGITS)
    hour = F.col("timestamp") - F.pmod("timestamp", F.lit(HOUR).cast("bigint"))
    ends = trades.groupBy(hour.alias("timestamp")).agg((2 * F.max("offset") + 3).alias("position"))
    return prices, totals.join(ends, "timestamp").select("position", "timestamp", "total_price", "symbols")


_SQL_ARRIVAL = f"""
    WITH t AS (SELECT event_id, CAST(user_id AS VARCHAR) AS symbol, value AS price, {_MS} - {_MS} % {HOUR} AS timestamp FROM events),
    st AS (SELECT symbol, timestamp, CAST(sum(CAST(price * 100 AS BIGINT)) AS DOUBLE) / (count(price) * CAST(100 AS DOUBLE)) AS avg_price
           FROM t GROUP BY symbol, timestamp),
    s AS (SELECT timestamp, sum(CAST(avg_price * {10**TOTAL_DIGITS} AS BIGINT)) AS units, list(symbol) AS symbols FROM st GROUP BY timestamp),
    e AS (SELECT timestamp, 2 * max(event_id) + 3 AS position FROM t GROUP BY timestamp),
    k AS (SELECT DISTINCT symbol FROM t),
    g AS (SELECT e.position, k.symbol FROM e CROSS JOIN k),
    p AS (SELECT g.position, g.symbol, t.price FROM g ASOF JOIN t ON g.symbol = t.symbol AND g.position >= 2 * t.event_id),
    x AS (SELECT e.position, e.timestamp, s.units, s.symbols FROM s JOIN e USING (timestamp))
    SELECT x.position, x.timestamp,
           CAST(any_value(x.units) + coalesce(sum(CAST(p.price * {10**TOTAL_DIGITS} AS BIGINT)) FILTER (NOT list_contains(x.symbols, p.symbol)), 0) AS DOUBLE)
             / CAST({10**TOTAL_DIGITS} AS DOUBLE) AS total,
           len(any_value(x.symbols)) + count(*) FILTER (NOT list_contains(x.symbols, p.symbol)) AS known
    FROM x JOIN p USING (position) GROUP BY x.position, x.timestamp"""


@register("completed_arrival", _SQL_ARRIVAL)
def completed_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices, summaries = _arrivals(spark, sf_dir)
    return completed_in_order(prices, summaries, digits=TOTAL_DIGITS)


@register("stream_completed_arrival", _SQL_ARRIVAL)
def stream_completed_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream")
    prices, summaries = _arrivals(spark, sf_dir)
    rows = prices.unionByName(summaries, allowMissingColumns=True)
    tables = ArrivalTables.under(base)

    def start(stream: DataFrame):
        new = stream.where("symbol IS NOT NULL").select("position", "symbol", "last_price")
        asked = stream.where("symbol IS NULL").select("position", "timestamp", "total_price", "symbols")
        return start_completed_in_order(new, asked, tables, f"{base}/checkpoint", digits=TOTAL_DIGITS)

    _started_twice(spark, rows, "position", base, start)
    return tables.totals.read(spark)


@register("stream_first_n", ORACLES["first_n_messages"])
def stream_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first data messages over several triggers and a restart."""
    base = shared_dir(spark, "stream")
    long = T.LongType()
    out = SliceTable(f"{base}/messages", T.StructType([T.StructField("offset", long), T.StructField("trades", T.IntegerType())]))
    counts = SliceTable(f"{base}/counts", T.StructType([T.StructField("n", long)]))
    events = _table(spark, sf_dir, "events")

    def start(rows: DataFrame):
        data = data_messages(parse(_as_messages(rows))).select("offset", F.size("message.data").alias("trades"))
        return start_first_messages(data, FIRST_MESSAGES, out, counts, f"{base}/checkpoint")

    _started_twice(spark, events, "event_id", base, start)
    return out.read(spark)


# Delivery with offsets -------------------------------------------------------------------------------

PARTITIONS = 6

_SQL_REPORTS = f"""
    WITH t AS (SELECT event_id, CAST(user_id AS VARCHAR) AS key, event_type <> 'error' AS good FROM events WHERE event_type <> 'signup'),
    p AS (SELECT *, CAST(('0x' || md5(key)[1:8])::BIGINT % {PARTITIONS} AS INTEGER) AS part FROM t WHERE good)
    SELECT 'trades' AS topic, part AS partition, row_number() OVER (PARTITION BY part ORDER BY event_id) - 1 AS "offset", key, 'delivered' AS status FROM p
    UNION ALL
    SELECT 'trades', NULL, NULL, key, 'failed: price' FROM t WHERE NOT good"""


def _unpriced_errors(events: DataFrame) -> DataFrame:
    """Trades of users; those of errors come without a price."""
    price = F.when(F.col("event_type") != "error", F.col("value"))
    return _as_trades(events.where("event_type <> 'signup'"), "user_id", price).withColumn("volume", F.lit(1.0))


@register("delivery_reports", _SQL_REPORTS)
def delivery_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark, 'topics')}/trades"
    trades = _unpriced_errors(_table(spark, sf_dir, "events"))
    return publish_numbered(trades, "trades", path, DATASETS["trades"], PARTITIONS)


@register("stream_delivery_reports", _SQL_REPORTS)
def stream_delivery_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream")
    heads = KeyedTable(f"{base}/heads", NEXT_OFFSETS, ["topic", "partition"])
    sent = SliceTable(f"{base}/reports", REPORTS)

    def start(rows: DataFrame):
        return start_publish_numbered(
            _unpriced_errors(rows), "trades", f"{base}/trades", DATASETS["trades"], PARTITIONS, heads, sent, f"{base}/checkpoint"
        )

    _started_twice(spark, _table(spark, sf_dir, "events"), "event_id", base, start)
    return sent.read(spark)


# Late corrections ------------------------------------------------------------------------------------


def _repaired_market(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Window statistics, summary and completed totals per user and hour, where every tenth trade came late."""
    trades = _trades(spark, sf_dir, "user_id")
    in_time, late = trades.where("offset % 10 <> 3"), trades.where("offset % 10 = 3")
    base = shared_dir(spark, "market")
    window_parts(in_time, HOUR, PRICE_DIGITS).write.parquet(f"{base}/parts")
    parts = spark.read.parquet(f"{base}/parts")
    stats = parts_stats(parts, PRICE_DIGITS)
    settled_totals(stats, completed_total(stats, HOUR, digits=TOTAL_DIGITS), TOTAL_DIGITS).write.parquet(f"{base}/totals")
    totals = spark.read.parquet(f"{base}/totals")
    found = repair(parts, totals, late, HOUR, price_digits=PRICE_DIGITS, digits=TOTAL_DIGITS)
    sums = summary(stats, HOUR, digits=TOTAL_DIGITS)
    return (
        parts_stats(applied(parts, found.parts, ["symbol", "timestamp"]), PRICE_DIGITS),
        applied(sums, found.summary, ["timestamp"]),
        read_totals(applied(totals, found.totals, ["timestamp"]), TOTAL_DIGITS),
    )


@register("repaired_stats", f"SELECT symbol, count, avg_price, timestamp, last_price FROM ({_sql_stats('user_id', HOUR)})")
def repaired_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired_market(spark, sf_dir)[0]


@register("repaired_summary", _sql_summary("user_id", HOUR))
def repaired_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired_market(spark, sf_dir)[1].withColumn("symbols", F.array_join("symbols", ","))


@register("repaired_totals", f"SELECT timestamp, total, known FROM ({_sql_completed('user_id', HOUR)})")
def repaired_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired_market(spark, sf_dir)[2]


# Versions of a layout --------------------------------------------------------------------------------


def _trade_layouts() -> Layouts:
    """Trades in whole prices; then with conditions; then without them, with volume and venue."""
    text, long, double = T.StringType(), T.LongType(), T.DoubleType()
    layouts = Layouts()
    layouts.register(Layout((Field("symbol", text), Field("price", T.IntegerType()), Field("timestamp", long))))
    conditions = Field("conditions", T.ArrayType(text), nullable=True, default=None)
    layouts.register(Layout((Field("symbol", text), Field("price", double), Field("timestamp", long), conditions)))
    volume, venue = Field("volume", double, default=1.0), Field("venue", text, nullable=True, default=None)
    layouts.register(Layout((Field("symbol", text), Field("price", double), Field("timestamp", long), volume, venue)))
    return layouts


@register(
    "resolved_records",
    f"""SELECT event_id AS "offset", CAST(event_id % 4 + 1 AS INTEGER) AS version,
               CASE WHEN good THEN event_type END AS symbol,
               CASE WHEN good THEN CASE WHEN event_id % 4 = 0 THEN floor(value) ELSE value END END AS price,
               CASE WHEN good THEN {_MS} END AS timestamp,
               CASE WHEN good THEN CASE WHEN event_id % 4 = 2 THEN CAST(user_id AS DOUBLE) ELSE 1.0 END END AS volume,
               CASE WHEN event_id % 4 = 2 AND good THEN 'x' END AS venue,
               CASE WHEN event_id % 4 = 3 THEN 'version' WHEN NOT good THEN 'price' END AS fault
        FROM (SELECT *, event_id % 4 < 3 AND event_type <> 'error' AS good FROM events)""",
)
def resolved_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades written in three versions, and one that nobody knows, read in the newest; errors come without a price."""
    events = _table(spark, sf_dir, "events")
    number = (F.col("event_id") % 4).cast("int")
    price = F.when(F.col("event_type") != "error", F.col("value"))
    own = [F.col("event_type").alias("symbol"), _millis("ts").alias("timestamp")]
    one = F.to_json(F.struct(*own, F.floor(price).cast("int").alias("price")))
    two = F.to_json(F.struct(*own, price.alias("price"), F.array("event_type").alias("conditions")))
    three = F.to_json(F.struct(*own, price.alias("price"), F.col("user_id").cast("double").alias("volume"), F.lit("x").alias("venue")))
    value = F.when(number == 0, one).when(number == 1, two).otherwise(three)
    records = events.select(F.col("event_id").alias("offset"), (number + 1).alias("version"), value.alias("value"))
    found = read_versions(records, _trade_layouts())
    return found.select("offset", "version", "row.*", "fault")
