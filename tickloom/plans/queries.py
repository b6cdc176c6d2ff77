"""Registered queries: each operator on the shared tables, with the SQL that must give the same rows.

``events`` plays the trades: ``event_id`` is the offset, ``ts`` the event time, ``value`` the price in
cents' precision, and ``event_type`` or ``user_id`` the symbol. Lists are joined into texts so that both
engines return plain columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from tickloom.functions import known_symbols, missing_symbols, strip_control, time_bucket, unique_symbols
from tickloom.operators import dimension, frames
from tickloom.operators.asof import as_of
from tickloom.operators.completed import completed_total, known_since, missing_intervals
from tickloom.operators.joins import with_company_symbols
from tickloom.operators.latest import company_symbols, latest_prices
from tickloom.operators.mentions import mentions
from tickloom.operators.windows import summary, window_stats
from tickloom.plans.market import prices_from_messages
from tickloom.plans.profiles import refresh_cache
from tickloom.catalog import Catalog
from tickloom.schemas import DATASETS, LATEST_PRICES, SUMMARY, WINDOW_STATS
from tickloom.session import shared_dir
from tickloom.sinks.heads import CsvCache
from tickloom.sinks.publish import Delivery, publish, tombstones, write_csv
from tickloom.sources.files import big_tech_list, company_list, read_csv_cache
from tickloom.sources.messages import data_messages, explode_trades, parse, rejected_messages, trades_from_messages
from tickloom.sources.topics import read_topics, stock_prices, symbols
from tickloom.streaming.jobs import (
    LateRows, MarketTables, start_final, start_latest_prices, start_market, start_publish, start_summary_changes,
)
from tickloom.streaming.tables import KeyedTable, SliceTable

Query = Callable[[SparkSession, str], DataFrame]

SECOND, MINUTE, HOUR = 1_000, 60_000, 3_600_000
DELAY, DELAY_MS = "10 minutes", 600_000
PRICE_DIGITS, TOTAL_DIGITS = 2, 6
FIRST_MESSAGES = 1_000
# State partitions of the streams by event type: its five symbols have a few open hours at any time.
OPEN_WINDOWS = 4

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


# Inputs -------------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _as_trades(events: DataFrame, symbol: str, price: Column | None = None) -> DataFrame:
    return events.select(
        F.col("event_id").alias("offset"),
        F.col(symbol).cast("string").alias("symbol"),
        (F.col("value") if price is None else price).alias("price"),
        _millis("ts").alias("timestamp"),
    )


def _trades(spark: SparkSession, sf_dir: str, symbol: str, price: Column | None = None) -> DataFrame:
    return _as_trades(_table(spark, sf_dir, "events"), symbol, price)


def _trade_stream(spark: SparkSession, sf_dir: str, symbol: str) -> DataFrame:
    """The events as a stream; the pattern in the path lets it be one file or a folder of files."""
    schema = _table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return frames.with_event_time(_as_trades(events, symbol))


def _registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups are the symbols topic: a user registers as a symbol."""
    signups = _table(spark, sf_dir, "events").where("event_type = 'signup'")
    return _as_trades(signups, "user_id").select("offset", "symbol", "timestamp")


def _purchase_price() -> Column:
    """Only purchases carry a price."""
    return F.when(F.col("event_type") == "purchase", F.col("value"))


def _stats(spark: SparkSession, sf_dir: str, symbol: str, size_ms: int, with_last: bool = False) -> DataFrame:
    return window_stats(_trades(spark, sf_dir, symbol), size_ms, digits=PRICE_DIGITS, with_last=with_last)


# The same in SQL ------------------------------------------------------------------------------------

_MS = "epoch_us(ts) // 1000"


def _sql_stats(symbol: str, size_ms: int) -> str:
    return f"""
        SELECT symbol, count(*) AS count,
               CAST(sum(CAST(price * 100 AS BIGINT)) AS DOUBLE)
                 / (count(price) * CAST(100 AS DOUBLE)) AS avg_price,
               arg_max(price, event_id) AS last_price, ms - ms % {size_ms} AS timestamp
        FROM (SELECT event_id, CAST({symbol} AS VARCHAR) AS symbol, value AS price, {_MS} AS ms FROM events)
        GROUP BY symbol, ms - ms % {size_ms}"""


def _sql_total(price: str) -> str:
    """The sum at ``TOTAL_DIGITS`` decimal places, whatever the order of the rows; the cast rounds."""
    units = 10**TOTAL_DIGITS
    return f"CAST(sum(CAST({price} * {units} AS BIGINT)) AS DOUBLE) / CAST({units} AS DOUBLE)"


def _sql_closed(size_ms: int) -> str:
    return f"timestamp + {size_ms} <= (SELECT max({_MS}) - {DELAY_MS} FROM events)"


def _sql_summary(symbol: str, size_ms: int) -> str:
    return f"""
        SELECT timestamp, {_sql_total('avg_price')} AS total_price,
               string_agg(symbol, ',' ORDER BY symbol) AS symbols
        FROM ({_sql_stats(symbol, size_ms)}) GROUP BY timestamp"""


def _sql_completed(symbol: str, size_ms: int) -> str:
    """Brute force: every window against every symbol."""
    return f"""
        WITH stats AS ({_sql_stats(symbol, size_ms)}),
        grid AS (SELECT w.timestamp, s.symbol FROM (SELECT DISTINCT timestamp FROM stats) w
                 CROSS JOIN (SELECT DISTINCT symbol FROM stats) s),
        prices AS (SELECT g.timestamp, g.symbol,
                          CASE WHEN p.timestamp = g.timestamp THEN p.avg_price ELSE p.last_price END AS price
                   FROM grid g ASOF JOIN stats p ON g.symbol = p.symbol AND g.timestamp >= p.timestamp)
        SELECT timestamp, {_sql_total('price')} AS total,
               count(*) AS known, string_agg(symbol, ',' ORDER BY symbol) AS all_symbols
        FROM prices GROUP BY timestamp"""


# Windows --------------------------------------------------------------------------------------------


@register("window_stats_1s", f"SELECT symbol, count, avg_price, timestamp FROM ({_sql_stats('event_type', SECOND)})")
def window_stats_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, "event_type", SECOND)


@register("window_stats_1h", f"SELECT symbol, count, avg_price, timestamp FROM ({_sql_stats('user_id', HOUR)})")
def window_stats_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, "user_id", HOUR)


def _summary(stats: DataFrame, size_ms: int) -> DataFrame:
    totals = summary(stats, size_ms, digits=TOTAL_DIGITS)
    return totals.withColumn("symbols", F.array_join("symbols", ","))


@register("summary_1s", _sql_summary("event_type", SECOND))
def summary_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(_stats(spark, sf_dir, "event_type", SECOND), SECOND)


@register("summary_1h", _sql_summary("user_id", HOUR))
def summary_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(_stats(spark, sf_dir, "user_id", HOUR), HOUR)


@register("completed_total_event_type", f"SELECT timestamp, total, known FROM ({_sql_completed('event_type', SECOND)})")
def completed_total_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = _stats(spark, sf_dir, "event_type", SECOND, with_last=True)
    return completed_total(stats, SECOND, digits=TOTAL_DIGITS)


@register("completed_total_user", f"SELECT timestamp, total, known FROM ({_sql_completed('user_id', MINUTE)})")
def completed_total_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = _stats(spark, sf_dir, "user_id", MINUTE, with_last=True)
    return completed_total(stats, MINUTE, digits=TOTAL_DIGITS)


@register(
    "missing_symbols_1h",
    f"""SELECT * FROM (
          SELECT symbol, timestamp + {HOUR} AS missing_from,
                 lead(timestamp) OVER (PARTITION BY symbol ORDER BY timestamp) AS missing_until
          FROM ({_sql_stats('user_id', HOUR)}))
        WHERE missing_until IS NULL OR missing_until > missing_from""",
)
def missing_symbols_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_intervals(_stats(spark, sf_dir, "user_id", HOUR), HOUR)


@register("known_since_1h", f"SELECT symbol, min(timestamp) AS known_since FROM ({_sql_stats('user_id', HOUR)}) GROUP BY symbol")
def known_since_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_since(_stats(spark, sf_dir, "user_id", HOUR))


@register(
    "symbol_sets_1h",
    f"""WITH e AS (SELECT DISTINCT user_id, event_type, ms - ms % {HOUR} AS timestamp FROM (SELECT *, {_MS} AS ms FROM events)),
             l AS (SELECT user_id, timestamp, list(event_type) AS now FROM e GROUP BY user_id, timestamp),
             p AS (SELECT *, coalesce(lag(now) OVER (PARTITION BY user_id ORDER BY timestamp), []) AS before FROM l)
        SELECT user_id, timestamp,
               array_to_string(list_sort(list_filter(before, lambda x: NOT list_contains(now, x))), ',') AS missing,
               array_to_string(list_sort(list_distinct(list_concat(before, now))), ',') AS known
        FROM p""",
)
def symbol_sets_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and hour: the event types of the hour before that are missing now, and those of both hours."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", time_bucket(_millis("ts"), HOUR).alias("timestamp"))
    now = events.groupBy("user_id", "timestamp").agg(F.collect_set(F.concat("event_type", F.lit("\x00"))).alias("now"))
    now = now.withColumn("now", unique_symbols(F.col("now")))
    before = F.lag("now").over(W.partitionBy("user_id").orderBy("timestamp"))
    rows = now.withColumn("before", F.coalesce(before, F.array().cast("array<string>")))
    missing = missing_symbols(F.col("before"), F.col("now"))
    return rows.select(
        "user_id",
        "timestamp",
        F.array_join(missing, ",").alias("missing"),
        F.array_join(known_symbols(missing, F.col("now")), ",").alias("known"),
    )


# Latest values and joins ----------------------------------------------------------------------------


@register(
    "company_symbols",
    f"""SELECT CAST(user_id AS VARCHAR) AS symbol, arg_max({_MS}, event_id) AS timestamp
        FROM events WHERE event_type = 'signup' GROUP BY user_id""",
)
def company_symbols_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return company_symbols(_registrations(spark, sf_dir))


_SQL_LATEST = f"""
    SELECT CAST(user_id AS VARCHAR) AS symbol,
           coalesce(arg_max(value, event_id) FILTER (WHERE event_type = 'purchase'), 0) AS last_price,
           arg_max({_MS}, event_id) AS timestamp
    FROM events GROUP BY user_id"""


@register("latest_prices", _SQL_LATEST)
def latest_prices_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_prices(_trades(spark, sf_dir, "user_id", _purchase_price()))


@register(
    "prices_with_registration",
    f"""SELECT e.event_id AS "offset", CAST(e.user_id AS VARCHAR) AS symbol, e.value AS price,
               r.registered_at
        FROM events e LEFT JOIN (SELECT user_id, arg_max({_MS}, event_id) AS registered_at FROM events
                                 WHERE event_type = 'signup' GROUP BY user_id) r ON e.user_id = r.user_id""",
)
def prices_with_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = company_symbols(_registrations(spark, sf_dir))
    joined = with_company_symbols(_trades(spark, sf_dir, "user_id"), table)
    return joined.select("offset", "symbol", "price", "registered_at")


@register(
    "as_of_symbol",
    f"""SELECT e.event_id AS "offset", CAST(e.user_id AS VARCHAR) AS symbol, e.value AS price, r.registered_at
        FROM events e ASOF LEFT JOIN (SELECT event_id, user_id, {_MS} AS registered_at FROM events
                                      WHERE event_type = 'signup') r
          ON e.user_id = r.user_id AND e.event_id >= r.event_id""",
)
def as_of_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _registrations(spark, sf_dir).withColumnRenamed("timestamp", "registered_at")
    prices = _trades(spark, sf_dir, "user_id").select("offset", "symbol", "price")
    return as_of(prices, changes, "symbol", ["registered_at"])


@register(
    "as_of_messages",
    f"""SELECT e.event_id AS message, e.position, 'user_' || CAST(e.user_id AS VARCHAR) AS symbol, e.value AS price,
               r.registered_at
        FROM (SELECT *, 1 AS position FROM events WHERE event_type IN ('click', 'view', 'purchase')
              AND NOT (event_type = 'view' AND value < 1)) e
        ASOF LEFT JOIN (SELECT event_id, user_id, {_MS} AS registered_at FROM events WHERE event_type = 'signup') r
          ON e.user_id = r.user_id AND e.event_id >= r.event_id
        UNION ALL
        SELECT event_id, 0, event_type, value, NULL FROM events
        WHERE event_type IN ('click', 'view', 'purchase') AND NOT (event_type = 'view' AND value < 1)""",
)
def as_of_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades out of raw messages, in arrival order by message and place, with their symbol's registration then."""
    prices = prices_from_messages(_messages(spark, sf_dir))
    symbol = F.concat(F.lit("user_"), "symbol").alias("symbol")
    place = F.struct(F.col("offset").alias("message"), F.lit(0).alias("position")).alias("offset")
    changes = _registrations(spark, sf_dir).select(place, symbol, F.col("timestamp").alias("registered_at"))
    found = as_of(prices, changes, "symbol", ["registered_at"], order=["offset.message", "offset.position"])
    return found.select("offset.message", "offset.position", "symbol", "price", "registered_at")


# Messages and records -------------------------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_messages(_table(spark, sf_dir, "events"))


def _as_messages(events: DataFrame) -> DataFrame:
    """One feed message per event: trades, empty trade lists, pings, error notices and broken texts."""

    def trade(symbol: Column) -> Column:
        return F.struct(
            F.array("event_type").alias("c"),
            F.col("value").alias("p"),
            symbol.alias("s"),
            _millis("ts").alias("t"),
            F.col("user_id").cast("double").alias("v"),
        )

    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    both = F.array(trade(F.col("event_type")), trade(user))
    kept = F.when((F.col("event_type") == "view") & (F.col("value") < 1), F.slice(both, 1, 0)).otherwise(both)
    text = (
        F.when(F.col("event_type") == "signup", F.lit('{"type":"ping"}'))
        .when((F.col("event_type") == "error") & (F.col("value") < 20), F.concat(F.lit("bad{"), F.col("props")))
        .when(F.col("event_type") == "error", F.to_json(F.struct(F.lit("error").alias("type"), "props")))
        .otherwise(F.to_json(F.struct(F.lit("trade").alias("type"), kept.alias("data"))))
    )
    return events.select(F.col("event_id").alias("offset"), text.alias("value"))


_SQL_DATA = "event_type IN ('click', 'view', 'purchase')"
_SQL_EMPTY = "event_type = 'view' AND value < 1"


@register(
    "trade_messages",
    f"""SELECT event_id AS "offset", position, CASE position WHEN 0 THEN event_type
                 ELSE 'user_' || CAST(user_id AS VARCHAR) END AS symbol,
               value AS price, CAST(user_id AS DOUBLE) AS volume, {_MS} AS timestamp, event_type AS conditions
        FROM events CROSS JOIN (VALUES (0), (1)) p(position)
        WHERE {_SQL_DATA} AND NOT ({_SQL_EMPTY})""",
)
def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = explode_trades(data_messages(parse(_messages(spark, sf_dir))), keep=["offset"])
    conditions = F.array_join("trade_condition", "|").alias("conditions")
    return trades.select("offset", "position", "symbol", "price", "volume", "timestamp", conditions)


@register(
    "rejected_messages",
    """SELECT event_id AS "offset", CASE WHEN value < 20 THEN 'malformed' ELSE 'no data' END AS reason
       FROM events WHERE event_type = 'error'""",
)
def rejected_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_messages(parse(_messages(spark, sf_dir))).select("offset", "reason")


@register(
    "first_n_messages",
    f"""SELECT event_id AS "offset", CASE WHEN {_SQL_EMPTY} THEN 0 ELSE 2 END AS trades
        FROM events WHERE {_SQL_DATA} ORDER BY event_id LIMIT {FIRST_MESSAGES}""",
)
def first_n_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = data_messages(parse(_messages(spark, sf_dir)))
    first = frames.first_messages(data, FIRST_MESSAGES)
    return first.select("offset", F.size("message.data").alias("trades"))


@register(
    "latest_prices_from_messages",
    f"""SELECT symbol, arg_max(value, event_id) AS last_price, arg_max(ms, event_id) AS timestamp
        FROM (SELECT event_id, value, {_MS} AS ms, CASE position WHEN 0 THEN event_type
                       ELSE 'user_' || CAST(user_id AS VARCHAR) END AS symbol
              FROM events CROSS JOIN (VALUES (0), (1)) p(position)
              WHERE {_SQL_DATA} AND NOT ({_SQL_EMPTY}))
        GROUP BY symbol""",
)
def latest_prices_from_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_prices(prices_from_messages(_messages(spark, sf_dir)))


def _uneven_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as they come in: NaN prices in errors, no symbol in signups."""
    nan = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    trades = _trades(spark, sf_dir, "event_type", nan)
    trades = trades.withColumn("symbol", F.nullif("symbol", F.lit("signup"))).withColumn("volume", F.lit(1.0))
    return frames.normalise_nulls(trades)


@register(
    "valid_records",
    f"""SELECT event_id AS "offset", event_type AS symbol, value AS price, {_MS} AS timestamp
        FROM events WHERE event_type NOT IN ('error', 'signup')""",
)
def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = frames.valid(_uneven_records(spark, sf_dir), DATASETS["trades"])
    return records.select("offset", "symbol", "price", "timestamp")


@register(
    "quarantined_records",
    """SELECT event_id AS "offset", CASE event_type WHEN 'error' THEN 'price' ELSE 'symbol' END AS lacking
       FROM events WHERE event_type IN ('error', 'signup')""",
)
def quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = frames.quarantined(_uneven_records(spark, sf_dir), DATASETS["trades"])
    return records.select("offset", F.array_join("lacking", ",").alias("lacking"))


def _publish_all(spark: SparkSession, sf_dir: str) -> tuple[dict[str, str], dict[str, Delivery]]:
    """All events go to two topics: signups to symbols, the rest to trades. A trade of a price under 1 is sent as a
    tombstone, an error without its price; what was delivered and what failed is counted."""
    base = shared_dir(spark, "topics")
    paths = {"trades": f"{base}/trades", "symbols": f"{base}/symbols"}
    events = _table(spark, sf_dir, "events").where("event_type <> 'signup'")
    price = F.when(F.col("event_type") != "error", F.col("value"))
    trades = _as_trades(events, "user_id", price).withColumn("volume", F.lit(1.0))
    sent = {"trades": publish(trades.where("price >= 1 OR price IS NULL"), "trades", paths["trades"], DATASETS["trades"])}
    tombstones(trades.where("price < 1"), "trades", "symbol").write.mode("append").parquet(paths["trades"])
    sent["symbols"] = publish(_registrations(spark, sf_dir), "symbols", paths["symbols"], DATASETS["symbols"])
    return paths, sent


@register(
    "topic_route",
    f"""SELECT 'trades' AS topic, event_id AS "offset", CAST(user_id AS VARCHAR) AS symbol, value AS price,
               {_MS} AS timestamp
        FROM events WHERE event_type NOT IN ('signup', 'error') AND value >= 1
        UNION ALL
        SELECT 'symbols', event_id, CAST(user_id AS VARCHAR), NULL, {_MS} FROM events WHERE event_type = 'signup'""",
)
def topic_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics are published, read as one stream of records, routed by name and decoded, without tombstones."""
    paths, _ = _publish_all(spark, sf_dir)
    records = frames.live(read_topics(spark, paths))
    prices = stock_prices(frames.route(records, "trades")).withColumn("topic", F.lit("trades"))
    named = symbols(frames.route(records, "symbols")).withColumn("topic", F.lit("symbols"))
    rows = prices.unionByName(named, allowMissingColumns=True)
    return rows.select("topic", "offset", "symbol", "price", "timestamp")


@register(
    "deliveries",
    """SELECT 'trades' AS topic, count(*) FILTER (event_type <> 'error') AS delivered,
              count(*) FILTER (event_type = 'error') AS failed
       FROM events WHERE event_type <> 'signup' AND (value >= 1 OR event_type = 'error')
       UNION ALL SELECT 'symbols', count(*), 0 FROM events WHERE event_type = 'signup'""",
)
def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What publishing counted."""
    _, sent = _publish_all(spark, sf_dir)
    rows = [(topic, d.delivered, d.failed) for topic, d in sent.items()]
    return spark.createDataFrame(rows, "topic string, delivered bigint, failed bigint")


@register(
    "tombstoned_keys",
    """SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS tombstones FROM events
       WHERE event_type NOT IN ('signup', 'error') AND value < 1 GROUP BY user_id""",
)
def tombstoned_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = _publish_all(spark, sf_dir)
    gone = read_topics(spark, paths).where("value IS NULL")
    return gone.groupBy("key").agg(F.count("*").alias("tombstones"))


@register(
    "listings",
    """SELECT 'company' AS list, CAST(c_custkey AS VARCHAR) AS name, c_name AS detail FROM customer
       UNION ALL SELECT 'big_tech', n_name, CAST(n_regionkey AS VARCHAR) FROM nation""",
)
def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company list as CSV and the big-tech list as Parquet, written and read."""
    base = shared_dir(spark, "lists")
    customers = _table(spark, sf_dir, "customer")
    customers.select(F.col("c_custkey").alias("symbol"), F.col("c_name").alias("security"), "c_mktsegment").write.option(
        "header", "true"
    ).csv(f"{base}/companies")
    nations = _table(spark, sf_dir, "nation")
    nations.select(F.col("n_regionkey").alias("country"), F.col("n_name").alias("company")).write.parquet(f"{base}/tech")
    companies = company_list(spark, f"{base}/companies").select(
        F.lit("company").alias("list"), F.col("symbol").alias("name"), F.col("security").alias("detail")
    )
    tech = big_tech_list(spark, f"{base}/tech", "parquet")
    return companies.unionByName(tech.select(F.lit("big_tech").alias("list"), F.col("company").alias("name"), F.col("country").alias("detail")))


@register(
    "registered_dataset",
    f"""SELECT CAST(user_id AS VARCHAR) AS symbol, {_MS} AS timestamp FROM events WHERE event_type = 'signup'""",
)
def registered_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored registrations, registered under their declared layout and read by it."""
    path = shared_dir(spark, "registered")
    _registrations(spark, sf_dir).select("symbol", "timestamp").write.parquet(path)
    catalog = Catalog(spark)
    catalog.register("symbols", path)
    return catalog.read("symbols")


@register(
    "whole_prices_1h",
    f"""SELECT timestamp, sum(avg_price) AS total_price, count(*) AS symbols FROM (
          SELECT user_id, ms - ms % {HOUR} AS timestamp, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price
          FROM (SELECT user_id, {_MS} AS ms, CASE WHEN event_type = 'error' THEN NULL ELSE 1024.0 END AS price FROM events)
          GROUP BY ALL)
        GROUP BY timestamp""",
)
def whole_prices_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default averages and sums, on prices that are exact in any order; errors have the price NaN."""
    price = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.lit(1024.0))
    totals = summary(window_stats(_trades(spark, sf_dir, "user_id", price), HOUR), HOUR)
    return totals.select("timestamp", "total_price", F.size("symbols").cast("bigint").alias("symbols"))


#: Added before cutting to hundredths, so that no total in use lies on a border that rounding could cross.
_OFF_BORDER = 0.1234567


def _sql_unpriced(total: str) -> str:
    """The completed total where errors have no price, by every window against every symbol."""
    return f"""
        WITH t AS (SELECT event_id, CAST(user_id AS VARCHAR) AS symbol, value AS price, {_MS} - {_MS} % {HOUR} AS timestamp
                   FROM events WHERE event_type <> 'error'),
        stats AS (SELECT symbol, timestamp, arg_max(price, event_id) AS last_price,
                         CAST(sum(CAST(price * 100 AS BIGINT)) AS DOUBLE) / (count(*) * 100.0::DOUBLE) AS avg_price
                  FROM t GROUP BY symbol, timestamp),
        grid AS (SELECT w.timestamp, s.symbol FROM (SELECT DISTINCT timestamp FROM stats) w
                 CROSS JOIN (SELECT DISTINCT symbol FROM stats) s),
        prices AS (SELECT g.timestamp, CASE WHEN p.timestamp = g.timestamp THEN p.avg_price ELSE p.last_price END AS price
                   FROM grid g ASOF JOIN stats p ON g.symbol = p.symbol AND g.timestamp >= p.timestamp)
        SELECT timestamp, {total} AS total, count(*) AS known FROM prices GROUP BY timestamp"""


def _unpriced_total(spark: SparkSession, sf_dir: str, digits: int) -> DataFrame:
    nan = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    stats = window_stats(_trades(spark, sf_dir, "user_id", nan), HOUR, digits=PRICE_DIGITS, with_last=True)
    return completed_total(stats, HOUR, digits=digits)


@register("completed_total_unpriced", _sql_unpriced(_sql_total("price")))
def completed_total_unpriced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors have the price NaN, which is no price."""
    return _unpriced_total(spark, sf_dir, TOTAL_DIGITS)


@register("completed_total_unpriced_18", _sql_unpriced(f"CAST(floor(sum(price) * 100 + {_OFF_BORDER}) AS BIGINT)"))
def completed_total_unpriced_18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the default precision, compared in whole hundredths: SQL adds doubles."""
    totals = _unpriced_total(spark, sf_dir, 18)
    return totals.withColumn("total", F.floor(F.col("total") * 100 + _OFF_BORDER))


@register("distinct_symbols", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS symbol FROM events")
def distinct_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.distinct_symbols(_trades(spark, sf_dir, "user_id"))


@register(
    "clean_text",
    r"""SELECT doc_id, regexp_replace(text, '[\x00-\x1F]', '', 'g') AS text,
               CAST(length(text) - length(regexp_replace(text, '[\x00-\x1F]', '', 'g')) AS INTEGER) AS removed
        FROM documents""",
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = strip_control(F.col("text"))
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", clean.alias("clean"))
    return documents.select(
        "doc_id", F.col("clean").alias("text"), (F.length("text") - F.length("clean")).alias("removed")
    )


# Company dimension ----------------------------------------------------------------------------------


def _company_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return listed.select(F.col("c_custkey").alias("symbol"), F.col("c_name").alias("security"))


def _cached_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that ordered before 1996 have a cached profile."""
    orders = _table(spark, sf_dir, "orders").where("o_orderdate < TIMESTAMP_NTZ '1996-01-01 00:00:00'")
    return orders.groupBy(F.col("o_custkey").alias("symbol")).agg(
        F.count("*").cast("double").alias("share_outstanding"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("ipo"),
    )


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured profile responses; one market segment has none."""
    answered = _table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return answered.select(
        F.col("c_custkey").alias("symbol"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("industry")
    )


_SQL_PROFILES = """(SELECT o_custkey AS symbol, CAST(count(*) AS DOUBLE) AS share_outstanding,
                          strftime(min(o_orderdate), '%Y-%m-%d') AS ipo
                   FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY o_custkey)"""
_SQL_NEW = f"""(SELECT c_custkey AS symbol, c_name AS security, c_mktsegment FROM customer
               WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT symbol FROM {_SQL_PROFILES}))"""
_SQL_KNOWN = f"""(SELECT * FROM {_SQL_PROFILES}
                 WHERE symbol IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0))"""


@register("new_companies", f"SELECT symbol, security FROM {_SQL_NEW}")
def new_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.new_companies(_company_list(spark, sf_dir), _cached_profiles(spark, sf_dir))


@register("known_companies", f"SELECT symbol, share_outstanding, ipo FROM {_SQL_KNOWN}")
def known_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.known_companies(_cached_profiles(spark, sf_dir), _company_list(spark, sf_dir))


@register(
    "refreshed_profiles",
    f"""SELECT symbol, share_outstanding, ipo, NULL AS name, NULL AS industry FROM {_SQL_KNOWN}
        UNION ALL
        SELECT symbol, NULL, NULL, security, c_mktsegment FROM {_SQL_NEW} WHERE c_mktsegment <> 'BUILDING'""",
)
def refreshed_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    refreshed, _ = dimension.refresh(
        _company_list(spark, sf_dir), _cached_profiles(spark, sf_dir), _responses(spark, sf_dir)
    )
    return refreshed


@register(
    "refreshed_cache",
    f"""SELECT symbol, share_outstanding, ipo, NULL AS name, NULL AS industry FROM {_SQL_KNOWN}
        UNION ALL
        SELECT symbol, NULL, NULL, security, c_mktsegment FROM {_SQL_NEW} WHERE c_mktsegment <> 'BUILDING'""",
)
def refreshed_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cached profiles refreshed from cache to cache, with the vendor's names in the responses."""
    schema = T.StructType.fromDDL("symbol bigint, share_outstanding double, ipo string, name string, industry string")
    cache = CsvCache(shared_dir(spark, "profiles"), schema)
    cached = _cached_profiles(spark, sf_dir)
    cache.write(cached.withColumns({c: F.lit(None).cast("string") for c in ("name", "industry")}))
    responses = _responses(spark, sf_dir).withColumnsRenamed({"symbol": "Symbol", "industry": "vendorIndustry"})
    refresh_cache(cache, _company_list(spark, sf_dir), responses, industry="vendorIndustry")
    return cache.read(spark)


@register("missing_profiles", f"SELECT symbol, security FROM {_SQL_NEW} WHERE c_mktsegment = 'BUILDING'")
def missing_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, missing = dimension.refresh(
        _company_list(spark, sf_dir), _cached_profiles(spark, sf_dir), _responses(spark, sf_dir)
    )
    return missing


@register(
    "company_pattern",
    """SELECT replace(coalesce(string_agg(s_name || ' Inc.', '|' ORDER BY s_name), ''), 'Inc.', 'Inc') AS pattern
       FROM supplier WHERE s_nationkey = 1""",
)
def company_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _table(spark, sf_dir, "supplier").select(
        F.concat("s_name", F.lit(" Inc.")).alias("company"), F.col("s_nationkey").cast("string").alias("country")
    )
    return dimension.company_pattern(suppliers, "1")


@register(
    "big_tech_match",
    """WITH p AS (SELECT c_custkey AS symbol, lower(n_name) || ' inc. ' || c_name AS name
                  FROM customer JOIN nation ON c_nationkey = n_nationkey)
       SELECT symbol, name FROM p
       WHERE regexp_matches(name, (SELECT replace(string_agg(n_name || ' Inc.', '|'), 'Inc.', 'Inc')
                                   FROM nation WHERE n_regionkey = 1), 'i')""",
)
def big_tech_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _table(spark, sf_dir, "nation")
    companies = nations.select(
        F.concat("n_name", F.lit(" Inc.")).alias("company"), F.col("n_regionkey").cast("string").alias("country")
    )
    customers = _table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.concat(F.lower("n_name"), F.lit(" inc. "), "c_name").alias("name")
    profiles = customers.select(F.col("c_custkey").alias("symbol"), name)
    return dimension.match_companies(profiles, companies, "1")


@register(
    "company_mentions",
    """WITH n AS (SELECT DISTINCT p_name || ' ' || p_brand AS company FROM part UNION SELECT s_name FROM supplier UNION SELECT 'an'),
            t AS (SELECT p_partkey AS symbol, 'The ' || upper(p_name) || ' ' || p_brand || ' by Supplier#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS name
                  FROM part)
       SELECT symbol, company FROM t, n WHERE contains(lower(name), lower(company))""",
)
def company_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that name a product, a maker or both, against all of them."""
    parts = _table(spark, sf_dir, "part")
    products = parts.select(F.concat_ws(" ", "p_name", "p_brand").alias("company"))
    makers = _table(spark, sf_dir, "supplier").select(F.col("s_name").alias("company"))
    maker = F.concat(F.lit(" by Supplier#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    name = F.concat(F.lit("The "), F.upper("p_name"), F.lit(" "), "p_brand", maker)
    texts = parts.select(F.col("p_partkey").alias("symbol"), name.alias("name"))
    short = spark.range(1).select(F.lit("an").alias("company"))
    return mentions(texts, products.unionByName(makers).unionByName(short)).select("symbol", "company")


@register(
    "csv_round_trip",
    """SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment
       FROM customer""",
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", segment)
    path = shared_dir(spark, "csv")
    write_csv(customers, path)
    return read_csv_cache(spark, path, customers.schema)


# Streams --------------------------------------------------------------------------------------------


@register(
    "stream_window_final",
    f"""SELECT symbol, count, avg_price, timestamp FROM ({_sql_stats('event_type', HOUR)})
        WHERE {_sql_closed(HOUR)}""",
)
def stream_window_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream")
    trades = _trade_stream(spark, sf_dir, "event_type")
    stats = window_stats(trades, HOUR, delay=DELAY, digits=PRICE_DIGITS).drop("window")
    start_final(stats, f"{base}/out", f"{base}/checkpoint", state_partitions=OPEN_WINDOWS).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("stream_summary_final", f"SELECT * FROM ({_sql_summary('event_type', HOUR)}) WHERE {_sql_closed(HOUR)}")
def stream_summary_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream")
    trades = _trade_stream(spark, sf_dir, "event_type")
    stats = window_stats(trades, HOUR, delay=DELAY, digits=PRICE_DIGITS)
    totals = _summary(stats, HOUR)
    start_final(totals, f"{base}/out", f"{base}/checkpoint", state_partitions=OPEN_WINDOWS).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register(
    "stream_latest_prices",
    f"""SELECT CAST(user_id AS VARCHAR) AS symbol, arg_max(value, event_id) AS last_price,
               arg_max({_MS}, event_id) AS timestamp FROM events GROUP BY user_id""",
)
def stream_latest_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream")
    table = KeyedTable(f"{base}/latest_prices", LATEST_PRICES, "symbol")
    trades = _trade_stream(spark, sf_dir, "user_id")
    start_latest_prices(trades, table, f"{base}/checkpoint").awaitTermination()
    return table.read(spark)


@register(
    "stream_completed_total",
    f"""SELECT timestamp, total, known FROM ({_sql_completed('user_id', HOUR)}) WHERE {_sql_closed(HOUR)}""",
)
def stream_completed_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream")
    tables = MarketTables.under(base)
    trades = _trade_stream(spark, sf_dir, "user_id")
    start_market(
        trades, HOUR, DELAY, tables, f"{base}/checkpoint", digits=PRICE_DIGITS, total_digits=TOTAL_DIGITS
    ).awaitTermination()
    return tables.totals.read(spark)


@register(
    "stream_published_prices",
    f"""SELECT symbol, arg_max(value, event_id) AS last_price, arg_max(ms, event_id) AS timestamp
        FROM (SELECT event_id, value, {_MS} AS ms, CASE position WHEN 0 THEN event_type
                       ELSE 'user_' || CAST(user_id AS VARCHAR) END AS symbol
              FROM events CROSS JOIN (VALUES (0), (1)) p(position)
              WHERE {_SQL_DATA} AND NOT ({_SQL_EMPTY}))
        GROUP BY symbol""",
)
def stream_published_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages to a topic, and the topic to latest prices, each a stream; the second resumes once more from
    its checkpoint and changes nothing."""
    base = shared_dir(spark, "stream")
    events = _table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")
    trades = trades_from_messages(_as_messages(stream), keep=["offset"])
    start_publish(trades, "trades", f"{base}/trades", DATASETS["trades"], f"{base}/publish").awaitTermination()
    table = KeyedTable(f"{base}/latest", LATEST_PRICES, "symbol")
    for _ in range(2):
        topic = read_topics(spark, {"trades": f"{base}/trades"}, stream=True)
        start_latest_prices(stock_prices(topic), table, f"{base}/checkpoint").awaitTermination()
    return table.read(spark)


@register("stream_summary_changes", _sql_summary("event_type", HOUR))
def stream_summary_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest summary of every window, open ones too."""
    base = shared_dir(spark, "stream")
    table = KeyedTable(f"{base}/stats", WINDOW_STATS, ["symbol", "timestamp"])
    changes = SliceTable(f"{base}/changes", SUMMARY)
    start_summary_changes(
        _trade_stream(spark, sf_dir, "event_type"), HOUR, DELAY, table, changes, f"{base}/checkpoint",
        digits=PRICE_DIGITS, total_digits=TOTAL_DIGITS,
    ).awaitTermination()
    newest = changes.newest(spark, "timestamp")
    return newest.withColumn("symbols", F.array_join("symbols", ","))


@register(
    "stream_arrival_1h",
    f"""SELECT event_type AS symbol, count(*) AS count, ms - ms % {HOUR} + 86400000 AS timestamp
        FROM (SELECT event_type, {_MS} AS ms FROM events)
        GROUP BY event_type, ms - ms % {HOUR} HAVING timestamp + {HOUR} <= (SELECT max({_MS}) + 86400000 - {DELAY_MS} FROM events)""",
)
def stream_arrival_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows by the time of arrival, here a day after the event."""
    base = shared_dir(spark, "stream")
    trades = _trade_stream(spark, sf_dir, "event_type").drop("event_time")
    arrived = trades.withColumn("arrival", F.timestamp_millis(F.col("timestamp") + 86_400_000))
    stats = window_stats(frames.with_event_time(arrived, "arrival", "arrival"), HOUR, delay=DELAY).drop("window", "avg_price")
    start_final(stats, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("symbol", "count", "timestamp")


@register(
    "stream_late_rows",
    f"""SELECT count(*) AS late FROM events
        WHERE event_type = 'signup' AND {_MS} - {_MS} % {HOUR} + {HOUR} <= (SELECT max({_MS}) FROM events) - {DELAY_MS}""",
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events come first; then all signups come again, most of them too late. What is dropped is counted."""
    base = shared_dir(spark, "stream")
    events = _table(spark, sf_dir, "events")
    _as_trades(events, "event_id").write.parquet(f"{base}/in/part=0")
    schema = spark.read.parquet(f"{base}/in/part=0").schema
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        for again in (False, True):
            if again:
                _as_trades(events.where("event_type = 'signup'"), "event_id").write.parquet(f"{base}/in/part=1")
            trades = frames.with_event_time(spark.readStream.schema(schema).parquet(f"{base}/in/part=*"))
            stats = window_stats(trades, HOUR, delay=DELAY).drop("window")
            start_final(stats, f"{base}/out", f"{base}/checkpoint").awaitTermination()
        listener.wait(60)
    finally:
        spark.streams.removeListener(listener)
    return spark.range(1).select(F.lit(listener.total).cast("bigint").alias("late"))


# The queries about order of arrival register themselves here; they use what is defined above.
from tickloom.plans import arrival_queries  # noqa: E402, F401
