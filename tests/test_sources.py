import pytest
from pyspark.sql import functions as F, types as T

from tickloom.catalog import Catalog, Kind
from tickloom.operators import frames
from tickloom.operators.dimension import rename_profile_columns
from tickloom.operators.latest import latest_prices
from tickloom.plans.market import prices_from_messages
from tickloom.schemas import COMPANY_PROFILES, DATASETS, PROFILE_COLUMNS
from tickloom.sinks.publish import Delivery, publish, records, stamped, tombstones, write_csv
from tickloom.sources import files, messages as feed, topics

MESSAGES = [
    (1, '{"type":"trade","data":[{"c":null,"p":1.5,"s":"X","t":1704067200100,"v":2}]}'),
    (2, '{"type":"trade","data":[{"c":["1",null],"p":2.5,"s":"Y","t":5,"v":1},{"p":3.5,"s":"X","t":6,"v":0.5}]}'),
    (3, '{"type":"trade","data":[]}'),
    (4, '{"type":"ping"}'),
    (5, '{"type":"error","msg":"x"}'),
    (6, "bad{"),
    (7, '{"data":[]}'),
    (8, "{'type':'trade','data':[]}"),
    (9, '{"type":"trade","data":[]} trailing'),
    (10, None),
    (11, '{"type":"trade","data":[{"p":"abc","s":"Z","t":7,"v":1}]} \n'),
    (12, '{"type":"news","data":[{"p":9.0,"s":"W","t":8,"v":1}]}'),
]


@pytest.fixture(scope="module")
def parsed(spark):
    return feed.parse(spark.createDataFrame(MESSAGES, "offset bigint, value string")).cache()


def test_trades_from_messages(spark):
    raw = spark.createDataFrame(MESSAGES, "offset bigint, value string")
    trades = feed.trades_from_messages(raw, keep=["offset"])
    assert trades.columns == ["offset", "position", "trade_condition", "price", "symbol", "timestamp", "volume"]
    assert [tuple(r) for r in trades.orderBy("offset", "position").collect()] == [
        (1, 0, None, 1.5, "X", 1704067200100, 2.0),
        (2, 0, ["1", None], 2.5, "Y", 5, 1.0),
        (2, 1, None, 3.5, "X", 6, 0.5),
        (11, 0, None, None, "Z", 7, 1.0),
        (12, 0, None, 9.0, "W", 8, 1.0),
    ]


def test_one_bad_field_costs_one_record(parsed):
    trades = feed.explode_trades(feed.data_messages(parsed), keep=["offset"])
    bad = frames.quarantined(trades, DATASETS["trades"]).collect()
    assert [(r["offset"], r["lacking"]) for r in bad] == [(11, ["price"])]
    assert frames.valid(trades, DATASETS["trades"]).count() == 4


def test_rejected_messages(parsed):
    rejected = {r["offset"]: r["reason"] for r in feed.rejected_messages(parsed).collect()}
    assert rejected == {
        5: "no data", 6: "malformed", 7: "no type", 8: "malformed", 9: "malformed", 10: "malformed"
    }


def test_message_limit_counts_data_messages(parsed):
    first = lambda n: [r["offset"] for r in frames.first_messages(feed.data_messages(parsed), n).collect()]
    assert sorted(first(4)) == [1, 2, 3, 11]
    assert sorted(first(None)) == sorted(first(0)) == [1, 2, 3, 11, 12]


def test_prices_from_messages_keep_arrival_order(spark):
    raw = spark.createDataFrame(
        [(1, '{"type":"trade","data":[{"p":1.0,"s":"A","t":5,"v":1},{"p":2.0,"s":"A","t":5,"v":1}]}'),
         (0, '{"type":"trade","data":[{"p":9.0,"s":"A","t":9,"v":1}]}'),
         (2, '{"type":"trade","data":[{"p":NaN,"s":"A","t":9,"v":1}]}')],
        "offset bigint, value string",
    )
    prices = prices_from_messages(raw)
    assert sorted(tuple(r["offset"]) for r in prices.collect()) == [(0, 0), (1, 0), (1, 1)]
    assert latest_prices(prices).collect() == [("A", 2.0, 5)]


def test_message_stream(spark, folder):
    spark.createDataFrame(MESSAGES, "offset bigint, value string").select("value").where("value NOT LIKE '% \n'").write.text(folder + "/in")
    trades = feed.trades_from_messages(spark.readStream.text(folder + "/in"))
    out = trades.writeStream.format("parquet").option("path", folder + "/out").option("checkpointLocation", folder + "/cp")
    out.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["symbol"] for r in spark.read.parquet(folder + "/out").collect()) == ["W", "X", "X", "Y"]


TRADES = [("a", 1.0, 10, 2.0, 0), ("b", None, 20, 1.0, 1), (None, 3.0, 30, 1.0, 2), ("a", 4.0, 40, 1.0, 3)]
TRADE_FIELDS = "symbol string, price double, timestamp bigint, volume double, offset bigint"


def test_publish_and_read_topics(spark, folder):
    paths = {"trades": folder + "/trades", "symbols": folder + "/symbols"}
    trades = spark.createDataFrame(TRADES, TRADE_FIELDS)
    assert publish(trades, "trades", paths["trades"], DATASETS["trades"]) == Delivery(2, 2)
    gone = spark.createDataFrame([("b", 4)], "symbol string, offset bigint")
    tombstones(gone, "trades", "symbol").write.mode("append").parquet(paths["trades"])
    named = stamped(files.tickers(spark, ["a", "b"]))
    assert publish(named, "symbols", paths["symbols"], DATASETS["symbols"]) == Delivery(2, 0)

    read = topics.read_topics(spark, paths)
    assert read.columns == ["topic", "key", "value", "offset"]
    assert read.groupBy("topic").count().orderBy("topic").collect() == [("symbols", 2), ("trades", 3)]
    prices = topics.stock_prices(frames.route(read, "trades"))
    assert prices.orderBy("offset").collect() == [(0, 1.0, "a", 10), (3, 4.0, "a", 40)]
    assert frames.live(read).count() == 4
    symbols = topics.symbols(frames.route(read, "symbols")).collect()
    assert {s["symbol"] for s in symbols} == {"a", "b"}
    # Milliseconds: a value in seconds would be a thousand times smaller.
    assert all(s["timestamp"] > 1_600_000_000_000 for s in symbols)


def test_topics_as_a_stream(spark, folder):
    paths = {"trades": folder + "/trades", "symbols": folder + "/symbols"}
    publish(spark.createDataFrame(TRADES, TRADE_FIELDS), "trades", paths["trades"], DATASETS["trades"])
    publish(stamped(files.tickers(spark, ["a"])), "symbols", paths["symbols"], DATASETS["symbols"])
    read = topics.read_topics(spark, paths, stream=True)
    query = read.writeStream.format("memory").queryName("topic_rows").option("checkpointLocation", folder + "/cp")
    query.trigger(availableNow=True).start().awaitTermination()
    assert spark.table("topic_rows").groupBy("topic").count().orderBy("topic").collect() == [("symbols", 1), ("trades", 2)]


@pytest.mark.parametrize("names", [[], {}, "trades"])
def test_topic_names_are_checked(spark, names):
    with pytest.raises(ValueError):
        topics._check(names)


def test_codecs(spark):
    rows = spark.createDataFrame([("a", 1)], "symbol string, timestamp bigint")
    text = rows.select(topics.encode(F.struct("symbol", "timestamp")).alias("value"))
    back = text.select(topics.decode(F.col("value"), DATASETS["symbols"]).alias("row")).select("row.*")
    assert back.collect() == rows.collect()
    with pytest.raises(ValueError):
        topics.encode(F.lit(1), "xml")
    with pytest.raises(ValueError):
        topics.decode(F.lit("x"), DATASETS["symbols"], "xml")


def test_avro_schema_of_a_dataset():
    avro = DATASETS["trades"].avro_schema
    fields = {f["name"]: f["type"] for f in avro["fields"]}
    assert avro["type"] == "record" and avro["name"] == "trades"
    assert fields["price"] == "double" and fields["timestamp"] == "long" and fields["symbol"] == "string"
    # as in the trade record: the field comes first, and its absence is the union's first branch
    assert next(iter(fields)) == "trade_condition"
    assert fields["trade_condition"] == ["null", {"type": "array", "items": ["string", "null"]}]
    assert {f["name"]: f["type"] for f in DATASETS["company_profiles"].avro_schema["fields"]}["logo"] == ["string", "null"]


def test_records_are_keyed(spark):
    rows = records(spark.createDataFrame(TRADES, TRADE_FIELDS), "t", DATASETS["trades"]).collect()
    assert [(r["topic"], r["key"], r["offset"]) for r in rows] == [("t", "a", 0), ("t", "a", 3)]
    with pytest.raises(ValueError):
        records(spark.range(1), "t", DATASETS["trades"])


# Files


def test_csv_round_trip(spark, folder):
    schema = T.StructType([T.StructField("symbol", T.StringType(), False), T.StructField("note", T.StringType()), T.StructField("cap", T.DoubleType())])
    rows = [("A", 'say "hi", ok', 1.5), ("B", None, None), ("C", "x", 1e-7)]
    write_csv(spark.createDataFrame(rows, schema), folder + "/c")
    assert "N/A" in spark.read.text(folder + "/c").where("value LIKE 'B%'").first()[0]
    cached = files.read_csv_cache(spark, folder + "/c", schema)
    assert sorted(map(tuple, cached.collect())) == rows


def test_missing_cache_is_none(spark, folder):
    assert files.read_csv_cache(spark, folder + "/none", COMPANY_PROFILES) is None


def test_lists(spark, folder):
    spark.createDataFrame([("A", "Alpha", 1), ("B", "Beta", 2)], "symbol string, security string, extra int").write.option("header", True).csv(folder + "/l")
    assert sorted(files.company_list(spark, folder + "/l").collect()) == [("A", "Alpha"), ("B", "Beta")]
    spark.createDataFrame([("X Inc.", "US")], "company string, country string").write.parquet(folder + "/b")
    assert files.big_tech_list(spark, folder + "/b", "parquet").collect() == [("X Inc.", "US")]
    assert files.tickers(spark, ["p", "q"]).collect() == [("p",), ("q",)]


# Frames


def test_rename_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, 2)], "marketCapitalization int, other int")
    assert frames.rename(df, PROFILE_COLUMNS).columns == ["market_capitalization", "other"]


def test_profile_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "name int, vendorIndustry int, shareOutstanding int, Symbol int")
    assert rename_profile_columns(df, "vendorIndustry").columns == ["name", "industry", "share_outstanding", "symbol"]


def test_union_by_name(spark):
    left = spark.createDataFrame([(1, "a")], "x int, y string")
    right = spark.createDataFrame([("b", 2.0)], "y string, z double")
    assert sorted(frames.union_by_name(left, right).collect(), key=str) == [(1, "a", None), (None, "b", 2.0)]
    assert frames.union_by_name(None, right).collect() == [("b", 2.0)]
    assert frames.union_by_name(left, None).collect() == [(1, "a")]
    with pytest.raises(ValueError):
        frames.union_by_name(None, None)


def test_normalise_nulls(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "v double, s string")
    assert frames.normalise_nulls(df).collect() == [(None, "x"), (1.0, None)]


def test_event_time(spark):
    df = spark.createDataFrame([(1500, 99)], "timestamp bigint, arrived bigint").withColumn("arrival", F.timestamp_millis("arrived"))
    millis = lambda out: out.select(F.unix_millis("event_time")).first()[0]
    assert millis(frames.with_event_time(df)) == 1500
    assert millis(frames.with_event_time(df, "arrival", "arrival")) == 99
    assert millis(frames.with_event_time(df, "arrival")) > 1_600_000_000_000
    with pytest.raises(ValueError):
        frames.with_event_time(df, "guess")


def test_distinct_symbols(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "symbol string")
    assert sorted(frames.distinct_symbols(df).collect()) == [("a",), ("b",)]


# Catalog


def test_catalog_tables(spark):
    catalog = Catalog(spark)
    df = spark.range(3)
    assert catalog.create_view("Ticks_View", df) and not catalog.create_view("ticks_view", df)
    assert catalog.exists(Kind.TABLE, "TICKS_VIEW")
    assert catalog.drop(Kind.TABLE, "ticks_view") and not catalog.drop(Kind.TABLE, "ticks_view")
    assert catalog.create_table("ticks_table", df) and not catalog.create_table("ticks_table", df)
    assert "ticks_table" in catalog.show(Kind.TABLE)
    assert spark.table("ticks_table").count() == 3
    assert catalog.drop(Kind.TABLE, "ticks_table") and not catalog.exists(Kind.TABLE, "ticks_table")


def test_catalog_streams(spark, folder):
    catalog = Catalog(spark)
    spark.range(5).write.parquet(folder + "/in")

    def launch():
        stream = spark.readStream.schema("id bigint").parquet(folder + "/in")
        return stream.writeStream.format("memory").queryName("Numbers").option("checkpointLocation", folder + "/cp").start()

    query = catalog.start("numbers", launch)
    assert catalog.start("NUMBERS", launch).id == query.id
    assert catalog.show(Kind.STREAM) == ["Numbers"]
    query.processAllAvailable()
    assert spark.table("Numbers").count() == 5
    assert catalog.drop(Kind.STREAM, "numbers") and not catalog.exists(Kind.STREAM, "numbers")


def test_catalog_topics(spark, folder):
    catalog = Catalog(spark)
    spark.createDataFrame([("a", 1)], "symbol string, timestamp bigint").write.parquet(folder + "/s")
    spark.createDataFrame([("a", "x")], "symbol string, timestamp string").write.parquet(folder + "/bad")
    registered = catalog.register("nasdaq_symbols", folder + "/s", "symbols")
    assert registered.key == "symbol" and catalog.exists(Kind.TOPIC, "NASDAQ_SYMBOLS")
    assert catalog.read("nasdaq_symbols").collect() == [("a", 1)]
    with pytest.raises(ValueError):
        catalog.register("symbols", folder + "/bad")
    assert catalog.drop(Kind.TOPIC, "nasdaq_symbols") and catalog.show(Kind.TOPIC) == []
