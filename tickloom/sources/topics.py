"""Topics (SRC-1..5): keyed record logs, in Kafka or as folders of Parquet files.

A record is (topic, key, value, offset); ``value`` is the encoded record and null for a tombstone. The
Kafka and Avro modules are separate Spark packages, so both are choices of the caller.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.schemas import DATASETS, Dataset

RECORD = "topic string, key string, value string, offset bigint"


def read_topics(spark: SparkSession, paths: Mapping[str, str], *, stream: bool = False, **options: str) -> DataFrame:
    """SRC-4, SRC-5: the records of several file topics (name -> folder), from the first one on.

    ``topic`` is written in the records, so routing prunes nothing it needs.
    """
    _check(paths)
    reader = (spark.readStream if stream else spark.read).schema(RECORD).options(**options)
    columns = ["topic", "key", "value", "offset"]  # not the folders of a topic that a stream published
    if not stream and len(paths) == 1:
        return reader.parquet(*paths.values()).select(*columns)
    frames = [reader.parquet(path).select(*columns) for path in paths.values()]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def read_kafka(
    spark: SparkSession, servers: str, topics: Sequence[str], *, stream: bool = True, **options: str
) -> DataFrame:
    """SRC-4, SRC-5 over Kafka, from the earliest offset. ``arrival`` is the broker's record time."""
    _check(topics)
    reader = (spark.readStream if stream else spark.read).format("kafka")
    return (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .select("topic", F.col("key").cast("string"), "value", "offset", F.col("timestamp").alias("arrival"))
    )


def _check(topics: Iterable[str]) -> None:
    if isinstance(topics, str) or not list(topics):
        raise ValueError("topics must be a non-empty collection of names")


def encode(row: Column, codec: str = "json", dataset: Dataset | None = None, layout: str | None = None) -> Column:
    """SCL-10: a struct as a record value; ``layout`` is an Avro schema as JSON, by default the dataset's own."""
    if codec == "json":
        return F.to_json(row)
    if codec == "avro":
        from pyspark.sql.avro.functions import to_avro

        layout = layout or (json.dumps(dataset.avro_schema) if dataset else None)
        return to_avro(row, layout) if layout else to_avro(row)
    raise ValueError(f"unknown codec {codec!r}")


def decode(value: Column, dataset: Dataset, codec: str = "json", layout: str | None = None) -> Column:
    """SCL-10: a record value as a struct. ``layout`` is the writer's Avro schema as JSON, by default the dataset's
    own: Avro bytes can be read in the layout only that they were written in."""
    if codec == "json":
        return F.from_json(value.cast("string"), dataset.schema)
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(value, layout or json.dumps(dataset.avro_schema))
    raise ValueError(f"unknown codec {codec!r}")


def stream_of(records: DataFrame, dataset: Dataset, columns: Sequence[str], codec: str = "json") -> DataFrame:
    """SRC-1, SRC-2, PRJ-1: the chosen columns of a topic's live records, with their offset."""
    row = decode(F.col("value"), dataset, codec)
    arrival = [c for c in ("arrival",) if c in records.columns]
    live = records.where(F.col("value").isNotNull()).withColumn("row", row)
    return live.select("offset", *arrival, *[F.col(f"row.{c}").alias(c) for c in columns])


def stock_prices(records: DataFrame, codec: str = "json") -> DataFrame:
    """SRC-1: (offset, price, symbol, timestamp) of the trades topic; the other fields are never decoded."""
    return stream_of(records, DATASETS["trades"], ["price", "symbol", "timestamp"], codec)


def symbols(records: DataFrame, codec: str = "json") -> DataFrame:
    """SRC-2: (offset, symbol, timestamp) of the symbols topic."""
    return stream_of(records, DATASETS["symbols"], ["symbol", "timestamp"], codec)
