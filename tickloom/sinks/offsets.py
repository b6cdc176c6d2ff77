"""Partitions and offsets of published records, and a report for each (SNK-1, SNK-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.operators.frames import contract
from tickloom.operators.sequence import numbered
from tickloom.schemas import Dataset
from tickloom.sinks.publish import records

def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


#: What is known between micro-batches: the next offset of each partition.
NEXT_OFFSETS = _fields(topic=T.StringType(), partition=T.IntegerType(), next=T.LongType())
REPORTS = _fields(topic=T.StringType(), partition=T.IntegerType(), offset=T.LongType(), key=T.StringType(), status=T.StringType())
RECORDS = _fields(topic=T.StringType(), partition=T.IntegerType(), key=T.StringType(), value=T.StringType(), offset=T.LongType())


def partition_of(key: Column, partitions: int) -> Column:
    """The partition of a key: the first 32 bits of its MD5, modulo their number. A record without a key is in partition 0."""
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(bits, F.lit(partitions)).cast("int"), F.lit(0))


def with_offsets(rows: DataFrame, partitions: int, *, order: str = "offset", heads: DataFrame | None = None) -> DataFrame:
    """Records (topic, key, value and ``order``) with their partition and dense offsets in it, by ``order``.

    ``heads`` has the next offset of partitions that are not empty. A hot partition is sorted by many tasks.
    """
    placed = rows.select("topic", partition_of(F.col("key"), partitions).alias("partition"), F.col(order).alias("_order"), "key", "value")
    found = numbered(placed, ["_order"], "_number", within=["topic", "partition"])
    if heads is None:
        return found.select("topic", "partition", "key", "value", F.col("_number").alias("offset"))
    found = found.join(heads, ["topic", "partition"], "left")
    return found.select("topic", "partition", "key", "value", (F.col("_number") + F.coalesce("next", F.lit(0))).alias("offset"))


def next_offsets(published: DataFrame) -> DataFrame:
    """The next offset of each partition that has records here."""
    return published.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next"))


def reports(published: DataFrame, failed: DataFrame) -> DataFrame:
    """SNK-7: a row (topic, partition, offset, key, status) for each record; a failed one has neither partition nor offset."""
    sent = published.select("topic", "partition", "offset", "key", F.lit("delivered").alias("status"))
    return sent.unionByName(failed, allowMissingColumns=True).select(*REPORTS.names)


def failures(df: DataFrame, topic: str, dataset: Dataset) -> DataFrame:
    """The rows that break the contract, with the fields they lack as their status."""
    lacking = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in dataset.required]))
    return df.where(~contract(df, dataset)).select(
        F.lit(topic).alias("topic"), F.col(dataset.key).cast("string").alias("key"),
        F.concat(F.lit("failed: "), F.array_join(lacking, ",")).alias("status"),
    )


def publish_numbered(
    df: DataFrame, topic: str, path: str, dataset: Dataset, partitions: int, *, order: str = "offset", codec: str = "json"
) -> DataFrame:
    """SNK-1, SNK-7 in a batch: a new file topic, its records numbered by ``order`` in each partition; returns the reports."""
    given = records(df, topic, dataset, codec=codec) if order == "offset" else records(df.withColumn("offset", F.col(order)), topic, dataset, codec=codec)
    with_offsets(given, partitions).write.parquet(path)
    published = df.sparkSession.read.schema(RECORDS).parquet(path)
    return reports(published, failures(df, topic, dataset))
