"""Publishing records and files (SNK-1, SNK-2, SNK-4, SNK-7)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from tickloom.functions import epoch_seconds_now, to_millis
from tickloom.operators.frames import contract
from tickloom.schemas import Dataset
from tickloom.sources.files import MISSING_VALUE
from tickloom.sources.topics import encode


@dataclass(frozen=True)
class Delivery:
    """SNK-7: how many records went out and how many failed the contract."""

    delivered: int
    failed: int


def records(df: DataFrame, topic: str, dataset: Dataset, *, codec: str = "json") -> DataFrame:
    """(topic, key, value, offset) of the rows that satisfy the contract; the others are left out.

    ``offset`` is the row's own arrival order where it has one: a folder of files assigns none.
    """
    row = F.struct(*[f.name for f in dataset.schema.fields if f.name in df.columns])
    offset = F.col("offset").cast("bigint") if "offset" in df.columns else F.lit(None).cast("bigint")
    return df.where(contract(df, dataset)).select(
        F.lit(topic).alias("topic"),
        F.col(dataset.key).cast("string").alias("key"),
        encode(row, codec, dataset).alias("value"),
        offset.alias("offset"),
    )


def tombstones(df: DataFrame, topic: str, key: str) -> DataFrame:
    """Records that delete their key: the value is null."""
    offset = F.col("offset").cast("bigint") if "offset" in df.columns else F.lit(None).cast("bigint")
    return df.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.lit(None).cast("string").alias("value"),
        offset.alias("offset"),
    )


def _counted(df: DataFrame, topic: str, dataset: Dataset) -> tuple[DataFrame, Observation]:
    seen = Observation(f"publish {topic}")
    failed = F.count_if(~contract(df, dataset)).alias("failed")
    return df.observe(seen, F.count("*").alias("rows"), failed), seen


def _delivery(seen: Observation) -> Delivery:
    counts = seen.get
    return Delivery(counts["rows"] - counts["failed"], counts["failed"])


def publish(df: DataFrame, topic: str, path: str, dataset: Dataset, *, codec: str = "json") -> Delivery:
    """SNK-1, SNK-7: append the valid rows to a file topic, and count them in the same pass."""
    counted, seen = _counted(df, topic, dataset)
    records(counted, topic, dataset, codec=codec).write.mode("append").parquet(path)
    return _delivery(seen)


def publish_kafka(df: DataFrame, topic: str, servers: str, dataset: Dataset, *, codec: str = "avro") -> Delivery:
    """SNK-1 over Kafka."""
    counted, seen = _counted(df, topic, dataset)
    keyed = records(counted, topic, dataset, codec=codec).select("topic", "key", "value")
    keyed.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    return _delivery(seen)


def stamped(symbols: DataFrame) -> DataFrame:
    """SNK-2, PRJ-6: symbols with the time of publication, in milliseconds like all other times."""
    return symbols.withColumn("timestamp", to_millis(epoch_seconds_now(), "s"))


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-4: CSV with header, nulls as ``N/A``."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("nullValue", MISSING_VALUE)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(path)
    )
