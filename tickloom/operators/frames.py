"""Projections and row filters (PRJ-*, FLT-*, DST-1, SET-1, LIM-1). Narrow: none of them shuffles,
except the top-n of LIM-1 and the distinct of DST-1."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.functions import null_if_nan, to_event_time
from tickloom.schemas import Dataset


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """PRJ-2: rename by map; other columns stay, absent names are ignored."""
    return df.withColumnsRenamed(dict(names))


def with_event_time(df: DataFrame, source: str = "column", arrival: str | None = None) -> DataFrame:
    """STR-6: add ``event_time`` from the ``timestamp`` column (epoch ms) or from record arrival.

    ``arrival`` names the column with the arrival time, for example the transport's own timestamp or
    the source file's modification time; without one the query's clock is used.
    """
    if source == "column":
        return df.withColumn("event_time", to_event_time(F.col("timestamp")))
    if source == "arrival":
        return df.withColumn("event_time", F.col(arrival) if arrival else F.current_timestamp())
    raise ValueError(f"unknown event time source {source!r}")


def normalise_nulls(df: DataFrame) -> DataFrame:
    """FLT-9: NaN becomes null in every floating-point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: null_if_nan(F.col(name)) for name in floats}) if floats else df


def contract(df: DataFrame, dataset: Dataset) -> Column:
    """FLT-5: true where every required field of ``dataset`` has a value."""
    absent = set(dataset.required) - set(df.columns)
    if absent:
        raise ValueError(f"{dataset.name}: missing columns {sorted(absent)}")
    return reduce(Column.__and__, (F.col(name).isNotNull() for name in dataset.required))


def valid(df: DataFrame, dataset: Dataset) -> DataFrame:
    """FLT-5: the records that satisfy the contract."""
    return df.where(contract(df, dataset))


def quarantined(df: DataFrame, dataset: Dataset) -> DataFrame:
    """FLT-5: the other records, each with the names of the fields it lacks."""
    lacking = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in dataset.required]))
    return df.where(~contract(df, dataset)).withColumn("lacking", lacking)


def live(df: DataFrame, value: str = "value") -> DataFrame:
    """FLT-7: drop tombstones."""
    return df.where(F.col(value).isNotNull())


def route(df: DataFrame, topic: str) -> DataFrame:
    """FLT-8: the records of one topic."""
    return df.where(F.col("topic") == topic)


def distinct_symbols(df: DataFrame, key: str = "symbol") -> DataFrame:
    """DST-1: every symbol once. Repeats collapse before the shuffle, so a hot symbol costs nothing."""
    return df.select(key).distinct()


def union_by_name(first: DataFrame | None, second: DataFrame | None) -> DataFrame:
    """SET-1: all rows of both; either side may be absent, missing columns are null."""
    present = [df for df in (first, second) if df is not None]
    if not present:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def first_messages(messages: DataFrame, n: int | None, order: Sequence[str] = ("offset",)) -> DataFrame:
    """LIM-1: the first ``n`` data messages in arrival order; no limit when ``n`` is None or 0.

    Counts messages, not trades. The top-n keeps ``n`` rows per task and merges them.
    """
    return messages.orderBy(*order).limit(n) if n else messages
