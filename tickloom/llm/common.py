"""Reading tables, splitting words and keeping intermediate tables, for all operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import shared_dir

#: White space between words: blank and the five ASCII controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_value(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is evaluated once per row. It comes out of a one-element explode, so the optimizer
    cannot copy its expression into later filters and functions."""
    return df.drop(name).select("*", F.explode(F.array(value)).alias(name))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes a table below the shared checkpoint folder and reads it back: its lineage ends there, and the
    loss of an executor costs nothing that has been written."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
