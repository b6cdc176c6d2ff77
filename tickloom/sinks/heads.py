"""Heads: which version of a table is complete.

A version is written whole into a folder of its own; then its number is written to one of two head folders, in turn.
One of the two is whole at any time, so a reader always finds a complete version, also while the next is written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.sinks.publish import write_csv
from tickloom.sources.files import read_csv_cache


def read_head(spark: SparkSession, path: str) -> int:
    """The last complete version of the table at ``path``; -1 before the first."""
    found = [-1]
    for turn in (0, 1):
        try:
            found += [r["version"] for r in spark.read.schema("version bigint").parquet(f"{path}-head/{turn}").collect()]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return max(found)


def write_head(spark: SparkSession, path: str, version: int) -> None:
    head = spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
    head.coalesce(1).write.mode("overwrite").parquet(f"{path}-head/{version % 2}")


class CsvCache:
    """SRC-7, SNK-4: a CSV cache that can be read while it is replaced by what was made from it."""

    def __init__(self, path: str, schema: T.StructType) -> None:
        self.path, self.schema = path, schema

    def read(self, spark: SparkSession) -> DataFrame | None:
        version = read_head(spark, self.path)
        return None if version < 0 else read_csv_cache(spark, f"{self.path}/version={version}", self.schema)

    def write(self, rows: DataFrame) -> None:
        """The next version. The one before stays, for readers that have begun with it; older ones may be removed."""
        spark = rows.sparkSession
        version = read_head(spark, self.path) + 1
        write_csv(rows.select(*self.schema.names), f"{self.path}/version={version}")
        write_head(spark, self.path, version)
