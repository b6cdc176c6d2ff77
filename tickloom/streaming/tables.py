"""Tables kept by streaming queries (SNK-3): an upserted table and a table of finished slices.

Both are folders of Parquet, one ``batch=<id>`` folder per micro-batch, written whole. A micro-batch that
is run again after a failure overwrites its own folder, so the result is the same.

A keyed table is read up to its head, the last micro-batch that is complete. The head is written after the data, in
turn to one of two folders, so that one of them is whole at any time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.sinks.heads import read_head, write_head


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType())])


@dataclass(frozen=True)
class SliceTable:
    """Rows that are final when written; every micro-batch adds its own."""

    path: str
    schema: T.StructType

    def write(self, rows: DataFrame, batch: int) -> DataFrame:
        """Write one slice and return it as read back, so that later steps do not compute it again."""
        folder = f"{self.path}/batch={batch}"
        rows.select(*self.schema.names).write.mode("overwrite").parquet(folder)
        return rows.sparkSession.read.schema(self.schema).parquet(folder)

    def newest(self, spark: SparkSession, key: str) -> DataFrame:
        """Of rows that later slices replace, the last one per key."""
        rows = spark.read.schema(_with_batch(self.schema)).parquet(self.path)
        columns = [c for c in self.schema.names if c != key]
        return rows.groupBy(key).agg(*[F.max_by(c, "batch").alias(c) for c in columns]).select(*self.schema.names)

    def slice(self, spark: SparkSession, batch: int) -> DataFrame | None:
        """The rows of one micro-batch; None before the first."""
        return None if batch < 0 else spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_with_batch(self.schema)).parquet(self.path).select(*self.schema.names)


@dataclass(frozen=True)
class KeyedTable:
    """Latest row per key. A micro-batch writes the keys it changed; every ``snapshot_every``-th one writes
    all keys, so that reading never goes further back than that, and what lies two snapshots back is emptied."""

    path: str
    schema: T.StructType
    key: str | Sequence[str]
    snapshot_every: int = 100

    @property
    def keys(self) -> list[str]:
        return [self.key] if isinstance(self.key, str) else list(self.key)

    def _latest(self, rows: DataFrame) -> DataFrame:
        columns = [c for c in self.schema.names if c not in self.keys]
        latest = rows.groupBy(*self.keys).agg(*[F.max_by(c, "batch").alias(c) for c in columns])
        return latest.select(*self.schema.names)

    def _folder(self, batch: int) -> str:
        return f"{self.path}/batch={batch}"

    def head(self, spark: SparkSession) -> int:
        """The last complete micro-batch; -1 before the first."""
        return read_head(spark, self.path)

    def at(self, spark: SparkSession, batch: int) -> DataFrame | None:
        """The table after micro-batch ``batch``, of the last two snapshots; None before the first."""
        if batch < 0:
            return None
        snapshot = batch - batch % self.snapshot_every
        folders = [self._folder(b) for b in range(snapshot, batch + 1)]
        reader = spark.read.schema(_with_batch(self.schema)).option("basePath", self.path)
        return self._latest(reader.parquet(*folders))

    def slice(self, spark: SparkSession, batch: int) -> DataFrame:
        """What one micro-batch wrote: the keys it changed, or all keys in a snapshot."""
        return spark.read.schema(self.schema).parquet(self._folder(batch))

    def read(self, spark: SparkSession) -> DataFrame:
        """The table after the last complete micro-batch."""
        last = self.at(spark, self.head(spark))
        return spark.createDataFrame([], self.schema) if last is None else last

    def upsert(self, rows: DataFrame, batch: int) -> None:
        """Write the rows of one micro-batch, unique per key. A micro-batch that is complete is left as it is."""
        spark = rows.sparkSession
        if batch <= self.head(spark):
            return
        for key in self.keys:
            rows = rows.where(F.col(key).isNotNull())
        rows = rows.select(*self.schema.names)
        if batch and batch % self.snapshot_every == 0:
            before = self.at(spark, batch - 1).withColumn("batch", F.lit(batch - 1))
            rows = self._latest(before.unionByName(rows.withColumn("batch", F.lit(batch))))
        rows.write.mode("overwrite").parquet(self._folder(batch))
        write_head(spark, self.path, batch)
        old = batch - 2 * self.snapshot_every
        if old >= 0:
            spark.createDataFrame([], self.schema).coalesce(1).write.mode("overwrite").parquet(self._folder(old))
