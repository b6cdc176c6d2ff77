"""Definitions: list, look up, create once, drop (DDL-1..5). Spark's catalog and query manager hold them."""

from __future__ import annotations

from collections.abc import Callable
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.schemas import DATASETS, Dataset


class Kind(Enum):
    STREAM = "streams"
    TABLE = "tables"
    TOPIC = "topics"


class Catalog:
    """The named streams (running queries), tables and topics (registered datasets) of a session."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.topics: dict[str, Dataset] = {}

    def show(self, kind: Kind) -> list[str]:
        """DDL-1."""
        if kind is Kind.STREAM:
            return sorted(q.name for q in self.spark.streams.active if q.name)
        if kind is Kind.TABLE:
            return sorted(t.name for t in self.spark.catalog.listTables())
        return sorted(self.topics)

    def exists(self, kind: Kind, name: str) -> bool:
        """DDL-2. Names are compared without case, as Spark does."""
        return name.lower() in (known.lower() for known in self.show(kind))

    def create_view(self, name: str, df: DataFrame) -> bool:
        """DDL-3: name a frame, batch or stream; False when the name is taken."""
        if self.exists(Kind.TABLE, name):
            return False
        df.createTempView(name)
        return True

    def create_table(self, name: str, df: DataFrame) -> bool:
        """DDL-3, SNK-3: materialise a batch result as a table; False when the name is taken."""
        if self.exists(Kind.TABLE, name):
            return False
        df.write.saveAsTable(name)
        return True

    def start(self, name: str, launch: Callable[[], StreamingQuery]) -> StreamingQuery:
        """DDL-3: the running query of that name, or a new one."""
        for query in self.spark.streams.active:
            if query.name and query.name.lower() == name.lower():
                return query
        return launch()

    def drop(self, kind: Kind, name: str) -> bool:
        """DDL-4: drop if it exists; tells whether it did."""
        if not self.exists(kind, name):
            return False
        if kind is Kind.STREAM:
            for query in self.spark.streams.active:
                if query.name and query.name.lower() == name.lower():
                    query.stop()
        elif kind is Kind.TABLE:
            if not self.spark.catalog.dropTempView(name):
                self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        else:
            self.topics = {n: d for n, d in self.topics.items() if n.lower() != name.lower()}
        return True

    def register(self, name: str, path: str, layout: str | None = None) -> Dataset:
        """DDL-5: register a dataset at ``path`` under a declared layout, and check that the data has it."""
        declared = DATASETS[layout or name]
        actual = {f.name.lower(): f.dataType for f in self.spark.read.parquet(path).schema.fields}
        wrong = [
            f"{f.name}: {actual.get(f.name.lower(), 'absent')}"
            for f in declared.schema.fields
            if actual.get(f.name.lower()) != f.dataType and not (f.nullable and f.name.lower() not in actual)
        ]
        if wrong:
            raise ValueError(f"{name}: data at {path} does not fit: {', '.join(wrong)}")
        self.topics[name] = Dataset(name, declared.schema, declared.key, path)
        return self.topics[name]

    def read(self, name: str) -> DataFrame:
        """A registered dataset under its declared names and types."""
        dataset = self.topics[name]
        return self.spark.read.schema(dataset.schema).parquet(dataset.path)
