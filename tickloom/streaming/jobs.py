"""Streaming queries (STR-4..8, SNK-3, SNK-5, SNK-6, CMP-1).

Every query resumes from its checkpoint (STR-8). Offsets, state and results live in shared folders, so a
lost executor or a restarted driver repeats at most one micro-batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tickloom.functions import fixed_point
from tickloom.operators.completed import completed_total, last_prices
from tickloom.operators.latest import latest_prices
from tickloom.operators.windows import summary, window_stats
from tickloom.schemas import Dataset
from tickloom.sinks.offsets import RECORDS, failures, next_offsets, reports, with_offsets
from tickloom.sinks.publish import records
from tickloom.streaming.tables import KeyedTable, SliceTable


def _triggered(writer: DataStreamWriter, trigger: dict | None) -> DataStreamWriter:
    return writer.trigger(**(trigger or {"availableNow": True}))


@contextmanager
def _state_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """A query copies its session's settings when it starts, and its checkpoint keeps the number of partitions."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if number is not None:
        spark.conf.set(key, str(number))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_final(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    name: str | None = None,
    state_partitions: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """STR-4: each window once, after the watermark has closed it, appended to Parquet.

    State holds the open windows only, so a stream of few symbols needs few ``state_partitions``, however
    many trades it has; each costs a state store per stateful operator and micro-batch.
    """
    writer = df.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    with _state_partitions(df.sparkSession, state_partitions):
        return _triggered(writer, trigger).start()


def start_batches(
    df: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    mode: str = "append",
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A query whose micro-batches are handled by ``work(rows, batch_id)``."""
    writer = df.writeStream.outputMode(mode).foreachBatch(work).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _triggered(writer, trigger).start()


def start_latest_prices(
    prices: DataFrame, table: KeyedTable, checkpoint: str, *, name: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """STR-5, AGG-3: the keys changed by each micro-batch are upserted into ``table``."""
    return start_batches(
        latest_prices(prices), table.upsert, checkpoint, mode="update", name=name, trigger=trigger
    )


def start_push(df: DataFrame, name: str, sink: str = "console", checkpoint: str | None = None) -> StreamingQuery:
    """SNK-5: every change to a client, on the console or, for small results, in a memory table."""
    writer = df.writeStream.outputMode("update").format(sink).queryName(name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.start()


def start_publish(
    df: DataFrame, topic: str, path: str, dataset: Dataset, checkpoint: str, *, codec: str = "json", trigger: dict | None = None
) -> StreamingQuery:
    """SNK-1 on a stream: the valid rows of each micro-batch go to a folder of their own below a file topic, which a
    repeated micro-batch writes again, so no record is published twice. Invalid rows are left out."""

    def work(rows: DataFrame, batch: int) -> None:
        records(rows, topic, dataset, codec=codec).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return start_batches(df, work, checkpoint, trigger=trigger)


def start_publish_numbered(
    df: DataFrame,
    topic: str,
    path: str,
    dataset: Dataset,
    partitions: int,
    heads: KeyedTable,
    sent: SliceTable,
    checkpoint: str,
    *,
    order: str = "offset",
    codec: str = "json",
    trigger: dict | None = None,
) -> StreamingQuery:
    """SNK-1, SNK-7 on a stream: records with partitions and dense offsets that go on from micro-batch to micro-batch, and a
    report for each in ``sent``. ``heads`` keeps the next offsets and is written last: a repeated micro-batch starts from the same ones
    and writes the same folders."""

    def work(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        if batch <= heads.head(spark):
            return
        given = records(rows.withColumn("offset", F.col(order)), topic, dataset, codec=codec)
        folder = f"{path}/batch={batch}"
        with_offsets(given, partitions, heads=heads.at(spark, batch - 1)).write.mode("overwrite").parquet(folder)
        published = spark.read.schema(RECORDS).parquet(folder)
        sent.write(reports(published, failures(rows, topic, dataset)), batch)
        heads.upsert(next_offsets(published), batch)

    return start_batches(df, work, checkpoint, trigger=trigger)


def start_summary_changes(
    prices: DataFrame,
    size_ms: int,
    delay: str,
    table: KeyedTable,
    changes: SliceTable,
    checkpoint: str,
    *,
    digits: int | None = None,
    total_digits: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """STR-5, STR-3: the summary of every window that a micro-batch changed, open windows too.

    ``table`` keeps the window statistics by symbol and timestamp; ``changes`` gets (timestamp, total_price, symbols)
    of the changed windows, a slice per micro-batch. A window's newest row is its current summary.
    """
    stats = window_stats(prices, size_ms, delay=delay, digits=digits)

    def work(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        table.upsert(rows, batch)
        changed = table.slice(spark, batch).select("timestamp").distinct()
        current = table.at(spark, batch).join(changed, "timestamp", "left_semi")
        changes.write(summary(current, size_ms, digits=total_digits), batch)

    return start_batches(stats, work, checkpoint, mode="update", trigger=trigger)


class LateRows(StreamingQueryListener):
    """STR-7: counts the rows that streams drop as late, over all their progress. Register it with
    ``spark.streams.addListener`` before the queries start; reports arrive a moment after each micro-batch."""

    def __init__(self) -> None:
        self.by_query: dict[str, int] = {}
        self._running: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self._running.add(str(event.runId))
        self.by_query.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        dropped = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        query = str(event.progress.id)
        self.by_query[query] = self.by_query.get(query, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._running.discard(str(event.runId))

    def wait(self, seconds: float) -> None:
        """Until all reports of the queries that have ended are in; raises ``TimeoutError`` if they do not come in time."""
        end = time.monotonic() + seconds
        while self._running:
            if time.monotonic() > end:
                raise TimeoutError(f"no last report of {len(self._running)} queries after {seconds} seconds")
            time.sleep(0.02)

    @property
    def total(self) -> int:
        return sum(self.by_query.values())


def late_rows(query: StreamingQuery) -> int:
    """STR-7: rows dropped as late in the progress reports the query still keeps, for short runs; ``LateRows``
    counts all of a long-running stream."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def _fields(key: T.DataType, *columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField("symbol", key), *[T.StructField(n, t) for n, t in columns]])


@dataclass(frozen=True)
class MarketTables:
    """The tables kept by ``start_market``."""

    stats: SliceTable
    summary: SliceTable
    totals: SliceTable
    state: SliceTable
    prices: KeyedTable

    @classmethod
    def under(
        cls, base: str, key: T.DataType = T.StringType(), *, symbols: bool = False, snapshot_every: int = 100
    ) -> MarketTables:
        long, double = T.LongType(), T.DoubleType()
        listed = [T.StructField("all_symbols", T.ArrayType(key))] if symbols else []
        return cls(
            SliceTable(
                f"{base}/window_stats",
                _fields(key, ("count", long), ("avg_price", double), ("timestamp", long), ("last_price", double)),
            ),
            SliceTable(
                f"{base}/summary",
                T.StructType([
                    T.StructField("timestamp", long),
                    T.StructField("total_price", double),
                    T.StructField("symbols", T.ArrayType(key)),
                ]),
            ),
            SliceTable(
                f"{base}/completed_total",
                T.StructType([
                    T.StructField("timestamp", long),
                    T.StructField("total", double),
                    T.StructField("known", long),
                    *listed,
                ]),
            ),
            SliceTable(f"{base}/state", T.StructType([T.StructField("settled", T.StringType()), T.StructField("known", long)])),
            KeyedTable(
                f"{base}/last_prices",
                _fields(key, ("timestamp", long), ("last_price", double)),
                "symbol",
                snapshot_every,
            ),
        )


def start_market(
    prices: DataFrame,
    size_ms: int,
    delay: str,
    tables: MarketTables,
    checkpoint: str,
    *,
    digits: int | None = None,
    total_digits: int = 18,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Window statistics, summary and completed total of a trade stream, in one query.

    In append mode a micro-batch holds all windows the watermark has just closed, and windows close in time
    order. So a micro-batch is a whole slice of time: its summary is complete, and its completed total needs
    from the slices before only one row, the sum of all last prices and the number of symbols, and the last prices
    of the symbols that trade in the slice. The batch operators do the work; the state between slices is
    tables in the shared folder. The last prices are written last, so their head tells which slices are complete.
    """
    stats = window_stats(prices, size_ms, delay=delay, digits=digits, with_last=True)
    listed = "all_symbols" in tables.totals.schema.names

    def work(closed: DataFrame, batch: int) -> None:
        spark: SparkSession = closed.sparkSession
        if batch <= tables.prices.head(spark):
            return
        rows = tables.stats.write(closed, batch)
        before = tables.state.slice(spark, batch - 1)
        if rows.isEmpty():
            for table in (tables.summary, tables.totals):
                table.write(spark.createDataFrame([], table.schema), batch)
            tables.state.write(before if before is not None else spark.createDataFrame([("0", 0)], tables.state.schema), batch)
            tables.prices.upsert(spark.createDataFrame([], tables.prices.schema), batch)
            return
        tables.summary.write(summary(rows, size_ms, digits=total_digits), batch)
        now = last_prices(rows)
        carry = tables.prices.at(spark, batch - 1)
        few = None if carry is None else carry.join(now.select("symbol"), "symbol", "left_semi")
        kept = _others(before, few, total_digits)
        totals = completed_total(
            rows,
            size_ms,
            digits=total_digits,
            carry=carry if listed else few,
            others=None if listed or kept is None else (kept.select("settled").scalar(), kept.select("known").scalar()),
            symbols=listed,
        )
        tables.totals.write(totals, batch)
        tables.state.write(_settled(kept, now, total_digits), batch)
        tables.prices.upsert(now, batch)

    return start_batches(stats, work, checkpoint, name=name, trigger=trigger)


def _sums(prices: DataFrame, digits: int) -> DataFrame:
    """One row: the sum of last prices, as fixed point, and their number."""
    units = F.sum(fixed_point(F.col("last_price"), digits))
    return prices.agg(F.coalesce(units, F.lit(0)).alias("settled"), F.count("*").alias("known"))


def _others(before: DataFrame | None, few: DataFrame | None, digits: int) -> DataFrame | None:
    """One row: the state before a slice without the symbols that trade in it."""
    if before is None or few is None:
        return None
    gone = _sums(few, digits)
    kind = gone.schema["settled"].dataType
    return gone.select(
        (before.select(F.col("settled").cast(kind)).scalar() - F.col("settled")).alias("settled"),
        (before.select("known").scalar() - F.col("known")).alias("known"),
    )


def _settled(others: DataFrame | None, now: DataFrame, digits: int) -> DataFrame:
    """The state after a slice."""
    sums = _sums(now, digits)
    settled, known = F.col("settled"), F.col("known")
    if others is not None:
        settled, known = settled + others.select("settled").scalar(), known + others.select("known").scalar()
    return sums.select(settled.cast("string").alias("settled"), known.alias("known"))
