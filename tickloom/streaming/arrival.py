"""Streams that answer in the order of arrival (JOIN-1, JOIN-1b, JOIN-5, AGG-10, AGG-11, STR-5, LIM-1).

A micro-batch is a slice of the order: what came in earlier ones lies before all its rows. So each job runs the batch
operator on its slice and lays the last values of the slices before in front of it. Those are tables in the shared
folder, kept by key; a slice reads the rows of its own keys. The keyed table is written last, and its head says which
slices are complete: a micro-batch that is repeated after a failure writes the same folders again, or does nothing.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions import fixed_point, null_if_nan
from tickloom.operators.arrival import completed_in_order
from tickloom.operators.asof import CHUNK_ROWS, as_of, running_latest
from tickloom.operators.frames import first_messages
from tickloom.operators.latest import price_changes
from tickloom.schemas import LATEST_PRICES
from tickloom.streaming.jobs import start_batches
from tickloom.streaming.tables import KeyedTable, SliceTable


def _carry(table: KeyedTable, spark: SparkSession, batch: int, keys: DataFrame) -> DataFrame | None:
    """The rows of a slice's own keys as they were before it."""
    before = table.at(spark, batch - 1)
    return None if before is None else before.join(keys.select(table.key).distinct(), table.key, "left_semi")


def start_as_of(
    events: DataFrame,
    changes: DataFrame,
    key: str,
    values: Sequence[str],
    table: KeyedTable,
    out: SliceTable,
    checkpoint: str,
    *,
    order: str = "offset",
    chunk: int | None = CHUNK_ROWS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """JOIN-1, JOIN-1b on streams: each event with ``values`` of its key's last change when it arrived.

    Changes that came in an earlier micro-batch are in force; those of the same one are laid in ``order`` with the events. ``table``
    keeps the last change of each key (its columns are ``key`` and ``values``), ``out`` gets the events' columns and ``values``. Where
    both streams are in order and advance together that is the as-of join of all rows; a change that comes late is
    seen from then on only.
    """
    sides = events.select(F.struct(*events.columns).alias("event")).unionByName(
        changes.select(F.struct(*changes.columns).alias("change")), allowMissingColumns=True
    )

    def work(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        if batch <= table.head(spark):
            return
        asked, new = rows.where("event IS NOT NULL").select("event.*"), rows.where("change IS NOT NULL").select("change.*")
        carry = _carry(table, spark, batch, asked)
        out.write(as_of(asked, new, key, values, order=order, chunk=chunk, carry=carry), batch)
        # the last change counts as a whole, null values too
        last = new.where(F.col(order).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*values), order).alias("last"))
        table.upsert(last.select(key, "last.*"), batch)

    return start_batches(sides, work, checkpoint, trigger=trigger)


#: What ``start_price_changes`` writes: a row for each record.
CHANGES = T.StructType([T.StructField("offset", T.LongType()), *LATEST_PRICES.fields])


def start_price_changes(
    prices: DataFrame, table: KeyedTable, out: SliceTable, checkpoint: str, *, chunk: int | None = CHUNK_ROWS, trigger: dict | None = None
) -> StreamingQuery:
    """STR-5, SNK-5: for each record the row of the table of latest prices after it, in ``out``. ``table`` keeps that table,
    null where no price is known."""

    def work(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        if batch <= table.head(spark):
            return
        carry = _carry(table, spark, batch, rows)
        out.write(price_changes(rows, chunk=chunk, carry=carry), batch)
        at = rows.select("offset", "symbol", null_if_nan(F.col("price")).alias("price"), F.col("timestamp").alias("at"))
        latest = running_latest(at, "symbol", {"price": "last_price", "at": "timestamp"}, chunk=chunk, carry=carry)
        last = latest.groupBy("symbol").agg(F.max_by(F.struct("last_price", "timestamp"), "offset").alias("last"))
        table.upsert(last.select("symbol", "last.*"), batch)

    return start_batches(prices, work, checkpoint, trigger=trigger)


@dataclass(frozen=True)
class ArrivalTables:
    """The tables kept by ``start_completed_in_order``."""

    totals: SliceTable
    state: SliceTable
    prices: KeyedTable

    @classmethod
    def under(cls, base: str, key: T.DataType = T.StringType(), snapshot_every: int = 100) -> ArrivalTables:
        long, double = T.LongType(), T.DoubleType()
        fields = lambda *columns: T.StructType([T.StructField(n, t) for n, t in columns])
        return cls(
            SliceTable(f"{base}/totals", fields(("position", long), ("timestamp", long), ("total", double), ("known", long))),
            SliceTable(f"{base}/state", fields(("settled", T.StringType()), ("known", long))),
            KeyedTable(f"{base}/last_prices", fields(("symbol", key), ("last_price", double)), "symbol", snapshot_every),
        )


def start_completed_in_order(
    prices: DataFrame,
    summaries: DataFrame,
    tables: ArrivalTables,
    checkpoint: str,
    *,
    digits: int,
    chunk: int | None = CHUNK_ROWS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """JOIN-5, AGG-10, AGG-11: each summary completed with the prices before it in the sequence of both topics.

    The streams have the columns of ``operators.arrival.completed_in_order``; a micro-batch may hold any run of the sequence. Its
    state is the last price of each symbol, their sum and their number.
    """
    sides = prices.select("position", "symbol", "last_price").withColumn("summary", F.lit(False)).unionByName(
        summaries.select("position", "timestamp", "total_price", "symbols").withColumn("summary", F.lit(True)), allowMissingColumns=True
    )

    def work(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        if batch <= tables.prices.head(spark):
            return
        new = rows.where("NOT summary AND symbol IS NOT NULL AND position IS NOT NULL").select("position", "symbol", "last_price")
        new = new.where(null_if_nan(F.col("last_price")).isNotNull())
        asked = rows.where("summary").select("position", "timestamp", "total_price", "symbols")
        keys = new.select("symbol").unionByName(asked.select(F.explode("symbols").alias("symbol")))
        carry = _carry(tables.prices, spark, batch, keys)
        state = tables.state.slice(spark, batch - 1)
        kind = new.select(fixed_point(F.col("last_price"), digits).alias("units")).agg(F.sum("units").alias("units")).schema["units"].dataType
        base = None
        if state is not None:
            base = (state.select(F.col("settled").cast(kind)).scalar(), state.select("known").scalar())
        tables.totals.write(completed_in_order(new, asked, digits=digits, chunk=chunk, carry=carry, base=base), batch)

        last = new.groupBy("symbol").agg(F.max_by("last_price", "position").alias("last_price"))
        moved = last.select("symbol", fixed_point(F.col("last_price"), digits).alias("now"))
        old = F.lit(None).cast(moved.schema["now"].dataType).alias("old")
        if carry is not None:
            moved = moved.join(carry.select("symbol", fixed_point(F.col("last_price"), digits).alias("old")), "symbol", "left")
        else:
            moved = moved.select("*", old)
        settled = F.coalesce(F.sum(F.col("now") - F.coalesce("old", F.lit(0))), F.lit(0))
        sums = moved.agg(settled.alias("settled"), F.count_if(F.col("old").isNull()).alias("known"))
        if base is not None:
            sums = sums.select((F.col("settled") + base[0]).alias("settled"), (F.col("known") + base[1]).alias("known"))
        tables.state.write(sums.select(F.col("settled").cast("string").alias("settled"), "known"), batch)
        tables.prices.upsert(last, batch)

    return start_batches(sides, work, checkpoint, trigger=trigger)


def start_first_messages(
    messages: DataFrame, limit: int, out: SliceTable, counts: SliceTable, checkpoint: str, *, order: Sequence[str] = ("offset",), trigger: dict | None = None
) -> StreamingQuery:
    """LIM-1 on a stream: the first ``limit`` data messages over all micro-batches, no more and no fewer.

    Each micro-batch writes what is left of the bound, cut by ``order``, to ``out`` and the number so far to ``counts`` (column n), from which a
    restart goes on. Then the query has nothing to do: ``stop_when_full`` ends it.
    """

    def work(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        before = counts.slice(spark, batch - 1)
        so_far = before.first()["n"] if before is not None else 0
        left = limit - so_far
        taken = out.write(first_messages(rows, left, order) if left > 0 else rows.limit(0), batch)
        counts.write(taken.agg((F.count("*") + F.lit(so_far)).alias("n")), batch)

    return start_batches(messages, work, checkpoint, trigger=trigger)


def stop_when_full(spark: SparkSession, query: StreamingQuery, counts: SliceTable, limit: int, seconds: float = 0.2) -> None:
    """Waits until a query of ``start_first_messages`` has its messages, or ends, and stops it."""
    while query.isActive:
        progress = query.lastProgress
        if progress is not None and counts.read(spark).agg(F.max("n")).first()[0] >= limit:
            query.stop()
        time.sleep(seconds)
