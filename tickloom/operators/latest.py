"""Latest value per key (AGG-1, AGG-2, AGG-3, AGG-11).

``max_by`` aggregates partially before the shuffle: each task sends one row per key, so a key that holds
a third of all rows is no heavier than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import null_if_nan
from tickloom.operators.asof import CHUNK_ROWS, running_latest


def latest_value(value: str, offset: str = "offset") -> Column:
    """AGG-1: the non-null value with the highest offset (a null order key is ignored by ``max_by``)."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(offset)))


def latest_by_offset(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], offset: str = "offset"
) -> DataFrame:
    """One row per key with the latest value of each column, ``columns`` mapping input to output name.

    Columns are resolved independently, and rows without a key belong to no group.
    """
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(*[latest_value(c, offset).alias(name) for c, name in columns.items()])


def company_symbols(symbols: DataFrame) -> DataFrame:
    """AGG-2: (symbol, timestamp), the latest registration of every symbol."""
    return latest_by_offset(symbols, ["symbol"], {"timestamp": "timestamp"})


def latest_prices(prices: DataFrame, default: float = 0.0) -> DataFrame:
    """AGG-3: (symbol, last_price, timestamp); columns are resolved independently, and NaN is no price.

    The defining query also left-joins the company symbols, selects none of their columns and has one
    such row per symbol. That join cannot change the result, so it is left out here;
    ``joins.with_company_symbols`` is the join itself.
    """
    prices = prices.withColumn("price", null_if_nan(F.col("price")))
    latest = latest_by_offset(prices, ["symbol"], {"price": "last_price", "timestamp": "timestamp"})
    return latest.withColumn("last_price", F.coalesce("last_price", F.lit(default)))


def price_changes(prices: DataFrame, default: float = 0.0, *, chunk: int | None = CHUNK_ROWS, carry: DataFrame | None = None) -> DataFrame:
    """STR-5, SNK-5: for each record of the trades, the row of ``latest_prices`` after it: (offset, symbol, last_price, timestamp).

    ``carry`` is the table (symbol, last_price, timestamp) before these records, null where no price is known; ``default`` fills in only
    here.
    """
    rows = prices.select(
        F.col("offset"), F.col("symbol"), null_if_nan(F.col("price")).alias("price"), F.col("timestamp").alias("at")
    )
    columns = {"price": "last_price", "at": "timestamp"}
    found = running_latest(rows, "symbol", columns, chunk=chunk, carry=carry)
    return found.select("offset", "symbol", F.coalesce("last_price", F.lit(default)).alias("last_price"), "timestamp")
