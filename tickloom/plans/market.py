"""The whole chain, composed from the operators in dependency order. Nothing runs until a result is used."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.completed import completed_total
from tickloom.operators.frames import normalise_nulls, valid
from tickloom.operators.latest import company_symbols, latest_prices
from tickloom.operators.windows import SECOND_MS, summary, window_stats
from tickloom.schemas import DATASETS
from tickloom.sources.messages import trades_from_messages


@dataclass(frozen=True)
class Market:
    """The results of a backfill over stored trades and symbols."""

    company_symbols: DataFrame
    latest_prices: DataFrame
    window_stats: DataFrame
    summary: DataFrame
    completed_total: DataFrame


def prices_from_messages(messages: DataFrame, text: str = "value") -> DataFrame:
    """Raw feed texts with an ``offset`` to the (offset, symbol, price, timestamp) of their valid trades.

    A NaN, which JSON readers let through, counts as no value. A trade's offset is a struct of its message's
    offset and its place in the message, which orders like a number.
    """
    trades = normalise_nulls(trades_from_messages(messages, text, keep=["offset"]))
    trades = valid(trades, DATASETS["trades"])
    offset = F.struct(F.col("offset").alias("message"), "position").alias("offset")
    return trades.select(offset, "symbol", "price", "timestamp")


def backfill(
    prices: DataFrame,
    symbols: DataFrame,
    size_ms: int = SECOND_MS,
    *,
    digits: int | None = None,
    total_digits: int = 18,
    list_symbols: bool = False,
) -> Market:
    """Batch form of the chain; ``streaming.jobs`` runs the same operators on streams."""
    stats = window_stats(prices, size_ms, digits=digits, with_last=True)
    return Market(
        company_symbols=company_symbols(symbols),
        latest_prices=latest_prices(prices),
        window_stats=stats.drop("last_price"),
        summary=summary(stats, size_ms, digits=total_digits),
        completed_total=completed_total(stats, size_ms, digits=total_digits, symbols=list_symbols),
    )
