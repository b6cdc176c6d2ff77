"""Feed messages: JSON envelopes to trades (SRC-6, SCL-1, FLT-1, FLT-6, PRJ-2, PRJ-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.frames import rename
from tickloom.schemas import MESSAGE, TRADE_COLUMNS

JSON_SPACE = " \t\n\r"


def parse(messages: DataFrame, text: str = "value") -> DataFrame:
    """Add ``message``, the parsed envelope. A field of the wrong type is null; a malformed text is all null.

    The envelope goes through a one-element ``explode``: a plain column would be copied into every filter
    and projection that uses it, and the text parsed again in each.
    """
    options = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    envelope = F.from_json(F.col(text), MESSAGE, options)
    # Nothing may follow the object, as a strict JSON reader demands; Spark's own reader would ignore it.
    complete = F.when(F.endswith(F.rtrim(F.col(text), F.lit(JSON_SPACE)), F.lit("}")), envelope)
    return messages.select("*", F.explode(F.array(complete)).alias("message"))


def _is_ping() -> Column:
    return F.coalesce(F.col("message.type") == "ping", F.lit(False))


def _has_data() -> Column:
    return F.col("message.type").isNotNull() & F.col("message.data").isNotNull()


def data_messages(parsed: DataFrame) -> DataFrame:
    """FLT-1: messages that carry a record array, possibly empty; pings and rejects are gone."""
    return parsed.where(~_is_ping() & _has_data())


def rejected_messages(parsed: DataFrame) -> DataFrame:
    """FLT-6: messages the feed handler skips, with the reason."""
    reason = F.when(F.col("message.type").isNull() & F.col("message.data").isNull(), "malformed").when(
        F.col("message.type").isNull(), "no type"
    )
    return parsed.where(~_is_ping() & ~_has_data()).select(
        *[c for c in parsed.columns if c != "message"], F.coalesce(reason, F.lit("no data")).alias("reason")
    )


def explode_trades(data: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-3: one row per trade under the record's names; ``keep`` are message columns to carry along.

    ``position`` is the place in the message: (offset, position) is the arrival order of trades.
    """
    rows = data.select(*keep, F.posexplode("message.data").alias("position", "trade"))
    return rename(rows.select(*keep, "position", "trade.*"), TRADE_COLUMNS)


def trades_from_messages(messages: DataFrame, text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """SRC-6: raw feed texts, batch or stream, to trades."""
    return explode_trades(data_messages(parse(messages, text)), keep)
