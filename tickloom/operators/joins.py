"""Equi-joins with a keyed table (JOIN-1..4): left, semi and anti.

The physical join is Spark's choice. Nothing here hints a broadcast: the optimizer's estimate of a table is
scaled from its compressed files and can be a hundredth of its size. With the settings of
``session.build_session`` a join starts as a shuffle, and adaptive execution makes it a broadcast when the
measured size of the shuffled table allows, or splits the partitions of heavy keys. Rows without a key match
nothing and are spread evenly, so they form no heavy partition of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SPREAD = 1024


def unique_per(table: DataFrame, key: str) -> DataFrame:
    """One row per key: of several, the greatest by the other columns in their order."""
    others = [c for c in table.columns if c != key]
    if not others:
        return table.select(key).distinct()
    rows = table.groupBy(key).agg(F.max(F.struct(*others)).alias("_row"))
    return rows.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in table.columns])


def keyed_join(left: DataFrame, table: DataFrame, key: str, how: str) -> DataFrame:
    """``left``, ``left_semi`` or ``left_anti`` join of all rows of ``left``, which is read once.

    A key's rows in ``table`` count as one (``unique_per``), so a left join never multiplies rows. On a stream
    the table is joined as it stands at each micro-batch.
    """
    if how not in ("left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join {how!r}")
    if how == "left":
        table = unique_per(table, key)
    if left.isStreaming:
        return left.join(table, key, how)
    # always 0 for a key that can match; the optimizer must not see that, or it would drop the column
    slot = F.pmod(F.hash(key), F.lit(1))
    spread = F.when(F.col(key).isNull(), F.floor(F.rand(11) * SPREAD).cast("int") + 1).otherwise(slot)
    joined = left.withColumn("_slot", spread).join(table.withColumn("_slot", slot), [key, "_slot"], how).drop("_slot")
    rest = [c for c in table.columns if c != key] if how == "left" else []
    return joined.select(*left.columns, *rest)


def known(df: DataFrame, table: DataFrame, key: str = "symbol") -> DataFrame:
    """JOIN-3, FLT-4: rows whose key is in ``table``."""
    return keyed_join(df, table.select(key), key, "left_semi")


def unknown(df: DataFrame, table: DataFrame, key: str = "symbol") -> DataFrame:
    """JOIN-2: rows whose key is not in ``table``; rows without a key count as unknown."""
    return keyed_join(df, table.select(key), key, "left_anti")


def with_company_symbols(prices: DataFrame, company_symbols: DataFrame) -> DataFrame:
    """JOIN-1: every trade with its symbol's registration time, null when the symbol is not registered.

    On a stream this joins the table as it stands at each micro-batch.
    """
    table = company_symbols.select("symbol", F.col("timestamp").alias("registered_at"))
    return keyed_join(prices, table, "symbol", "left")
