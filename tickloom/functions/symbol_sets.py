"""Set expressions over symbol arrays (DST-2, SET-2, SET-3)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickloom.functions.scalars import strip_control_all


def unique_symbols(symbols: Column) -> Column:
    """DST-2: cleaned symbols without repeats."""
    return F.array_distinct(strip_control_all(symbols))


def missing_symbols(known: Column, symbols: Column) -> Column:
    """SET-2: known symbols that are not in this summary."""
    return F.array_sort(F.array_except(known, symbols))


def known_symbols(missing: Column, symbols: Column) -> Column:
    """SET-3: all symbols, sorted."""
    return F.array_sort(F.array_union(missing, symbols))
