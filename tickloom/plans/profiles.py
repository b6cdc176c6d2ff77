"""The company dimension from cache to cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.dimension import refreshed_profiles
from tickloom.sinks.heads import CsvCache


def refresh_cache(
    cache: CsvCache,
    company_list: DataFrame,
    responses: DataFrame,
    *,
    industry: str | None = None,
    key: str = "symbol",
) -> DataFrame:
    """Reads the cache, refreshes it from the list and the responses and writes it as the cache's next version; returns
    the listed companies that were not found. A column of the cache that nothing fills is null."""
    spark = company_list.sparkSession
    refreshed, missing = refreshed_profiles(company_list, cache.read(spark), responses, industry=industry, key=key)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in cache.schema.fields if f.name not in refreshed.columns}
    cache.write(refreshed.withColumns(absent) if absent else refreshed)
    return missing

