"""File and in-memory sources (SRC-7..10)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.functions import null_if_token
from tickloom.schemas import BIG_TECH_LIST, COMPANY_LIST

MISSING_VALUE = "N/A"


def read_csv_cache(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame | None:
    """SRC-7: a cached CSV with header under a declared schema; None when there is no such path."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    settings = {"header": "true", "nullValue": MISSING_VALUE, "escape": '"', **options}
    try:
        cached = spark.read.schema(nullable).options(**settings).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    texts = [f.name for f in nullable.fields if isinstance(f.dataType, T.StringType)]
    return cached.withColumns({name: null_if_token(F.col(name)) for name in texts}) if texts else cached


def company_list(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """SRC-8: (symbol, security) of the listed companies."""
    return _listing(spark, path, fmt, COMPANY_LIST)


def big_tech_list(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """SRC-9: (company, country) of the big-tech list."""
    return _listing(spark, path, fmt, BIG_TECH_LIST)


def _listing(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
    listed = reader.format(fmt).load(path)
    return listed.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def tickers(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """SRC-10: a list of tickers as a frame."""
    return spark.createDataFrame([(name,) for name in names], "symbol string")
