"""Company dimension: incremental refresh and name matching (JOIN-2..4, SET-1, FLT-2, FLT-3, AGG-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import name_regex
from tickloom.operators.frames import normalise_nulls, rename
from tickloom.operators.joins import known, unknown
from tickloom.schemas import PROFILE_COLUMNS


def rename_profile_columns(responses: DataFrame, industry: str | None = None) -> DataFrame:
    """PRJ-2 for profile responses. ``industry`` is the vendor's name of the industry field."""
    return rename(responses, {**PROFILE_COLUMNS, **({industry: "industry"} if industry else {})})


def new_companies(company_list: DataFrame, profiles: DataFrame | None, key: str = "symbol") -> DataFrame:
    """JOIN-2: listed companies without a cached profile; all of them when there is no cache."""
    return company_list if profiles is None else unknown(company_list, profiles, key)


def known_companies(profiles: DataFrame, company_list: DataFrame, key: str = "symbol") -> DataFrame:
    """JOIN-3: cached profiles that are still on the list."""
    return known(profiles, company_list, key)


def _flagged(company_list: DataFrame, profiles: DataFrame | None, responses: DataFrame, key: str) -> DataFrame:
    """A row per key with what the list, the cache and the responses have of it, as structs.

    The three tables are laid under each other and grouped: each is read once and moved once. Several rows of a
    key in one table count as one, the greatest. Rows without a key have nothing to be looked up by.
    """
    sides = {"listed": company_list, "cached": profiles, "answer": responses}
    tables = [
        side.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.struct(*side.columns).alias(name))
        for name, side in sides.items()
        if side is not None
    ]
    laid = tables[0]
    for other in tables[1:]:
        laid = laid.unionByName(other, allowMissingColumns=True)
    present = [name for name, side in sides.items() if side is not None]
    return laid.groupBy("_key").agg(*[F.max(name).alias(name) for name in present])


def refresh(
    company_list: DataFrame, profiles: DataFrame | None, responses: DataFrame, key: str = "symbol"
) -> tuple[DataFrame, DataFrame]:
    """JOIN-2..4, SET-1: the refreshed dimension, and the listed companies not found.

    Cached profiles of listed companies stay; the other listed companies get the profile of their response,
    if there is one. Columns are those of the cache, then those only the responses have.
    """
    rows = _flagged(company_list, profiles, responses, key).where("listed IS NOT NULL")
    own = profiles.columns if profiles is not None else []
    columns = [*own, *[c for c in responses.columns if c not in own]]

    def value(name: str) -> Column:
        kept = F.col(f"cached.{name}") if name in own else F.lit(None)
        found = F.col(f"answer.{name}") if name in responses.columns else F.lit(None)
        return (F.when(F.col("cached").isNotNull(), kept).otherwise(found) if own else found).alias(name)

    held = F.col("answer").isNotNull() | F.col("cached").isNotNull() if own else F.col("answer").isNotNull()
    return rows.where(held).select(*[value(c) for c in columns]), rows.where(~held).select("listed.*")


def refreshed_profiles(
    company_list: DataFrame,
    profiles: DataFrame | None,
    responses: DataFrame,
    *,
    industry: str | None = None,
    key: str = "symbol",
) -> tuple[DataFrame, DataFrame]:
    """The whole refresh: responses renamed, refreshed with the cache, NaN as null; and the companies not found."""
    refreshed, missing = refresh(company_list, profiles, rename_profile_columns(responses, industry), key)
    return normalise_nulls(refreshed), missing


def company_pattern(companies: DataFrame, country: str | None = "US") -> DataFrame:
    """FLT-2, AGG-7: one row with the ``|``-joined names of a country's companies, ``Inc.`` as ``Inc``.

    Names are sorted, for a stable text. The list is a curated one and its text is a single value; of an
    empty list it is the empty text, which matches every name.
    """
    chosen = companies if country is None else companies.where(F.col("country") == country)
    return chosen.agg(F.expr("listagg(company, '|') WITHIN GROUP (ORDER BY company)").alias("pattern")).select(
        F.replace(F.coalesce("pattern", F.lit("")), F.lit("Inc."), F.lit("Inc")).alias("pattern")
    )


def match_names(profiles: DataFrame, pattern: str, *, name: str = "name", quote: bool = False) -> DataFrame:
    """FLT-3: profiles whose name contains a match of the pattern, in any case; a null name never does."""
    if name not in profiles.columns:
        raise KeyError(f"profiles have no column {name!r}")
    return profiles.where(F.coalesce(F.col(name).rlike(name_regex(pattern, quote)), F.lit(False)))


def match_companies(
    profiles: DataFrame, companies: DataFrame, country: str | None = "US", *, name: str = "name"
) -> DataFrame:
    """FLT-3 with the pattern of a company list, which stays inside the query, whatever its length."""
    if name not in profiles.columns:
        raise KeyError(f"profiles have no column {name!r}")
    regex = F.concat(F.lit(name_regex("")), company_pattern(companies, country).scalar())
    return profiles.where(F.coalesce(F.rlike(F.col(name), regex), F.lit(False)))
