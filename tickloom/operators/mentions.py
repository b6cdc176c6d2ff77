"""Texts that contain names of a long list (FLT-3, AGG-7), without a pattern as long as the list.

An inverted index of grams finds the candidates: of each name the gram that the fewest texts have is its key, and a text is
compared with the names of its grams only. The list may hold any number of names; nothing is broadcast by hint, and no
text meets every name. The grams of the texts are many times the texts, which Spark's estimate of their size does not see: they
are joined by sorting, so they never lie in the driver or whole in an executor. ``dimension.match_companies`` stays for names
that are patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Characters of the longest grams: six digits of a number tell it from most others.
Q = 6


def _grams(text: Column, length: Column) -> Column:
    """The distinct grams of that length of a text that is not shorter."""
    starts = F.sequence(F.lit(1), F.char_length(text) - length + 1)
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, length)))


def mentions(texts: DataFrame, names: DataFrame, *, text: str = "name", company: str = "company", q: int = Q) -> DataFrame:
    """The rows of ``texts`` with ``company``, one for each name of ``names`` that is part of their text, whatever the case.

    A name counts once, however often the list or the text has it (names that differ in case are different). A null or empty name is
    part of nothing; a null text has no part. A name is looked for by grams of q characters, or of the most that it has of 1, 2, 4, ...
    """
    lengths = [*(2**k for k in range(q.bit_length()) if 2**k < q), q]
    listed = names.select(F.col(company).alias("company")).where("company IS NOT NULL AND company <> ''").distinct()
    listed = listed.withColumn("low", F.lower("company"))
    listed = listed.withColumn("length", F.greatest(*[F.when(F.char_length("low") >= k, k) for k in lengths], F.lit(1)))
    # grams of each length that some name is looked for by
    wanted = listed.agg(F.collect_set("length").alias("lengths")).scalar()
    low = F.lower(F.col(text))
    rows = texts.where(low.isNotNull() & (low != "")).select(F.struct(*texts.columns).alias("row"), low.alias("low"))
    rows = rows.withColumn("length", F.explode(F.array(*[F.lit(k) for k in lengths])))
    rows = rows.where(F.array_contains(wanted, F.col("length")) & (F.char_length("low") >= F.col("length")))
    postings = rows.select("row", "length", F.explode(_grams(F.col("low"), F.col("length"))).alias("gram"))
    often = postings.groupBy("length", "gram").agg(F.count("*").alias("texts"))

    named = listed.select("company", F.col("low").alias("sought"), "length", F.explode(_grams(F.col("low"), F.col("length"))).alias("gram"))
    # a name with a gram that no text has is in no text
    rarity = named.join(often.hint("merge"), ["length", "gram"], "left").groupBy("company", "sought", "length").agg(
        F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "gram")).alias("best")
    )
    keys = rarity.where("best.texts > 0").select("company", "sought", "length", F.col("best.gram").alias("gram"))
    found = postings.hint("merge").join(keys, ["length", "gram"]).where(F.contains(F.lower(F.col("row")[text]), "sought"))
    return found.select("row.*", F.col("company").alias(company))
