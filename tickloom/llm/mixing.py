"""Mixing sources to target weights by Pareto order sampling.

A source's target share, divided by its size, is the number of copies each of its documents is expected to get. The
whole part is certain. The rest is an inclusion probability p, and a document's rank is its random odds divided
by its inclusion odds, (u / (1 - u)) / (p / (1 - p)). The documents of lowest rank get one more copy, as many as
bring the source's words nearest to its target: a sample of fixed size, in words.

u is a hash of doc_id and the seed, so reruns agree. Only Spark expressions are used. The place of a document in its
source's order is found without sorting a source in one task: ranks are cut into narrow classes, the words of the
classes are summed, and only the class in which the target is reached is put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import materialise, whole, words

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
#: Classes that the ranks of a source are cut into.
RANK_CLASSES = 1 << 16


def _unit(seed: int) -> Column:
    """A number between 0 and 1 for each doc_id: 52 bits of a hash."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"/mix/{seed}"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(4503599627370496.0)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target from rows of source and source_size; one row per source.

    Sources in code point order, null last, get the weights in turn. Each target is the weight times one level,
    or most_copies times the source's size where that is less; the level is where the targets sum to all sizes.
    """
    place = W.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(w) for w in weights])
    own = sizes.withColumn("w", F.get(kinds, F.pmod(F.row_number().over(place) - 1, F.lit(len(weights)))))
    own = own.withColumn("cap", F.col("source_size") * most_copies)
    total = F.sum("source_size").over(W.partitionBy())
    full = F.col("cap") / F.col("w")
    order = [F.col("full").asc(), F.col("source").asc_nulls_last()]
    back = [F.col("full").desc(), F.col("source").desc_nulls_first()]
    own = own.withColumn("total", total).withColumn("full", full)
    own = own.withColumn("caps", F.sum("cap").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col("cap"))
    own = own.withColumn("ws", F.sum("w").over(W.orderBy(*back).rowsBetween(W.unboundedPreceding, 0)))
    # with ever more sources held at their cap, in ascending order, the level rises up to the right one, then falls
    level = F.max((F.col("total") - F.col("caps")) / F.col("ws")).over(W.partitionBy())
    target = F.least(F.col("cap").cast("double"), F.col("w") * level)
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target)
    return own.select("source", "source_size", target.alias("target"))


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size and u of each row, and the row itself in d."""
    size = F.size(words(whole("text"))).cast("long")
    rows = docs.select(F.struct(*docs.columns).alias("d"), F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"))
    return rows.withColumn("u", _unit(seed))


def _with_rank(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """rows with their source's share, their rank q and its class."""
    rank = (F.col("u") / (1 - F.col("u"))) / (F.col("part") / (1 - F.col("part")))
    shares = shares.withColumnRenamed("source", "s")
    rows = rows.join(shares, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    rows = rows.withColumn("q", F.when(F.col("part") > 0, rank))
    # q / (1 + q) rises with q from 0 to 1 and is finest where the target is reached, near q = 1
    return rows.withColumn("class", F.floor(F.col("q") / (1 + F.col("q")) * RANK_CLASSES).cast("int"))


def _decided(docs: DataFrame, weights: Sequence[int], most_copies: int, seed: int, rows_too: bool) -> DataFrame:
    """The sized rows with their copies; with the rows themselves in d if rows_too."""
    every = _sized(docs, seed)
    narrow = materialise(every.drop("d"), "mix")
    shares = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_copies)
    copies = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.col("target") / F.col("source_size"))
    shares = shares.withColumn("certain", F.floor(copies)).withColumn("part", copies - F.floor(copies))
    shares = materialise(shares.withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size")), "shares")

    sums = _with_rank(narrow, shares).where("q is not null")
    sums = sums.groupBy("source", "class").agg(F.sum("size").alias("n"), F.first("rest").alias("rest"))
    upto = F.sum("n").over(W.partitionBy("source").orderBy("class").rowsBetween(W.unboundedPreceding, 0))
    cut = sums.withColumn("upto", upto).where("upto >= rest")
    # the class in which the target is reached, and the words before it
    cut = cut.groupBy("source").agg(F.min(F.struct("class", (F.col("upto") - F.col("n")).alias("before"))).alias("cut"))
    cut = materialise(cut.select(F.col("source").alias("s"), F.col("cut.class").alias("cut"), F.col("cut.before").alias("before")), "cut")

    ranked = _with_rank(every if rows_too else narrow, shares)
    ranked = ranked.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    inside = F.col("q").isNotNull() & (F.col("class") < F.coalesce("cut", F.lit(RANK_CLASSES + 1)))
    edge = F.coalesce(F.col("class") == F.col("cut"), F.lit(False))
    order = W.partitionBy("source").orderBy("q", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    run = F.col("before") + F.sum("size").over(order) - F.col("size") / 2
    sure = ranked.where(~edge).withColumn("copies", F.col("certain") + inside.cast("long"))
    near = ranked.where(edge).withColumn("copies", F.col("certain") + (run <= F.col("rest")).cast("long"))
    return sure.unionByName(near)


def mixed(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_copies: int = MOST_COPIES, seed: int = 0
) -> DataFrame:
    """A row for each of docs: doc_id, source, size (words), source_size, target, copies, taken (size * copies).

    docs needs doc_id, text and source. Null and empty texts have size 0; a null source is a source, the last
    one. Rows of equal doc_id, source and size are alike, whichever of them gets a copy. A document gets at
    most most_copies copies. An empty table gives an empty result.
    """
    rows = _decided(docs, weights, most_copies, seed, False)
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "copies")
    return rows.withColumn("taken", F.col("size") * F.col("copies"))


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_copies: int = MOST_COPIES, seed: int = 0) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with the columns of docs and no others."""
    rows = _decided(docs, weights, most_copies, seed, True).where("copies > 0")
    return rows.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select("d.*")
