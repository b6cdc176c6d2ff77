"""Audit of how filters interact: what each removes after every choice of others before it.

Each filter has a table of the ids of the documents that fail it (``failing_ids``). What a filter removes does not depend
on the order of those before it, so for every set of earlier filters (31 at most with five) the survivors are computed
by left-anti joins with these tables, a level of sets after the other, and what the next filter removes by left-semi
joins: documents, and those with labels. An order of filters is then read off, step by step, from the sets it passes.

An id is two 64-bit numbers: the doc_id, or a hash of the text where there is none, and a hash of the text. Rows with the
same id and part fail the same filters; they are one row with their number.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialise, whole, with_value, words
from tickloom.operators.joins import keyed_join

FILTERS = "ABCDE"
#: Tasks that the rows of one text are spread over where copies are looked for.
SPREAD = 16


def text_failures(words_: Column, text: Column) -> dict[str, Column]:
    """The conditions of filters A to D: few words, few different words, many capitals, symbols."""
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words_) < 200,
        "B": 100 * F.size(F.array_distinct(words_)) < 50 * F.size(words_),
        "C": 100 * capitals > 2 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def described(docs: DataFrame) -> DataFrame:
    """one, two (the id), doc_id, part (source, empty if null), digest (of the text), n (equal rows) and the failures A to D."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), whole("text").alias("text"))
    rows = with_value(rows, "words", words(F.col("text")))
    rows = rows.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        *[c.alias(f) for f, c in text_failures(F.col("words"), F.col("text")).items()],
    )
    rows = rows.groupBy("doc_id", "part", "digest").agg(F.count("*").alias("n"), *[F.first(f).alias(f) for f in "ABCD"])
    return rows.select(F.coalesce("doc_id", F.xxhash64("digest", F.lit(1))).alias("one"), F.xxhash64("digest").alias("two"), *rows.columns)


def copies(rows: DataFrame) -> DataFrame:
    """one, two of the rows whose text a smaller doc_id has. Rows of a text are spread over ``SPREAD`` groups, and the smallest doc_id
    of each text that several have goes to all of them."""
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("most > least")
    firsts = firsts.select("digest", "least", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("slot"))
    slot = F.pmod(F.xxhash64("one", "part"), F.lit(SPREAD)).cast("int").alias("slot")
    found = rows.select("one", "two", "doc_id", "digest", slot).join(firsts, ["digest", "slot"])
    return found.where("doc_id > least").select("one", "two")


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """For each filter the written table of the ids that fail it."""
    tables = {f: rows.where(f).select("one", "two") for f in "ABCD"} | {"E": copies(rows)}
    return {f: materialise(t, f"failing-{f}") for f, t in tables.items()}


def interactions(rows: DataFrame, failing: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(part, passed, filter, removed, good_lost, toxic_lost) for each set of earlier filters and each other filter, and
    (part, passed, kept) for each set. rows has one, two, part, n, good and toxic; passed has bit i for the i-th filter."""
    names = list(failing)
    bits = [F.lit(1 << i) for i in range(len(names))]
    fails = [t.select(bit.alias("filter"), "one", "two") for t, bit in zip(failing.values(), bits)]
    fails = materialise(_union(fails), "failing")
    key = ["filter", "one", "two"]
    survivors = rows.select("one", "two", "part", "n", "good", "toxic", F.lit(0).alias("passed"))
    removed, kept = [], [_kept(survivors)]
    for level in range(len(names)):
        after = F.array(*bits)
        steps = survivors.withColumn("filter", F.explode(F.filter(after, lambda f: F.col("passed").bitwiseAND(f) == 0)))
        gone = steps.join(fails, key, "left_semi").groupBy("part", "passed", "filter")
        gone = gone.agg(F.sum("n").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))
        removed.append(materialise(gone, f"removed-{level}"))
        # each set is reached once, by its filters in their own order
        left = steps.where("filter > passed").join(fails, key, "left_anti")
        left = left.select("one", "two", "part", "n", "good", "toxic", F.col("passed").bitwiseOR(F.col("filter")).alias("passed"))
        if level + 1 < len(names):
            survivors = materialise(left, f"survivors-{level + 1}")
            kept.append(_kept(survivors))
        else:
            kept.append(_kept(left))
    return _union(removed), _union(kept)


def _kept(survivors: DataFrame) -> DataFrame:
    return survivors.groupBy("part", "passed").agg(F.sum("n").alias("kept"))


def _union(tables: list[DataFrame]) -> DataFrame:
    first, *others = tables
    for t in others:
        first = first.unionByName(t)
    return first


def _orders(names: list[str]) -> Column:
    """All orders of the filters, step by step: an array of filter_order, step, passed (before) and bit (of this filter)."""
    found = []
    for order in permutations(range(len(names))):
        passed, text = 0, "".join(names[i] for i in order)
        for step, i in enumerate(order):
            found.append({"filter_order": text, "step": step + 1, "passed": passed, "bit": 1 << i})
            passed |= 1 << i
    return F.from_json(F.lit(json.dumps(found)), "array<struct<filter_order:string,step:int,passed:int,bit:int>>")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part (source, empty if null), filter_order (all orders of the filters) and step: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley, as document counts within the part, zeros included.

    docs needs doc_id, text and source, labels doc_id, quality and toxic; other columns are ignored. A null text is empty:
    it fails A and nothing else of A to D. Rows without a doc_id have no smaller one and no label, fail no E and make no other row fail
    it. Repeated rows are documents of their own; those that share a doc_id are no copies of each other. Of several
    labels of a doc_id one of quality 1 or toxic 1 is enough. An empty table gives no rows. Redundant are the documents that a filter
    removes when it comes first and no longer at this step.
    """
    rows = materialise(described(docs), "described")
    failing = failing_ids(rows)
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    labelled = keyed_join(rows.select("one", "two", "doc_id", "part", "n"), marks, "doc_id", "left")
    number = lambda c: (F.coalesce(c, F.lit(0)) * F.col("n")).cast("long").alias(c)
    labelled = materialise(labelled.select("one", "two", "part", "n", number("good"), number("toxic")), "labelled")
    removed, kept = interactions(labelled, failing)

    # a part has at most 80 removals and 32 sets: they are two maps
    figures = F.struct("removed", "good_lost", "toxic_lost")
    removals = removed.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("passed", "filter"), figures))).alias("removals")
    )
    sets = kept.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("passed", "kept"))).alias("sets"))
    table = sets.join(removals, "part", "left").select("part", "sets", "removals", F.inline(_orders(list(failing))))
    everything = (1 << len(failing)) - 1

    def of(passed: Column, figure: str) -> Column:
        return F.coalesce(F.col("removals")[F.struct(passed.alias("passed"), F.col("bit").alias("filter"))][figure], F.lit(0))

    n = len(failing)
    shapley = F.lit(0)
    for passed in range(1 << n):
        weight = factorial(passed.bit_count()) * factorial(max(n - 1 - passed.bit_count(), 0))
        shapley = shapley + F.when(F.lit(passed).bitwiseAND(F.col("bit")) == 0, weight * of(F.lit(passed), "removed")).otherwise(0)
    now = F.col("passed")
    return table.select(
        "part", "filter_order", "step",
        F.coalesce(F.col("sets")[now.bitwiseOR(F.col("bit"))], F.lit(0)).alias("kept"),
        of(now, "removed").alias("removed"),
        (of(F.lit(0), "removed") - of(now, "removed")).alias("redundant"),
        of(F.lit(everything) - F.col("bit"), "removed").alias("unique_fails"),
        of(now, "good_lost").alias("good_lost"),
        of(now, "toxic_lost").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
