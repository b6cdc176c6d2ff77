"""Quality rules as a short-circuit cascade.

A rule is a condition on one document; a document goes at the first rule it fails, and later rules are not
evaluated for it. The order comes from a sample: for each rule the share of documents it rejects and its seconds,
and the rules run in descending order of rejection per cost. The order changes the cost and the name of the first
failed rule, never the verdict.

Everything is a Spark expression on the text.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import let, materialise, whole, with_value, words

MIN_WORDS = 10
#: Documents in the sample that costs and selectivities are estimated on.
SAMPLE_ROWS = 2_000
#: The least time that a rule counts with: clocks tell no less.
LEAST_SECONDS = 0.001


@dataclass(frozen=True)
class Rule:
    """A name and the condition that rejects a document, made from its text and the array of its words."""

    name: str
    rejects: Callable[[Column, Column], Column]


def count(own: Column) -> Column:
    return F.size(own).cast("long")


def word_chars(own: Column) -> Column:
    """Code points in an array of words."""
    return F.char_length(F.array_join(own, "")).cast("long")


def n_chars_of(text: Column, chars: str) -> Column:
    """How many code points of the text are among chars, the inside of a character class."""
    return (F.size(F.split(text, f"[{chars}]")) - 1).cast("long")


def n_symbols(text: Column) -> Column:
    return n_chars_of(text, "#*$%&|<>")


def _word_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_word_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def many_dup_lines(text: Column) -> Column:
    """More than half of the lines with a word equal an earlier line."""
    return let(_word_lines(text), lambda lines: F.size(lines) > 2 * F.size(F.array_distinct(lines)))


def n_repeat_words(own: Column, width: int = 5) -> Column:
    """Of an array of words, those in windows of five that are found twice or more, the first time included.

    Hashes of the windows tell most texts without a repetition. For the others, windows are sorted as text, so
    that equal ones are neighbours, and the places of repeated ones are merged.
    """

    def hashes(places: Column) -> Column:
        return F.transform(places, lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(width)]))

    def windows(places: Column) -> Column:
        return F.transform(
            places, lambda i: F.struct(F.concat_ws(" ", *[F.get(own, i + k) for k in range(width)]).alias("w"), i.alias("i"))
        )

    def repeated(rows: Column) -> Column:
        same = F.filter(rows, lambda x, i: (x["w"] == F.get(rows, i - 1)["w"]) | (x["w"] == F.get(rows, i + 1)["w"]))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    places = F.sequence(F.lit(0), F.size(own) - width)
    heavy = let(let(F.sort_array(windows(places)), repeated), covered)
    once = let(hashes(places), lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when((F.size(own) < width) | once, F.lit(0)).otherwise(heavy).cast("long")


def n_stutters(own: Column) -> Column:
    """Words that equal the word before them."""
    return F.size(F.filter(own, lambda x, i: x == F.get(own, i - 1))).cast("long")


def base_failed(own: Column) -> Column:
    """Too few words, or over a fifth of them repeated."""
    return (count(own) < MIN_WORDS) | (100 * n_repeat_words(own) > 20 * count(own))


STANDARD = (
    Rule("base", lambda text, own: base_failed(own)),
    Rule("symbols", lambda text, own: 10 * n_symbols(text) > count(own)),
    Rule("duplicate_lines", lambda text, own: many_dup_lines(text)),
    Rule("stutter", lambda text, own: 4 * n_stutters(own) > count(own)),
    Rule("exclamations", lambda text, own: 4 * n_chars_of(text, "!") > count(own)),
    Rule("word_length", lambda text, own: ~word_chars(own).between(2 * count(own), 20 * count(own))),
)


def _seconds(sample: DataFrame, condition: Column) -> float:
    """The time that counting the rows of a condition takes: the shorter of two runs after one that only warms up."""
    times = []
    for _ in range(3):
        start = time.perf_counter()
        sample.where(condition).count()
        times.append(time.perf_counter() - start)
    return min(times[1:])


def net_order(names: Sequence[str], seconds: Mapping[str, float], rejected: Sequence[tuple[frozenset[str], int]]) -> list[str]:
    """Names by rejection per second, one after the other: a rule's rejections are those among the rows that the rules before it
    leave. rejected has the number of rows for each set of rules that reject them. Ties keep the given order."""
    order, left = [], list(names)
    while left:
        counts = {n: sum(k for own, k in rejected if n in own and not own & set(order)) for n in left}
        best = max(left, key=lambda n: ((counts[n] + 0.5) / seconds[n], -left.index(n)))
        order.append(best)
        left.remove(best)
    return order


def ordered(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per second on a sample of about sample_rows documents. A rule's seconds are those beyond the time of a
    condition that costs nothing, which is that of a job; its rejections are those that earlier rules leave."""
    rows = docs.count()
    if not rows:
        return list(rules)
    sample = docs.select("text")
    if rows > sample_rows:
        sample = sample.sample(fraction=sample_rows / rows, seed=5)
    text = whole("text")
    sample = materialise(sample.select(text.alias("text"), words(text).alias("words")), "rule-sample")
    rejects = [F.coalesce(rule.rejects(F.col("text"), F.col("words")), F.lit(False)) for rule in rules]
    idle = _seconds(sample, F.size("words") < 0)
    names = [str(i) for i in range(len(rules))]
    seconds = {n: max(_seconds(sample, c) - idle, LEAST_SECONDS) for n, c in zip(names, rejects)}
    flags = sample.select(*[c.alias(n) for n, c in zip(names, rejects)]).groupBy(*names).count().collect()
    rejected = [(frozenset(n for n in names if r[n]), r["count"]) for r in flags]
    return [rules[int(n)] for n in net_order(names, seconds, rejected)]


def _failed(rules: Sequence[Rule], text: Column, own: Column, known: Mapping[str, Column]) -> Column:
    """The name of the first rule that rejects, or null; known has conditions that are there already."""
    failed = F.lit(None).cast("string")
    for rule in reversed(rules):
        condition = known[rule.name] if rule.name in known else rule.rejects(text, own)
        failed = F.when(condition, F.lit(rule.name)).otherwise(failed)
    return failed


def cascade(docs: DataFrame, rules: Sequence[Rule] = STANDARD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with ``failed_rule``: the first rule, in the order of rejection per cost, that rejects the row, else null.

    Needs a column ``text``; null and empty texts have no words. A rule whose condition is null does not reject.
    Repeated rows have equal verdicts; an empty table stays empty. A column failed_rule of docs is replaced.
    """
    rows = _split(docs)
    failed = _failed(ordered(docs, rules, sample_rows), F.col("text"), F.col("words"), {}).alias("failed_rule")
    names = docs.columns if "failed_rule" in docs.columns else [*docs.columns, "failed_rule"]
    return rows.select(*[failed if c == "failed_rule" else F.col("row").getField(c).alias(c) for c in names])


def _split(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), text and words."""
    return with_value(docs.select(F.struct(*docs.columns).alias("row"), whole("text").alias("text")), "words", words(F.col("text")))


def accepted(docs: DataFrame, rules: Sequence[Rule] = STANDARD) -> DataFrame:
    """The rows that no rule rejects, with the columns of docs."""
    rows = _split(docs)
    failed = _failed(ordered(docs, rules), F.col("text"), F.col("words"), {})
    return rows.where(failed.isNull()).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def base_figures(docs: DataFrame, rules: Sequence[Rule] = STANDARD) -> DataFrame:
    """doc_id, the base figures of the text, base_failed, and kept: the cascade's verdict."""
    text, own = F.col("text"), F.col("words")
    rows = docs.select("doc_id", whole("text").alias("text"))
    rows = with_value(rows, "words", words(text))
    rows = with_value(rows.withColumn("n_words", count(own)), "n_repeat_words", n_repeat_words(own))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    for name, figure in (("word_chars", word_chars(own)), ("n_symbols", n_symbols(text)), ("n_dup_lines", n_dup_lines(text))):
        rows = with_value(rows, name, figure)
    # rules on figures that are there already
    known = {
        "base": F.col("base_failed"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "word_length": ~F.col("word_chars").between(2 * F.col("n_words"), 20 * F.col("n_words")),
    }
    first = _failed(ordered(docs, rules), text, own, known if rules is STANDARD else {})
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        first.isNull().alias("kept"),
    )
