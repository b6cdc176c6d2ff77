"""URL filter: host and path rules, and for the URLs without a rule a ratio of two character language models.

A rule names a host, which stands for its subdomains too, and the start of a path; the longest rule that fits decides.
The URLs that rules allow and block teach two Markov models of variable order: the chance of a character given
the three before it, smoothed with the shorter contexts (Witten and Bell), down to one in ``ALPHABET``. The mean
log-likelihood difference per character is the score, and the threshold is the one that separates best those decided
URLs that the models did not see.

Only Spark expressions are used. The models are tables of distinct four-character strings. A difference is
rounded to millionths, so that sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import materialise

ORDER = 3
ALPHABET = 256
_START, _STOP = "\x02", "\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty if it is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _grams(text: Column) -> Column:
    """Every character of a text, and its end, with the ORDER characters before it."""
    chars = F.split(F.concat(F.lit(_START * ORDER), text, F.lit(_STOP)), "")

    def each(own: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(own) - ORDER - 1),
            lambda i: F.concat(*[F.get(own, i + k) for k in range(ORDER + 1)]),
        )

    return F.get(F.transform(F.array(chars), each), F.lit(0))


def differences(grams: DataFrame) -> DataFrame:
    """gram, and the log-likelihood difference of its last character in millionths, for the distinct grams of rows of
    gram, kind (allow, block, or null for one that is not learnt from) and n."""
    seen = grams.where("kind is not null")
    orders = F.explode(F.array(*[F.lit(k) for k in range(ORDER + 1)]))
    cut = seen.withColumn("k", orders).withColumn("part", F.substr("gram", F.lit(ORDER + 1) - F.col("k")))
    counts = cut.groupBy("kind", "k", "part").agg(F.sum("n").alias("n"))
    before = F.substr(F.col("part"), F.lit(1), F.char_length("part") - 1)
    contexts = counts.groupBy("kind", "k", before.alias("before")).agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    wanted = grams.select("gram").distinct().withColumn("kind", F.explode(F.array(F.lit("allow"), F.lit("block"))))
    wanted = wanted.withColumn("k", orders).withColumn("part", F.substr("gram", F.lit(ORDER + 1) - F.col("k")))
    wanted = wanted.withColumn("before", before)
    found = wanted.join(counts, ["kind", "k", "part"], "left").join(contexts, ["kind", "k", "before"], "left")
    each = F.struct("k", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("types", F.lit(0)).alias("types"))
    rows = found.groupBy("gram", "kind").agg(F.sort_array(F.collect_list(each)).alias("orders"))
    chance = F.aggregate(
        "orders",
        F.lit(1.0 / ALPHABET),
        lambda p, x: F.when(x["total"] == 0, p).otherwise((x["n"] + x["types"] * p) / (x["total"] + x["types"])),
    )
    sign = F.when(F.col("kind") == "allow", 1).otherwise(-1)
    nats = rows.select("gram", (sign * F.round(F.ln(chance) * 1_000_000).cast("long")).alias("nats"))
    return nats.groupBy("gram").agg(F.sum("nats").alias("nats"))


def judged(pages: DataFrame, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), score (millionths per character; null for a decided URL).

    pages needs page_id and url. A null url, or one without ``://``, has empty host and path; where rules do not decide
    and host and path are empty, or one of the models has nothing to learn from, the URL is allowed. Repeated
    rows are judged alike; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own in sorted(rules, key=lambda r: len(str(r))):
        fits = own.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, F.lit(str(own))).otherwise(rule), F.when(fits, F.lit(own.verdict)).otherwise(verdict)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("kind"), F.concat("host", "path").alias("text"))
    # equal texts are counted and scored once
    texts = rows.where("text <> ''").groupBy("text", "kind").agg(F.count("*").alias("n"))
    held = F.substring(F.md5(F.col("text").cast("binary")), 1, 1) < "3"
    texts = materialise(texts.withColumn("held", held), "urls")
    exploded = texts.select("text", "kind", "n", "held", F.explode(_grams(F.col("text"))).alias("gram"))
    learnt = F.when(~F.col("held"), F.col("kind"))
    grams = exploded.groupBy("gram", learnt.alias("kind")).agg(F.sum("n").alias("n"))
    nats = materialise(differences(materialise(grams, "grams")), "models")

    needed = exploded.where("kind is null or held")
    scores = needed.join(nats, "gram").groupBy("text", "kind", "n").agg((F.sum("nats") / F.count("*")).alias("score"))
    scores = materialise(scores, "scores")
    kinds = texts.where("not held").agg(F.count_distinct("kind").alias("learnt"))
    step = F.floor(F.col("score") / 1000).alias("step")
    known = scores.where("kind is not null").groupBy(step).agg(
        F.sum(F.when(F.col("kind") == "allow", F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("kind") == "block", F.col("n")).otherwise(0)).alias("bad"),
    )
    below = W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    gain = F.coalesce(F.sum("bad").over(below) / F.sum("bad").over(every), F.lit(0.0))
    loss = F.coalesce(F.sum("good").over(below) / F.sum("good").over(every), F.lit(0.0))
    # every threshold above the step before is as good: the middle is taken
    middle = F.ceil((F.coalesce(F.lag("step").over(W.orderBy("step")), F.col("step")) + F.col("step")) / 2)
    known = known.where("good + bad > 0").select("step", middle.alias("middle"), (gain - loss).alias("gain"))
    best = known.agg(F.min(F.struct((-F.col("gain")).alias("gain"), "step", "middle")).alias("best")).select(
        F.coalesce("best.middle", F.lit(0)).alias("threshold")
    )
    learnt, threshold = kinds.first()["learnt"], best.first()["threshold"]
    fine = (F.lit(learnt) < 2) | (F.floor(F.col("score") / 1000) >= F.lit(threshold))
    decided = scores.where("kind is null").select("text", "score", fine.alias("fine"))
    rows = rows.join(decided, "text", "left")
    verdict = F.coalesce("kind", F.when(F.coalesce("fine", F.lit(True)), F.lit("allow")).otherwise(F.lit("block")))
    score = F.when(F.col("kind").isNull(), F.col("score"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))
