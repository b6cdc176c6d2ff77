"""Document fingerprints by I-Match with randomised lexicons.

Terms are words with A-Z lower-cased, by their 64-bit hash. A term is in the lexicon if its normalised inverse document
frequency, ln(N / df) / ln N over all documents, lies in a band: neither so common that all texts have it nor so rare that it
is noise. Of a text, the distinct terms in the lexicon are kept, in order of their hashes. Several random lexicons are parts
of this one, in chains from a quarter down to 1/1024 of its terms; each gives one hash of the terms left. A text of many
terms uses the smaller parts only, from the smallest in which at least ``ENOUGH`` of its terms are left, and only the terms
in these parts are looked up. The fingerprint is these hashes. The likeness of two texts looks, in each chain, at the
smallest lexicon that has terms of either.

Only Spark expressions are used.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import let, materialise, whole, with_value, words

BAND = (0.1, 0.9)
#: Random lexicons: chains of ever smaller parts, each a quarter of the one before; a chain's bits of a term's hash
#: begin STEP bits after those of the chain before.
CHAINS, LEVELS, STEP = 12, 5, 3
#: Terms of a text, inside and outside the lexicon, that are left in the largest part it uses, at least.
ENOUGH = 2
#: Ids whose neighbours are looked for in one group of rows, and blocks whose order is found in one.
ID_BLOCK, BLOCKS = 1024, 4096
_PATTERNS = [int(x) for x in np.random.default_rng(3).integers(0, 4**LEVELS, CHAINS)]


def _terms(text: Column) -> Column:
    """Hashes of the distinct words of a text."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.transform(words(lower), lambda w: F.xxhash64(w)))


def frequencies(docs: DataFrame) -> DataFrame:
    """term (hash) and df, its exact document frequency over all rows."""
    return docs.select(F.explode(_terms(whole("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def first_level(terms: Column) -> Column:
    """The number of the largest parts that a text of these terms uses."""
    level = F.floor(F.log(F.greatest(F.size(terms), F.lit(1)) / F.lit(float(ENOUGH))) / F.log(F.lit(4.0)))
    return F.greatest(F.lit(1), F.least(F.lit(LEVELS), level)).cast("int")


def used(terms: Column, level: Column) -> Column:
    """The terms that lie in a part of that level, of any chain."""
    mask = F.element_at(F.array(*[F.lit(4**k - 1).cast("long") for k in range(1, LEVELS + 1)]), level)

    def inside(h: Column) -> Column:
        differ = lambda j: F.shiftrightunsigned(h, STEP * j).bitwiseXOR(F.lit(_PATTERNS[j]).cast("long")).bitwiseAND(mask)
        found = differ(0) == 0
        for j in range(1, CHAINS):
            found = found | (differ(j) == 0)
        return found

    return F.filter(terms, inside)


def lexicon_hashes(terms: Column, first: Column) -> Column:
    """The fingerprint of the terms of a text that are in the lexicon, from level first on: 32 bits for each part, null where it
    has none of them or is not used."""

    def down(chain: Column, level: int, terms: Column) -> Column:
        """The hash of the terms left at a level, followed by those of the levels below."""
        short = F.shiftright(F.xxhash64(terms), 32).cast("int")
        own = F.array(F.when((F.size(terms) > 0) & (first <= level), short))
        return own if level == LEVELS else F.concat(own, further(chain, level + 1, terms))

    def further(chain: Column, level: int, terms: Column) -> Column:
        shift, wanted = chain[f"shift{level}"], chain[f"wanted{level}"]
        part = F.filter(terms, lambda h: F.call_function("shiftrightunsigned", h, shift).bitwiseAND(F.lit(3)) == wanted)
        return let(part, lambda left: down(chain, level, left))

    # one expression for all chains: what the driver plans and keeps does not grow with them
    chains = F.array(*[_chain(number) for number in range(CHAINS)])
    return let(F.sort_array(terms), lambda terms: F.flatten(F.transform(chains, lambda chain: further(chain, 1, terms))))


def _chain(number: int) -> Column:
    """For each level of a chain, how far a term's hash is shifted, and the two bits that it must have then."""
    levels = range(1, LEVELS + 1)
    shifts = [F.lit(STEP * number + 2 * level - 2).alias(f"shift{level}") for level in levels]
    return F.struct(*shifts, *[F.lit((_PATTERNS[number] >> (2 * level - 2)) & 3).cast("long").alias(f"wanted{level}") for level in levels])


def as_text(own: Column) -> Column:
    """A fingerprint as hex digits, eight for each lexicon; dashes where there is no hash."""
    digits = F.transform(own, lambda h: F.coalesce(F.lower(F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), F.lit("-" * 8)))
    return F.array_join(digits, "")


def likeness(one: Column, two: Column) -> Column:
    """The share of chains whose smallest lexicon with terms of either text has the same of both; 1 if the texts
    have no terms at all."""

    def pair(place: Column) -> Column:
        a, b = F.get(one, place), F.get(two, place)
        return F.when(a.isNotNull() | b.isNotNull(), F.coalesce((a == b).cast("int"), F.lit(0)))

    # null for a chain without terms of either
    places = F.array(*[F.lit(j * LEVELS) for j in range(CHAINS)])
    chains = F.transform(places, lambda at: F.coalesce(*[pair(at + k) for k in reversed(range(LEVELS))]))

    def share(used: Column) -> Column:
        equal = F.aggregate(used, F.lit(0), lambda upto, chain: upto + chain)
        return F.when(F.size(used) == 0, 1.0).otherwise(equal / F.size(used))

    return let(F.filter(chains, lambda chain: chain.isNotNull()), share)


def followed(docs: DataFrame, tie: Column | None = None) -> DataFrame:
    """docs with ``next``, a struct of the row's columns that comes after it in descending order of doc_id; after the
    last row comes the first.

    Rows lie in blocks of ids. A copy of the first row of each block ends the block above, so no order goes
    beyond a block. Ties go by tie, a hash of the text if not given; rows without a doc_id come last, in blocks by tie.
    """
    lowest = -(1 << 62)
    rows = docs.withColumn("__tie", F.xxhash64("text") if tie is None else tie)
    block = F.coalesce(F.floor(F.col("doc_id") / ID_BLOCK), F.lit(lowest) + F.shiftright("__tie", 50))
    order = [F.desc_nulls_last("doc_id"), F.desc("__tie")]
    rows = rows.withColumn("__block", block).withColumn("__copy", F.lit(0))
    heads = rows.groupBy("__block").agg(
        F.max(F.struct(F.coalesce("doc_id", F.lit(lowest)), "__tie", F.struct(*docs.columns).alias("row"))).alias("head")
    )
    # the block above each: in groups of blocks, and over one row per group
    blocks = rows.select("__block").distinct().withColumn("__group", F.floor(F.col("__block") / BLOCKS))
    groups = blocks.groupBy("__group").agg(F.min("__block").alias("least"))
    groups = groups.select("__group", F.lag("least").over(W.orderBy(F.desc("__group"))).alias("__border"))
    above = F.lag("__block").over(W.partitionBy("__group").orderBy(F.desc("__block")))
    last = rows.agg(F.min("__block").alias("__block")).scalar()
    blocks = blocks.withColumn("__above", above).join(groups, "__group")
    blocks = blocks.select("__block", F.coalesce("__above", "__border", last).alias("__above"))
    heads = heads.join(blocks, "__block").select("head.row.*", F.col("__above").alias("__block"), F.lit(1).alias("__copy"))
    heads = heads.withColumn("__tie", F.lit(0).cast("long"))
    both = rows.unionByName(heads)
    # column by column: a struct of them would be made, and moved, before the exchange
    following = W.partitionBy("__block").orderBy("__copy", *order)
    both = both.withColumns({f"__next_{c}": F.lead(c).over(following) for c in docs.columns})
    following = F.struct(*[F.col(f"__next_{c}").alias(c) for c in docs.columns])
    return both.where("__copy = 0").select(*docs.columns, following.alias("next"))


def _edited() -> Column:
    """The text of a row with its last third replaced by the beginning of the next row's."""
    third = F.floor(F.char_length("text") / 3).cast("int")
    return F.concat(F.substr("text", F.lit(1), F.char_length("text") - third), F.substr("next.text", F.lit(1), third))


def gathered(pairs: DataFrame) -> DataFrame:
    """For each tag, the terms of the text (own) and of the edited text (other), a head and the number of heads.

    Rows move before any are grouped: the terms of a text lie apart until then, and sets begun where they lie hold one or two
    terms each and take more bytes than the terms themselves.
    """
    of = lambda bit: F.collect_set(F.when(F.col("in").bitwiseAND(F.lit(bit).cast("byte")) > 0, F.col("term")))
    return pairs.repartition("tag").groupBy("tag").agg(
        of(1).alias("own"), of(2).alias("other"), F.max("head").alias("head"), F.count("head").alias("rows")
    )


def _marked(rows: DataFrame) -> DataFrame:
    """doc_id, tie, n_chars, edited_sha256, own and other: the fingerprints of each text and of its edited text.

    Each row is a head and its terms that count, 16 bytes and a mark each; those that join the terms of the lexicon come together
    again with the head. Rows alike in doc_id, text and next are one group, and its heads are counted.
    """
    counted = materialise(frequencies(rows), "term-counts")
    size = rows.count()
    idf = F.log(F.lit(float(size)) / F.col("df")) / F.log(F.lit(float(max(size, 2))))
    # at most a text's mean number of terms times N^0.1: they need not move to be left out
    common = counted.where(idf < BAND[0]).agg(F.collect_list("term").alias("common")).scalar()
    inside = counted.where(idf.between(*BAND)).select("term", F.lit(True).alias("inside"))

    pairs = followed(rows).select(
        "doc_id", "text", F.xxhash64("text").alias("tie"),
        F.xxhash64("doc_id", "text", "next.doc_id", "next.text").alias("tag"), _edited().alias("edited"),
    )

    def counting(text: str) -> Column:
        """The level of a text and its terms that count."""
        struct = lambda terms, level: F.struct(level.alias("level"), used(terms, level).alias("terms"))
        return let(_terms(F.col(text)), lambda terms: let(first_level(terms), lambda level: struct(terms, level)))

    pairs = with_value(with_value(pairs, "own", counting("text")), "other", counting("edited"))
    pairs = with_value(pairs, "one", F.array_except("own.terms", common))
    pairs = with_value(pairs, "two", F.array_except("other.terms", common))
    one, two = F.col("one"), F.col("two")
    marked = lambda terms, mark: F.transform(terms, lambda h: F.struct(h.alias("term"), F.lit(mark).cast("byte").alias("in"), none.alias("head")))
    head = F.struct(
        "doc_id", "tie", F.char_length("text").cast("long").alias("n_chars"), F.unhex(F.sha2(F.col("edited"), 256)).alias("sha"),
        F.col("own.level").alias("own_level"), F.col("other.level").alias("other_level"),
    )
    none = F.lit(None).cast("struct<doc_id:bigint,tie:bigint,n_chars:bigint,sha:binary,own_level:int,other_level:int>")
    heads = F.array(F.struct(F.col("tag").alias("term"), F.lit(0).cast("byte").alias("in"), head.alias("head")))
    # in: whether a term is of the text (1), of the edited text (2) or of both (3)
    pairs = pairs.select("tag", F.inline(F.concat(
        heads, marked(F.array_intersect(one, two), 3), marked(F.array_except(one, two), 1), marked(F.array_except(two, one), 2)
    )))
    pairs = pairs.join(inside, "term", "left").where("head is not null or inside").select("tag", "term", "in", "head")
    found = gathered(pairs).select(
        "head.doc_id", "head.tie", "head.n_chars", F.col("head.sha").alias("edited_sha256"),
        lexicon_hashes(F.col("own"), F.col("head.own_level")).alias("own"),
        lexicon_hashes(F.col("other"), F.col("head.other_level")).alias("other"),
        F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))).alias("copy"),
    )
    return materialise(found.drop("copy"), "fingerprints")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """A row for each of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third replaced by the beginning of the next document in descending order of doc_id.
    docs needs doc_id and text; a null text is empty. Texts without terms in the band have a fingerprint of dashes and
    are alike. Repeated rows are documents of their own. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    marked = _marked(rows)
    rows = followed(marked.withColumn("near_edited", likeness(F.col("own"), F.col("other"))), F.col("tie"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        "near_edited",
        likeness(F.col("own"), F.col("next.own")).alias("near_next"),
    )
