"""Substring dedup: passages that repeat, exactly or nearly, across or inside documents.

Paragraphs are cut by content, so that equal passages fall into equal paragraphs whatever stands around them, line breaks
included: one begins at each word whose hash (with the next word's) is the least among ``RADIUS`` words on both sides, about
every 13 words. Line breaks are white space like any other.

1. Each paragraph has MinHash values of its five-word shingles, in bands tuned for a wanted recall at the threshold.
2. Paragraphs that share a band are joined, the exact Jaccard similarity decides, and components of like paragraphs
   are found. Of each component the first (by doc_id, then place) stays. Chance joins more and more paragraphs as the table
   grows; in a large cluster only those are compared that have one of their first shingles in common, as similar ones do.
3. Others that follow each other as their first ones do are a run. At both ends it is compared word by word with what
   stands around the paragraphs that stay, so that it grows to the whole shared passage.
4. Runs that few words separate, here and there, are one passage if it is at least ``SIMILARITY`` alike by its
   shingles. Passages of at least ``MIN_WORDS`` words are found, at their code points.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import materialise
from tickloom.llm.components import apart, connected, key_links
from tickloom.llm.shingles import WIDTH, chunks, mix, pieces, shingle_rows, words_at

MIN_WORDS = 50
SIMILARITY = 0.8
RADIUS = 6
#: Words between two runs of one passage, at most.
GAP = 2 * RADIUS + WIDTH
#: Sets that lie in memory as they are compared, at most, and those of a cluster beyond which it is cut by prefix elements.
MOST_SETS, LARGE = 50_000, 4_000
#: MinHash values in a band, and the wanted chance that a pair at the threshold shares a band.
BAND_ROWS = 2
RECALL = 0.95
_MOST = np.iinfo(np.uint64).max
_WHOLE = np.zeros(1, np.int64)
_PAIR = np.array([0xD6E8FEB86659FD93, 0xA5A35625D6A1D7A7], np.uint64)
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def bands_for(recall: float = RECALL, similarity: float = SIMILARITY, rows: int = BAND_ROWS) -> int:
    """The least number of bands with which a pair of that similarity meets with that chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


BANDS = bands_for()


def exact_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Index pairs with a Jaccard similarity of the threshold or more that connect all such pairs.

    In an order of all elements, rare ones first, two such sets share one of their first fifth; only sets that do are
    compared, and a pair inside one component is not compared again."""
    if len(sets) == 2:
        both = len(set(sets[0].tolist()).intersection(sets[1].tolist()))
        return [(0, 1)] if 9 * both >= 4 * (len(sets[0]) + len(sets[1])) else []
    size = np.array([len(x) for x in sets])
    kinds, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.lexsort((kinds, often))
    rank = np.empty(len(kinds), np.int64)
    rank[order] = np.arange(len(kinds))
    ranks = np.split(rank[place], np.cumsum(size)[:-1])
    # elements by a part of their hash: what two sets have in common there, and what one has lost, bound their overlap from above
    bits = [sum({1 << (x & 255) for x in own.tolist()}) for own in sets]
    lost = [len(own) - x.bit_count() for own, x in zip(sets, bits)]
    # for each element the sets that have it among their first, in lists of one component; merged when they are next read
    seen: dict[int, list[list[int]]] = defaultdict(list)
    component = list(range(len(sets)))
    members = {i: [i] for i in component}
    found = []
    for i in np.argsort(size, kind="stable").tolist():
        own = np.sort(ranks[i])
        first = own[: len(own) - (4 * len(own) + 4) // 5 + 1].tolist()
        tried = set()
        for x in first:
            lists: dict[int, list[int]] = {}
            for few in seen[x]:
                many = lists.setdefault(component[few[0]], few)
                if many is not few:
                    many, few = (many, few) if len(many) >= len(few) else (few, many)
                    many += few
                    lists[component[many[0]]] = many
            for c, others in lists.items():
                if c == component[i]:
                    continue
                for j in reversed(others):
                    if j in tried or 5 * size[j] < 4 * size[i]:
                        continue
                    tried.add(j)
                    wanted = 4 * (size[i] + size[j])
                    if 9 * ((bits[i] & bits[j]).bit_count() + min(lost[i], lost[j])) < wanted:
                        continue
                    if 9 * len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= wanted:
                        found.append((i, j))
                        few, many = sorted((component[i], component[j]), key=lambda k: len(members[k]))
                        for k in members[few]:
                            component[k] = many
                        members[many] += members.pop(few)
                        break
            seen[x] = [*lists.values(), [i]]
    return found


class Paragraphs:
    """The paragraphs of a chunk of texts, as arrays: text, number, word (place of its first), words, start and length (code
    points), name (a hash of its words in order) and first (place of its first word in the chunk)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.hashes, places, first, length = words_at(data, offsets)
        n = len(self.hashes)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(places))
        upto = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        #: Code points of each word's begin and end in its text.
        self.begin, self.end = upto[first] - upto[offsets[owner]], upto[first + length] - upto[offsets[owner]]
        self.first = self._borders(places, owner) if n else np.zeros(0, np.int64)
        self.words = np.diff(np.append(self.first, n))
        self.text = owner[self.first]
        #: Numbers of the first paragraph of each text.
        self.opening = np.searchsorted(self.first, places)
        self.number = np.arange(len(self.first)) - self.opening[self.text]
        self.word = self.first - places[self.text]
        self.start = self.begin[self.first]
        self.length = self.end[self.first + self.words - 1] - self.start
        inside = np.arange(n) - np.repeat(self.first, self.words)
        power = np.cumprod(np.full(int(self.words.max(initial=1)), _BASE, np.uint64))
        sums = np.add.reduceat(self.hashes * power[inside], self.first) if n else np.zeros(0, np.uint64)
        self.name = mix(sums + self.words.astype(np.uint64) * _PAIR[0], 3)
        self.shingles = np.append(shingle_rows(self.hashes), np.zeros(min(n, WIDTH - 1), np.uint64))
        self.whole = inside + WIDTH <= np.repeat(self.words, self.words)

    def _borders(self, places: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The words that begin a paragraph, and the first of each text."""
        after = np.append(self.hashes[1:], np.uint64(0))
        opening = np.unique(places[:-1][np.diff(places) > 0])
        after[np.append(opening[1:], len(after)) - 1] = 0
        pairs = mix(self.hashes * _PAIR[0] + after * _PAIR[1], 4) >> np.uint64(1)
        # texts stand apart, so that no word is compared with those of another text
        at = np.arange(len(pairs)) + RADIUS * (owner + 1)
        wide = np.full(int(at[-1]) + 1 + RADIUS, _MOST, np.uint64)
        wide[at] = pairs
        before, behind = np.full_like(wide, _MOST), np.full_like(wide, _MOST)
        for k in range(1, RADIUS + 1):
            np.minimum(before[k:], wide[:-k], out=before[k:])
            np.minimum(behind[:-k], wide[k:], out=behind[:-k])
        least = (wide < before) & (wide <= behind)
        return np.union1d(np.flatnonzero(least[at]), opening)

    def bands(self) -> np.ndarray:
        """(paragraphs, bands) keys; a paragraph of fewer than five words has its name for a shingle."""
        found = np.empty((len(self.first), BANDS), np.uint64)
        short = self.words < WIDTH
        for band in range(BANDS):
            key = np.zeros(len(self.first), np.uint64)
            for row in range(BAND_ROWS):
                salt = 16 + band * BAND_ROWS + row
                values = np.where(self.whole, mix(self.shingles, salt), _MOST)
                least = np.minimum.reduceat(values, self.first) if len(values) else key
                key = mix(key + np.where(short, mix(self.name, salt), least), 5)
            found[:, band] = mix(key, 8 + band)
        return found

    def set(self, k: int) -> np.ndarray:
        """The shingles of the k-th paragraph of the chunk."""
        if self.words[k] < WIDTH:
            return self.name[k : k + 1]
        return np.unique(self.shingles[self.first[k] : self.first[k] + self.words[k] - WIDTH + 1])

    def around(self, k: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For paragraphs of the chunk the words next to each, nearest first, to the end of the next but one: how many, and the hashes
        (32 bits) and code points of all."""
        text = self.text[k]
        last = np.minimum(k + 2, self.opening[text + 1] - 1)
        low = np.where(right, self.first[k] + self.words[k], self.first[np.maximum(k - 2, self.opening[text])])
        high = np.where(right, self.first[last] + self.words[last], self.first[k])
        count = high - low
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        place = np.where(np.repeat(right, count), np.repeat(low, count) + step, np.repeat(high, count) - 1 - step)
        return count, (self.hashes[place] >> np.uint64(32)).astype(np.uint32).view(np.int32), np.where(np.repeat(right, count), self.end[place], self.begin[place])


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the text) and text; a text is named by the first two."""
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.withColumn("mark", F.xxhash64("text")).select("doc_id", "mark", "text")


def _paragraphs(texts: DataFrame) -> DataFrame:
    """A row for each paragraph: where it is, its name, and its band keys."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for base, data, offsets in chunks(batch.column(2)):
                own = Paragraphs(data, offsets)
                at = pa.array(base + own.text)
                ints = [pa.array(x.astype(np.int32)) for x in (own.number, own.word, own.words, own.start, own.length)]
                keys = pa.FixedSizeListArray.from_arrays(pa.array(own.bands().view(np.int64).ravel()), BANDS)
                columns = [batch.column(0).take(at), batch.column(1).take(at), *ints, pa.array(own.name.view(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, keys.cast(pa.list_(pa.int64()))], names="doc_id mark paragraph word words start length name bands".split()
                )

    return texts.mapInArrow(
        rows, "doc_id long, mark long, paragraph int, word int, words int, start int, length int, name long, bands array<long>"
    )


def _asked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, mark, text and, for each other column of wanted (doc_id, mark and others), a list of its values for that text. Equal rows
    of a text are asked once."""
    keys, names = ["doc_id", "mark"], [c for c in wanted.columns if c not in ("doc_id", "mark")]
    rows = wanted.groupBy(*keys).agg(F.collect_list(F.struct(*names)).alias("asked"))
    rows = materialise(rows.select(*keys, *[F.col(f"asked.{c}").alias(c) for c in names]), "asked")
    found = apart(texts, rows.select(*keys), keys)[0].join(rows, keys)
    return found.dropDuplicates(keys).select(*keys, "text", *names)


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Paragraphs, np.ndarray, np.ndarray, list[pa.Array]]]:
    """For each chunk of the texts of ``_asked``: the batch, its paragraphs, the rows that ask, the paragraphs they ask for (the first
    list), and the values of the other lists."""
    for batch in pieces(batches):
        count = batch.column(3).value_lengths().to_numpy()
        begin = np.append(0, np.cumsum(count))
        flat = [batch.column(i).flatten() for i in range(3, batch.num_columns)]
        number = flat[0].to_numpy()
        for base, data, offsets in chunks(batch.column(2)):
            own, texts = Paragraphs(data, offsets), len(offsets) - 1
            low, high = int(begin[base]), int(begin[base + texts])
            row = np.repeat(np.arange(texts), count[base : base + texts])
            yield batch, own, base + row, own.opening[row] + number[low:high], [x.slice(low, high - low) for x in flat[1:]]


def _elements(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The members' shingle sets, from the paragraph that stands for each name, with the cluster and a key in which they are compared. In a
    large cluster a set is there once for each of its first elements, as similar sets have one of these in common; its key is 0 elsewhere."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own, _, wanted, (cluster, node, large) in _answered(batches):
            row, keys, elements = [], [], []
            for k, cut_ in enumerate(large.to_pylist()):
                found = own.set(int(wanted[k]))
                first = found[: len(found) - (4 * len(found) + 4) // 5 + 1].view(np.int64) if cut_ else _WHOLE
                row += [k] * len(first)
                keys.append(first)
                elements += [found.tobytes()] * len(first)
            at = pa.array(row, pa.int64())
            columns = [cluster.take(at), pa.array(np.concatenate([_WHOLE[:0], *keys])), node.take(at), pa.array(elements, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "key", "node", "elements"])

    asked = members.select("doc_id", "mark", "paragraph", "cluster", "node", "large")
    return _asked(texts, asked).mapInArrow(sets, "cluster long, key long, node long, elements binary")


def task_links(nodes: np.ndarray, sets: Callable[[int, int], list[np.ndarray]]) -> list[tuple[int, int]]:
    """The links between nodes that are compared with each other; sets(a, b) gives the sets of some. Beyond ``MOST_SETS`` they are compared
    block by block, each with all others."""
    n = len(nodes)
    if n <= MOST_SETS:
        return [(nodes[x], nodes[y]) for x, y in exact_links(sets(0, n))] if n > 1 else []
    blocks = [(a, min(a + MOST_SETS // 2, n)) for a in range(0, n, MOST_SETS // 2)]
    found = []
    for k, (a, b) in enumerate(blocks):
        for c, d in blocks[k + 1 :]:
            both = np.append(nodes[a:b], nodes[c:d])
            found += [(both[x], both[y]) for x, y in exact_links(sets(a, b) + sets(c, d))]
    return found


def _links(elements: DataFrame) -> DataFrame:
    """(a, b) links that ``exact_links`` finds among the sets of each cluster and key. These lie one after the other in sorted partitions, so
    that small clusters cost little."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            keys = np.stack([table.column(k).to_numpy() for k in range(2)])
            border = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if len(border):
                yield linked(table.slice(0, int(border[-1])), np.append(0, border))
                left = table.slice(int(border[-1]))
            else:
                left = table
        if left is not None and left.num_rows:
            yield linked(left, np.array([0, left.num_rows]))

    def linked(table: pa.Table, border: np.ndarray) -> pa.RecordBatch:
        nodes = table.column(2).to_numpy()
        read = lambda a, b: [np.frombuffer(x.as_buffer(), np.uint64) for c in table.column(3).slice(a, b - a).chunks for x in c]
        found, spans = [], list(zip(border.tolist(), border[1:].tolist()))
        if table.num_rows <= MOST_SETS:
            every = read(0, table.num_rows)
            for a, b in spans:
                found += task_links(nodes[a:b], lambda c, d: every[a + c : a + d])
        else:
            for a, b in spans:
                found += task_links(nodes[a:b], lambda c, d: read(a + c, a + d))
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    keys = ["cluster", "key"]
    return elements.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(runs, "a long, b long")


def _contexts(texts: DataFrame, ends: DataFrame) -> DataFrame:
    """For each of ends (doc_id, mark, paragraph, right) the words around it: hashes and code points, nearest first."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own, row, wanted, (right,) in _answered(batches):
            count, hashes, points = own.around(wanted, right.to_numpy(zero_copy_only=False))
            upto = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
            row = pa.array(row)
            lists = [pa.ListArray.from_arrays(upto, pa.array(x)) for x in (hashes, points.astype(np.int32))]
            number = pa.array(own.number[wanted].astype(np.int32))
            columns = [batch.column(0).take(row), batch.column(1).take(row), number, right, *lists]
            yield pa.RecordBatch.from_arrays(columns, names="doc_id mark paragraph right hashes points".split())

    return _asked(texts, ends.select("doc_id", "mark", "paragraph", "right")).mapInArrow(
        words, "doc_id long, mark long, paragraph int, right boolean, hashes array<int>, points array<int>"
    )


def _repeated(texts: DataFrame) -> DataFrame:
    """The paragraphs that are not the first of their component, with that first one (head)."""
    rows = materialise(_paragraphs(texts), "paragraphs")
    clusters = connected(key_links(rows.select(F.explode("bands").alias("key"), F.col("name").alias("node"))))
    clusters = clusters.select(F.col("node").alias("name"), F.col("root").alias("cluster"))
    few = apart(rows, clusters.select("name"), ["name"])[0].join(clusters, "name")
    place = F.struct("doc_id", "mark", "paragraph")
    classes = few.groupBy(F.col("name").alias("node")).agg(F.min(place).alias("first"), F.first("cluster").alias("cluster"))
    classes = classes.select("first.*", "node", "cluster")
    sizes = classes.groupBy("cluster").agg(F.count("*").alias("sets")).where("sets > 1")
    sizes = sizes.select("cluster", (F.col("sets") > LARGE).alias("large"))
    members = materialise(classes.join(sizes, "cluster"), "members")
    roots = connected(_links(_elements(texts, members))).select(F.col("node").alias("name"), "root")

    rows = rows.drop("bands")
    maybe, alone = apart(rows, roots.select("name"), ["name"])
    maybe = maybe.join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
    rooted = maybe.unionByName(alone.withColumn("root", F.col("name")))
    several = materialise(rooted.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root"), "several")
    several_rows = apart(rooted, several, ["root"])[0].join(several, "root", "left_semi")
    several_rows = materialise(several_rows, "repeated")
    heads = several_rows.groupBy("root").agg(F.min(F.struct("doc_id", "mark", "paragraph", "word", "words", "start", "length")).alias("head"))
    found = several_rows.join(heads, "root")
    return found.where(F.struct("doc_id", "mark", "paragraph") != F.struct("head.doc_id", "head.mark", "head.paragraph"))


def _runs(texts: DataFrame) -> DataFrame:
    """Repeated paragraphs in a row, grown to both sides. Words and code points of the run (low, high, start, stop) and of its
    ends where they stay (one and two, with their words and code points)."""
    repeated = _repeated(texts)
    in_text = W.partitionBy("doc_id", "mark").orderBy("paragraph")
    place = lambda head: F.struct(f"{head}doc_id", f"{head}mark", F.col(f"{head}paragraph") - F.col("paragraph"))
    follows = (F.lag("paragraph").over(in_text) == F.col("paragraph") - 1) & (F.lag(place("head.")).over(in_text) == place("head."))
    runs = repeated.withColumn("begins", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    runs = runs.withColumn("island", F.sum("begins").over(in_text)).groupBy("doc_id", "mark", "island").agg(
        F.min("paragraph").alias("opening"), F.max("paragraph").alias("closing"),
        F.min("word").alias("low"), F.max(F.col("word") + F.col("words")).alias("high"),
        F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("stop"),
        F.min_by("head", "paragraph").alias("one"), F.max_by("head", "paragraph").alias("two"),
    )
    runs = materialise(runs, "runs")
    ends = [("opening", "one", False), ("closing", "two", True)]
    asked = None
    for own, head, right in ends:
        for row in (runs.select("doc_id", "mark", F.col(own).alias("paragraph")), runs.select(f"{head}.doc_id", f"{head}.mark", f"{head}.paragraph")):
            row = row.withColumn("right", F.lit(right))
            asked = row if asked is None else asked.unionByName(row)
    contexts = materialise(_contexts(texts, asked.distinct()), "contexts")
    for own, head, right in ends:
        words = contexts.where(F.col("right") == right)
        here = words.select("doc_id", "mark", F.col("paragraph").alias(own), F.col("hashes").alias("here"), F.col("points").alias("at"))
        there = words.select(
            F.struct("doc_id", "mark", "paragraph").alias("key"), F.col("hashes").alias("there"), F.col("points").alias("at_there")
        )
        key = F.struct(f"{head}.doc_id", f"{head}.mark", f"{head}.paragraph")
        runs = runs.join(here, ["doc_id", "mark", own]).withColumn("key", key).join(there, "key").drop("key")
        equal = F.zip_with("here", "there", lambda a, b: a.eqNullSafe(b))
        runs = runs.withColumn("equal", equal)
        runs = runs.withColumn("grown", F.coalesce(F.nullif(F.array_position("equal", F.lit(False)), F.lit(0)) - 1, F.size("equal")).cast("int"))
        last = lambda points, otherwise: F.coalesce(F.get(points, F.col("grown") - 1), otherwise)
        if right:
            runs = runs.withColumn("high", F.col("high") + F.col("grown")).withColumn("stop", last("at", F.col("stop")))
            runs = runs.withColumn("kept_high", F.col("two.word") + F.col("two.words") + F.col("grown"))
            runs = runs.withColumn("kept_stop", last("at_there", F.col("two.start") + F.col("two.length")))
        else:
            runs = runs.withColumn("low", F.col("low") - F.col("grown")).withColumn("start", last("at", F.col("start")))
            runs = runs.withColumn("kept_low", F.col("one.word") - F.col("grown")).withColumn("kept_start", last("at_there", F.col("one.start")))
        runs = runs.drop("here", "there", "at", "at_there", "equal", "grown")
    return runs


def duplicate_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each passage of at least min_words words that an earlier place has too, and for that place: doc_id, text_hash (xxhash64 of
    the text), start and length (code points), words, kept_doc_id, kept_start and kept_length (of the earlier place; the last two null
    where parts of the passage come from different texts), removed (false for the earlier place itself, whose words are not counted).

    docs needs doc_id and text. Null and empty texts have no passages; rows without a doc_id are left alone. Equal rows
    are one text; rows that share a doc_id with different texts are different texts. An empty table gives an empty result.
    """
    runs = _runs(_texts(docs))
    in_text = W.partitionBy("doc_id", "mark").orderBy("low", "high")
    before = lambda c: F.lag(c).over(in_text)
    here, there = F.col("low") - before("high"), F.col("kept_low") - before("kept_high")
    near = (before("two.doc_id") == F.col("one.doc_id")) & (before("two.mark") == F.col("one.mark")) & here.between(0, GAP) & there.between(0, GAP)
    runs = runs.withColumn("near", F.coalesce(near, F.lit(False)))
    runs = runs.withColumn("chain", F.sum(F.when(F.col("near"), 0).otherwise(1)).over(in_text))
    runs = materialise(runs, "grown")
    chains = runs.groupBy("doc_id", "mark", "chain").agg(
        F.count("*").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("start").alias("start"), F.max("stop").alias("stop"),
        F.min("kept_low").alias("kept_low"), F.max("kept_high").alias("kept_high"),
        F.min_by("kept_start", "low").alias("kept_start"), F.max_by("kept_stop", "low").alias("kept_stop"),
        F.min_by("one", "low").alias("one"), F.max_by("two", "low").alias("two"),
        F.sum(F.greatest(F.col("high") - F.col("low") - (WIDTH - 1), F.lit(0))).alias("both"),
    )
    # the shingles inside the runs are common to both passages
    sizes = F.col("high") - F.col("low") + F.col("kept_high") - F.col("kept_low") - 2 * (WIDTH - 1)
    alike = (F.col("n") == 1) | (9 * F.col("both") >= 4 * sizes)
    whole_ = chains.where(alike)
    parts = runs.join(chains.where(~alike).select("doc_id", "mark", "chain"), ["doc_id", "mark", "chain"], "left_semi")
    columns = ["doc_id", "mark", "low", "high", "start", "stop", "kept_start", "kept_stop", "one", "two"]
    found = whole_.select(*columns).unionByName(parts.select(*columns)).where(F.col("high") - F.col("low") >= min_words)
    one_text = (F.col("one.doc_id") == F.col("two.doc_id")) & (F.col("one.mark") == F.col("two.mark")) & (F.col("kept_stop") > F.col("kept_start"))
    found = materialise(found.withColumn("one_text", one_text), "passages")
    gone = found.select(
        "doc_id", F.col("mark").alias("text_hash"), "start", (F.col("stop") - F.col("start")).alias("length"),
        (F.col("high") - F.col("low")).alias("words"), F.col("one.doc_id").alias("kept_doc_id"),
        F.when(F.col("one_text"), F.col("kept_start")).alias("kept_start"),
        F.when(F.col("one_text"), F.col("kept_stop") - F.col("kept_start")).alias("kept_length"), F.lit(True).alias("removed"),
    )
    stays = found.where("one_text").select(
        F.col("one.doc_id").alias("doc_id"), F.col("one.mark").alias("text_hash"), F.col("kept_start").alias("start"),
        (F.col("kept_stop") - F.col("kept_start")).alias("length"), F.lit(None).cast("int").alias("words"),
        F.col("one.doc_id").alias("kept_doc_id"), "kept_start", (F.col("kept_stop") - F.col("kept_start")).alias("kept_length"),
        F.lit(False).alias("removed"),
    )
    return gone.unionByName(stays.distinct())


def cut(text: str, ranges: list[tuple[int, int]]) -> str:
    """text without the code points of the ranges (start, length), which may overlap."""
    left, upto = [], 0
    for start, length in sorted(ranges):
        left.append(text[upto : max(start, upto)])
        upto = max(upto, start + length)
    return "".join([*left, text[upto:]])


def without_paragraphs(docs: DataFrame, duplicates: DataFrame) -> DataFrame:
    """docs, all columns, without the removed passages; a document that has no word left goes.

    n_chars, where there is such a column, counts the new text. A text without removed passages is unchanged, also a
    null or empty one.
    """
    gone = duplicates.where("removed").groupBy("doc_id", F.col("text_hash").alias("mark"))
    gone = materialise(gone.agg(F.collect_list(F.struct("start", "length")).alias("ranges")), "gone")
    keys = ["doc_id", "mark"]
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"))
    maybe, unchanged = apart(rows, gone.select(*keys), keys)
    joined = maybe.join(gone, keys, "left")

    def shorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [cut(t, [(r["start"], r["length"]) for r in own]) for t, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "left"])

    changed = joined.where("ranges is not null").select("row", "row.text", "ranges")
    schema = changed.select("row").schema.add("left", "string")
    changed = changed.mapInArrow(shorter, schema).where(r"left rlike '[^\\x20\\x09-\\x0D]'")
    new: dict[str, Column] = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("left").cast(docs.schema["n_chars"].dataType)
    names = [(n, F.col("row").getField(n)) for n in docs.columns]
    changed = changed.select(*[new.get(n, c).alias(n) for n, c in names])
    same = unchanged.select("row").unionByName(joined.where("ranges is null").select("row"))
    return same.select(*[c.alias(n) for n, c in names]).unionByName(changed)
