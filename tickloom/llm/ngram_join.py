"""N-gram Jaccard join: a prefix-tree join of documents on their sets of five-word shingles.

1. A document's set is its distinct shingle hashes. Equal sets are one class; only classes are compared.
2. The global order puts the shingles of many documents last, those of most at the very end; a table of fixed size counts
   them by a part of their hash. In that order two similar sets share one of the first fifth of their elements, their prefixes. Classes that
   share a prefix element are candidates if sizes and counts per hash class, which bound the overlap from above,
   allow the threshold. Connected candidates form a cluster.
3. Inside a cluster, the sets are stored in a prefix tree. A search walks it with an overlap that all sets below
   a node share, and leaves a subtree when the remaining lengths cannot reach the threshold, or when all its
   candidates are in the searcher's component already.
4. Components of the links found are components of all links: a link is skipped only inside a component.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialise
from tickloom.llm.components import apart, comparisons, connected, verified_links
from tickloom.llm.shingles import class_counts, pieces, shingle_sets, signature

#: Similar: 100 * intersection >= 80 * union, which is 9 * intersection >= 4 * (size + size).
_PART, _SIZES = 9, 4
#: Smaller sets are similar to equal ones only.
_LEAST = 4
#: Counters of shingles, their pieces, and levels of their order: all counters, the higher half, the highest quarter and so on.
HEAT_BITS, HEAT_PIECES, LEVELS = 21, 32, 16
#: A prefix element of more classes than this makes them one cluster without a look at bounds.
CROWD = 1_000
_MANY = 255


def _small_counts(own: np.ndarray) -> np.ndarray:
    """Counts per hash class in a byte each; the highest value stands for any larger count. There is a class for about
    every four elements, and their number is a power of two, so that neighbouring halves add up to fewer classes."""
    classes = 32
    while 5 * classes < len(own):
        classes *= 2
    return np.minimum(class_counts(own, classes), _MANY).astype(np.uint8)


def _profiles(docs: DataFrame) -> DataFrame:
    """A row for each document: size, signature and class counts of its set; and, with a piece, rows of counters."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heat = np.zeros(1 << HEAT_BITS, np.uint32)
        names = ["doc_id", "n_shingles", "one", "two", "counts", "piece"]
        for batch in pieces(batches):
            found = []
            for _, own in shingle_sets(batch.column(1)):
                found.append((len(own), *signature(own), _small_counts(own).tobytes()))
                places = (own >> np.uint64(64 - HEAT_BITS)).astype(np.int64)
                np.add.at(heat, places, np.uint32(1))
            columns = [pa.array([x[k] for x in found], pa.int64()) for k in range(3)]
            columns += [pa.array([x[3] for x in found], pa.binary()), pa.nulls(len(found), pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)
        parts = [zlib.compress(np.minimum(x, 65535).astype(np.uint16).tobytes(), 1) for x in np.split(heat, HEAT_PIECES)]
        empty = [pa.nulls(HEAT_PIECES, pa.int64())] * 4
        columns = [*empty, pa.array(parts, pa.binary()), pa.array(range(HEAT_PIECES), pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(rows, "doc_id long, n_shingles long, one long, two long, counts binary, piece int")


def levels_of(heat: np.ndarray) -> np.ndarray:
    """How far up each counter is among all: level k from the 2^-k part of the highest on, equal counters on one level. The place
    among the others decides, not the count, so that a level has as many counters whatever the size of the input."""
    bounds = np.sort(heat)[[-max(1, len(heat) >> k) for k in range(1, LEVELS)]]
    return np.searchsorted(bounds, heat, "right").astype(np.uint8)


def _levels(profiles: DataFrame) -> bytes:
    """A byte for each counter, compressed: its level within its piece. 2 MB at most, whatever the input."""

    def total(group: pa.Table) -> pa.Table:
        heat = sum(np.frombuffer(zlib.decompress(x.as_py()), np.uint16).astype(np.uint64) for x in group.column("counts"))
        found = zlib.compress(levels_of(heat).tobytes(), 1)
        return pa.table({"piece": group.column("piece")[:1], "levels": pa.array([found], pa.binary())})

    heat = profiles.where("piece is not null").select("piece", "counts").groupBy("piece")
    found = {r["piece"]: zlib.decompress(r["levels"]) for r in heat.applyInArrow(total, "piece int, levels binary").collect()}
    none = bytes((1 << HEAT_BITS) // HEAT_PIECES)
    return zlib.compress(b"".join(found.get(k, none) for k in range(HEAT_PIECES)), 1)


def prefix(own: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The first elements of a set in the global order: any similar set has one of them among its own first."""
    last = levels[(own >> np.uint64(64 - HEAT_BITS)).astype(np.int64)]
    return own[np.argsort(last, kind="stable")][: len(own) - (4 * len(own) + 4) // 5 + 1]


def _crowds(docs: DataFrame, levels: bytes) -> DataFrame:
    """The documents that share a prefix element: nodes (array) and crowded, one row for each different list. Of
    equal sets in a piece of a batch one is enough. A list beyond ``CROWD`` comes as pairs with its first node."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.frombuffer(zlib.decompress(levels), np.uint8)
        for batch in pieces(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            seen, keys, nodes = set(), [], []
            for i, own in shingle_sets(batch.column(1)):
                if len(own) >= _LEAST and (name := signature(own)) not in seen:
                    seen.add(name)
                    keys.append(prefix(own, order))
                    nodes.append(np.full(len(keys[-1]), ids[i], np.int64))
            if keys:
                columns = [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "node"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_nodes, crowd = None, np.zeros(0, np.int64), False
        seen: set[bytes] = set()

        def batch_of(found: list[np.ndarray], crowded: list[bool]) -> pa.RecordBatch:
            columns = [pa.array(found, pa.list_(pa.int64())), pa.array(crowded, pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=["nodes", "crowded"])

        def close(nodes: np.ndarray, crowded: bool, out: list, marks: list) -> None:
            nodes = np.unique(nodes)
            if len(nodes) < 2:
                return
            if crowded or len(nodes) > CROWD:
                for other in nodes[1:]:
                    out.append(np.array([nodes[0], other]))
                    marks.append(True)
            elif (name := nodes.tobytes()) not in seen:
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(name)
                out.append(nodes)
                marks.append(False)

        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            v = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(k):
                continue
            starts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            ends = np.append(starts[1:], len(k))
            out, marks = [], []
            if open_key is not None and k[0] == open_key:
                open_nodes = np.concatenate([open_nodes, v[: ends[0]]])
                if len(open_nodes) > CROWD:
                    # too long to hold: pairs with its first node, which goes on to stand for the list
                    close(open_nodes, True, out, marks)
                    open_nodes, crowd = open_nodes[:1], True
                starts, ends = starts[1:], ends[1:]
            if len(starts):
                close(open_nodes, crowd, out, marks)
                for i in np.flatnonzero(ends[:-1] - starts[:-1] > 1):
                    close(v[starts[i] : ends[i]], False, out, marks)
                open_key, open_nodes, crowd = k[-1], v[starts[-1] :], False
            if out:
                yield batch_of(out, marks)
        out, marks = [], []
        close(open_nodes, crowd, out, marks)
        if out:
            yield batch_of(out, marks)

    keys = docs.mapInArrow(rows, "key long, node long").repartition("key").sortWithinPartitions("key", "node")
    return keys.mapInArrow(lists, "nodes array<long>, crowded boolean").distinct()


def bounded_links(size: np.ndarray, counts: list[np.ndarray]) -> list[tuple[int, int]]:
    """Index pairs that connect all sets whose sizes and class counts do not rule out the threshold."""
    component = np.arange(len(size))
    classes = np.array([len(x) for x in counts])
    # for each number of classes, the counts of all sets that have so many or more, added up to that number
    folded, place = {}, {}
    for c in np.unique(classes).tolist():
        rows = np.flatnonzero(classes >= c)
        wide = [np.where(counts[i] == _MANY, 1 << 20, counts[i].astype(np.int32)).reshape(-1, c).sum(axis=0) for i in rows]
        folded[c], place[c] = np.stack(wide), np.zeros(len(size), np.int64)
        place[c][rows] = np.arange(len(rows))
    found = []
    for i in range(len(size) - 1):
        near = (5 * size[i + 1 :] >= 4 * size[i]) & (4 * size[i + 1 :] <= 5 * size[i])
        late = i + 1 + np.flatnonzero((component[i + 1 :] != component[i]) & near)
        shared = np.minimum(classes[late], classes[i])
        for c in np.unique(shared).tolist():
            some = late[shared == c]
            bound = np.minimum(folded[c][place[c][some]], folded[c][place[c][i]]).sum(axis=1)
            for j in some[_PART * bound >= _SIZES * (size[i] + size[some])].tolist():
                if component[j] != component[i]:
                    found.append((i, j))
                    component[component == component[j]] = component[i]
    return found


def _candidates(crowds: DataFrame, profiles: DataFrame) -> DataFrame:
    """(a, b) links between documents whose sets may be similar."""

    def links(group: pa.Table) -> pa.Table:
        nodes = group.column("doc_id").to_numpy()
        counts = [np.frombuffer(x.as_py(), np.uint8) for x in group.column("counts")]
        found = np.array(bounded_links(group.column("n_shingles").to_numpy(), counts), np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(nodes[found[:, 0]]), "b": pa.array(nodes[found[:, 1]])})

    lists = crowds.where("not crowded").select(F.xxhash64("nodes", F.lit(1)).alias("list"), F.explode("nodes").alias("doc_id"))
    known = profiles.where("piece is null").select("doc_id", "n_shingles", "counts")
    pairs = lists.join(known, "doc_id").groupBy("list").applyInArrow(links, "a long, b long")
    hot = crowds.where("crowded").select(F.get("nodes", F.lit(0)).alias("a"), F.get("nodes", F.lit(1)).alias("b"))
    return pairs.unionByName(hot)


def tree_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Index pairs of similar sets that connect every component of all similar pairs.

    The sets, in lexicographic order, are the leaves of a path-compressed prefix tree whose nodes are ranges of
    them. A search for each set finds the later sets that are similar and in another component.
    """
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    sets = [sets[i] for i in order]
    m = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    counts = np.stack([class_counts(x) for x in sets])
    shared = np.zeros(m + 1, np.int64)
    for i in range(1, m):
        k = min(size[i - 1], size[i])
        differ = np.flatnonzero(sets[i - 1][:k] != sets[i][:k])
        shared[i] = differ[0] if len(differ) else k
    children: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}

    def below(node: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Borders of the children of the sets low to high, which agree up to depth, and what each child agrees on."""
        if node not in children:
            low, high, depth = node
            cuts = np.concatenate([[low], low + 1 + np.flatnonzero(shared[low + 1 : high] <= depth), [high]])
            agree = [int(size[a]) if b - a == 1 else int(shared[a + 1 : b].min()) for a, b in zip(cuts, cuts[1:])]
            children[node] = cuts, np.array(agree)
        return children[node]

    component = np.arange(m)
    found = []
    for i in range(m - 1):
        own, n = sets[i], int(size[i])
        late = i + 1 + np.flatnonzero(
            (component[i + 1 :] != component[i]) & (5 * size[i + 1 :] >= 4 * n) & (4 * size[i + 1 :] <= 5 * n)
        )
        if len(late):
            bound = np.minimum(counts[late], counts[i]).sum(axis=1, dtype=np.int64)
            late = late[_PART * bound >= _SIZES * (n + size[late])]
        if not len(late):
            continue
        open_ = np.zeros(m + 1, np.int64)
        open_[late + 1] = 1
        left = np.cumsum(open_)
        stack = [(0, m, 0, 0, 0)]
        while stack:
            low, high, depth, overlap, place = stack.pop()
            cuts, agrees = below((low, high, depth))
            for k in np.flatnonzero(left[cuts[1:]] > left[cuts[:-1]]).tolist():
                a, b, agree = int(cuts[k]), int(cuts[k + 1]), int(agrees[k])
                edge = sets[a][depth:agree]
                at = place + np.searchsorted(own[place:], edge)
                hits = int((own[np.minimum(at, n - 1)][at < n] == edge[at < n]).sum()) if len(edge) else 0
                rest = place + int(np.searchsorted(own[place:], edge[-1], "right")) if len(edge) else place
                total = overlap + hits
                if b - a == 1:
                    if component[a] != component[i] and _PART * total >= _SIZES * (n + int(size[a])):
                        found.append((order[i], order[a]))
                        component[component == component[a]] = component[i]
                        open_[1:][component == component[i]] = 0
                        left = np.cumsum(open_)
                    continue
                sizes = size[a:b]
                most = total + min(n - rest, int(sizes.max()) - agree)
                if _PART * most >= _SIZES * (n + int(sizes.min())):
                    stack.append((a, b, agree, total, rest))
    return found


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (columns doc_id and text; others are ignored).

    component_id is the smallest doc_id reachable over links, the document itself included. Null and empty texts
    have n_shingles 0 and are alone. Repeated rows are separate rows of one component. An empty table gives an
    empty result. Rows without a doc_id keep a null component and link nothing.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = docs.where("doc_id is not null")
    profiles = materialise(_profiles(docs), "profiles")
    rows = profiles.where("piece is null").select("doc_id", "n_shingles", "one", "two")
    linkable = rows.where("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy("one", "two").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"))
    # of equal sets only the class's node has to share elements with others; some rows of other nodes pass, and change nothing
    nodes = apart(named, classes.select(F.col("node").alias("doc_id")), ["doc_id"])[0]
    crowds = materialise(_crowds(nodes, _levels(profiles)), "crowds")
    clusters = connected(_candidates(crowds, profiles))
    clusters = rows.join(clusters.select(F.col("node").alias("doc_id"), F.col("root").alias("cluster")), "doc_id")
    clusters = clusters.groupBy("one", "two").agg(F.min("cluster").alias("cluster"))
    members = materialise(comparisons(classes.join(clusters, ["one", "two"])), "members")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The member's own set; a row that only shares its doc_id with the member is left out."""
        for batch in pieces(batches):
            one, two = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            kept, elements = [], []
            for i, own in shingle_sets(batch.column(6)):
                if signature(own) == (one[i], two[i]):
                    kept.append(i)
                    elements.append(own.tobytes())
            few = batch.take(pa.array(kept, pa.int64()))
            columns = [few.column(k) for k in range(4)] + [pa.array(elements, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "i", "j", "node", "elements"])

    ids = members.select(F.col("node").alias("doc_id"))
    texts = apart(named, ids, ["doc_id"])[0].join(members, F.col("doc_id") == F.col("node"))
    elements = texts.select("cluster", "i", "j", "node", "one", "two", "text").mapInArrow(
        sets, "cluster long, i int, j int, node long, elements binary"
    )
    roots = connected(verified_links(elements, tree_links))
    rooted = classes.join(roots, "node", "left").select("one", "two", F.coalesce("root", "node").alias("root"))
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return rows.join(rooted, ["one", "two"], "left").select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("root")).alias("component_id")
    )


def _nodes(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), node and text. A node is a text: its doc_id, or for texts of a doc_id that has several a number above
    2^62, so that they come after all others."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    mark = F.xxhash64("text")
    several = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
    several = materialise(several.where("low <> high").select("doc_id"), "several")
    if several.isEmpty():
        return rows.withColumnRenamed("doc_id", "node")
    maybe, plain = apart(rows, several, ["doc_id"])
    number = F.lit(1 << 62) + F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 61))
    maybe = maybe.join(several.withColumn("known", F.lit(True)), "doc_id", "left")
    maybe = maybe.select("row", F.when(F.col("known"), number).otherwise(F.col("doc_id")).alias("node"), "text")
    return plain.withColumnRenamed("doc_id", "node").unionByName(maybe)


def without_similar(docs: DataFrame) -> DataFrame:
    """docs, all columns, with one document of each component: that of the smallest doc_id, where texts of a doc_id that has several
    different ones come last. Of rows that share doc_id and text one stays; rows without a doc_id all stay."""
    rows = _nodes(docs)
    found = similar_components(rows.select(F.col("node").alias("doc_id"), "text")).where("doc_id is not null")
    found = found.groupBy(F.col("doc_id").alias("node")).agg(
        F.count("*").alias("n"), F.min(F.col("component_id") < F.col("doc_id")).alias("goes")
    )
    special = materialise(found.where("goes or n > 1"), "goes")
    maybe, stay = apart(rows, special, ["node"])
    maybe = maybe.join(special, "node", "left")
    few = maybe.where("n is null").select("row")
    several = maybe.where("n > 1 and not goes").dropDuplicates(["node"]).select("row")
    kept = stay.select("row").unionByName(few).unionByName(several)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
