"""Connected components, candidate links from shared keys, and exact links inside clusters of candidates.

Three steps that the near-duplicate operators share. Nothing here emits the pairs of a group:

- ``key_links`` turns (key, node) rows into one link per node and shared key, to the smallest node of the key;
- ``connected`` finds the components of a link table in rounds of joins, each written to the shared folder;
- ``comparisons`` and ``verified_links`` bring the sets of each cluster together and keep the links that an exact
  test accepts. A cluster beyond ``TASK_TOKENS`` is cut into blocks, and every pair of blocks is a task of its own,
  so that a task's memory is bounded and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialise

#: Set elements that one task compares at most (8 bytes each), unless a single block pair is larger.
TASK_TOKENS = 4_000_000
#: Bits of the table that says which keys may be members: 2^17 words of 64.
KEY_BITS = 1 << 23


def key_links(keys: DataFrame) -> DataFrame:
    """(a, b) for every node that shares a key with a smaller node; keys has columns key and node.

    Rows are sorted by key inside each partition and read as a stream: memory does not grow with a key's rows.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hub = None, None
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            v = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(k):
                continue
            new = np.append(key is None or k[0] != key, k[1:] != k[:-1])
            first = np.flatnonzero(new)
            run = np.cumsum(new) - 1
            hubs = v[first]
            own = np.where(run < 0, hub if hub is not None else 0, hubs[run] if len(hubs) else 0)
            keep = own != v
            key, hub = k[-1], own[-1]
            if keep.any():
                pairs = np.unique(np.stack([v[keep], own[keep]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    sorted_keys = keys.select("key", "node").repartition("key").sortWithinPartitions("key", "node")
    return sorted_keys.mapInArrow(runs, "a long, b long").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each linked node's component.

    Alternating star contraction: each round links all larger neighbours of a node to its smallest neighbour,
    then all smaller ones. The number of rounds grows with the logarithm of the longest chain.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        sums = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if sums == before or sums["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = sums
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = large.where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        edges = materialise(small.where("a <> b").distinct(), "links")


def apart(rows: DataFrame, members: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """rows whose keys may be among the members', and rows whose keys are not.

    A table of ``KEY_BITS`` bits, of which the members' hashes set some, is broadcast: 2 MB, whatever the input. Only
    a join tells for certain, but it then moves few rows in vain, and the other rows stay where they are.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(KEY_BITS))
    word, bit = F.floor(place / 64), (place % 64).cast("int")
    marks = members.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word")
    marks = marks.agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    found = rows.withColumn("__word", word).withColumn("__bit", bit).join(F.broadcast(marks), "__word", "left")
    member = F.coalesce(F.getbit("__bits", F.col("__bit")) == 1, F.lit(False))
    return found.where(member).select(*rows.columns), found.where(~member).select(*rows.columns)


def comparisons(members: DataFrame) -> DataFrame:
    """members (cluster, node, n, more) with the tasks (i, j) that each takes part in.

    A cluster of at most ``TASK_TOKENS`` elements is one task; a larger one is cut into blocks of half of it, and a
    member goes to a task for each other block. Clusters of one member are left out.
    """
    sizes = members.groupBy("cluster").agg(F.sum("n").alias("total"), F.count("*").alias("count")).where("count > 1")
    blocks = F.ceil(F.col("total") * 2 / TASK_TOKENS).cast("int")
    sizes = sizes.select("cluster", F.when(F.col("total") <= TASK_TOKENS, 1).otherwise(blocks).alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = members.join(sizes, "cluster").withColumn("block", block).withColumn("other", others)
    spread = spread.where("blocks = 1 or other <> block")
    spread = spread.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    return spread.drop("blocks", "block", "other")


def verified_links(elements: DataFrame, test: Callable[[list[np.ndarray]], list[tuple[int, int]]]) -> DataFrame:
    """(a, b) links that ``test`` accepts between nodes of a task: columns cluster, i, j, node, elements (64-bit
    numbers in ascending order). test gets the sets and returns index pairs that connect all it would link."""

    def compare(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in group.column("elements").chunks for x in c]
        found = test(sets) if len(sets) > 1 else []
        a = nodes[[x for x, _ in found]] if found else np.zeros(0, np.int64)
        b = nodes[[x for _, x in found]] if found else np.zeros(0, np.int64)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return elements.groupBy("cluster", "i", "j").applyInArrow(compare, "a long, b long")
