"""Sharding by a hypergeometric communication matrix: a uniform shuffle into shards of exact sizes.

1. Rows are dealt to blocks by a hash, and the blocks are counted.
2. Each block's numbers of rows for the shards are drawn from the multivariate hypergeometric distribution: from what
   the shards can still take, as if all rows lay in a random order that is cut into shards.
3. Each block puts its rows in random order, and the matrix says which go to which shard.
4. Each shard puts its rows in random order again: the place is the slot.

The rows move with all their columns. Counts and the matrix, one row per ``BLOCK_ROWS`` rows, pass through the driver.
Places in a shard are counted in ranges of the random order, so no task holds a shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import materialise, whole

SHARDS = 40
BLOCK_ROWS = 32_768
#: The hypergeometric draws of numpy end here; beyond, rows are drawn one by one.
_NUMPY_ROWS = 10**9


def _draw(free: np.ndarray, rows: int, random: np.random.Generator) -> np.ndarray:
    """How many of rows places, drawn without replacement from the free places of the shards, lie in each."""
    total = int(free.sum())
    if total < _NUMPY_ROWS:
        return random.multivariate_hypergeometric(free, rows)
    places = np.unique(random.integers(0, total, rows))
    while len(places) < rows:
        places = np.union1d(places, random.integers(0, total, rows - len(places)))
    return np.diff(np.searchsorted(places, np.append(0, np.cumsum(free))))


def matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows from each block (down) to each shard (across). Shard sizes differ by one at most."""
    rows = sum(counts)
    free = np.array([rows // shards + (k < rows % shards) for k in range(shards)], np.int64)
    random = np.random.default_rng(seed)
    drawn = np.zeros((len(counts), shards), np.int64)
    for block, count in enumerate(counts):
        drawn[block] = _draw(free, count, random)
        free -= drawn[block]
    return drawn


def exchanged(docs: DataFrame, shards: int = SHARDS, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """row (a struct of all columns of docs), shard, slot: the documents themselves, shuffled.

    docs needs doc_id and text. A null text counts as empty, and a null doc_id is a value like others. Rows of equal
    doc_id and text take places of their own, by their other columns. With fewer rows than shards some shards
    stay empty; an empty table gives an empty result. Equal tables give equal shards.
    """
    spark = docs.sparkSession
    text = whole("text").cast("binary")
    size, crc = F.octet_length(text).cast("long") + 16, F.crc32(text)
    random = [F.xxhash64(F.lit(f"{seed}/{k}"), F.coalesce("doc_id", F.lit(-1)), crc, size) for k in range(3)]
    # maps have no hash; rows that differ in them alone are alike
    every = [f"`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    tie = F.xxhash64(F.lit(str(seed)), *every)
    total = docs.count()
    blocks = max(1, -(-total // block_rows))
    rows = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col("doc_id").alias("__doc_id"), tie.alias("tie"),
        crc.alias("crc"), size.alias("bytes"), *[r.alias(f"r{k}") for k, r in enumerate(random)],
        F.pmod(random[0], F.lit(blocks)).cast("int").alias("block"),
    )
    counted = {r["block"]: r["count"] for r in rows.groupBy("block").count().collect()}
    drawn = matrix([counted.get(b, 0) for b in range(blocks)], shards, seed)
    ends = pa.array(np.cumsum(drawn, axis=1).tolist(), pa.list_(pa.int64()))
    ends = spark.createDataFrame(pa.table({"block": pa.array(range(blocks), pa.int32()), "ends": ends}))

    same = ["__doc_id", "crc", "bytes", "tie"]
    key = F.struct("r1", *same)
    # the last row of each block for each shard, with the places of the rows alike: only keys move here
    order = W.partitionBy("block").orderBy("r1", *same)
    peers = order.rangeBetween(W.unboundedPreceding, W.currentRow)
    places = [F.row_number().over(order), F.rank().over(order), F.count("*").over(peers)]
    places = [p.cast("long").alias(n) for p, n in zip(places, ("place", "first", "last"))]
    cuts = rows.select("block", key.alias("key"), *places).join(materialise(ends, "shard-matrix"), "block")
    cuts = cuts.where(F.array_contains("ends", F.col("place"))).groupBy("block").agg(
        F.first("ends").alias("ends"),
        F.map_from_entries(F.collect_list(F.struct("place", F.struct("key", "first", "last")))).alias("at"),
    )

    def cut(end: Column) -> Column:
        at = F.try_element_at("at", end)
        return F.struct(end.alias("end"), at["key"].alias("key"), at["first"].alias("first"), at["last"].alias("last"))

    cuts = materialise(cuts.select("block", F.transform("ends", cut).alias("cuts")), "shard-cuts")
    rows = rows.withColumn("key", key).join(cuts, "block")
    below = F.size(F.filter("cuts", lambda c: c["key"].isNull() | (c["key"] < F.col("key"))))
    # rows alike on both sides of a cut are numbered
    torn = F.filter("cuts", lambda c: F.coalesce((c["key"] == F.col("key")) & (c["last"] > c["end"]), F.lit(False)))
    rows = rows.withColumn("torn", F.get(torn, F.lit(0))["first"])
    alike = rows.where("torn is not null")
    alike = alike.withColumn("place", F.col("torn") - 1 + F.row_number().over(W.partitionBy("block", "key").orderBy("tie")))
    number = F.size(F.filter("cuts", lambda c: c["end"] < F.col("place")))
    columns = ["row", *same, "r2"]
    rows = rows.where("torn is null").select(*columns, below.alias("shard")).unionByName(
        alike.select(*columns, number.alias("shard"))
    )
    ranges = max(1, -(-total // (shards * block_rows)))
    part = F.floor((F.col("r2") / F.lit(2.0**64) + 0.5) * ranges).cast("int")
    rows = rows.select(*columns, "shard", F.least(part, F.lit(ranges - 1)).alias("part"))
    # counted apart, without the rows
    before = F.sum("count").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    before = rows.groupBy("shard", "part").count().select("shard", "part", F.coalesce(before, F.lit(0)).alias("before"))
    before = materialise(before, "shard-parts")
    order = W.partitionBy("shard", "part").orderBy("r2", *same)
    rows = rows.withColumn("place", F.row_number().over(order)).join(before, ["shard", "part"])
    return rows.select("row", "shard", (F.col("before") + F.col("place") - 1).alias("slot"))


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of each row of ``exchanged``, whose output is written and read again; size
    is the UTF-8 bytes of the text plus 16."""
    rows = materialise(exchanged(docs, shards, seed, block_rows), "shards")
    text = whole("row.text").cast("binary")
    size, crc = (F.octet_length(text) + 16).cast("long"), F.crc32(text)
    return rows.select("row.doc_id", size.alias("size"), crc.alias("text_crc32"), "shard", "slot")
