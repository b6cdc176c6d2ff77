"""Hard negatives by exact inner products, scored with subset-sum tables (the method of the Four Russians).

Components are whole numbers. A candidate is packed into bit planes: a byte holds one bit of eight components, and the last
plane is the sign's. For each eight dimensions an anchor has a table of the sums of all 256 subsets of its components. A
plane of a candidate's eight dimensions then is one lookup; the lookups of all dimensions are added, and the planes,
highest first, by shifting the sum so far. The result is the exact inner product.

Anchors are scored against all rows in blocks: a task holds one block of anchors and one of candidates. It returns the best
few of each anchor, and a window over these picks the best of all. Two such passes are needed, one over rows of the
anchor's label, one over the others, as the scores that negatives may have depend on the positives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative scores between this part of the positive's score, in hundredths, and all of it.
NEAR = 80
#: Rows of a block: no more anchors, and of candidates between these two (a few blocks for each core of a small cluster first).
ANCHORS, CANDIDATES, FEW, BLOCKS = 4_096, 65_536, 2_048, 64
#: Rows and anchors that are scored at once.
_ROWS, _WIDE = 4_096, 64
#: Components beyond this are an error: scores would not fit.
_MOST = 1 << 27


def pack(values: np.ndarray) -> np.ndarray:
    """Bit planes (rows, planes, bytes) of whole numbers (rows, dimensions); the last plane is the sign."""
    most = max(int(values.max(initial=0)), ~int(values.min(initial=0)))
    planes = most.bit_length() + 1
    bits = [np.packbits(((values >> b) & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(planes)]
    return np.stack(bits, axis=1)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables (groups of eight dimensions, 256 subsets, anchors) of the sums of an anchor's components."""
    n, dims = anchors.shape
    wide = np.zeros((n, -(-dims // 8) * 8), anchors.dtype)
    wide[:, :dims] = anchors
    parts = np.ascontiguousarray(wide.reshape(n, -1, 8).transpose(1, 2, 0))
    tables = np.zeros((parts.shape[0], 256, n), anchors.dtype)
    for j in range(8):
        tables[:, 1 << j : 2 << j] = tables[:, : 1 << j] + parts[:, j : j + 1]
    return tables


def scores(planes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products (rows, anchors) of packed rows with anchors (anchors, dimensions)."""
    rows, depth, groups = planes.shape
    dims = max(groups * 8, anchors.shape[1])
    bound = int(np.abs(anchors).max(initial=0)) * dims << depth
    kind = np.int32 if bound < 1 << 31 else np.int64
    found = np.zeros((rows, len(anchors)), np.int64)
    for first in range(0, len(anchors), _WIDE):
        tables = subset_sums(anchors[first : first + _WIDE].astype(kind))
        for low in range(0, rows, _ROWS):
            own = planes[low : low + _ROWS]
            total = np.zeros((len(own), tables.shape[2]), kind)
            for b in reversed(range(depth)):
                total <<= 1
                for g in range(min(groups, len(tables))):
                    if b == depth - 1:
                        total -= tables[g][own[:, b, g]]
                    else:
                        total += tables[g][own[:, b, g]]
            found[low : low + _ROWS, first : first + _WIDE] = total
    return found


def best(score: np.ndarray, names: np.ndarray, few: int) -> np.ndarray:
    """The places of the few highest scores, ties by smaller name."""
    if len(score) > few:
        some = np.flatnonzero(score >= np.partition(score, len(score) - few)[len(score) - few])
    else:
        some = np.arange(len(score))
    return some[np.lexsort((names[some], -score[some]))][:few]


def usable(rows: DataFrame, anchors: Column, scale: int = SCALE) -> DataFrame:
    """vec_id, label, values (whole numbers) and anchor of the rows that take part."""
    own = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    finite = F.forall(own, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.where(F.coalesce(finite, F.lit(False)))
    limit = float(1 << 62)
    whole = F.transform(own, lambda x: F.floor(F.greatest(F.least(F.floor(x * float(scale)).cast("double"), F.lit(limit)), F.lit(-limit))))
    names = [F.col(c).cast("long").alias(c) for c in ("vec_id", "label")]
    return rows.select(*names, whole.alias("values"), F.coalesce(anchors, F.lit(False)).alias("anchor"))


def packed(rows: DataFrame) -> DataFrame:
    """vec_id, label, planes (bytes) and, of anchors, vector (bytes) of the rows of ``usable``; equal rows once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(width).tolist():
                some = batch.take(pa.array(np.flatnonzero(width == dims)))
                values = some.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(some.num_rows, dims)
                if dims and (values.max() >= _MOST or values.min() < -_MOST):
                    raise ValueError(f"a component beyond {_MOST // SCALE} times the scale: its scores would not fit")
                # one number of planes for each row, so that a row's bytes do not depend on its batch
                depth = np.frompyfunc(lambda x: int(x).bit_length() + 1, 1, 1)(np.maximum(values, ~values).max(axis=1, initial=0))
                for planes in np.unique(depth.astype(int)).tolist():
                    here = np.flatnonzero(depth == planes)
                    bits = pack(values[here]) if dims else np.zeros((len(here), 1, 0), np.uint8)
                    head = planes.to_bytes(1, "little")
                    own = some.take(pa.array(here))
                    vectors = [values[k].astype("<i4").tobytes() if a else None for k, a in zip(here, own.column(3).to_pylist())]
                    columns = [pa.array([head + x.tobytes() for x in bits], pa.binary()), pa.array(vectors, pa.binary())]
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), *columns], names=["vec_id", "label", "planes", "vector"])

    return rows.mapInArrow(work, "vec_id long, label long, planes binary, vector binary").distinct()


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    """The planes of rows, all with as many planes and bytes as the largest: a sign is repeated, a missing component is 0."""
    raw = [x.as_py() for x in column]
    depth = np.array([x[0] for x in raw])
    groups = np.array([(len(x) - 1) // x[0] for x in raw])
    most = (len(raw), int(depth.max(initial=1)), int(groups.max(initial=0)))
    found = np.zeros(most, np.uint8)
    for d, g in sorted(set(zip(depth.tolist(), groups.tolist()))):
        here = np.flatnonzero((depth == d) & (groups == g))
        own = np.frombuffer(b"".join(raw[k][1:] for k in here), np.uint8).reshape(len(here), d, g)
        found[here, :d, :g] = own
        found[here, d:, :g] = own[:, -1:]
    return found


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    raw = [np.frombuffer(x.as_py(), "<i4") for x in column]
    found = np.zeros((len(raw), max(map(len, raw), default=0)), np.int64)
    for k, x in enumerate(raw):
        found[k, : len(x)] = x
    return found


def _blocks(rows: int, most: int, few: int) -> int:
    return max(1, -(-rows // most), min(BLOCKS, -(-rows // few)))


def hard_negatives(rows: DataFrame, anchors: Column, near: int = NEAR, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each anchor (a row where anchors holds) and each of
    its positives the first negatives.

    rows needs vec_id, label and embedding; other columns are ignored, but anchors may use them. Rows with a null in one of the three, or with a
    component that is null or not finite, take no part. Equal rows (id, label and components) count as one; rows that share an id and
    differ are rows of their own. Vectors of different lengths are compared as if zeros followed. Ties go by smaller
    vec_id. A component of 2^27 / scale or more is an error. An empty table gives an empty result.
    """
    table = materialise(packed(usable(rows, anchors, scale)), "packed")
    counts = table.agg(F.count("*"), F.count("vector")).first()
    right, left = _blocks(counts[0], CANDIDATES, FEW), max(1, -(-counts[1] // ANCHORS))
    name = F.xxhash64("vec_id", "label", "planes")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = table.select(
        each(left).alias("i"), F.pmod(name, F.lit(right)).cast("int").alias("j"), "vec_id", "label", name.alias("name"), "planes",
        F.lit(None).cast("binary").alias("vector"), F.lit(None).cast("array<struct<id:bigint,score:bigint,name:bigint>>").alias("positives"),
    )
    asked = table.where("vector is not null").select(
        F.pmod(name, F.lit(left)).cast("int").alias("i"), each(right).alias("j"), "vec_id", "label", name.alias("name"), "vector"
    )

    def positives(group: pa.Table) -> pa.Table:
        found = []
        for k, anchor, score, own in _scored(group):
            others = np.flatnonzero(own["name"] != anchor["name"][k])
            for at in others[best(score[others], own["vec_id"][others], POSITIVES)]:
                found.append((anchor["vec_id"][k], anchor["label"][k], anchor["name"][k], own["vec_id"][at], score[at], own["name"][at]))
        return _table(found, "anchor_id label anchor id score name")

    same = candidates.unionByName(asked, allowMissingColumns=True)
    found = same.groupBy("label", "i", "j").applyInArrow(
        positives, "anchor_id long, label long, anchor long, id long, score long, name long"
    )
    order = W.partitionBy("anchor_id", "anchor").orderBy(F.desc("score"), "id", "name")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= POSITIVES)
    found = found.groupBy("anchor_id", "anchor").agg(F.collect_list(F.struct("id", "score", "name")).alias("positives"))
    found = materialise(found, "positives")
    known = asked.join(found.select(F.col("anchor_id").alias("vec_id"), F.col("anchor").alias("name"), "positives"), ["vec_id", "name"])

    def negatives(group: pa.Table) -> pa.Table:
        out = []
        for k, anchor, score, own in _scored(group):
            others = np.flatnonzero(own["label"] != anchor["label"][k])
            scaled = 100 * score[others]
            for positive in anchor["positives"][k]:
                most = positive["score"]
                some = others[(scaled >= near * most) & (scaled <= 100 * most)]
                for at in some[best(score[some], own["vec_id"][some], NEGATIVES)]:
                    names = (anchor["vec_id"][k], anchor["name"][k], positive["id"], positive["name"], most)
                    out.append((*names, own["vec_id"][at], score[at], own["name"][at]))
        return _table(out, "anchor_id anchor positive_id positive positive_score negative_id negative_score name")

    other = candidates.unionByName(known, allowMissingColumns=True)
    kinds = "anchor_id long, anchor long, positive_id long, positive long, positive_score long, negative_id long, negative_score long, name long"
    mined = other.groupBy("i", "j").applyInArrow(negatives, kinds)
    order = W.partitionBy("anchor_id", "anchor", "positive_id", "positive").orderBy(F.desc("negative_score"), "negative_id", "name")
    mined = mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _scored(group: pa.Table) -> Iterator[tuple[int, dict, np.ndarray, dict]]:
    """For each anchor of a task its place among the task's anchors, these, the scores of all candidates, and those."""
    asking = pa.compute.is_valid(group.column("vector"))
    anchors, rows = group.filter(asking), group.filter(pa.compute.invert(asking))
    if not anchors.num_rows or not rows.num_rows:
        return
    columns = ("vec_id", "label", "name")
    own = {c: rows.column(c).to_numpy() for c in columns}
    planes = _unpacked(rows.column("planes"))
    for first in range(0, anchors.num_rows, _WIDE):
        few = anchors.slice(first, _WIDE)
        named = {c: few.column(c).to_numpy() for c in columns} | {"positives": few.column("positives").to_pylist()}
        found = np.ascontiguousarray(scores(planes, _vectors(few.column("vector"))).T)
        for k in range(few.num_rows):
            yield k, named, found[k], own


def _table(rows: list[tuple], names: str) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in names.split()]
    return pa.table({n: pa.array(np.array(c, np.int64)) for n, c in zip(names.split(), columns)})
