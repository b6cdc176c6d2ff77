"""Dense numbers over distributed rows (SRC-4, SNK-7): one sequence over several topics, offsets inside partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.session import shared_dir

# monotonically_increasing_id: the number of the task above, the row in its task below.
_TASK_BITS = 33


def numbered(rows: DataFrame, order: Sequence[str], name: str = "position", *, within: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``name``, their numbers 0, 1, ... by ``order``, counted apart for each group of ``within``.

    No task sorts more than its range: rows are dealt to ranges of (within, order), sorted there and written with
    their place in the range. One row per range, and one per group that begins in it, are all that is needed from
    others. Nulls come first; rows that agree in ``order`` are numbered in the order of their other columns that can be sorted, and
    equal rows in any.
    """
    others = [c for c in rows.columns if c not in {*within, *order} and rows.schema[c].dataType.typeName() != "map"]
    # ranges are cut at every column, so that ties are many tasks
    keys = [*within, *order, *[c for c in others if rows.schema[c].dataType.typeName() not in ("array", "struct")]]
    ranged = rows.repartitionByRange(*keys, F.monotonically_increasing_id()).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    ranged = ranged.withColumn("_task", F.shiftright(place, _TASK_BITS)).withColumn("_row", place.bitwiseAND(F.lit((1 << _TASK_BITS) - 1)))
    path = shared_dir(rows.sparkSession, "numbered")
    ranged.write.parquet(path)
    written = rows.sparkSession.read.schema(ranged.schema).parquet(path)

    # a row per task: their number is that of the partitions
    sizes = written.groupBy("_task").agg(F.count("*").alias("n"))
    before = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    position = F.col("_row") + F.col("_base")
    if within:
        # a group's first number: it lies in the first task that has rows of it
        heads = written.groupBy(*within, "_task").agg(F.min("_row").alias("_row")).join(bases, "_task")
        heads = heads.groupBy(*within).agg(F.min(position).alias("_first"))
        same = _all_equal([F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in within])
        written = written.join(bases, "_task").alias("r").join(heads.alias("h"), same)
        return written.select(*[f"r.{c}" for c in rows.columns], (position - F.col("_first")).alias(name))
    return written.join(bases, "_task").select(*rows.columns, position.alias(name))


def _all_equal(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def consumed_sequence(records: DataFrame, order: Sequence[str] = ("arrival", "topic", "offset"), name: str = "position") -> DataFrame:
    """SRC-4: the records of several topics as the one sequence in which a consumer of all of them reads them: by time, then
    topic, then offset; ``name`` numbers them from 0."""
    return numbered(records, order, name)
