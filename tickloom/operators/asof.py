"""As-of lookup (JOIN-1b): the table row in force when an event arrived."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# Rows of a key that one task sorts, where the chunk is measured; message numbers of a chunk where it is not.
CHUNK_ROWS = 1_000_000
UNPLACED_GROUPS = 1024
# The chunk of what is carried over from earlier slices; no order column comes near it.
FIRST_CHUNK = -(1 << 62)


def as_of(
    events: DataFrame,
    changes: DataFrame,
    key: str,
    values: Sequence[str],
    *,
    order: str | Sequence[str] = "offset",
    chunk: int | None = CHUNK_ROWS,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Each event with ``values`` of the latest change of its key at or before it; null before the first.

    ``order`` names whole-number columns of both sides, compared one after the other: for example
    (offset, position) for trades in messages, or (time, topic, partition, offset) for records of several
    topics. An event or change that lacks one has no place: such an event gets nulls, such a change is left out.

    Events and changes are laid in one sequence per key and the last change is carried forward. The
    sequence is cut by the first order column into chunks of ``chunk`` values, so that a hot key is many
    groups; a chunk starts with the change carried over from earlier chunks, found on one row per key and
    chunk. Where the values are not used densely, ``chunk=None`` measures their spacing first (one aggregate
    over both sides, part of the same plan) and makes chunks of about ``CHUNK_ROWS`` rows.

    ``carry`` has a row (``key`` and ``values``) for keys whose last change lies before all rows here, in an earlier
    slice of a stream.

    Each side is read once, or twice if the spacing is measured, and moved once.
    """
    order = [order] if isinstance(order, str) else list(order)
    placed = _all(F.col(c).isNotNull() for c in [key, *order])
    change = F.struct(*values).alias("change")
    name = F.when(placed, F.col(key)).alias("_key")
    at = [F.when(placed, F.col(c).cast("bigint")).alias(f"_{i}") for i, c in enumerate(order)]
    asked = events.select(name, *at, F.lit(1).alias("_side"), F.struct(*events.columns).alias("event"))
    arrivals = changes.where(placed).select(name, *at, F.lit(0).alias("_side"), change)
    laid = asked.unionByName(arrivals, allowMissingColumns=True)
    # Events without a place find nothing, in whichever group they are.
    anywhere = F.floor(F.rand(7) * UNPLACED_GROUPS)
    laid = laid.withColumn("_chunk", F.when(F.col("_key").isNull(), anywhere).otherwise(_slot(laid, chunk)))
    laid = laid.repartition("_key", "_chunk")

    place = [f"_{i}" for i in range(len(order))]
    so_far = W.partitionBy("_key", "_chunk").orderBy(*place, "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = laid.withColumn("change", F.last("change", ignorenulls=True).over(so_far)).where("_side = 1")

    newest = F.when(F.col("change").isNotNull(), F.struct(*place))
    tails = laid.where("_key IS NOT NULL").groupBy("_key", "_chunk").agg(F.max_by("change", newest).alias("tail"))
    if carry is not None:
        kind = laid.schema["_chunk"].dataType
        before = carry.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.lit(FIRST_CHUNK).cast(kind).alias("_chunk"), change.alias("tail"))
        tails = tails.unionByName(before)
    earlier = W.partitionBy("_key").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = tails.select("_key", "_chunk", F.last("tail", ignorenulls=True).over(earlier).alias("carried"))
    found = inside.join(carried, ["_key", "_chunk"], "left")
    found = found.withColumn("change", F.coalesce("change", "carried"))
    return found.select("event.*", *[F.col(f"change.{v}").alias(v) for v in values])


def _all(conditions) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def _slot(laid: DataFrame, chunk: int | None) -> Column:
    """The chunk of a row, in whole numbers: offsets may lie above 2^53."""
    if chunk is not None:
        return F.expr(f"_0 div {chunk}L - if(_0 % {chunk}L < 0, 1, 0)")
    span = F.expr("CAST(max(_0) AS DECIMAL(38, 0)) - min(_0) + 1")
    width = F.greatest(F.lit(1), F.ceil(span * CHUNK_ROWS / F.greatest(F.count("*"), F.lit(1)))).cast("bigint")
    measured = laid.agg(width.alias("width")).scalar()
    return F.floor(F.col("_0") - F.pmod(F.col("_0"), measured))


def running_latest(
    df: DataFrame,
    key: str,
    columns: Mapping[str, str],
    *,
    order: str | Sequence[str] = "offset",
    chunk: int | None = CHUNK_ROWS,
    carry: DataFrame | None = None,
) -> DataFrame:
    """STR-5 with a row for each record: every row with the latest non-null value of each column at it, by ``order``.

    ``columns`` maps input to output names; each is resolved on its own. It is what a table of the latest values by key holds
    after the record. Rows without a key or a place belong to no group and are left out. As in ``as_of`` a key is cut
    into chunks, so a hot one is many groups, and ``carry`` (``key`` and the output columns) holds what was known before.
    """
    order = [order] if isinstance(order, str) else list(order)
    placed = _all(F.col(c).isNotNull() for c in [key, *order])
    at = [F.col(c).cast("bigint").alias(f"_{i}") for i, c in enumerate(order)]
    laid = df.where(placed).select(F.col(key).alias("_key"), *at, F.struct(*df.columns).alias("row"))
    laid = laid.withColumn("_chunk", _slot(laid, chunk)).repartition("_key", "_chunk")
    place = [f"_{i}" for i in range(len(order))]
    so_far = W.partitionBy("_key", "_chunk").orderBy(*place).rowsBetween(W.unboundedPreceding, W.currentRow)
    latest = lambda c: F.last(f"row.{c}", ignorenulls=True).over(so_far).alias(f"_new_{c}")
    inside = laid.select("_key", "_chunk", "row", *[latest(c) for c in columns])

    newest = lambda c: F.max_by(f"row.{c}", F.when(F.col(f"row.{c}").isNotNull(), F.struct(*place))).alias(f"_old_{c}")
    tails = laid.groupBy("_key", "_chunk").agg(*[newest(c) for c in columns])
    if carry is not None:
        kind = laid.schema["_chunk"].dataType
        known = [F.col(out).alias(f"_old_{c}") for c, out in columns.items()]
        before = carry.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.lit(FIRST_CHUNK).cast(kind).alias("_chunk"), *known)
        tails = tails.unionByName(before)
    earlier = W.partitionBy("_key").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    older = [F.last(f"_old_{c}", ignorenulls=True).over(earlier).alias(f"_old_{c}") for c in columns]
    found = inside.join(tails.select("_key", "_chunk", *older), ["_key", "_chunk"], "left")
    return found.select("row.*", *[F.coalesce(f"_new_{c}", f"_old_{c}").alias(out) for c, out in columns.items()])
