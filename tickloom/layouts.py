"""Versions of a record layout (DDL-5, SCL-10, FLT-5): what a writer of one version wrote, read in another.

A topic's layouts are registered one after the other, and each must be able to read all before it. A record names the version that
it was written in. Reading compiles one expression per version, so records of all versions are read in one pass:

- a field that the writer lacks takes the reader's default; without one the layouts do not fit, and registering fails;
- a number may become a wider one (int, long, float, double, in this order); any other change of type does not fit;
- a field that the reader lacks is dropped;
- a null where the reader's field may not be null, or a value that is not of the writer's type, makes the record invalid.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Numbers by width: each may be read as any later one.
WIDER = (T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType())
_NONE = object()


class LayoutError(ValueError):
    """Two layouts of a topic that do not fit."""


@dataclass(frozen=True)
class Field:
    """A field of a layout; ``default`` is what readers take where a writer does not have it."""

    name: str
    kind: T.DataType
    nullable: bool = False
    default: object = _NONE

    @property
    def has_default(self) -> bool:
        return self.default is not _NONE


@dataclass(frozen=True)
class Layout:
    fields: tuple[Field, ...]

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if len(names) != len(set(names)):
            raise LayoutError(f"a field is named twice: {names}")
        for f in self.fields:
            if f.has_default and f.default is None and not f.nullable:
                raise LayoutError(f"{f.name}: the default is null, which the field may not be")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.kind) for f in self.fields])

    def get(self, name: str) -> Field | None:
        return next((f for f in self.fields if f.name == name), None)


def promoted(name: str, writer: T.DataType, reader: T.DataType) -> T.DataType:
    """The reader's type, if a value of the writer's can be read as it."""
    if isinstance(writer, T.ArrayType) and isinstance(reader, T.ArrayType):
        promoted(name, writer.elementType, reader.elementType)
        return reader
    if writer == reader or (writer in WIDER and reader in WIDER and WIDER.index(writer) <= WIDER.index(reader)):
        return reader
    raise LayoutError(f"{name}: {writer.simpleString()} cannot be read as {reader.simpleString()}")


def resolved(row: Column, writer: Layout, reader: Layout) -> Column:
    """A struct of the writer's layout as one of the reader's."""
    found = []
    for f in reader.fields:
        written = writer.get(f.name)
        if written is not None:
            value = row.getField(f.name).cast(promoted(f.name, written.kind, f.kind))
        elif f.has_default:
            value = F.lit(f.default).cast(f.kind)
        else:
            raise LayoutError(f"{f.name}: the writer does not have it and it has no default")
        found.append(value.alias(f.name))
    return F.struct(*found)


@dataclass
class Layouts:
    """The registered layouts of a topic, by version from 1 on."""

    versions: dict[int, Layout] = field(default_factory=dict)

    def register(self, layout: Layout) -> int:
        """The version of a layout; a layout that is the newest already keeps its version. Raises if it cannot read all before it."""
        if self.versions and self.versions[self.newest] == layout:
            return self.newest
        for version, writer in self.versions.items():
            try:
                _check(writer, layout)
            except LayoutError as error:
                raise LayoutError(f"records of version {version} could not be read: {error}") from None
        self.versions[len(self.versions) + 1] = layout
        return len(self.versions)

    @property
    def newest(self) -> int:
        if not self.versions:
            raise LayoutError("no layout is registered")
        return max(self.versions)


def _check(writer: Layout, reader: Layout) -> None:
    for f in reader.fields:
        written = writer.get(f.name)
        if written is not None:
            promoted(f.name, written.kind, f.kind)
        elif not f.has_default:
            raise LayoutError(f"{f.name}: the writer does not have it and it has no default")


def read_versions(records: DataFrame, layouts: Layouts, version: int | None = None, *, value: str = "value", written: str = "version") -> DataFrame:
    """``records`` with ``row``, their value in the layout of ``version`` (the newest if none is given), and ``fault``, null for a valid
    record: ``version`` for one that is not registered, else the names of the fields that have no value.

    ``value`` is JSON, ``written`` the version of the writer. The record is parsed once, in its own layout. A tombstone has a null row and no fault.
    """
    reader = layouts.versions[layouts.newest if version is None else version]
    rows = F.lit(None).cast(reader.schema)
    for number, writer in layouts.versions.items():
        parsed = F.from_json(F.col(value).cast("string"), writer.schema, {"mode": "PERMISSIVE"})
        own = F.col(written) == number
        rows = F.when(own, resolved(parsed, writer, reader)).otherwise(rows)
    # out of a one-element explode: a plain column would be parsed again in each use
    rows = F.explode(F.array(F.when(F.col(value).isNotNull(), rows))).alias("row")
    found = records.select(F.struct(*records.columns).alias("_record"), F.col(value).alias("_value"), F.col(written).alias("_version"), rows)
    lacking = F.array_compact(F.array(*[F.when(F.col(f"row.{f.name}").isNull(), F.lit(f.name)) for f in reader.fields if not f.nullable]))
    known = F.coalesce(F.col("_version").isin(*layouts.versions), F.lit(False))
    fault = F.when(F.col("_value").isNull(), None).when(~known, "version").when(F.size(lacking) > 0, F.array_join(lacking, ","))
    return found.select("_record.*", F.when(fault.isNull(), F.col("row")).alias("row"), fault.alias("fault"))
