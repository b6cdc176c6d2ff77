"""Versions of a record layout: what fits is read, what does not raises."""

import json

import pytest
from pyspark.sql import types as T

from tickloom.layouts import Field, Layout, LayoutError, Layouts, read_versions

INT, LONG, DOUBLE, STRING = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
ONE = Layout((Field("symbol", STRING), Field("price", INT), Field("note", STRING, nullable=True)))
TWO = Layout((Field("symbol", STRING), Field("price", LONG), Field("tags", T.ArrayType(INT), default=[])))
THREE = Layout((
    Field("symbol", STRING), Field("price", DOUBLE), Field("volume", DOUBLE, default=1.5), Field("venue", STRING, nullable=True, default=None),
    Field("tags", T.ArrayType(LONG), nullable=True, default=None),
))


@pytest.fixture
def layouts():
    found = Layouts()
    assert [found.register(x) for x in (ONE, TWO, THREE, THREE)] == [1, 2, 3, 3]
    return found


RECORDS = [
    (1, 1, {"symbol": "a", "price": 3, "note": "x"}), (2, 2, {"symbol": "b", "price": 2**40, "tags": [1, 2]}),
    (3, 3, {"symbol": "c", "price": 0.25, "volume": 2.0, "venue": "v", "tags": [2**40], "more": 1}), (4, 3, {"symbol": "d", "price": 1.0, "volume": 1.0}),
    (5, 1, {"symbol": None, "price": 1}), (6, 2, {"price": 1, "tags": []}), (7, 9, {"symbol": "z"}), (8, None, {"symbol": "z"}), (9, 2, None),
    (10, 1, {"symbol": "e", "price": "three"}), (11, 3, {"symbol": "f", "price": 1.0, "volume": None}),
]


def read(spark, layouts, version=None):
    rows = [(k, v, None if x is None else json.dumps(x), 0) for k, v, x in RECORDS] + [(12, 1, "no json", 0)]
    frame = spark.createDataFrame(rows, "offset int, version int, value string, row int").drop("row").withColumnRenamed("offset", "fault")
    return {r[0]: (r[-2] and tuple(r[-2]), r[-1]) for r in read_versions(frame, layouts, version).collect()}


def test_records_of_all_versions_in_the_newest(spark, layouts):
    found = read(spark, layouts)
    assert {k: v for k, v in found.items() if v[1] is None} == {
        1: (("a", 3.0, 1.5, None, None), None), 2: (("b", float(2**40), 1.5, None, [1, 2]), None),
        3: (("c", 0.25, 2.0, "v", [2**40]), None), 4: (("d", 1.0, 1.0, None, None), None), 9: (None, None),
    }
    assert {k: v for k, v in found.items() if v[1] is not None} == {
        5: (None, "symbol"), 6: (None, "symbol"), 7: (None, "version"), 8: (None, "version"), 10: (None, "price"), 11: (None, "volume"),
        12: (None, "symbol,price"),
    }


def test_records_in_an_older_version(spark):
    layouts = Layouts()
    for x in (ONE, Layout((Field("symbol", STRING), Field("price", INT), Field("extra", INT, default=7)))):
        layouts.register(x)
    with pytest.raises(LayoutError):
        read_versions(spark.createDataFrame([], "version int, value string"), Layouts())
    frame = spark.createDataFrame([(2, '{"symbol":"a","price":1,"extra":2}')], "version int, value string")
    with pytest.raises(LayoutError, match="note"):
        read_versions(frame, layouts, 1)
    assert tuple(read_versions(frame, layouts).first()["row"]) == ("a", 1, 2)


@pytest.mark.parametrize("layout, message", [
    (Layout((Field("symbol", STRING), Field("price", STRING))), "price"),
    (Layout((Field("symbol", STRING), Field("price", INT), Field("new", INT))), "new"),
    (Layout((Field("symbol", T.ArrayType(STRING)), Field("price", INT))), "symbol"),
    (Layout((Field("symbol", INT), Field("price", INT))), "symbol"),
])
def test_illegal_changes_raise(layout, message):
    layouts = Layouts()
    layouts.register(ONE)
    with pytest.raises(LayoutError, match=message):
        layouts.register(layout)
    assert layouts.newest == 1


def test_narrower_numbers_and_bad_layouts_raise():
    layouts = Layouts()
    layouts.register(TWO)
    with pytest.raises(LayoutError, match="bigint cannot be read as int"):
        layouts.register(ONE)
    with pytest.raises(LayoutError, match="twice"):
        Layout((Field("a", INT), Field("a", INT)))
    with pytest.raises(LayoutError, match="default is null"):
        Layout((Field("a", INT, default=None),))
