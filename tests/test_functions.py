import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from tickloom import functions as fn


def one(spark, column, **values):
    fields = ", ".join(f"{name} {kind}" for name, (kind, _) in values.items())
    row = [tuple(value for _, value in values.values())]
    return spark.createDataFrame(row, fields).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, clean",
    [("\x00\x1eBTC", "BTC"), ("a\tb\nc\x1f", "abc"), ("\x7f ok\x80", "\x7f ok\x80"), ("", ""), (None, None)],
)
def test_strip_control(spark, text, clean):
    assert one(spark, fn.strip_control(F.col("t")), t=("string", text)) == clean


def test_strip_control_all(spark):
    assert one(spark, fn.strip_control_all(F.col("t")), t=("array<string>", ["\x01A", "B", None])) == ["A", "B", None]


@pytest.mark.parametrize("millis, bucket", [(0, 0), (999, 0), (1000, 1000), (1999, 1000), (-1, -1000), (-1000, -1000)])
def test_time_bucket(spark, millis, bucket):
    assert one(spark, fn.time_bucket(F.col("t"), 1000), t=("bigint", millis)) == bucket


def test_epochs(spark):
    assert one(spark, fn.to_millis(F.col("t"), "s"), t=("bigint", 1_704_067_200)) == 1_704_067_200_000
    assert one(spark, fn.to_millis(F.col("t")), t=("bigint", 1_704_067_200_123)) == 1_704_067_200_123
    back = F.unix_millis(fn.to_event_time(F.col("t")))
    assert one(spark, back, t=("bigint", 1_704_067_200_123)) == 1_704_067_200_123
    with pytest.raises(ValueError):
        fn.to_millis(F.col("t"), "us")


def test_clock_is_in_seconds(spark):
    now = one(spark, fn.epoch_seconds_now(), t=("int", 1))
    assert 1_600_000_000 < now < 10_000_000_000


def test_null_if_nan(spark):
    assert one(spark, fn.null_if_nan(F.col("t")), t=("double", float("nan"))) is None
    assert one(spark, fn.null_if_nan(F.col("t")), t=("double", 1.5)) == 1.5


def test_null_if_token(spark):
    for text, value in (("N/A", None), ("nan", None), ("", None), ("Nan Corp", "Nan Corp")):
        assert one(spark, fn.null_if_token(F.col("t")), t=("string", text)) == value


def test_tick_units(spark):
    for price, units in ((12.34, 1234), (0.1 + 0.2, 30), (-1.5, -150), (1e-9, 0)):
        assert one(spark, fn.tick_units(F.col("t"), 2), t=("double", price)) == units


@pytest.mark.parametrize("price", [1e17, -1e17, float("nan"), float("inf")])
def test_units_out_of_range_raise(spark, price):
    with pytest.raises(ArithmeticException):
        one(spark, fn.tick_units(F.col("t"), 2), t=("double", price))


@pytest.mark.parametrize("digits", [2, 6, 9, 12, 18])
def test_fixed_point_round_trip(spark, digits):
    there = fn.fixed_point(F.col("t"), digits)
    assert one(spark, fn.from_fixed_point(there, digits), t=("double", 1234.56)) == 1234.56
    assert one(spark, fn.from_fixed_point(there, digits), t=("double", None)) is None


def test_name_regex_quotes_on_request():
    assert fn.name_regex("A.B|C") == "(?i)A.B|C"
    assert fn.name_regex("A.B|C", quote=True) == "(?i)\\QA.B\\E|\\QC\\E"


def test_symbol_sets(spark):
    known, traded = ("array<string>", ["b", "a", "c"]), ("array<string>", ["\x01a", "a", "d"])
    unique = fn.unique_symbols(F.col("s"))
    assert one(spark, unique, k=known, s=traded) == ["a", "d"]
    missing = fn.missing_symbols(F.col("k"), unique)
    assert one(spark, missing, k=known, s=traded) == ["b", "c"]
    assert one(spark, fn.known_symbols(missing, unique), k=known, s=traded) == ["a", "b", "c", "d"]
    assert one(spark, F.size(fn.known_symbols(missing, unique)), k=known, s=traded) == 4
