"""Scalar expressions (SCL-1..10). All are built-in Spark functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The control characters U+0000 to U+001F.
CONTROL_CHARS = "[\\x00-\\x1F]+"

# Texts read as "no value" in a cached CSV.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The most decimal places kept as a 64-bit number of units: prices up to nine billion at nine places.
INTEGER_DIGITS = 9


def strip_control(text: Column) -> Column:
    """SCL-4: the text without control characters."""
    return F.regexp_replace(text, CONTROL_CHARS, "")


def strip_control_all(texts: Column) -> Column:
    """SCL-4 on every element of an array."""
    return F.transform(texts, strip_control)


def to_millis(epoch: Column, unit: str = "ms") -> Column:
    """Epoch value in ``unit`` ('s' or 'ms') as epoch milliseconds."""
    if unit not in ("s", "ms"):
        raise ValueError(f"unknown epoch unit {unit!r}")
    millis = epoch.cast("bigint")
    return millis * 1000 if unit == "s" else millis


def to_event_time(millis: Column) -> Column:
    """SCL-8: epoch milliseconds as a timestamp, the type watermarks need."""
    return F.timestamp_millis(millis)


def epoch_seconds_now() -> Column:
    """SCL-7: the clock in whole seconds, one value per query."""
    return F.unix_seconds(F.current_timestamp())


def time_bucket(millis: Column, size_ms: int) -> Column:
    """Start of the epoch-aligned bucket that holds ``millis``; also right before 1970."""
    return millis - F.pmod(millis, F.lit(size_ms).cast("bigint"))


def null_if_nan(value: Column) -> Column:
    """FLT-9 for one floating-point column."""
    return F.when(~F.isnan(value), value)


def null_if_token(text: Column) -> Column:
    """A CSV text as null when it is one of ``NULL_TOKENS``."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def name_regex(pattern: str, quote: bool = False) -> str:
    """A ``|``-joined list of names as a case-insensitive regex.

    Names are regex fragments unless ``quote`` is set, so ``.`` matches any character.
    """
    if quote:
        pattern = "|".join(f"\\Q{name}\\E" for name in pattern.split("|"))
    return f"(?i){pattern}"


def tick_units(value: Column, digits: int) -> Column:
    """A price as a whole number of ``10**-digits`` units; sums of it do not depend on row order.

    The cast checks its range in ANSI mode: a price that does not fit, or NaN, raises, as does a sum that
    overflows. NaN is no price: operators make it null first (``null_if_nan``).
    """
    return F.rint(value * F.lit(float(10**digits))).cast("bigint")


def fixed_point(value: Column, digits: int) -> Column:
    """A double with ``digits`` decimal places, for exact sums; ``from_fixed_point`` turns sums back.

    Up to ``INTEGER_DIGITS`` places it is a whole number of units, which is several times faster to add;
    beyond that a 38-digit decimal. In both forms a value that cannot be kept, NaN too, raises.
    """
    if digits <= INTEGER_DIGITS:
        return tick_units(value, digits)
    kind = T.DecimalType(38, digits)
    kept = value.try_cast(kind)
    lost = F.raise_error(F.lit("a price does not fit its decimal places")).cast(kind)
    return F.when(value.isNotNull() & kept.isNull(), lost).otherwise(kept)


def from_fixed_point(total: Column, digits: int) -> Column:
    """A sum of ``fixed_point`` values as a double."""
    total = total.cast("double")
    return total / F.lit(float(10**digits)) if digits <= INTEGER_DIGITS else total
