from tickloom.functions.scalars import (
    epoch_seconds_now, fixed_point, from_fixed_point, name_regex, null_if_nan, null_if_token,
    strip_control, strip_control_all, tick_units, time_bucket, to_event_time, to_millis,
)
from tickloom.functions.symbol_sets import known_symbols, missing_symbols, unique_symbols

__all__ = [
    "epoch_seconds_now", "fixed_point", "from_fixed_point", "known_symbols", "missing_symbols", "name_regex",
    "null_if_nan", "null_if_token", "strip_control", "strip_control_all", "tick_units", "time_bucket", "to_event_time",
    "to_millis", "unique_symbols",
]
