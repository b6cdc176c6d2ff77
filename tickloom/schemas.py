"""Declared record layouts: types, required fields, key and time unit of every dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_str, _dbl, _long = T.StringType(), T.DoubleType(), T.LongType()


def _record(
    required: dict[str, T.DataType], optional: dict[str, T.DataType] | None = None, order: str | None = None
) -> T.StructType:
    """A layout; ``order`` names the fields in the order of the record where that is another one. Binary Avro has no
    field names, so there the order counts."""
    fields = [T.StructField(n, t, False) for n, t in required.items()]
    fields += [T.StructField(n, t, True) for n, t in (optional or {}).items()]
    return T.StructType(sorted(fields, key=lambda f: order.split().index(f.name)) if order else fields)


TRADES = _record(
    {"price": _dbl, "symbol": _str, "timestamp": _long, "volume": _dbl},
    {"trade_condition": T.ArrayType(_str, True)},
    "trade_condition price symbol timestamp volume",
)
SYMBOLS = _record({"symbol": _str, "timestamp": _long})
COMPANY_PROFILES = _record(
    {
        "country": _str, "currency": _str, "estimate_currency": _str, "exchange": _str, "industry": _str,
        "ipo": _str, "market_capitalization": _dbl, "name": _str, "phone": _str,
        "share_outstanding": _dbl, "ticker": _str, "weburl": _str, "symbol": _str,
    },
    {"logo": _str},
    "country currency estimate_currency exchange industry ipo logo market_capitalization name phone "
    "share_outstanding ticker weburl symbol",
)
COMPANY_LIST = _record({"symbol": _str, "security": _str})
BIG_TECH_LIST = _record({"company": _str, "country": _str})

COMPANY_SYMBOLS = _record({"symbol": _str}, {"timestamp": _long})
LATEST_PRICES = _record({"symbol": _str, "last_price": _dbl}, {"timestamp": _long})
WINDOW_STATS = _record({"symbol": _str, "count": _long, "timestamp": _long}, {"avg_price": _dbl})
SUMMARY = _record({"timestamp": _long}, {"total_price": _dbl, "symbols": T.ArrayType(_str)})
COMPLETED_TOTAL = _record({"timestamp": _long, "total": _dbl, "known": _long}, {"all_symbols": T.ArrayType(_str)})

# The feed's envelope, one JSON text per message.
MESSAGE = T.StructType([
    T.StructField("type", _str),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("c", T.ArrayType(_str)),
        T.StructField("p", _dbl),
        T.StructField("s", _str),
        T.StructField("t", _long),
        T.StructField("v", _dbl),
    ]))),
])

# Short feed names and profile API names -> column names.
TRADE_COLUMNS = {"c": "trade_condition", "p": "price", "s": "symbol", "t": "timestamp", "v": "volume"}
PROFILE_COLUMNS = {
    "estimateCurrency": "estimate_currency",
    "marketCapitalization": "market_capitalization",
    "shareOutstanding": "share_outstanding",
    "Symbol": "symbol",
}


_AVRO = {_str: "string", _dbl: "double", _long: "long"}


def _avro_type(data_type: T.DataType, nullable: bool) -> object:
    if isinstance(data_type, T.ArrayType):
        kind = {"type": "array", "items": _avro_type(data_type.elementType, data_type.containsNull)}
    else:
        kind = _AVRO[data_type]
    # the branches of the trade record: an array or its absence counts from null, a text's absence comes second
    return (["null", kind] if isinstance(data_type, T.ArrayType) else [kind, "null"]) if nullable else kind


@dataclass(frozen=True)
class Dataset:
    """A named record layout. ``key`` is the partitioning column of its topic."""

    name: str
    schema: T.StructType
    key: str
    path: str | None = None

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def avro_schema(self) -> dict:
        """The layout as an Avro record, for a transport that carries Avro."""
        fields = [{"name": f.name, "type": _avro_type(f.dataType, f.nullable)} for f in self.schema.fields]
        return {"type": "record", "name": self.name, "fields": fields}


DATASETS = {
    d.name: d
    for d in (
        Dataset("trades", TRADES, "symbol"),
        Dataset("symbols", SYMBOLS, "symbol"),
        Dataset("company_profiles", COMPANY_PROFILES, "ticker"),
        Dataset("company_list", COMPANY_LIST, "symbol"),
        Dataset("big_tech_list", BIG_TECH_LIST, "company"),
        Dataset("company_symbols", COMPANY_SYMBOLS, "symbol"),
        Dataset("latest_prices", LATEST_PRICES, "symbol"),
        Dataset("window_stats", WINDOW_STATS, "symbol"),
        Dataset("summary", SUMMARY, "timestamp"),
        Dataset("completed_total", COMPLETED_TOTAL, "timestamp"),
    )
}
