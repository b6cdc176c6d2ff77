"""Plain-Python definitions of the operators, for small fixtures."""

from __future__ import annotations

from collections import defaultdict


def window_rows(trades, size_ms):
    """{(window, symbol): (average, last price)} of (symbol, price, timestamp, offset) tuples with a price."""
    groups = defaultdict(list)
    for symbol, price, timestamp, offset in trades:
        if symbol is not None and price is not None:
            groups[timestamp // size_ms * size_ms, symbol].append((offset, price))
    return {
        key: (sum(p for _, p in prices) / len(prices), max(prices)[1]) for key, prices in groups.items()
    }


def completed(trades, size_ms):
    """[(window, total, known symbols)] by walking over all windows and all symbols."""
    rows = window_rows(trades, size_ms)
    last, result = {}, []
    for window in sorted({w for w, _ in rows}):
        now = {s: row for (w, s), row in rows.items() if w == window}
        known = sorted(set(last) | set(now))
        total = sum(now[s][0] if s in now else last[s] for s in known)
        result.append((window, round(total, 6), known))
        last.update({s: row[1] for s, row in now.items()})
    return result


def as_of(events, changes):
    """[(offset, value)]: the value of the key's last change at or before each event."""
    result = []
    for key, offset in events:
        seen = [(o, v) for k, o, v in changes if k is not None and k == key and o <= offset]
        result.append((offset, max(seen, key=lambda c: c[0])[1] if seen else None))
    return sorted(result)
