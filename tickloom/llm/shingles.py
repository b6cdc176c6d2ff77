"""Word shingles of texts as sorted arrays of 64-bit hashes, a chunk of texts at a time.

A word is a run of bytes without ASCII white space, A-Z lower-cased; a shingle is five words in a row. A text
of one to four words has one shingle, the whole of it; an empty or null text has none. Hashes come from whole
words and are mixed to 64 bits; two different shingles collide with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
#: Text bytes that are hashed at once; a longer text is a chunk of its own.
CHUNK_BYTES = 512 << 10
#: Texts whose sets are held at once.
CHUNK_TEXTS = 1_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_RANDOM = np.random.default_rng(7)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, WIDTH + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Added to a shingle of so many words; arrays, as only these wrap round silently.
_COUNT = np.arange(WIDTH + 1, dtype=np.uint64) * _PLACE[WIDTH:]
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) for pieces of a string array of about ``CHUNK_BYTES``."""
    texts = texts.fill_null("")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words_at(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A hash for every word of a chunk, each text's first place among them (one more entry at the end), and every
    word's first byte and number of bytes."""
    inside = ~_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    start[borders] = inside[borders]
    first = np.flatnonzero(start)
    places = np.searchsorted(first, offsets, "left")
    if not len(first):
        return np.zeros(0, np.uint64), places, first, first
    at = np.flatnonzero(inside)
    begin = np.searchsorted(at, first)
    length = np.diff(np.append(begin, len(at)))
    place = np.arange(len(at)) - np.repeat(begin, length)
    power = np.cumprod(np.full(int(length.max()), _BASE, np.uint64))
    sums = np.add.reduceat(_BYTE[_LOWER[data[at]]] * power[place], begin)
    return mix(sums + length.astype(np.uint64) * _PLACE[0]), places, first, length


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word of a chunk, and each text's first place among them (one more entry at the end)."""
    return words_at(data, offsets)[:2]


def shingle_rows(hashes: np.ndarray) -> np.ndarray:
    """The hash of the shingle that begins at each word and lies in the chunk."""
    n = len(hashes) - WIDTH + 1
    rows = np.full(max(n, 0), _COUNT[WIDTH], np.uint64)
    for k in range(WIDTH if n > 0 else 0):
        rows += hashes[k : k + n] * _PLACE[k]
    return mix(rows)


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct shingle hashes) of every text."""
    for base, data, offsets in chunks(texts):
        hashes, places = word_hashes(data, offsets)
        rows = shingle_rows(hashes)
        for i in range(len(offsets) - 1):
            low, high = places[i], places[i + 1]
            if high - low >= WIDTH:
                own = np.sort(rows[low : high - WIDTH + 1])
                own = own[np.append(True, own[1:] != own[:-1])]
            elif high > low:
                few = hashes[low:high]
                own = mix((few * _PLACE[: len(few)]).sum(keepdims=True) + _COUNT[len(few) : len(few) + 1])
            else:
                own = np.zeros(0, np.uint64)
            yield base + i, own


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to ``CHUNK_TEXTS`` rows, so that what is made from one is small."""
    for batch in batches:
        for first in range(0, batch.num_rows, CHUNK_TEXTS):
            yield batch.slice(first, CHUNK_TEXTS)


def signature(own: np.ndarray) -> tuple[int, int]:
    """128 bits that are equal for equal sets, as two signed numbers."""
    one, two = mix(own, 1).sum(), mix(own, 2).sum()
    return int(np.int64(np.uint64(one))), int(np.int64(np.uint64(two)))


def class_counts(own: np.ndarray, classes: int = 64) -> np.ndarray:
    """How many hashes fall into each of 64 classes. The sum of the smaller counts bounds an overlap from above."""
    return np.bincount((own & np.uint64(classes - 1)).astype(np.int64), minlength=classes).astype(np.uint16 if len(own) < 65536 else np.uint32)
