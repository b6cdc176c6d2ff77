"""Token-id files compressed by a Re-Pair grammar per shard.

Documents are put in ascending order of doc_id (rows without one come last), encoded, and cut into shards of about
``SHARD_IDS`` ids; a document is never cut. In a shard, frequent pairs of neighbouring ids are replaced by nonterminals,
again and again, the most frequent first, until none is frequent or it hardly pays; no pair goes beyond its document. A shard is one
byte string, a row of the Parquet files that Spark writes, with

- a head: magic, number of documents, of symbols and of rules, the first nonterminal, bytes of a symbol;
- the rules, two symbols each, and the number of ids that each rule expands to;
- for each document its doc_id and where its symbols and its ids end;
- the symbols, in planes of bytes.

``Shard.ids`` decodes any range of a document: expansion lengths tell which symbols cover it, and only these are expanded.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import materialise, whole
from tickloom.llm.packing import _byte_letters

END_ID = 1
SHARD_IDS = 1 << 20
#: A pair is frequent if it occurs so often in its shard. A round replaces all pairs that occur at least 1/LEADERS as
#: often as the most frequent one; the last round is one that shortens the shard by less than 1/GAIN.
LEAST, LEADERS, GAIN = 4, 16, 64
#: Words, and pieces of words, whose ids an encoder remembers at once.
WORDS = 600_000
#: Bytes of text that are encoded at once.
PORTION_BYTES = 4 << 20
MAGIC = b"RPG1"
_HEAD = struct.Struct("<4sIQIIB")
_SLOT_BITS = 17
_HASH = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.iinfo(np.int32).max

#: Fixed values of Latin-1: letters after lower-casing, numbers, and white space (two of it become blanks).
_LETTERS = rb"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBERS = rb"0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACES = rb"\x09-\x0d\x20\x85\xa0"
_PRETOKENS = re.compile(
    rb"[" + _LETTERS + rb"]+|[" + _NUMBERS + rb"]|'(?:s|t|re|ve|m|ll|d)|[^" + _SPACES + _LETTERS + _NUMBERS + rb"]+"
)
_LOWER = bytes(32 if c in (133, 160) else c + 32 if 65 <= c <= 90 or 192 <= c <= 222 and c != 215 else c for c in range(256))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder(dict):
    """Texts to ids of a lower-casing word vocabulary, as the tokenizers library gives them without special tokens added.

    The library splits a text at white space and then between classes of characters, and encodes each piece alone. So Arrow splits
    texts into words, also between a letter and a sign, and finds the different ones, and a word's ids are remembered. A word of Latin-1, which the library's normal
    form leaves as it is, is cut by a pattern into pieces, whose ids are remembered too; a word beyond it, or with a mark of a
    special token, goes to the library whole. As a dict it holds the place of each word among the remembered ones.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letter = {b: c for c, b in _byte_letters().items()}
        self.letters = str.maketrans({chr(b): c for b, c in letter.items()})
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.first, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used, self.known = np.zeros(4096, np.uint32), 0, 0
        self.new_ids: list[int] = []
        self.new_counts: list[int] = []
        self.pieces: dict[bytes, list[int]] = {}

    def __missing__(self, word: str) -> int:
        if word.isascii() and word.isalpha():
            own = self._piece(word.lower().encode("ascii"))
        else:
            own = self._word(word)
        self.new_ids.extend(own)
        self.new_counts.append(len(own))
        place = self[word] = len(self)
        return place

    def _word(self, word: str) -> list[int]:
        try:
            raw = word.encode("latin-1").translate(_LOWER)
        except UnicodeEncodeError:
            raw = None
        if raw is None or any(x in word for x in self.special):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        return [i for piece in _PRETOKENS.findall(raw) for i in self._piece(piece)]

    def _piece(self, piece: bytes) -> list[int]:
        own = self.pieces.get(piece)
        if own is None:
            text = piece.decode("latin-1")
            if not piece.isascii() or not piece.isalnum():
                text = text.encode("utf-8").decode("latin-1").translate(self.letters)
            own = self.pieces[piece] = [t.id for t in self.model.tokenize(text)]
        return own

    def _keep(self) -> None:
        """Moves what ``__missing__`` has added since to the arrays."""
        n, ids = len(self.new_counts), len(self.new_ids)
        while self.known + n > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        while self.used + ids > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        own = slice(self.known, self.known + n)
        self.count[own] = self.new_counts
        self.first[own] = self.used + np.cumsum(self.count[own]) - self.count[own]
        self.flat[self.used : self.used + ids] = self.new_ids
        self.used, self.known = self.used + ids, self.known + n
        self.new_ids, self.new_counts = [], []

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string array without nulls."""
        if not any(pa.compute.any(pa.compute.match_substring(texts, x, ignore_case=True)).as_py() for x in self.special):
            # fewer different words: small letters, and the end of a word apart from the sign that follows
            texts = pa.compute.replace_substring_regex(pa.compute.ascii_lower(texts), r"([a-z])([.,;:!?])", r"\1 \2")
        words = pa.compute.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        if len(self) > WORDS:
            self.forget()
        kinds = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.__getitem__, kinds), np.int64, len(kinds))
        if self.new_counts:
            self._keep()
        place = place[coded.indices.to_numpy()]
        count = self.count[place]
        flat = gathered(self.flat, self.first[place], count)
        ends = np.append(0, np.cumsum(count))[np.cumsum(words.value_lengths().to_numpy())]
        return np.split(flat, ends[:-1]) if len(texts) else []


def gathered(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The slices flat[first : first + count], one after the other."""
    upto = np.cumsum(count)
    return flat[np.repeat(first - upto + count, count) + np.arange(upto[-1] if len(upto) else 0)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _chosen(pairs: np.ndarray, least: int) -> np.ndarray:
    """The pairs that a round replaces, most frequent first."""
    ordered = np.sort(pairs)
    border = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    count = np.diff(np.append(border, len(ordered)))
    kinds = ordered[border]
    if len(kinds) and kinds[-1] == np.uint64(0xFFFFFFFFFFFFFFFF):
        kinds, count = kinds[:-1], count[:-1]  # places between two documents
    if not len(kinds) or count.max() < least:
        return kinds[:0]
    some = np.flatnonzero(count >= max(least, int(count.max()) // LEADERS))
    return kinds[some[np.lexsort((kinds[some], -count[some]))]]


def _replaced(pairs: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs to replace, none next to another, and the rank of each among the chosen ones."""
    slot = lambda x: (x * _HASH) >> np.uint64(64 - _SLOT_BITS)
    table = np.full(1 << _SLOT_BITS, _NONE, np.int32)
    # of pairs with one slot the most frequent stays; the others wait for the next round
    table[slot(chosen[::-1])] = np.arange(len(chosen) - 1, -1, -1, dtype=np.int32)
    rank = table[slot(pairs)]
    place = np.flatnonzero(rank != _NONE)
    rank = rank[place]
    right = chosen[rank] == pairs[place]
    place, rank = place[right], rank[right]
    if not len(place):
        return place, rank
    # in a run of one id every other pair counts
    touch = np.diff(place) == 1
    begins = np.flatnonzero(np.append(True, ~(touch & (rank[1:] == rank[:-1]))))
    run = np.arange(len(place)) - np.repeat(begins, np.diff(np.append(begins, len(place))))
    place, rank = place[run % 2 == 0], rank[run % 2 == 0]
    touch = np.diff(place) == 1
    beaten = np.append(False, touch & (rank[:-1] < rank[1:])) | np.append(touch & (rank[1:] < rank[:-1]), False)
    place, rank = place[~beaten], rank[~beaten]
    often = np.bincount(rank, minlength=len(chosen)) > 1
    return place[often[rank]], rank[often[rank]]


def grammar(ids: np.ndarray, ends: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, ends of the documents in them, rules, first nonterminal) of ids whose documents end at ends."""
    symbols, ends = ids.astype(np.uint32), ends.astype(np.int64)
    first = int(symbols.max()) + 1 if len(symbols) else 0
    rules: list[np.ndarray] = []
    made = 0
    while len(symbols) > 1:
        wide = symbols.astype(np.uint64)
        pairs = (wide[:-1] << np.uint64(32)) | wide[1:]
        pairs[ends[:-1] - 1] = np.uint64(0xFFFFFFFFFFFFFFFF)
        chosen = _chosen(pairs, least)
        if not len(chosen):
            break
        place, rank = _replaced(pairs, chosen)
        if not len(place):
            break
        kinds, own = np.unique(rank, return_inverse=True)
        rules.append(np.stack([chosen[kinds] >> np.uint64(32), chosen[kinds] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        symbols[place] = (first + made + own).astype(np.uint32)
        made += len(kinds)
        ends = ends - np.searchsorted(place + 1, ends)
        keep = np.ones(len(symbols), bool)
        keep[place + 1] = False
        before, symbols = len(symbols), symbols[keep]
        if (before - len(symbols)) * GAIN < before:
            break
    return symbols, ends, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), first


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule expands to. Rules only use symbols of earlier ones, so a few passes settle all."""
    length = np.ones(len(rules), np.int64)
    inner = np.where(rules >= first, rules.astype(np.int64) - first, -1)
    while True:
        both = np.where(inner >= 0, length[inner], 1).sum(axis=1) if len(rules) else length
        if np.array_equal(both, length):
            return length
        length = both


def expanded(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that symbols stand for, rule by rule."""
    while True:
        deep = symbols >= first
        if not deep.any():
            return symbols
        width = 1 + deep.astype(np.int64)
        place = (np.cumsum(width) - width)[deep]
        rule = rules[symbols[deep] - first]
        symbols = np.repeat(symbols, width)
        symbols[place], symbols[place + 1] = rule[:, 0], rule[:, 1]


def shard_bytes(names: list[int | None], ids: list[np.ndarray]) -> bytes:
    """The file form of documents with at least one id each."""
    ends = np.cumsum([len(x) for x in ids]).astype(np.int64)
    symbols, places, rules, first = grammar(np.concatenate(ids), ends)
    width = max(1, (int(max(symbols.max(), rules.max() if len(rules) else 0)).bit_length() + 7) // 8)
    head = _HEAD.pack(MAGIC, len(ids), len(symbols), len(rules), first, width)
    known = np.packbits([x is not None for x in names])
    planes = np.ascontiguousarray(symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T)
    parts = [rules.astype("<u4"), expansion_lengths(rules, first).astype("<u8"), known]
    parts += [np.array([x or 0 for x in names], "<i8"), places.astype("<u8"), ends.astype("<u8"), planes]
    return head + b"".join(x.tobytes() for x in parts)


class Shard:
    """Documents of a shard's bytes: ``names``, and ids by number of document and range."""

    def __init__(self, content: bytes) -> None:
        magic, documents, symbols, rules, self.first, width = _HEAD.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, n, at)
            at += found.nbytes
            return found

        self.rules = take("<u4", 2 * rules).reshape(-1, 2)
        self.lengths = take("<u8", rules).astype(np.int64)
        known = np.unpackbits(take("u1", -(-documents // 8)))[:documents].astype(bool)
        self.names = [int(x) if k else None for x, k in zip(take("<i8", documents), known)]
        self.places = np.append(0, take("<u8", documents)).astype(np.int64)
        self.ends = np.append(0, take("<u8", documents)).astype(np.int64)
        whole_ = np.zeros((symbols, 4), np.uint8)
        whole_[:, :width] = take("u1", width * symbols).reshape(width, symbols).T
        self.symbols = whole_.view("<u4").ravel()

    def all(self) -> np.ndarray:
        """The ids of all documents: each rule is expanded once and copied to its places."""
        own = expanded(np.arange(self.first, self.first + len(self.rules), dtype=np.uint32), self.rules, self.first)
        deep = np.flatnonzero(self.symbols >= self.first)
        rule = self.symbols[deep] - self.first
        width = np.ones(len(self.symbols), np.int64)
        width[deep] = self.lengths[rule]
        found = np.repeat(self.symbols, width)
        place = (np.cumsum(width) - width)[deep]
        inside = gathered(np.arange(len(found)), place, width[deep])
        found[inside] = gathered(own, (np.cumsum(self.lengths) - self.lengths)[rule], width[deep])
        return found

    def ids(self, number: int, start: int = 0, length: int | None = None) -> np.ndarray:
        """ids start to start + length of a document, all if no length is given; only the symbols that cover them are
        expanded."""
        own = self.symbols[self.places[number] : self.places[number + 1]]
        each = np.ones(len(own), np.int64)
        deep = own >= self.first
        each[deep] = self.lengths[own[deep] - self.first]
        upto = np.cumsum(each)
        stop = int(upto[-1]) if length is None else min(start + length, int(upto[-1]))
        if stop <= start:
            return np.zeros(0, np.uint32)
        low, high = int(np.searchsorted(upto, start, "right")), int(np.searchsorted(upto, stop, "left")) + 1
        skipped = int(upto[low] - each[low])
        return expanded(own[low:high], self.rules, self.first)[start - skipped : stop - skipped]


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about so many bytes of text; a longer text is one of its own."""
    upto = np.cumsum(pa.compute.binary_length(batch.column(1)).to_numpy())
    first = 0
    while first < batch.num_rows:
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + PORTION_BYTES, "right")))
        yield batch.slice(first, last - first)
        first = last


def write_tokens(docs: DataFrame, label: str = "tokens", tokenizer: str | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes the files and returns their table as read back: part and shard (numbers in order), documents, ids (their
    numbers) and content (the shard's bytes).

    docs needs doc_id and text. A null or empty text is the end id alone. Rows that share a doc_id are documents of
    their own, in order of a hash of their texts, equal rows in any order; rows without a doc_id come last. Many such
    rows fill many tasks. An empty table gives no shards. A task holds one shard, or one text if that is longer.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    order = [F.asc_nulls_last("doc_id"), F.asc("tie"), F.asc("row")]
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number = encoder(path), TaskContext.get().partitionId(), 0
        names, ids, size = [], [], 0

        def close() -> pa.RecordBatch:
            values = [part, number, len(names), size, shard_bytes(names, ids)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["part", "shard", "documents", "ids", "content"],
            )

        for batch in (few for batch in batches for few in _portions(batch)):
            for name, own in zip(batch.column(0).to_pylist(), encode.ids(batch.column(1))):
                names.append(name)
                ids.append(np.append(own, np.uint32(END_ID)))
                size += len(ids[-1])
                if size >= shard_ids:
                    yield close()
                    names, ids, size, number = [], [], 0, number + 1
        if names:
            yield close()

    return materialise(rows.mapInArrow(pack, "part int, shard long, documents long, ids long, content binary"), label)


def read_tokens(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """A row for each document of ``write_tokens``' table: doc_id, start (ids of all documents before it) and ids (as
    little-endian unsigned 32-bit numbers, the end id included)."""
    sizes = shards.select("part", "shard", "ids")
    # parts are tasks, so their totals are few; inside a part the shards are summed apart
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    before = W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    inside = sizes.select("part", "shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("inside"))
    bases = materialise(inside.join(parts, "part").select("part", "shard", (F.col("base") + F.col("inside")).alias("base")), "bases")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(content.as_buffer().to_pybytes())
                ids = shard.all().astype("<u4").tobytes()
                ends = shard.ends.tolist()
                columns = [
                    pa.array(shard.names, pa.int64()),
                    pa.array([base + x for x in ends[:-1]], pa.int64()),
                    pa.array([ids[4 * a : 4 * b] for a, b in zip(ends, ends[1:])], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids"])

    rows = shards.select("part", "shard", "content").join(bases, ["part", "shard"]).select("base", "content")
    return rows.mapInArrow(unpack, "doc_id long, start long, ids binary")


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the rows of ``read_tokens``."""
    n = F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return documents.select("doc_id", "start", n, F.crc32("ids").alias("ids_crc32"))
