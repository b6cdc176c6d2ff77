"""Packing by lexical retrieval: documents that share rare terms fill a training window together.

Documents are tokenized and dealt to shards by a hash; a shard holds about ``SHARD_DOCS`` documents or ``SHARD_BYTES``
of text. Each shard has a BM25 inverted index over the tokens of its documents. A window begins with a seed: the
document that the last window cut, or else the next unused one. The index returns the unused neighbours of the
seed, best first, and they fill the window; the last one is cut and goes on in the next window, whose seed it is. So
only the last window of a shard has room left.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import whole

WINDOW = 1024
END_ID = 0
SHARD_DOCS, SHARD_BYTES = 2_048, 16 << 20
#: BM25's usual constants.
SATURATION, LENGTH_WEIGHT = 1.2, 0.75


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


#: In Latin-1 texts, the places inside white space before its last character, if a word follows: there the tokenizer's pattern
#: (``public_tokenizers.PATTERN``) cuts by looking ahead. With the texts cut there, a pattern that does not look ahead, which
#: is about twice as fast, cuts the rest in the same places.
_BLANK = "\t\n\v\f\r \x85\xa0"
_LAST_BLANK = re.compile(f"(?<=[{_BLANK}])(?=[{_BLANK}][^{_BLANK}])")
_AHEAD = r"|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids (unsigned 32-bit), as the tokenizers library gives them without special tokens added.

    Latin-1 texts without the vocabulary's added tokens go through tiktoken with the same vocabulary, which is several
    times faster; all others go through tokenizers itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    letters = _byte_letters()
    added = [x["content"] for x in described.get("added_tokens", [])]
    ranks = {bytes(letters[c] for c in t): k for t, k in described["model"]["vocab"].items() if t not in added}
    pattern = public_tokenizers.PATTERN.removesuffix(_AHEAD) + r"|\s+"
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        if any(x in text for x in added):
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array([k for part in _LAST_BLANK.split(text) for k in fast.encode_ordinary(part)], np.uint32)

    return encode


class Index:
    """A BM25 inverted index over token ids: for each term its documents and weights."""

    def __init__(self, ids: list[np.ndarray]) -> None:
        size = np.array([len(x) for x in ids], np.float64)
        counted = [np.unique(x, return_counts=True) for x in ids]
        self.terms = [t for t, _ in counted]
        owner = np.repeat(np.arange(len(ids)), [len(t) for t in self.terms])
        term = np.concatenate(self.terms)
        count = np.concatenate([c for _, c in counted]).astype(np.float64)
        order = np.argsort(term, kind="stable")
        self.kinds, self.first, self.df = np.unique(term[order], return_index=True, return_counts=True)
        self.docs = owner[order]
        idf = np.log(1 + (len(ids) - self.df + 0.5) / (self.df + 0.5))
        norm = SATURATION * (1 - LENGTH_WEIGHT + LENGTH_WEIGHT * size / max(size.mean(), 1))
        weight = count * (SATURATION + 1) / (count + norm[owner])
        self.weights = weight[order] * np.repeat(idf, self.df)
        self.size = len(ids)
        # the weights of a term that a quarter of the documents have are a row for all of them
        often = np.flatnonzero(4 * self.df >= self.size)
        self.rows = np.zeros((len(often), self.size))
        for row, k in zip(self.rows, often.tolist()):
            postings = slice(self.first[k], self.first[k] + self.df[k])
            row[self.docs[postings]] = self.weights[postings]
        self.row = np.full(len(self.kinds), -1, np.int64)
        self.row[often] = np.arange(len(often))

    def scores(self, doc: int) -> np.ndarray:
        """The BM25 score of every document for all terms of one that others have too."""
        place = np.searchsorted(self.kinds, self.terms[doc])
        place = place[self.df[place] > 1]
        row = self.row[place]
        score = self.rows[row[row >= 0]].sum(axis=0)
        place = place[row < 0]
        if len(place):
            begin, length = self.first[place], self.df[place]
            at = np.repeat(begin - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum())
            score += np.bincount(self.docs[at], weights=self.weights[at], minlength=self.size)
        return score


def _ranked(score: np.ndarray) -> Iterator[int]:
    """All documents of a positive score, best first, equal ones by number; few are sorted at a time."""
    near, some = np.flatnonzero(score > 0), 64
    while len(near):
        least = np.partition(score[near], -some)[-some] if len(near) > some else 0.0
        first = near[score[near] >= least]
        yield from first[np.lexsort((first, -score[first]))].tolist()
        near, some = near[score[near] < least], 4 * some


def order_of(ids: list[np.ndarray], names: list[int | None], window: int = WINDOW) -> list[int]:
    """The order in which a shard's documents follow each other."""
    index = Index(ids)
    free = np.ones(len(ids), bool)
    names = np.array([-1 if x is None else x for x in names], np.int64)
    order, upto, unseen = [], 0, 0
    while True:
        while unseen < len(ids) and not free[unseen]:
            unseen += 1
        if unseen == len(ids):
            return order
        if not order or upto % window == 0:
            free[unseen] = False
            order.append(unseen)
            upto += len(ids[unseen])
        room = -upto % window
        seed = order[-1]
        if not room:
            continue
        score = index.scores(seed) * (free & (names != names[seed]))
        for doc in _ranked(score):
            free[doc] = False
            order.append(doc)
            upto += len(ids[doc])
            room -= len(ids[doc])
            if room <= 0:
                break
        else:
            # no neighbour is left: the next unused document goes on
            while unseen < len(ids) and not free[unseen]:
                unseen += 1
            if unseen < len(ids):
                free[unseen] = False
                order.append(unseen)
                upto += len(ids[unseen])


_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def packed(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """The pieces of all documents: doc_id, start (the document's ids before it), length, ids (little-endian 32-bit numbers), ids_crc32 (of
    these bytes), doc_tokens, sequence_id, offset (ids before it in the sequence).

    docs needs doc_id and text. A document is its ids and END_ID; a null or empty text is END_ID alone. Each id lies in
    one piece, and a sequence has at most window ids. Repeated rows are documents of their own, kept apart where
    others are near. An empty table gives an empty result.
    """
    path = tokenizer or default_tokenizer()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    sizes = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    shards = max(1, -(-sizes[0] // SHARD_DOCS), -(-(sizes[1] or 0) // SHARD_BYTES))

    def pack(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("doc_id").to_pylist(), group.column("text").to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        names, shard = [r[0] for r in rows], group.column("shard")[0].as_py()
        encode, end = encoder(path), np.array([END_ID], np.uint32)
        ids = [np.append(encode(text), end) for _, text in rows]
        found, upto = [], 0
        for doc in order_of(ids, names, window):
            own, start = ids[doc], 0
            while start < len(own):
                length = min(len(own) - start, window - upto % window)
                piece = own[start : start + length].astype("<u4").tobytes()
                found.append((names[doc], start, length, piece, len(own), (shard << 32) + upto // window, upto % window))
                start, upto = start + length, upto + length
        fields = [x.split() for x in _PIECES.split(", ")]
        columns = [pa.array(x, pa.binary() if kind == "binary" else pa.int64()) for x, (_, kind) in zip(zip(*found), fields)]
        return pa.table(columns, names=[name for name, _ in fields])

    # rows without a doc_id, of which many may be equal, are dealt by their place
    name = F.coalesce("doc_id", F.monotonically_increasing_id())
    shard = F.pmod(F.xxhash64(name, F.crc32(F.col("text").cast("binary"))), F.lit(shards)).alias("shard")
    pieces = docs.select("*", shard).groupBy("shard").applyInArrow(pack, _PIECES)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")
