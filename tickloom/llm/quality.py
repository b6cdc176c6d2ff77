"""Quality classifier: supervised subword embeddings.

A text's features are its words, pairs of words in a row and character n-grams of three and four bytes inside words
(with a blank at either end), hashed to ``BUCKETS``. Each bucket has a learnt vector; a text is the mean of the vectors of
all its features, and a softmax layer turns that into the chance of each label. Vectors and layer are trained
together by stochastic gradient descent in numpy.

Training uses at most about ``MOST_LABELLED`` labelled rows, whole texts, chosen by a hash of the doc_id. They lie in
``PARTS`` parts; in each round every part goes on from the common model on its own, and the models are averaged. A
model has a fixed size. Scoring reads each text once: for two labels, mean and softmax need one number per bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialise
from tickloom.llm.shingles import chunks, mix, pieces, word_hashes

BUCKET_BITS, WIDTH = 16, 8
BUCKETS = 1 << BUCKET_BITS
MOST_LABELLED = 4_000
PARTS, ROUNDS = 6, 3
#: Steps of a part in a round: whole passes over its rows, as many as it takes.
STEPS = 1_300
RATE = 2.0
CUT = 0.3
_RANDOM = np.random.default_rng(17)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[[9, 10, 11, 12, 13]] = 32
#: The bucket of a word that equals the one before it.
_TWICE = 1


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def margins(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the log-odds of label 1, and what is added once."""
        weights = self.layer[:, 1] - self.layer[:, 0]
        return (self.vectors @ weights).astype(np.float64), float(self.bias[1] - self.bias[0])


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, numbers of the texts they belong to) for every kind of feature of a chunk of texts."""
    hashes, places = word_hashes(data, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(places))
    yield _bucket(hashes), owner
    if len(hashes) > 1:
        pair = _bucket(mix(hashes[:-1] * _PLACE[0] + hashes[1:] * _PLACE[1], 8))
        pair[hashes[:-1] == hashes[1:]] = _TWICE
        both = owner[:-1] == owner[1:]
        yield pair[both], owner[:-1][both]
    own = _BLANK[data]
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    letters = own != 32
    for n in (3, 4):
        size = len(own) - n + 1
        if size <= 0:
            continue
        keep = text[:size] == text[n - 1 :]
        for k in range(1, n - 1):
            keep &= letters[k : k + size]
        at = np.flatnonzero(keep)
        sums = np.full(len(at), _PLACE[n], np.uint64)
        for k in range(n):
            sums += _BYTE[own[at + k]] * _PLACE[k]
        yield _bucket(sums * _PLACE[7]), text[at]


def _counted(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, how often each occurs) of each text, in two bytes each."""
    for _, data, offsets in chunks(texts):
        found = list(features(data, offsets))
        bucket, owner = np.concatenate([b for b, _ in found]), np.concatenate([o for _, o in found])
        both = np.sort(owner.astype(np.int64) << BUCKET_BITS | bucket)
        new = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, np.int64)
        counts = np.diff(np.append(new, len(both)))
        kinds, owners = (both[new] & (BUCKETS - 1)).astype(np.int32), both[new] >> BUCKET_BITS
        cuts = np.searchsorted(owners, np.arange(len(offsets)))
        for low, high in zip(cuts, cuts[1:]):
            yield kinds[low:high].astype(np.uint16), np.minimum(counts[low:high], 65535).astype(np.uint16)


def _descend(model: Model, rows: list[tuple[int, bytes, bytes]], first: float, last: float, seed: int) -> Model:
    """Passes over rows of (label, buckets, counts), the rate falling from first to last."""
    vectors, layer, bias = model.vectors.copy(), model.layer.copy(), model.bias.copy()
    passes = -(-STEPS // len(rows))
    steps = passes * len(rows)
    random = np.random.default_rng(seed)
    order = np.concatenate([random.permutation(len(rows)) for _ in range(passes)])
    for step, i in enumerate(order):
        label, buckets, counts = rows[i][0], np.frombuffer(rows[i][1], np.uint16), np.frombuffer(rows[i][2], np.uint16)
        shares = counts / np.float32(max(int(counts.sum(dtype=np.int64)), 1))
        rate = np.float32(first + (last - first) * step / steps)
        mean = shares @ vectors[buckets] if len(buckets) else np.zeros(WIDTH, np.float32)
        odds = mean @ layer + bias
        chance = np.exp(odds - odds.max())
        wrong = (chance / chance.sum()).astype(np.float32)
        wrong[label] -= 1
        back = layer @ wrong
        layer -= rate * np.outer(mean, wrong)
        bias -= np.float32(0.1) * rate * wrong
        if len(buckets):
            # shares sum to one, so a bucket's step is scaled by how much of the text it is, as seen by its root
            vectors[buckets] -= rate * np.sqrt(shares)[:, None] * back
    return Model(vectors, layer, bias)


def _improve(model: Model, first: float, last: float) -> Callable[[pa.Table], pa.Table]:
    """One part's round, as a function of its rows."""

    def improve(group: pa.Table) -> pa.Table:
        own = sorted(zip(*[group.column(k).to_pylist() for k in ("label", "buckets", "counts")]))
        after = _descend(model, own, first, last, group.column("part")[0].as_py())
        parts = {f"m{k}": pa.array([x.tobytes()], pa.binary()) for k, x in enumerate((after.vectors, after.layer, after.bias))}
        return pa.table({"n": pa.array([len(own)], pa.int64()), **parts})

    return improve


def trained(labelled: DataFrame) -> Model:
    """A model of ``label`` (0 or 1) by ``text``; labelled has doc_id, text, label. Without rows it is neutral."""
    random = np.random.default_rng(23)
    start = random.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    model = Model(start, np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [(b.tobytes(), s.tobytes()) for b, s in _counted(batch.column(2))]
            columns = [pa.array([x[k] for x in found], pa.binary()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["part", "label", "buckets", "counts"])

    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part")
    samples = labelled.select(part, F.col("label").cast("int"), "text").mapInArrow(
        rows, "part int, label int, buckets binary, counts binary"
    )
    samples = materialise(samples, "labelled")
    for turn in range(ROUNDS):
        first, last = RATE * (1 - turn / ROUNDS), RATE * (1 - (turn + 1) / ROUNDS)
        found = samples.groupBy("part").applyInArrow(_improve(model, first, last), "n long, m0 binary, m1 binary, m2 binary").collect()
        found = sorted(found, key=lambda r: bytes(r["m2"]))
        if not found:
            break
        total = sum(r["n"] for r in found)
        mean = [sum(np.frombuffer(r[f"m{k}"], np.float32) * np.float32(r["n"] / total) for r in found) for k in range(3)]
        model = Model(mean[0].reshape(BUCKETS, WIDTH), mean[1].reshape(WIDTH, 2), mean[2])
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs (doc_id, text and others) with score, the chance of label 1. Null and empty texts have the score of no
    features; a column score of docs is replaced."""
    margins, bias = model.margins()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            scores = []
            for _, data, offsets in chunks(batch.column(1)):
                sums, counts = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
                for bucket, owner in features(data, offsets):
                    sums += np.bincount(owner, weights=margins[bucket], minlength=len(sums))
                    counts += np.bincount(owner, minlength=len(sums))
                scores.append(1 / (1 + np.exp(-(sums / np.maximum(counts, 1) + bias))))
            own = pa.array(np.concatenate(scores) if scores else [], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), own], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """doc_id, held_out, score and predicted for each of docs, by a model of labels.quality.

    A doc_id is held out if crc32 of its text form is a multiple of five; such rows, and null labels, are never
    learnt from. A document labelled twice counts twice. Repeated rows have equal scores, and rows without a doc_id
    are held out. Without labels every score is the same; an empty table gives an empty result.
    """
    rest = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5))
    known = labels.where("quality is not null and doc_id is not null").where(rest != 0)
    known = known.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").alias("label"))
    total = known.count()
    if total > most:
        known = known.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(total)) < most)
    # about MOST_LABELLED rows of two numbers at most
    known = F.broadcast(materialise(known, "labels"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = trained(docs.join(known, docs.doc_id == F.col("id")).select("doc_id", "text", "label"))
    rows = scored(docs, model)
    return rows.select("doc_id", (rest == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
