"""Token files, filter audit and hard negatives against brute force and exact round trips."""

import math
import random
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tickloom.llm import filter_audit, negatives, token_files

# Token files ------------------------------------------------------------------------------------------

ODD = [
    None, "", " \n\t", "a b", "é É ß Ω Σς ΣΑΣ", "<|endoftext|> hi <|STARTOFTEXT|>", "≠ á ≮", "x y\x85z\x1c!", "don't I'LL 's ''s !'s",
    "²½3 Ⅷ", "ﬁ İ", "a\x00b \x00", "a" * 5000, "ha " * 3000, "名前 です。", "🙂🙂 ok", "ÀÉÎ õ÷×",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]


def test_encoder_gives_the_librarys_ids(library):
    encode = token_files.Encoder(token_files.default_tokenizer())
    rng = random.Random(5)
    alphabet = "abcXYZ éÉßœ09²'st.,!;:?\u0301\x1c\x85\n\t<|>Σλ́字🙂"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    plain = [t for t in texts if "<|" not in (t or "")]
    for texts in (texts, plain, plain):
        for text, own in zip(texts, encode.ids(pa.array([t or "" for t in texts]))):
            assert [*own.tolist(), 1] == library(text), text
    encode.forget()
    assert [*encode.ids(pa.array(["", "x", "don't"]).slice(2))[0].tolist(), 1] == library("don't")
    assert encode.ids(pa.array([], pa.string())) == []


@pytest.mark.parametrize("kind", ["random", "one id", "repeats", "single"])
def test_grammar_round_trip(kind):
    rng = np.random.default_rng(2)
    ids = {
        "random": lambda: rng.integers(0, 9, 4000), "one id": lambda: np.zeros(1003, int),
        "repeats": lambda: np.tile(rng.integers(0, 400, 50), 60), "single": lambda: np.array([7]),
    }[kind]().astype(np.uint32)
    ends = np.unique(np.append(rng.integers(1, len(ids) + 1, 5), len(ids)))
    documents = [ids[a:b] for a, b in zip(np.append(0, ends), ends)]
    names = [None, *range(1, len(documents))]
    content = token_files.shard_bytes(names, documents)
    shard = token_files.Shard(content)
    assert shard.names == names and np.array_equal(shard.all(), ids)
    if kind in ("one id", "repeats"):
        assert len(shard.symbols) < len(ids) / 8 and len(content) < 2 * len(ids)
    lengths = [len(token_files.expanded(np.array([shard.first + k], np.uint32), shard.rules, shard.first)) for k in range(len(shard.rules))]
    assert shard.lengths.tolist() == lengths
    for number, own in enumerate(documents):
        for start in range(0, len(own) + 2, 7):
            for length in (0, 1, 5, 10**6):
                assert np.array_equal(shard.ids(number, start, length), own[start : start + length])
        assert np.array_equal(shard.ids(number), own)


def test_rules_replace_the_most_frequent_pair_first():
    ids = np.array([5, 6] * 40 + [1] + [6, 7] * 6 + [1], np.uint32)
    _, _, rules, first = token_files.grammar(ids, np.array([81, len(ids)]))
    assert rules[0].tolist() == [5, 6] and first == 8


def test_files_hold_all_documents_in_order(spark, library):
    rows = [(k * 3 % 19 - 4, t) for k, t in enumerate(ODD)] + [(None, "no id"), (None, "no id"), (2, "same"), (2, "same"), (2, "other")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, shard int, content string")
    shards = token_files.write_tokens(docs.repartition(5), shard_ids=20)
    assert shards.count() > 3
    found = token_files.read_tokens(spark, shards).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["ids"])) for r in found) == sorted(
        (d is None, d or 0, np.array(library(t), "<u4").tobytes()) for d, t in rows
    )
    upto, last = 0, (False, -99)
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == upto and (r["doc_id"] is None, r["doc_id"] or 0) >= last
        upto, last = upto + len(r["ids"]) // 4, (r["doc_id"] is None, r["doc_id"] or 0)
    for r in token_files.digests(token_files.read_tokens(spark, shards)).where("doc_id = -4").collect():
        ids = library(dict(rows)[-4])
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_no_documents_no_files(spark):
    shards = token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"))
    assert shards.count() == 0 and token_files.read_tokens(spark, shards).count() == 0


# Filter audit -----------------------------------------------------------------------------------------


def brute_audit(docs, labels):
    """{(part, order, step): figures} from the definitions, one order and document after the other."""
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, x in labels if x == 1 and d is not None}

    def fails(d, t):
        t, own = t or "", brute.words(t)
        capitals = sum("A" <= c <= "Z" for c in t)
        marks = [len(own) < 200, 100 * len(set(own)) < 50 * len(own), 100 * capitals > 2 * len(t), any(c in "#$%&*|" for c in t),
                 d is not None and least[t] < d]
        return {f for f, m in zip("ABCDE", marks) if m}

    found = {}
    rows = [(d, s or "", fails(d, t)) for d, t, s in docs]
    for part in {s for _, s, _ in rows}:
        own, shapley = [(d, f) for d, s, f in rows if s == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, name in enumerate(order):
                before = set(order[:step])
                alive = [(d, f) for d, f in own if not f & before]
                gone = [(d, f) for d, f in alive if name in f]
                shapley[name] += len(gone)
                found[part, "".join(order), step + 1] = (
                    len(alive) - len(gone), len(gone), sum(name in f and bool(f & before) for _, f in own), sum(f == {name} for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                )
        for key in [k for k in found if k[0] == part]:
            found[key] += (shapley[key[1][key[2] - 1]],)
    return found


def test_audit_equals_brute_force(spark):
    rng = random.Random(3)
    long = lambda kinds, n: " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))
    texts = [None, "", "A", "few words", long(900, 300), long(30, 300), long(900, 300).upper(), long(900, 250) + " #", long(20, 400) + "|", "Ab cd" * 300]
    docs = [(k, rng.choice(texts), rng.choice(["x", "y", None, ""])) for k in range(120)]
    docs += [(None, texts[4], "x"), (None, texts[4], "x"), (3, texts[4], "z"), (3, texts[4], "z"), (3, texts[5], "z"), (500, texts[4], "z")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 130, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, True) for d in docs], "doc_id long, text string, source string, part int, A boolean")
    marks = spark.createDataFrame([(*x, "q") for x in labels], "doc_id long, quality int, toxic int, good string")
    rows = filter_audit.audit(frame, marks).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}
    assert len(rows) == len(found) and found == brute_audit(docs, labels)


def test_audit_of_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_copies_are_spread(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "same", "x") for k in range(200)], "doc_id long, text string, source string")
    found = filter_audit.copies(filter_audit.described(docs))
    assert found.count() == 199


# Hard negatives ---------------------------------------------------------------------------------------


def brute_negatives(rows):
    own = []
    for v, e, label in rows:
        if v is None or e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        row = (v, label, tuple(math.floor(256 * float(np.float32(x))) for x in e))
        if row not in own:
            own.append(row)
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    found = []
    for a in own:
        if a[0] % 100:
            continue
        ranked = sorted((-score(a, b), b[0], b) for b in own if b is not a)
        for p, name, _ in [r for r in ranked if r[2][1] == a[1]][:5]:
            some = [(n, b) for n, b, row in ranked if row[1] != a[1] and 80 * -p <= 100 * -n <= 100 * -p][:5]
            found += [(a[0], name, k + 1, b, -p, -n) for k, (n, b) in enumerate(some)]
    return sorted(found)


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(seed, n, dims, spread=0.3):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(4)]
    return [(k, [c + rng.gauss(0, spread / 2) for c in centre[rng.randrange(4)]], rng.randrange(3)) for k in range(n)]


@pytest.mark.parametrize("dims", [1, 8, 13, 64])
def test_negatives_equal_brute_force(spark, monkeypatch, dims):
    monkeypatch.setattr(negatives, "FEW", 50)
    rows = vectors(dims, 420, dims)
    rows += [(500, [0.0] * dims, 1), (600, [3.0] * dims, None), (601, None, 1), (602, [float("nan")] * dims, 1), (603, [None] * dims, 0)]
    rows += [(604, [float("inf")] * dims, 1), (None, [1.0] * dims, 1), (700, [1.0] * dims, 1), (700, [1.0] * dims, 1), rows[5], rows[100]]
    frame = spark.createDataFrame(rows, VECTORS)
    found = negatives.hard_negatives(frame, frame["vec_id"] % 100 == 0).collect()
    assert sorted(map(tuple, found)) == brute_negatives(rows)


def test_ties_go_by_smaller_id(spark):
    rows = [(k, [1.0, 1.0], k % 2) for k in range(40)]
    frame = spark.createDataFrame(rows, VECTORS)
    found = sorted(map(tuple, negatives.hard_negatives(frame, frame["vec_id"] == 0).collect()))
    assert [r[:4] for r in found] == [(0, p, k + 1, 2 * k + 1) for p in (2, 4, 6, 8, 10) for k in range(5)]


def test_vectors_of_other_lengths_and_none(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1.0], 0), (2, [1.0, 2.0, 9.0], 0), (3, [], 0), (4, [0.9, 2.0], 1), (5, [1.0, -2.0], 1)]
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], VECTORS + ", name int, planes string")
    found = sorted(map(tuple, negatives.hard_negatives(frame, frame["vec_id"] == 0).collect()))
    assert found == brute_negatives([(v, [*e, 0.0, 0.0, 0.0][:3], x) for v, e, x in rows])
    empty = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(empty, empty["vec_id"] == 0).count() == 0


def test_too_large_components_are_an_error(spark):
    frame = spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], VECTORS)
    with pytest.raises(Exception, match="would not fit"):
        negatives.hard_negatives(frame, frame["vec_id"] == 0).collect()


def test_scores_are_exact_inner_products():
    rng = np.random.default_rng(1)
    for bits, dims in ((1, 3), (8, 64), (20, 17), (26, 100)):
        rows, anchors = (rng.integers(-(1 << bits), 1 << bits, (n, dims)) for n in (70, 130))
        assert np.array_equal(negatives.scores(negatives.pack(rows), anchors), rows @ anchors.T)
