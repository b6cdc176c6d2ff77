"""N-gram Jaccard join and substring dedup against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tickloom.llm import components, ngram_join, paragraphs
from tickloom.llm.shingles import chunks, shingle_sets

DOCS = "doc_id long, text string"


def near_copies(seed, bases=12, copies=6):
    """Texts of all lengths with copies that differ by a few words, some just above and some just below the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 8, 9, 12, 30, 60, 150]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(base) // 20])):
                at = rng.randrange(len(own) + 1)
                kind = rng.random()
                if kind < 0.4 and at < len(own):
                    own[at] = rng.choice(vocabulary)
                elif kind < 0.7:
                    own.insert(at, rng.choice(vocabulary))
                elif len(own) > 1:
                    own.pop(min(at, len(own) - 1))
            texts.append(" ".join(own) if rng.random() < 0.8 else "\t".join(own).upper())
    return texts


@pytest.fixture(scope="module")
def rows():
    texts = [t for seed in (1, 2) for t in near_copies(seed)] + [None, "", " \n", "one", "ONE", "a b c d", "a b c d e", "b c d e"]
    line = " ".join(f"common{i}" for i in range(30))
    texts += [f"{line} {' '.join(near_copies(9 + k, 1, 1))}" for k in range(8)]
    random.Random(3).shuffle(texts)
    return list(enumerate(texts))


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def expected(rows):
    sets = {i: brute.shingles(t) for i, t in rows}
    roots = brute.components(sets)
    return {i: (len(sets[i]), roots[i]) for i in sets}


def test_components_equal_brute_force(spark, rows):
    assert found(ngram_join.similar_components(spark.createDataFrame(rows, DOCS))) == expected(rows)


def test_blocks_and_crowds_change_nothing(spark, rows, monkeypatch):
    """Clusters cut into many tasks, elements of many documents, frequent elements: all limits reached."""
    monkeypatch.setattr(components, "TASK_TOKENS", 300)
    members = spark.createDataFrame([(1, i, 100) for i in range(10)], "cluster long, node long, n long")
    tasks = components.comparisons(members).collect()
    together = {(i, j): set() for i in range(10) for j in range(10)}
    for t in {(r["i"], r["j"]) for r in tasks}:
        nodes = [r["node"] for r in tasks if (r["i"], r["j"]) == t]
        assert len(nodes) <= 10
        for a in nodes:
            for b in nodes:
                together[a, b].add(t)
    assert all(together.values())
    assert found(ngram_join.similar_components(spark.createDataFrame(rows, DOCS))) == expected(rows)


def test_tree_search_finds_all_components():
    rng = np.random.default_rng(4)
    for _ in range(20):
        base = np.unique(rng.integers(0, 2**63, rng.integers(5, 80), dtype=np.uint64))
        sets = []
        for _ in range(25):
            keep = base[rng.random(len(base)) < rng.choice([0.8, 0.9, 0.97, 1.0])]
            more = rng.integers(0, 2**63, rng.integers(0, 6), dtype=np.uint64)
            own = np.unique(np.concatenate([keep, more]))
            if len(own):
                sets.append(own)
        plain = {i: set(x.tolist()) for i, x in enumerate(sets)}
        links = ngram_join.tree_links(sets)
        assert all(brute.similar(plain[a], plain[b]) for a, b in links)
        root = {i: i for i in plain}
        for _ in sets:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        assert root == brute.components(plain)
        bounds = ngram_join.bounded_links(np.array([len(x) for x in sets]), [ngram_join._small_counts(x) for x in sets])
        for _ in sets:
            for a, b in bounds:
                root[a] = root[b] = min(root[a], root[b])
        assert all(root[a] == root[b] for a, b in links)


def test_shingles_of_many_documents_come_last_however_full_the_counters_are():
    """Counters as of a large table: 500 rare shingles in each, and some that 1,200 documents have."""
    rng = np.random.default_rng(6)
    heat = rng.poisson(500, 1 << ngram_join.HEAT_BITS)
    common = rng.integers(0, 2**63, 40, dtype=np.uint64) * np.uint64(2)
    heat[(common >> np.uint64(64 - ngram_join.HEAT_BITS)).astype(np.int64)] += 1_200
    levels = np.concatenate([ngram_join.levels_of(x) for x in np.split(heat, ngram_join.HEAT_PIECES)])
    for _ in range(20):
        own = np.unique(np.concatenate([common, rng.integers(0, 2**63, 160, dtype=np.uint64) * np.uint64(2)]))
        first = ngram_join.prefix(own, levels)
        assert len(first) == 41 and not set(first.tolist()) & set(common.tolist())
    for heat in (np.zeros(64, np.uint64), np.array([3], np.uint64), np.arange(5)):
        assert (np.diff(ngram_join.levels_of(heat).astype(int)) >= 0).all()


def test_one_document_of_equal_sets_is_compared(spark, monkeypatch):
    """Copies in different partitions make no lists of documents that share an element."""
    texts = [" ".join(f"{k}w{i}" for i in range(60)) for k in range(3)]
    rows = [(40 * k + i, t) for k, t in enumerate(texts) for i in range(40)]
    tables = {}

    def kept(df, label, materialise=ngram_join.materialise):
        tables.setdefault(label, materialise(df, label))
        return tables[label]

    monkeypatch.setattr(ngram_join, "materialise", kept)
    got = found(ngram_join.similar_components(spark.createDataFrame(rows, DOCS).repartition(8)))
    assert got == {i: (56, 40 * (i // 40)) for i, _ in rows}
    assert tables["crowds"].isEmpty()


def test_the_pipelines_stage_keeps_one_of_equal_sets_and_makes_no_lists_of_them(spark, monkeypatch):
    """Texts that differ in white space and case only, in different partitions."""
    texts = [" ".join(f"{k}w{i}" for i in range(60)) for k in range(3)]
    rows = [(40 * k + i, t.upper() if i % 3 else t.replace(" ", "\n")) for k, t in enumerate(texts) for i in range(40)]
    tables = {}

    def kept(df, label, materialise=ngram_join.materialise):
        tables.setdefault(label, materialise(df, label))
        return tables[label]

    monkeypatch.setattr(ngram_join, "materialise", kept)
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    left = stage(spark, spark.createDataFrame(rows, DOCS).repartition(8), "").collect()
    assert sorted(map(tuple, left)) == [rows[0], rows[40], rows[80]]
    assert tables["crowds"].isEmpty()


def test_similar_sets_share_a_prefix_element():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(4, 60), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, rng.integers(0, 5), dtype=np.uint64)]))
        flags = rng.random(1 << ngram_join.HEAT_BITS) < rng.choice([0, 0.5, 1])
        if len(b) >= 4 and brute.similar(set(a.tolist()), set(b.tolist())):
            assert set(ngram_join.prefix(a, flags).tolist()) & set(ngram_join.prefix(b, flags).tolist())


def test_shingles_of_odd_texts():
    texts = ["", None, "a", "a  b\tc\nd", "A B C D E", "a b c d e", "é b c d e", "É b c d e", "x " * 3000, "y" * 2_000_000, "a b c d e f a b c d e"]
    sizes = [len(own) for _, own in shingle_sets(pa.array(texts))]
    assert sizes == [len(brute.shingles(t)) for t in texts]
    sets = [own.tobytes() for _, own in shingle_sets(pa.array(texts))]
    assert sets[4] == sets[5] and sets[6] != sets[7]
    assert [own.tobytes() for _, own in shingle_sets(pa.array(texts).slice(3, 4))] == sets[3:7]


def test_join_of_unusual_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert found(ngram_join.similar_components(empty)) == {}
    assert ngram_join.without_similar(empty).count() == 0
    text = "one two three four five six"
    rows = [(1, text, 5), (1, text, 5), (2, text, 6), (None, text, 7), (None, None, 8), (3, None, 9), (4, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumn("component_id", F.lit(0)).withColumn("key", F.lit("x"))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.similar_components(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, None), (None, 0, None), (3, 0, 3), (4, 0, 4)], key=str)
    kept = ngram_join.without_similar(df)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["1", "3", "4", "None", "None"]


def test_join_keeps_texts_of_one_id_apart(spark):
    rng = random.Random(4)
    first, other = passage(rng, 40), passage(rng, 40)
    rows = [(1, first), (5, f"{first} more"), (5, other), (5, other), (6, f"{other} x"), (9, "alone"), (9, None), (None, first)]
    names = "__rows int, __goes string, __bits int, __doc_id string, __word int, __bit int, node string, n int, row int, known int"
    df = spark.createDataFrame([(*r, 1, "mine", 3, "mine", 90952, 4, "mine", 5, 6, 7) for r in rows], f"{DOCS}, {names}")
    kept = ngram_join.without_similar(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert sorted((r["doc_id"], r["text"]) for r in got if r["doc_id"] and r["text"]) in (
        [(1, first), (5, other), (9, "alone")], [(1, first), (6, f"{other} x"), (9, "alone")]
    )
    assert len(got) == 5 and {tuple(r)[2:] for r in got} == {(1, "mine", 3, "mine", 90952, 4, "mine", 5, 6, 7)}


def test_connected_over_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (300, 200)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 120)}, 200: 200, 300: 200}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


# Substring dedup


def passage(rng, n):
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(60)) for _ in range(n))


def spans(text):
    return [m.span() for m in brute.WORD.finditer(text or "")]


def repeated_words(docs, least):
    """{doc: [bool per word]}: whether the word is in a run of least words that an earlier place has too."""
    seen, found = set(), {}
    for doc, text in sorted(docs):
        own = brute.words(brute.lower(text))
        marks = [False] * len(own)
        for i in range(len(own) - least + 1):
            window = tuple(own[i : i + least])
            if window in seen:
                marks[i : i + least] = [True] * least
            seen.add(window)
        found[doc] = marks
    return found


def removed_words(docs, rows):
    found = {doc: [False] * len(spans(text)) for doc, text in docs}
    texts = dict(docs)
    for r in rows:
        if r["removed"]:
            for i, (a, b) in enumerate(spans(texts[r["doc_id"]])):
                if r["start"] <= a and b <= r["start"] + r["length"]:
                    found[r["doc_id"]][i] = True
    return found


@pytest.fixture(scope="module")
def corpus():
    """Passages of many lengths inside other text, across line breaks, at the ends of texts, in capitals; also whole copies."""
    rng = random.Random(8)
    shared = [passage(rng, n) for n in (30, 45, 51, 51, 52, 55, 60, 75, 90, 130)]
    docs = []
    for i in range(60):
        words = passage(rng, rng.choice([0, 3, 20, 60, 200])).split()
        for _ in range(rng.randrange(3)):
            at = rng.choice([0, len(words), rng.randrange(len(words) + 1)])
            words[at:at] = [w.upper() if i % 7 == 0 else w for w in rng.choice(shared).split()]
        docs.append((i, "".join(w + rng.choice([" "] * 9 + ["\n", "  ", "\t", " \n\n"]) for w in words)))
    docs += [(70, docs[5][1]), (71, docs[5][1] + " end"), (72, None), (73, ""), (74, " \n"), (75, "tiny text"), (76, "é " + shared[9] + " ß")]
    return [*docs, (77, f"{shared[8]} {passage(rng, 9)} {shared[8]}"), (78, "Ünï " * 10 + shared[4])]


def test_runs_equal_brute_force(spark, corpus):
    rows = paragraphs.duplicate_paragraphs(spark.createDataFrame(corpus, DOCS)).collect()
    gone, wanted = removed_words(corpus, rows), repeated_words(corpus, 51)
    allowed = repeated_words(corpus, 50)
    most = sum(sum(w) for w in wanted.values())
    assert most > 1500
    caught = sum(g and w for doc in wanted for g, w in zip(gone[doc], wanted[doc]))
    assert caught >= 0.97 * most
    # passages of fewer words stay, and no word beyond a passage goes, but for a few between two parts of one
    extra = sum(g and not a for doc in gone for g, a in zip(gone[doc], allowed[doc]))
    assert extra <= 0.005 * most
    texts, same = dict(corpus), []
    for r in rows:
        own = texts[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        if r["removed"]:
            assert len(own.split()) == r["words"] >= 50
            if r["kept_start"] is not None:
                kept = texts[r["kept_doc_id"]][r["kept_start"] : r["kept_start"] + r["kept_length"]]
                same.append(brute.words(brute.lower(kept)) == brute.words(brute.lower(own)))
                assert same[-1] or brute.similar(brute.shingles(kept), brute.shingles(own))
        else:
            assert r["kept_doc_id"] == r["doc_id"] and r["kept_start"] == r["start"]
    assert sum(same) > 0.9 * len(same) > 20


def test_near_passages_are_found_whole(spark):
    """A word in 60 changed, dropped or added keeps the similarity at 0.8 or more; every tenth does not."""
    rng = random.Random(3)
    base = passage(rng, 180).split()
    few, many = list(base), list(base)
    few[40], few[100:101], few[150:150] = "changed", [], ["added"]
    many[5::10] = ["other"] * len(many[5::10])
    docs = [(1, " ".join(base)), (2, f"{passage(rng, 30)} {' '.join(few)} {passage(rng, 30)}"), (3, " ".join(many))]
    assert brute.similar(brute.shingles(" ".join(base)), brute.shingles(" ".join(few)))
    rows = paragraphs.duplicate_paragraphs(spark.createDataFrame(docs, DOCS)).collect()
    gone = removed_words(docs, rows)
    assert not any(gone[1]) and not any(gone[3])
    assert gone[2] == [False] * 30 + [True] * len(few) + [False] * 30


def test_removal_keeps_the_rest(spark, corpus):
    schema = "doc_id long, text string, __doc_id string, n_chars int, __word int, __bits string, __gone int, row int, ranges string, mark int"
    df = spark.createDataFrame([(i, t, "mine", len(t or ""), 7, "b", 3, 4, "r", 5) for i, t in corpus], schema)
    duplicates = paragraphs.duplicate_paragraphs(df)
    result = {r["doc_id"]: r for r in paragraphs.without_paragraphs(df, duplicates).collect()}
    found = duplicates.where("removed").collect()
    for i, text in corpus:
        ranges = [(r["start"], r["length"]) for r in found if r["doc_id"] == i]
        left = "".join(c for k, c in enumerate(text or "") if not any(a <= k < a + n for a, n in ranges))
        if ranges and not left.split():
            assert i not in result
        else:
            assert result[i]["text"] == (left if ranges else text) and result[i]["n_chars"] == len(left)
            assert tuple(result[i])[4:] == (7, "b", 3, 4, "r", 5) and result[i]["__doc_id"] == "mine"
    assert paragraphs.without_paragraphs(df, duplicates).columns == df.columns


def test_texts_of_one_id_are_apart(spark):
    rng = random.Random(2)
    shared, first, other = passage(rng, 60), passage(rng, 40), passage(rng, 40)
    docs = [(1, f"{first} {shared}"), (5, f"{other} {shared}"), (5, f"{shared} unique to this text"), (5, "nothing shared")]
    df = spark.createDataFrame(docs, DOCS)
    kept = paragraphs.without_paragraphs(df, paragraphs.duplicate_paragraphs(df)).collect()
    assert sorted((r["doc_id"], r["text"].strip()) for r in kept) == sorted(
        [(1, docs[0][1]), (5, other), (5, "unique to this text"), (5, "nothing shared")]
    )


def test_links_of_sets_connect_all_similar_pairs():
    rng = np.random.default_rng(6)
    for _ in range(60):
        base = np.unique(rng.integers(0, 2**63, rng.integers(1, 30), dtype=np.uint64))
        sets = []
        for _ in range(30):
            more = rng.integers(0, 2**63, rng.integers(0, 3), dtype=np.uint64)
            own = np.unique(np.concatenate([base[rng.random(len(base)) < rng.choice([0.8, 0.95, 1.0])], more]))
            if len(own):
                sets.append(own)
        plain = {i: set(x.tolist()) for i, x in enumerate(sets)}
        links = paragraphs.exact_links(sets)
        assert all(brute.similar(plain[a], plain[b]) for a, b in links)
        root = {i: i for i in plain}
        for _ in sets:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        assert root == brute.components(plain)


def test_links_of_many_sets_find_all_components():
    """Sets of several components that share elements, compared at once and block by block."""
    rng = np.random.default_rng(9)
    hot = rng.integers(0, 2**63, 30, dtype=np.uint64)
    sets = []
    for _ in range(60):
        base = np.append(rng.integers(0, 2**63, rng.integers(1, 9), dtype=np.uint64), rng.choice(hot, 4, False))
        for _ in range(rng.integers(1, 6)):
            sets.append(np.unique(np.append(base, rng.integers(0, 2**63, rng.integers(0, 3), dtype=np.uint64))))
    plain = {i: set(x.tolist()) for i, x in enumerate(sets)}
    nodes = np.arange(len(sets))
    for most in (1_000, 40, 7):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(paragraphs, "MOST_SETS", most, raising=False)
            links = paragraphs.task_links(nodes, lambda a, b: sets[a:b])
        assert all(brute.similar(plain[a], plain[b]) for a, b in links)
        root = {i: i for i in plain}
        for _ in sets:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        assert root == brute.components(plain)


def test_a_large_cluster_is_cut_by_first_shingles_and_not_sent_out_in_pairs_of_blocks(spark, corpus, monkeypatch):
    tables = {}

    def kept(df, label, materialise=paragraphs.materialise):
        tables[label] = materialise(df, label)
        return tables[label]

    def result():
        return sorted((tuple(r) for r in paragraphs.duplicate_paragraphs(spark.createDataFrame(corpus, DOCS)).collect()), key=str)

    whole = result()
    assert whole
    monkeypatch.setattr(paragraphs, "materialise", kept)
    monkeypatch.setattr(components, "TASK_TOKENS", 300)
    monkeypatch.setattr(paragraphs, "LARGE", 1, raising=False)
    assert result() == whole
    assert tables["members"].count() == tables["members"].select("node").distinct().count() > 0


def test_bands_are_tuned_for_the_recall():
    for rows in (1, 2, 4):
        n = paragraphs.bands_for(0.99, 0.8, rows)
        assert 1 - (1 - 0.8**rows) ** n >= 0.99 > 1 - (1 - 0.8**rows) ** (n - 1)


def test_paragraphs_depend_on_content_alone():
    """A shared run has the same inner borders in any place, also in a chunk with other texts."""
    rng = random.Random(4)
    shared = passage(rng, 100)
    texts = [f"{passage(rng, n)} {shared} {passage(rng, n)}" for n in (1, 17, 40)] + ["", shared, "x"]
    borders = []
    for _, data, offsets in chunks(pa.array(texts)):
        own = paragraphs.Paragraphs(data, offsets)
        assert own.words.sum() == sum(len(t.split()) for t in texts)
        for k, n in enumerate((1, 17, 40)):
            inside = own.word[own.text == k] - n
            borders.append(set(inside[(inside > 6) & (inside < 93)].tolist()))
    assert borders[0] == borders[1] == borders[2] and len(borders[0]) > 3


def test_dedup_of_unusual_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    none = paragraphs.duplicate_paragraphs(empty)
    assert none.count() == 0 and paragraphs.without_paragraphs(empty, none).count() == 0
    text = passage(random.Random(1), 60)
    df = spark.createDataFrame([(None, text), (1, text), (1, text), (2, None)], DOCS).withColumn("line", F.lit(1))
    found = paragraphs.duplicate_paragraphs(df)
    assert found.count() == 0
    assert paragraphs.without_paragraphs(df, found).count() == 4
