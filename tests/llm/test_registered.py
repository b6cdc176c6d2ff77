"""The registered queries: SQL where there is one, and the pipeline stage by stage."""

import re
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.compare import connect, differences
from tests.conftest import TESTDATA
from tests.llm import brute
from tickloom.llm.common import materialise
from tickloom.llm.queries import ORACLES, QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    rows, found = differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert not found
    assert rows > 0


def test_all_are_registered():
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", ["op3_mixing", "op4_chat_format", "op6_url_filter", "op8_fingerprints", "op10_quality_rules"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op5_quality_classifier", "op7_packing", "op9_sharding", "op11_token_files"])
def test_queries_cover_all_documents(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = QUERIES[name](spark, SF_DIR)
    ids = {r["doc_id"] for r in rows.select("doc_id").collect()}
    every = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert ids == every if name != "op1_substring_dedup" else ids < every


def windows(text, n):
    own = brute.words(brute.lower(text))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, SF_DIR)
        if i + 1 == len(corpus_pipeline.STAGES):
            break
        assert after.columns == docs.columns
        docs = materialise(after, name)
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
        if name == "mix_sources":
            mixed = docs.count()
    rules, joined, dedup, mix = kept
    raw = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for doc, text in raw.items():
        words, _, _, _, repeated = brute.figures(text)
        assert not (doc in rules and (words < 10 or 100 * repeated > 20 * words))
    roots = brute.components({d: brute.shingles(t) for d, t in rules.items()})
    assert set(joined) == set(roots.values()) and all(joined[d] == raw[d] for d in joined)
    assert set(dedup) <= set(joined)
    for doc, text in joined.items():
        left = iter(brute.words(text))
        assert doc not in dedup or all(word in left for word in brute.words(dedup[doc]))
    # of each run of 51 words that several texts have one is left
    seen = Counter(w for text in dedup.values() for w in windows(text, 51))
    before = Counter(w for text in joined.values() for w in windows(text, 51))
    several = [w for w, n in before.items() if n > 1 and len(set(w)) > 25]
    assert sum(seen[w] <= 1 for w in several) >= 0.95 * len(several)
    assert set(mix) <= set(dedup) and mixed >= len(mix)
    pieces = after.collect()
    assert {r["doc_id"] for r in pieces} == set(mix)
    assert sum(r["start"] == 0 for r in pieces) == mixed
    assert sum(r["length"] for r in pieces) == sum(r["doc_tokens"] for r in pieces if r["start"] == 0)


def test_run_is_the_chain(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_nothing_else_imports_this_folder():
    root = Path(__file__).parent.parent.parent
    for path in root.glob("**/*.py"):
        parts = path.relative_to(root).parts
        if "llm" not in parts and parts not in (("corpus_pipeline.py",), ("__spark_entry__.py",)):
            assert "tickloom.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path
