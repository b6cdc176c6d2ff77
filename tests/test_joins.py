import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.brute import as_of as brute_as_of
from tickloom.operators import dimension
from tickloom.operators.asof import as_of
from tickloom.plans.profiles import refresh_cache
from tickloom.sinks.heads import CsvCache
from tickloom.operators.mentions import mentions
from tickloom.operators.joins import keyed_join, known, unique_per, unknown, with_company_symbols


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows belong to one key, some keys have no match, some rows have no key."""
    keys = ["hot"] * 60 + ["warm"] * 25 + [f"k{i}" for i in range(20)] + [None] * 15
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "symbol string, n int")


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", None), ("other", 3)], "symbol string, timestamp bigint")


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_keyed_join_equals_the_plain_join(skewed, table, how):
    joined = keyed_join(skewed, table, "symbol", how)
    plain = skewed.join(table, "symbol", how)
    assert joined.columns == plain.columns
    assert rows_of(joined) == rows_of(plain)
    assert rows_of(keyed_join(skewed, table.unionAll(table), "symbol", how)) == rows_of(plain)


def test_join_types_are_checked(skewed, table):
    with pytest.raises(ValueError):
        keyed_join(skewed, table, "symbol", "full")


def test_a_table_has_one_row_per_key(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 1, "z"), ("b", None, "y")], "symbol string, n int, s string")
    assert rows_of(unique_per(rows, "symbol")) == [("a", 2, None), ("b", None, "y")]
    assert rows_of(unique_per(rows.select("symbol"), "symbol")) == [("a",), ("b",)]


def test_a_compressible_table_is_not_broadcast(spark, folder):
    """Its files are small, its rows are not: the measured size decides, and the left side is read once."""
    text = F.repeat(F.lit("x"), 1_000)
    spark.range(30_000).select(F.col("id").cast("string").alias("symbol"), text.alias("text")).write.parquet(folder + "/t")
    spark.range(1_000).select((F.col("id") % 7).cast("string").alias("symbol"), "id").write.parquet(folder + "/l")
    joined = keyed_join(spark.read.parquet(folder + "/l"), spark.read.parquet(folder + "/t"), "symbol", "left")
    assert joined.where("text IS NULL").count() == 0
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" not in plan
    assert plan.count("FileScan") == 2


def test_left_join_keeps_every_trade(skewed, table):
    joined = with_company_symbols(skewed, table)
    assert joined.count() == skewed.count()
    assert {r["registered_at"] for r in joined.collect() if r["symbol"] == "hot"} == {1}
    assert {r["registered_at"] for r in joined.collect() if r["symbol"] in (None, "warm")} == {None}


def test_semi_and_anti_split_the_rows(skewed, table):
    assert known(skewed, table).count() + unknown(skewed, table).count() == skewed.count()
    assert known(skewed, table.unionAll(table)).count() == 62


@pytest.mark.parametrize("seed, chunk", [(1, 5), (2, 17), (3, 1), (4, 1_000_000)])
def test_as_of_against_brute_force(spark, seed, chunk):
    rng = random.Random(seed)
    offsets = list(range(150))
    rng.shuffle(offsets)
    pick = lambda: "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
    events = [(pick(), o) for o in offsets[:100]]
    changes = [(pick(), o, rng.choice([None, o * 10])) for o in offsets[100:]]
    left = spark.createDataFrame(events, "symbol string, offset bigint")
    right = spark.createDataFrame(changes, "symbol string, offset bigint, since bigint")
    found = as_of(left, right, "symbol", ["since"], chunk=chunk)
    assert found.columns == ["symbol", "offset", "since"]
    assert sorted(((r["offset"], r["since"]) for r in found.collect())) == brute_as_of(events, changes)


def test_as_of_includes_a_change_at_the_same_offset(spark):
    left = spark.createDataFrame([("a", 5), ("a", 4)], "symbol string, offset bigint")
    right = spark.createDataFrame([("a", 5, "x")], "symbol string, offset bigint, v string")
    assert rows_of(as_of(left, right, "symbol", ["v"])) == [("a", 4, None), ("a", 5, "x")]


@pytest.mark.parametrize("base, step", [(10**16, 1), (0, 1_000_000), (2**53, 3)])
@pytest.mark.parametrize("chunk", [1_000_000, 7, None])
def test_as_of_with_large_and_sparse_offsets(spark, base, step, chunk):
    events = [("a", base + step * o) for o in range(0, 60, 2)] + [("b", base + step * 3), (None, base), ("a", None)]
    changes = [("a", base + step * o, o) for o in (1, 17, 40)] + [("b", base + step * 4, 9), ("b", None, 8)]
    left = spark.createDataFrame(events, "symbol string, offset bigint")
    right = spark.createDataFrame(changes, "symbol string, offset bigint, v bigint")
    found = [(r["symbol"], r["offset"], r["v"]) for r in as_of(left, right, "symbol", ["v"], chunk=chunk).collect()]
    brute = lambda k, o: max(((c[1], c[2]) for c in changes if k and o is not None and c[0] == k and c[1] is not None and c[1] <= o), default=(0, None))[1]
    assert sorted(found, key=str) == sorted(((k, o, brute(k, o)) for k, o in events), key=str)


def test_as_of_by_message_and_place(spark):
    left = spark.createDataFrame([("a", 1, 0), ("a", 1, 2), ("a", 2, 0)], "symbol string, offset bigint, position int")
    right = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 3, "y")], "symbol string, offset bigint, position int, v string")
    found = as_of(left, right, "symbol", ["v"], order=["offset", "position"], chunk=1)
    assert rows_of(found) == [("a", 1, 0, None), ("a", 1, 2, "x"), ("a", 2, 0, "y")]


# Dimension refresh


@pytest.fixture(scope="module")
def listing(spark):
    return spark.createDataFrame([("A", "Alpha"), ("B", "Beta"), ("C", "Gamma"), ("D", "Delta")], "symbol string, security string")


@pytest.fixture(scope="module")
def cached(spark):
    return spark.createDataFrame([("A", "Alpha Inc", "US"), ("Z", "Zeta", "DE")], "symbol string, name string, country string")


@pytest.fixture(scope="module")
def responses(spark):
    return spark.createDataFrame([("B", "Beta plc", "x.png"), ("C", "Gamma", None), ("Q", "Quux", None)], "symbol string, name string, logo string")


def test_refresh(listing, cached, responses):
    refreshed, missing = dimension.refresh(listing, cached, responses)
    assert rows_of(refreshed.select("symbol", "name", "country", "logo")) == [
        ("A", "Alpha Inc", "US", None), ("B", "Beta plc", None, "x.png"), ("C", "Gamma", None, None)
    ]
    assert rows_of(missing) == [("D", "Delta")]


def test_refresh_without_a_cache(listing, responses):
    refreshed, missing = dimension.refresh(listing, None, responses)
    assert [r[0] for r in rows_of(refreshed)] == ["B", "C"]
    assert rows_of(missing) == [("A", "Alpha"), ("D", "Delta")]


def test_repeated_responses_count_once(spark, listing, cached):
    twice = spark.createDataFrame([("A", "x", "1"), ("B", "Beta", "1"), ("B", "Beta", "2")], "symbol string, name string, logo string")
    refreshed, missing = dimension.refresh(listing, cached, twice)
    assert rows_of(refreshed.select("symbol", "name", "logo")) == [("A", "Alpha Inc", None), ("B", "Beta", "2")]
    assert rows_of(missing.select("symbol")) == [("C",), ("D",)]


def test_refreshed_profiles_rename_and_clean(spark, listing):
    cached = spark.createDataFrame([("A", "Metals", float("nan"))], "symbol string, industry string, share_outstanding double")
    answers = spark.createDataFrame([("B", "Paper", 2.0)], "Symbol string, vendorIndustry string, shareOutstanding double")
    refreshed, _ = dimension.refreshed_profiles(listing, cached, answers, industry="vendorIndustry")
    assert rows_of(refreshed) == [("A", "Metals", None), ("B", "Paper", 2.0)]


def test_cache_is_replaced_by_what_was_made_from_it(spark, folder, listing):
    cache = CsvCache(folder + "/cache", T.StructType.fromDDL("symbol string, name string, industry string, share_outstanding double"))
    assert cache.read(spark) is None
    answers = spark.createDataFrame([("A", "Alpha", "N/A", 1.5), ("B", None, "Paper", None)], "Symbol string, name string, vIndustry string, shareOutstanding double")
    assert rows_of(refresh_cache(cache, listing, answers, industry="vIndustry").select("symbol")) == [("C",), ("D",)]
    before = cache.read(spark)
    later = spark.createDataFrame([("A", "Other", "x", 9.0), ("C", "Gamma", "Oil", 2.0)], answers.schema)
    refresh_cache(cache, listing.where("symbol <> 'B'"), later, industry="vIndustry")
    assert rows_of(before) == [("A", "Alpha", None, 1.5), ("B", None, "Paper", None)]
    assert rows_of(cache.read(spark)) == [("A", "Alpha", None, 1.5), ("C", "Gamma", "Oil", 2.0)]


COMPANIES = [("Apple Inc.", "US"), ("Meta (US)", "US"), ("SAP", "DE"), ("Amazon.com", "US")]
PROFILES = [("APPLE INC", 1), ("apple incorporated", 2), ("AmazonXcom", 3), ("Sap AG", 4), (None, 5), ("meta us", 6)]


def test_company_pattern(spark):
    companies = spark.createDataFrame(COMPANIES, "company string, country string")
    assert dimension.company_pattern(companies).first()[0] == "Amazon.com|Apple Inc|Meta (US)"
    assert dimension.company_pattern(companies, "XX").first()[0] == ""
    assert dimension.company_pattern(companies, None).first()[0].endswith("|SAP")


def test_match_names(spark):
    companies = spark.createDataFrame(COMPANIES, "company string, country string")
    profiles = spark.createDataFrame(PROFILES, "name string, id int")
    ids = lambda df: sorted(r["id"] for r in df.collect())
    # Names are regexes: a dot matches any character and parentheses group.
    assert ids(dimension.match_companies(profiles, companies)) == [1, 2, 3, 6]
    assert ids(dimension.match_names(profiles, "Amazon.com|Meta (US)", quote=True)) == []
    assert ids(dimension.match_names(profiles, "")) == [1, 2, 3, 4, 6]
    with pytest.raises(KeyError):
        dimension.match_names(profiles, "x", name="title")
    with pytest.raises(KeyError):
        dimension.match_companies(profiles, companies, name="title")


def test_mentions_equal_brute_force(spark):
    rng = random.Random(7)
    letters = "abcAB .é#"
    word = lambda most: "".join(rng.choice(letters) for _ in range(rng.randrange(most)))
    names = [word(7) for _ in range(120)] + [None, "", "a", "AB", "ab", "ab", "not in any text"]
    texts = [(k, word(30)) for k in range(150)] + [(200, None), (201, ""), (202, "a")]
    found = mentions(
        spark.createDataFrame([(k, t, 1) for k, t in texts], "symbol int, name string, low int"),
        spark.createDataFrame([(n, 5) for n in names], "company string, length int"),
    ).collect()
    expected = [(k, n) for k, t in texts for n in set(names) if n and t and n.lower() in t.lower()]
    assert sorted((r["symbol"], r["company"]) for r in found) == sorted(expected) and len(expected) > 500
    assert {r["low"] for r in found} == {1}


def test_mentions_of_nothing(spark):
    texts = spark.createDataFrame([(1, "a b")], "symbol int, name string")
    none = spark.createDataFrame([], "company string")
    assert mentions(texts, none).count() == 0 and mentions(texts.limit(0), none.unionByName(spark.createDataFrame([("a",)], "company string"))).count() == 0


def test_mentions_by_grams_of_any_length(spark):
    rng = random.Random(11)
    names = ["".join(rng.choice("ab1") for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    texts = [(k, "".join(rng.choice("aB1") for _ in range(40))) for k in range(40)]
    expected = sorted((k, n) for k, t in texts for n in set(names) if n in t.lower())
    own, listed = spark.createDataFrame(texts, "symbol int, name string"), spark.createDataFrame([(n,) for n in names], "company string")
    for q in (1, 2, 5, 8, 9):
        assert sorted((r["symbol"], r["company"]) for r in mentions(own, listed, q=q).collect()) == expected


def test_mentions_never_broadcast_the_grams_of_the_texts(spark, tmp_path):
    # equal texts make a small file, whose estimate is below any threshold; their grams are many times as large
    spark.range(20_000).selectExpr("id AS symbol", "repeat('a long text ', 20) AS name").write.parquet(f"{tmp_path}/texts")
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    texts, names = session.read.parquet(f"{tmp_path}/texts"), session.createDataFrame([("long t",)], "company string")
    plan = mentions(texts, names)._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
