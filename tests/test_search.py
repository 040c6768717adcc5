import itertools
import json
import math

import pytest
from pyspark.sql import functions as F

from crosslex.functions.analysis import PLAIN
from crosslex.operators import clauses, index, links, results, search
from crosslex.operators.clauses import Clause
from crosslex.sources import workspace

LANGS = ["sk", "cs", "hu"]
PLAINLY = {lang: PLAIN for lang in LANGS}

DOCS = [
    ("sk", "1", "COVID-19", "virus test a test"),
    ("sk", "2", "Test", "iný test"),
    ("sk", "10", "Test", "iný test"),
    ("sk", "3", "Klasická teória testov", "covid covid"),
    ("sk", "4", "Prázdny", ""),
    ("cs", "7", "Covid-19", "nemoc"),
    ("hu", "8", "Covid19", "betegség"),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "lang string, id string, title string, text string")


@pytest.fixture(scope="module")
def ix(spark, docs):
    return index.write_index(docs, workspace.new_path(spark, "ix"), PLAINLY, buckets=3)


def ids(df):
    return [r["id"] for r in df.orderBy("rank").collect()]


def test_bm25_by_hand(ix):
    [hit] = search.search(ix, "sk", "T", "covid").collect()
    n, df, avgdl, dl = 5, 1, (2 + 1 + 1 + 3 + 1) / 5, 2
    expected = math.log(1 + (n - df + .5) / (df + .5)) / (1 + 1.2 * (.25 + .75 * dl / avgdl))
    assert hit["score"] == pytest.approx(expected, abs=1e-6)


def test_scopes_and_ties(ix):
    assert ids(search.search(ix, "sk", "T", "test")) == ["2", "10"]
    both = search.search(ix, "sk", "T&t", "covid test")
    assert set(ids(both)) == {"1", "2", "10"}
    either = search.search(ix, "sk", "t|T", "covid test")
    assert set(ids(either)) == {"1", "2", "10", "3"}


def test_either_score_is_the_sum(ix):
    def scores(at):
        return {r["id"]: r["score"] for r in search.search(ix, "sk", at, "covid test").collect()}

    title, text, either, both = scores("T"), scores("t"), scores("T|t"), scores("T&t")
    for doc, score in either.items():
        assert score == pytest.approx(title.get(doc, 0) + text.get(doc, 0), abs=2e-6)
    assert set(both) == set(title) & set(text)


def test_repeated_word_counts_twice(ix):
    once = search.search(ix, "sk", "T", "covid").first()["score"]
    assert search.search(ix, "sk", "T", "covid covid").first()["score"] == pytest.approx(2 * once)


def test_no_words_no_hits(ix):
    assert search.search(ix, "sk", "T", "?!").count() == 0


def test_copies_count_as_documents(spark):
    """A document stored once with copies gives what the repeated rows give."""
    given = [("sk", str(i), f"w{i % 3} x", "body text x") for i in range(6)]
    schema = "lang string, id string, title string, text string"
    bag = spark.createDataFrame(given + [given[0]] * 4 + [given[4]] * 12, schema)
    built = index.build_index(bag, PLAINLY)
    assert built.docs.count() == 6
    stats = {r["field"]: r["n_docs"] for r in built.field_stats.collect()}
    assert stats == {"title": 22, "text": 22}
    hits = search.search(built, "sk", "t", "body").orderBy("rank").collect()
    assert [(h["id"], h["copy_no"]) for h in hits] == [("0", i) for i in range(1, 6)] + [
        ("1", 1), ("2", 1), ("3", 1), ("4", 1), ("4", 2)]
    counted = spark.createDataFrame(given, schema).withColumn(
        "copies", F.when(F.col("id") == "0", 5).when(F.col("id") == "4", 13).otherwise(1))
    again = index.build_index(counted, PLAINLY, unique_ids=True)
    assert rows(search.search(again, "sk", "T|t", "x w1")) == rows(
        search.search(built, "sk", "T|t", "x w1"))


def test_same_id_other_content(spark):
    given = [("sk", "1", "a", "b"), ("sk", "1", "a", "c"), ("sk", "1", None, "c")]
    docs = index.collapse_copies(
        spark.createDataFrame(given, "lang string, id string, title string, text string"))
    assert sorted(r["dup_no"] for r in docs.collect()) == [0, 1, 2]


def test_index_is_replaced_not_appended(spark, docs):
    path = workspace.new_path(spark, "again")
    first = index.write_index(docs, path, PLAINLY, 2).postings.count()
    assert index.write_index(docs, path, PLAINLY, 2).postings.count() == first
    assert index.read_index(spark, path, PLAINLY).postings.count() == first


def test_lengths_match_frequencies(ix):
    lengths = ix.postings.groupBy("lang", "field", "id").agg(
        F.sum("tf").alias("tf"), F.max("dl").alias("dl"), F.sum(F.col("first").cast("int")).alias("f"))
    assert lengths.where("tf <> dl OR f <> 1").count() == 0
    assert ix.postings.where("size(positions) <> tf").count() == 0


def test_terms_are_grouped_whatever_the_slices(spark, monkeypatch):
    texts = ["b a b é a b", "", "z", "a " * 9, "Á b é b"]
    rows = spark.createDataFrame(
        [("sk", "text", str(n), 0, 1, len(t.split()), [(w, i) for i, w in enumerate(t.split())])
         for n, t in enumerate(texts)],
        "lang string, field string, id string, dup_no int, copies long, dl int, "
        "tokens array<struct<term string, pos int>>").coalesce(1)
    want = []
    for n, text in enumerate(texts):
        words = text.split()
        for term in sorted(set(words), key=str.encode):
            places = [i for i, w in enumerate(words) if w == term]
            want.append(("sk", "text", term, str(n), 0, 1, len(places), len(words),
                         term == min(words, key=str.encode), places))
    for most in (1, 7, 1 << 20):
        monkeypatch.setattr(index, "SLICE_TOKENS", most)
        assert [tuple(r) for r in index.group_terms(rows).collect()] == want


def test_lossy_lengths(spark):
    pairs = {5: 5, 39: 39, 40: 40, 41: 40, 42: 42, 100: 96, 1000: 984, 12345: 12312}
    df = spark.createDataFrame([(k,) for k in pairs], "dl int")
    found = {r["dl"]: r["x"] for r in df.select(
        "dl", search.lossy_length(F.col("dl")).alias("x")).collect()}
    assert found == pairs


QUERIES = [
    (1, "sk:T:covid test"), (2, "sk:t|T:test:more"), (3, "xx:T:a"), (4, "sk:Q:a"), (5, "sk:T:"),
    (6, "SK:T:a"), (7, "sk:T::x"), (8, "sk:T: "), (9, "cs:T&t:covid nemoc"), (10, None),
]


def test_validation(spark):
    queries = spark.createDataFrame(QUERIES, "qid int, q string")
    valid, rejected = search.validate_queries(queries, LANGS)
    assert rows(search.decode_queries(valid)) == [
        (1, "sk", "T", "covid test"), (2, "sk", "t|T", "test"), (9, "cs", "T&t", "covid nemoc")]
    assert {r["qid"]: r["reason"] for r in rejected.collect()} == {
        3: "language", 4: "scope", 5: "syntax", 6: "language", 7: "empty text", 8: "empty text",
        10: "syntax"}
    assert search.normalize_lang("SK", LANGS) == "sk"
    with pytest.raises(ValueError):
        search.normalize_lang("de", LANGS)


def test_batch_is_the_single_queries(spark, ix):
    queries = spark.createDataFrame(QUERIES, "qid int, q string")
    batch = search.search_batch(queries, ix)
    single = search.search(ix, "sk", "t|T", "test")
    assert rows(batch.where("qid = 2").drop("qid")) == rows(single.drop("qid"))
    assert set(r["qid"] for r in batch.collect()) == {1, 2, 9}
    shuffled = search.search_batch(queries, ix, small=False)
    assert rows(shuffled) == rows(batch)


def test_scan_is_pruned(ix):
    plan = search.search(ix, "sk", "T", "covid")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("dynamicpruning") >= 3
    looked_up = search.lookup_id(ix, "sk", "10")
    assert rows(looked_up) == [("sk", "10", "Test", "iný test")]
    plan = looked_up._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lang" in plan and "bucket" in plan


TRIPLES = [("1", "7", "8"), ("2", "7", "99")]


@pytest.fixture(scope="module")
def id_map(spark):
    triples = spark.createDataFrame(TRIPLES, "sk_id string, cs_id string, hu_id string")
    return links.build_id_map(triples, LANGS)


def test_translations(spark, ix, id_map):
    asked = search.query_table(spark, [(1, "sk:T|t:test")])
    found = results.cross_search(asked, ix, id_map, LANGS)
    table = [(r["rank"], r["pos"], r["lang"], r["id"], r["title"])
             for r in found.orderBy("rank", "pos").collect()]
    assert [t for t in table if t[0] == 1] == [
        (1, 0, "sk", "2", "Test"), (1, 1, "cs", "7", "Covid-19"), (1, 2, "hu", "99", None)]
    assert (2, 0, "sk", "10", "Test") in table and not any(t[0] == 2 and t[1] for t in table)
    lines = [r["line"] for r in results.to_lines(found).orderBy("rank", "pos").collect()]
    assert lines[:2] == ["2 SK Test", "7 CS Covid-19"]
    [(_, nested)] = rows(results.to_json(found))
    first = json.loads(nested)["searchResult"][0]
    assert list(first) == ["sk", "cs", "hu"]
    assert first["cs"] == {"id": "7", "title": "Covid-19", "text": "nemoc"}
    assert first["hu"] == {"id": "99"}


def test_order_of_translations(spark, ix, id_map):
    asked = search.query_table(spark, [(1, "hu:T:covid19")])
    found = results.cross_search(asked, ix, id_map, LANGS).orderBy("rank", "pos").collect()
    assert [r["lang"] for r in found] == ["hu", "sk", "cs"]


# --- clauses -----------------------------------------------------------------

WORDS = [
    ("en", "1", "t", "a b c a b"), ("en", "2", "t", "b a c"), ("en", "3", "t", "a x b"),
    ("en", "4", "t", "test tset tests"), ("en", "5", "t", "abc abd zzz"), ("en", "6", "t", "a a b"),
]


@pytest.fixture(scope="module")
def words(spark):
    docs = spark.createDataFrame(WORDS, "lang string, id string, title string, text string")
    return index.build_index(docs, {"en": PLAIN})


def found(words, *given):
    return sorted(r["id"] for r in clauses.score_clauses(words, "en", list(given)).collect())


def test_clause_kinds(words):
    def text(kind, value, **more):
        return Clause("text", kind, value, **more)

    assert found(words, text("phrase", "a b")) == ["1", "6"]
    assert found(words, text("phrase", "a a b")) == ["6"]
    assert found(words, text("phrase", "a b", slop=1)) == ["1", "3", "6"]
    assert found(words, text("phrase", "a b", slop=2)) == ["1", "2", "3", "6"]
    assert found(words, text("prefix", "AB")) == ["5"]
    assert found(words, text("wildcard", "t?st*")) == ["4"]
    assert found(words, text("regex", "ab[cd]")) == ["5"]
    assert found(words, text("range", "abc", upper="abd", inclusive=False)) == []
    assert found(words, text("range", "abc", upper="abd")) == ["5"]


def test_sloppy_frequency(spark):
    """Three words, worked out by hand: places as they stand, offsets 0, 1, 2."""
    given = [
        ([0], [1], [2], 1.0),              # in sequence
        ([0], [2], [4], 1 / (1 + 2)),      # each one place late: at 0, 1, 2
        ([2], [1], [0], 1 / (1 + 4)),      # in reverse: at 2, 0, -2
        ([0, 10], [1, 11], [2, 12], 2.0 + 1 / 11 + 1 / 11),
        ([0], [50], [51], 0.0),
    ]
    rows = spark.createDataFrame(given, "p0 array<int>, p1 array<int>, p2 array<int>, x double")
    for r in rows.select(clauses.sloppy_frequency(10, [0, 1, 2]).alias("f"), "x").collect():
        assert r["f"] == pytest.approx(r["x"])


def test_fuzzy_takes_all_near_terms(spark):
    docs = spark.createDataFrame(
        [("en", str(i), "", f"tes{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(80)],
        "lang string, id string, title string, text string")
    built = index.build_index(docs, {"en": PLAIN})
    assert len(found(built, Clause("text", "fuzzy", "tesxx"))) == 80
    assert len(found(built, Clause("text", "fuzzy", "tesxx", expansions=50))) == 50


def test_same_number_in_two_languages(spark):
    docs = spark.createDataFrame(
        [("sk", "7", "test", ""), ("cs", "7", "test test", ""), ("cs", "8", "test a b", "")],
        "lang string, id string, title string, text string")
    built = index.build_index(docs, {"sk": PLAIN, "cs": PLAIN})
    asked = search.query_table(spark, [(1, "sk:T:test"), (1, "cs:T:test")])
    both = {(r["lang"], r["id"]): r["score"] for r in search.score_queries(asked, built).collect()}
    alone = search.score_queries(search.query_table(spark, [(1, "cs:T:test")]), built)
    assert sorted(both) == [("cs", "7"), ("cs", "8"), ("sk", "7")]
    assert {k: v for k, v in both.items() if k[0] == "cs"} == {
        (r["lang"], r["id"]): r["score"] for r in alone.collect()}


def test_boolean_clauses(words):
    a, b, c = (Clause("text", "term", w) for w in "abc")
    must_not = Clause("text", "term", "x", "must_not")
    assert found(words, must_not) == []
    assert found(words, a, must_not) == ["1", "2", "6"]
    assert found(words, Clause("text", "term", "c", "must"), a) == ["1", "2"]
    grouped = [Clause("text", "term", "c", "must", group=1), Clause("text", "term", "x", "must", group=1),
               Clause("text", "term", "b", "must", group=2)]
    assert found(words, *grouped) == ["1", "2", "3"]


def test_boost(words):
    def score(boost):
        return clauses.score_clauses(
            words, "en", [Clause("text", "term", "x", boost=boost)]).first()["score"]

    assert score(2.0) == pytest.approx(2 * score(1.0), abs=2e-6)


def test_bad_clauses():
    for bad in (dict(kind="wildcard", value="*a"), dict(kind="fuzzy", value="a", edits=3),
                dict(kind="other", value="a"), dict(kind="range", value="a")):
        with pytest.raises(ValueError):
            Clause("text", **bad)


def osa(a, b):
    """Edit distance with swaps of neighbours, by the textbook table."""
    d = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1)
         if not i or not j}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        cost = a[i - 1] != b[j - 1]
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + cost)
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@pytest.mark.parametrize("most", [0, 1, 2])
def test_edit_distance(spark, most):
    terms = ["".join(t) for n in range(1, 6) for t in itertools.product("abc", repeat=n)]
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    for word in ["ab", "abca", "aabb", "abcab"]:
        mine = {r["t"]: r["d"] for r in df.select(
            "t", clauses.edit_distance(F.col("t"), word, most).alias("d")).collect()}
        brute = {t: osa(word, t) if osa(word, t) <= most else None for t in terms}
        assert mine == brute
