"""Clauses as a table, lookup tables and sloppy phrases, against plain versions."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from crosslex.functions.analysis import PLAIN
from crosslex.operators import clause_batch, clauses, index, lookups
from crosslex.operators.clauses import Clause
from crosslex.sources import workspace

LETTERS = "abcé"


@pytest.fixture(scope="module")
def ix(spark):
    """An index of short texts over few words, so that words repeat and are frequent."""
    rng = random.Random(4)
    words = ["of", "the", "that", *["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 6)))
                                    for _ in range(60)]]
    rows = [(lang, str(n), " ".join(rng.choices(words, k=2)),
             " ".join(rng.choices(words[:3] * 6 + words, k=rng.randint(0, 25))))
            for lang in ("sk", "cs") for n in range(60)]
    frame = spark.createDataFrame(rows, "lang string, id string, title string, text string")
    built = index.write_index(frame, workspace.new_path(spark, "ix"),
                              {"sk": PLAIN, "cs": PLAIN}, buckets=3)
    return lookups.write_lookups(built, workspace.new_path(spark, "lookups"))


def vocabulary(ix, lang="sk", field="text"):
    return {r["term"] for r in ix.term_stats.where(
        (F.col("lang") == lang) & (F.col("field") == field)).select("term").collect()}


# --- sloppy phrases with repeated words ------------------------------------------

def plain_sloppy(words, places, slop):
    """All ways to give each word a place; of those that begin at one place the shortest."""
    best = {}
    for chosen in itertools.product(*[places[w] for w in words]):
        if any(words[i] == words[j] and chosen[i] >= chosen[j]
               for i, j in itertools.combinations(range(len(words)), 2)):
            continue
        keys = sorted((p - i, i, p) for i, p in enumerate(chosen))
        reach = keys[-1][0] - keys[0][0]
        second = keys[1][:2]
        old = best.get(keys[0], (reach, second))
        best[keys[0]] = min(old[0], reach), min(old[1], second)
    total = 0.0
    for (_, i, p), (reach, second) in best.items():
        again = [(q - i, i) for q in places[words[i]] if q > p]
        if reach <= slop and (not again or second < min(again)):
            total += 1 / (1 + reach)
    return total


def test_repeated_words_by_hand(spark):
    cases = [  # phrase, text, slop, frequency
        ("a a", "a", 3, 0), ("a a", "a a", 3, 1), ("a a", "a a a", 3, 2), ("a a", "a x a", 3, 0.5),
        ("a a", "a x a", 0, 0), ("a b a", "a b a", 2, 1), ("a b a", "a b x a", 2, 0.5),
        ("a b a", "a b", 9, 0), ("a b a", "b a a", 2, 1 / 3), ("a a a", "a a", 9, 0),
    ]
    for phrase, text, slop, want in cases:
        words = phrase.split()
        places = {w: [i for i, x in enumerate(text.split()) if x == w] for w in words}
        assert plain_sloppy(words, places, slop) == pytest.approx(want), (phrase, text)
        assert frequencies(spark, [(words, places, slop)]) == [pytest.approx(want)], (phrase, text)


def frequencies(spark, cases):
    rows = []
    for n, (words, places, slop) in enumerate(cases):
        slots = [(i, max((j for j in range(i) if words[j] == w), default=-1), i, places[w])
                 for i, w in enumerate(words)]
        rows.append((n, slots, slop))
    frame = spark.createDataFrame(rows, f"n int, slots array<{clauses.SLOT}>, slop int")
    return [r["f"] for r in frame.select("n", clauses.repeated_frequency(
        F.col("slots"), F.col("slop")).alias("f")).orderBy("n").collect()]


def test_repeated_words_at_random(spark):
    rng = random.Random(1)
    cases = []
    for _ in range(400):
        words = [rng.choice("ab") for _ in range(rng.randint(2, 4))]
        text = [rng.choice("abx") for _ in range(rng.randint(0, 9))]
        places = {w: [i for i, x in enumerate(text) if x == w] for w in words}
        cases.append((words, places, rng.randint(0, 5)))
    got = frequencies(spark, cases)
    for found, case in zip(got, cases):
        assert found == pytest.approx(plain_sloppy(*case)), case


# --- lookups -----------------------------------------------------------------------

PATTERNS = ["a.*", "(a|b)+c", "a?b", "[ab]{2}c*", "é+", "ab|c.", "(?i)AB", r"\p{L}+c", "a.+b?é", "",
            "((a|b)c)+", "[a&&[^b]]b", r"a\wc", "(of)?the", "th(e|at)", r"\Qab\E.*", "a{2,}", ".*"]


def test_regex_grams_lose_no_term(spark, ix):
    terms = vocabulary(ix) | {"ab", "the", "that", "aabbc"}
    frame = spark.createDataFrame([(t,) for t in terms], "term string")
    for pattern in PATTERNS:
        rows = frame.select("term", F.col("term").rlike(f"^(?:{pattern})$").alias("fits"),
                            lookups.regex_grams(F.lit(pattern)).alias("needed"),
                            lookups.grams(lookups.bounded(F.col("term"))).alias("own")).collect()
        for r in rows:
            if r["fits"]:
                assert set(r["needed"] or []) <= set(r["own"]), (pattern, r["term"])


def test_wildcard_grams_lose_no_term(spark, ix):
    frame = spark.createDataFrame([(t,) for t in vocabulary(ix)], "term string")
    for pattern in ["a*", "a?b*", "th?", "*a", "ab*c?", "é*a"]:
        like = clauses.wildcard_pattern(pattern)
        for r in frame.select("term", F.col("term").like(like).alias("fits"),
                              lookups.wildcard_grams(F.lit(pattern)).alias("needed"),
                              lookups.grams(lookups.bounded(F.col("term"))).alias("own")).collect():
            if r["fits"]:
                assert set(r["needed"]) <= set(r["own"]), (pattern, r["term"])


def plain_distance(a, b):
    """Restricted edit distance with swaps of neighbours."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_distance_and_neighbourhoods(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 9))) for _ in range(120)}
                   | {"abcabcabca", "abcabcabac", "bacabcabca", "abcabcabcaéé"})
    pairs = [(a, b) for a in words for b in rng.sample(words, 30)] + list(
        itertools.product(words[-4:], words[-4:]))
    frame = spark.createDataFrame(pairs, "a string, b string")
    rows = frame.select(
        "a", "b", clause_batch.edit_distance(F.col("a"), F.col("b"), F.lit(2)).alias("edits"),
        F.arrays_overlap(lookups.deletions(F.col("a"), 2), lookups.deletions(F.col("b"), 2)).alias("meet"),
        F.arrays_overlap(lookups.deletions(F.col("a"), 2), lookups.deletions(F.col("b"), 1)).alias("meet1"),
    ).collect()
    for r in rows:
        want = plain_distance(r["a"], r["b"])
        assert r["edits"] == (want if want <= 2 else None), r
        assert r["meet"] or want > 2
        assert r["meet1"] or want > 1


def test_terms_that_begin_alike_share_their_keys(spark):
    terms = [f"abcdefg{a}{b}" for a in LETTERS for b in LETTERS]
    frame = spark.createDataFrame([("sk", str(n), term, "x") for n, term in enumerate(terms)],
                                  "lang string, id string, title string, text string")
    built = lookups.write_lookups(index.write_index(
        frame, workspace.new_path(spark, "ix"), {"sk": PLAIN}, buckets=3), workspace.new_path(spark, "lookups"))
    stats = built.term_stats.where("field = 'title'")
    keys = spark.range(1).select(F.size(lookups.deletions(F.lit("abcdefg"), 2))).first()[0]
    assert lookups.neighbour_table(stats, 3).count() == keys
    near = clauses.fuzzy_terms(built, "sk", Clause("title", "fuzzy", "abcdfgaa"))
    assert {r["term"] for r in near.collect()} == {
        t for t in terms if plain_distance(t, "abcdfgaa") <= 2}


def test_pairs_of_frequent_words(ix):
    """A pair's positions are those where both words stand in sequence."""
    frequent = {r["term"] for r in ix.lookups.frequent.where("lang = 'sk' AND field = 'text'").collect()}
    assert {"of", "the", "that"} <= frequent
    for r in ix.docs.where("lang = 'sk'").collect():
        words = re.findall(r"\w+", r["text"])
        want = {}
        for i, (a, b) in enumerate(zip(words, words[1:])):
            if a in frequent and b in frequent:
                want.setdefault(f"{a} {b}", []).append(i)
        got = {p["term"]: p["positions"] for p in ix.lookups.pairs.where(
            (F.col("lang") == "sk") & (F.col("field") == "text") & (F.col("id") == r["id"])).collect()}
        assert got == want
        if r["id"] == "7":
            break


# --- batches ---------------------------------------------------------------------------

def made_clauses(rng, terms):
    def one():
        word = rng.choice(terms)
        occur = rng.choice(["should", "should", "must", "must_not"])
        given = dict(field=rng.choice(["title", "text", "text"]), occur=occur,
                     boost=rng.choice([1.0, 0.5, 2.0]), group=rng.choice([None, None, 1, 2]))
        return rng.choice([
            Clause(kind="term", value=f"{word} {rng.choice(terms)} {word}", **given),
            Clause(kind="phrase", value=rng.choice(["of the that", "the the", f"{word} of", "that of the"]), **given),
            Clause(kind="phrase", value=rng.choice(["the of the", "that the", "of", f"of of {word}"]),
                   slop=rng.randint(1, 4), **given),
            Clause(kind="prefix", value=word[:2], **given),
            Clause(kind="wildcard", value=f"{word[:1]}*{word[-1]}", **given),
            Clause(kind="fuzzy", value=word, edits=rng.choice([0, 1, 2]),
                   expansions=rng.choice([None, 2]), **given),
            Clause(kind="range", value=min(word, "b"), upper=max(word, "b"),
                   inclusive=rng.random() < 0.5, **given),
            Clause(kind="regex", value=rng.choice(["(a|b)+.*", "th.+", f"{word}?", "[of]{2}"]), **given),
        ])

    return [one() for _ in range(rng.randint(1, 5))]


def as_rows(df):
    return {(r["qid"], r["lang"], r["id"]): r["score"] for r in df.collect()}


def test_batch_is_the_single_queries(spark, ix):
    rng = random.Random(3)
    terms = sorted(vocabulary(ix))
    queries = {n: (rng.choice(["sk", "cs"]), made_clauses(rng, terms)) for n in range(9)}
    asked = clause_batch.clause_table(spark, queries)
    got = as_rows(clause_batch.score_clause_batch(ix, asked))
    want = {}
    for qid, (lang, given) in queries.items():
        for r in clauses.score_clauses(ix, lang, given).collect():
            want[qid, lang, r["id"]] = r["score"]
    assert got.keys() == want.keys()
    for key, score in got.items():
        assert score == pytest.approx(want[key], abs=2e-6), (key, queries[key[0]])
    # Beyond the bound of broadcasts, and without lookup tables.
    assert as_rows(clause_batch.score_clause_batch(ix, asked, small=False)) == pytest.approx(got)
    plain = index.Index(ix.docs, ix.postings, ix.term_stats, ix.field_stats, ix.buckets, ix.analyzers)
    assert as_rows(clause_batch.score_clause_batch(plain, asked)) == pytest.approx(got)


def test_invalid_clauses_are_named(spark, ix):
    wrong = spark.sql("""SELECT * FROM VALUES
        (1, 'xx', 0, 'text', 'term', 'a', 'should', 1D, NULL, NULL, true, 0, 2, NULL),
        (2, 'sk', 0, 'text', 'term', 'the', 'should', 1D, NULL, NULL, true, 0, 2, NULL),
        (2, 'sk', 1, 'text', 'range', 'a', 'should', 1D, NULL, NULL, true, 0, 2, NULL),
        (3, 'sk', 0, 'text', 'wildcard', '*a', 'should', 1D, NULL, NULL, true, 0, 2, NULL),
        (4, 'sk', 0, 'text', 'fuzzy', 'a', 'should', 1D, NULL, NULL, true, 0, 3, NULL),
        (5, 'sk', 0, 'text', 'near', 'a', 'should', 1D, NULL, NULL, true, 0, 2, NULL),
        (6, 'sk', 0, 'text', 'term', 'a', 'may', 1D, NULL, NULL, true, 0, 2, NULL),
        (7, 'sk', 0, 'text', 'term', NULL, 'must', 1D, NULL, NULL, true, 0, 2, NULL),
        (8, 'sk', 0, 'text', 'term', 'the', 'should', 1D, NULL, NULL, true, 0, 2, NULL)
        AS t(qid, lang, clause, field, kind, value, occur, boost, grp, upper, inclusive, slop, edits,
             expansions)""")
    many = clause_batch.clause_table(spark, {9: ("sk", [
        Clause("text", "term", "the", "must") for _ in range(clause_batch.MOST_REQUIRED + 1)])})
    asked = wrong.unionByName(many.withColumn("qid", F.col("qid").cast("int")))
    _, rejected = clause_batch.validate_clauses(asked, ix.analyzers)
    assert {r["qid"]: r["reason"] for r in rejected.collect()} == {
        1: "language", 2: "range without an end", 3: "leading wildcard", 4: "edits", 5: "kind",
        6: "occur", 7: "incomplete", 9: "too many required groups"}
    scored = clause_batch.score_clause_batch(ix, asked)
    assert {r["qid"] for r in scored.select("qid").distinct().collect()} == {8}
    assert clause_batch.score_clause_batch(ix, asked.where("false")).count() == 0


def test_best_of_each_query(spark, ix):
    asked = clause_batch.clause_table(spark, {
        1: ("sk", [Clause("text", "term", "of the")]), 2: ("cs", [Clause("text", "phrase", "of the")])})
    best = clause_batch.search_clause_batch(ix, asked, k=3).collect()
    holders = [r["id"] for r in ix.docs.where("lang = 'cs'").collect()
               if re.search(r"\bof the\b", r["text"])]
    assert sorted(r["rank"] for r in best if r["qid"] == 1) == [1, 2, 3]
    assert len([r for r in best if r["qid"] == 2]) == min(3, len(holders)) > 0
    assert {r["id"] for r in best if r["qid"] == 2} <= set(holders)
