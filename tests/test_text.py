import pytest
from pyspark.sql import functions as F

from crosslex.functions import stemmers, text
from crosslex.functions.analysis import ANALYZERS, PLAIN, analyze, analyzer_for


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_title_key(spark):
    given = ["Foo", "A:B", "A:B:C", "Star Trek: Nemesis", "Cat:", "", ":x", None]
    assert column(spark, given, text.title_key) == [
        "Foo", "B", "B:C", "_Nemesis", "", "", "x", None]
    known = column(spark, given, lambda c: text.title_key(c, ["A", "Cat"]))
    assert known == ["Foo", "B", "B:C", "Star_Trek:_Nemesis", "", "", ":x", None]


def test_unicode_words(spark):
    given = ["COVID-19 don't U.S.A. 3.14 a_b x@y.com", "___ e.g. 1.a", "漢字かな kana", "x" * 300]
    words = column(spark, given, text.unicode_words)
    assert words[0] == "covid 19 don't u.s.a 3.14 a_b x y.com".split()
    assert words[1] == ["e.g", "1", "a"]
    assert words[2] == ["漢", "字", "か", "な", "kana"]
    assert [len(w) for w in words[3]] == [255, 45]


#: Cases of the published rules of word boundaries, and of emoji.
BREAKS = {
    "can't 32.3 1,234.5 e.g. a.b": ["can't", "32.3", "1,234.5", "e.g", "a.b"],
    "a_b 1_a _x_ __ a__1": ["a_b", "1_a", "_x_", "a__1"],
    "カタカナ ｶﾀｶﾅ カタkana カ_a ア.ア": ["カタカナ", "ｶﾀｶﾅ", "カタ", "kana", "カ_a", "ア", "ア"],
    "한국어abc 한글 3한": ["한국어abc", "한글", "3한"],
    "漢字かなカナ": ["漢", "字", "か", "な", "カナ"],
    "👍🏽 ok👍ok": ["👍🏽", "ok", "👍", "ok"],
    "👨‍👩‍👧‍👦 ❤️ ❤": ["👨‍👩‍👧‍👦", "❤️"],
    "🇨🇿🇭🇺 🇸": ["🇨🇿", "🇭🇺"],
    "1️⃣ #️⃣ 12": ["1️⃣", "#️⃣", "12"],
    "🏴󠁧󠁢󠁥󠁮󠁧󠁿x": ["🏴󠁧󠁢󠁥󠁮󠁧󠁿", "x"],
    "e\u0301te\u0301 so\u00adft": ["e\u0301te\u0301", "so\u00adft"],
    "👩🏽‍🚀🚀": ["👩🏽‍🚀", "🚀"],
    "שלום עולם Ωμέγα": ["שלום", "עולם", "ωμέγα"],
}


def test_word_breaks(spark):
    assert column(spark, list(BREAKS), text.unicode_words) == list(BREAKS.values())


def test_word_breaks_by_sql(spark):
    """The SQL that checks whole tables gives the same on these cases."""
    import duckdb

    from crosslex.plans.oracle import unicode_words

    for given, want in BREAKS.items():
        assert duckdb.execute(f"SELECT {unicode_words('t')} FROM (SELECT ? AS t)", [given]).fetchone()[0] == want


def test_very_long_word(spark):
    [words] = column(spark, ["a1" * 40_000], text.unicode_words)
    assert sum(map(len, words)) == 80_000


def test_fold_accents(spark):
    assert column(spark, ["hebrejčina", "ŐSZI Út"], text.fold_accents) == ["hebrejcina", "oszi ut"]


CZECH = {"testov": "test", "klasická": "klasick", "praze": "prah", "matčin": "matk",
         "testech": "test", "dům": "dom", "češt": "česk", "a": "a"}
HUNGARIAN = {"házakkal": "ház", "késsel": "kés", "kézzel": "kéz", "asszonnyal": "asszony",
             "kutyáknak": "kutya", "könyveim": "könyv", "ban": "ban", "én": "én",
             "nagyobb": "nagyobb", "babakocsi": "babakocs"}


@pytest.mark.parametrize("language, pairs", [("czech", CZECH), ("hungarian", HUNGARIAN)])
def test_stem(spark, language, pairs):
    assert column(spark, list(pairs), lambda c: stemmers.stem(c, language)) == list(pairs.values())


def test_stop_words_leave_gaps(spark):
    df = spark.createDataFrame(
        [("sk", "Klasická teória testov a COVID-19"), ("hu", "A házakkal és könyveim")],
        "lang string, t string")
    rows = df.select(analyze(F.col("t"), F.col("lang")).alias("x")).collect()
    found = [[(t["term"], t["pos"]) for t in r["x"]] for r in rows]
    assert found[0] == [("klasick", 0), ("teóri", 1), ("test", 2), ("covid", 4), ("19", 5)]
    assert found[1] == [("ház", 1), ("könyv", 3)]


def test_analyzers():
    assert analyzer_for("sk") == analyzer_for("cs") == ANALYZERS["sk"]
    with pytest.raises(ValueError):
        analyzer_for("en")


def test_unknown_language_fails(spark):
    df = spark.createDataFrame([("xx", "word")], "lang string, t string")
    with pytest.raises(Exception, match="no analyzer for language xx"):
        df.select(analyze(F.col("t"), F.col("lang"), {"en": PLAIN})).collect()
