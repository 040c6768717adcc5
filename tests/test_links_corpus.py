import time

import pytest
from pyspark.sql import functions as F

from crosslex.operators import corpus, links, skew, titles
from crosslex.sources import tables, workspace


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


LINKS = [(1, "cs", "A:B C"), (2, "cs", "D"), (3, "cs", "X:"), (4, "cs", "nowhere"),
         (1, "hu", "E"), (2, "hu", "E"), (5, "hu", None)]
PAGES = [("cs", 11, 0, "B_C"), ("cs", 9, 14, "B_C"), ("cs", 12, 0, "D"), ("hu", 21, 0, "E"),
         ("hu", 11, 0, "D")]


@pytest.fixture
def wiki(spark):
    return (spark.createDataFrame(LINKS, "ll_from long, ll_lang string, ll_title string"),
            spark.createDataFrame(
                PAGES, "lang string, page_id long, page_namespace int, page_title string"))


def test_resolve(wiki):
    pairs = links.resolve_links(*wiki)
    assert rows(pairs) == [("1", "cs", "9"), ("1", "hu", "21"), ("2", "cs", "12"),
                           ("2", "hu", "21")]
    assert rows(links.unresolved_links(*wiki)) == [
        (3, "cs", "X:", "Title missing"), (4, "cs", "nowhere", "No page_id"),
        (5, "hu", None, "Title missing")]
    assert rows(links.pivot_join(pairs, "sk", ["cs", "hu"])) == [
        ("1", "9", "21"), ("2", "12", "21")]


def test_resolve_with_hot_titles(spark):
    """Hot keys are salted, and the result is the same."""
    given = spark.range(3000).select(
        F.col("id").alias("ll_from"), F.lit("cs").alias("ll_lang"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("ll_title"))
    pages = spark.range(2000).select(
        F.lit("cs").alias("lang"), F.col("id").alias("page_id"), F.lit(0).alias("page_namespace"),
        F.when(F.col("id") < 5, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("page_title"))
    hot = skew.hot_keys(links.normalize_links(given), ["title_key"], share=10, min_rows=1)
    assert rows(hot) == [("hot",)]
    salted = links.resolve_links(given, pages, salts=7, share=10, min_rows=1)
    assert rows(salted) == rows(links.resolve_links(given, pages))
    assert salted.where("target_id = '0'").count() == 1000
    missing = links.unresolved_links(given, pages, salts=7, share=10, min_rows=1)
    assert missing.count() + salted.count() == 3000


def test_complete_triples(spark):
    triples = spark.createDataFrame(
        [("1", "a"), ("1", "a"), (None, "b"), ("2", None), ("3", "c")],
        "sk_id string, cs_id string")
    articles = spark.createDataFrame(
        [("sk", "1"), ("sk", "1"), ("sk", "2"), ("sk", None)], "lang string, id string")
    semi = corpus.complete_triples(triples, articles, ["sk"])
    literal = corpus.complete_triples_except(triples, articles, ["sk"])
    assert rows(semi) == rows(literal) == [("1", "a"), ("2", None)]


def test_shared_article(spark):
    triples = spark.createDataFrame([("1", "7"), ("2", "7"), ("3", "8")], "sk_id string, cs_id string")
    articles = spark.createDataFrame(
        [("sk", "1", "a", "x"), ("sk", "2", "b", "y"), ("sk", "3", "c", "z"),
         ("cs", "7", "d", "v"), ("cs", "8", "e", "w"), ("cs", "9", "f", "u")],
        "lang string, id string, title string, text string")
    bag = corpus.extract_documents(articles, triples, ["sk", "cs"])
    salted = corpus.extract_documents(articles, triples, ["sk", "cs"], salts=3, share=10, min_rows=1)
    assert rows(bag) == rows(salted)
    assert rows(bag.where("lang = 'cs'").select("id")) == [("7",), ("7",), ("8",)]
    counted = corpus.extract_counted(articles, triples, ["sk", "cs"])
    assert rows(counted.where("copies > 1").select("lang", "id", "copies")) == [("cs", "7", 2)]


def test_id_map_collision(spark):
    triples = spark.createDataFrame(
        [("9", "5", "1"), ("10", "5", "2"), ("10", "6", "3")],
        "sk_id string, cs_id string, hu_id string")
    found = links.build_id_map(triples, ["sk", "cs", "hu"])
    assert rows(found.where("lang = 'cs' AND id = '5'").select("other_lang", "other_id")) == [
        ("hu", "2"), ("sk", "10")]
    assert rows(found.where("lang = 'sk' AND id = '10'").select("other_lang", "other_id")) == [
        ("cs", "6"), ("hu", "3")]
    nested = tables.nest_id_map(found, ["sk", "cs", "hu"])
    assert nested.where("lang = 'cs' AND id = '5'").first()["ids"] == ["10", "2"]


def test_files(spark):
    path = workspace.new_path(spark, "t")
    triples = spark.createDataFrame([("1", "2"), ("3", None)], "sk_id string, cs_id string")
    tables.write_triples(triples, f"{path}/triples")
    assert rows(tables.read_triples(spark, f"{path}/triples", ["sk", "cs"])) == rows(triples)
    with pytest.raises(Exception, match="(?i)exists"):
        tables.write_triples(triples, f"{path}/triples")


def test_malformed_articles(spark, tmp_path):
    nested = tmp_path / "AA"
    nested.mkdir()
    (nested / "wiki_00").write_text(
        '{"id": "1", "revid": "2", "url": "u", "title": "T", "text": "x"}\nnot json\n')
    articles = tables.read_articles(spark, {"sk": str(tmp_path)})
    assert rows(articles) == [("sk", "1", "2", "u", "T", "x"), ("sk", None, None, None, None, None)]


def test_jdbc_options_split_the_scan():
    options = tables.jdbc_options("jdbc:x", "langlinks", "ll_from", 1, 100, 8, user="u")
    assert options["partitionColumn"] == "ll_from" and options["numPartitions"] == "8"


DUMP = """<mediawiki><page><title>Test</title><ns>0</ns><id>12</id><revision><id>5</id>
<text>'''Test''' je [[skúška|skúšky]] a {{citácia|x={{y}}}}[[Star Trek: Nemesis]].&lt;ref&gt;z&lt;/ref&gt;
[[Kategória:Testy]]
== Dejiny ==
* [http://x.sk odkaz]</text></revision></page>
<page><title>Presmerovanie</title><ns>0</ns><id>13</id><redirect title="Test"/>
<revision><id>6</id><text>#REDIRECT</text></revision></page>
<page><title>Diskusia:Test</title><ns>1</ns><id>14</id><revision><id>7</id><text>x</text></revision>
</page></mediawiki>"""


def test_nested_templates(spark):
    given = ["{{a|{{b|{{c|{{d|{{e|{{f}}x}}}}}}}}}}Text after", "{{a|}}}}b", "open {{a {{b}} c",
             "{{{x}}}y", "no braces { here }", ""]
    made = spark.createDataFrame([(t,) for t in given], "t string").select(
        corpus.without_templates(F.col("t")))
    assert [r[0] for r in made.collect()] == [
        "Text after", "}}b", "open {{a {{b}} c", "}y", "no braces { here }", ""]


def test_dump(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(DUMP)
    [article] = corpus.read_dump(spark, str(tmp_path / "dump.xml"), "sk", "u/").collect()
    assert (article["id"], article["revid"], article["url"], article["title"]) == (
        "12", "5", "u/12", "Test")
    assert article["text"].split("\n")[0] == "Test je skúšky a Star Trek: Nemesis."
    assert "Dejiny." in article["text"] and "odkaz" in article["text"]
    assert "Kategória" not in article["text"] and "http" not in article["text"]


def test_title_example(spark):
    """Two matched words come first; accents do not matter."""
    dictionary = spark.createDataFrame(
        [(1, "COVID-19", "Covid-19", "Covid19"), (2, "Rýchly test COVID-19", "Rychlý test", "Teszt"),
         (3, "Turingov test", "Turingův test", "Turing-teszt"), (70_000, "Test", "Testování", "T")],
        "dict_id long, sk_title string, cs_title string, hu_title string")
    langs = ["sk", "cs", "hu"]
    index = titles.token_index(dictionary, langs)
    asked = spark.createDataFrame([(1, "sk: covid test"), (2, "cs:TURINGUV")], "qid int, q string")
    ranked = titles.rank_titles(titles.search_titles(asked, index))
    assert rows(ranked.where("qid = 1").select("n", "dict_id", "matched")) == [
        (1, 2, 2), (2, 1, 1), (3, 3, 1), (4, 70_000, 1)]
    [line] = titles.to_lines(ranked.where("qid = 2"), dictionary, langs).collect()
    assert line["line"] == "1. Turingův test (cs) = Turingov test (sk) = Turing-teszt (hu)"


def test_running_number(spark):
    df = spark.range(0, 1000).select((F.col("id") * 37).alias("k"), (F.col("id") % 3).alias("g"))
    numbered = titles.running_number(df, "k", "n", within=("g",), block=100)
    for group in range(3):
        found = [r["n"] for r in numbered.where(f"g = {group}").orderBy("k").collect()]
        assert found == list(range(1, len(found) + 1))


NESTED = [
    ("a {{b {{c}} d}} e", "a  e"), ("a {{b", "a {{b"), ("a }} b", "a }} b"), ("{{a|}}b", "b"),
    ("a {| x\n| {| y |} z\n|} b", "a  b"), ("a {| {{t|}} |} b {{u {| v |} }} c", "a  b  c"),
    ("[[File:x.png|see [[b|c]] and {{d}}]] e", " e"), ("[[a|b]] [[c]]", "[[a|b]] [[c]]"),
    ("[[a|{{t}}]]", "[[a|{{t}}]]"), ("{{a [[b }} c", " c"), ("{a} [b] | c", "{a} [b] | c"),
    ("", ""), (None, None), ("[[:Category:x]]", "[[:Category:x]]"), ("{{{a}}}", "}"),
    ("{{a}}" * 3_000 + "b" * 5_000 + "{{" + "c" * 9_000, "b" * 5_000 + "{{" + "c" * 9_000),
    ("{{" * 500 + "x" + "}}" * 500 + "y", "y"), ("[[a " + "b" * 9_000 + "]]", "[[a " + "b" * 9_000 + "]]"),
]


def test_balanced_markup(spark):
    frame = spark.createDataFrame([(n, t) for n, (t, _) in enumerate(NESTED)], "n int, t string")
    got = {r["n"]: r["x"] for r in frame.select("n", corpus.without_nested(F.col("t")).alias("x")).collect()}
    for n, (text, want) in enumerate(NESTED):
        assert got[n] == want, text and text[:60]


def test_markup_takes_time_in_proportion(spark):
    """A million signs, in one row."""
    frame = spark.range(1).select(F.expr("repeat('{{a}} [[b|c]] {| d |} ', 30000)").alias("t"))
    text = frame.select(corpus.without_nested(F.col("t"))).first()[0]
    assert text.split() == ["[[b|c]]"] * 30_000


def test_deep_markup_takes_time_in_proportion(spark):
    """Two hundred thousand signs within one another, in one row."""
    frame = spark.range(1).select(F.expr(
        "concat('a ', repeat('{{', 200000), ' |} ]] ', repeat('}}', 200000), ' b')").alias("t"))
    begun = time.monotonic()
    assert frame.select(corpus.without_nested(F.col("t"))).first()[0] == "a  b"
    assert time.monotonic() - begun < 20


def test_markup_of_any_text_goes_through_python_whole(spark):
    texts = [None, "", "žluťoučký {{kůň}} 漢字 😀 [[a:\u00a0b]]", "{{é" * 3, "[[a:]] [[b: c]] [[d:\te]]"]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    got = [r[0] for r in frame.orderBy("n").select(corpus.without_nested(F.col("t"))).collect()]
    assert got == [None, "", "žluťoučký  漢字 😀 ", "{{é" * 3, " [[b: c]] [[d:\te]]"]
