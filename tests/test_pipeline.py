"""All stages, files to files, on a small three-language corpus with its analyzers."""

import json

import pytest

from crosslex.operators import results, search
from crosslex.plans import pipeline

ARTICLES = {
    "sk": [("1", "Rýchly antigénový test COVID-19", "Test na vírus, covid."),
           ("2", "Test", "Rozcestník: covid a test."),
           ("3", "Klasická teória testov", "O covide nie, len test a covid."),
           ("4", "Motorka", "Bez slova."),
           ("5", "Osamotený test", "covid test")],
    "cs": [("11", "Rychlý antigenní test na covid-19", "a"), ("12", "Testování", "b"),
           ("13", "Klasická testová teorie", "c"), ("14", "Motocykl", "d")],
    "hu": [("21", "Covid19-antigén gyorsteszt", "a"), ("22", "Test", "b"),
           ("23", "Klasszikus tesztelmélet", "c")],
}
LINKS = [(1, "11", "21"), (2, "12", "22"), (3, "13", "23"), (4, "14", "missing")]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("wiki")
    titles = {lang: {i: t for i, t, _ in rows} for lang, rows in ARTICLES.items()}
    links = [(sk, lang, titles[lang].get(i, i)) for sk, cs, hu in LINKS
             for lang, i in (("cs", cs), ("hu", hu))] + [(1, "de", "Test")]
    spark.createDataFrame(links, "ll_from long, ll_lang string, ll_title string").write.parquet(
        f"{root}/langlinks")
    for lang, rows in ARTICLES.items():
        # The article of one link is not in the corpus, its page is.
        pages = [(int(i), 0, t.replace(" ", "_")) for i, t, _ in rows]
        pages += [(99, 0, "missing")] if lang == "hu" else []
        spark.createDataFrame(
            pages, "page_id long, page_namespace int, page_title string"
        ).write.parquet(f"{root}/page-{lang}")
        folder = root / f"articles-{lang}" / "AA"
        folder.mkdir(parents=True)
        (folder / "wiki_00").write_text("".join(
            json.dumps({"id": i, "revid": "0", "url": "u", "title": t, "text": x}) + "\n"
            for i, t, x in rows))
    pipeline.find_pairs(spark, f"{root}/langlinks",
                        {x: f"{root}/page-{x}" for x in ("cs", "hu")}, f"{root}/pairs")
    pipeline.join_pairs(spark, f"{root}/pairs", f"{root}/triples")
    counts = pipeline.create_documents(
        spark, {x: f"{root}/articles-{x}" for x in ARTICLES}, f"{root}/triples",
        f"{root}/documents")
    pipeline.index_documents(spark, f"{root}/documents", f"{root}/index", buckets=2)
    pipeline.map_ids(spark, f"{root}/triples", f"{root}/maps")
    return root, counts


def test_equal_counts(built):
    assert built[1] == {"sk": 3, "cs": 3, "hu": 3}


def ask(spark, built, q):
    root, _ = built
    found = pipeline.search(spark, search.query_table(spark, [(1, q)]), f"{root}/index",
                            f"{root}/maps")
    return [r["line"] for r in results.to_lines(found).orderBy("rank", "pos").collect()]


def test_both_fields(spark, built):
    """Any word per field is enough, hyphens split words, endings do not matter."""
    lines = ask(spark, built, "sk:T&t:covid test")
    assert lines[:3] == ["1 SK Rýchly antigénový test COVID-19",
                         "11 CS Rychlý antigenní test na covid-19",
                         "21 HU Covid19-antigén gyorsteszt"]
    assert {x for x in lines if " SK " in x} == {
        "1 SK Rýchly antigénový test COVID-19", "2 SK Test", "3 SK Klasická teória testov"}


def test_other_languages(spark, built):
    assert ask(spark, built, "cs:T:teorie") == [
        "13 CS Klasická testová teorie", "3 SK Klasická teória testov",
        "23 HU Klasszikus tesztelmélet"]
    assert ask(spark, built, "hu:T:antigénben")[0] == "21 HU Covid19-antigén gyorsteszt"


def test_stop_words_find_nothing(spark, built):
    assert ask(spark, built, "sk:T|t:na a ale") == []


def test_result_file(spark, built, tmp_path):
    root, _ = built
    found = pipeline.search(spark, search.query_table(spark, [(7, "hu:T:test")]),
                            f"{root}/index", f"{root}/maps")
    for _ in range(2):
        results.write_json(found, str(tmp_path / "out"))
    [row] = spark.read.json(str(tmp_path / "out")).collect()
    assert row["qid"] == 7
    assert [r.asDict()["sk"]["title"] for r in row["searchResult"]] == ["Test"]
