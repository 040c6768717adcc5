"""Complete triples, their documents, and articles from markup."""

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosslex.operators.skew import salted_join


# --- which triples are complete ----------------------------------------------

def _ids(articles: DataFrame, lang: str) -> DataFrame:
    return articles.where(F.col("lang") == lang).select(F.col("id").alias(f"{lang}_id"))


def missing_triples(triples: DataFrame, articles: DataFrame, lang: str) -> DataFrame:
    """Triples whose article in one language is not in the corpus."""
    return triples.join(_ids(articles, lang), f"{lang}_id", "left_anti").select(*triples.columns)


def complete_triples(triples: DataFrame, articles: DataFrame, langs) -> DataFrame:
    """Distinct triples with an article in every language.

    One distinct and one semi join per language. Equal to removing the missing
    triples by EXCEPT, which would read the triples twice per language.
    """
    out = reduce(
        lambda left, lang: left.join(_ids(articles, lang), f"{lang}_id", "left_semi"),
        langs, triples.distinct(),
    )
    return out.select(*triples.columns)


def complete_triples_except(triples: DataFrame, articles: DataFrame, langs) -> DataFrame:
    """The same by anti join and EXCEPT, for comparison."""
    return reduce(
        lambda left, lang: left.subtract(missing_triples(left, articles, lang)), langs, triples)


# --- documents of the complete triples ---------------------------------------

def wanted_ids(triples: DataFrame, langs) -> DataFrame:
    """``(lang, id, pivot_id)``: one row per triple and language."""
    pivot = langs[0]
    rows = F.array(*[
        F.struct(F.lit(lang).alias("lang"), F.col(f"{lang}_id").alias("id"),
                 F.col(f"{pivot}_id").alias("pivot_id"))
        for lang in langs
    ])
    return triples.select(F.inline(rows))


def extract_documents(articles: DataFrame, triples: DataFrame, langs, **salting) -> DataFrame:
    """``documents(lang, id, title, text)``, one row per triple and language.

    An article that many triples share is emitted once for each of them; such an
    article is spread over several tasks.
    """
    found = salted_join(
        wanted_ids(triples, langs), articles.select("lang", "id", "title", "text"),
        ["lang", "id"], F.col("pivot_id"), **salting,
    )
    return found.select("lang", "id", "title", "text")


def extract_counted(articles: DataFrame, triples: DataFrame, langs) -> DataFrame:
    """The same documents once each, with ``copies``: how many triples share them.

    The copies are counted before the join, so that no text is repeated in the
    shuffle, the index or on disk.
    """
    copies = wanted_ids(triples, langs).groupBy("lang", "id").agg(
        F.count(F.lit(1)).alias("copies"))
    return articles.select("lang", "id", "title", "text").join(copies, ["lang", "id"])


def corpus_counts(documents: DataFrame) -> DataFrame:
    """Documents per language."""
    return documents.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))


# --- articles from markup ----------------------------------------------------

# The named entities that are decoded, ampersand last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&nbsp;", " "), ("&amp;", "&")]

# Elements whose content is no article text.
HTML_DROPPED = ["script", "style", "nav", "head"]

# Wiki markup, in the order it is removed; (pattern, replacement).
WIKI_MARKUP = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<ref[^>/]*/>", ""),
    (r"(?is)<ref[^>]*>.*?</ref>", ""),
    (r"(?is)<(math|gallery|timeline)[^>]*>.*?</\1>", ""),
    (r"\[\[[^\[\]|:]*:(?=\S)[^\[\]|]*\|[^\[\]]*(?:\[\[[^\[\]]*\]\][^\[\]]*)*\]\]", ""),
    (r"\[\[[^\[\]|:]+:(?=\S)[^\[\]]*\]\]", ""),
    (r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", "$1"),
    (r"\[\[([^\[\]]*)\]\]", "$1"),
    (r"\[https?://[^\s\]]+\s+([^\]]*)\]", "$1"),
    (r"\[https?://[^\s\]]+\]", ""),
    (r"'{2,5}", ""),
    (r"(?m)^=+\s*(.*?)\s*=+\s*$", "$1."),
    (r"(?m)^[*#:;]+\s*", ""),
    (r"<[^>]+>", ""),
    (r"[ \t]+", " "),
    (r"\n{3,}", "\n\n"),
]


def decode_entities(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), ENTITIES, text)


# Signs that open and close what may be nested; a closing sign of a table is none
# where its last character closes a template.
SIGNS = {"{{": "}}", "{|": "|}", "[[": "]]"}
ANY_SIGN = rb"\{[{|]|\}\}|\|\}(?!\})|\[\[|\]\]"
#: A link into a namespace, whose text is no running text, but not one that only points there.
NAMESPACE_LINK = rb"\[\[[^\[\]|:]+:(?=[^ \t\n\x0b\f\r])"


def without_nested(text: Column, signs: dict[str, str] = SIGNS) -> Column:
    """Text outside templates, tables and links into namespaces, however deeply they are nested.

    Each text is read once, from sign to sign. A stack holds the signs that are open; what the
    outermost of them spans is dropped when it closes, or kept if it is a plain link. A closing
    sign too many is text, what is opened and never closed hides nothing; a sign that closes an
    outer one closes all in it. Null stays null.
    """
    opening = {sign.encode(): kind for kind, sign in enumerate(signs)}
    closing = {sign.encode(): kind for kind, sign in enumerate(signs.values())}
    any_sign, namespace_link = ANY_SIGN, NAMESPACE_LINK

    @F.arrow_udf("string")
    def visible(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import re

        import pyarrow as pa

        # All signs are ASCII, so texts stay bytes.
        find, into_namespace = re.compile(any_sign).finditer, re.compile(namespace_link).match

        def shown(text: bytes) -> bytes:
            kept, begin, outermost = [], 0, 0
            stack, held = [], [0] * len(opening)
            for found in find(text):
                kind = opening.get(found[0])
                if kind is not None:
                    if not stack:
                        outermost = found.start()
                    stack.append(kind)
                    held[kind] += 1
                    continue
                kind = closing.get(found[0])
                if kind is None or not held[kind]:
                    continue
                while True:
                    inner = stack.pop()
                    held[inner] -= 1
                    if inner == kind:
                        break
                if not stack and (not text.startswith(b"[[", outermost)
                                  or into_namespace(text, outermost, found.end())):
                    kept.append(text[begin:outermost])
                    begin = found.end()
            return b"".join([*kept, text[begin:]]) if begin else text

        for batch in batches:
            texts = batch.cast(pa.binary()).to_pylist()
            yield pa.array([t if t is None else shown(t) for t in texts], pa.binary()).view(pa.string())

    return visible(text)


def without_templates(text: Column) -> Column:
    """Text outside double braces, however deeply they are nested."""
    return without_nested(text, {"{{": "}}"})


def strip_wiki(text: Column) -> Column:
    """Text of a wiki page; templates are dropped, not expanded. Null stays null."""
    hidden, rest = WIKI_MARKUP[:4], WIKI_MARKUP[4:]
    visible = reduce(lambda c, rule: F.regexp_replace(c, *rule), hidden, text)
    plain = reduce(lambda c, rule: F.regexp_replace(c, *rule), rest, without_nested(visible))
    return F.trim(decode_entities(plain))


def strip_html(html: Column) -> Column:
    """Text of an HTML page with single spaces."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for element in HTML_DROPPED:
        text = F.regexp_replace(text, rf"(?is)<{element}\b[^>]*>.*?</{element}>", " ")
    text = decode_entities(F.regexp_replace(text, r"<[^>]*>", " "))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def extract_articles(pages: DataFrame) -> DataFrame:
    """Article rows from ``pages(page_id, url, html)``."""
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    return pages.select(
        F.col("page_id").cast("string").alias("id"),
        F.lower(F.regexp_extract("html", r'(?i)<html[^>]*\blang="([^"]+)"', 1)).alias("lang"),
        "url",
        F.trim(decode_entities(title)).alias("title"),
        strip_html(F.col("html")).alias("text"),
    )


def read_dump(spark, path: str, lang: str, base_url: str = "") -> DataFrame:
    """Article rows from an XML page dump: main-namespace pages, no redirects."""
    schema = ("id long, ns int, title string, redirect struct<_title: string>, "
              "revision struct<id: long, text: string>")
    dump = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    articles = dump.where((F.col("ns") == 0) & F.col("redirect").isNull())
    return articles.select(
        F.lit(lang).alias("lang"),
        F.col("id").cast("string").alias("id"),
        F.col("revision.id").cast("string").alias("revid"),
        F.concat(F.lit(base_url), F.col("id").cast("string")).alias("url"),
        "title",
        strip_wiki(F.col("revision.text")).alias("text"),
    )
