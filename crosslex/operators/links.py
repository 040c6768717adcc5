"""Interlanguage links to id pairs, translation tuples and id maps."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosslex.functions.text import title_key
from crosslex.operators.skew import salted_join


def number(id_column) -> Column:
    """Numeric value of a text id, null where it is no number."""
    return F.col(id_column).try_cast("long")


def link_keys(links: DataFrame, namespaces=None) -> DataFrame:
    """Links with the page-table spelling of their title, empty ones included."""
    return links.select(
        "ll_from", F.col("ll_lang").alias("lang"), "ll_title",
        title_key(F.col("ll_title"), namespaces).alias("title_key"),
    )


def normalize_links(links: DataFrame, namespaces=None) -> DataFrame:
    """Links whose title is not empty once its prefix is gone."""
    return link_keys(links, namespaces).where(F.col("title_key") != "")


def title_ids(pages: DataFrame) -> DataFrame:
    """One page per title: of several pages with one title the smallest id counts."""
    return pages.groupBy("lang", F.col("page_title").alias("title_key")).agg(
        F.min("page_id").alias("target_id"))


def resolve_links(links: DataFrame, pages: DataFrame, namespaces=None, **salting) -> DataFrame:
    """``pairs(pivot_id, lang, target_id)``: links whose title is a page.

    Many links may point to one popular title, so the join is salted.
    """
    found = salted_join(
        normalize_links(links, namespaces).select("ll_from", "lang", "title_key"),
        title_ids(pages), ["lang", "title_key"], F.col("ll_from"), **salting,
    )
    return found.select(
        F.col("ll_from").cast("long").cast("string").alias("pivot_id"), "lang",
        F.col("target_id").cast("long").cast("string").alias("target_id"),
    )


def unresolved_links(links: DataFrame, pages: DataFrame, namespaces=None, **salting) -> DataFrame:
    """Links that give no pair, with the reason."""
    keys = link_keys(links, namespaces)
    known = pages.select("lang", F.col("page_title").alias("title_key")).distinct()
    missing = salted_join(
        keys.where(F.col("title_key") != ""), known, ["lang", "title_key"],
        F.col("ll_from"), how="left_anti", **salting,
    ).withColumn("reason", F.lit("No page_id"))
    empty = keys.where(F.coalesce("title_key", F.lit("")) == "").withColumn("reason", F.lit("Title missing"))
    return missing.unionByName(empty).select("ll_from", "lang", "ll_title", "reason")


def pivot_join(pairs: DataFrame, pivot: str, targets) -> DataFrame:
    """Pivot articles linked to every target language: ``<lang>_id`` per language.

    An inner join per language with bag semantics. The sides are plain shuffles of
    the pair table, which adaptive execution can split where an id is skewed.
    """
    per_lang = [
        pairs.where(F.col("lang") == lang).select(
            F.col("pivot_id").alias(f"{pivot}_id"), F.col("target_id").alias(f"{lang}_id"))
        for lang in targets
    ]
    joined = reduce(lambda a, b: a.join(b, f"{pivot}_id"), per_lang)
    return joined.select(f"{pivot}_id", *[f"{lang}_id" for lang in targets])


def build_id_map(triples: DataFrame, langs) -> DataFrame:
    """``id_map(lang, id, other_lang, other_id)`` for every language, both ways.

    An id in several triples keeps the tuple of other ids that is numerically
    largest, compared in language order, pivot first.
    """
    def row(lang):
        others = [other for other in langs if other != lang]
        return F.struct(
            F.lit(lang).alias("lang"),
            F.col(f"{lang}_id").alias("id"),
            F.struct(
                F.array(*[number(f"{o}_id") for o in others]).alias("numbers"),
                F.array(*[F.struct(F.lit(o).alias("other_lang"),
                                   F.col(f"{o}_id").alias("other_id")) for o in others]
                        ).alias("others"),
            ).alias("candidate"),
        )

    return (
        triples.select(F.inline(F.array(*[row(lang) for lang in langs])))
        .groupBy("lang", "id").agg(F.max("candidate").alias("best"))
        .select("lang", "id", F.inline("best.others"))
    )
