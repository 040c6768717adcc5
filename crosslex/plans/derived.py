"""Linked articles derived from the given ``documents`` and ``labels`` tables.

* article: a document; its first line is the title, the rest its text
* page, langlinks: the tables a wiki keeps about articles. The documents of a
  block of sixteen neighbouring ids are linked: the n-th English one to the n-th
  of every other language. By its source, a link may be broken in one of the ways
  that real links are.
* corpus: the articles, without those labelled toxic

The same tables are spelled in SQL in :mod:`crosslex.plans.oracle`.
"""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crosslex.functions.analysis import CZECH, HUNGARIAN, PLAIN
from crosslex.functions.text import plain_words
from crosslex.operators import (
    by_document, clause_batch, corpus, index, links, lookups, update)
from crosslex.sources import workspace

PIVOT = "en"
TARGETS = ["de", "fr"]
LANGS = [PIVOT, *TARGETS]
ALL_LANGS = [*LANGS, "es"]
PLAIN_ANALYZERS = {lang: PLAIN for lang in ALL_LANGS}

#: The analyzers with stop words and stems, on languages that the test data has.
ANALYZERS = {"en": CZECH, "de": HUNGARIAN}

#: Folders per language and field of the indexes. For data of this size; on a
#: cluster so many that a folder of documents is about a gigabyte.
BUCKETS = 8

#: Links come from blocks of this many neighbouring ids.
LINK_BLOCK = 16


@dataclass(frozen=True)
class Derived:
    """The derived tables of one data folder, as lazy DataFrames."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def articles(self) -> DataFrame:
        lines = F.split(F.col("text"), "\n", 2)
        return self.table("documents").select(
            F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("num_id"), "lang",
            "source", F.trim(lines[0]).alias("title"),
            F.coalesce(F.get(lines, 1), F.lit("")).alias("text"),
        )

    @cached_property
    def pages(self) -> DataFrame:
        return self.articles.select(
            F.col("num_id").alias("page_id"), "lang", F.lit(0).alias("page_namespace"),
            F.replace("title", F.lit(" "), F.lit("_")).alias("page_title"))

    @cached_property
    def langlinks(self) -> DataFrame:
        block = F.floor(F.col("num_id") / LINK_BLOCK)
        nth = F.row_number().over(Window.partitionBy("block", "lang").orderBy("num_id"))
        placed = self.articles.select(
            "num_id", "lang", "source", "title", block.alias("block")
        ).withColumn("nth", nth)
        sources = placed.where(F.col("lang") == PIVOT).select(
            F.col("num_id").alias("ll_from"), "block", "nth")
        title = (
            F.when(F.col("source") == "src13", F.lit("Category:"))
            .when(F.col("source") == "src11", F.concat(F.lit("Missing "), "num_id"))
            .when(F.col("source") == "src17", F.concat(F.lit("A:B:"), "title"))
            .when(F.col("source") == "src7", F.concat(F.lit("Category:"), "title"))
            .otherwise(F.col("title"))
        )
        return placed.where(F.col("lang") != PIVOT).join(sources, ["block", "nth"]).select(
            "ll_from", F.col("lang").alias("ll_lang"), title.alias("ll_title"))

    @cached_property
    def corpus(self) -> DataFrame:
        toxic = self.table("labels").where(F.col("toxic") == 1).select(
            F.col("doc_id").alias("num_id"))
        return self.articles.join(toxic, "num_id", "left_anti")

    @cached_property
    def pairs(self) -> DataFrame:
        return links.resolve_links(self.langlinks, self.pages)

    @cached_property
    def triples(self) -> DataFrame:
        return links.pivot_join(self.pairs, PIVOT, TARGETS)

    @cached_property
    def complete(self) -> DataFrame:
        return corpus.complete_triples(self.triples, self.corpus, LANGS)

    @cached_property
    def asked(self) -> DataFrame:
        """``queries(qid, q)``: an article's title as a query, some of them invalid."""
        scope = F.col("source")
        for source, at in {"src1": "t", "src2": "T&t", "src3": "t&T", "src4": "T|t",
                           "src5": "t|T", "src6": "Q"}.items():
            scope = F.when(F.col("source") == source, at).otherwise(scope)
        scope = F.when(scope == F.col("source"), "T").otherwise(scope)
        lang = F.when(F.col("source") == "src8", F.upper("lang")).otherwise(F.col("lang"))
        text = (
            F.when(F.col("source") == "src9", F.lit(""))
            .when(F.col("source") == "src10", F.concat("title", F.lit(":more")))
            .when(F.col("source") == "src12", F.concat(F.lit(":"), "title"))
            .otherwise(F.col("title"))
        )
        return self.articles.select(
            F.col("num_id").alias("qid"), F.concat_ws(":", lang, scope, text).alias("q"))

    @cached_property
    def passages(self) -> DataFrame:
        """``queries(qid, q)``: every benchmark passage as a query."""
        return self.table("benchmark").select(
            F.col("item_id").alias("qid"), F.concat(F.lit("en:T|t:"), "text").alias("q"))

    @cached_property
    def short_passages(self) -> DataFrame:
        """``queries(qid, q)``: the first three words of every benchmark passage as a query."""
        first = F.array_join(F.slice(plain_words(F.col("text")), 1, 3), " ")
        return self.table("benchmark").select(
            F.col("item_id").alias("qid"), F.concat(F.lit("en:T|t:"), first).alias("q"))

    @cached_property
    def passage_clauses(self) -> DataFrame:
        """Structured queries, as clauses, from the first words of every benchmark passage."""
        def word(n):
            return F.get(F.col("words"), F.lit(n))

        def several(*numbers):
            return F.array_join(F.array_compact(F.array(*[word(n) for n in numbers])), " ")

        given = [
            {"kind": "term", "value": several(0, 1, 2, 3, 4), "occur": "must", "grp": 1},
            {"kind": "term", "value": several(5, 6, 7), "occur": "must", "grp": 1, "field": "title"},
            {"kind": "phrase", "value": several(1, 2), "boost": 2.0},
            {"kind": "phrase", "value": several(3, 4, 3), "slop": 4},
            {"kind": "prefix", "value": F.left(word(5), F.lit(4))},
            {"kind": "wildcard", "boost": 0.5,
             "value": F.concat(F.left(word(6), F.lit(2)), F.lit("*"), F.right(word(6), F.lit(1)))},
            {"kind": "fuzzy", "value": word(7)},
            {"kind": "fuzzy", "value": word(8), "edits": 1, "expansions": 3},
            {"kind": "range", "value": word(9), "upper": F.concat(word(9), F.lit("e")),
             "inclusive": F.col("item_id") % 2 == 0},
            {"kind": "regex",
             "value": F.concat(F.left(word(10), F.lit(1)), F.lit(".+"), F.right(word(10), F.lit(2)))},
            {"kind": "term", "value": word(11), "occur": "must_not", "field": "title"},
            {"kind": "prefix", "value": F.lit("the"), "occur": "must", "grp": 2},
            {"kind": "term", "value": word(12), "occur": "must", "grp": 2},
        ]
        common = {"lang": PIVOT, "field": "text", "occur": "should"}
        rows = []
        for n, clause in enumerate(given):
            values = common | clause | {"qid": F.col("item_id"), "clause": n}
            rows.append(F.struct(*[
                (v if isinstance(v := values.get(c), Column) else F.lit(v)).cast(t).alias(c)
                for c, t in clause_batch.COLUMNS.items()]))
        return self.table("benchmark").select(
            "item_id", plain_words(F.col("text")).alias("words")).select(
            F.inline(F.array(*rows))).where("value IS NOT NULL")

    # Written tables: read by several queries, so each is built once per session.

    @cached_property
    def kept_triples(self) -> DataFrame:
        return workspace.settle(self.triples, "triples")

    @cached_property
    def article_index(self) -> index.Index:
        """Index of all articles."""
        return index.write_index(
            self.articles, workspace.new_path(self.spark, "articles"), PLAIN_ANALYZERS,
            BUCKETS, unique_ids=True)

    @cached_property
    def looked_up_index(self) -> index.Index:
        """The same with tables from patterns, misspelt words and word pairs to terms."""
        return lookups.write_lookups(
            self.article_index, workspace.new_path(self.spark, "lookups"))

    @cached_property
    def by_document_index(self) -> index.Index:
        """The same laid out by document as well."""
        return by_document.write_by_document(
            self.article_index, workspace.new_path(self.spark, "by-document"))

    @cached_property
    def updated_index(self) -> index.Index:
        """An index of most articles to which a third of two languages' articles, changed or new,
        were added afterwards."""
        path = workspace.new_path(self.spark, "updated")
        first = self.articles.where(F.col("num_id") % 5 != 4)
        built = index.write_index(first, path, PLAIN_ANALYZERS, BUCKETS, unique_ids=True)
        by_document.write_by_document(built, path)
        changed = self.articles.where(
            F.col("lang").isin(PIVOT, "de") & (F.col("num_id") % 3 == 0)).withColumn(
            "text", F.concat(F.split_part("text", F.lit("."), F.lit(1)), F.lit(" zusatz "), "title"))
        return update.update_index(self.spark, path, changed, PLAIN_ANALYZERS)

    @cached_property
    def analyzed_index(self) -> index.Index:
        """Index of the articles of two languages with stop words and stems."""
        return index.write_index(
            self.articles.where(F.col("lang").isin(list(ANALYZERS))),
            workspace.new_path(self.spark, "analyzed"), ANALYZERS, BUCKETS, unique_ids=True)

    @cached_property
    def renumbered_index(self) -> index.Index:
        """Index of articles numbered anew, so that ids recur within and across languages."""
        number = F.floor(F.col("num_id") / 4).cast("string")
        return index.write_index(
            self.articles.withColumn("id", number), workspace.new_path(self.spark, "renumbered"),
            PLAIN_ANALYZERS, BUCKETS)

    @cached_property
    def document_index(self) -> index.Index:
        """Index of the documents of the complete triples."""
        complete = corpus.complete_triples(self.kept_triples, self.corpus, LANGS)
        documents = corpus.extract_counted(self.corpus, complete, LANGS)
        return index.write_index(
            documents, workspace.new_path(self.spark, "documents"),
            {lang: PLAIN for lang in LANGS}, BUCKETS, unique_ids=True)

    @cached_property
    def id_map(self) -> DataFrame:
        return links.build_id_map(self.kept_triples, LANGS)

    @cached_property
    def kept_id_map(self) -> DataFrame:
        placed = self.id_map.withColumn("bucket", index.bucket(F.col("id"), BUCKETS))
        return workspace.settle(placed, "id_map", "lang", "bucket")


_SESSIONS: dict[tuple[str, str], Derived] = {}


def derived(spark: SparkSession, folder: str) -> Derived:
    """The derived tables of a folder, the same object throughout a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _SESSIONS:
        _SESSIONS[key] = Derived(spark, folder)
    return _SESSIONS[key]
