"""Postings laid out by document: scores are summed where the rows lie, and blocks of
documents that cannot reach the best are not read.

``weights``  lang, field, block, term, id, dup_no, copies, tf, dl
``bounds``   lang, field, term_bucket, term, block, max_tf, min_dl

A document is in one block by the hash of its id. ``weights`` is a table with the blocks as
folders, bucketed by id into as many buckets: a block is read by one task, so a sum by document
needs no shuffle, and there are as many tasks as blocks.
It has no positions; what needs them, or only a few terms, reads the postings by term.
``bounds`` has for each term and block the largest frequency and the smallest length, from
which no document of the block gets a larger score, whatever the mean length becomes.
"""

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crosslex.operators import search
from crosslex.operators.index import Index, bucket, write_folders
from crosslex.sources import workspace

#: Blocks per bucket. For data of this size; on a cluster so many blocks in all that a
#: folder is about a gigabyte.
BLOCKS_PER_BUCKET = 4

WEIGHTS = {"term": "string", "id": "string", "dup_no": "int", "copies": "long", "tf": "int",
           "dl": "int", "lang": "string", "field": "string", "block": "int"}
FOLDERS = ["lang", "field", "block"]
BOUNDS = "term string, block int, max_tf int, min_dl int, lang string, field string, term_bucket int"
BOUND_FOLDERS = ["lang", "field", "term_bucket"]

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

#: Scores are rounded to six decimals; a bound is not.
ROUNDING = 1e-6


def block_of(key: Column, blocks: int) -> Column:
    """Block of an id: Spark's bucket of it among as many buckets."""
    return F.pmod(F.hash(key), F.lit(blocks))


def weight_rows(postings: DataFrame, blocks: int) -> DataFrame:
    return postings.withColumn("block", block_of(F.col("id"), blocks)).select(*WEIGHTS)


def bound_rows(weights: DataFrame, buckets: int) -> DataFrame:
    return weights.groupBy(*FOLDERS, "term").agg(
        F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl")).withColumn(
        "term_bucket", bucket(F.col("term"), buckets)).select(
        "term", "block", "max_tf", "min_dl", *BOUND_FOLDERS)


def _table(spark: SparkSession, path: str, blocks: int, written: bool = True) -> str:
    """Name of the bucketed table whose files are at a path. The name holds for the session."""
    name = f"crosslex_weights_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}` {t}" for c, t in WEIGHTS.items())
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(FOLDERS)}) "
              f"CLUSTERED BY (id) SORTED BY (term) INTO {blocks} BUCKETS LOCATION '{path}'")
    if written:  # the catalog learns of the folders that are there
        spark.catalog.recoverPartitions(name)
    return name


def overwrite_blocks(rows: DataFrame, path: str, blocks: int) -> None:
    """Write blocks into the table at a path; blocks of which no row is given stay."""
    spark = rows.sparkSession
    name = _table(spark, path, blocks, written=False)
    columns = spark.table(name).columns
    # Tables take this from the session only.
    mode = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        with workspace.freeing(spark):
            rows.select(*columns).hint("rebalance", *FOLDERS).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE_MODE, mode)
    spark.sql(f"DROP TABLE {name}")  # the name only: the table's place is its own


def write_by_document(index: Index, path: str, blocks: int | None = None) -> Index:
    """Lay the postings of an index out by document, and return the index with that."""
    spark = index.postings.sparkSession
    blocks = blocks or index.buckets * BLOCKS_PER_BUCKET
    if blocks % index.buckets:
        raise ValueError("blocks must be a multiple of the buckets")
    overwrite_blocks(weight_rows(index.postings, blocks), f"{path}/weights", blocks)
    spark.range(1).select(F.lit(blocks).alias("blocks")).write.mode("overwrite").parquet(
        f"{path}/blocks")
    weights = spark.read.schema(_schema()).parquet(f"{path}/weights")
    write_folders(bound_rows(weights, index.buckets), f"{path}/bounds", BOUND_FOLDERS, F.col("term"))
    return read_by_document(spark, index, path)


def _schema() -> str:
    return ", ".join(f"{c} {t}" for c, t in WEIGHTS.items())


def read_by_document(spark: SparkSession, index: Index, path: str) -> Index:
    """The index with the layout that was written for it."""
    blocks = spark.read.schema("blocks int").parquet(f"{path}/blocks").first()["blocks"]
    return replace(
        index, blocks=blocks, weights=spark.table(_table(spark, f"{path}/weights", blocks)),
        bounds=spark.read.schema(BOUNDS).parquet(f"{path}/bounds"))


# --- top k by bounds ------------------------------------------------------------------

def term_bounds(terms: DataFrame, index: Index, lossy_norms: bool = True) -> DataFrame:
    """``qid, lang, field, term, block, bound``: a term adds no more to a document of the block."""
    part = F.col("weight") * search.tf_norm(
        F.col("max_tf"), F.col("min_dl"), F.col("avgdl"), lossy_norms)
    return index.bounds.join(F.broadcast(terms), ["lang", "field", "term_bucket", "term"]).select(
        "qid", "lang", "field", "term", "block", part.alias("bound"))


def rarest_terms(terms: DataFrame, postings: int) -> DataFrame:
    """Of each query the rarest terms, until they have so many postings."""
    before = Window.partitionBy("qid").orderBy("df", "lang", "field", "term").rowsBetween(
        Window.unboundedPreceding, -1)
    return terms.withColumn("earlier", F.coalesce(F.sum("df").over(before), F.lit(0))).where(
        F.col("earlier") < postings).drop("earlier")


def needed_terms(terms: DataFrame, bounds: DataFrame, least: DataFrame) -> DataFrame:
    """The terms with ``needed``: a document with none of a query's needed terms scores less
    than ``least(qid, least)``, whatever others it has."""
    highest = bounds.groupBy("qid", "lang", "field", "term").agg(F.max("bound").alias("highest"))
    rising = Window.partitionBy("qid", "lang").orderBy("highest", "field", "term").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return terms.join(highest, ["qid", "lang", "field", "term"]).join(
        F.broadcast(least), "qid", "left").withColumn(
        "needed", F.coalesce(F.sum("highest").over(rising) + ROUNDING >= F.col("least"), F.lit(True)))


def kth_scores(scored: DataFrame, k: int) -> DataFrame:
    """``qid, least``: the k-th score of the queries that have as many hits."""
    return search.top_k(scored, k).where(F.col("rank") == k).select(
        "qid", F.col("score").alias("least"))


def matches_of(terms: DataFrame, index: Index) -> DataFrame:
    """Postings of the terms, with their blocks."""
    return index.weights.join(F.broadcast(terms.drop("term_bucket")), ["lang", "field", "term"])


def candidates(found: DataFrame, terms: DataFrame, bounds: DataFrame) -> DataFrame:
    """Documents that can still be among the best: with what the terms that are not needed may
    add in their block."""
    slack = bounds.join(terms.where(~F.col("needed")).select(
        "qid", "lang", "field", "term"), ["qid", "lang", "field", "term"]).groupBy(
        "qid", "lang", "block").agg(F.sum("bound").alias("slack"))
    least = F.broadcast(terms.select("qid", "least").distinct())
    return found.join(slack, ["qid", "lang", "block"], "left").join(least, "qid").where(
        F.col("least").isNull()
        | (F.col("part") + F.coalesce("slack", F.lit(0.0)) + ROUNDING >= F.col("least")))


def matches_in(found: DataFrame, terms: DataFrame, index: Index, lossy_norms: bool) -> DataFrame:
    """Postings of the terms that are not needed, in the candidates only.

    Candidates within a bound are broadcast; only their blocks' folders are then read.
    """
    asked = F.broadcast(terms.where(~F.col("needed")).drop("term_bucket", "copies"))
    keys = found.select("qid", "lang", "block", "id", "dup_no").where("block >= 0")
    few = found.count() <= search.BROADCAST_CHARS
    rows = index.weights.join(F.broadcast(keys) if few else keys, ["lang", "block", "id", "dup_no"])
    return rows.join(asked, ["qid", "lang", "field", "term"])


def search_pruned(queries: DataFrame, index: Index, k: int = search.TOP, lossy_norms: bool = True,
                  enough: int = 50) -> DataFrame:
    """The hits of :func:`search.search_batch`, from as few postings as the bounds allow.

    First the rarest terms of each query are scored, ``enough * k`` postings or so. A sum over
    some terms is at most the score, so the k-th of these sums is one that every hit reaches.
    Terms that together stay below it are not needed: a document that has only such is no hit.
    The needed terms' postings are scored; of the documents found, those whose sum can reach the
    k-th with what the other terms may add in their block are candidates, and only there, in
    the folders of their blocks, the other terms are read. Queries with fewer than ``k`` hits
    by their rarest terms read all.
    """
    terms = workspace.settle(search.weighted_terms(queries, index), "terms")
    bounds = workspace.settle(term_bounds(terms, index, lossy_norms), "bounds")
    scored = search.score_documents(matches_of(rarest_terms(terms, enough * k), index), lossy_norms)
    least = workspace.settle(kth_scores(scored, k), "least")
    split = workspace.settle(needed_terms(terms, bounds, least), "split")
    found = search.document_parts(matches_of(split.where("needed"), index), lossy_norms, "block")
    best = workspace.settle(candidates(found, split, bounds), "candidates")
    others = search.document_parts(matches_in(best, split, index, lossy_norms), lossy_norms)
    return search.top_k(search.finish_scores(best.select(others.columns).unionByName(others)), k)
