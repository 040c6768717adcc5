"""Boundary files and tables: links, pages, pairs, triples, articles, documents, id maps."""

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crosslex import schemas


# --- link and page tables ----------------------------------------------------

def jdbc_options(url: str, table: str, key: str, lower: int, upper: int,
                 partitions: int, **more) -> dict:
    """Options of a JDBC scan split over ``key``, so that no task reads it all."""
    return {
        "url": url, "dbtable": table, "partitionColumn": key, "lowerBound": str(lower),
        "upperBound": str(upper), "numPartitions": str(partitions), **more,
    }


def read_table(spark: SparkSession, source) -> DataFrame:
    """A table from JDBC options (a dict), a registered name or a Parquet path."""
    if isinstance(source, dict):
        return spark.read.format("jdbc").options(**source).load()
    if "/" in source:
        return spark.read.parquet(source)
    return spark.read.table(source)


def read_langlinks(spark: SparkSession, source, lang: str | None = None) -> DataFrame:
    """Interlanguage links, of one target language if given. The filter is pushed down."""
    links = read_table(spark, source).select("ll_from", "ll_lang", "ll_title")
    return links if lang is None else scan_links_by_lang(links, lang)


def scan_links_by_lang(links: DataFrame, lang: str) -> DataFrame:
    return links.where(F.col("ll_lang") == lang).select("ll_from", "ll_title")


def read_pages(spark: SparkSession, sources: dict) -> DataFrame:
    """Page tables of several languages, ``{lang: source}``, as one table."""
    pages = [
        read_table(spark, source).select(
            F.lit(lang).alias("lang"), "page_id", "page_namespace", "page_title")
        for lang, source in sources.items()
    ]
    return reduce(DataFrame.unionByName, pages)


# --- pairs and triples -------------------------------------------------------

def write_pairs(pairs: DataFrame, path: str, pivot: str, langs) -> None:
    """``pairs(pivot_id, lang, target_id)`` as CSV with the header ``<pivot>_id,<lang>_id``,
    a folder per language.

    The pairs are read once per language; give them as a written table.
    """
    for lang in langs:
        pairs.where(F.col("lang") == lang).select(
            F.col("pivot_id").alias(f"{pivot}_id"), F.col("target_id").alias(f"{lang}_id"),
        ).write.csv(f"{path}/lang={lang}", header=True)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The pairs of all folders; columns are known by their place, whatever the header says."""
    return (
        spark.read.schema("pivot_id string, target_id string, lang string")
        .option("pathGlobFilter", "*.csv").option("enforceSchema", True).csv(path, header=True)
        .select("pivot_id", "lang", "target_id")
    )


def write_triples(triples: DataFrame, path: str) -> None:
    """Headered CSV folder; an existing target is an error."""
    triples.write.csv(path, header=True, mode="errorifexists")


def read_triples(spark: SparkSession, path: str, langs) -> DataFrame:
    """Column names come from the schema, whatever the header says."""
    return (
        spark.read.option("pathGlobFilter", "*.csv").option("enforceSchema", True)
        .schema(schemas.triples(langs)).csv(path, header=True)
    )


# --- articles and documents --------------------------------------------------

def read_articles(spark: SparkSession, paths: dict) -> DataFrame:
    """Article JSON Lines under ``{lang: folder}``, nested folders included.

    A malformed line gives a row of nulls, which the joins on ``id`` drop.
    """
    articles = [
        spark.read.schema(schemas.ARTICLE).option("recursiveFileLookup", True).json(path)
        .select(F.lit(lang).alias("lang"), "*")
        for lang, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, articles)


def write_documents(documents: DataFrame, path: str, langs=()) -> dict:
    """``id, title, text`` JSON Lines, one folder per language; null fields are left out.

    Returns the number of documents per language of ``langs``, counted while they
    are written and not in a second pass.
    """
    rows = documents.select("lang", "id", "title", "text")
    if not langs:
        rows.write.partitionBy("lang").json(path)
        return {}
    counts = Observation("documents")
    rows.observe(counts, *[
        F.count_if(F.col("lang") == lang).alias(lang) for lang in langs
    ]).write.partitionBy("lang").json(path)
    return counts.get


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema("id string, title string, text string, lang string")
        .option("pathGlobFilter", "*.json").json(path).select("lang", "id", "title", "text")
    )


# --- id maps -----------------------------------------------------------------

def nest_id_map(id_map: DataFrame, langs) -> DataFrame:
    """``(lang, id, ids)``: the other languages' ids in language order."""
    order = F.array_position(F.array(*[F.lit(lang) for lang in langs]), F.col("other_lang"))
    return id_map.groupBy("lang", "id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(order.alias("pos"), "other_id"))),
            lambda x: x["other_id"],
        ).alias("ids")
    )


def write_id_map(id_map: DataFrame, path: str, langs) -> None:
    """JSON Lines of ``(id, ids)``, one folder per language."""
    nest_id_map(id_map, langs).write.partitionBy("lang").json(path)


def write_id_table(id_map: DataFrame, path: str, buckets: int) -> None:
    """The id map by language and bucket, for searches; a former one is replaced."""
    placed = id_map.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    placed.hint("rebalance", "lang", "bucket").write.mode("overwrite").partitionBy(
        "lang", "bucket").parquet(f"{path}/ids")
    id_map.sparkSession.range(1).select(F.lit(buckets).alias("buckets")).write.mode(
        "overwrite").parquet(f"{path}/layout")


def read_id_table(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The id map and its number of buckets."""
    buckets = spark.read.schema("buckets int").parquet(f"{path}/layout").first()["buckets"]
    return spark.read.schema(
        "id string, other_lang string, other_id string, lang string, bucket int"
    ).parquet(f"{path}/ids"), buckets


def read_id_map(spark: SparkSession, path: str, langs) -> DataFrame:
    """Back to one row per (id, other language)."""
    rows = (
        spark.read.schema("id string, ids array<string>, lang string")
        .option("pathGlobFilter", "*.json").json(path)
    )
    all_langs = F.array(*[F.lit(lang) for lang in langs])
    others = F.filter(all_langs, lambda x: x != F.col("lang"))
    pairs = F.arrays_zip(others.alias("other_lang"), F.col("ids").alias("other_id"))
    return rows.select("lang", "id", F.inline(pairs))
