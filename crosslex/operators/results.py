"""Hits with their translations: flat rows, nested JSON, printed lines."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosslex.operators import search as ranked
from crosslex.operators.index import Index, bucket
from crosslex.sources import workspace

#: Up to this many rows of hits are broadcast to the documents.
BROADCAST_HITS = 200_000


def other_languages(lang: Column, langs) -> Column:
    """The languages that accompany one, in language order."""
    return F.filter(F.array(*[F.lit(x) for x in langs]), lambda x: x != lang)


def expand_translations(hits: DataFrame, id_map: DataFrame, index: Index, langs,
                        small: bool = False, map_buckets: int | None = None) -> DataFrame:
    """``(qid, rank, score, pos, lang, id, title, text)``: each hit, then its translations.

    ``id_map`` may have a column ``bucket``, of ``map_buckets`` buckets or as many as the
    index; then only the folders of the hits' buckets are read of it. A hit without translations stays alone; a translation that is not in the index
    has no title and text. Documents are read for these few ids only, after the
    ranking. ``small`` hits are broadcast, so that the scan is pruned to the ids'
    buckets.
    """
    def side(df):
        return F.broadcast(df) if small else df

    asked = hits.select("qid", "rank", "score", "lang", "id").withColumn(
        "bucket", bucket(F.col("id"), map_buckets or index.buckets))
    known = ["lang", "bucket", "id"] if "bucket" in id_map.columns else ["lang", "id"]
    others = id_map.join(side(asked), known).select(
        "qid", "rank", "score",
        F.array_position(other_languages(F.col("lang"), langs), F.col("other_lang")).cast(
            "int").alias("pos"),
        F.col("other_lang").alias("lang"), F.col("other_id").alias("id"),
        F.lit(0).alias("dup_no"),
    )
    own = hits.select("qid", "rank", "score", F.lit(0).alias("pos"), "lang", "id", "dup_no")
    wanted = own.unionByName(others).withColumn("bucket", bucket(F.col("id"), index.buckets))
    keys = ["lang", "bucket", "id", "dup_no"]
    found = index.docs.select(*keys, "title", "text").join(
        side(wanted.select(*keys).distinct()), keys)
    return wanted.join(found, keys, "left").select(
        "qid", "rank", "score", "pos", "lang", "id", "title", "text")


def cross_search(queries: DataFrame, index: Index, id_map: DataFrame, langs,
                 k: int = ranked.TOP, lossy_norms: bool = True,
                 map_buckets: int | None = None) -> DataFrame:
    """Search, top ``k``, translations: the whole of a cross-language query batch.

    The ranked hits are written before they are expanded. They are few, several
    joins read them, and their real number then decides what is broadcast.
    """
    hits = workspace.settle(ranked.search_batch(queries, index, k, lossy_norms), "hits")
    return expand_translations(
        hits, id_map, index, langs, hits.count() <= BROADCAST_HITS, map_buckets)


def nest(rows: DataFrame) -> DataFrame:
    """``(qid, searchResult)``: a list of ``{lang: {id, title, text}}`` in rank order."""
    document = F.struct(F.coalesce("id", F.lit("")).alias("id"), "title", "text")
    entry = F.struct("pos", "lang", document.alias("document"))
    hits = rows.groupBy("qid", "rank").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    by_lang = F.map_from_entries(F.transform(
        "entries", lambda e: F.struct(e["lang"].alias("key"), e["document"].alias("value"))))
    # A query has at most k hits, a hit at most one document per language. Maps
    # cannot be compared, so rank alone orders them.
    return hits.select("qid", F.col("rank"), by_lang.alias("hit")).groupBy("qid").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "hit")),
                         lambda a, b: a["rank"] - b["rank"]),
            lambda x: x["hit"],
        ).alias("searchResult"))


def to_json(rows: DataFrame) -> DataFrame:
    """``(qid, json)``: one ``{"searchResult": [...]}`` object per query."""
    return nest(rows).select("qid", F.to_json(F.struct("searchResult")).alias("json"))


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON line per query; a former result is replaced."""
    nest(rows).write.mode("overwrite").json(path)


def to_lines(rows: DataFrame) -> DataFrame:
    """``(qid, rank, pos, line)`` with lines ``id LANG title``."""
    return rows.select(
        "qid", "rank", "pos", F.concat_ws(" ", "id", F.upper("lang"), "title").alias("line"))
