"""Adding documents to a written index and changing those that it has.

The new content of every folder that changes is written beside the index first, then put in
place folder by folder. Folders without a changed document or term keep their files, no
document that stays is analyzed again, and statistics are the old ones with the difference
of the changed documents. Putting in place again gives the same, so a job that broke off is
finished by :func:`apply_update`.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosslex.functions.analysis import ANALYZERS
from crosslex.operators import by_document, index, search
from crosslex.operators.index import Index, bucket
from crosslex.operators.links import number
from crosslex.sources import workspace

#: Tables of an index with their folders and the order within files.
FOLDERS = {
    "docs": ["lang", "bucket"],
    "postings": ["lang", "field", "term_bucket"],
    "term_stats": ["lang", "field", "term_bucket"],
    "bounds": by_document.BOUND_FOLDERS,
}


@dataclass(frozen=True)
class Staged:
    """New content of the folders that change, written and not yet in place."""

    tables: dict[str, DataFrame]
    emptied: dict[str, DataFrame]
    field_stats: DataFrame
    blocks: int


def _within(table: DataFrame, folders: DataFrame, names: list[str]) -> DataFrame:
    """Rows of some folders; the list of folders is bounded by the layout and prunes the scan."""
    return table.join(F.broadcast(folders.select(*names).where(F.col(names[0]).isNotNull())), names, "left_semi")


def _but(table: DataFrame, ids: DataFrame, few: bool) -> DataFrame:
    return table.join(F.broadcast(ids) if few else ids, ["lang", "id"], "left_anti")


def _opened(spark: SparkSession, path: str, analyzers) -> Index:
    """The index at a path, with its layout by document if it has one there."""
    found = index.read_index(spark, path, analyzers)
    has = spark.read.option("ignoreMissingFiles", "true").option("pathGlobFilter", "*.parquet")
    try:
        has.schema("blocks int").parquet(f"{path}/blocks")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return found
    return by_document.read_by_document(spark, found, path)


def stage_update(spark: SparkSession, path: str, documents: DataFrame, analyzers=ANALYZERS,
                 removed: DataFrame | None = None) -> Staged:
    """Write the new content of all folders that ``documents`` and ``removed(lang, id)`` change.

    All versions of a document that is given, or removed, are replaced; one that is not in the
    index is added.
    """
    old = _opened(spark, path, analyzers)
    given = documents if removed is None else documents.join(
        removed.select("lang", "id").distinct(), ["lang", "id"], "left_anti")
    fresh = workspace.settle(index.collapse_copies(given).withColumn(
        "bucket", bucket(F.col("id"), old.buckets)), "fresh")
    touched = fresh.select("lang", "id")
    if removed is not None:
        touched = touched.unionByName(removed.select("lang", "id"))
    ids = workspace.settle(touched.distinct(), "touched")
    few = ids.count() <= search.BROADCAST_CHARS
    tables, emptied = {}, {}

    def stage(name, current, added, folders):
        """Old rows of the changed folders without the changed documents, and the new rows."""
        kept = _but(_within(current, folders, FOLDERS.get(name, by_document.FOLDERS)), ids, few)
        tables[name] = workspace.settle(kept.select(*current.columns).unionByName(
            added.select(*current.columns)), name)
        names = FOLDERS.get(name, by_document.FOLDERS)
        emptied[name] = folders.select(*names).join(
            tables[name].select(*names).distinct(), names, "left_anti")

    placed = ids.withColumn("bucket", bucket(F.col("id"), old.buckets))
    stage("docs", old.docs, fresh, placed.select("lang", "bucket").distinct())

    postings = workspace.settle(index.build_postings(fresh, analyzers).withColumn(
        "term_bucket", bucket(F.col("term"), old.buckets)), "new-postings")
    languages = F.broadcast(ids.select("lang").distinct())
    gone = workspace.settle(
        (old.postings.join(languages, "lang", "left_semi") if old.weights is None else _within(
            old.weights.withColumn("first", F.lit(None).cast("boolean")), ids.select(
                "lang", by_document.block_of(F.col("id"), old.blocks).alias("block")).distinct(),
            ["lang", "block"])).join(F.broadcast(ids) if few else ids, ["lang", "id"], "left_semi").select(
            "lang", "field", "term", "id", "dup_no", "copies", "tf", "dl"), "gone")

    sign = F.lit(1).cast("long")
    change = postings.select(gone.columns).withColumn("sign", sign).unionByName(
        gone.withColumn("sign", -sign))
    terms = workspace.settle(change.groupBy("lang", "field", "term").agg(
        F.sum(F.col("sign") * F.col("copies")).alias("df"),
        F.sum(F.col("sign") * F.col("copies") * F.col("tf")).alias("ttf"),
    ).withColumn("term_bucket", bucket(F.col("term"), old.buckets)), "changed-terms")
    term_folders = terms.select("lang", "field", "term_bucket").distinct()
    stage("postings", old.postings, postings, term_folders)

    keys = ["lang", "field", "term_bucket", "term"]
    counted = terms.where("df <> 0 OR ttf <> 0").select(*keys, "df", "ttf")
    stat_folders = counted.select("lang", "field", "term_bucket").distinct()
    tables["term_stats"] = workspace.settle(
        _within(old.term_stats, stat_folders, FOLDERS["term_stats"]).select(*keys, "df", "ttf").unionByName(
            counted).groupBy(*keys).agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf")).where(
            "df > 0").select(*old.term_stats.columns), "term_stats")
    names = FOLDERS["term_stats"]
    emptied["term_stats"] = stat_folders.join(
        tables["term_stats"].select(*names).distinct(), names, "left_anti")

    # A document's length once: with its copies, as the statistics count it.
    sizes = change.groupBy("lang", "field", "id", "dup_no", "sign").agg(
        F.max("copies").alias("copies"), F.max("dl").alias("dl"))
    difference = sizes.groupBy("lang", "field").agg(
        F.sum(F.col("sign") * F.col("copies")).alias("n_docs"),
        F.sum(F.col("sign") * F.col("copies") * F.col("dl")).alias("sum_dl"))
    totals = old.field_stats.select("lang", "field", "n_docs", "sum_dl").unionByName(
        difference).groupBy("lang", "field").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("sum_dl").alias("sum_dl")).where("n_docs > 0")
    field_stats = workspace.settle(totals.withColumn(
        "avgdl", F.col("sum_dl").cast("double") / F.col("n_docs")), "field_stats")

    if old.weights is not None:
        _stage_by_document(old, postings, ids, few, tables, emptied)
    return Staged(tables, emptied, field_stats, old.blocks)


def _stage_by_document(old: Index, postings: DataFrame, ids: DataFrame, few: bool,
                       tables: dict, emptied: dict) -> None:
    """The blocks that change, and the bounds of the terms in them."""
    blocks = ids.select("lang", by_document.block_of(F.col("id"), old.blocks).alias("block")).distinct()
    folders = workspace.settle(blocks.join(F.broadcast(
        old.field_stats.select("lang", "field").unionByName(
            postings.select("lang", "field")).distinct()), "lang"), "blocks")
    kept = _but(_within(old.weights, folders, by_document.FOLDERS), ids, few)
    fresh = by_document.weight_rows(postings, old.blocks)
    tables["weights"] = workspace.settle(
        kept.select(*fresh.columns).unionByName(fresh), "weights")
    emptied["weights"] = folders.join(
        tables["weights"].select(*by_document.FOLDERS).distinct(), by_document.FOLDERS, "left_anti")
    # Bounds of other blocks stay; their folders are those of the terms, so these are read.
    changed = by_document.bound_rows(tables["weights"], old.buckets)
    bound_folders = folders.select("lang", "field").distinct().withColumn(
        "term_bucket", F.explode(F.sequence(F.lit(0), F.lit(old.buckets - 1))))
    others = _within(old.bounds, bound_folders, FOLDERS["bounds"]).join(
        F.broadcast(folders), by_document.FOLDERS, "left_anti")
    tables["bounds"] = workspace.settle(
        others.select(*changed.columns).unionByName(changed), "bounds")
    emptied["bounds"] = bound_folders.join(
        tables["bounds"].select(*FOLDERS["bounds"]).distinct(), FOLDERS["bounds"], "left_anti")


def apply_update(path: str, staged: Staged) -> None:
    """Put staged folders in place. Doing it again changes nothing."""
    for name, rows in staged.tables.items():
        spark = rows.sparkSession
        gone = staged.emptied[name]
        if name == "weights":
            by_document.overwrite_blocks(rows, f"{path}/weights", staged.blocks)
        else:
            order = number("id") if name == "docs" else F.col("term")
            index.write_folders(rows, f"{path}/{name}", FOLDERS[name], order, dynamic=True)
        _remove_folders(spark, f"{path}/{name}", gone)
    staged.field_stats.write.mode("overwrite").parquet(f"{path}/field_stats")


def _remove_folders(spark: SparkSession, path: str, folders: DataFrame) -> None:
    """Remove folders that hold no row any more: as many at most as the layout has."""
    jvm = spark.sparkContext._jvm
    for row in folders.collect():
        place = jvm.org.apache.hadoop.fs.Path(
            "/".join([path, *[f"{name}={row[name]}" for name in folders.columns]]))
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def update_index(spark: SparkSession, path: str, documents: DataFrame, analyzers=ANALYZERS,
                 removed: DataFrame | None = None) -> Index:
    """Add documents to the index at a path, or change those of their language and id.

    Equal to an index of all documents built anew. Tables for patterns and pairs of words
    (:mod:`lookups`) are to be written again where they are used.
    """
    staged = stage_update(spark, path, documents, analyzers, removed)
    apply_update(path, staged)
    return _opened(spark, path, analyzers)
