"""Main text of web pages, without what a site repeats.

The subtrees of every page are digested and counted by host in Spark; those that recur
across many unlike pages of a host are the site's template and are left out when the
pages are read a second time, besides what the markup itself tells to be no article.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslex.llm.common import held, picked, slices, small_batches, text_of
from crosslex.llm.html_parse import parse
from crosslex.sources import workspace

#: A subtree belongs to the template if it is on so many unlike pages of its host, and on
#: this share of them or on so many pages that no share is asked for.
LEAST_PAGES, LEAST_SHARE, MANY_PAGES = 5, 0.3, 20
#: Up to so many subtrees of all hosts are sent to every task; of more each page gets its own.
BROADCAST_TREES = 200_000


def host_of(url: Column) -> Column:
    """Host of an address, in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(
        url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES,
              least_share: float = LEAST_SHARE, many_pages: int = MANY_PAGES,
              url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, tree``: digests of the subtrees of a host's template, one a row.

    A page counts by its text: copies of one page under many addresses are one page, so an
    article that is copied is no template. Only digests are shuffled, once for each host,
    subtree and text.
    """
    small_batches(pages.sparkSession)
    rows = picked(pages, host=host_of(F.col(url_col)), html=text_of(html_col))
    seen = _subtrees(rows).select("host", "tree", F.xxhash64("text").alias("page")).distinct()
    counts = workspace.settle(
        seen.groupBy("host", "tree").agg(F.count(F.lit(1)).alias("pages")).where(
            F.col("tree").isNull() | (F.col("pages") >= least_pages)), "trees")
    whole = counts.where("tree is null").select("host", F.col("pages").alias("all_pages"))
    return counts.where("tree is not null").join(whole, "host").where(
        (F.col("pages") >= many_pages)
        | (F.col("pages") >= least_share * F.col("all_pages"))).select("host", "tree")


def _subtrees(rows: DataFrame) -> DataFrame:
    """``host, tree, text, key`` of ``rows(host, html)``: the page's text beside each digest of
    its subtrees, and once beside null; ``key`` is a hash of the page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            read = [parse(html) for html in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("host"), part.column("key"),
                 pa.array([[None, *page.digests] for page in read], pa.list_(pa.int64())),
                 pa.array([page.text for page in read], pa.string())],
                names=["host", "key", "trees", "text"])

    return rows.withColumn("key", F.xxhash64("html")).mapInArrow(
        run, "host string, key long, trees array<long>, text string").select(
        "host", "key", F.explode("trees").alias("tree"), "text")


def _own_trees(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with ``trees``: those of a page's own subtrees that its host's template has.

    The digests of each page meet the template's by host and digest; what comes back to a
    page, by its hash, is at most as many as it has subtrees.
    """
    own = _subtrees(rows).where("tree IS NOT NULL").select("host", "key", "tree").distinct().join(
        found, ["host", "tree"], "left_semi")
    by_page = own.groupBy("host", "key").agg(F.collect_set("tree").alias("trees"))
    return rows.withColumn("key", F.xxhash64("html")).join(by_page, ["host", "key"], "left").drop("key")


@held
def _by_host(rows: list) -> dict[str, frozenset[int]]:
    found: dict[str, set[int]] = {}
    for host, tree in rows:
        found.setdefault(host, set()).add(tree)
    return {host: frozenset(trees) for host, trees in found.items()}


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", **options) -> DataFrame:
    """``<id>, url, text, n_chars`` for every row.

    A null or empty page, or one of tags only, has an empty text. Pages without an address
    are one host. Repeated rows are each returned.
    """
    found = workspace.settle(templates(pages, url_col=url_col, html_col=html_col, **options), "templates")
    rows = picked(pages, id=id_col, url=url_col, html=text_of(html_col),
                  host=host_of(F.col(url_col)))
    shared = None
    if found.count() <= BROADCAST_TREES:
        shared = pages.sparkSession.sparkContext.broadcast(
            [(r["host"], r["tree"]) for r in found.collect()])
        rows = rows.withColumn("trees", F.lit(None).cast("array<long>"))
    else:
        rows = _own_trees(rows, found)
    rows = rows.select("id", "url", "html", "host", "trees")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _by_host(shared.value) if shared else {}
        for part in slices(batches):
            texts = [
                parse(html, known.get(host, frozenset()) if shared else frozenset(trees or ())).text
                for html, host, trees in zip(
                    part.column("html").to_pylist(), part.column("host").to_pylist(),
                    part.column("trees").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, T.StructType([
        rows.schema["id"], rows.schema["url"], T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType())])).withColumnRenamed("id", id_col)
