"""The stages from link tables to search results, each from files to files.

A stage reads what the stage before wrote, so any of them can run again alone.
``langs`` starts with the pivot language; any number of others may follow.
"""

from pyspark.sql import DataFrame, SparkSession

from crosslex.functions.analysis import ANALYZERS
from crosslex.operators import corpus, index, links, results
from crosslex.sources import tables, workspace

#: The languages of the original corpus, pivot first.
LANGS = ["sk", "cs", "hu"]


def find_pairs(spark: SparkSession, langlinks, pages: dict, path: str, langs=LANGS,
               namespaces=None) -> None:
    """Link and page tables to id pairs of all target languages.

    ``langlinks`` and the values of ``pages`` are JDBC options, table names or paths.
    """
    targets = list(langs[1:])
    wanted = tables.read_langlinks(spark, langlinks)
    wanted = wanted.where(wanted["ll_lang"].isin(targets))
    found = workspace.settle(
        links.resolve_links(wanted, tables.read_pages(spark, pages), namespaces), "pairs")
    tables.write_pairs(found, path, langs[0], targets)


def join_pairs(spark: SparkSession, pairs: str, path: str, langs=LANGS) -> None:
    """Pairs to translation tuples."""
    found = tables.read_pairs(spark, pairs)
    tables.write_triples(links.pivot_join(found, langs[0], langs[1:]), path)


def create_documents(spark: SparkSession, articles: dict, triples: str, path: str,
                     langs=LANGS) -> dict:
    """Articles of the complete tuples, as JSON Lines; returns how many per language.

    The articles are landed as Parquet first: their ids are read once per language
    and their texts once, and JSON would be parsed in full each time.
    """
    corpora = workspace.settle(tables.read_articles(spark, articles), "articles", "lang")
    tuples = tables.read_triples(spark, triples, langs)
    # Read once for every language: settled, so that the tuples are filtered once.
    complete = workspace.settle(corpus.complete_triples(tuples, corpora, langs), "complete")
    return tables.write_documents(
        corpus.extract_documents(corpora, complete, langs), path, langs)


def index_documents(spark: SparkSession, documents: str, path: str, analyzers=ANALYZERS,
                    buckets: int = 8) -> index.Index:
    """Documents of all languages to the term index."""
    return index.write_index(tables.read_documents(spark, documents), path, analyzers, buckets)


def map_ids(spark: SparkSession, triples: str, path: str, langs=LANGS, buckets: int = 8) -> None:
    """Tuples to the id map of every language: a table by bucket, as the index has them, and
    from it JSON Lines to export."""
    found = links.build_id_map(tables.read_triples(spark, triples, langs), langs)
    tables.write_id_table(found, f"{path}/table", buckets)
    written, _ = tables.read_id_table(spark, f"{path}/table")
    tables.write_id_map(written.drop("bucket"), f"{path}/json", langs)


def search(spark: SparkSession, queries: DataFrame, index_path: str, id_map: str,
           langs=LANGS, analyzers=ANALYZERS) -> DataFrame:
    """Hits and translations of ``queries(qid, q)`` with ``lang:at:qtext``.

    Give the rows to ``results.to_lines`` for lines or ``results.write_json`` for JSON.
    """
    opened = index.read_index(spark, index_path, analyzers)
    ids, buckets = tables.read_id_table(spark, f"{id_map}/table")
    return results.cross_search(queries, opened, ids, langs, map_buckets=buckets)
