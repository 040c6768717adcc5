"""The registered query of each operator, over its whole table, and the SQL where there is one."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crosslex.llm import (
    conversations,
    decontamination,
    embeddings,
    filter_audit,
    html_extract,
    jaccard,
    language_id,
    licenses,
    oracle,
    sharding,
    token_counts,
    token_files,
    unigram,
    url_rules,
)
from crosslex.sources import workspace

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_table(spark, sf_dir, "documents")).drop("detections")


def op3_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.encode(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_ids(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        workspace.new_path(spark, "ids"), end_id=1)
    return token_files.read_ids(spark, files)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(_table(spark, sf_dir, "documents"))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), shards=24)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
        limit=4096)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op9_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op10_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.95)


# The rules given to the URL filter.
LISTED = [url_rules.Listed("block", "net", "/"), url_rules.Listed("allow", "example.net", "/en/"),
          url_rules.Listed("block", "example.com", "/de/"), url_rules.Listed("allow", "org", "/fr/")]


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page; rules are mined from what the list and the labels say about pages."""
    pages = _table(spark, sf_dir, "pages")
    known = url_rules.labelled_urls(pages, _table(spark, sf_dir, "labels"), LISTED)
    return url_rules.judge_urls(pages, LISTED, url_rules.mine(known))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    given = _table(spark, sf_dir, "conversations")
    damaged = conversations.damage(given)
    return conversations.repaired_digests(damaged, conversations.audit(damaged, given))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and labels, all orders of the five filters, by source."""
    masks = filter_audit.failure_masks(_table(spark, sf_dir, "documents"))
    return filter_audit.filter_interactions(
        filter_audit.mask_cells(masks, _table(spark, sf_dir, "labels")))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_decontamination, op2_license_scan, op3_sentencepieces, op4_token_files,
        op5_language_id, op6_shards, op7_token_counts, op8_html_text,
        op9_parity_join, op10_vector_links, op11_url_rules, op12_conversation_repair,
        op13_filter_audit)
}

SQL: dict[str, str] = {
    "op1_decontamination": oracle.CONTAMINATION,
    "op9_parity_join": oracle.SHINGLES,
    "op10_vector_links": oracle.VECTORS,
    "op12_conversation_repair": oracle.CONVERSATIONS,
    "op13_filter_audit": oracle.FILTERS,
}
