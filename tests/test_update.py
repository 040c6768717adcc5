"""An index that documents are added to and changed in, and the layout by document."""

import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crosslex.functions.analysis import PLAIN
from crosslex.operators import by_document, index, search, update
from crosslex.sources import workspace

LANGS = {"sk": PLAIN, "cs": PLAIN, "hu": PLAIN}
SCHEMA = "lang string, id string, title string, text string"


def made(n, lang, text="of the word"):
    return (lang, str(n), f"title {n}", f"{text} w{n % 7} w{n % 11} " + "of " * (n % 5))


FIRST = [made(n, lang) for lang in ("sk", "cs") for n in range(40)] + [made(3, "sk")] * 2
CHANGED = [made(n, "sk", "other words") for n in (1, 2, 3)] + [
    ("sk", "900", "new", "brand new"), ("sk", "5", None, None), ("hu", "1", "first", "of a language"),
    ("sk", "6", "two", "versions"), ("sk", "6", "two", "other versions"), ("sk", "6", "two", "versions")]
REMOVED = [("sk", "7"), ("sk", "8"), ("sk", "nowhere")]


def all_rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def after(first, changed, removed=()):
    gone = {(r[0], r[1]) for r in [*changed, *removed]}
    return [r for r in first if (r[0], r[1]) not in gone] + changed


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns
            for p in Path(path).rglob("*.parquet") if p.is_file()}


def local(spark, name):
    return workspace.new_path(spark, name)


def built(spark, rows, path):
    frame = spark.createDataFrame(rows, SCHEMA)
    return by_document.write_by_document(index.write_index(frame, path, LANGS, buckets=4), path, blocks=8)


TABLES = ["docs", "postings", "term_stats", "field_stats", "weights", "bounds"]


def test_update_is_a_rebuild(spark):
    path = local(spark, "updated")
    built(spark, FIRST, path)
    before = files(path)
    removed = spark.createDataFrame(REMOVED, "lang string, id string")
    changed = spark.createDataFrame(CHANGED, SCHEMA)
    staged = update.stage_update(spark, path, changed, LANGS, removed)
    update.apply_update(path, staged)
    whole = built(spark, after(FIRST, CHANGED, REMOVED), local(spark, "rebuilt"))
    updated = update._opened(spark, path, LANGS)
    for name in TABLES:
        assert all_rows(getattr(updated, name)) == all_rows(getattr(whole, name)), name
    # Folders of the language that did not change keep their files.
    now = files(path)
    kept = [f for f in before if "lang=cs" in f]
    assert kept and all(now[f] == before[f] for f in kept)
    # In the changed language, so do the blocks of documents that did not change.
    blocks = {r[0] for r in spark.createDataFrame(
        [(r[1],) for r in CHANGED + REMOVED if r[0] == "sk"], "id string").select(
        by_document.block_of(F.col("id"), 8)).collect()}
    same = [f for f in before if f.startswith("weights/lang=sk")
            and int(f.split("block=")[1].split(os.sep)[0]) not in blocks]
    assert all(now.get(f) == before[f] for f in same)
    # Applied again, and updated again with the same documents, nothing changes.
    update.apply_update(path, staged)
    again = update.update_index(spark, path, changed, LANGS, removed)
    for name in TABLES:
        assert all_rows(getattr(again, name)) == all_rows(getattr(whole, name)), name


def test_update_without_the_layout_by_document(spark):
    path = local(spark, "plain")
    index.write_index(spark.createDataFrame(FIRST, SCHEMA), path, LANGS, buckets=4)
    updated = update.update_index(spark, path, spark.createDataFrame(CHANGED, SCHEMA), LANGS)
    whole = index.build_index(spark.createDataFrame(after(FIRST, CHANGED), SCHEMA), LANGS, 4)
    for name in TABLES[:4]:
        mine, other = getattr(updated, name), getattr(whole, name)
        assert all_rows(mine.select(*sorted(mine.columns))) == all_rows(
            other.select(*sorted(mine.columns))), name
    nothing = update.update_index(spark, path, spark.createDataFrame([], SCHEMA), LANGS)
    assert all_rows(nothing.postings) == all_rows(updated.postings)


@pytest.fixture(scope="module")
def laid_out(spark):
    rows = [("sk", str(n), f"t{n % 13} of", " ".join(
        ["of"] * (1 + n % 9) + ["the"] * (n % 4) + [f"r{n % 97}"] + ["x"] * (n % 30))) for n in range(600)]
    return built(spark, rows, local(spark, "laid-out"))


def test_scores_need_no_shuffle(spark, laid_out):
    queries = search.query_table(spark, [(1, "sk:T|t:of the r5")])
    scored = search.score_queries(queries, laid_out)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    # Only the query's own words are shuffled, no posting by its document.
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys and not any("dup_no" in key for key in keys)
    plain = index.Index(laid_out.docs, laid_out.postings, laid_out.term_stats, laid_out.field_stats,
                        laid_out.buckets, laid_out.analyzers)
    assert all_rows(scored) == all_rows(search.score_queries(queries, plain))


def test_as_many_tasks_as_blocks(laid_out):
    sums = laid_out.weights.groupBy("id").agg(F.sum("tf"))
    assert sums.rdd.getNumPartitions() == laid_out.blocks == 8


def test_pruned_search_reads_fewer_postings(spark, laid_out):
    queries = search.query_table(spark, [
        (1, "sk:T|t:of the r5"), (2, "sk:t:r7 of"), (3, "sk:T&t:of t3 r3"), (4, "sk:t:unknown"),
        (5, "sk:t:of"), (6, "sk:T|t:r1 r2 r3 the")])
    want = all_rows(search.search_batch(queries, laid_out))
    for enough in (1, 50):
        assert all_rows(by_document.search_pruned(queries, laid_out, enough=enough)) == want
    short = queries.where("qid in (1, 2, 6)")
    terms = search.weighted_terms(short, laid_out)
    bounds = by_document.term_bounds(terms, laid_out)
    least = by_document.kth_scores(search.score_documents(
        by_document.matches_of(by_document.rarest_terms(terms, 20), laid_out)), 2)
    split = by_document.needed_terms(terms, bounds, least)
    assert split.where("NOT needed").count() > 0
    needed = by_document.matches_of(split.where("needed"), laid_out)
    found = by_document.candidates(search.document_parts(needed, True, "block"), split, bounds)
    others = by_document.matches_in(found, split, laid_out, True)
    assert needed.count() + others.count() < by_document.matches_of(terms, laid_out).count() / 2
    # A bound is never below a document's score.
    parts = by_document.matches_of(terms, laid_out).withColumn("part", F.col("weight") * search.tf_norm(
        F.col("tf"), F.col("dl"), F.col("avgdl")))
    assert parts.join(bounds, ["qid", "lang", "field", "term", "block"]).where(
        "part > bound + 1e-9").count() == 0
