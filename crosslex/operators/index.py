"""Term index of documents as four tables.

``docs``         lang, bucket, id, dup_no, copies, title, text
``postings``     lang, field, term_bucket, term, id, dup_no, copies, tf, dl, first, positions
``term_stats``   lang, field, term_bucket, term, df, ttf
``field_stats``  lang, field, n_docs, sum_dl, avgdl

A document that the corpus holds several times is stored once with its number of
``copies``; every statistic and every ranked list counts it that often. ``dup_no``
tells documents apart that share an id but not their content.

The buckets are partition columns. A join with a small table of query terms or hit
ids therefore prunes the scan to the few folders it needs.
"""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crosslex.functions.analysis import ANALYZERS, analyze_words, analyzer_number, finishers
from crosslex.operators.links import number
from crosslex.sources import workspace

FIELDS = ("title", "text")


@dataclass(frozen=True)
class Index:
    """The tables of an index, how they are bucketed and how text was analyzed."""

    docs: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    buckets: int
    analyzers: dict
    #: Tables from patterns, misspelt words and pairs of words to terms, where they were built.
    lookups: "Lookups | None" = None
    #: Tables of :mod:`crosslex.operators.by_document`, where they were built.
    weights: DataFrame | None = None
    bounds: DataFrame | None = None
    blocks: int = 0


@dataclass(frozen=True)
class Lookups:
    """Tables of :mod:`crosslex.operators.lookups`, in as many buckets as the index."""

    grams: DataFrame
    neighbours: DataFrame
    frequent: DataFrame
    pairs: DataFrame
    pair_stats: DataFrame


def bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def collapse_copies(documents: DataFrame) -> DataFrame:
    """Documents once each, with ``copies`` and ``dup_no``; nulls become empty.

    Texts move once, to the others of their id: there copies are counted, by a digest of
    the content, and the different versions of an id numbered.
    """
    copies = F.col("copies") if "copies" in documents.columns else F.lit(1)
    once = documents.select(
        "lang", "id", F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("text", F.lit("")).alias("text"), copies.cast("long").alias("copies"),
    ).withColumn("digest", F.sha2(F.concat_ws("\0", "title", "text").cast("binary"), 256)).repartition(
        "lang", "id").groupBy("lang", "id", "digest").agg(
        F.first("title").alias("title"), F.first("text").alias("text"),
        F.sum("copies").alias("copies")).select("lang", "id", "title", "text", "copies")
    versions = Window.partitionBy("lang", "id").orderBy("title", "text")
    return once.withColumn("dup_no", (F.row_number().over(versions) - 1).cast("int"))


def unique_documents(documents: DataFrame) -> DataFrame:
    """The same for documents known to have one row per id: no shuffle."""
    copies = F.col("copies") if "copies" in documents.columns else F.lit(1)
    return documents.select(
        "lang", "id", F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("text", F.lit("")).alias("text"),
        copies.cast("long").alias("copies"), F.lit(0).alias("dup_no"),
    )


def document_words(docs: DataFrame, analyzers=ANALYZERS) -> DataFrame:
    """Words of every document and field, as one array per row, with the analyzer's number."""
    fields = F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(name).alias("value")) for name in FIELDS
    ])
    return docs.select("lang", "id", "dup_no", "copies", F.inline(fields)).select(
        "lang", "field", "id", "dup_no", "copies",
        analyze_words(F.col("value"), F.col("lang"), analyzers).alias("words"),
        analyzer_number(F.col("lang"), analyzers).alias("analyzer"),
    )


def build_postings(docs: DataFrame, analyzers=ANALYZERS) -> DataFrame:
    """One row per document, field and term, with frequency and positions.

    Stop words are left out and words stemmed where the terms are grouped: there each word of
    some documents is looked at once, however often they have it.
    """
    sliced, numbered = _slicer("words", SLICE_TOKENS), _numberer(finishers(analyzers), STEMS)

    def tokens(batches):
        numbers = numbered()
        for part, lengths in sliced(batches):
            yield part, *numbers(part, lengths)

    return _grouped(document_words(docs, analyzers), tokens)


#: Tokens that are grouped at a time, unless one document alone has more.
SLICE_TOKENS = 1 << 20
#: Words whose stems a task remembers.
STEMS = 1 << 17

# What follows is sent to tasks and so holds all that it needs: workers need not have the package.


def group_terms(rows: DataFrame) -> DataFrame:
    """Postings of rows with their ``tokens``, by position or sorted, and the length ``dl`` of
    the field."""
    sliced = _slicer("tokens", SLICE_TOKENS)

    def tokens(batches):
        import numpy as np
        import pyarrow.compute as pc

        for part, lengths in sliced(batches):
            given = part["tokens"].flatten()
            coded = pc.struct_field(given, "term").dictionary_encode()
            yield (part, coded.dictionary, np.repeat(np.arange(part.num_rows), lengths),
                   coded.indices.to_numpy(), pc.struct_field(given, "pos"), part["dl"])

    return _grouped(rows, tokens)


def _grouped(rows: DataFrame, tokens: Callable) -> DataFrame:
    """Postings of rows, of which ``tokens`` gives some at a time: the rows, the distinct terms,
    of every token its row, term and position, and the length of the field.

    A document is one row, so its terms are grouped where the row lies and nothing is
    shuffled: the tokens of some documents at a time are Arrow columns, sorted by
    document and term and cut where either changes.
    """
    columns = {"lang": "string", "field": "string", "term": "string", "id": rows.schema["id"].dataType.simpleString(),
               "dup_no": "int", "copies": "long", "tf": "int", "dl": "int", "first": "boolean",
               "positions": "array<int>"}
    kept = ["lang", "field", "id", "dup_no", "copies"]

    def grouped(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for part, terms, row, number, pos, dl in tokens(batches):
            if not len(row):
                continue
            by_term = pc.sort_indices(terms).to_numpy()
            rank = np.empty(len(by_term), np.int64)
            rank[by_term] = np.arange(len(by_term))
            key = row * len(by_term) + rank[number]
            order = np.argsort(key, kind="stable")
            key = key[order]
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            offsets = np.append(starts, len(key)).astype(np.int32)
            row, term = np.divmod(key[starts], len(by_term))
            at = pa.array(row)
            own = {name: part[name].take(at) for name in kept}
            own |= {
                "term": terms.take(pa.array(by_term[term])),
                "tf": pa.array(np.diff(offsets)),
                "dl": dl.take(at),
                "first": pa.array(np.diff(row, prepend=-1) > 0),
                "positions": pa.ListArray.from_arrays(offsets, pos.take(pa.array(order))),
            }
            yield pa.RecordBatch.from_pydict({name: own[name] for name in columns})

    return rows.mapInArrow(grouped, ", ".join(f"{name} {kind}" for name, kind in columns.items()))


def _slicer(column: str, most: int) -> Callable[[Iterable], Iterator[tuple]]:
    """Cuts batches into rows that have up to ``most`` tokens in a column of arrays, or into
    single rows, with the number of tokens of each."""
    def sliced(batches):
        import numpy as np
        import pyarrow.compute as pc

        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch[column]), 0).to_numpy(
                zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(int(np.searchsorted(ends, before + most, side="right")), start + 1)
                yield batch.slice(start, stop - start), np.diff(ends[start:stop], prepend=before)
                start = stop

    return sliced


def _numberer(finish: list[tuple], remembered: int) -> Callable[[], Callable]:
    """Makes, for a task, what gives the distinct terms of the ``words`` of some rows, and of every
    word that is no stop word its row, term and position, and the number of such words in a row."""
    plain = all(not stop and stem is None for stop, stem in finish)

    def made():
        from functools import lru_cache

        import numpy as np
        import pyarrow as pa

        of_analyzer = [(stop, stem and lru_cache(remembered)(stem)) for stop, stem in finish]

        def numbers(part, lengths):
            coded = part["words"].flatten().dictionary_encode()
            terms, number = coded.dictionary, coded.indices.to_numpy()
            row = np.repeat(np.arange(len(lengths)), lengths)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            if not plain:
                word, found = number, {}
                number, analyzer = np.empty(len(word), np.int64), part["analyzer"].to_numpy()[row]
                for one in np.unique(analyzer):
                    stop, stem = of_analyzer[one]
                    here = analyzer == one
                    used = np.unique(word[here])
                    term_of = np.full(len(terms), -1)
                    for w, text in zip(used.tolist(), terms.take(pa.array(used)).to_pylist()):
                        if text not in stop:
                            term_of[w] = found.setdefault(stem(text) if stem else text, len(found))
                    number[here] = term_of[word[here]]
                kept = number >= 0
                row, pos, number, terms = row[kept], pos[kept], number[kept], pa.array(list(found), pa.string())
                lengths = np.bincount(row, minlength=len(lengths))
            return terms, row, number, pa.array(pos.astype(np.int32)), pa.array(lengths.astype(np.int32))

        return numbers

    return made


def doc_freq(postings: DataFrame) -> DataFrame:
    """Documents and occurrences per term."""
    return postings.groupBy("lang", "field", "term").agg(
        F.sum("copies").alias("df"), F.sum(F.col("copies") * F.col("tf")).alias("ttf"))


def doc_lengths(postings: DataFrame) -> DataFrame:
    """Number of terms per document and field: kept on every posting, read off one."""
    return postings.where("first").select("lang", "field", "id", "dup_no", "copies", "dl")


def field_stats(postings: DataFrame) -> DataFrame:
    """Documents that have the field, and its mean length."""
    totals = doc_lengths(postings).groupBy("lang", "field").agg(
        F.sum("copies").alias("n_docs"), F.sum(F.col("copies") * F.col("dl")).alias("sum_dl"))
    return totals.withColumn("avgdl", F.col("sum_dl").cast("double") / F.col("n_docs"))


def build_index(documents: DataFrame, analyzers=ANALYZERS, buckets: int = 8,
                unique_ids: bool = False) -> Index:
    """The index as unwritten tables; use :func:`write_index` to keep one."""
    docs = unique_documents(documents) if unique_ids else collapse_copies(documents)
    docs = docs.withColumn("bucket", bucket(F.col("id"), buckets))
    postings = build_postings(docs, analyzers).withColumn(
        "term_bucket", bucket(F.col("term"), buckets))
    return Index(docs, postings, _term_stats(postings, buckets), field_stats(postings),
                 buckets, analyzers)


def _term_stats(postings: DataFrame, buckets: int) -> DataFrame:
    return doc_freq(postings).withColumn("term_bucket", bucket(F.col("term"), buckets))


def write_index(documents: DataFrame, path: str, analyzers=ANALYZERS, buckets: int = 8,
                unique_ids: bool = False) -> Index:
    """Build and write an index; a former one at ``path`` is replaced.

    All tables are rebalanced by their folders: adaptive execution splits a folder
    that a frequent term or language makes large and joins small ones. Sorting by
    term lets file statistics find a term's rows. The statistics are computed from
    the written postings.
    """
    spark = documents.sparkSession
    built = build_index(documents, analyzers, buckets, unique_ids)
    write_folders(built.docs, f"{path}/docs", ["lang", "bucket"], number("id"))

    docs = spark.read.schema(built.docs.schema).parquet(f"{path}/docs")
    postings = build_postings(docs, analyzers).withColumn(
        "term_bucket", bucket(F.col("term"), buckets))
    folders = ["lang", "field", "term_bucket"]
    write_folders(postings, f"{path}/postings", folders, F.col("term"))

    written = spark.read.schema(postings.schema).parquet(f"{path}/postings")
    write_folders(_term_stats(written, buckets), f"{path}/term_stats", folders, F.col("term"))
    field_stats(written).write.mode("overwrite").parquet(f"{path}/field_stats")
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(
        f"{path}/layout")
    return read_index(spark, path, analyzers)


def write_folders(df: DataFrame, path: str, folders: list[str], order: Column,
                  dynamic: bool = False) -> None:
    """Write sorted files into folders, even in size; ``dynamic`` replaces only folders that
    have rows in ``df``.

    Text folders are declared not null: the writer would otherwise replace empty
    values in them, and then sort everything once more.
    """
    for name, kind in df.dtypes:
        if name in folders and kind == "string":
            df = df.withColumn(name, F.coalesce(name, F.lit("")))
    with workspace.freeing(df.sparkSession):
        df.hint("rebalance", *folders).sortWithinPartitions(*folders, order).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static").partitionBy(
            *folders).parquet(path)


DOCS = ("id string, dup_no int, copies long, title string, text string, "
        "lang string, bucket int")
POSTINGS = ("term string, id string, dup_no int, copies long, tf int, dl int, first boolean, "
            "positions array<int>, lang string, field string, term_bucket int")
TERM_STATS = "term string, df long, ttf long, lang string, field string, term_bucket int"
FIELD_STATS = "lang string, field string, n_docs long, sum_dl long, avgdl double"


def read_index(spark: SparkSession, path: str, analyzers=ANALYZERS) -> Index:
    """Open a written index. ``analyzers`` as when it was written."""
    def table(name, schema):
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    buckets = table("layout", "buckets int").first()["buckets"]
    return Index(table("docs", DOCS), table("postings", POSTINGS),
                 table("term_stats", TERM_STATS), table("field_stats", FIELD_STATS),
                 buckets, analyzers)
