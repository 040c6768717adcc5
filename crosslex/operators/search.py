"""Field-scoped ranked search: many ``lang:at:qtext`` queries in one job."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crosslex.functions.analysis import analyze
from crosslex.operators.index import Index, bucket
from crosslex.operators.links import number

# Ranking constants, list length, scopes.
K1 = 1.2
B = 0.75
TOP = 10
SCOPES = ["T", "t", "T|t", "T&t", "t|T", "t&T"]

#: Query text up to this many characters in total is small enough to broadcast;
#: it cannot have more terms than characters.
BROADCAST_CHARS = 1_000_000
#: Otherwise each query term is repeated this often, so that the postings of a
#: frequent term are read by as many tasks.
SALTS = 32


# --- query rows --------------------------------------------------------------

def query_parts(q: Column) -> Column:
    """Text between colons; trailing empty parts are dropped."""
    return F.split(F.regexp_replace(q, ":+$", ""), ":")


def check_queries(queries: DataFrame, langs) -> DataFrame:
    """``queries(qid, q)`` with ``reason``: null if valid. Case counts, nothing is trimmed."""
    parts = query_parts(F.col("q"))
    reason = (
        F.when(F.col("q").isNull() | (F.size(parts) < 3), F.lit("syntax"))
        .when(~parts[0].isin(list(langs)), F.lit("language"))
        .when(~parts[1].isin(SCOPES), F.lit("scope"))
        .when(F.trim(parts[2]) == "", F.lit("empty text"))
    )
    return queries.withColumn("reason", reason)


def validate_queries(queries: DataFrame, langs) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    checked = check_queries(queries, langs)
    return (checked.where(F.col("reason").isNull()).drop("reason"),
            checked.where(F.col("reason").isNotNull()))


def decode_queries(queries: DataFrame) -> DataFrame:
    """``(qid, lang, at, qtext)``; what follows a third colon is dropped."""
    parts = query_parts(F.col("q"))
    return queries.select(
        "qid", parts[0].alias("lang"), parts[1].alias("at"), parts[2].alias("qtext"))


def known_lang(lang: Column, langs) -> Column:
    """A language in any case, as its lower-case code; null if unknown."""
    lower = F.lower(lang)
    return F.when(lower.isin(list(langs)), lower)


def normalize_lang(lang: str, langs) -> str:
    """A language argument in any case, as its lower-case code."""
    if lang.lower() not in langs:
        raise ValueError(f"unknown language {lang!r}, known: {list(langs)}")
    return lang.lower()


def query_terms(decoded: DataFrame, index: Index) -> DataFrame:
    """``(qid, lang, both, field, term, term_bucket, qtf)`` of decoded queries.

    A repeated word counts each time. ``both`` asks for a match in either field.
    """
    fields = (
        F.when(F.col("at") == "T", F.array(F.lit("title")))
        .when(F.col("at") == "t", F.array(F.lit("text")))
        .otherwise(F.array(F.lit("title"), F.lit("text")))
    )
    tokens = analyze(F.col("qtext"), F.col("lang"), index.analyzers)
    terms = decoded.select(
        "qid", "lang", F.col("at").contains("&").alias("both"),
        F.explode(F.transform(tokens, lambda t: t["term"])).alias("term"),
        fields.alias("fields"),
    ).groupBy("qid", "lang", "both", "term", "fields").agg(F.count(F.lit(1)).alias("qtf"))
    return terms.select(
        "qid", "lang", "both", F.explode("fields").alias("field"), "term",
        bucket(F.col("term"), index.buckets).alias("term_bucket"), "qtf",
    )


# --- scores ------------------------------------------------------------------

def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def lossy_length(dl: Column) -> Column:
    """Length as a one-byte norm keeps it: exact below 40, then four leading bits."""
    above = (dl - 24).cast("int")
    shift = F.length(F.bin(above.cast("long"))) - 4
    # The shift is data, so it is a power of two here.
    unit = F.pow(F.lit(2.0), shift)
    return F.when(dl < 40, dl.cast("double")).otherwise(24 + F.floor(above / unit) * unit)


def tf_norm(tf: Column, dl: Column, avgdl: Column, lossy_norms: bool = True) -> Column:
    """Weight of a frequency; lengths are those of one-byte norms unless told otherwise."""
    length = lossy_length(dl) if lossy_norms else dl
    return tf / (tf + K1 * (1 - B + B * length / avgdl))


def bm25(tf: Column, dl: Column, avgdl: Column, n_docs: Column, df: Column,
         lossy_norms: bool = True) -> Column:
    return idf(n_docs, df) * tf_norm(tf, dl, avgdl, lossy_norms)


def with_weights(terms: DataFrame, index: Index, small: bool = True) -> DataFrame:
    """Query terms that the index knows, with the weight of the term and the mean length."""
    keys = ["lang", "field", "term_bucket", "term"]
    # One row per indexed language and field.
    stats = F.broadcast(index.field_stats.select("lang", "field", "n_docs", "avgdl"))
    known = index.term_stats.select(*keys, "df").join(
        F.broadcast(terms) if small else terms, keys)
    return known.join(stats, ["lang", "field"]).select(
        *keys, "qid", "both", "avgdl", "df",
        (F.col("qtf") * idf(F.col("n_docs"), F.col("df"))).alias("weight"))


def weighted_terms(queries: DataFrame, index: Index) -> DataFrame:
    """The same for the valid ones of ``queries(qid, q)``."""
    valid, _ = validate_queries(queries, list(index.analyzers))
    return with_weights(query_terms(decode_queries(valid), index), index)


def match_terms(terms: DataFrame, index: Index, small: bool = True) -> DataFrame:
    """Postings of the query terms, with the weight of the term and the mean length.

    ``small`` query terms are broadcast twice: to the term statistics, and with
    these to the postings, whose folders are pruned by the terms' buckets; an index that is
    laid out by document as well is read in that layout, bucket by bucket. Beyond
    that bound both joins shuffle, and every term is spread over ``SALTS`` tasks.
    """
    keys = ["lang", "field", "term_bucket", "term"]
    weighted = with_weights(terms, index, small)
    if small and index.weights is not None:
        return index.weights.drop("block").join(
            F.broadcast(weighted.drop("term_bucket")), ["lang", "field", "term"])
    postings = index.postings.select(*keys, "id", "dup_no", "copies", "tf", "dl")
    if small:
        return postings.join(F.broadcast(weighted), keys)
    salted = weighted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    postings = postings.withColumn("_salt", bucket(F.col("id"), SALTS))
    return postings.join(salted, [*keys, "_salt"]).drop("_salt")


def score_documents(matches: DataFrame, lossy_norms: bool = True) -> DataFrame:
    """``(qid, lang, id, dup_no, copies, score)``: matching documents of each query.

    Scores are rounded before anything is ordered by them, so that the order in
    which floating-point terms are added cannot change a list. The language is part
    of the key: ids of different languages are unlike, and a query number may be given
    for several languages.
    """
    return finish_scores(document_parts(matches, lossy_norms), summed=True)


def document_parts(matches: DataFrame, lossy_norms: bool = True, *also: str) -> DataFrame:
    """Sums of a document's matches, before they are rounded and the scope is held against them."""
    part = F.col("weight") * tf_norm(F.col("tf"), F.col("dl"), F.col("avgdl"), lossy_norms)
    in_title = F.col("field") == "title"
    return matches.select(
        "qid", "lang", "id", "dup_no", *also, "copies", "both", part.alias("part"),
        in_title.alias("in_title"), (~in_title).alias("in_text"),
    ).groupBy("qid", "lang", "id", "dup_no", *also).agg(
        F.sum("part").alias("part"), F.max("copies").alias("copies"), F.max("both").alias("both"),
        F.max("in_title").alias("in_title"), F.max("in_text").alias("in_text"))


def finish_scores(parts: DataFrame, summed: bool = False) -> DataFrame:
    """Scores from the parts of documents; parts of one document are added up."""
    if not summed:
        parts = parts.groupBy("qid", "lang", "id", "dup_no").agg(
            F.sum("part").alias("part"),
            *[F.max(c).alias(c) for c in ("copies", "both", "in_title", "in_text")])
    scored = parts.withColumn("score", F.round("part", 6))
    return scored.where(~F.col("both") | (F.col("in_title") & F.col("in_text"))).select(
        "qid", "lang", "id", "dup_no", "copies", "score")


def top_k(scored: DataFrame, k: int = TOP) -> DataFrame:
    """``hits(qid, rank, score, lang, id, dup_no, copy_no)``: the ``k`` best per query.

    Ties go to the smaller numeric id. A document with copies fills as many ranks.
    The first window prunes before its shuffle; the second sees at most ``k``
    documents per query.
    """
    order = [F.desc("score"), number("id").asc_nulls_last(), F.col("id"), F.col("lang"),
             F.col("dup_no")]
    per_query = Window.partitionBy("qid")
    best = scored.withColumn("rank", F.row_number().over(per_query.orderBy(*order)))
    copies = best.where(F.col("rank") <= k).withColumn(
        "copy_no", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    again = F.row_number().over(per_query.orderBy("rank", "copy_no"))
    return copies.withColumn("rank", again).where(F.col("rank") <= k).select(
        "qid", "rank", "score", "lang", "id", "dup_no", "copy_no")


# --- entry points ------------------------------------------------------------

def is_small(queries: DataFrame, chars: int = BROADCAST_CHARS) -> bool:
    """Whether the query text is within the broadcast bound."""
    size = queries.agg(F.sum(F.length("q") + 1)).first()[0]
    return (size or 0) <= chars


def score_queries(queries: DataFrame, index: Index, lossy_norms: bool = True,
                  small: bool | None = None) -> DataFrame:
    """All matching documents of all valid queries with their scores.

    ``small`` tells whether the query terms may be broadcast; by default the query
    text is measured.
    """
    if small is None:
        small = is_small(queries)
    valid, _ = validate_queries(queries, list(index.analyzers))
    terms = query_terms(decode_queries(valid), index)
    return score_documents(match_terms(terms, index, small), lossy_norms)


def search_batch(queries: DataFrame, index: Index, k: int = TOP, lossy_norms: bool = True,
                 small: bool | None = None) -> DataFrame:
    """Hits of all valid ``queries(qid, q)``."""
    return top_k(score_queries(queries, index, lossy_norms, small), k)


def query_table(spark: SparkSession, rows) -> DataFrame:
    """``queries(qid, q)`` from a few ``(qid, q)`` rows, as literals."""
    literals = F.array(*[
        F.struct(F.lit(qid).alias("qid"), F.lit(q).alias("q")) for qid, q in rows])
    return spark.range(1).select(F.inline(literals))


def one_query(index: Index, q: str) -> DataFrame:
    """A single query as a query table."""
    return query_table(index.postings.sparkSession, [(1, q)])


def search(index: Index, lang: str, at: str, qtext: str, k: int = TOP,
           lossy_norms: bool = True) -> DataFrame:
    """Hits of one query."""
    q = f"{lang}:{at}:{qtext}"
    return search_batch(one_query(index, q), index, k, lossy_norms, len(q) <= BROADCAST_CHARS)


def lookup_ids(index: Index, ids: DataFrame) -> DataFrame:
    """Documents by exact ``ids(lang, id)``, at most one per id.

    The bucket of an id is known, so the join prunes the scan to those folders.
    """
    wanted = ids.select("lang", "id").distinct().withColumn(
        "bucket", bucket(F.col("id"), index.buckets))
    return index.docs.where(F.col("dup_no") == 0).join(wanted, ["lang", "bucket", "id"]).select(
        "lang", "id", "title", "text")


def lookup_id(index: Index, lang: str, doc_id: str) -> DataFrame:
    """The document with an id."""
    in_bucket = F.col("bucket") == bucket(F.lit(doc_id), index.buckets)
    return index.docs.where(
        (F.col("lang") == lang) & in_bucket & (F.col("id") == doc_id) & (F.col("dup_no") == 0)
    ).select("lang", "id", "title", "text")
