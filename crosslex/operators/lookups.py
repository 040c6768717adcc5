"""Tables beside a term index: from patterns, misspelt words and word pairs to terms.

``grams``       lang, field, gram_bucket, gram, term_bucket, term
``neighbours``  lang, field, key_bucket, key, beginning
``frequent``    lang, field, term
``pairs``       as postings, of neighbouring frequent words; the term is both words
``pair_stats``  as term statistics

Each leads to candidates by an equi-join; what the pattern or the distance says is then
tried on these only, so no clause reads the whole vocabulary.
"""

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crosslex.functions.analysis import ANALYZERS, analyze
from crosslex.operators.index import (
    FIELDS, POSTINGS, TERM_STATS, Index, Lookups, bucket, group_terms, write_folders)

GRAM = 3
#: Stand before and behind a term, so that its ends have grams of their own.
BEGIN, END = "\x02\x02", "\x03\x03"
#: Stands for any text between two literal runs of a pattern.
ANY = "\x01"

#: Letters of a term that deletions are made in. Words that are near have beginnings that
#: are near, so this bounds the neighbourhood of a long word and loses none.
NEAR_PREFIX = 7

#: A word is frequent if it is in one of so many documents, and of the most frequent ones.
FREQUENT_SHARE = 8
MOST_FREQUENT = 64


# --- grams of terms, necessary grams of patterns --------------------------------------

def grams(text: Column) -> Column:
    """Distinct runs of three characters; none of a shorter text."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (GRAM - 1), F.lit(1)))
    cut = F.transform(starts, lambda i: F.substring(text, i, GRAM))
    return F.array_distinct(F.filter(cut, lambda gram: F.length(gram) == GRAM))


def bounded(text: Column) -> Column:
    return F.concat(F.lit(BEGIN), text, F.lit(END))


def _grams_of_runs(pattern: Column) -> Column:
    """Grams of the literal runs of a bounded pattern."""
    return F.array_distinct(F.flatten(F.transform(F.split(pattern, ANY), grams)))


def wildcard_grams(value: Column) -> Column:
    """Grams that a term needs to match ``?`` and ``*``."""
    return _grams_of_runs(bounded(F.regexp_replace(value, "[?*]+", ANY)))


# What is cut out of a regular expression until only literals that any match holds are left:
# escaped signs and classes, sets, groups (innermost first), signs that may be absent, signs
# after which others may follow, and what stands for any sign or none.
_ESCAPED = r"(?s)\\[pP](?:\{[^}]*\}|.)|\\."
_SET = r"\[\^?\]?[^\[\]]*\]"
_GROUP = r"\([^()]*\)"
_OPTIONAL = r"(?s).(?:[?*]|\{[^}]*\})[+?]?"
_MORE = r"\+[+?]?|[.^$]"
#: Flags and named groups, and escapes that are more than one sign or stand for text.
_UNREAD = r"(?s)\(\?|\\[^dDwWsSpPbB\[\](){}|*+?^$./-]"
_DEPTH = 6


def regex_grams(value: Column) -> Column:
    """Grams that a term needs to match a regular expression as a whole; null if it has
    parts that are not read here. Fewer grams than needed are found, never others."""
    def cut(text, pattern, times=1):
        return reduce(lambda t, _: F.regexp_replace(t, pattern, ANY), range(times), text)

    rest = cut(cut(cut(value, _ESCAPED), _SET, 3), _GROUP, _DEPTH)
    literal = cut(cut(rest, _OPTIONAL), _MORE)
    unread = value.rlike(_UNREAD) | rest.rlike(r"[\[\]()]")
    # Alternatives outside a group: no part is needed.
    return F.when(unread, None).when(rest.contains("|"), F.array().cast("array<string>")).otherwise(
        _grams_of_runs(bounded(literal)))


def gram_table(term_stats: DataFrame, buckets: int) -> DataFrame:
    return term_stats.select(
        "lang", "field", "term_bucket", "term",
        F.explode(grams(bounded(F.col("term")))).alias("gram"),
    ).withColumn("gram_bucket", bucket(F.col("gram"), buckets))


# --- neighbourhoods by deletion ----------------------------------------------------------

def deletions(text: Column, most: Column | int) -> Column:
    """What is left of a text's beginning after up to ``most`` (at most two) deletions."""
    def without_one(t: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(t))
        return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(
            F.transform(places, lambda i: F.concat(F.left(t, i - 1), F.substring(t, i + 1, F.lit(NEAR_PREFIX)))))

    most = F.lit(most) if isinstance(most, int) else most
    begin = beginning(text)
    none = F.array().cast("array<string>")
    once = F.when(most >= 1, F.array_distinct(without_one(begin))).otherwise(none)
    twice = F.when(most >= 2, F.flatten(F.transform(once, without_one))).otherwise(none)
    return F.array_distinct(F.concat(F.array(begin), once, twice))


def beginning(term: Column) -> Column:
    """What of a term the keys of its neighbourhood are made of."""
    return F.left(term, F.lit(NEAR_PREFIX))


def neighbour_table(term_stats: DataFrame, buckets: int, most: int = 2) -> DataFrame:
    """Keys of the beginnings that terms have: many terms begin alike, and more terms bring
    ever fewer new beginnings."""
    return term_stats.select("lang", "field", beginning(F.col("term")).alias("beginning")).distinct().select(
        "lang", "field", "beginning", F.explode(deletions(F.col("beginning"), most)).alias("key"),
    ).withColumn("key_bucket", bucket(F.col("key"), buckets))


# --- pairs of frequent words ----------------------------------------------------------------

def frequent_terms(index: Index, share: int = FREQUENT_SHARE, most: int = MOST_FREQUENT) -> DataFrame:
    """``lang, field, term``: at most ``most`` rows a language and field."""
    by_df = Window.partitionBy("lang", "field").orderBy(F.desc("df"), "term")
    n_docs = F.broadcast(index.field_stats.select("lang", "field", "n_docs"))
    return index.term_stats.join(n_docs, ["lang", "field"]).where(
        F.col("df") * share >= F.col("n_docs")).withColumn(
        "rank", F.row_number().over(by_df)).where(F.col("rank") <= most).select(
        "lang", "field", "term")


def pair_postings(docs: DataFrame, frequent: DataFrame, analyzers=ANALYZERS) -> DataFrame:
    """Postings of neighbouring frequent words, as :func:`index.build_postings` has them.

    The frequent words of a language and field are few and become literals; nothing is moved.
    """
    fields = F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(name).alias("value")) for name in FIELDS])
    tokens = analyze(F.col("value"), F.col("lang"), analyzers)
    rows = docs.select("lang", "id", "dup_no", "copies", F.inline(fields)).select(
        "lang", "field", "id", "dup_no", "copies", tokens.alias("all"))
    # As literals, in which a word is looked up by its hash.
    lists = frequent.groupBy("lang", "field").agg(F.sort_array(F.collect_set("term")).alias("terms"))

    def frequent_of(terms):
        return F.filter("all", lambda t: t["term"].isin(terms))

    kept = F.filter("all", lambda t: F.lit(False))
    for row in lists.collect():
        here = (F.col("lang") == row["lang"]) & (F.col("field") == row["field"])
        kept = F.when(here, frequent_of(row["terms"])).otherwise(kept)

    def pair(token, i):
        following = F.get(F.col("kept"), i + 1)
        return F.when(following["pos"] == token["pos"] + 1, F.struct(
            F.concat(token["term"], F.lit(" "), following["term"]).alias("term"), token["pos"].alias("pos")))

    pairs = F.array_compact(F.transform(F.col("kept"), pair))
    return group_terms(rows.withColumn("kept", kept).select(
        "lang", "field", "id", "dup_no", "copies", F.size("all").alias("dl"), pairs.alias("tokens")))


# --- written tables ---------------------------------------------------------------------------

GRAMS = "gram string, term_bucket int, term string, lang string, field string, gram_bucket int"
NEIGHBOURS = "key string, beginning string, lang string, field string, key_bucket int"
FREQUENT = "lang string, field string, term string"


def write_lookups(index: Index, path: str) -> Index:
    """Write the tables for an index and return it with them. Former ones are replaced."""
    spark = index.postings.sparkSession
    for name, table in (("gram", gram_table), ("key", neighbour_table)):
        made = table(index.term_stats, index.buckets)
        write_folders(made, f"{path}/{name}s", ["lang", "field", f"{name}_bucket"], F.col(name))
    frequent_terms(index).write.mode("overwrite").parquet(f"{path}/frequent")
    frequent = spark.read.schema(FREQUENT).parquet(f"{path}/frequent")
    postings = pair_postings(index.docs, frequent, index.analyzers).withColumn(
        "term_bucket", bucket(F.col("term"), index.buckets))
    folders = ["lang", "field", "term_bucket"]
    write_folders(postings, f"{path}/pairs", folders, F.col("term"))
    pairs = spark.read.schema(POSTINGS).parquet(f"{path}/pairs")
    stats = pairs.groupBy(*folders, "term").agg(
        F.sum("copies").alias("df"), F.sum(F.col("copies") * F.col("tf")).alias("ttf"))
    write_folders(stats, f"{path}/pair_stats", folders, F.col("term"))
    return read_lookups(spark, index, path)


def read_lookups(spark: SparkSession, index: Index, path: str) -> Index:
    """The index with the tables that were written for it."""
    def table(name, schema):
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    return replace(index, lookups=Lookups(
        table("grams", GRAMS), table("keys", NEIGHBOURS), table("frequent", FREQUENT),
        table("pairs", POSTINGS), table("pair_stats", TERM_STATS)))
