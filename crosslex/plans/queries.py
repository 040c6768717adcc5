"""One query per operator, each over the tables of a data folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosslex.functions import stopwords, text
from crosslex.functions.analysis import remove_stopwords
from crosslex.functions.stemmers import stem
from crosslex.operators import clause_batch as batch
from crosslex.operators import by_document, clauses, corpus, index, links, results, search, titles
from crosslex.operators.clauses import Clause
from crosslex.plans.derived import (
    ALL_LANGS, BUCKETS, LANGS, PIVOT, PLAIN_ANALYZERS, TARGETS, derived)
from crosslex.sources import tables, workspace

QUERIES = {}

#: The query rows of the searches with translations.
ASKED = [
    (1, "en:T:the that"),
    (2, "en:t:the that"),
    (3, "en:T&t:the that"),
    (4, "de:t|T:der und:extra"),
]


#: Queries of the index with stop words and stems.
ANALYZED = [(1, "en:t:the thenou ale anda"), (2, "de:T|t:der undes az chaknak"),
            (3, "en:T&t:that with a"), (4, "de:t:a az")]

#: One query number given for two languages.
SAME_QID = [(1, "en:T|t:the that"), (1, "de:T|t:der und")]


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(derived(spark, sf_dir))
    QUERIES[function.__name__] = run
    return function


def joined(array):
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")


# --- links -------------------------------------------------------------------

@query
def scan_links_by_lang(d):
    return tables.scan_links_by_lang(d.langlinks, "de")


@query
def normalize_links(d):
    return links.normalize_links(d.langlinks)


@query
def resolve_links(d):
    return d.pairs


@query
def unresolved_links(d):
    return links.unresolved_links(d.langlinks, d.pages)


@query
def pivot_join(d):
    return d.triples


@query
def pivot_join_nway(d):
    return links.pivot_join(d.pairs, PIVOT, [*TARGETS, "es"])


@query
def id_map(d):
    return d.id_map


# --- corpus ------------------------------------------------------------------

@query
def missing_triples(d):
    per_lang = [
        corpus.missing_triples(d.kept_triples, d.corpus, lang).withColumn("lang", F.lit(lang))
        for lang in LANGS
    ]
    return per_lang[0].unionByName(per_lang[1]).unionByName(per_lang[2])


def twice(df):
    return df.unionAll(df)


@query
def complete_triples(d):
    return corpus.complete_triples(twice(d.kept_triples), d.corpus, LANGS)


@query
def complete_triples_except(d):
    return corpus.complete_triples_except(twice(d.kept_triples), d.corpus, LANGS)


def kept_complete(d):
    return corpus.complete_triples(d.kept_triples, d.corpus, LANGS)


@query
def extract_documents(d):
    return corpus.extract_documents(d.corpus, kept_complete(d), LANGS)


@query
def corpus_counts(d):
    return corpus.corpus_counts(corpus.extract_documents(d.corpus, kept_complete(d), LANGS))


@query
def extract_articles(d):
    return corpus.extract_articles(d.table("pages"))


#: Signs that mean something in markup, taken out of the texts that are marked up.
BOLD = "'''"
MARKUP_SIGNS = "[]{}|'=<>&*#:;"


def marked_up(d):
    """The whole text of every document as wiki markup: templates, tables, file links and links
    around its lines, nested in one another."""
    lines = F.split(F.translate("text", MARKUP_SIGNS, " " * len(MARKUP_SIGNS)), "\n")

    def marked(line, i):
        return (
            F.when(i % 5 == 0, F.concat(F.expr("repeat('{{x|', 1 + cast(num_id % 8 as int))"), "source",
                                        F.expr("repeat('}}', 1 + cast(num_id % 8 as int))"), line))
            .when(i % 5 == 1, F.concat(line, F.lit(
                '{| class="a"\n|-\n| b {{y|{| c |}}} || {| d\n|-\n| {| e |}\n|}\n|}')))
            .when(i % 5 == 2, F.concat(F.lit("[[File:p.png|thumb|see [[q|r]], [[s]] {{t|}}]]"), line))
            .when(i % 5 == 3, F.concat(line, F.lit(" [["), "id", F.lit("|''"), "lang", F.lit("'']]")))
            .otherwise(F.concat(F.lit(BOLD), line, F.lit(f"{BOLD} [["), "lang", F.lit("]]")))
        )

    return d.articles.select("id", "num_id", "lang", "source", "title", F.array_join(
        F.transform(lines, marked), "\n").alias("markup"))


@query
def strip_wiki(d):
    return marked_up(d).select("id", corpus.strip_wiki(F.col("markup")).alias("text"))


@query
def extract_dump(d):
    """Articles from an XML dump that is written from the documents."""
    path = f"{workspace.new_path(d.spark, 'dump')}/pages"
    redirect = F.when(F.col("source") == "src3", F.struct(F.col("title").alias("_title")))
    marked_up(d).select(
        "title", F.when(F.col("source") == "src2", 1).otherwise(0).alias("ns"),
        F.col("num_id").alias("id"), redirect.alias("redirect"),
        F.struct((F.col("num_id") + 1).alias("id"), F.col("markup").alias("text")).alias("revision"),
    ).write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(path)
    return corpus.read_dump(d.spark, path, "en", "https://en.example.org/").select(
        "id", "revid", "url", "text")


# --- files -------------------------------------------------------------------

@query
def csv_roundtrip(d):
    path = workspace.new_path(d.spark, "csv")
    found = workspace.settle(d.pairs, "pairs")
    tables.write_pairs(found, f"{path}/pairs", PIVOT, TARGETS)
    pairs = tables.read_pairs(d.spark, f"{path}/pairs")
    tables.write_triples(links.pivot_join(pairs, PIVOT, TARGETS), f"{path}/triples")
    return tables.read_triples(d.spark, f"{path}/triples", LANGS)


@query
def jsonl_articles(d):
    path = workspace.new_path(d.spark, "articles-json")
    d.articles.select(
        "lang", "source", "id", F.concat(F.lit("r"), "id").alias("revid"),
        F.concat_ws("/", F.lit(""), "lang", "id").alias("url"), "title", "text",
    ).write.partitionBy("lang", "source").json(path)
    return tables.read_articles(d.spark, {lang: f"{path}/lang={lang}" for lang in ALL_LANGS})


@query
def jsonl_documents(d):
    path = workspace.new_path(d.spark, "documents-json")
    tables.write_documents(
        corpus.extract_documents(d.corpus, kept_complete(d), LANGS), path)
    return tables.read_documents(d.spark, path)


@query
def id_map_json(d):
    path = workspace.new_path(d.spark, "id-map")
    tables.write_id_map(d.id_map, path, LANGS)
    return tables.read_id_map(d.spark, path, LANGS)


# --- analysis ----------------------------------------------------------------

@query
def tokenize(d):
    words = text.plain_words(F.col("text"))
    return d.table("documents").select(
        "doc_id", F.size(words).cast("long").alias("n"), F.array_join(words, " ").alias("words"))


@query
def tokenize_standard(d):
    words = text.unicode_words(F.col("text"))
    return d.table("documents").select(
        "doc_id", F.size(words).cast("long").alias("n"), F.array_join(words, " ").alias("words"))


@query
def stopwords_removed(d):
    kept = remove_stopwords(text.plain_words(F.col("text")), F.col("lang"), {
        "en": stopwords.CZECH, "de": stopwords.HUNGARIAN})
    return d.table("documents").select("doc_id", F.array_join(kept, " ").alias("words"))


QUERIES["stopwords"] = QUERIES.pop("stopwords_removed")


def vocabulary(d):
    return d.table("documents").select(
        F.explode(text.plain_words(F.col("text"))).alias("term")).distinct()


@query
def stem_cs(d):
    return vocabulary(d).select("term", stem(F.col("term"), "czech").alias("stem"))


@query
def stem_hu(d):
    return vocabulary(d).select("term", stem(F.col("term"), "hungarian").alias("stem"))


@query
def fold_accents(d):
    return d.articles.select("id", text.fold_accents(F.col("title")).alias("folded"))


# --- index -------------------------------------------------------------------

@query
def postings(d):
    built = index.build_index(d.articles, PLAIN_ANALYZERS, BUCKETS, unique_ids=True)
    return built.postings.select(
        "lang", "field", "term", "id", F.col("tf").cast("long").alias("tf"),
        joined("positions").alias("positions"))


@query
def doc_freq(d):
    return index.doc_freq(d.article_index.postings).select("lang", "field", "term", "df")


@query
def doc_lengths(d):
    return index.doc_lengths(d.article_index.postings).select(
        "lang", "field", "id", F.col("dl").cast("long").alias("dl"))


@query
def field_stats(d):
    return index.field_stats(d.article_index.postings).select(
        "lang", "field", "n_docs", F.round("avgdl", 6).alias("avgdl"))


@query
def index_roundtrip(d):
    return d.document_index.postings.select(
        "lang", "field", "term", "id", "copies", F.col("tf").cast("long").alias("tf"),
        F.col("dl").cast("long").alias("dl"))


@query
def index_update(d):
    """Postings and statistics of an index that documents were added to and changed in."""
    updated, keys = d.updated_index, ["lang", "field", "term"]
    return updated.postings.join(updated.term_stats.select(*keys, "df", "ttf"), keys).join(
        updated.field_stats, ["lang", "field"]).join(
        updated.weights.select(*keys, "id", F.col("tf").alias("weight_tf")), [*keys, "id"]).select(
        *keys, "id", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("long").alias("dl"),
        "df", "ttf", "n_docs", F.col("weight_tf").cast("long").alias("weight_tf"),
        F.round("avgdl", 6).alias("avgdl"))


@query
def index_analyzed(d):
    """Postings by the analyzers with stop words and stems, on two languages."""
    return d.analyzed_index.postings.select(
        "lang", "field", "term", "id", F.col("tf").cast("long").alias("tf"),
        F.col("dl").cast("long").alias("dl"), joined("positions").alias("positions"))


@query
def search_analyzed(d):
    asked = search.query_table(d.spark, ANALYZED)
    found = search.search_batch(asked, d.analyzed_index)
    return found.select(
        F.col("qid").cast("long").alias("qid"), F.col("rank").cast("long").alias("rank"), "lang",
        "id", "score")


@query
def lookup_id(d):
    ids = d.pairs.select("lang", F.col("target_id").alias("id"))
    return search.lookup_ids(d.article_index, ids)


# --- search ------------------------------------------------------------------

@query
def decode_queries(d):
    valid, _ = search.validate_queries(d.asked, LANGS)
    return search.decode_queries(valid)


@query
def validate_queries(d):
    return search.check_queries(d.asked, LANGS).select("qid", "reason")


@query
def known_lang(d):
    return d.asked.select("qid", search.known_lang(
        search.query_parts(F.col("q"))[0], LANGS).alias("lang"))


def hits(df):
    return df.select(F.col("rank").cast("long").alias("rank"), "lang", "id", "score")


@query
def search_title(d):
    return hits(search.search(d.article_index, "en", "T", "the that"))


@query
def search_text(d):
    return hits(search.search(d.article_index, "en", "t", "the that then"))


@query
def search_title_and_text(d):
    return hits(search.search(d.article_index, "en", "T&t", "there with the"))


@query
def search_title_or_text(d):
    return hits(search.search(d.article_index, "de", "t|T", "der und der nicht"))


def scores(df):
    return df.select("qid", "lang", "id", "score")


@query
def bm25_scores(d):
    return scores(search.score_queries(
        search.one_query(d.article_index, "en:T|t:the that"), d.article_index))


@query
def bm25_exact(d):
    return scores(search.score_queries(
        search.one_query(d.article_index, "en:T|t:the that"), d.article_index, lossy_norms=False))


@query
def accent_sensitive(d):
    asked = search.query_table(d.spark, [(1, "fr:t:étion"), (2, "fr:t:etion")])
    return scores(search.score_queries(asked, d.article_index))


@query
def search_batch(d):
    found = search.search_batch(d.passages, d.by_document_index)
    return found.select("qid", F.col("rank").cast("long").alias("rank"), "id", "score")


@query
def search_pruned(d):
    """The hits of short queries, from as few postings as the bounds of blocks allow."""
    found = by_document.search_pruned(d.short_passages, d.by_document_index)
    return found.select("qid", F.col("rank").cast("long").alias("rank"), "id", "score")


@query
def search_batch_large(d):
    """The same as for query texts beyond the broadcast bound."""
    found = search.search_batch(d.passages, d.article_index, small=False)
    return found.select("qid", F.col("rank").cast("long").alias("rank"), "id", "score")


@query
def search_same_qid(d):
    """One query number for two languages whose articles share ids."""
    return hits(search.search_batch(
        search.query_table(d.spark, SAME_QID), d.renumbered_index))


def translated(d):
    asked = search.query_table(d.spark, ASKED)
    return results.cross_search(asked, d.document_index, d.kept_id_map, LANGS)


@query
def cross_search(d):
    return translated(d).select(
        F.col("qid").cast("long").alias("qid"), F.col("rank").cast("long").alias("rank"),
        "score", F.col("pos").cast("long").alias("pos"), "lang", "id", "title")


@query
def expand_translations(d):
    """Every document as a hit, over all articles: whole texts of the translations."""
    every = d.article_index.docs.where(F.col("lang").isin(LANGS)).select(
        F.col("id").cast("long").alias("qid"), F.lit(1).alias("rank"), F.lit(0.0).alias("score"),
        "lang", "id", "dup_no")
    return results.expand_translations(every, d.kept_id_map, d.article_index, LANGS).select(
        "qid", F.col("pos").cast("long").alias("pos"), "lang", "id", "title", "text")


@query
def result_json(d):
    return results.to_json(translated(d)).select(F.col("qid").cast("long").alias("qid"), "json")


@query
def result_lines(d):
    return results.to_lines(translated(d)).select(
        F.col("qid").cast("long").alias("qid"), F.col("rank").cast("long").alias("rank"),
        F.col("pos").cast("long").alias("pos"), "line")


# --- clauses -----------------------------------------------------------------

#: Structured queries by name: language and clauses.
CLAUSES = {
    "bool_must": ("en", [Clause("text", "term", "then", "must"),
                         Clause("text", "term", "that with")]),
    "bool_must_not": ("en", [Clause("text", "term", "then that"),
                             Clause("text", "term", "from", "must_not")]),
    "phrase": ("en", [Clause("text", "phrase", "in the"), Clause("text", "phrase", "of the that")]),
    "phrase_slop": ("en", [Clause("text", "phrase", "the with", slop=3)]),
    "phrase_slop_three": ("en", [Clause("text", "phrase", "the of that", slop=6)]),
    "phrase_slop_repeat": ("en", [Clause("text", "phrase", "the that the", slop=5),
                                  Clause("text", "phrase", "of of", slop=4)]),
    "prefix": ("en", [Clause("text", "prefix", "therb")]),
    "wildcard": ("en", [Clause("text", "wildcard", "th?r*ble")]),
    "fuzzy": ("en", [Clause("text", "fuzzy", "tehre")]),
    "term_range": ("en", [Clause("text", "range", "theaa", upper="thead"),
                          Clause("title", "range", "for", upper="from", inclusive=False)]),
    "term_regex": ("en", [Clause("text", "regex", "(sh|ed)+tion")]),
    "boost": ("en", [Clause("title", "term", "that", boost=2.5),
                     Clause("text", "term", "there", boost=0.5)]),
    "bool_groups": ("en", [Clause("text", "term", "then", "must", group=1),
                           Clause("title", "term", "that", "must", group=1),
                           Clause("text", "term", "with", "must", group=2),
                           Clause("text", "prefix", "ing", "must", group=2),
                           Clause("title", "term", "the", "should")]),
}


def _clause_query(name):
    lang, given = CLAUSES[name]

    def run(spark, sf_dir):
        return clauses.score_clauses(derived(spark, sf_dir).looked_up_index, lang, given).select(
            "lang", "id", "score")
    return run


for _name in CLAUSES:
    QUERIES[_name] = _clause_query(_name)


@query
def clause_batch(d):
    """Structured queries of every benchmark passage, all at once."""
    return scores(batch.score_clause_batch(d.looked_up_index, d.passage_clauses))


# --- title dictionary --------------------------------------------------------

def dictionary(d):
    return titles.build_dictionary(d.langlinks, d.pages, PIVOT, TARGETS)


def ranked_titles(d):
    asked = search.query_table(d.spark, [(1, "en: the that"), (2, "de:Der und"), (3, "fr:ÉTION la")])
    return titles.rank_titles(
        titles.search_titles(asked, titles.token_index(dictionary(d), LANGS)))


@query
def title_dictionary(d):
    return dictionary(d)


@query
def title_token_index(d):
    return titles.token_index(dictionary(d), LANGS).select(
        "lang", "token", "block", joined("ids").alias("ids"))


@query
def title_search(d):
    return ranked_titles(d).select(
        F.col("qid").cast("long").alias("qid"), "n", "dict_id", "matched")


@query
def title_lines(d):
    return titles.to_lines(ranked_titles(d), dictionary(d), LANGS).select(
        F.col("qid").cast("long").alias("qid"), "n", "line")
