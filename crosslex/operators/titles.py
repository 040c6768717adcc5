"""Title dictionary: titles of linked articles side by side, and search over them."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosslex.functions.text import PLAIN_WORD, fold_accents, strip_prefix

#: Dictionary ids per block of a token's list.
BLOCK = 65_536


def running_number(df: DataFrame, order: str, name: str, within: tuple = (),
                   block: int = BLOCK) -> DataFrame:
    """Number rows 1, 2, ... by a numeric, unique column, per group ``within``.

    The order is cut into blocks of key values. Rows are numbered inside their
    block, which holds at most ``block`` of them, and only the block counts are
    summed up in order, so that no task sees all rows.
    """
    keyed = df.withColumn("_block", F.floor(F.col(order) / block))
    counts = keyed.groupBy(*within, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(
        *within, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*within, "_block").orderBy(order))
    return keyed.withColumn("_inside", inside).join(offsets, [*within, "_block"]).withColumn(
        name, F.col("_before") + F.col("_inside")).drop("_block", "_inside", "_before")


def build_dictionary(links: DataFrame, pages: DataFrame, pivot: str, targets) -> DataFrame:
    """``(dict_id, <lang>_title ...)``: pivot pages that link to every target language.

    The titles come straight from the links. One aggregation turns the links of a
    page into a row; of several links to one language the first title counts.
    """
    usable = links.select(
        "ll_from", "ll_lang", strip_prefix(F.col("ll_title")).alias("title")
    ).where((F.col("title") != "") & F.col("ll_lang").isin(list(targets)))
    rows = usable.groupBy("ll_from").agg(*[
        F.min(F.when(F.col("ll_lang") == lang, F.col("title"))).alias(f"{lang}_title")
        for lang in targets
    ]).where(reduce(Column.__and__, [F.col(f"{t}_title").isNotNull() for t in targets]))
    pivot_pages = pages.where(F.col("lang") == pivot).select(
        F.col("page_id").alias("ll_from"),
        F.replace("page_title", F.lit("_"), F.lit(" ")).alias(f"{pivot}_title"))
    numbered = running_number(rows.join(pivot_pages, "ll_from"), "ll_from", "dict_id")
    return numbered.select("dict_id", *[f"{lang}_title" for lang in [pivot, *targets]])


def title_tokens(dictionary: DataFrame, langs) -> DataFrame:
    """``(lang, dict_id, token)``: distinct accent-free words of every title."""
    titles = F.array(*[
        F.struct(F.lit(lang).alias("lang"), F.col(f"{lang}_title").alias("title"))
        for lang in langs
    ])
    return dictionary.select("dict_id", F.inline(titles)).select(
        "lang", "dict_id", F.explode(F.array_distinct(words(F.col("title")))).alias("token"))


def words(text: Column) -> Column:
    return F.regexp_extract_all(fold_accents(text), F.lit(PLAIN_WORD), F.lit(0))


def token_index(dictionary: DataFrame, langs, block: int = BLOCK) -> DataFrame:
    """``(lang, token, block, ids)``: dictionary ids per token, ascending.

    The list of a frequent token is kept in blocks of at most ``block`` ids.
    """
    return title_tokens(dictionary, langs).groupBy(
        "lang", "token", F.floor(F.col("dict_id") / block).alias("block")
    ).agg(F.array_sort(F.collect_set("dict_id")).alias("ids"))


def search_titles(queries: DataFrame, index: DataFrame) -> DataFrame:
    """``(qid, lang, dict_id, matched)`` for ``queries(qid, q)`` with ``lang:qtext``.

    Any word may match; ``matched`` counts the different words that do.
    """
    parts = F.split(F.col("q"), ":", 2)
    asked = queries.select(
        "qid", parts[0].alias("lang"),
        F.explode(F.array_distinct(words(F.get(parts, 1)))).alias("token"))
    return index.join(asked, ["lang", "token"]).select(
        "qid", "lang", F.explode("ids").alias("dict_id")
    ).groupBy("qid", "lang", "dict_id").agg(F.count(F.lit(1)).alias("matched"))


def rank_titles(hits: DataFrame) -> DataFrame:
    """Hits with ``n``: more matched words first, then the smaller id.

    Numbered without a single task per query: first within each number of matched
    words, then shifted by the size of the groups before.
    """
    groups = hits.groupBy("qid", "matched").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("qid").orderBy(F.desc("matched")).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = groups.select(
        "qid", "matched", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    inside = running_number(hits, "dict_id", "_n", within=("qid", "matched"))
    return inside.join(offsets, ["qid", "matched"]).withColumn(
        "n", F.col("_shift") + F.col("_n")).drop("_shift", "_n")


def to_lines(ranked: DataFrame, dictionary: DataFrame, langs) -> DataFrame:
    """``(qid, n, line)``: ``n. title (lang) = title (lang) = ...``, asked language first."""
    def titled(lang):
        return F.struct((F.lit(lang) != F.col("lang")).alias("other"),
                        F.format_string("%s (%s)", F.col(f"{lang}_title"), F.lit(lang)).alias("t"))

    titles = F.array(*[titled(lang) for lang in langs])
    ordered = F.concat(F.filter(titles, lambda x: ~x["other"]), F.filter(titles, lambda x: x["other"]))
    text = F.array_join(F.transform(ordered, lambda x: x["t"]), " = ")
    return ranked.join(dictionary, "dict_id").select(
        "qid", "n", F.concat(F.col("n").cast("string"), F.lit(". "), text).alias("line"))
