"""Structured queries as a table: the clauses of many queries matched and combined at once.

A row of ``asked`` is a clause: ``qid, lang, clause, field, kind, value, occur, boost, grp,
upper, inclusive, slop, edits, expansions``, with the meaning that
:class:`crosslex.operators.clauses.Clause` gives them; ``clause`` numbers the clauses of a
query, ``grp`` is null or the number of its group. Clauses of one kind meet the vocabulary in
one join, all terms found meet the postings in one, and the groups that a document matches
are bits of one number, held against those that its query asks for.
"""

from dataclasses import asdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crosslex.functions.analysis import analyze
from crosslex.operators import clauses, lookups, search
from crosslex.operators.clauses import KINDS, MAX_EDITS, OCCURS, SLOT, Clause
from crosslex.operators.index import Index, bucket
from crosslex.sources import workspace

COLUMNS = {"qid": "long", "lang": "string", "clause": "int", "field": "string", "kind": "string",
           "value": "string", "occur": "string", "boost": "double", "grp": "int",
           "upper": "string", "inclusive": "boolean", "slop": "int", "edits": "int",
           "expansions": "int"}

#: Required groups of a query at most, one bit each. Bit 0 is for excluded clauses.
MOST_REQUIRED = 62
#: Up to this many terms, each with the clause it is for, are broadcast to the postings.
BROADCAST_TERMS = 200_000
#: Longest beginning that prefixes and ranges are joined by.
HEAD = 3

QUERY = ["qid", "lang", "clause"]
DOC = ["id", "dup_no"]
TERM = ["lang", "field", "term_bucket", "term"]
#: What a matching term or phrase adds to a document, and how.
ROLE = ["boost", "bits", "required"]


def clause_table(spark: SparkSession, queries: dict[int, tuple[str, list[Clause]]]) -> DataFrame:
    """``asked`` from a few queries, ``{qid: (lang, clauses)}``, as literals."""
    def row(qid, lang, n, clause):
        values = asdict(clause) | {"qid": qid, "lang": lang, "clause": n, "grp": clause.group}
        return F.struct(*[F.lit(values[c]).cast(t).alias(c) for c, t in COLUMNS.items()])

    rows = [row(qid, lang, n, c) for qid, (lang, given) in queries.items()
            for n, c in enumerate(given)]
    return spark.range(1).select(F.inline(F.array(*rows)))


# --- which queries can be run -----------------------------------------------------------

def check_clauses(asked: DataFrame, langs) -> DataFrame:
    """``asked`` with ``reason``: why a clause cannot be run, null if it can."""
    required = F.size(F.collect_set(F.when(F.col("occur") == "must", _group())).over(
        Window.partitionBy("qid", "lang")))
    reason = (
        F.when(~F.coalesce(F.col("lang").isin(list(langs)), F.lit(False)), "language")
        .when(F.col("qid").isNull() | F.col("clause").isNull() | F.col("field").isNull()
              | F.col("value").isNull(), "incomplete")
        .when(~F.coalesce(F.col("kind").isin(KINDS), F.lit(False)), "kind")
        .when(~F.coalesce(F.col("occur").isin(OCCURS), F.lit(False)), "occur")
        .when((F.col("kind") == "range") & F.col("upper").isNull(), "range without an end")
        .when((F.col("kind") == "wildcard") & F.col("value").rlike("^[?*]"), "leading wildcard")
        .when((F.col("kind") == "fuzzy") & ~F.coalesce("edits", F.lit(MAX_EDITS)).between(
            0, MAX_EDITS), "edits")
        .when(F.col("required_groups") > MOST_REQUIRED, "too many required groups")
    )
    return asked.withColumn("required_groups", required).withColumn("reason", reason).drop(
        "required_groups")


def validate_clauses(asked: DataFrame, langs) -> tuple[DataFrame, DataFrame]:
    """(clauses of the queries that can be run, clauses that keep theirs from it)."""
    checked = check_clauses(asked, langs)
    rejected = checked.where(F.col("reason").isNotNull())
    bad = F.max(F.col("reason").isNotNull()).over(Window.partitionBy("qid", "lang"))
    return checked.withColumn("bad", bad).where(~F.col("bad")).drop("bad", "reason"), rejected


def _group() -> Column:
    """A group's key; a clause without a group is one of its own."""
    return F.struct(F.col("grp").isNull().alias("alone"), F.coalesce("grp", "clause").alias("n"))


def with_bits(asked: DataFrame) -> DataFrame:
    """Clauses with the ``bits`` they give a document and those that their query requires.

    A group is required if one of its clauses is; any of them that is not excluded then
    gives its bit.
    """
    query = Window.partitionBy("qid", "lang")
    excluded = F.col("occur") == "must_not"
    needed = F.max(F.col("occur") == "must").over(
        Window.partitionBy("qid", "lang", _group()))
    # Required groups come first and so have the smallest numbers.
    nth = F.dense_rank().over(query.orderBy((~F.col("needed")).cast("int"), _group()))
    bit = F.expr("shiftleft(cast(1 as bigint), nth)")
    rows = asked.withColumn("needed", needed).withColumn("nth", nth).withColumn(
        "bits", F.when(excluded, F.lit(1)).when(F.col("needed"), bit).otherwise(0).cast("long"))
    required = F.coalesce(F.expr(
        "bit_or(case when occur = 'must' then bits end) over (partition by qid, lang)"), F.lit(0))
    return rows.withColumn("required", required.cast("long")).select(
        *QUERY, "field", "kind", "value", "occur",
        F.coalesce("boost", F.lit(1.0)).alias("boost"), "upper",
        F.coalesce("inclusive", F.lit(True)).alias("inclusive"),
        F.coalesce("slop", F.lit(0)).alias("slop"),
        F.coalesce("edits", F.lit(MAX_EDITS)).alias("edits"), "expansions", "bits", "required")


# --- terms by kind of clause ---------------------------------------------------------------

def _of_kind(asked: DataFrame, *kinds: str) -> DataFrame:
    return asked.where(F.col("kind").isin(*kinds))


def _sent(rows: DataFrame, few: bool) -> DataFrame:
    """Rows of the clauses, broadcast if the text of all clauses is within a bound."""
    return F.broadcast(rows) if few else rows


def _statistics(index: Index) -> DataFrame:
    """One row per language and field."""
    return F.broadcast(index.field_stats.select("lang", "field", "n_docs", "avgdl"))


def _tokens(asked: DataFrame, index: Index, *columns: str) -> DataFrame:
    tokens = analyze(F.col("value"), F.col("lang"), index.analyzers)
    return asked.select(*QUERY, "field", *columns, F.posexplode(tokens).alias("slot", "token")).select(
        *QUERY, "field", *columns, "slot", F.col("token.term").alias("term"),
        F.col("token.pos").alias("pos"),
    ).withColumn("term_bucket", bucket(F.col("term"), index.buckets))


def _scored(rows: DataFrame, weight: Column) -> DataFrame:
    return rows.select(*QUERY, *ROLE, *TERM[1:], weight.alias("weight"))


def word_terms(asked: DataFrame, index: Index) -> DataFrame:
    """Words of ``term`` clauses; one that is repeated counts each time."""
    words = _tokens(_of_kind(asked, "term"), index, *ROLE).groupBy(
        *QUERY, *ROLE, *TERM[1:]).agg(F.count(F.lit(1)).alias("qtf"))
    known = words.join(index.term_stats.select(*TERM, "df"), TERM).join(
        _statistics(index), ["lang", "field"])
    return _scored(known, F.col("qtf") * search.idf(F.col("n_docs"), F.col("df")))


def _common_beginning(a: Column, b: Column) -> Column:
    """What two texts begin with alike, up to :data:`HEAD` characters."""
    out = F.lit("")
    for n in range(1, HEAD + 1):
        out = F.when(F.left(a, F.lit(n)) == F.left(b, F.lit(n)), F.left(a, F.lit(n))).otherwise(out)
    return out


def spelt_terms(asked: DataFrame, index: Index, few: bool) -> DataFrame:
    """Terms of ``prefix``, ``range``, ``wildcard`` and ``regex`` clauses; all score alike.

    Prefixes and ranges meet the terms that begin as they do; patterns those that hold all
    the grams that the pattern needs. Only a clause that fixes neither a beginning nor a gram
    tries every term of its field, as the result may hold them all.
    """
    value, upper = F.lower("value"), F.lower("upper")
    rows = _of_kind(asked, "prefix", "range", "wildcard", "regex").withColumn(
        "value", F.when(F.col("kind") == "regex", F.col("value")).otherwise(value)).withColumn(
        "upper", upper).withColumn("grams", F.when(
            F.col("kind") == "wildcard", lookups.wildcard_grams(F.col("value"))).when(
            F.col("kind") == "regex", lookups.regex_grams(F.col("value"))))
    by_gram = (F.size(F.coalesce("grams", F.array().cast("array<string>"))) > 0) & F.lit(
        index.lookups is not None)
    test = (
        F.when(F.col("kind") == "prefix", F.col("term").startswith(F.col("value")))
        .when(F.col("kind") == "range", F.when(
            F.col("inclusive"), (F.col("term") >= F.col("value")) & (F.col("term") <= F.col("upper")))
            .otherwise((F.col("term") > F.col("value")) & (F.col("term") < F.col("upper"))))
        .when(F.col("kind") == "wildcard", F.expr("term like pattern"))
        .otherwise(F.expr("rlike(term, pattern)"))
    )
    escaped = reduce(lambda c, sign: F.replace(c, F.lit(sign), F.lit("\\" + sign)), "\\%_", F.col("value"))
    like = F.replace(F.replace(escaped, F.lit("?"), F.lit("_")), F.lit("*"), F.lit("%"))
    rows = rows.withColumn("pattern", F.when(F.col("kind") == "wildcard", like).when(
        F.col("kind") == "regex", F.concat(F.lit("^(?:"), "value", F.lit(")$"))))
    keep = [*QUERY, *ROLE, "field", "kind", "value", "upper", "inclusive", "pattern"]

    head = F.when(F.col("kind") == "prefix", F.left("value", F.lit(HEAD))).when(
        F.col("kind") == "range", _common_beginning(F.col("value"), F.col("upper"))).otherwise("")
    beginnings = F.transform(F.sequence(F.lit(0), F.least(F.length("term"), F.lit(HEAD))),
                             lambda n: F.left("term", n))
    heads = index.term_stats.select(*TERM, F.explode(beginnings).alias("head"))
    found = heads.join(_sent(rows.where(~by_gram).select(*keep, head.alias("head")), few),
                       ["lang", "field", "head"]).select(*keep, "term_bucket", "term")
    if index.lookups is not None:
        needed = rows.where(by_gram).select(*keep, F.size("grams").alias("needed"),
                                            F.explode("grams").alias("gram"))
        folders = needed.withColumn("gram_bucket", bucket(F.col("gram"), index.buckets))
        holders = index.lookups.grams.join(
            _sent(folders, few), ["lang", "field", "gram_bucket", "gram"]).groupBy(
            *keep, "needed", "term_bucket", "term").agg(F.count(F.lit(1)).alias("n"))
        found = found.unionByName(holders.where("n = needed").select(*keep, "term_bucket", "term"))
    return _scored(found.where(test), F.lit(None).cast("double"))


def edit_distance(term: Column, word: Column, most: Column) -> Column:
    """Edits between two words, null above ``most`` (at most two); a swap of neighbours is one.

    As :func:`clauses.edit_distance`, for words in columns.
    """
    plain = F.levenshtein(term, word)
    size = F.length(word)

    def swapped(text, i):
        """The text with its signs ``i`` and ``i + 1`` in the other order."""
        return F.concat(F.left(text, i - 1), F.substring(text, i + 1, F.lit(1)),
                        F.substring(text, i, F.lit(1)), F.substring(text, i + 2, F.length(text)))

    def after_swap(i):
        """Least edits if the swap at ``i`` is one of them, what is around it unchanged but
        for one more edit on either side."""
        pair = F.concat(F.substring(word, i + 1, F.lit(1)), F.substring(word, i, F.lit(1)))
        head, tail = F.left(word, i - 1), F.substring(word, i + 2, size)
        before, after = F.concat(head, pair), F.concat(pair, tail)
        rest = F.substring(term, F.length(before) + 1, F.length(term))
        start = F.left(term, F.length(term) - F.length(after))
        again = F.exists(_places(i + 2, size - 1), lambda j: swapped(swapped(word, i), j) == term)
        near = (term.startswith(before) & (F.levenshtein(rest, tail) <= 1)) | (
            term.endswith(after) & (F.levenshtein(start, head) <= 1)) | again
        return F.when(swapped(word, i) == term, 1).when(near, 2)

    best = F.array_min(F.transform(
        F.filter(_places(F.lit(1), size - 1), lambda i: F.substring(word, i, F.lit(1))
                 != F.substring(word, i + 1, F.lit(1))), after_swap))
    edits = F.least(plain, F.when(best.isNotNull(), best))
    return F.when(edits <= most, edits)


def _places(first: Column, last: Column) -> Column:
    """Numbers from first to last, none if there are none."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def near_terms(asked: DataFrame, index: Index, few: bool) -> DataFrame:
    """Near terms of ``fuzzy`` clauses: they score as one term, each by its similarity.

    Terms and words meet in what deletions leave of their beginnings; without that table, in their field.
    """
    rows = _of_kind(asked, "fuzzy").select(
        *QUERY, *ROLE, "field", F.lower("value").alias("word"), "edits", "expansions")
    keys = index.term_stats.select(*TERM, "df")
    if index.lookups is None:
        met = keys.join(_sent(rows, few), ["lang", "field"])
    else:
        parts = rows.withColumn("key", F.explode(lookups.deletions(F.col("word"), F.col("edits")))).withColumn(
            "key_bucket", bucket(F.col("key"), index.buckets))
        candidates = index.lookups.neighbours.join(
            _sent(parts, few), ["lang", "field", "key_bucket", "key"]).select(
            *QUERY, *ROLE, "field", "word", "edits", "expansions", "beginning").distinct()
        met = keys.withColumn("beginning", lookups.beginning(F.col("term"))).join(
            candidates, ["lang", "field", "beginning"])
    close = met.where(F.abs(F.length("term") - F.length("word")) <= F.col("edits")).withColumn(
        "distance", edit_distance(F.col("term"), F.col("word"), F.col("edits")))
    shorter = F.least(F.length("term"), F.length("word"))
    found = close.where(F.col("distance").isNotNull()).withColumn(
        "similar", F.when(F.col("distance") == 0, 1.0).otherwise(1.0 - F.col("distance") / shorter)
    ).where(F.col("similar") > 0)
    of_clause = Window.partitionBy(*QUERY)
    best = found.withColumn("nth", F.row_number().over(of_clause.orderBy(F.desc("similar"), "term")))
    chosen = best.where(F.col("expansions").isNull() | (F.col("nth") <= F.col("expansions")))
    blended = chosen.withColumn("df", F.max("df").over(of_clause)).join(
        _statistics(index), ["lang", "field"])
    return _scored(blended, F.col("similar") * search.idf(F.col("n_docs"), F.col("df")))


def match_terms(terms: DataFrame, index: Index, lossy: bool, small: bool) -> DataFrame:
    """Documents of the clauses that are matched by single terms, with what each adds."""
    weighted = terms.join(_statistics(index), ["lang", "field"]).drop("n_docs")
    postings = index.postings.select(*TERM, *DOC, "copies", "tf", "dl")
    if small:
        hits = postings.join(F.broadcast(weighted), TERM)
    else:
        salted = weighted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(search.SALTS - 1))))
        hits = postings.withColumn("_salt", bucket(F.col("id"), search.SALTS)).join(
            salted, [*TERM, "_salt"])
    part = F.col("weight") * search.tf_norm(F.col("tf"), F.col("dl"), F.col("avgdl"), lossy)
    # A weight that is null: the clause only asks whether there is a term.
    return hits.groupBy(*QUERY, *DOC).agg(
        F.coalesce(F.sum(part), F.lit(1.0)).alias("part"), F.max("copies").alias("copies"),
        *[F.max(c).alias(c) for c in ROLE])


# --- phrases -----------------------------------------------------------------------------------

def phrase_slots(asked: DataFrame, index: Index) -> DataFrame:
    """Phrases as one row each: the units to look up, ``slots`` that name them, weight.

    A unit is a word or, in phrases without slop, a pair of frequent neighbours; words that
    such pairs hold are not looked up alone. Phrases with a word that is in no document are
    left out.
    """
    words = _tokens(_of_kind(asked, "phrase"), index, *ROLE, "slop")
    known = words.join(index.term_stats.select(*TERM, "df"), TERM, "left").join(
        _statistics(index), ["lang", "field"])
    if index.lookups is None:
        known = known.withColumn("often", F.lit(False))
    else:
        # At most a fixed number of words a language and field.
        often = F.broadcast(index.lookups.frequent.withColumn("often", F.lit(True)))
        known = known.join(often, ["lang", "field", "term"], "left").withColumn(
            "often", F.coalesce("often", F.lit(False)))
    word = F.struct("slot", "pos", "term", "df", "often")
    rows = known.groupBy(*QUERY, *ROLE, "field", "slop", "n_docs", "avgdl").agg(
        F.array_sort(F.collect_list(word)).alias("words")).where(
        ~F.exists("words", lambda w: w["df"].isNull()))
    idfs = F.aggregate("words", F.lit(0.0), lambda sum_, w: sum_ + search.idf(F.col("n_docs"), w["df"]))
    words_ = F.col("words")

    def paired(w, other):
        """Whether a word and a neighbour are looked up together."""
        return F.coalesce((F.col("slop") == 0) & w["often"] & other["often"]
                          & (F.abs(w["pos"] - other["pos"]) == 1), F.lit(False))

    def units(w, i):
        following, former = F.get(words_, i + 1), F.get(words_, i - 1)
        pair = F.when(paired(w, following), F.struct(
            F.concat(w["term"], F.lit(" "), following["term"]).alias("unit"), w["pos"].alias("pos")))
        alone = F.when(~paired(w, following) & ~paired(w, former),
                       F.struct(w["term"].alias("unit"), w["pos"].alias("pos")))
        return F.array_compact(F.array(pair, alone))

    found = F.flatten(F.transform("words", units))
    units_ = F.col("units")
    slot = F.transform("units", lambda u, i: F.struct(
        i.alias("slot"),
        # The unit before it that is alike.
        F.coalesce(F.array_max(F.filter(
            F.transform(units_, lambda x, j: F.when((j < i) & (x["unit"] == u["unit"]), j)),
            lambda j: j.isNotNull())), F.lit(-1)).alias("previous"),
        (u["pos"] - F.get(units_, F.lit(0))["pos"]).alias("offset"), u["unit"].alias("unit")))
    return rows.withColumn("units", found).select(
        *QUERY, *ROLE, "field", "slop", "avgdl", idfs.alias("weight"), slot.alias("slots"))


def match_phrases(asked: DataFrame, index: Index, lossy: bool, few: bool) -> DataFrame:
    """Documents that hold the phrases, with what each adds.

    The rarest unit of a phrase names the documents; the others' positions are kept for
    these only before they are brought together.
    """
    phrases = workspace.settle(phrase_slots(asked, index), "phrases")
    units = phrases.select(
        *QUERY, "field", F.explode(F.array_distinct(F.transform("slots", lambda s: s["unit"]))).alias("term")
    ).withColumn("term_bucket", bucket(F.col("term"), index.buckets))

    def looked_up(rows, words, pairs):
        """Rows of the units in a table of terms and one of pairs, each read for its own."""
        if pairs is None:
            return words.join(_sent(rows, few), TERM)
        is_pair = F.col("term").contains(" ")
        return words.join(_sent(rows.where(~is_pair), few), TERM).unionByName(
            pairs.join(_sent(rows.where(is_pair), few), TERM))

    have = index.lookups
    counted = looked_up(units, index.term_stats.select(*TERM, "df"),
                        None if have is None else have.pair_stats.select(*TERM, "df"))
    by_df = Window.partitionBy(*QUERY).orderBy("df", "term")
    ranked = workspace.settle(counted.withColumn("nth", F.row_number().over(by_df)), "units")
    columns = [*TERM, *DOC, "copies", "dl", "positions"]
    places = looked_up(ranked.drop("df"), index.postings.select(*columns),
                       None if have is None else have.pairs.select(*columns))
    first = places.where("nth = 1")
    others = places.where("nth > 1").join(
        looked_up(ranked.where("nth = 1").drop("df", "nth"), index.postings.select(*TERM, *DOC),
                  None if have is None else have.pairs.select(*TERM, *DOC)).select(*QUERY, *DOC),
        [*QUERY, *DOC], "left_semi")
    # As many rows a phrase and document as the phrase has units.
    together = first.unionByName(others).groupBy(*QUERY, *DOC).agg(
        F.collect_list(F.struct("term", "positions")).alias("found"), F.max("dl").alias("dl"),
        F.max("copies").alias("copies"))
    rows = together.join(_sent(phrases, few), QUERY).where(
        F.size("found") == F.size(F.array_distinct(F.transform("slots", lambda s: s["unit"]))))
    at = F.map_from_entries("found")
    slots = F.transform("slots", lambda s: F.struct(
        s["slot"].alias("slot"), s["previous"].alias("previous"), s["offset"].alias("offset"),
        F.element_at(at, s["unit"]).alias("positions")).cast(SLOT))
    shifted = F.transform("placed", lambda s: F.transform(s["positions"], lambda p: p - s["offset"]))
    exact = F.size(F.aggregate(
        "shifted", F.get("shifted", F.lit(0)), F.array_intersect)).cast("double")
    freq = F.when((F.col("slop") == 0) | (F.size("placed") == 1), exact).otherwise(
        clauses.repeated_frequency(F.col("placed"), F.col("slop")))
    part = F.col("weight") * search.tf_norm(F.col("freq"), F.col("dl"), F.col("avgdl"), lossy)
    # Not a filter, which would be pushed below and work the frequency out a second time.
    some = F.explode(F.filter(F.array(freq), lambda x: x > 0))
    return rows.withColumn("placed", slots).withColumn("shifted", shifted).withColumn(
        "freq", some).select(*QUERY, *DOC, part.alias("part"), "copies", *ROLE)


# --- combination -----------------------------------------------------------------------------

def score_clause_batch(index: Index, asked: DataFrame, lossy_norms: bool = True,
                       small: bool | None = None) -> DataFrame:
    """``(qid, lang, id, dup_no, copies, score)`` of the documents that match their query.

    Every required group must match, no excluded clause may, and without a required group
    some optional clause must; scores of all matching clauses add up. A query with a clause
    that cannot be run has no result (:func:`validate_clauses` names it), one with excluded
    clauses only none either; an empty table has none.

    A clause, not a query, is the unit of all joins, so the number of jobs does not depend on
    how many queries there are. Terms that clauses lead to are written and counted; up to a
    bound they are broadcast to the postings, beyond it both are shuffled and the terms
    spread over many tasks.
    """
    valid, _ = validate_clauses(asked, list(index.analyzers))
    rows = workspace.settle(with_bits(valid), "clauses")
    size = rows.agg(F.sum(F.length("value") + 1)).first()[0]
    few = (size or 0) <= search.BROADCAST_CHARS
    terms = workspace.settle(
        word_terms(rows, index).unionByName(spelt_terms(rows, index, few)).unionByName(
            near_terms(rows, index, few)), "terms")
    if small is None:
        small = terms.count() <= BROADCAST_TERMS
    parts = match_terms(terms, index, lossy_norms, small).unionByName(
        match_phrases(rows, index, lossy_norms, few))
    excluded = F.col("bits").bitwiseAND(1) != 0
    found = parts.groupBy("qid", "lang", *DOC).agg(
        F.round(F.sum(F.when(~excluded, F.col("part") * F.col("boost"))), 6).alias("score"),
        F.max("copies").alias("copies"), F.bit_or("bits").alias("bits"),
        F.max("required").alias("required"))
    return found.where(
        (F.col("bits").bitwiseAND(1) == 0) & F.col("score").isNotNull()
        & (F.col("bits").bitwiseAND(F.col("required")) == F.col("required"))
    ).select("qid", "lang", *DOC, "copies", "score")


def search_clause_batch(index: Index, asked: DataFrame, k: int = search.TOP,
                        lossy_norms: bool = True) -> DataFrame:
    """The ``k`` best documents of each query."""
    return search.top_k(score_clause_batch(index, asked, lossy_norms), k)
