"""Structured query clauses: required, excluded, phrase, prefix, fuzzy and the like.

A clause is a condition on one field. Clauses of one group are alternatives; the
groups of a query are combined as required, optional or excluded.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosslex.functions.analysis import analyzer_for
from crosslex.operators import lookups, search
from crosslex.operators.index import Index, bucket

# Kinds of clause, ways to combine groups, most edits of fuzzy clauses.
KINDS = ["term", "phrase", "prefix", "wildcard", "fuzzy", "range", "regex"]
OCCURS = ["must", "should", "must_not"]
MAX_EDITS = 2

DOC = ["lang", "id", "dup_no", "copies"]


@dataclass(frozen=True)
class Clause:
    """One condition.

    ``value`` is words for ``term`` (any may match) and ``phrase`` (in sequence,
    up to ``slop`` moves apart), a pattern for ``prefix``, ``wildcard``
    and ``regex``, a word for ``fuzzy`` (within ``edits``; all near terms, or the
    ``expansions`` nearest if asked for), and the lower end of a ``range`` up to
    ``upper``.
    """

    field: str
    kind: str
    value: str
    occur: str = "should"
    boost: float = 1.0
    group: int | None = None
    upper: str | None = None
    inclusive: bool = True
    slop: int = 0
    edits: int = MAX_EDITS
    expansions: int | None = None

    def __post_init__(self):
        if self.kind not in KINDS or self.occur not in OCCURS:
            raise ValueError(f"unknown clause {self.kind!r} / {self.occur!r}")
        if self.kind == "range" and self.upper is None:
            raise ValueError("a range needs an upper end")
        if self.kind == "wildcard" and self.value[:1] in ("*", "?"):
            raise ValueError("a wildcard may not lead")
        if self.kind == "fuzzy" and not 0 <= self.edits <= MAX_EDITS:
            raise ValueError(f"at most {MAX_EDITS} edits")


# --- which postings a clause is about ----------------------------------------

def _postings(index: Index, lang: str, field: str) -> DataFrame:
    return index.postings.where((F.col("lang") == lang) & (F.col("field") == field))


def _vocabulary(index: Index, lang: str, field: str) -> DataFrame:
    return index.term_stats.where((F.col("lang") == lang) & (F.col("field") == field))


def _stats(index: Index) -> DataFrame:
    """Collection statistics: one row per language and field."""
    return F.broadcast(index.field_stats.select("lang", "field", "n_docs", "avgdl"))


def analyzed(index: Index, lang: str, value: str) -> list[tuple[str, int]]:
    """Terms and positions of a clause's own words."""
    spark = index.postings.sparkSession
    tokens = analyzer_for(lang, index.analyzers).tokens(F.lit(value))
    row = spark.range(1).select(tokens.alias("tokens")).first()
    return [(t["term"], t["pos"]) for t in row["tokens"]]


def _of_terms(index: Index, lang: str, field: str, terms) -> DataFrame:
    """Postings of given terms, or of pairs of terms; folders and row groups are pruned by
    literals."""
    terms = sorted(set(terms))
    folders = [bucket(F.lit(t), index.buckets) for t in terms]
    pairs = [" " in t for t in terms]
    postings = index.lookups.pairs if any(pairs) else index.postings
    return postings.where(
        (F.col("lang") == lang) & (F.col("field") == field)
        & F.col("term_bucket").isin(*folders) & F.col("term").isin(terms))


def _term_weights(index: Index, lang: str, field: str, terms) -> DataFrame:
    """``(term, df, n_docs, avgdl)`` of given terms: at most one row each."""
    terms = sorted(set(terms))
    return _vocabulary(index, lang, field).where(F.col("term").isin(terms)).join(
        _stats(index), ["lang", "field"]).select("term", "df", "n_docs", "avgdl")


def _constant(matches: DataFrame) -> DataFrame:
    return matches.select(*DOC).distinct().withColumn("score", F.lit(1.0))


# --- clause kinds ------------------------------------------------------------

def _match_term(index, lang, c: Clause, lossy: bool) -> DataFrame:
    words = [t for t, _ in analyzed(index, lang, c.value)]
    counts = {t: words.count(t) for t in words}
    if not counts:
        return _nothing(index)
    qtf = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    hits = _of_terms(index, lang, c.field, counts).join(
        F.broadcast(_term_weights(index, lang, c.field, counts)), "term")
    part = F.element_at(qtf, F.col("term")) * search.bm25(
        F.col("tf"), F.col("dl"), F.col("avgdl"), F.col("n_docs"), F.col("df"), lossy)
    return hits.groupBy(*DOC).agg(F.sum(part).alias("score"))


def phrase_positions(index, lang, c: Clause, terms, rarest_first) -> DataFrame:
    """Per document one position array per distinct term, where all terms occur.

    Starts from the documents of the rarest term; the positions of a frequent one are
    then looked up for these only.
    """
    def places(term):
        return _of_terms(index, lang, c.field, [term]).select(
            *DOC, "dl", F.col("positions").alias(f"p{terms.index(term)}"))

    first, *others = rarest_first
    return reduce(lambda docs, term: docs.join(places(term).drop("dl"), DOC), others, places(first))


def phrase_frequency(tokens, terms) -> Column:
    """How often the terms stand in sequence: shifted positions that all share."""
    def shifted_by(term, distance):
        return F.transform(F.col(f"p{terms.index(term)}"), lambda p: p - distance)

    shifted = [shifted_by(t, pos - tokens[0][1]) for t, pos in tokens]
    return F.size(reduce(F.array_intersect, shifted)).cast("double")


def sloppy_frequency(slop: int, offsets=(0, 1)) -> Column:
    """Weighted matches of different words up to ``slop`` moves apart, in any order.

    ``offsets`` are the words' places in the phrase. On the merged positions, shifted as if
    the words were in sequence, a place counts if the next one is another word's and every
    other word still follows. The match reaches to the farthest of their next places, and
    counts 1 / (1 + that distance) if it is at most ``slop``.
    """
    def tagged(which, offset):
        return F.transform(F.col(f"p{which}"), lambda p: F.struct(
            (p - offset).alias("at"), F.lit(which).alias("which")))

    size = len(offsets)
    merged = F.sort_array(F.concat(*[tagged(i, o) for i, o in enumerate(offsets)]), asc=False)
    nothing = F.lit(None).cast("int")
    begin = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("last"),
                     F.array(*[nothing] * size).alias("next"))

    def step(acc, place):
        # Backwards, so that the next places of all words are known.
        others = F.filter(acc["next"], lambda at, i: i != place["which"])
        reach = F.array_max(others) - place["at"]
        counts = ((place["which"] != acc["last"]) & ~F.exists(others, lambda at: at.isNull())
                  & (reach <= slop))
        return F.struct(
            (acc["sum"] + F.when(counts, 1.0 / (1.0 + reach)).otherwise(0.0)).alias("sum"),
            place["which"].alias("last"),
            F.transform(acc["next"], lambda at, i: F.when(
                i == place["which"], place["at"]).otherwise(at)).alias("next"))

    return F.aggregate(merged, begin, step, lambda acc: acc["sum"])


#: A word of a phrase: its number, that of the same word before it (or -1), its place in the
#: phrase, and where the word stands in a document.
SLOT = "struct<slot int, previous int, offset int, positions array<int>>"


def repeated_frequency(slots: Column, slop: Column) -> Column:
    """Weighted matches of words up to ``slop`` moves apart where words may repeat.

    A match gives every slot a place of its word, slots of one word different places in the
    order in which they stand in the phrase. On the places, shifted as if the words were in
    sequence, a match begins at a place of any slot and takes for each other slot the next
    place that is left to it. It reaches to the farthest of them and counts 1 / (1 + that
    distance) if it is at most ``slop`` - unless the slot it begins with has another place
    before those of all the others, from where a match is as short. For different words this
    is :func:`sloppy_frequency`.
    """
    place = "struct<at int, slot int, pos int>"
    none = F.lit(None).cast(place)
    merged = F.sort_array(F.flatten(F.transform(slots, lambda s: F.transform(
        s["positions"], lambda p: F.struct(
            (p - s["offset"]).alias("at"), s["slot"].alias("slot"), p.alias("pos"))))), asc=False)
    # Per slot its next places, as many as there are slots: more others cannot have taken.
    begin = F.struct(F.lit(0.0).alias("sum"), F.transform(
        slots, lambda s: F.array().cast(f"array<{place}>")).alias("next"))

    def taken(next_, start):
        """Places of a match that begins at ``start``, slot by slot; null where there is none."""
        def take(acc, s):
            after = F.when(s["previous"] >= 0, F.get(acc, s["previous"])["pos"]).otherwise(-1)
            free = F.filter(F.get(next_, s["slot"]), lambda p: p["pos"] > after)
            own = F.when(start["pos"] > after, start).otherwise(none)
            return F.array_append(acc, F.when(s["slot"] == start["slot"], own).when(
                after.isNull(), none).otherwise(F.get(free, 0)))

        return F.aggregate(slots, F.array().cast(f"array<{place}>"), take)

    def step(acc, start):
        match = taken(acc["next"], start)
        others = F.filter(match, lambda p: p["slot"] != start["slot"])
        again = F.get(F.get(acc["next"], start["slot"]), 0)
        reach = F.array_max(F.transform(match, lambda p: p["at"])) - start["at"]
        counts = (F.size(others) == F.size(slots) - 1) & ~F.exists(match, lambda p: p.isNull()) & (
            reach <= slop) & F.coalesce(F.array_min(others) < again, F.lit(True))
        return F.struct(
            (acc["sum"] + F.when(counts, 1.0 / (1.0 + reach)).otherwise(0.0)).alias("sum"),
            F.transform(acc["next"], lambda places, i: F.when(
                i == start["slot"], F.slice(F.concat(F.array(start), places), 1, F.size(slots))
            ).otherwise(places)).alias("next"))

    return F.aggregate(merged, begin, step, lambda acc: acc["sum"])


def _slots(tokens, terms) -> Column:
    """The slots of a phrase whose words' positions are in ``p0``, ``p1``, ..."""
    words = [t for t, _ in tokens]
    return F.array(*[
        F.struct(F.lit(i).alias("slot"),
                 F.lit(max((j for j in range(i) if words[j] == t), default=-1)).alias("previous"),
                 F.lit(pos - tokens[0][1]).alias("offset"),
                 F.col(f"p{terms.index(t)}").alias("positions")).cast(SLOT)
        for i, (t, pos) in enumerate(tokens)])


def phrase_units(tokens, frequent) -> list[tuple[str, int]]:
    """What to look up for words in sequence: ``(term, position)``, pairs of frequent
    neighbours as one term and the words that are in no such pair."""
    pairs = [(f"{a} {b}", pos) for (a, pos), (b, following) in zip(tokens, tokens[1:])
             if following == pos + 1 and a in frequent and b in frequent]
    paired = {p for _, pos in pairs for p in (pos, pos + 1)}
    return sorted(pairs + [(t, pos) for t, pos in tokens if pos not in paired], key=lambda u: u[1])


def _units(index, lang, field, tokens) -> list[tuple[str, int]]:
    if index.lookups is None:
        return tokens
    words = [t for t, _ in tokens]
    known = index.lookups.frequent.where(
        (F.col("lang") == lang) & (F.col("field") == field) & F.col("term").isin(words))
    return phrase_units(tokens, {r["term"] for r in known.collect()})


def _match_phrase(index, lang, c: Clause, lossy: bool) -> DataFrame:
    tokens = analyzed(index, lang, c.value)
    terms = sorted({t for t, _ in tokens}, key=[t for t, _ in tokens].index)
    if not terms:
        return _nothing(index)
    looked_up = terms
    if not c.slop:
        units = _units(index, lang, c.field, tokens)
        looked_up = sorted({t for t, _ in units}, key=[t for t, _ in units].index)
        frequency = phrase_frequency(units, looked_up)
    elif len(terms) == 1 and len(tokens) == 1:
        frequency = F.size("p0").cast("double")
    elif len(tokens) == len(terms):
        frequency = sloppy_frequency(c.slop, [pos - tokens[0][1] for _, pos in tokens])
    else:
        frequency = repeated_frequency(_slots(tokens, terms), F.lit(c.slop))
    weights = _term_weights(index, lang, c.field, terms)
    known = {r["term"]: r["df"] for r in weights.select("term", "df").collect()}
    if len(known) < len(terms):
        return _nothing(index)
    counts = F.create_map(*[F.lit(x) for t in terms
                            for x in (t, [w for w, _ in tokens].count(t))])
    # The weight of the phrase is that of all its words together.
    weight = weights.select(F.sum(F.element_at(counts, F.col("term")) * search.idf(
        F.col("n_docs"), F.col("df")))).scalar()
    mean = weights.select(F.max("avgdl")).scalar()
    pairs = [t for t in looked_up if " " in t]
    if pairs:
        stats = index.lookups.pair_stats.where(
            (F.col("lang") == lang) & (F.col("field") == c.field) & F.col("term").isin(pairs))
        known |= {r["term"]: r["df"] for r in stats.select("term", "df").collect()}
    if any(t not in known for t in looked_up):
        return _nothing(index)
    rarest = sorted(looked_up, key=lambda t: (known[t], t))
    docs = phrase_positions(index, lang, c, looked_up, rarest)
    score = weight * search.tf_norm(F.col("freq"), F.col("dl"), mean, lossy)
    return docs.withColumn("freq", frequency).where(F.col("freq") > 0).select(
        *DOC, score.alias("score"))


def _match_prefix(index, lang, c: Clause, lossy: bool) -> DataFrame:
    return _constant(_postings(index, lang, c.field).where(
        F.col("term").startswith(c.value.lower())))


def _match_range(index, lang, c: Clause, lossy: bool) -> DataFrame:
    term = F.col("term")
    if c.inclusive:
        test = (term >= c.value.lower()) & (term <= c.upper.lower())
    else:
        test = (term > c.value.lower()) & (term < c.upper.lower())
    return _constant(_postings(index, lang, c.field).where(test))


def _with_grams(index, lang, field, needed: list[str] | None) -> DataFrame:
    """``(term_bucket, term)`` with all the grams that a pattern needs; the whole vocabulary
    if it needs none or the index has no gram table."""
    if not needed or index.lookups is None:
        return _vocabulary(index, lang, field).select("term_bucket", "term")
    folders = [bucket(F.lit(gram), index.buckets) for gram in needed]
    return index.lookups.grams.where(
        (F.col("lang") == lang) & (F.col("field") == field) & F.col("gram_bucket").isin(*folders)
        & F.col("gram").isin(needed)).groupBy("term_bucket", "term").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") == len(needed)).drop("n")


def _by_vocabulary(index, lang, c: Clause, needed: Column, test: Column) -> DataFrame:
    """Documents with a term that passes a test, made for the candidates of its grams only."""
    grams = None if index.lookups is None else index.postings.sparkSession.range(1).select(
        needed.alias("grams")).first()["grams"]
    terms = _with_grams(index, lang, c.field, grams).where(test)
    return _constant(_postings(index, lang, c.field).join(
        terms, ["term_bucket", "term"], "left_semi"))


def wildcard_pattern(value: str) -> str:
    """LIKE pattern: ``?`` is one character, ``*`` any number."""
    escaped = value.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return escaped.replace("?", "_").replace("*", "%")


def _match_wildcard(index, lang, c: Clause, lossy: bool) -> DataFrame:
    value = c.value.lower()
    return _by_vocabulary(index, lang, c, lookups.wildcard_grams(F.lit(value)),
                          F.col("term").like(wildcard_pattern(value)))


def _match_regex(index, lang, c: Clause, lossy: bool) -> DataFrame:
    return _by_vocabulary(index, lang, c, lookups.regex_grams(F.lit(c.value)),
                          F.col("term").rlike(f"^(?:{c.value})$"))


def edit_distance(term: Column, word: str, most: int = MAX_EDITS) -> Column:
    """Edits between a term and a word, null above ``most``; a swap is one edit.

    The built-in distance counts a swap of neighbours as two. So each swap of the
    word is tried as well: with what stands before and after it unchanged, but for
    one more edit on either side.
    """
    word_length = len(word)
    plain = F.levenshtein(term, F.lit(word), most)
    distance = F.when(plain >= 0, plain)
    swaps = [(i, word[:i], word[i + 1] + word[i], word[i + 2:])
             for i in range(word_length - 1) if word[i] != word[i + 1]]
    one = [head + pair + tail for _, head, pair, tail in swaps]
    if most >= 1 and one:
        distance = F.least(distance, F.when(term.isin(one), F.lit(1)))
    if most >= 2 and swaps:
        two = [w[:j] + w[j + 1] + w[j] + w[j + 2:] for (i, *_), w in zip(swaps, one)
               for j in range(i + 2, word_length - 1)]
        tests = [term.isin(two)] if two else []
        for _, head, pair, tail in swaps:
            before, after = head + pair, pair + tail
            rest = F.substring(term, len(before) + 1, 1_000_000)
            start = F.left(term, F.length(term) - len(after))
            tests.append(term.startswith(before)
                         & (F.levenshtein(rest, F.lit(tail), 1) >= 0))
            tests.append(term.endswith(after)
                         & (F.levenshtein(start, F.lit(head), 1) >= 0))
        distance = F.least(distance, F.when(reduce(Column.__or__, tests), F.lit(2)))
    return distance


def _near_vocabulary(index, lang, field, word: str, edits: int) -> DataFrame:
    """Term statistics of the terms whose beginning shares a neighbour with a word's, or of
    all terms."""
    vocabulary = _vocabulary(index, lang, field)
    if index.lookups is None:
        return vocabulary
    spark = index.postings.sparkSession
    keys = spark.range(1).select(
        F.explode(lookups.deletions(F.lit(word), edits)).alias("key")).withColumn(
        "key_bucket", bucket(F.col("key"), index.buckets))
    found = index.lookups.neighbours.where(
        (F.col("lang") == lang) & (F.col("field") == field)).join(
        F.broadcast(keys), ["key_bucket", "key"]).select("beginning").distinct()
    return vocabulary.withColumn("beginning", lookups.beginning(F.col("term"))).join(
        found, "beginning", "left_semi").drop("beginning")


def fuzzy_terms(index, lang, c: Clause) -> DataFrame:
    """All near terms with their weight, or the most similar ``expansions`` of them."""
    word = c.value.lower()
    shorter = F.least(F.length("term"), F.lit(len(word)))
    # An edit changes the length by one at most; the distance is worked out for these only.
    near = _near_vocabulary(index, lang, c.field, word, c.edits).where(
        F.abs(F.length("term") - len(word)) <= c.edits).withColumn(
        "edits", edit_distance(F.col("term"), word, c.edits)).where(F.col("edits").isNotNull())
    weight = F.when(F.col("edits") == 0, 1.0).otherwise(1.0 - F.col("edits") / shorter)
    found = near.withColumn("weight", weight).where(F.col("weight") > 0)
    if c.expansions is not None:
        found = found.orderBy(F.desc("weight"), "term").limit(c.expansions)
    return found.select("lang", "field", "term_bucket", "term", "df", "weight")


def _match_fuzzy(index, lang, c: Clause, lossy: bool) -> DataFrame:
    """The near terms score as one blended term, each by its similarity."""
    near = fuzzy_terms(index, lang, c)
    blended = near.groupBy("lang", "field").agg(F.max("df").alias("df"))
    keys = ["lang", "field", "term_bucket", "term"]
    weighted = near.drop("df").join(blended, ["lang", "field"]).join(
        _stats(index), ["lang", "field"])
    hits = _postings(index, lang, c.field).join(weighted, keys)
    part = F.col("weight") * search.bm25(
        F.col("tf"), F.col("dl"), F.col("avgdl"), F.col("n_docs"), F.col("df"), lossy)
    return hits.groupBy(*DOC).agg(F.sum(part).alias("score"))


def _nothing(index: Index) -> DataFrame:
    return index.postings.where(F.lit(False)).select(*DOC, F.lit(0.0).alias("score"))


MATCH = {
    "term": _match_term, "phrase": _match_phrase, "prefix": _match_prefix,
    "wildcard": _match_wildcard, "fuzzy": _match_fuzzy, "range": _match_range,
    "regex": _match_regex,
}


# --- combination -------------------------------------------------------------

def score_clauses(index: Index, lang: str, clauses: list[Clause],
                  lossy_norms: bool = True) -> DataFrame:
    """``(qid, lang, id, dup_no, copies, score)`` of the documents that match.

    A clause without a group is a group of its own. Every required group must
    match, no excluded one may, and without a required group some optional one
    must. Scores of all matching clauses add up; exclusion alone finds nothing.
    """
    parts, must, excluded = [], set(), []
    for i, c in enumerate(clauses):
        group = f"clause {i}" if c.group is None else f"group {c.group}"
        matched = MATCH[c.kind](index, lang, c, lossy_norms)
        if c.occur == "must_not":
            excluded.append(matched.select("lang", "id", "dup_no"))
            continue
        if c.occur == "must":
            must.add(group)
        parts.append(matched.select(
            *DOC, (F.col("score") * c.boost).alias("part"), F.lit(group).alias("grp")))
    if not parts:
        return _as_hits(_nothing(index))
    found = reduce(DataFrame.unionByName, parts).groupBy(*DOC).agg(
        F.round(F.sum("part"), 6).alias("score"), F.collect_set("grp").alias("groups"))
    if must:
        needed = F.array(*[F.lit(g) for g in sorted(must)])
        found = found.where(F.size(F.array_except(needed, F.col("groups"))) == 0)
    for out in excluded:
        found = found.join(out, ["lang", "id", "dup_no"], "left_anti")
    return _as_hits(found)


def _as_hits(scored: DataFrame) -> DataFrame:
    return scored.select(F.lit(1).alias("qid"), *DOC, "score")


def search_clauses(index: Index, lang: str, clauses: list[Clause],
                   k: int = search.TOP, lossy_norms: bool = True) -> DataFrame:
    """The ``k`` best documents of a structured query."""
    return search.top_k(score_clauses(index, lang, clauses, lossy_norms), k)
