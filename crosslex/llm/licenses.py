"""Licence scan: signature rules behind keywords, overlaps settled by containment and priority.

Everything is a column expression over one row, so a text is neither moved nor copied.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosslex.llm.common import picked, text_of
from crosslex.llm.license_rules import WORD_CHARS, Rule, build

WORD = f"[{WORD_CHARS}]+"
FOUND = "struct<start:int,stop:int,priority:int,label:string,base:int>"
#: Results of a fold are gathered in chunks, as adding to an array copies it.
CHUNK = 128


def _fold(items: Column, state: Column, step, out_type: str) -> Column:
    """Array of what ``step(state, item) -> (state, out or null)`` gives for each item in order."""
    empty = F.array().cast(f"array<{out_type}>")
    begin = F.struct(
        state.alias("state"), empty.alias("open"),
        F.array().cast(f"array<array<{out_type}>>").alias("full"))

    def merge(acc: Column, item: Column) -> Column:
        after, out = step(acc["state"], item)
        grown = F.when(out.isNull(), acc["open"]).otherwise(F.concat(acc["open"], F.array(out)))
        full = F.size(acc["open"]) >= CHUNK
        return F.struct(
            after.alias("state"),
            F.when(full, F.when(out.isNull(), empty).otherwise(F.array(out)))
            .otherwise(grown).alias("open"),
            F.when(full, F.concat(acc["full"], F.array(acc["open"])))
            .otherwise(acc["full"]).alias("full"))

    return F.aggregate(
        items, begin, merge, lambda acc: F.concat(F.flatten(acc["full"]), acc["open"]))


def _places(text: Column, rule: Column) -> Column:
    """Where a rule's pattern matches: the text between the matches gives their offsets."""
    matches = F.call_function("regexp_extract_all", text, rule["pattern"], F.lit(0))
    between = F.call_function("split", text, rule["pattern"], F.lit(-1))

    def step(at: Column, pair: Column):
        start = at + F.length(pair["gap"])
        stop = start + F.length(pair["match"])
        return stop, F.struct(
            start.alias("start"), stop.alias("stop"), rule["priority"].alias("priority"),
            rule["label"].alias("label"), rule["base"].alias("base"))

    def placed(found: Column) -> Column:
        pairs = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda m, g: F.struct(
            g.alias("gap"), m.alias("match")))
        return _fold(pairs, F.lit(0), step, FOUND)

    empty = F.array().cast(f"array<{FOUND}>")
    # Bound to a name, so that the text is searched once.
    return F.flatten(F.transform(F.array(matches), lambda m: F.when(
        F.size(m) == 0, empty).otherwise(placed(m))))


def _settled(found: Column) -> Column:
    """Detections left when overlaps are resolved, in order of their start.

    One contained in another goes, whatever their priorities; of equal ones the higher
    priority stays. Of two that overlap in part the first stays, unless the second has the
    higher priority; then the part of the first before it is what the first was seen in,
    and both are kept. Sorted by start, the longer first, a detection is contained in an
    earlier one if none so far ended before it.
    """
    ordered = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"], (-d["stop"]).alias("rank_stop"), (-d["priority"]).alias("rank"), d["label"],
        d["base"])))
    begin = F.struct(F.lit(-1).alias("reach"), F.lit(-1).alias("priority"))

    def step(last: Column, d: Column):
        stop, priority = -d["rank_stop"], -d["rank"]
        kept = (stop > last["reach"]) & (
            (d["start"] >= last["reach"]) | (priority > last["priority"]))
        after = F.struct(
            F.when(kept, stop).otherwise(last["reach"]).alias("reach"),
            F.when(kept, priority).otherwise(last["priority"]).alias("priority"))
        return after, F.when(kept, F.struct(
            d["start"], stop.alias("stop"), priority.alias("priority"), d["label"], d["base"]))

    return _fold(ordered, begin, step, FOUND)


def scan(docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """The rows with ``found`` and ``base`` beside them: arrays of
    ``start, stop, priority, label, base`` by character offset.

    ``found`` holds the detections left after overlaps are settled, ``base`` all places of
    the phrases that are always reported. Both are empty for null and empty texts. Every
    other column is returned as it is; a column named ``found`` or ``base`` is replaced.
    """
    rules = build() if rules is None else rules
    keywords = sorted({rule.keyword for rule in rules})
    table = F.array(*[F.struct(
        F.lit(r.keyword).alias("keyword"), F.lit(r.also).alias("also"),
        F.lit(r.pattern).alias("pattern"), F.lit(r.priority).alias("priority"),
        F.lit(r.label).alias("label"), F.lit(r.base).alias("base")) for r in rules])
    empty = F.array().cast(f"array<{FOUND}>")
    rest = docs.drop("found", "base")

    # One step a column, each used more than once by the next, so that none is worked
    # out again inside an expression. Lower case beyond A-Z may only open a gate too many.
    lowered = rest.withColumn("_llm_lower", F.lower(text_of(text_col)))
    gated = lowered.withColumn("_llm_gates", F.array_compact(F.array(*[
        F.when(F.contains("_llm_lower", F.lit(k)), F.lit(k)) for k in keywords])))
    tried = F.filter(table, lambda r: F.array_contains("_llm_gates", r["keyword"])
                     & F.contains(F.col("_llm_lower"), r["also"]))
    searched = gated.withColumn("_llm_all", F.when(F.size("_llm_gates") == 0, empty).otherwise(
        F.flatten(F.transform(tried, lambda r: _places(F.col(text_col), r)))))
    return searched.select(
        *rest.columns,
        F.when(F.size("_llm_all") == 0, empty).otherwise(_settled(F.col("_llm_all"))).alias("found"),
        F.array_sort(F.filter("_llm_all", lambda d: d["base"] > 0)).alias("base"))


def license_report(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``<id>, n_words, n_base, first_word, last_word, base_labels, labels, score, detections``.

    The word columns count words of digits, letters and everything beyond ASCII. ``score``
    is the share of the text's characters inside detections. A null or empty text has
    zeros, no labels and null places; each row, repeated or without id, gives one row.
    """
    seen = scan(picked(docs, id=id_col, text=text_of(text_col)), rules)
    n_words = F.regexp_count("text", F.lit(WORD)).cast("long")

    def words_before(place: Column) -> Column:
        return F.regexp_count(F.substring("text", F.lit(1), place["start"]), F.lit(WORD)).cast("long")

    def labels(of: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda d: d["label"]))), ",")

    inside = F.aggregate("found", F.struct(F.lit(0).alias("sum"), F.lit(0).alias("reach")),
                         lambda acc, d: F.struct(
        (acc["sum"] + d["stop"] - F.greatest(d["start"], acc["reach"])).alias("sum"),
        d["stop"].alias("reach")), lambda acc: acc["sum"])
    return seen.select(
        F.col("id").alias(id_col), n_words.alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.when(F.size("base") > 0, words_before(F.col("base")[0])).alias("first_word"),
        F.when(F.size("base") > 0, words_before(F.element_at("base", -1))).alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(F.concat("found", "base")).alias("labels"),
        F.when(F.size("found") == 0, F.lit(0.0)).otherwise(
            inside / F.length("text")).alias("score"),
        F.transform("found", lambda d: F.struct(d["start"], d["stop"], d["label"])).alias("detections"))
