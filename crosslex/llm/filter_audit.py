"""How filters interact: what each step of every order of them removes, by a recursive query."""

from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crosslex.llm.common import picked, text_of
from crosslex.sources import workspace

#: Words are what stands between these.
BLANKS = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The filter that looks at other documents; the others look at a text alone.
REPEATED = "E"
#: A recursion over more letters exceeds the rows that Spark lets a recursive query have.
MOST_LETTERS = 6


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Whether a text fails a filter, by the filter's letter."""
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def bits(failures: dict[str, Column], letters: str) -> Column:
    """The failures as one number: the bit of a letter is its place in ``letters``."""
    found = F.lit(0)
    for letter, fails in failures.items():
        found = found + F.when(fails, 1 << letters.index(letter)).otherwise(0)
    return found.cast("int")


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source", letters: str = "ABCDE") -> DataFrame:
    """``id, part, mask`` for every row: which filters it fails, whatever the others do.

    A null text is empty, a null part is the empty string. A document fails ``E`` if a row
    with a smaller id has the same text; rows of one id do not fail it by each other, and a
    null id is neither smaller than another nor has a smaller one. Texts are compared by
    SHA-256.

    A text is read once and only its digest moves. The smallest id of each digest is a sum
    by key, partial before its shuffle; a row then meets it by digest and id together, so
    that no text, however often it occurs, makes one task large.
    """
    words = F.array_remove(F.split("text", BLANKS), "")
    rows = workspace.settle(
        picked(docs, id=id_col, text=text_col, part=part_col).select(
            "id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
            text_of("text").alias("text")).withColumn("words", words).select(
            "id", "part", bits(text_failures(F.col("text"), F.col("words")), letters).alias("mask"),
            F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")), "masks")
    known, unnamed = rows.where("id IS NOT NULL"), rows.where("id IS NULL")
    firsts = known.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    repeated = F.when(F.col("first").isNull(), 1 << letters.index(REPEATED)).otherwise(0)
    return known.join(firsts, ["digest", "id"], "left").select(
        "id", "part", (F.col("mask") + repeated).cast("int").alias("mask")
    ).unionByName(unnamed.select("id", "part", "mask"))


def mask_cells(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """``part, mask, documents, good, toxic``: the documents of a part that fail alike.

    A document is good, or toxic, if a label of its id says 1; without a label, or with a
    null one, it is neither. At most 2 ** letters rows a part.
    """
    marks = picked(labels, id=id_col, good=good_col, toxic=toxic_col).where(
        "id IS NOT NULL").groupBy("id").agg(
        *[F.max((F.col(c) == 1).cast("long")).alias(c) for c in ("good", "toxic")])
    known, unnamed = masks.where("id IS NOT NULL"), masks.where("id IS NULL")
    none = F.lit(None).cast("long")
    marked = known.join(marks, "id", "left").select("part", "mask", "good", "toxic").unionByName(
        unnamed.select("part", "mask", none.alias("good"), none.alias("toxic")))
    return marked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("documents"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")])


def walk(spark: SparkSession, letters: str = "ABCDE") -> DataFrame:
    """``filter_order, step, mask`` and what the last filter does to documents of the mask.

    Each level of the recursion puts one more unused letter behind every prefix of an order,
    for each mask, and carries the bits of the filters that stand before. ``fate`` is kept,
    removed (by this filter), redundant (removed before, and this filter fails it too) or
    gone; ``alone`` tells that the mask fails no other filter. The number of rows depends on
    the letters only.
    """
    if len(set(letters)) != len(letters) or not 0 < len(letters) <= MOST_LETTERS:
        raise ValueError(f"give 1 to {MOST_LETTERS} different letters")
    filters = ", ".join(f"('{letter}', {1 << i})" for i, letter in enumerate(letters))
    return spark.sql(f"""
        WITH RECURSIVE filters(letter, bit) AS (VALUES {filters}),
        walk(filter_order, step, applied, bit, mask) AS (
            SELECT '', 0, 0, 0, CAST(id AS INT) FROM range({1 << len(letters)})
            UNION ALL
            SELECT concat(w.filter_order, f.letter), w.step + 1, w.applied | w.bit, f.bit, w.mask
            FROM walk w JOIN filters f ON ((w.applied | w.bit) & f.bit) = 0)
        SELECT filter_order, step, mask,
            CASE WHEN mask & applied = 0 AND mask & bit = 0 THEN 'kept'
                WHEN mask & applied = 0 THEN 'removed'
                WHEN mask & bit <> 0 THEN 'redundant' ELSE 'gone' END AS fate,
            mask = bit AS alone
        FROM walk WHERE step > 0""")


def filter_interactions(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """``part, filter_order, step`` and the counts of that step, for all orders of the filters.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (it would remove them, an
    earlier one did), ``unique_fails`` (fail its filter only), ``good_lost`` and
    ``toxic_lost`` (of those removed), ``shapley`` (removed by its filter, over all orders).
    Every part has all orders and steps, with zeros; a table without rows has none.

    The steps of an order depend on its prefix only, so counts are added up by prefix (325
    for five filters) and given to the orders that begin with it. A part is at most 2 **
    letters cells, so nothing grows with its documents.
    """
    spark = cells.sparkSession
    steps = workspace.settle(walk(spark, letters), "walk")

    def total(count: str, test: Column) -> Column:
        return F.sum(F.when(test, F.col(count)).otherwise(0))

    removed, fate = F.col("fate") == "removed", F.col("fate")
    by_prefix = cells.join(F.broadcast(steps), "mask").groupBy("part", "filter_order", "step").agg(
        total("documents", fate == "kept").alias("kept"),
        total("documents", removed).alias("removed"),
        total("documents", fate == "redundant").alias("redundant"),
        total("documents", F.col("alone")).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
    ).withColumnRenamed("filter_order", "prefix")
    # A prefix of k letters begins (n - k)! orders.
    begins = F.element_at(F.array(*[
        F.lit(factorial(len(letters) - k)) for k in range(1, len(letters) + 1)]), F.col("step"))
    of_filter = Window.partitionBy("part", F.right("prefix", F.lit(1)))
    with_shares = by_prefix.withColumn(
        "shapley", F.sum(F.col("removed") * begins).over(of_filter)).drop("step")
    orders = steps.where(F.col("step") == len(letters)).select("filter_order").distinct().select(
        "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")).select(
        "filter_order", "step", F.left("filter_order", F.col("step")).alias("prefix"))
    return with_shares.join(F.broadcast(orders), "prefix").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley")
