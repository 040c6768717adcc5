"""URL filter: a given list of rules, and rules mined from labelled URLs where it is silent."""

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosslex.llm.common import held, picked
from crosslex.sources import workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, ALLOW = "block", "allow"
#: Items that stand for the label in what is mined; no token of a URL begins like them.
MARKS = {BLOCK: "=block", ALLOW: "=allow"}


@dataclass(frozen=True)
class Listed:
    """A rule of the given list: for a host and its subdomains, paths that begin alike."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Mined:
    """URLs with all these tokens have the verdict, as often as the confidence says."""

    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: int


# --- parts of a URL --------------------------------------------------------------

def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null and without ``://``."""
    def part(n):
        return F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", n), F.lit(""))

    return lowered(part(1)), part(2)


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL; their first letter tells what they are.

    ``s`` scheme, ``e`` ending of the host, ``d`` its last two labels, ``l`` a label, ``w`` a
    word inside a label, ``p`` a piece of the path, ``x`` the ending of its last piece, ``q``
    a name or a name with its value from the query. Numbers count as alike (``0``).
    """
    host, path = host_and_path(url)
    labels = F.split(F.regexp_replace(host, ":[0-9]*$", ""), "[.]")
    pieces = F.split(F.regexp_replace(lowered(path), "[0-9]+", "0"), "/")
    last = F.element_at(pieces, -1)
    asked = F.split(F.regexp_replace(lowered(F.regexp_extract(
        F.coalesce(url, F.lit("")), "^[^?#]*[?]([^#]*)", 1)), "[0-9]+", "0"), "&")

    def marked(letter, parts):
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(f"{letter}:"), x))

    return F.array_distinct(F.concat(
        marked("s", F.array(lowered(F.regexp_extract(
            F.coalesce(url, F.lit("")), "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)))),
        marked("e", F.array(F.element_at(labels, -1))),
        marked("d", F.array(F.array_join(F.slice(labels, F.greatest(
            F.size(labels) - 1, F.lit(1)), F.lit(2)), "."))),
        marked("l", labels),
        marked("w", F.flatten(F.transform(
            F.filter(labels, lambda x: x.rlike("[-_]")), lambda x: F.split(x, "[-_]+")))),
        marked("p", pieces),
        marked("x", F.array(F.regexp_extract(last, "[.]([a-z0-9]+)$", 1))),
        marked("q", F.flatten(F.transform(
            asked, lambda x: F.array(F.substring_index(x, "=", 1), x)))),
    ))


# --- the given list ----------------------------------------------------------------

def fitting_rule(host: Column, path: Column, rules: list[Listed]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does.

    Of rules of one length the first by name, of one name a block, goes before.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict != BLOCK))
    name = verdict = F.lit(None).cast("string")
    for rule in reversed(ranked):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def labelled_urls(pages: DataFrame, labels: DataFrame, rules: list[Listed], id_col: str = "page_id",
                  url_col: str = "url", label_id_col: str = "doc_id", good_col: str = "quality",
                  toxic_col: str = "toxic") -> DataFrame:
    """``url, verdict``: what is known about URLs, to mine rules from.

    The verdict of the list where it has a rule. Elsewhere the label of the page's id: a
    toxic page speaks for a block, a good one that is not toxic against it. Pages of which
    neither says anything, and null URLs, are left out; a URL may stand with both verdicts.
    """
    marks = picked(labels, id=label_id_col, good=good_col, toxic=toxic_col).where(
        "id IS NOT NULL").groupBy("id").agg(
        *[F.max(F.coalesce((F.col(c) == 1), F.lit(False))).alias(c) for c in ("good", "toxic")])
    host, path = host_and_path(F.col("url"))
    _, by_list = fitting_rule(host, path, rules)
    parts = picked(pages, id=id_col, url=url_col).where("url IS NOT NULL").withColumn("listed", by_list)
    by_label = F.when(F.col("toxic"), BLOCK).when(F.col("good"), ALLOW)
    silent = parts.where("listed IS NULL AND id IS NOT NULL").join(marks, "id").select(
        "url", by_label.alias("verdict"))
    return parts.select("url", F.col("listed").alias("verdict")).unionAll(silent).where(
        "verdict IS NOT NULL")


# --- mining ---------------------------------------------------------------------------

class Index:
    """Rules by their rarest token: a URL tries only those that one of its tokens leads to."""

    def __init__(self, rules: list[tuple[str, ...]]):
        holders = Counter(token for tokens in rules for token in tokens)
        self.by_token = defaultdict(list)
        for n, tokens in enumerate(rules):
            first = min(tokens, key=lambda token: (holders[token], token))
            self.by_token[first].append((n, frozenset(tokens) - {first}))

    def matches(self, tokens: list[str]) -> Iterator[int]:
        """Numbers of the rules whose tokens are all there, each once."""
        own = set(tokens)
        for token in own & self.by_token.keys():
            for n, others in self.by_token[token]:
                if others <= own:
                    yield n


index_of = held(Index)


def token_strengths(urls: DataFrame, least: int) -> dict[str, float]:
    """How far a token's share of blocks is from that of all URLs, in standard errors.

    For tokens of at least ``least`` URLs: with ``least`` a share of the URLs, as many as a
    URL has tokens, by the inverse of the share, at most.
    """
    one = F.lit(1)
    total = urls.agg(F.count(one).alias("n"), F.avg(F.col("blocked").cast("double")).alias("base")).first()
    if not total["n"]:
        return {}
    counted = urls.select(F.explode("tokens").alias("token"), "blocked").groupBy("token").agg(
        F.count(one).alias("n"), F.avg(F.col("blocked").cast("double")).alias("share")).where(
        F.col("n") >= least)
    return {r["token"]: abs(r["share"] - total["base"]) * r["n"] ** 0.5 for r in counted.collect()}


def candidates(urls: DataFrame, strengths: dict[str, float], least_share: float, rows: int,
               total: int, widest: int, longest: int) -> list[tuple[str, ...]]:
    """Token combinations that FP-growth finds frequent together with a verdict.

    It is given ``rows`` of the URLs or so, chosen by their hash, and of each the ``widest``
    tokens whose share of blocks is farthest from the common one.
    """
    spark = urls.sparkSession
    known = spark.sparkContext.broadcast(strengths)

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = known.value
        for batch in batches:
            items = [
                [*sorted((t for t in tokens if t in of), key=lambda t: (-of[t], t))[:widest],
                 MARKS[BLOCK if blocked else ALLOW]]
                for tokens, blocked in zip(batch.column("tokens").to_pylist(),
                                           batch.column("blocked").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.list_(pa.string()))], ["items"])

    parts = 1 << 30
    chosen = urls.where(F.pmod(F.xxhash64("url"), F.lit(parts)) < int(parts * min(1.0, rows / total)))
    items = workspace.settle(
        chosen.select("tokens", "blocked").mapInArrow(strongest, "items array<string>"), "items")
    # A few small files are one task's; the patterns are grown in as many as there are cores.
    spread = items.repartition(spark.sparkContext.defaultParallelism)
    model = FPGrowth(minSupport=least_share, itemsCol="items").fit(spread)
    marks = F.array(*[F.lit(m) for m in MARKS.values()])
    found = model.freqItemsets.where(F.arrays_overlap("items", marks)).select(
        F.array_sort(F.array_except("items", marks)).alias("tokens")).where(
        F.size("tokens").between(1, longest)).distinct()
    return sorted(tuple(r["tokens"]) for r in found.collect())


def mine(labelled: DataFrame, least_share: float = 0.002, least_urls: int = 5,
         confidence: float = 0.8, longest: int = 3, rows: int = 200_000, widest: int = 10,
         most_rules: int = 10_000) -> list[Mined]:
    """Rules for ``labelled(url, verdict)``, the best first.

    A rule has at most ``longest`` tokens and is kept if it is on ``least_share`` of the
    labelled URLs, on ``least_urls`` at least, holds for ``confidence`` of them and more
    often than its verdict does in general, and no rule with fewer of its tokens is as sure.
    A URL counts once for each verdict that it has, however often it occurs. Without labelled
    URLs there are no rules.

    FP-growth names candidates from about ``rows`` URLs; their support and confidence are then
    counted over all. What reaches the driver is bounded by the support: a URL names fewer
    than (``widest`` + 1) ** ``longest`` combinations, and each needs its share of the URLs.
    Of more than ``most_rules`` rules the best stay.
    """
    spark = labelled.sparkSession
    urls = workspace.settle(
        labelled.select("url", (F.col("verdict") == BLOCK).alias("blocked")).where(
            "url IS NOT NULL AND blocked IS NOT NULL").distinct().withColumn(
            "tokens", url_tokens(F.col("url"))), "urls")
    by_verdict = {r["blocked"]: r["count"] for r in urls.groupBy("blocked").count().collect()}
    total = sum(by_verdict.values())
    if not total:
        return []
    least = max(least_urls, int(least_share * total))
    combinations_ = candidates(
        urls, token_strengths(urls, least), min(1.0, least / total), rows, total, widest, longest)
    if not combinations_:
        return []
    sent = spark.sparkContext.broadcast(combinations_)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, found = index_of(sent.value), Counter()
        for batch in batches:
            for tokens, blocked in zip(batch.column("tokens").to_pylist(),
                                       batch.column("blocked").to_pylist()):
                found.update((n, blocked) for n in index.matches(tokens))
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in found], pa.int32()), pa.array([b for _, b in found], pa.bool_()),
             pa.array(list(found.values()), pa.int64())], ["n", "blocked", "urls"])

    counts: dict[int, dict[bool, int]] = defaultdict(lambda: {True: 0, False: 0})
    for r in urls.select("tokens", "blocked").mapInArrow(
            count, "n int, blocked boolean, urls long").groupBy("n", "blocked").agg(
            F.sum("urls").alias("urls")).collect():
        counts[r["n"]][r["blocked"]] = r["urls"]
    sure = {}
    for n, of in counts.items():
        support = of[True] + of[False]
        for blocked, verdict in ((True, BLOCK), (False, ALLOW)):
            share = of[blocked] / support
            if support >= least and share >= confidence and share > by_verdict.get(blocked, 0) / total:
                sure[combinations_[n], verdict] = Mined(combinations_[n], verdict, share, support)
    kept = [rule for (tokens, verdict), rule in sure.items() if not any(
        (fewer, verdict) in sure and sure[fewer, verdict].confidence >= rule.confidence
        for size in range(1, len(tokens)) for fewer in combinations(tokens, size))]
    return sorted(kept, key=lambda r: (-r.confidence, -r.support, r.tokens, r.verdict))[:most_rules]


# --- verdicts --------------------------------------------------------------------------

def judge_urls(pages: DataFrame, listed: list[Listed], mined: list[Mined], id_col: str = "page_id",
               url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """``<id>, host, path, rule, verdict, mined, confidence`` of every row.

    The longest rule of the list that fits decides. Where none does, the first of the mined
    rules whose tokens the URL has; ``mined`` are its tokens joined by blanks. Where that
    finds none either, ``default``. A null URL, or one without ``://``, has an empty host and
    path and fits no rule; repeated rows are each judged.

    Rows are not moved: the rules, at most as many as were asked for when they were mined,
    go to every task.
    """
    sent = pages.sparkSession.sparkContext.broadcast([rule.tokens for rule in mined])

    def first_match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(sent.value)
        for batch in batches:
            tokens = batch.column("tokens").to_pylist()
            best = [None if own is None else min(index.matches(own), default=None) for own in tokens]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(best, pa.int32())], [*batch.schema.names[:-1], "n"])

    host, path = host_and_path(F.col("url"))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), listed)
    rows = picked(pages, id=id_col, url=url_col).withColumns({"host": host, "path": path}).withColumns(
        {"rule": name, "listed": verdict}).withColumn(
        "tokens", F.when(F.col("listed").isNull(), url_tokens(F.col("url")))).drop("url")
    shape = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])
    judged = rows.mapInArrow(first_match, f"{shape}, n int")

    def of_rule(values, kind):
        """The value of the rule that matched, from a literal list."""
        return F.get(F.lit(values) if values else F.array().cast(f"array<{kind}>"), F.col("n"))

    return judged.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("listed", of_rule([r.verdict for r in mined], "string"),
                   F.lit(default)).alias("verdict"),
        of_rule([" ".join(r.tokens) for r in mined], "string").alias("mined"),
        of_rule([r.confidence for r in mined], "double").alias("confidence"))
