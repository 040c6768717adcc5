"""Language by fused evidence: the text, the declared language, and where the document comes from.

For each language the logarithms are added of how likely the text is in it (byte
trigrams, a bounded sample of labelled rows to learn from), how likely such a document
declares what this one declares, and how common the language is on its host. The last
two are counted over all documents; a host with few of them leans on its suffix, a
suffix on the whole.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosslex.llm.common import SLICE, held, lean, picked, slices, small_batches, text_of
from crosslex.sources import workspace

FEATURES = 1 << 16
#: Labelled rows a language is learned from, about.
SAMPLE_ROWS = 1_000
#: A label is a language if it is on so many rows, or on one in so many of the labelled rows.
LEAST_ROWS, LABEL_SHARE = 5, 1_000
#: Languages whose counts a task of the training holds at once.
HELD_LANGUAGES = 64
#: Neighbouring trigrams tell much the same: a text counts as at most so many of them.
EVIDENCE = 60
#: Documents that a host's or suffix's prior weighs against its own.
HOST_WEIGHT = SUFFIX_WEIGHT = 20.0
#: Up to so many hosts are sent to all tasks; more are joined by a shuffle.
BROADCAST_HOSTS = 200_000

# Letters stay, A-Z in lower case, bytes beyond ASCII too; all else is a blank.
_TABLE = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32
                   for b in range(256)], np.uint8)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature of every byte's trigram, whether it counts (its middle is no blank), and where
    each text begins; the texts stand behind one another with blanks between."""
    data = b"".join(b"  " + t.encode("utf-8", "surrogatepass") for t in texts) + b"  "
    raw = _TABLE[np.frombuffer(data, np.uint8)]
    wide = raw.astype(np.uint32)
    feature = ((wide[:-2] * 961 + wide[1:-1] * 31 + wide[2:]) * np.uint32(2654435761)) >> np.uint32(16)
    sizes = [len(t.encode("utf-8", "surrogatepass")) + 2 for t in texts]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    return feature, raw[1:-1] != 32, starts


@dataclass(frozen=True)
class Model:
    """``logs[k, f]``: logarithm of the share of feature ``f`` in language ``k``."""

    languages: list[str]
    logs: np.ndarray
    confusion: np.ndarray | None = None  # of what is declared (languages, other, none), by language

    def likelihoods(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text by language, and the trigrams counted."""
        feature, counts, starts = trigrams(texts)
        n = np.add.reduceat(counts, starts, dtype=np.int64)
        sums = np.stack([np.add.reduceat(np.where(counts, log[feature], 0.0), starts)
                         for log in self.logs], axis=1)
        mean = sums / np.maximum(n, 1)[:, None]
        return mean * np.minimum(n, EVIDENCE)[:, None], n


@held
def _model(model: Model) -> Model:
    return model


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, text_col: str = "text",
          lang_col: str = "lang", least_rows: int = LEAST_ROWS,
          label_share: int = LABEL_SHARE) -> Model:
    """Learn languages from about ``sample_rows`` labelled rows each, chosen by hash.

    Every label on ``least_rows`` rows is learned, however large the table; where fewer than
    ``least_rows * label_share`` rows are labelled, rarer ones too. Rows whose label is null
    or blank do not count. What reaches the driver is a count a language and feature.
    """
    rows = picked(docs, text=text_of(text_col), lang=lang_col).where(F.trim("lang") != "")
    labels = workspace.settle(rows.groupBy("lang").count(), "labels")
    total = labels.agg(F.sum("count")).first()[0] or 0
    found = {r["lang"]: r["count"] for r in labels.where(
        (F.col("count") >= least_rows) | (F.col("count") * label_share >= total)).collect()}
    languages = sorted(found)
    if not languages:
        return Model([], np.zeros((0, FEATURES), np.float32))
    share = F.create_map(*[x for lang, n in found.items() for x in (
        F.lit(lang), F.lit(min(1.0, sample_rows / n)))])
    sample = rows.where(F.col("lang").isin(languages)).where(
        F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < share[F.col("lang")] * 1_000_003)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {lang: k for k, lang in enumerate(languages)}
        counts: dict[int, np.ndarray] = {}

        def counted_so_far() -> Iterator[pa.RecordBatch]:
            for k, own in counts.items():
                f = np.flatnonzero(own)
                yield pa.RecordBatch.from_pydict({"k": np.full(len(f), k), "f": f, "n": own[f]})
            counts.clear()

        for part in slices(batches):
            for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                feature, counted, _ = trigrams([text])
                own = np.bincount(feature[counted], minlength=FEATURES)
                if (k := place[lang]) in counts:
                    counts[k] += own
                    continue
                if len(counts) >= HELD_LANGUAGES:
                    yield from counted_so_far()
                counts[k] = own
        yield from counted_so_far()

    summed = sample.mapInArrow(run, "k long, f long, n long").groupBy("k", "f").agg(
        F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), FEATURES))
    counts[summed["k"].to_numpy(np.int64), summed["f"].to_numpy(np.int64)] = summed["n"]
    logs = np.log((counts + 0.1) / (counts.sum(axis=1, keepdims=True) + 0.1 * FEATURES))
    return Model(languages, logs.astype(np.float32))


def host_of(address: Column) -> Column:
    """Host of an address in lower case; anything without a scheme is taken as a host."""
    found = F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.coalesce(F.when(found != "", found), address, F.lit("")))


def suffix_of(host: Column) -> Column:
    """Last label of a host of several, else empty."""
    return F.regexp_extract(host, r"\.([a-z]+)$", 1)


def _scored(docs: DataFrame, model: Model, text_col: str, lang_col: str,
            address_col: str) -> DataFrame:
    """The rows with host, declared language (its number) and text likelihoods beside them."""
    numbers = {lang: i for i, lang in enumerate(model.languages)}
    known = F.create_map(*[x for lang, i in numbers.items() for x in (F.lit(lang), F.lit(i))])
    declared = F.lower(F.regexp_extract(F.coalesce(F.col(lang_col), F.lit("")), "^[^-_]*", 0))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # Only the text goes to Python and only numbers come back.
    @F.arrow_udf("struct<logs:array<double>,n:bigint>")
    def likelihoods(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _model(shared.value)
        for batch in batches:
            logs, counts = [np.zeros((0, len(own.languages)))], [np.zeros(0, np.int64)]
            for start in range(0, len(batch), SLICE):
                one, n = own.likelihoods([t or "" for t in batch.slice(start, SLICE).to_pylist()])
                logs.append(one)
                counts.append(n)
            each = np.concatenate(logs)
            ends = np.arange(len(each) + 1, dtype=np.int32) * each.shape[1]
            yield pa.StructArray.from_arrays([
                pa.ListArray.from_arrays(pa.array(ends), pa.array(each.reshape(-1))),
                pa.array(np.concatenate(counts), pa.int64())], names=["logs", "n"])

    return docs.withColumns({
        "_llm_host": host_of(F.col(address_col)),
        "_llm_declared": F.when(declared == "", len(numbers) + 1).otherwise(
            F.coalesce(known[declared], F.lit(len(numbers)))),
        # Called so, a filter on the scores does not work them out a second time.
        "_llm_scores": likelihoods.asNondeterministic()(F.col(text_col)),
    }).withColumns({
        "_llm_logs": F.col("_llm_scores.logs"), "_llm_n": F.col("_llm_scores.n")})


def _normal(logs: Column) -> Column:
    """Probabilities in proportion to the exponentials."""
    high = F.array_max(logs)
    parts = F.transform(logs, lambda x: F.exp(x - high))
    return F.transform(parts, lambda p: p / F.aggregate(parts, F.lit(0.0), lambda a, x: a + x))


def _priors(scored: DataFrame, model: Model) -> tuple[DataFrame, np.ndarray]:
    """Logarithms of the languages' shares by host, and how what is declared depends on them.

    Documents without letters tell nothing. The sums a host and declaration are written;
    from them come those of suffixes, of declarations (a bounded table) and of all.
    """
    size = len(model.languages)
    soft = scored.where("_llm_n > 0").select(
        "_llm_host", "_llm_declared", _normal(F.col("_llm_logs")).alias("p"))
    sums = [F.sum(F.col("p")[k]).alias(f"p{k}") for k in range(size)]
    counts = workspace.settle(soft.groupBy("_llm_host", "_llm_declared").agg(*sums), "hosts")
    again = [F.sum(f"p{k}").alias(f"p{k}") for k in range(size)]

    told = np.zeros((size + 2, size))
    for r in counts.groupBy("_llm_declared").agg(*again).collect():
        told[r["_llm_declared"]] = [r[f"p{k}"] for k in range(size)]
    overall = (told.sum(axis=0) + 1) / (told.sum() + size)
    confusion = np.log((told + 1) / (told + 1).sum(axis=0))

    hosts = counts.groupBy("_llm_host").agg(*again).withColumn(
        "_llm_suffix", suffix_of(F.col("_llm_host")))
    suffixes = hosts.groupBy("_llm_suffix").agg(
        *[F.sum(f"p{k}").alias(f"s{k}") for k in range(size)])

    def smoothed(own: str, above: list[Column], weight: float) -> list[Column]:
        n = sum((F.col(f"{own}{k}") for k in range(size)), F.lit(0.0))
        return [(F.col(f"{own}{k}") + weight * above[k]) / (n + weight) for k in range(size)]

    suffixes = suffixes.select("_llm_suffix", *[
        c.alias(f"s{k}") for k, c in enumerate(smoothed(
            "s", [F.lit(float(x)) for x in overall], SUFFIX_WEIGHT))])
    priors = hosts.join(suffixes, "_llm_suffix").select("_llm_host", F.array(*[
        F.log(c) for c in smoothed("p", [F.col(f"s{k}") for k in range(size)], HOST_WEIGHT)
    ]).alias("_llm_prior"))
    return workspace.settle(priors, "host_priors"), confusion


def identify(docs: DataFrame, model: Model | None = None, certain: float = 0.5,
             wanted: list[str] | None = None, text_col: str = "text", lang_col: str = "lang",
             address_col: str = "source") -> DataFrame:
    """The rows with ``language`` beside them: ``name, posterior, by_text, n_trigrams, kept``.

    ``lang_col`` holds what a document declares (a code, region after a dash), null or empty
    if nothing; ``address_col`` an address or a host. A document is kept if it has letters,
    one language has a posterior of at least ``certain`` and that is among ``wanted`` (null:
    any). Without letters (null and empty texts too) name and posterior are null. Where no
    row is labelled no language is known and nothing is kept. All columns are returned; one
    named ``language`` is replaced.
    """
    model = train(docs, text_col=text_col, lang_col=lang_col) if model is None else model
    rest = docs.drop("language")
    kind = "struct<name:string,posterior:double,by_text:string,n_trigrams:bigint,kept:boolean>"
    if not model.languages:
        return rest.withColumn("language", F.struct(
            F.lit(None).alias("name"), F.lit(None).alias("posterior"),
            F.lit(None).alias("by_text"), F.lit(0).alias("n_trigrams"),
            F.lit(False).alias("kept")).cast(kind))
    scored = _scored(rest, model, text_col, lang_col, address_col)
    needed = docs.select(text_col, lang_col, address_col)
    priors, confusion = _priors(_scored(needed, model, text_col, lang_col, address_col), model)
    if priors.count() <= BROADCAST_HOSTS:
        priors = F.broadcast(priors)
    joined = scored.join(priors, "_llm_host", "left")

    size = len(model.languages)
    told = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in confusion])
    none = F.array_repeat(F.lit(math.log(1 / size)), size)
    logs = F.zip_with(
        F.zip_with("_llm_logs", F.coalesce("_llm_prior", none), lambda a, b: a + b),
        told[F.col("_llm_declared")], lambda a, b: a + b)
    names = F.array(*[F.lit(x) for x in model.languages])
    fused = joined.withColumn("_llm_p", _normal(logs))

    def best(of: str) -> Column:
        return names[(F.array_position(of, F.array_max(of)) - 1).cast("int")]

    some = F.col("_llm_n") > 0
    sure = some & (F.array_max("_llm_p") >= certain)
    if wanted is not None:
        sure &= best("_llm_p").isin(wanted)
    return fused.select(*rest.columns, F.struct(
        F.when(some, best("_llm_p")).alias("name"),
        F.when(some, F.array_max("_llm_p")).alias("posterior"),
        F.when(some, best("_llm_logs")).alias("by_text"),
        F.col("_llm_n").alias("n_trigrams"), sure.alias("kept")).cast(kind).alias("language"))


def language_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", address_col: str = "source", **options) -> DataFrame:
    """``<id>, declared, language, posterior, by_text, n_trigrams, kept`` for every row."""
    rows = picked(docs, id=id_col, text=text_col, lang=lang_col, source=address_col)
    return identify(rows, **options).select(
        F.col("id").alias(id_col), F.col("lang").alias("declared"),
        F.col("language.name").alias("language"), "language.posterior", "language.by_text",
        "language.n_trigrams", "language.kept")


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their own columns only."""
    return identify(docs, **options).where("language.kept").select(
        *[c for c in docs.columns if c != "language"])
