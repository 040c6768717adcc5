"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A document's words are fed to it
one after the other; the state tells the longest run that ends at the word and occurs in
some item. Where a run is as long as a window, the words of the window are hit.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslex.llm.common import SLICE, held, picked, slices, small_batches, text_of

#: Words of a window.
WINDOW = 10
#: Words of items in one automaton; more items make more blocks, each a pass over the documents.
BLOCK_WORDS = 400_000
#: Longer items are cut into pieces of this many words, which share a window less one.
PIECE_WORDS = 20_000

# Words: digits, letters, all beyond ASCII; A-Z in lower case; everything else a blank.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass(frozen=True)
class Hits:
    """What was found in one document."""

    n_words: int
    spans: list[tuple[int, int]]  # of words, first and one past the last, in order
    items: frozenset


class Automaton:
    """Generalised suffix automaton over words; states are numbers, the root is 0.

    ``full`` names, for a state, the items of which every run of the state's length is
    part; ``whole`` the items shorter than a window that end with the state.
    """

    def __init__(self, items: list[tuple[Any, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        owners: list[set] = [set()]
        short: list[set] = [set()]
        for item, words in items:
            last = 0
            for word in words:
                last = self._add(last, self.ids.setdefault(word, len(self.ids)), owners, short)
                owners[last].add(item)
            if 0 < len(words) < window:
                short[last].add(item)
        # A state's runs occur wherever those of the states that link to it do.
        order = sorted(range(1, len(self.size)), key=lambda s: -self.size[s])
        for state in order:
            owners[self.link[state]] |= owners[state]
        # The state whose runs a window's length falls into, going up from each state.
        self.at_window = [0] * len(self.size)
        self.short_at: list[int] = [0] * len(self.size)
        for state in reversed(order):
            up = self.link[state]
            if self.size[state] >= window:
                self.at_window[state] = state if self.size[up] < window else self.at_window[up]
            self.short_at[state] = state if short[state] else self.short_at[up]
        # At these states there is something to report.
        self.report = [self.size[s] >= window or self.short_at[s] > 0
                       for s in range(len(self.size))]
        self.owners, self.short = owners, short

    def _add(self, last: int, word: int, owners: list[set], short: list[set]) -> int:
        at = self.next[last].get(word)
        if at is not None:
            if self.size[at] == self.size[last] + 1:
                return at
            return self._split(last, word, at, owners, short)
        new = self._state(self.size[last] + 1, {}, owners, short)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][word]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(
                p, word, q, owners, short)
        return new

    def _state(self, size: int, following: dict, owners: list[set], short: list[set]) -> int:
        self.next.append(following)
        self.size.append(size)
        self.link.append(0)
        owners.append(set())
        short.append(set())
        return len(self.size) - 1

    def _split(self, p: int, word: int, q: int, owners: list[set], short: list[set]) -> int:
        copy = self._state(self.size[p] + 1, dict(self.next[q]), owners, short)
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans of hit words and the items hit, of one document."""
        following, link, size, window = self.next, self.link, self.size, self.window
        report, found, items = self.report, [], set()
        state = length = 0
        for at, word in enumerate(map(self.ids.get, words)):
            if word is None:
                state = length = 0
                continue
            to = following[state].get(word)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = following[state].get(word)
                if to is None:
                    length = 0
                    continue
                length = size[state]
            state = to
            length += 1
            if report[state]:
                stop = at + 1
                if length >= window:
                    found.append((stop - window, stop))
                    items |= self.owners[self.at_window[state]]
                whole = self.short_at[state]
                if whole == state and length < size[state]:
                    whole = self.short_at[link[state]]
                if whole:
                    found.append((stop - size[whole], stop))
                while whole:
                    items |= self.short[whole]
                    whole = self.short_at[link[whole]]
        return merge(found), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


@held
def _automaton(block: tuple[list, int]) -> Automaton:
    items, window = block
    return Automaton([(item, text.split(b" ") if text else []) for item, text in items], window)


def item_blocks(items: DataFrame, window: int, block_words: int, id_col: str,
                text_col: str) -> Iterator[tuple[list, int]]:
    """The items in blocks of about ``block_words`` words, one at a time.

    Words are cut out in Spark; what comes to the driver is one block, whose size the
    parameter bounds however many items there are. Long items come in pieces that share
    ``window - 1`` words, so every window is inside a piece.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids, texts, sizes = [], [], []
            for item, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                words = words_of(text)
                for start in range(0, max(len(words) - window + 1, 1), PIECE_WORDS):
                    piece = words[start:start + PIECE_WORDS + window - 1]
                    ids.append(item)
                    texts.append(b" ".join(piece))
                    sizes.append(len(piece))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, part.column("id").type), pa.array(texts, pa.binary()),
                 pa.array(sizes, pa.int64())], names=["id", "words", "n"])

    rows = picked(items, id=id_col, text=text_of(text_col))
    cut = rows.mapInArrow(pieces, T.StructType([
        rows.schema["id"], T.StructField("words", T.BinaryType()),
        T.StructField("n", T.LongType())])).where("n > 0")
    total = cut.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    spread = cut.withColumn("block", F.pmod(F.xxhash64("id", "words"), F.lit(blocks)))
    for block in range(blocks):
        found = spread.where(F.col("block") == block).distinct().collect()
        yield sorted(((r["id"], bytes(r["words"])) for r in found),
                     key=lambda x: (x[1], str(x[0]))), window


def _matcher(docs: DataFrame, block: tuple[list, int]):
    """Column function: words, hit spans and items hit, of one block of items, of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    # Only the text goes to Python.
    @F.arrow_udf("struct<n:bigint,starts:array<bigint>,stops:array<bigint>,items:array<string>>")
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton(shared.value)
        longs = pa.list_(pa.int64())
        for batch in batches:
            counts, starts, stops, items = [], [], [], []
            for start in range(0, len(batch), SLICE):
                for text in batch.slice(start, SLICE).to_pylist():
                    words = words_of(text or "")
                    spans, hit = automaton.match(words)
                    counts.append(len(words))
                    starts.append([a for a, _ in spans])
                    stops.append([b for _, b in spans])
                    items.append(sorted(str(i) for i in hit if i is not None))
            yield pa.StructArray.from_arrays([
                pa.array(counts, pa.int64()), pa.array(starts, longs), pa.array(stops, longs),
                pa.array(items, pa.list_(pa.string()))], names=["n", "starts", "stops", "items"])

    # Called so, a filter on what was found does not look for it a second time.
    return match.asNondeterministic()


def find_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW,
               block_words: int = BLOCK_WORDS, text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents with ``contamination`` beside them: ``n_words``, ``spans`` of hit words
    (``start``, ``stop``) in order, and ``items``, the ids hit, as strings in order.

    A window is ``window`` words of an item; an item of fewer words is one window, one
    without words none. Null texts have no words. Items without id are looked for, but not
    named. Documents are neither moved nor joined: each block of items adds its spans to the
    row. Every other column is returned; one named ``contamination`` is replaced.
    """
    small_batches(docs.sparkSession)
    span = "array<struct<start:bigint,stop:bigint>>"
    rest = docs.drop("contamination")
    rows = rest.withColumns({
        "_llm_words": F.lit(0).cast("long"), "_llm_spans": F.array().cast(span),
        "_llm_named": F.array().cast("array<string>")})
    for block in item_blocks(items, window, block_words, item_id, item_text):
        match = _matcher(docs, block)
        rows = rows.withColumn("_llm_found", match(F.col(text_col))).select(
            *rest.columns, F.col("_llm_found.n").alias("_llm_words"),
            F.concat("_llm_spans", F.zip_with(
                "_llm_found.starts", "_llm_found.stops",
                lambda a, b: F.struct(a.alias("start"), b.alias("stop")))).alias("_llm_spans"),
            F.concat("_llm_named", "_llm_found.items").alias("_llm_named"))
    ordered = F.array_sort("_llm_spans")
    joined = F.aggregate(ordered, F.array().cast(span), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["stop"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"),
            F.greatest(F.element_at(acc, -1)["stop"], s["stop"]).alias("stop"))))
    ).otherwise(F.concat(acc, F.array(s))))
    return rows.select(*rest.columns, F.struct(
        F.col("_llm_words").alias("n_words"), joined.alias("spans"),
        F.array_sort(F.array_distinct("_llm_named")).alias("items")).alias("contamination"))


def contamination_report(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                         id_col: str = "doc_id", **options: Any) -> DataFrame:
    """``<id>, n_words, n_hit, n_items, items_sha256, contaminated`` for every row."""
    found = find_spans(picked(docs, id=id_col, text=options.pop("text_col", "text")), items,
                       window, **options)
    hit = F.aggregate("contamination.spans", F.lit(0).cast("long"),
                      lambda acc, s: acc + s["stop"] - s["start"])
    # The hit words are needed twice: once worked out, kept as a column.
    counted = found.select("id", "contamination", hit.alias("n_hit"))
    return counted.select(
        F.col("id").alias(id_col), F.col("contamination.n_words").alias("n_words"), "n_hit",
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


_STRIP = bytes(48 if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    word = np.frombuffer(data.translate(_STRIP), np.uint8) == 48
    edges = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    kept, at = [], 0
    for start, stop in spans:
        kept.append(data[at:begins[start]])
        at = int(ends[stop - 1])
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  max_share: float = 0.5, text_col: str = "text", **options: Any) -> DataFrame:
    """The documents without hit spans; those with more than ``max_share`` of their words hit go.

    Texts without a hit are returned as they are, null ones too, and all other columns.
    """
    found = find_spans(docs, items, window, text_col=text_col, **options)
    hit = F.aggregate("contamination.spans", F.lit(0).cast("long"),
                      lambda acc, s: acc + s["stop"] - s["start"])
    kept = found.withColumn("_llm_hit", hit).where(
        F.col("_llm_hit") <= F.col("contamination.n_words") * F.lit(max_share))
    spans = F.when(F.col("_llm_hit") > 0, F.col("contamination.spans"))

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, hits in batches:
            yield pa.array([
                None if found is None else cut_words(text, [(s["start"], s["stop"]) for s in found])
                for text, found in zip(texts.to_pylist(), hits.to_pylist())], pa.string())

    # Texts without a hit do not go to Python again.
    marked = kept.withColumn("_llm_cut", spans).withColumn("_llm_new", cut(
        F.when(F.col("_llm_cut").isNotNull(), F.col(text_col)), F.col("_llm_cut")))
    return marked.select(*[
        (F.coalesce("_llm_new", text_col) if c == text_col else F.col(c)).alias(c)
        for c in docs.columns if c != "contamination"])
