"""Documents whose word shingles overlap: a join on parity sketches.

A set's sketch is what its shingles' hashes give when they are combined by exclusive
or: equal shingles of two sets cancel, so two sketches differ by the shingles that are
in one set only. It is used in two ways. As bits (one bit a shingle), the Hamming
distance of two sketches is never more than the symmetric difference of the sets. And
cut into pieces (by the shingle's hash, with whole hashes combined), at most as many
pieces differ as there are shingles in one set only; a similarity allows a number of
these, so with more pieces than that some piece is equal (the pigeonhole principle).

* Sets of equal content are one class. Sizes fall into bands; two sets that may be
  linked are in the same or in neighbouring bands, so a set gives its pieces for its own
  band and the next larger one.
* Classes with an equal piece form a group; equal groups count once. In each group pairs
  are tested by the Hamming distance of their sketches, only as many as can join what is
  not joined yet, and those that pass are compared exactly, from the whole texts.
* A group is looked at again where such a pair turned out to be no link, then only its classes
  that are in such pairs, or as a whole where it is so large that not all its blocks have met:
  for links between components that the links so far leave apart, at last for all pairs that
  pass the test.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslex.llm.common import lean, picked, slices, small_batches, text_of
from crosslex.llm.components import components
from crosslex.sources import workspace

#: Up to so many ids are sent to all tasks (8 MB); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: A group is compared in blocks of so many classes.
BLOCK = 2_048
#: Rows of a group that a task holds back to see whether the group goes on.
HELD = 100_000
#: Pieces with so few shingles are left out where the others are enough.
LIGHT = 1

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PRIME = 0x100000001B3


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of a public generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64) + np.uint64(1)
_BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the prime and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < size:
        for i, step in enumerate((_PRIME, pow(_PRIME, -1, 1 << 64))):
            table = np.full(size + size // 2, step, np.uint64)
            table[0] = 1
            _POWERS[i] = np.multiply.accumulate(table)
    return _POWERS[0], _POWERS[1]


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted.

    Words are what blanks leave, A-Z in lower case. A text of fewer words than a shingle
    has is one shingle; one without words has none.
    """
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"".join(e + b" " for e in encoded), np.uint8)
    if not len(raw):
        return []
    ends_of_texts = np.cumsum([len(e) + 1 for e in encoded])
    inside = np.concatenate([[False], ~_BLANK[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_LOWER[raw] * power[:len(raw)])])
    word = mix((sums[ends] - sums[starts]) * inverse[starts])
    first = np.searchsorted(starts, np.concatenate([[0], ends_of_texts[:-1]]))
    last = np.append(first[1:], len(starts))
    run = word.copy()
    for j in range(1, words):
        run = mix(run[:-1] * _ODD + word[j:]) if len(run) > 1 else run[:0]
    sets = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= words:
            sets.append(np.unique(run[a:b - words + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for x in word[a:b]:
                whole = mix(whole * _ODD + x)
            sets.append(whole)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def class_of(shingles: np.ndarray) -> int:
    """A number for the content of a set, as a signed 64-bit integer."""
    own = mix(np.array([np.sum(mix(shingles + _ODD)) + np.uint64(len(shingles))], np.uint64))
    return int(own.astype(np.int64)[0])


class Bands:
    """Size bands, and the pieces of each, for a least similarity in per cent."""

    def __init__(self, percent: int):
        self.percent = percent
        self.starts = [1, 2]

    def allowed(self, both: int) -> int:
        """Shingles that may be in one set only, for sets of ``both`` shingles together."""
        return both * (100 - self.percent) // (100 + self.percent)

    def band(self, size: int) -> int:
        while self.starts[-1] <= size:
            last = self.starts[-1]
            self.starts.append(max(last + 1, 100 * (last - 1) // self.percent + 1))
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def pieces(self, band: int) -> int:
        """More than may differ, by a quarter, so that light ones can be left out."""
        while len(self.starts) < band + 2:
            self.band(self.starts[-1])
        most = self.allowed(2 * (self.starts[band + 1] - 1))
        return most + 1 + -(-most // 4)

    def split(self, shingles: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, combined hash and weight of each piece of a sorted set, empty ones too."""
        count = self.pieces(band)
        place = ((shingles >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
        weight = np.bincount(place, minlength=count)
        value = np.zeros(count, np.uint64)
        full = np.flatnonzero(weight)
        begin = np.concatenate([[0], np.cumsum(weight[full])[:-1]])
        value[full] = np.bitwise_xor.reduceat(shingles, begin)
        return np.arange(count), value, weight

    def lacks(self, shingles: np.ndarray) -> bool:
        """Whether leaving out light pieces could lose a link to a set that is no larger."""
        band = self.band(len(shingles))
        _, _, weight = self.split(shingles, band)
        light = int((weight <= LIGHT).sum())
        return light > len(weight) - self.allowed(2 * len(shingles)) - 1

    def keys(self, shingles: np.ndarray, every: frozenset[int]) -> np.ndarray:
        """Keys of the set's pieces, in its own band and the next one."""
        own, found = self.band(len(shingles)), []
        for band in (own, own + 1):
            number, value, weight = self.split(shingles, band)
            tag = mix((number + (band << 32)).astype(np.uint64) * _ODD)
            key = mix(value ^ tag)
            found.append(key if band in every else key[weight > LIGHT])
        return np.concatenate(found).astype(np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles by bit; two bits a shingle or more, a power of two of them."""
    words = max(1, 1 << max(0, (2 * len(shingles) - 1).bit_length() - 6))
    bit = shingles & np.uint64(64 * words - 1)
    out = np.zeros(words, np.uint64)
    np.bitwise_xor.at(out, (bit >> np.uint64(6)).astype(np.int64),
                      np.uint64(1) << (bit & np.uint64(63)))
    return out


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """A sketch of fewer words: the parity of what falls together."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def _described(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``id, text_hash, n, cls, band, lacks`` of each row; ``cls`` null without shingles."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for part in slices(batches):
            sets = shingle_sets(part.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays([
                part.column("id"), part.column("text_hash"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([bands.band(len(s)) if len(s) else None for s in sets], pa.int32()),
                pa.array([bool(len(s)) and bands.lacks(s) for s in sets], pa.bool_()),
            ], names=["id", "text_hash", "n", "cls", "band", "lacks"])

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, T.StructType([
        docs.schema["id"], T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()), T.StructField("cls", T.LongType()),
        T.StructField("band", T.IntegerType()), T.StructField("lacks", T.BooleanType())]))


def _piece_keys(docs: DataFrame, words: int, percent: int, every: frozenset[int]) -> DataFrame:
    """``key, cls`` of all pieces; copies within a batch give theirs once."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            seen: set[int] = set()
            for part in slices([batch]):
                keys, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for s in shingle_sets(part.column("text").to_pylist(), words):
                    if len(s) and (own := class_of(s)) not in seen:
                        seen.add(own)
                        keys.append(bands.keys(s, every))
                        owners.append(np.full(len(keys[-1]), own, np.int64))
                yield pa.RecordBatch.from_pydict({
                    "key": np.concatenate(keys), "cls": np.concatenate(owners)})

    return docs.select("text").mapInArrow(run, "key long, cls long")


def _groups(pieces: DataFrame) -> DataFrame:
    """``gid, cls``: the classes that share a piece, where there are several.

    Rows come sorted by key; groups of the same classes get the same number and are given
    once a task. A group too long to hold back is given row by row, numbered by its key.
    """
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_cls = np.zeros(0, np.int64), np.zeros(0, np.int64)
        long_key: int | None = None
        seen: set[int] = set()

        def given(key: np.ndarray, cls: np.ndarray) -> Iterator[pa.RecordBatch]:
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(begin, len(key)))
            sums = np.add.reduceat(mix(cls.astype(np.uint64)), begin)
            several = np.flatnonzero(size > 1)
            _, once = np.unique(sums[several], return_index=True)
            runs = several[np.sort(once)]
            number = mix(sums[runs] + size[runs].astype(np.uint64)).astype(np.int64)
            fresh = np.array([x not in seen for x in number.tolist()], bool)
            if len(seen) > 1_000_000:
                seen.clear()
            seen.update(number.tolist())
            runs, number = runs[fresh], number[fresh]
            if len(runs):
                at = np.repeat(begin[runs] - np.concatenate([[0], np.cumsum(size[runs])[:-1]]),
                               size[runs]) + np.arange(size[runs].sum())
                yield pa.RecordBatch.from_pydict({
                    "gid": np.repeat(number, size[runs]), "cls": cls[at]})

        for batch in batches:
            key = np.concatenate([held_key, batch.column(0).to_numpy()])
            cls = np.concatenate([held_cls, batch.column(1).to_numpy()])
            if not len(key):
                continue
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])])
            key, cls = key[new], cls[new]
            if long_key is not None:
                more = key == long_key
                if more.any():
                    yield pa.RecordBatch.from_pydict({"gid": key[more], "cls": cls[more]})
                    key, cls = key[~more], cls[~more]
                if not len(key):
                    held_key, held_cls = key, cls
                    continue
                long_key = None
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from given(key[:cut], cls[:cut])
            held_key, held_cls = key[cut:], cls[cut:]
            if len(held_key) > HELD:
                yield pa.RecordBatch.from_pydict({"gid": held_key, "cls": held_cls})
                long_key, held_key, held_cls = int(held_key[0]), held_key[:0], held_cls[:0]
        if len(held_key):
            yield from given(held_key, held_cls)

    ordered = pieces.repartition("key").sortWithinPartitions("key", "cls")
    return ordered.mapInArrow(run, "gid long, cls long").distinct()


def _features(docs: DataFrame, wanted: DataFrame, words: int, bits: bool) -> DataFrame:
    """``cls`` and its shingles (or sketch, as bytes) for the wanted ``cls, rep``."""
    rows = wanted.select(F.col("rep").alias("id"), F.col("cls").alias("want"))
    if wanted.count() <= BROADCAST_IDS:
        rows = F.broadcast(rows)
    kind = pa.binary() if bits else pa.list_(pa.int64())

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done: set[int] = set()
            for part in slices([batch]):
                own, values = [], []
                for s, want in zip(shingle_sets(part.column("text").to_pylist(), words),
                                   part.column("want").to_pylist()):
                    if want not in done and len(s) and class_of(s) == want:
                        done.add(want)
                        own.append(want)
                        values.append(sketch(s).tobytes() if bits else s.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(values, kind)], names=["cls", "value"])

    return docs.join(rows, "id").select("text", "want").mapInArrow(
        run, "cls long, value " + ("binary" if bits else "array<long>"))


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, words: int,
              percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` of classes that are linked, compared shingle by shingle."""
    ends = pairs.select(F.col("a").alias("cls")).unionAll(
        pairs.select(F.col("b").alias("cls"))).distinct()
    wanted = workspace.settle(ends.join(classes, "cls").select("cls", "rep"), "wanted")
    sets = workspace.settle(_features(docs, wanted, words, bits=False), "sets")
    joined = pairs.join(sets.select(F.col("cls").alias("a"), F.col("value").alias("sa")), "a").join(
        sets.select(F.col("cls").alias("b"), F.col("value").alias("sb")), "b")
    counted = joined.select(
        "a", "b", F.size(F.array_intersect("sa", "sb")).alias("common"),
        (F.size("sa") + F.size("sb")).alias("both"))
    return workspace.settle(counted.where(
        100 * F.col("common") >= percent * (F.col("both") - F.col("common"))
    ).select("a", "b").distinct(), "linked")


#: Rows and bytes of groups that are compared at a time, unless one group has more.
AT_ONCE, AT_ONCE_BYTES = 16_384, 1 << 23


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of sorted batches, several batches at a time, never parting those of one
    ``gid, lo, hi``."""
    held: list[pa.RecordBatch] = []
    count = size = 0
    for batch in batches:
        held.append(batch)
        count, size = count + batch.num_rows, size + batch.nbytes
        if count < AT_ONCE and size < AT_ONCE_BYTES:
            continue
        rows = pa.concat_batches(held)
        tags = [rows.column(n).to_numpy() for n in ("gid", "lo", "hi")]
        changes = np.flatnonzero(np.any([t[1:] != t[:-1] for t in tags], axis=0))
        begin = int(changes[-1]) + 1 if len(changes) else 0
        if begin:
            yield rows.slice(0, begin)
        held = [rows.slice(begin)]
        count, size = held[0].num_rows, held[0].nbytes
    rows = pa.concat_batches(held) if held else None
    if rows is not None and rows.num_rows:
        yield rows


#: Groups of up to so many classes are compared together with others as large.
SMALL = 64


def _met(rows: pa.RecordBatch, percent: int, forest: bool) -> Iterator[tuple]:
    """``gid, a, b`` of the pairs that pass the tests, in whole groups."""
    gid, lo, hi, block, cls, comp, n = (
        rows.column(x).to_numpy() for x in ("gid", "lo", "hi", "block", "cls", "comp", "n"))
    ends = rows.column("value").to_numpy(zero_copy_only=False)
    width = np.array([len(x) // 8 for x in ends], np.int64)
    place = np.cumsum(width) - width
    words = np.frombuffer(b"".join(ends), np.uint64)
    begin = np.flatnonzero(np.concatenate([[True], (gid[1:] != gid[:-1]) | (
        lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
    size = np.diff(np.append(begin, len(gid)))
    least = np.minimum.reduceat(width, begin)
    for g in np.flatnonzero(size > SMALL).tolist():
        own = slice(begin[g], begin[g] + size[g])
        bits = np.stack([fold(words[p:p + w], least[g]) for p, w in zip(
            place[own].tolist(), width[own].tolist())])
        found = _met_in_one(bits, n[own], block[own], comp[own].copy(), lo[own][0] != hi[own][0],
                            percent, forest)
        for i, at in found:
            a, b = cls[own][at], cls[own][i]
            yield np.full(len(at), gid[begin[g]]), np.minimum(a, b), np.maximum(a, b)
    kind = np.where((size > 1) & (size <= SMALL), size * (1 << 40) + least, 0)
    for one in np.unique(kind[kind > 0]).tolist():
        k, w = divmod(one, 1 << 40)
        at = begin[kind == one][:, None] + np.arange(k)
        bits = np.empty((*at.shape, w), np.uint64)
        for wide in np.unique(width[at]).tolist():
            here = width[at] == wide
            own = words[place[at[here]][:, None] + np.arange(wide)]
            bits[here] = np.bitwise_xor.reduce(own.reshape(len(own), -1, w), axis=1)
        yield from _met_in_many(bits, n[at], block[at], comp[at], (lo != hi)[at[:, 0]], cls[at],
                                gid[at[:, 0]], percent, forest)


def _met_in_one(bits, n, block, comp, apart, percent, forest) -> Iterator[tuple[int, np.ndarray]]:
    """A member of a group, and those behind it that it passes the tests with."""
    for i in range(len(n) - 1):
        near = comp[i + 1:] != comp[i]
        if apart:
            near &= block[i + 1:] != block[i]
        at = np.flatnonzero(near) + i + 1
        small, large = np.minimum(n[i], n[at]), np.maximum(n[i], n[at])
        at = at[100 * small >= percent * large]
        if not len(at):
            continue
        distance = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
        at = at[distance * (100 + percent) <= (n[at] + n[i]) * (100 - percent)]
        if forest:  # one to each component, which then is this one's
            _, once = np.unique(comp[at], return_index=True)
            joined = comp[at[once]]
            at = at[np.sort(once)]
            if len(joined):
                comp[np.isin(comp, joined)] = comp[i]
        if len(at):
            yield i, at


def _met_in_many(bits, n, block, comp, apart, cls, gid, percent, forest) -> Iterator[tuple]:
    """The same for many groups of equal size, a row each: ``gid, a, b``."""
    for i in range(n.shape[1] - 1):
        own, rest = slice(i, i + 1), slice(i + 1, None)
        near = (comp[:, rest] != comp[:, own]) & (
            ~apart[:, None] | (block[:, rest] != block[:, own]))
        small, large = np.minimum(n[:, own], n[:, rest]), np.maximum(n[:, own], n[:, rest])
        near &= 100 * small >= percent * large
        g, j = np.nonzero(near)
        if not len(g):
            continue
        j += i + 1
        distance = np.bitwise_count(bits[g, j] ^ bits[g, i]).sum(axis=1, dtype=np.int64)
        passed = distance * (100 + percent) <= (n[g, j] + n[g, i]) * (100 - percent)
        g, j = g[passed], j[passed]
        if forest and len(g):
            near[:] = False
            near[g, j - i - 1] = True
            theirs = comp[:, rest]
            for x in range(1, near.shape[1]):
                near[:, x] &= ~(near[:, :x] & (theirs[:, :x] == theirs[:, x:x + 1])).any(axis=1)
            g, j = np.nonzero(near)
            j += i + 1
            joined = ((comp[:, :, None] == theirs[:, None, :]) & near[:, None, :]).any(axis=2)
            comp = np.where(joined, comp[:, own], comp)
        if len(g):
            a, b = cls[g, j], cls[g, i]
            yield gid[g], np.minimum(a, b), np.maximum(a, b)


def _between(members: DataFrame, percent: int, forest: bool, whole: bool) -> DataFrame:
    """Pairs ``gid, a, b`` of classes of one group in different components that pass the size
    and Hamming tests; with ``forest`` only as many as can join components within a block.

    A group is parted into blocks; ``whole``: all of them meet pairwise, else each meets
    itself and the first.
    """
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches):
            found = list(_met(groups, percent, forest))
            if found:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(x)) for x in zip(*found)], names=["gid", "a", "b"])

    # A class goes once to each pair of blocks that its own is part of.
    own, parts = F.col("block"), F.col("parts")
    others = F.sequence(F.lit(0), parts - 1) if whole else F.when(
        own == 0, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0), own))
    placed = members.withColumn("parts", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("cls"), parts).cast("int")).withColumn(
        "other", F.explode(others)).select(
        "gid", F.least(own, "other").alias("lo"), F.greatest(own, "other").alias("hi"),
        "block", "cls", "comp", "n", "value")
    return placed.repartition("gid", "lo", "hi").sortWithinPartitions(
        "gid", "lo", "hi").mapInArrow(run, "gid long, a long, b long").distinct()


def linked(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``<id>, n_shingles, component_id`` for every row: :func:`report` without the rest."""
    return report(docs, words, percent, id_col, text_col).select(
        id_col, "n_shingles", "component_id")


def report(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``<id>, n_shingles, component_id, text_hash, group`` for every row.

    Two rows are linked if ``100 * common >= percent * all`` of their distinct shingles of
    ``words`` words. ``component_id`` is the smallest id that links lead to. Rows without
    words have no shingles and are linked with nothing, as are rows without id, whose
    component is null. Repeated rows are copies of one another. Texts are taken whole; no
    group, however large, loses a link. ``group`` is a number of the component that, unlike its
    smallest id, no other component has; ``text_hash`` tells rows of one id apart.
    """
    small_batches(docs.sparkSession)
    rows = picked(docs, id=id_col, text=text_of(text_col))
    described = workspace.settle(_described(rows, words, percent), "described")
    named = rows.where(F.col("id").isNotNull())
    classes = workspace.settle(described.where("cls is not null and id is not null").groupBy(
        "cls").agg(F.min("id").alias("rep"), F.max("n").alias("n")), "classes")
    # Bands in which light pieces are needed: one row a band.
    every = frozenset(r["band"] for r in described.where("lacks").select("band").distinct().collect())
    groups = workspace.settle(_groups(_piece_keys(named, words, percent, every)), "groups")

    sizes = groups.groupBy("gid").agg(F.count(F.lit(1)).alias("size"))
    members = groups.join(sizes, "gid")
    in_groups = workspace.settle(
        groups.select("cls").distinct().join(classes, "cls"), "in_groups")
    sketches = workspace.settle(_features(named, in_groups, words, bits=True).join(
        in_groups.select("cls", "n"), "cls"), "sketches")
    described_members = members.join(sketches, "cls")

    pairs = workspace.settle(_between(described_members.withColumn("comp", F.col("cls")),
                                      percent, forest=True, whole=False), "pairs")
    tested = pairs.select("a", "b").distinct()
    links = _verified(named, tested, classes, words, percent)
    # Groups of up to two blocks have met whole: what was not tested in them are pairs of classes
    # that found pairs join, which matters where one of these failed.
    failed = pairs.join(links, ["a", "b"], "left_anti").select("gid").distinct()
    again = members.where(F.col("size") > 2 * BLOCK).select("gid", "cls").unionAll(
        pairs.join(failed, "gid").select(
            "gid", F.explode(F.array("a", "b")).alias("cls"))).distinct()
    for forest in (True, False):
        again = workspace.settle(again, "again")
        if again.isEmpty():
            break
        placed = again.join(components(links).select(
            F.col("node").alias("cls"), "component"), "cls", "left").withColumn(
            "comp", F.coalesce("component", "cls")).drop("component")
        mixed = placed.groupBy("gid").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"),
            F.count(F.lit(1)).alias("size")).where("low != high").select("gid", "size")
        left = workspace.settle(placed.join(mixed, "gid"), "left")
        pairs = workspace.settle(_between(
            left.join(sketches, "cls"), percent, forest, whole=True), "pairs")
        untested = workspace.settle(pairs.select("a", "b").distinct().join(
            tested, ["a", "b"], "left_anti"), "untested")
        more = _verified(named, untested, classes, words, percent)
        tested = workspace.settle(tested.unionAll(untested), "tested")
        links = workspace.settle(links.unionAll(more), "links")
        # All others have met now; pairs that failed before count as well.
        failed = pairs.join(links, ["a", "b"], "left_anti").select("gid").distinct()
        again = left.join(failed, "gid").select("gid", "cls")
    found = components(links)

    smallest = found.join(classes, found["node"] == classes["cls"]).groupBy("component").agg(
        F.min("rep").alias("component_id"))
    of_class = classes.join(found.withColumnRenamed("node", "cls"), "cls", "left").join(
        smallest, "component", "left").select(
        "cls", F.coalesce("component_id", "rep").alias("component_id"),
        F.coalesce("component", "cls").alias("group"))
    return described.join(of_class, "cls", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        "text_hash", "group")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One document of each group of linked ones: that of the smallest id.

    Of rows of that id one text stays, and of rows with the same id and text one. Rows whose
    id another text has as well are told apart by their text. Rows without words or without id
    all stay.
    """
    found = workspace.settle(report(docs, words, percent, id_col, text_col), "near").where(
        F.col("group").isNotNull() & F.col(id_col).isNotNull())
    key = [id_col, "text_hash"]
    # A sum by group, partial before its shuffle; then rows meet it by their own id and text.
    kept_rows = found.groupBy("group").agg(F.min(F.struct(*key)).alias("kept")).select("kept.*")
    gone = found.select(*key).distinct().join(kept_rows, key, "left_anti")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    theirs = gone.select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
    text_hash = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    kept = docs.join(theirs, (docs[id_col] == F.col("_id")) & (text_hash == F.col("_hash")), "left_anti")
    repeated = found.groupBy(*key).count().where("count > 1").select(
        F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
    if repeated.isEmpty():
        return kept
    again = (kept[id_col] == F.col("_id")) & (
        F.xxhash64(F.coalesce(kept[text_col], F.lit(""))) == F.col("_hash"))
    return kept.join(repeated, again, "left_anti").unionByName(
        kept.join(repeated, again, "left_semi").dropDuplicates([id_col, text_col]))
