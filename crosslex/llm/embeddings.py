"""Near-duplicate vectors: binary codes by iterative quantisation, tables of their substrings.

Unit vectors are centred and rotated so that their signs are balanced bits that lose as
little as possible; several rotations are learned on a bounded sample. A table holds the
vectors by one substring of a code. Vectors of one bucket are compared by the cosine of
the vectors themselves, in double precision.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosslex.llm.common import picked
from crosslex.llm.components import components
from crosslex.sources import workspace

#: Vectors that rotations are learned from, at most; and bytes of them.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 32_000_000
#: Pairs that are made to find how many tables there must be, at most.
MADE_PAIRS = 2_000
#: Vectors are hashed with their mean where it would take so many times the tables without it.
MOST_TABLES = 10
#: Vectors of a bucket are compared in blocks of so many.
BLOCK = 1_024


@dataclass(frozen=True)
class Codes:
    """Rotations and the substrings of their bits that the tables are keyed by."""

    mean: np.ndarray
    rotations: np.ndarray  # dimension x all bits
    bits: int
    tables: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """Key of each vector in each table."""
        signs = ((unit - self.mean) @ self.rotations > 0)[:, :self.bits * self.tables]
        powers = 1 << np.arange(self.bits, dtype=np.int64)
        return signs.reshape(len(unit), self.tables, self.bits) @ powers


def rotation(centred: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """A rotation for which the signs of the rotated vectors are closest to them.

    Signs and rotation are fitted in turn: given the signs, the best rotation comes from a
    singular value decomposition.
    """
    size = centred.shape[1]
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    for _ in range(rounds if len(centred) else 0):
        signs = np.where(centred @ turn > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(centred.T @ signs)
        turn = u @ v
    return turn


def _angles(sample: np.ndarray, mean: np.ndarray, cosine: float) -> np.ndarray:
    """Angles, after the mean is taken off, of pairs made at the cosine from vectors of the sample.

    The second of a pair is disturbed in all directions alike, square to the first.
    """
    if not len(sample) or sample.shape[1] < 2:
        return np.array([math.acos(cosine)])
    first = sample[:MADE_PAIRS]
    noise = np.random.default_rng(0).standard_normal(first.shape)
    noise -= (noise * first).sum(axis=1, keepdims=True) * first
    noise /= np.maximum(np.sqrt((noise * noise).sum(axis=1, keepdims=True)), 1e-300)
    second = cosine * first + math.sqrt(max(0.0, 1 - cosine * cosine)) * noise
    a, b = first - mean, second - mean
    lengths = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    # A vector that is all mean has no direction left.
    found = (a * b).sum(axis=1)[lengths > 1e-12] / lengths[lengths > 1e-12]
    return np.arccos(np.clip(found, -1, 1)) if len(found) else np.array([math.acos(cosine)])


def learn(sample: np.ndarray, vectors: int, cosine: float) -> Codes:
    """Codes for about ``vectors`` vectors.

    Keys have as many bits as the number of vectors asks for, so that a bucket holds a few
    unlike vectors at any size. Bits of two vectors at the least cosine are the same less often
    where what the vectors have in common is large, as that is taken off first: pairs are made
    from vectors of the sample, and there are as many tables as let them miss all tables in
    one of twenty cases, on average over the pairs. Closer pairs are missed far less. Where
    that takes too many tables the mean stays on: buckets are larger then, but none is cut.
    """
    size = sample.shape[1]
    bits = max(12, min(32, math.ceil(math.log2(max(vectors, 2)))))
    mean = sample.mean(axis=0) if len(sample) else np.zeros(size)
    same = (1 - _angles(sample, mean, cosine) / math.pi) ** bits
    least = math.ceil(math.log(0.05) / math.log(1 - (1 - math.acos(cosine) / math.pi) ** bits))
    tables = least
    while ((1 - same) ** tables).mean() > 0.05 and tables < MOST_TABLES * least:
        tables += 1
    if ((1 - same) ** tables).mean() > 0.05:
        mean, tables = np.zeros(size), least
    turns = [rotation(sample - mean, seed) for seed in range(-(-bits * tables // size))]
    # Bits of one key come from all directions: shuffled, alike every time.
    every = np.concatenate(turns, axis=1)
    order = np.concatenate([np.random.default_rng(1_000 + i).permutation(size) + i * size
                            for i in range(len(turns))])
    return Codes(mean, every[:, order], bits, tables)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Unit vectors, filled up with zeros to one size."""
    out = np.zeros((len(column), size))
    for i, row in enumerate(column.to_pylist()):
        out[i, :len(row)] = row
    # Scaled first, so that no square overflows or vanishes.
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _buckets(classes: DataFrame, codes: Codes, size: int) -> DataFrame:
    """``place, cls, copies, n, keys, vector``: each class in the bucket of each table."""
    shared = classes.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1_000):
                batch = whole.slice(start, 1_000)
                unit = _matrix(batch.column("vector"), size)
                length = np.array([len(v) for v in batch.column("vector").to_pylist()])
                keys = own.keys(unit)
                times = np.arange(len(unit)).repeat(own.tables)
                tag = (np.tile(np.arange(own.tables), len(unit)) << 52) | keys.reshape(-1)
                packed = [k.astype("<u4").tobytes() for k in keys]
                vectors = [v.tobytes() for v in unit]
                yield pa.RecordBatch.from_pydict({
                    "place": tag, "cls": batch.column("cls").take(pa.array(times)),
                    "copies": batch.column("copies").take(pa.array(times)),
                    "n": pa.array(length[times], pa.int32()),
                    "keys": pa.array(packed, pa.binary()).take(pa.array(times)),
                    "vector": pa.array(vectors, pa.binary()).take(pa.array(times))})

    return classes.mapInArrow(
        run, "place long, cls long, copies long, n int, keys binary, vector binary")


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As many of the links as join what they join, found by going along them."""
    linked = np.zeros((size, size), bool)
    linked[a, b] = linked[b, a] = True
    new = np.ones(size, bool)
    left, right = [], []
    for start in np.unique(a).tolist():
        if not new[start]:
            continue
        new[start], waiting = False, [start]
        while waiting:
            at = waiting.pop()
            onward = np.flatnonzero(linked[at] & new)
            new[onward] = False
            left.append(np.full(len(onward), at))
            right.append(onward)
            waiting += onward.tolist()
    return np.concatenate(left), np.concatenate(right)


def _compared(buckets: DataFrame, cosine: float) -> DataFrame:
    """``cls, links, other``: links found of a class in a bucket, and, in rows of their own,
    links that join the classes linked there.

    A pair is looked at in the first table whose bucket it shares, so no link counts twice.
    Buckets are streamed from sorted rows; a large one is parted into blocks that meet
    pairwise.
    """
    counts = buckets.groupBy("place").agg(F.count(F.lit(1)).alias("size")).where(
        F.col("size") > 1)
    parted = buckets.join(counts, "place").withColumn(
        "parts", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "place", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "cls", "copies", "n", "keys", "vector")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            tags = np.stack([batch.column(c).to_numpy() for c in ("place", "lo", "hi")], axis=1)
            edges = np.flatnonzero((tags[1:] != tags[:-1]).any(axis=1)) + 1
            begins = [0, *edges.tolist(), len(tags)]
            for a, b in zip(begins[:-1], begins[1:]):
                if a == b:
                    continue
                tag = tuple(tags[a].tolist())
                if held and tag != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = tag
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            k = group.num_rows
            if k < 2:
                continue
            columns = {c: group.column(c).to_pylist() for c in ("keys", "vector")}
            unit = np.stack([np.frombuffer(v, np.float64) for v in columns["vector"]])
            keys = np.stack([np.frombuffer(v, "<u4") for v in columns["keys"]])
            cls, copies = group.column("cls").to_numpy(), group.column("copies").to_numpy()
            length, block = group.column("n").to_numpy(), group.column("block").to_numpy()
            table = int(group.column("place")[0].as_py()) >> 52
            near = np.triu(unit @ unit.T >= cosine, 1)
            near &= length[:, None] == length[None, :]
            if group.column("lo")[0] != group.column("hi")[0]:
                near &= block[:, None] != block[None, :]
            a, b = np.nonzero(near)
            if table and len(a):
                before = np.zeros(len(a), bool)
                for t in range(table):
                    before |= keys[a, t] == keys[b, t]
                a, b = a[~before], b[~before]
            if not len(a):
                continue
            links = np.bincount(a, copies[b], k) + np.bincount(b, copies[a], k)
            some = np.flatnonzero(links)
            left, right = _forest(a, b, k)
            yield pa.RecordBatch.from_pydict({
                "cls": np.concatenate([cls[some], cls[left]]),
                "links": pa.array(np.concatenate([links[some], np.zeros(len(left))]).astype(np.int64)),
                "other": pa.array([*[None] * len(some), *cls[right].tolist()], pa.int64())})

    return parted.repartition("place", "lo", "hi").sortWithinPartitions(
        "place", "lo", "hi").mapInArrow(run, "cls long, links long, other long")


def near_vectors(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """``<id>, n_links, component_id, kept`` for every row.

    Two rows are linked if the cosine of their vectors is at least ``cosine``; no pair below
    it is. A vector that is null, empty, zero or holds null or non-finite components is
    linked with nothing, as is a row without id; vectors of different lengths are not linked
    with one another. Equal vectors are one class with a number of copies. ``component_id``
    is the smallest id that links lead to, ``kept`` tells whether it is the row's own.
    """
    rows = picked(vectors, id=id_col, vector=vector_col)
    size = F.size("vector")
    sound = (
        F.col("id").isNotNull() & F.col("vector").isNotNull() & (size > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                   & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0))
    tagged = rows.select("id", "vector", F.when(
        F.coalesce(sound, F.lit(False)), F.xxhash64("vector", size)).alias("cls"))
    classes = workspace.settle(
        tagged.where("cls is not null").groupBy("cls", "vector").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    about = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    count, width = about[0], about[1] or 1
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
    chosen = classes.where(F.pmod("cls", F.lit(1_000_003)) * count < 1.2 * most * 1_000_003)
    sample = chosen.select("vector").limit(most).toArrow().column("vector")
    codes = learn(_matrix(sample.combine_chunks(), width) if len(sample) else
                  np.zeros((0, width)), count, cosine)

    found = workspace.settle(_compared(_buckets(classes, codes, width), cosine), "found")
    links = found.where("other is null").groupBy("cls").agg(F.sum("links").alias("links"))
    parts = components(found.where("other is not null"), "cls", "other")
    placed = classes.select("cls", "rep", "copies").join(links, "cls", "left").join(
        parts.withColumnRenamed("node", "cls"), "cls", "left")
    smallest = placed.where("component is not null").groupBy("component").agg(
        F.min("rep").alias("least"))
    of_class = placed.join(smallest, "component", "left").select(
        "cls", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("least", "rep").alias("component_id"))
    result = tagged.select("id", "cls").join(of_class, "cls", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return result.withColumn("kept", F.coalesce(
        F.col(id_col) == F.col("component_id"), F.lit(False)))
