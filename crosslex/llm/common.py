"""What several operators share: rows of a text table as Arrow slices, a bounded memo."""

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows taken from an Arrow batch at a time, so that few texts are Python objects at once.
SLICE = 128
#: Bytes of text in a slice, unless one text alone has more.
SLICE_BYTES = 1 << 20
#: Rows and bytes of the batches in which texts go to Python, at most: Spark's default for
#: each, which is meant for narrow rows, and what takes its place.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
         "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16777216b")}


def small_batches(spark: SparkSession) -> None:
    """Let the session send texts to Python in smaller batches than by default.

    The setting holds for the session from here on, as it is read when a query runs; what a
    user has set stays.
    """
    for name, (default, smaller) in BATCH.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, smaller)


def picked(docs: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named columns, under new names. Other columns, whatever they are called, stay out."""
    return docs.select(*[
        (docs[column] if isinstance(column, str) else column).alias(name)
        for name, column in columns.items()
    ])


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE,
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``rows`` rows, and of at most ``size`` bytes where
    they have more than one row."""
    for batch in batches:
        ends = np.cumsum(_row_bytes(batch))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            fitting = int(np.searchsorted(ends, before + size, side="right"))
            stop = min(max(fitting, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()


def give_back() -> None:
    """Return to the system what Arrow and, with glibc, the allocator keep of freed memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function of a task's batches, which leaves no freed memory behind.

    A Python worker lives on when its task has ended, beside those of other stages, and would
    keep the most that any of its tasks took.
    """
    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def _row_bytes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of the texts in each row."""
    total = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            total += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return total


def cut_texts(texts: pa.Array, at: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts cut at a sign: the distinct parts, the parts in order as numbers of these, and
    where each text's parts begin (one more at the end)."""
    cut = pc.split_pattern(texts, at)
    coded = cut.flatten().dictionary_encode()
    ends = cut.offsets.to_numpy()
    return coded.dictionary, coded.indices.to_numpy(), ends - ends[0]


def spread(values: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[
        np.ndarray, np.ndarray]:
    """The values of all parts in order, and where each part ends, from those of the distinct
    parts one behind the other and their sizes."""
    first = np.cumsum(sizes) - sizes
    counts = sizes[numbers]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(first[numbers] - (ends - counts), counts) + np.arange(total)
    return values[places], ends


def with_columns(batch: pa.RecordBatch, kept: list[str], **more: Any) -> pa.RecordBatch:
    """The ``kept`` columns of a batch and more beside them."""
    arrays = [batch.column(name) for name in kept]
    return pa.RecordBatch.from_arrays(
        [*arrays, *(x if isinstance(x, pa.Array) else pa.array(x) for x in more.values())],
        names=[*kept, *more])


def text_of(column: str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column), F.lit(""))


_HELD: list[Any] = []


def held(make: Callable[[Any], Any]) -> Callable[[Any], Any]:
    """Keep what was made of the last argument for the later tasks of a Python worker.

    The argument is the value of a broadcast, the same object in all tasks of a worker. One
    such result is kept in all: the next operator's takes its place, so that a worker that
    serves several does not hold the memory of all.
    """
    @wraps(make)
    def get(value: Any) -> Any:
        if not _HELD or _HELD[0] is not value:
            _HELD.clear()
            _HELD[:] = [value, make(value)]
        return _HELD[1]

    return get


class Memo(dict):
    """Results by key, for at most twice ``limit`` keys: those used lately stay.

    Keys longer than ``longest`` characters are worked out anew each time, so the
    memory is bounded whatever the texts hold.
    """

    def __init__(self, make: Callable[[str], Any], limit: int = 100_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, key: str) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key: str, value: Any) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
