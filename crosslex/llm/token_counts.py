"""Token counts by byte-pair merging, without emitting ids.

The symbols of a text are its characters. A heap holds the adjacent pairs that make
a piece, a linked list the symbols left; the pair of the lowest rank is merged again
and again. The count is the number of symbols less the number of merges; a symbol
that is no piece counts as its UTF-8 bytes.
"""

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from crosslex.llm import pieces as P
from crosslex.llm.common import held, picked, slices, small_batches, text_of, with_columns


def count_merged(part: str, ranks: dict[str, float]) -> int:
    """Number of tokens of one part."""
    size = len(part)
    if size == 1:
        return 1 if part in ranks else len(part.encode())
    # A symbol is part[start[i]:start of the next]; merged ones are unlinked.
    before = list(range(-1, size - 1))
    after = list(range(1, size + 1))
    end = list(range(1, size + 1))
    heap = [(ranks[pair], i, i + 2) for i in range(size - 1)
            if (pair := part[i:i + 2]) in ranks]
    heapify(heap)
    left = size
    alive = [True] * size
    while heap:
        _, i, stop = heappop(heap)
        j = after[i]
        if not alive[i] or j >= size or end[j] != stop or end[i] != j:
            continue  # one of the pair was merged meanwhile
        left -= 1
        alive[j] = False
        end[i] = stop
        after[i] = k = after[j]
        if k < size:
            before[k] = i
            if (rank := ranks.get(part[i:end[k]])) is not None:
                heappush(heap, (rank, i, end[k]))
        h = before[i]
        if h >= 0 and (rank := ranks.get(part[h:stop])) is not None:
            heappush(heap, (rank, h, stop))
    i, more = 0, 0
    while i < size:
        if end[i] - i == 1 and part[i] not in ranks:
            more += len(part[i].encode()) - 1
        i = after[i]
    return left + more


class Counter:
    """Counts tokens of texts; keeps the counts of segments seen lately."""

    def __init__(self, pieces: P.Pieces):
        ranks = {t: -pieces.scores[i] for t, i in pieces.normal.items()}
        self.parts = P.Parts(pieces, lambda part: count_merged(part, ranks), sum)

    def count(self, text: str) -> int:
        return sum(self.parts.of(text))


@held
def _counter(pieces: P.Pieces) -> Counter:
    return Counter(pieces)


def token_counts(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Tokens of every text: ``<id>, n_bytes, n_tokens, over_limit``.

    ``model`` is the path of a SentencePiece byte-pair model. Null and empty texts have
    no bytes and no tokens; texts are taken whole; a row is returned for each row,
    repeated or without id. Only the two named columns are read.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(P.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            counts = [counter.count(text) for text in texts]
            yield with_columns(
                part, ["id"],
                n_bytes=pa.array([len(text.encode()) for text in texts], pa.int64()),
                n_tokens=pa.array(counts, pa.int64()),
                over_limit=pa.array([n > limit for n in counts], pa.bool_()))

    rows = picked(docs, id=id_col, text=text_of(text_col))
    schema = T.StructType([
        rows.schema["id"], T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
