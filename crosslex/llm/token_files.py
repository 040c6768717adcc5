"""Token ids in binary files: Simple-8b words, escapes, blocks that are decoded by vectors.

A 64-bit word holds a selector in its upper four bits and below it as many ids as the
selector says, each in the same number of bits. An id of more than 60 bits, for which
no selector has room, is put in the list of escapes of its block, with its place.

A file (all numbers little-endian) is: ``MAGIC``; the blocks, each of at most ``BLOCK``
ids: words, then escapes as pairs of place and id; the table of documents (ids, then
which ids are null, then token counts); the table of blocks (byte offset, first id,
words, escapes); six numbers (documents, blocks, ids, offsets of the two tables, 0);
``MAGIC``.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslex.llm.common import (
    Memo, cut_texts, held, picked, slices, small_batches, spread, text_of)
from crosslex.sources import workspace

# Ids in a word and bits of each, by selector from 1; 0 is not used.
PER_WORD = [60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [60 // n for n in PER_WORD]

MAGIC = b"S8BIDS01"
BLOCK = 65_536
#: Ids read from a file at a time are those of one block; a table this many rows.
TAIL = 48
#: Rows that are encoded together, as far as their bytes allow: the longer a slice, the fewer
#: times a word is looked up.
ROWS = 2_000
ROWS_BYTES = 4 << 20


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes (pairs of place and id) of a block of unsigned ids."""
    ids = ids.astype(np.uint64)
    wide = np.flatnonzero(ids >> np.uint64(60))
    escapes = np.stack([wide.astype(np.uint64), ids[wide]], axis=1)
    if len(wide):
        ids = ids.copy()
        ids[wide] = 0
    # Bits of each id, at least one; rounding up near a power of two only costs room.
    bits = np.maximum(np.frexp(ids.astype(np.float64))[1], 1).astype(np.uint8)
    bits = np.minimum(bits, 60)
    padded = np.concatenate([bits, np.ones(60, np.uint8)])
    size = len(ids)
    # The most ids from each place on that fit a word: the maximum of n neighbours, for
    # growing n, against the bits that n ids have. What n ids fit, fewer fit as well.
    fitting = np.zeros(size, np.uint8)
    widest, reach = padded, 1
    for selector in range(len(PER_WORD) - 1, -1, -1):
        n = PER_WORD[selector]
        while reach < n:
            step = min(reach, n - reach)
            widest = np.maximum(widest[:-step], widest[step:])
            reach += step
        fits = widest[:size] <= BITS[selector]
        if not fits.any():
            break
        fitting += fits
    most = np.uint8(len(PER_WORD) + 1) - fitting
    count = [0, *PER_WORD]
    counts, at, starts = np.array(count, np.uint8)[most].tobytes(), 0, []
    while at < size:
        starts.append(at)
        at += counts[at]
    begins = np.array(starts, np.int64)
    selectors = most[begins] if size else np.zeros(0, np.uint8)
    words = selectors.astype(np.uint64) << np.uint64(60)
    values = np.concatenate([ids, np.zeros(60, np.uint64)])
    for selector in np.unique(selectors):
        n, width = PER_WORD[selector - 1], BITS[selector - 1]
        mine = np.flatnonzero(selectors == selector)
        shifts = (np.arange(n) * width).astype(np.uint64)
        words[mine] |= np.bitwise_or.reduce(
            values[begins[mine][:, None] + np.arange(n)] << shifts, axis=1)
    return words, escapes


def unpack(words: np.ndarray, escapes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` ids of a block."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(np.array([0, *PER_WORD])[selectors])
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for selector in np.unique(selectors):
        n, width = PER_WORD[selector - 1], BITS[selector - 1]
        mine = np.flatnonzero(selectors == selector)
        shifts = (np.arange(n) * width).astype(np.uint64)
        ids[(ends[mine] - n)[:, None] + np.arange(n)] = (
            words[mine][:, None] >> shifts) & np.uint64((1 << width) - 1)
    ids = ids[:size]
    ids[escapes[:, 0].astype(np.int64)] = escapes[:, 1]
    return ids


class Writer:
    """Writes one file, block by block; only the tables are kept until the end."""

    def __init__(self, out):
        self.out, self.at, self.waiting, self.room = out, 0, [], 0
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.blocks: list[tuple[int, int, int, int]] = []
        self.written = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.sizes.append(len(ids))
        self.waiting.append(ids)
        self.room += len(ids)
        if self.room >= BLOCK:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint64)
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for start in range(0, whole, BLOCK):
            block = ids[start:min(start + BLOCK, whole)]
            words, escapes = pack(block)
            self.blocks.append((self.at, self.written, len(words), len(escapes)))
            self._put(words.astype("<u8").tobytes())
            self._put(escapes.astype("<u8").tobytes())
            self.written += len(block)
        self.waiting, self.room = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(last=True)
        docs_at = self.at
        self._put(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self._put(np.array([d is None for d in self.docs], "u1").tobytes())
        self._put(np.array(self.sizes, "<i8").tobytes())
        blocks_at = self.at
        self._put(np.array(self.blocks, "<i8").reshape(-1, 4).tobytes())
        self._put(np.array([len(self.docs), len(self.blocks), self.written, docs_at,
                            blocks_at, 0], "<i8").tobytes())
        self._put(MAGIC)
        self.out.close()


def read_file(path: str) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
    """``(document, first id, runs of its ids)`` for each document of a file, in order."""
    where, name = fs.FileSystem.from_uri(path)
    with where.open_input_file(name) as file:
        size = file.size()
        file.seek(size - TAIL - len(MAGIC))
        tail = file.read(TAIL)
        if file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no file of token ids, or not whole")
        n_docs, n_blocks, n_ids, docs_at, blocks_at, _ = np.frombuffer(tail, "<i8").tolist()
        file.seek(docs_at)
        docs = np.frombuffer(file.read(8 * n_docs), "<i8").tolist()
        nulls = np.frombuffer(file.read(n_docs), "u1").tolist()
        sizes = np.frombuffer(file.read(8 * n_docs), "<i8").tolist()
        file.seek(blocks_at)
        blocks = np.frombuffer(file.read(32 * n_blocks), "<i8").reshape(-1, 4).tolist()
        ends = [first for _, first, _, _ in blocks[1:]] + [n_ids]

        def decoded() -> Iterator[np.ndarray]:
            for (at, first, words, escapes), end in zip(blocks, ends):
                file.seek(at)
                yield unpack(
                    np.frombuffer(file.read(8 * words), "<u8"),
                    np.frombuffer(file.read(16 * escapes), "<u8").reshape(-1, 2), end - first)

        source, block, used, start = decoded(), np.zeros(0, np.uint64), 0, 0
        for doc, null, count in zip(docs, nulls, sizes):
            runs, missing = [], count
            while missing:
                if used == len(block):
                    block, used = next(source), 0
                take = min(missing, len(block) - used)
                runs.append(block[used:used + take])
                used, missing = used + take, missing - take
            yield (None if null else doc), start, runs
            start += count


# Signs of ASCII but the apostrophe, which starts tokens such as 's.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def is_word(text: str) -> bool:
    """Whether a text is letters below U+0180 only. Lower-casing and composing leave such
    letters apart, and the tokenizer makes one word of them, whose last token ends it."""
    return text.isalpha() and (text.isascii() or max(text) < "ƀ" and "İ" not in text)


#: The letters of such texts.
LETTERS = "".join(filter(is_word, map(chr, range(0x180))))


class Words:
    """Ids of words, for at most twice ``limit`` words: those used lately stay. They are held as
    arrays in which all words of a slice are looked up at once; words of more than ``longest``
    signs are not held.
    """

    def __init__(self, limit: int = 500_000, longest: int = 64):
        self.limit, self.longest = limit, longest
        self.recent = self.older = _NO_WORDS

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For different words their places among those held, the older ones behind the recent
        ones, or -1; and which words are not among the recent ones."""
        at = _places(words, self.recent[0])
        behind = np.flatnonzero(at < 0)
        older = _places(words.take(pa.array(behind)), self.older[0])
        at[behind] = np.where(older < 0, older, len(self.recent[0]) + older)
        return at, behind

    def held(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words held one behind the other, and how many each has."""
        return (np.concatenate([self.recent[1], self.older[1]]),
                np.concatenate([self.recent[2], self.older[2]]))

    def put(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Hold words that are not among the recent ones."""
        short = pc.less_equal(pc.utf8_length(words), self.longest)
        keep = short.to_numpy(zero_copy_only=False)
        if not keep.all():
            words, ids, sizes = words.filter(short), ids[np.repeat(keep, sizes)], sizes[keep]
        for first in range(0, len(words), self.limit):
            last = min(first + self.limit, len(words))
            if len(self.recent[0]) + last - first > self.limit:
                self.older, self.recent = self.recent, _NO_WORDS
            begin, end = sizes[:first].sum(), sizes[:last].sum()
            self.recent = (pa.concat_arrays([self.recent[0], words[first:last]]),
                           np.concatenate([self.recent[1], ids[begin:end]]),
                           np.concatenate([self.recent[2], sizes[first:last]]))


_NO_WORDS = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)


def _places(words: pa.Array, among: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy(
        zero_copy_only=False).astype(np.int64)


def _joined(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids one behind the other, and how many each has."""
    return (np.frombuffer(b"".join(found), "<u4"),
            np.fromiter(map(len, found), np.int64, len(found)) // 4)


@dataclass
class Encoder:
    """Ids of texts, put together from those of the stretches between blanks, which no token
    crosses. A stretch of a word and signs after it is two parts; ids of parts are remembered.
    """

    data: bytes
    specials: tuple[str, ...]

    def __post_init__(self):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(self.data.decode())
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words, self.parts = Words(), Memo(self._fresh, 200_000)

    def _fresh(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids,
                        "<u4").tobytes()

    def _fresh_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in small letters, encoded in one go, which is faster than each alone."""
        if not len(words):
            return _joined([])
        lines = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py()
        ids = np.array(self.library.encode_batch_fast(
            [lines], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(words) and stops[-1] == len(ids):
            return ids, np.diff(stops, prepend=0)
        return _joined([self._fresh(word) for word in words.to_pylist()])

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words in small letters one behind the other, and how many each has."""
        at, behind = self.words.find(words)
        ids, sizes = self.words.held()
        fresh = np.flatnonzero(at < 0)
        new_ids, new_sizes = self._fresh_words(words.take(pa.array(fresh)))
        at[fresh] = len(sizes) + np.arange(len(fresh))
        sizes = np.concatenate([sizes, new_sizes])
        ids, ends = spread(np.concatenate([ids, new_ids]), sizes, at)
        sizes = sizes[at]
        late = np.zeros(len(words), bool)
        late[behind] = True
        self.words.put(words.filter(pa.array(late)), ids[np.repeat(late, sizes)], sizes[late])
        return ids, sizes

    def _of_stretches(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different stretches one behind the other, and how many each has."""
        words = pc.utf8_rtrim(stretches, SIGNS)
        plain = pc.match_substring_regex(words, f"^[{LETTERS}]+$")
        is_plain = plain.to_numpy(zero_copy_only=False)
        signed = np.flatnonzero(is_plain & pc.not_equal(words, stretches).to_numpy(
            zero_copy_only=False))
        coded = pc.utf8_lower(words.filter(plain)).dictionary_encode()
        tails = pc.utf8_ltrim(stretches.take(pa.array(signed)), LETTERS).dictionary_encode()
        rest = stretches.filter(pc.invert(plain)).to_pylist()
        parts = [self.look_up(coded.dictionary)]
        parts += [_joined(list(map(self.parts.__getitem__, texts)))
                  for texts in (tails.dictionary.to_pylist(), rest)]
        # Of each stretch the parts, as numbers of what was found.
        counts = np.ones(len(stretches), np.int64)
        counts[signed] = 2
        ends = np.cumsum(counts)
        numbers = np.empty(counts.sum(), np.int64)
        numbers[(ends - counts)[is_plain]] = coded.indices.to_numpy()
        numbers[ends[signed] - 1] = len(coded.dictionary) + tails.indices.to_numpy()
        numbers[(ends - counts)[~is_plain]] = (
            len(coded.dictionary) + len(tails.dictionary) + np.arange(len(rest)))
        ids, sizes = map(np.concatenate, zip(*parts))
        ids, last = spread(ids, sizes, numbers)
        return ids, np.diff(np.concatenate([[0], last])[np.concatenate([[0], ends])])

    def ids_of(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text. All are cut at once, and a stretch is looked up once for all."""
        distinct, numbers, begins = cut_texts(pc.replace_substring(texts, "\n", " "), " ")
        ids, ends = spread(*self._of_stretches(distinct), numbers)
        found = np.split(ids, np.concatenate([[0], ends])[begins][1:-1])
        special = reduce(pc.or_, [pc.match_substring(texts, x) for x in self.specials],
                         pa.array([False] * len(texts)))
        for n in np.flatnonzero(special.to_numpy(zero_copy_only=False)):
            found[n] = np.frombuffer(self._fresh(texts[n].as_py()), "<u4")
        return found

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of(pa.array([text], pa.string()))[0]


@held
def _encoder(model: dict) -> Encoder:
    return Encoder(model["data"], tuple(model["specials"]))


def _model(path: str) -> dict:
    """The tokenizer's file, after a look at whether blanks part its tokens."""
    import json

    with open(path, "rb") as file:
        data = file.read()
    spec = json.loads(data)
    kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    split = [p for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
    if kinds != ["NFC", "Replace", "Lowercase"] or not split or split[0]["behavior"] != "Removed":
        raise ValueError("only tokenizers that lower-case and drop blanks are supported")
    return {"data": data, "specials": [t["content"] for t in spec["added_tokens"]]}


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Write the ids of all texts in ascending order of their id; the list of files written:
    ``file_no, path, n_docs, n_ids, first_id``.

    Rows of one id are ordered by their text; a null id comes first; a null text has only
    the end id. A task sorts a range of the ids and writes one file, under a name of its
    own attempt until it is whole, so a lost task is simply run again.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_model(tokenizer))
    rows = picked(docs, id=id_col, text=text_of(text_col))
    ranged = rows.repartitionByRange(
        "id", F.xxhash64("text")).sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = _encoder(shared.value), TaskContext.get()
        number, writer = task.partitionId(), None
        where, folder = fs.FileSystem.from_uri(path)
        name = f"{folder}/ids-{number:06d}.s8b"
        own = f"{folder}/.ids-{number:06d}-{task.taskAttemptId()}"
        end = np.array([end_id], "<u4")
        for part in slices(batches, ROWS, ROWS_BYTES):
            if writer is None:
                writer = Writer(where.open_output_stream(own))
            found = encoder.ids_of(part.column("text"))
            for doc, ids in zip(part.column("id").to_pylist(), found):
                writer.add(doc, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            where.move(own, name)
            yield pa.RecordBatch.from_pydict({
                "file_no": pa.array([number], pa.int32()),
                "path": [f"{path}/ids-{number:06d}.s8b"],
                "n_docs": pa.array([len(writer.docs)], pa.int64()),
                "n_ids": pa.array([writer.written], pa.int64())})

    where, folder = fs.FileSystem.from_uri(path)
    where.create_dir(folder, recursive=True)
    files = workspace.settle(
        ranged.mapInArrow(run, "file_no int, path string, n_docs long, n_ids long"), "id_files")
    # One row a file.
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_ids(spark: SparkSession, files: DataFrame, id_col: str = "doc_id",
             ids: bool = False) -> DataFrame:
    """``<id>, start, n_tokens, ids_crc32`` (and ``ids``) of every document in the files."""
    schema = T.StructType([
        T.StructField(id_col, T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.LongType()))] if ids else [])])

    def rows(path: str, base: int) -> Iterator[tuple]:
        for doc, start, runs in read_file(path):
            crc, count = 0, 0
            for run in runs:
                crc = zlib.crc32(run.astype("<u4").tobytes(), crc)
                count += len(run)
            row = (doc, base + start, count, crc)
            yield (*row, np.concatenate(runs).tolist() if runs else []) if ids else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.name for field in schema]
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * ids
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                waiting: list[tuple] = []
                room = 0
                for row in rows(path, base):
                    waiting.append(row)
                    room += row[2] if ids else 1
                    if room >= BLOCK:
                        yield _batch(waiting, names, kinds)
                        waiting, room = [], 0
                if waiting:
                    yield _batch(waiting, names, kinds)

    # A task a file, or few.
    tasks = max(1, files.count())
    return files.select("path", "first_id", "file_no").repartition(tasks, "file_no").select(
        "path", "first_id").mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)
