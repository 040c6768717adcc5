"""Unigram segmentation: Viterbi over a double-array trie of pieces, and decoding.

Of all ways to write a text as pieces the one with the highest sum of scores is taken;
of equal ones the one whose last pieces are the longest. A character that no piece
covers costs ``UNKNOWN_COST`` more than the worst piece and is written as its bytes.
"""

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from crosslex.llm import pieces as P
from crosslex.llm.common import (
    cut_texts, held, lean, picked, slices, small_batches, spread, text_of, with_columns)

#: How much less than the worst piece an unknown character scores.
UNKNOWN_COST = 10.0
#: Bytes of a part that is segmented together with others, at most (an offset is one byte).
LONG = 128
#: Bytes of the parts that are segmented together, unless one alone has more.
CHUNK = 1 << 17


def _leads(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 begin a character."""
    return (data & 192) != 128


class Trie:
    """Double array: node ``s`` has the child ``base[s] + byte`` if ``check`` there is ``s``.

    ``value`` holds the id of the piece that ends at a node, or -1.
    """

    def __init__(self, keys: dict[bytes, int]):
        self.base, self.check = array("i", [0]), array("i", [-1])
        self.value = array("i", [-1])
        children: dict[bytes, set[int]] = {}
        for key in keys:
            for i in range(len(key)):
                children.setdefault(key[:i], set()).add(key[i])
        # Nodes with one child fill the first free place; those with more look for room
        # from a place on that moves along once the search gets long.
        free, roomy, level = 257, 257, [(b"", 0)]
        while level:
            below = []
            for prefix, node in level:
                self.value[node] = keys.get(prefix, -1)
                labels = sorted(children.get(prefix, ()))
                if not labels:
                    continue
                while free < len(self.check) and self.check[free] >= 0:
                    free += 1
                roomy = max(roomy, free)
                first = base = (free if len(labels) == 1 else roomy) - labels[0]
                while any(self._taken(base + label) for label in labels):
                    base += 1
                if base - first > 64:
                    roomy = base + labels[0]
                self.base[node] = base
                self._grow(base + labels[-1] + 1)
                for label in labels:
                    self.check[base + label] = node
                    below.append((prefix + bytes([label]), base + label))
            level = below
        self._grow(len(self.check) + 256)

    def _taken(self, place: int) -> bool:
        return place < len(self.check) and self.check[place] >= 0

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base.extend([0] * more)
            self.check.extend([-1] * more)
            self.value.extend([-1] * more)


class Encoder:
    """Ids of texts under a model's pieces and scores, and texts of ids."""

    def __init__(self, pieces: P.Pieces, trie: Trie):
        self.pieces, self.trie = pieces, trie
        self.base, self.check, self.value = (
            np.frombuffer(x, np.int32) for x in (trie.base, trie.check, trie.value))
        self.unknown = min(pieces.scores) - UNKNOWN_COST
        # The last one, which the number -1 finds, is that of no piece.
        self.scores = np.array([*pieces.scores, self.unknown])
        self.byte_ids = np.array([pieces.byte_ids[b] for b in range(256)], np.int32)
        self.near = np.unique(np.array(
            [ord(t[i]) << 21 | ord(t[i + 1]) for t in pieces.normal for i in range(len(t) - 1)],
            np.int64))
        self.bytes_of = [
            bytes([int(t[3:5], 16)]) if k == P.BYTE
            else t.replace(P.SPACE, " ").encode() if k == P.NORMAL else b""
            for t, k in zip(pieces.texts, pieces.kinds)]
        self.spelled = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.lengths = np.array(list(map(len, self.bytes_of)), np.int64)

    def _begins(self, data: bytes) -> np.ndarray:
        """Where parts begin that no piece reaches across: in front of a character that stands
        behind the one before it in no piece."""
        signs = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
        cut = np.ones(len(signs), bool)
        for start in range(1, len(signs), CHUNK):
            some = signs[start - 1:start + CHUNK].astype(np.int64)
            pairs = some[:-1] << 21 | some[1:]
            places = np.minimum(np.searchsorted(self.near, pairs), len(self.near) - 1)
            cut[start:start + CHUNK] = self.near[places] != pairs if len(self.near) else True
        return np.flatnonzero(_leads(np.frombuffer(data, np.uint8)))[cut]

    def _long(self, data: bytes) -> tuple[list[int], list[int], list[int]]:
        """Ends, beginnings and pieces (-1: none) of the best segmentation of a long part."""
        trie, scores = self.trie, self.pieces.scores
        size, base, check, value = len(data), trie.base, trie.check, trie.value
        best: list[float | None] = [None] * (size + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (size + 1)
        best[0], start = 0.0, 0
        while start < size:
            lead = data[start]
            width = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
            score, single, node, at = best[start], False, 0, start
            while at < size:
                to = base[node] + data[at]
                if check[to] != node:
                    break
                node, at = to, at + 1
                piece = value[node]
                if piece >= 0:
                    single |= at - start == width
                    total = score + scores[piece]
                    if best[at] is None or total > best[at]:
                        best[at], back[at] = total, (start, piece)
            if not single:
                at, total = start + width, score + self.unknown
                if best[at] is None or total > best[at]:
                    best[at], back[at] = total, (start, -1)
            start += width
        path, at = [], size
        while at:
            path.append((at, *back[at]))
            at = back[at][0]
        ends, starts, found = zip(*path)
        return list(ends), list(starts), list(found)

    def _matches(self, data: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> tuple[
            np.ndarray, np.ndarray, np.ndarray]:
        """Pieces in the data: which start each has, how many bytes, and its id. A character
        that is no piece is one of its own, with the id -1."""
        which, node, depth = np.arange(len(starts), dtype=np.int32), np.zeros(1, np.int32), 0
        alone = np.ones(len(starts), bool)
        lead = data[starts]
        widths = (1 + (lead >= 192).astype(np.int32) + (lead >= 224) + (lead >= 240)).astype(np.int32)
        room, at = limits - starts, starts
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(which):
            to = self.base[node] + data[at + depth]
            there = np.flatnonzero(self.check[to] == node)
            depth += 1
            which, node, at = which[there], to[there], at[there]
            ids = self.value[node]
            hit = np.flatnonzero(ids >= 0)
            mine = which[hit]
            found.append((mine, np.full(len(hit), depth, np.int32), ids[hit]))
            alone[mine[widths[mine] == depth]] = False
            more = np.flatnonzero(room[which] > depth)
            which, node, at = which[more], node[more], at[more]
        bare = np.flatnonzero(alone).astype(np.int32)
        found.append((bare, widths[bare], np.full(len(bare), -1, np.int32)))
        return tuple(map(np.concatenate, zip(*found)))

    def _best(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts of the data in order, and the byte behind each: Viterbi over all parts
        at once, a step for each place in a part. Long parts are taken one by one."""
        size, n = len(data), len(begins)
        stops = np.append(begins[1:], size)
        # A part of n bytes has n + 1 places: in front of each byte, and behind the last.
        part = np.repeat(np.arange(n), stops - begins)
        short = stops - begins <= LONG
        starts = np.flatnonzero(_leads(data) & short[part]).astype(np.int32)
        which, sizes, ids = self._matches(data, starts, stops[part[starts]])
        starts = starts[which]
        offset = (starts - begins[part[starts]]).astype(np.uint8)
        order = np.argsort(offset, kind="stable")
        froms = (starts + part[starts])[order]
        tos, ids = froms + sizes[order], ids[order]
        gains, steps = self.scores[ids], np.cumsum(np.bincount(offset, minlength=1))
        best, back = np.full(size + n, -np.inf), np.zeros(size + n, np.int32)
        best[begins + np.arange(n)] = 0.0
        first = 0
        for last in steps.tolist():
            total, to = best[froms[first:last]] + gains[first:last], tos[first:last]
            better = np.flatnonzero(total > best[to])
            to = to[better]
            best[to], back[to] = total[better], better + first
            first = last
        # The ends of the chosen pieces, from the last of each part to the first.
        chosen = np.zeros(size + n, bool)
        came, own = np.zeros(size + n, np.int32), np.zeros(size + n, np.int32)
        at = (stops + np.arange(n))[short]
        while len(at):
            chosen[at] = True
            match = back[at]
            came[at], own[at] = froms[match], ids[match]
            at = froms[match][match >= steps[0]]
        for i in np.flatnonzero(~short).tolist():
            ends, heads, found = map(np.array, self._long(data[begins[i]:stops[i]].tobytes()))
            shift = begins[i] + i
            chosen[ends + shift] = True
            came[ends + shift], own[ends + shift] = heads + shift, found
        at = np.flatnonzero(chosen)
        owned, ends = own[at], at - np.repeat(
            np.arange(n), np.add.reduceat(chosen, begins + np.arange(n), dtype=np.int64))
        widths = np.where(owned < 0, at - came[at], 1)
        out = np.repeat(owned, widths)
        bare = np.flatnonzero(out < 0)
        if len(bare):
            behind = np.repeat(np.cumsum(widths), widths)
            out[bare] = self.byte_ids[data[
                (np.repeat(ends, widths) - (behind - np.arange(len(out))))[bare]]]
        return out, np.repeat(ends, widths)

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and where each text's begin (one more at the end).
        What stands between blanks is encoded once, however often it occurs."""
        distinct, numbers, begins = cut_texts(P.spelled(texts), " ")
        offsets = np.frombuffer(distinct.buffers()[1], np.int32)[
            distinct.offset:distinct.offset + len(distinct) + 1].astype(np.int64)
        buffer = distinct.buffers()[2]
        data = buffer.to_pybytes()[offsets[0]:offsets[-1]] if buffer is not None else b""
        whole, offsets = np.frombuffer(data, np.uint8), offsets - offsets[0]
        # No part goes from one stretch to the next, though it may seem so.
        cut = np.zeros(len(data) + 1, bool)
        cut[self._begins(data)] = cut[offsets] = True
        places = np.flatnonzero(cut[:-1])
        ids, ends, first = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        while first < len(places):
            last = max(first + 1, int(np.searchsorted(places, places[first] + CHUNK)))
            start, stop = places[first], places[last] if last < len(places) else len(data)
            some, behind = self._best(whole[start:stop], places[first:last] - start)
            ids.append(some)
            ends.append(behind + start)
            first = last
        counts = np.diff(np.searchsorted(np.concatenate(ends), offsets, side="right"))
        found, stops = spread(np.concatenate(ids), counts, numbers)
        return found, np.concatenate([[0], stops])[begins]

    def encode(self, text: str) -> np.ndarray:
        return self.ids_of(pa.array([text], pa.string()))[0]

    def texts_of(self, ids: np.ndarray, begins: np.ndarray) -> pa.Array:
        """The texts of ids that are whole characters, each text with the space it began with."""
        data, ends = spread(self.spelled, self.lengths, ids)
        offsets = np.concatenate([[0], ends])[begins].astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(begins) - 1, [
            None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def decode(self, ids: list[int]) -> str:
        """Text of ids: markers become spaces, bytes are put together, the first space goes."""
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        return data.removeprefix(b" ").decode("utf-8", "replace")


@held
def _encoder(model: tuple[P.Pieces, Trie]) -> Encoder:
    return Encoder(*model)


def _shared(docs: DataFrame, model: str):
    """Pieces and their trie, built once; a vocabulary's size does not grow with the data."""
    small_batches(docs.sparkSession)
    pieces = P.load(model)
    if len(pieces.byte_ids) != 256:
        raise ValueError("the model has no piece for every byte")
    trie = Trie({text.encode(): i for text, i in pieces.normal.items()})
    return docs.sparkSession.sparkContext.broadcast((pieces, trie))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``<id>, n_tokens, ids, restored``: the ids of every whole text, and whether decoding
    them gives the text again.

    Null and empty texts have no ids. A text's spaces all come back; a marker character in
    a text comes back as a space, so such a text is not restored. One row for each row.
    """
    shared = _shared(docs, model)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for part in slices(batches):
            texts = part.column("text")
            ids, ends = encoder.ids_of(texts)
            yield with_columns(
                part, ["id"], n_tokens=pa.array(np.diff(ends), pa.int64()),
                ids=pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                restored=pc.equal(encoder.texts_of(ids, ends), P.led(texts, " ")))

    rows = picked(docs, id=id_col, text=text_of(text_col))
    return rows.mapInArrow(run, T.StructType([
        rows.schema["id"], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("restored", T.BooleanType())])).withColumnRenamed("id", id_col)


def decode(coded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``text`` beside them, decoded from their ids; null ids give null.

    Ids outside the vocabulary stand for nothing. A column named ``text`` is replaced.
    """
    shared = _shared(coded, model)
    rest = coded.drop("text")
    names = rest.columns

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        size = len(encoder.bytes_of)
        for part in slices(batches):
            texts = [None if ids is None else encoder.decode(
                [i for i in ids if i is not None and 0 <= i < size])
                for ids in part.column(ids_col).to_pylist()]
            yield with_columns(part, names, text=pa.array(texts, pa.string()))

    return rest.mapInArrow(run, T.StructType([
        *rest.schema.fields, T.StructField("text", T.StringType())]))
