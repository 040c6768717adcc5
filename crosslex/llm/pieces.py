"""Vocabulary pieces of a SentencePiece model, and texts cut where no piece can reach across."""

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc

from crosslex.llm.common import Memo

#: How a piece spells a space.
SPACE = "▁"
NORMAL, UNKNOWN, BYTE = 1, 2, 6


@dataclass(frozen=True)
class Pieces:
    """The pieces of a model in id order, with their scores and types. Plain data, to be broadcast."""

    texts: list[str] = field(repr=False)
    scores: list[float] = field(repr=False)
    kinds: list[int] = field(repr=False)

    @cached_property
    def normal(self) -> dict[str, int]:
        """Ids of the pieces that stand for text."""
        return {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == NORMAL}

    @cached_property
    def byte_ids(self) -> dict[int, int]:
        return {int(t[3:5], 16): i
                for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == BYTE}

    @cached_property
    def neighbours(self) -> set[str]:
        """Every two characters that stand side by side in some piece."""
        return {t[i:i + 2] for t in self.normal for i in range(len(t) - 1)}


def load(path: str) -> Pieces:
    """Read a model file whose normalisation is the identity."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
        raise ValueError("only models that change nothing but spaces are supported")
    if any(p.type not in (NORMAL, UNKNOWN, 3, BYTE) for p in model.pieces):
        raise ValueError("models with user-defined or unused pieces are not supported")
    return Pieces([p.piece for p in model.pieces], [p.score for p in model.pieces],
                  [p.type for p in model.pieces])


_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def segments(text: str) -> list[str]:
    """Cut a text, spelled with space markers and one before it, in front of every run of them.

    No piece has a marker behind another character, so none reaches across a cut.
    Line ends are cut as well: they are in no piece of more than one character.
    """
    if not text:
        return []
    if "  " in text or SPACE in text or text[0] == " ":
        return _RUNS.findall(SPACE + text.replace(" ", SPACE))
    return (SPACE + text.replace(" ", " " + SPACE).replace("\n", " \n")).split(" ")


def led(texts: pa.Array, sign: str) -> pa.Array:
    """The texts with a sign before each that is not empty."""
    return pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(sign, texts, ""))


def spelled(texts: pa.Array) -> pa.Array:
    """Texts spelled with space markers and one before each, and a blank wherever ``segments``
    cuts them; no other blank is left."""
    marked = led(pc.replace_substring(texts, " ", SPACE), SPACE)
    if pc.any(pc.match_substring(marked, SPACE * 2)).as_py():
        marked = pc.replace_substring_regex(marked, f"({SPACE}+)", r" \1")
    else:
        marked = pc.replace_substring(marked, SPACE, " " + SPACE)
    return pc.replace_substring(marked, "\n", " \n")


class Parts:
    """Results for segments, put together from those for parts that no piece reaches across.

    ``make`` gets a part whose neighbouring characters all occur side by side in some
    piece, ``join`` a list of results. Results are remembered by segment and by part.
    """

    def __init__(self, pieces: Pieces, make: Callable[[str], Any],
                 join: Callable[[list[Any]], Any]):
        self.neighbours, self.join = pieces.neighbours, join
        self.parts = Memo(make, 40_000)
        self.segments = Memo(self._of_segment)

    def _of_segment(self, segment: str) -> Any:
        near, cut, found = self.neighbours, 0, []
        for i in range(1, len(segment)):
            if segment[i - 1:i + 1] not in near:
                found.append(self.parts[segment[cut:i]])
                cut = i
        last = self.parts[segment[cut:]]
        return self.join([*found, last]) if found else last

    def of(self, text: str) -> list[Any]:
        """The results of the segments of a text, in order."""
        return list(map(self.segments.__getitem__, segments(text)))
