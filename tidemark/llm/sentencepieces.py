"""Encode and decode with a merge-type sentence-piece model, by a table of prefixes.

In byte-pair merging every prefix of a text has one last piece: of the pieces that end there (found by an
automaton over the vocabulary) the one that is compatible with the last piece of what stands before it.
Two pieces are compatible if merging their joined characters gives back just these two. So a text is
encoded in one pass that stores the last piece of each prefix, and the ids are read off backwards.

No piece of such a model has a space mark behind another character, so a text falls into independent
units, each a run of space marks and what follows. A unit also ends before any mark that no piece has behind
a letter, and around line ends, which no piece has at all. A worker remembers the units it has met. Characters
outside the vocabulary become byte pieces, as merging never touches them.

The tables are built in each worker from the model file (its path is a parameter, and it lies on every
machine). Work is a map over rows in bounded batches: no shuffle, whatever is repeated or hot.

Defined results: null and empty texts have no ids and decode to an empty text; null ids decode to an
empty text; columns of the input that have a result's name are replaced.
"""
from __future__ import annotations

import codecs
import re
import unicodedata
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import replacing, trim

SPACE = "▁"
NORMAL, UNKNOWN, BYTE = 1, 2, 6
#: Remembered pairs, and units in two generations of half as many: when the newer is full, the older one goes.
REMEMBERED = 400_000
#: Bits for the right one of a pair.
PAIR = 24


def units_of(pieces) -> tuple[re.Pattern, re.Pattern]:
    """Splits texts where no piece crosses: before runs of marks that follow only marks in any piece.

    Blanks stand for the space marks in texts. The first pattern is for any text, the second for Latin-1 characters.
    ``re`` looks at characters beyond 16 bits in a class one by one, so such marks stand apart.
    """
    neighbours = {a + b for p in pieces for a, b in zip(p, p[1:])}
    marks = {c for p in pieces for c in p if unicodedata.category(c)[0] not in "LM"} | {SPACE}
    while wrong := {b for a, b in neighbours if b in marks and a not in marks}:
        marks -= wrong
    if SPACE not in marks:
        raise ValueError("pieces span words, so texts do not fall into units")
    line = "" if any("\n" in p for p in pieces) else "\n"
    alone = line and "|\n"
    marks = marks - {SPACE, "\n"} | {" "}

    def within(first: str, last: str) -> str:
        return re.escape("".join(sorted(c for c in marks if first <= c <= last)))

    narrow, plain, high, far = within("\0", "\xff"), within("\0", "\uffff"), "\U00010000-\U0010ffff", within("\U00010000", "\U0010ffff")
    opening, other = f"[{plain}]+", f"[^{line}{plain}]+"
    if far:
        opening, other = f"(?:[{plain}]++|(?=[{high}])[{far}])++", f"(?:[^{line}{plain}{high}]++|(?=[{high}])[^{far}])++"
    wide = f" {other}{alone}|(?:{opening})?{other}|{opening}"
    return re.compile(wide), re.compile(f" [^{line}{narrow}]+{alone}|[{narrow}]*[^{line}{narrow}]+|[{narrow}]+")


class PieceTexts:
    """What the ids of one model stand for: all that decoding needs, at a fraction of the prefix table's size."""

    def __init__(self, path: str):
        self.load(path)

    def load(self, path: str):
        """Returns the parsed model."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        normal = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("a merge-type model that leaves texts as they are is needed")
        self.dummy_prefix = normal.add_dummy_prefix
        self.out: list[bytes] = []
        self.is_byte: list[bool] = []
        for piece in model.pieces:
            self.is_byte.append(piece.type == BYTE)
            if piece.type == BYTE:
                self.out.append(bytes([int(piece.piece[1:-1], 16)]))
            elif piece.type == NORMAL:
                self.out.append(piece.piece.replace(SPACE, " ").encode())
            else:
                self.out.append(model.trainer_spec.unk_surface.encode() if piece.type == UNKNOWN else b"")
        return model

    def decode(self, ids: list[int] | None) -> str:
        """Pieces in a row, byte pieces joined to characters; bytes that form none become U+FFFD, one each."""
        if not ids:
            return ""
        raw = b"".join(map(self.out.__getitem__, ids))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = raw.decode(errors="one_for_each_byte")
        return text[1:] if self.dummy_prefix and text.startswith(" ") and not self.is_byte[ids[0]] else text


class PrefixTable(PieceTexts):
    """The vocabulary of one model, and encoding and decoding by it."""

    def __init__(self, path: str):
        model = self.load(path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        automaton = ahocorasick.Automaton()
        for i, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                self.byte[int(piece.piece[1:-1], 16)] = i
            elif piece.type == NORMAL:
                self.score[piece.piece], self.id[piece.piece] = piece.score, i
                automaton.add_word(piece.piece, i)
        automaton.make_automaton()
        self.automaton = automaton
        self.text_of = [p.piece for p in model.pieces]
        self.length = list(map(len, self.text_of))
        known = {p for p in self.id if len(p) == 1}
        self.unknown = re.compile("[^" + re.escape("".join(sorted(known))) + "]")
        self.unit, self.narrow_unit = units_of(self.id)
        self.pairs: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the best-scored neighbours first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        key = left << PAIR | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            a, b = self.text_of[left], self.text_of[right]
            found = self.pairs[key] = self.merged(a + b) == [a, b]
        return found

    def run(self, text: str) -> list[int]:
        """The ids of a run of known characters."""
        n = len(text)
        last = [-1] * (n + 1)
        pairs, length = self.pairs, self.length
        for end, piece in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue  # the only fitting piece is already known
            before = end - length[piece]
            if before:
                left = last[before]
                if left < 0:
                    continue
                fits = pairs.get(left << PAIR | piece)
                if fits is None:
                    fits = self.compatible(left, piece)
            else:
                fits = length[piece] == 1 or self.whole(piece)
            if fits:
                last[end] = piece
        ids = []
        while n:
            ids.append(last[n])
            n -= length[last[n]]
        ids.reverse()
        return ids

    @lru_cache(maxsize=None)  # noqa: B019  one table lives as long as its worker
    def whole(self, piece: int) -> bool:
        """Whether merging reaches the piece at all."""
        return len(self.merged(self.text_of[piece])) == 1

    def of_unit(self, unit: str) -> bytes:
        """The ids of a unit, 32 bits each; blanks stand for its space marks."""
        found = self.units.get(unit)
        if found is not None:
            return found
        packed = self.older.get(unit)
        if packed is None:
            packed = array("i", self.found(unit.replace(" ", SPACE))).tobytes()
        if len(unit) <= 40:
            if len(self.units) >= REMEMBERED // 2:
                self.older, self.units = self.units, {}
            self.units[unit] = packed
        return packed

    def found(self, unit: str) -> list[int]:
        ids: list[int] = []
        at = 0
        for m in self.unknown.finditer(unit):
            if m.start() > at:
                ids += self.run(unit[at : m.start()])
            ids += [self.byte[b] for b in m.group().encode()]
            at = m.end()
        if at < len(unit):
            ids += self.run(unit[at:] if at else unit)
        return ids

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def packed(self, text: str | None) -> bytes:
        """The ids of a text, 32 bits each."""
        if not text:
            return b""
        if self.dummy_prefix:
            text = " " + text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            units = self.unit.findall(text.replace(SPACE, " "))
        else:
            units = self.narrow_unit.findall(text)
        known, of_unit = self.units.get, self.of_unit
        return b"".join([known(unit) or of_unit(unit) for unit in units])


def _one_for_each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one_for_each_byte", _one_for_each_byte)


@lru_cache(maxsize=4)
def table(path: str) -> PrefixTable:
    return PrefixTable(path)


@lru_cache(maxsize=4)
def piece_texts(path: str) -> PieceTexts:
    return PieceTexts(path)


def encode(docs: DataFrame, path: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """Add the ids of every text, without begin or end ids."""

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        of = table(path).packed
        values, sizes = bytearray(), [0]
        for text in texts:
            values += of(text.as_py())
            sizes.append(len(values) // 4)
        made = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.frombuffer(values, np.int32)))
        trim()
        return made

    # a decoder above would else run the encoder a second time, inlined
    once = ids_of.asNondeterministic()
    return replacing(docs, {ids_column: once(F.col(text_column).cast("string"))})


def decode(docs: DataFrame, path: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """Add the text that the ids stand for."""

    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        of = piece_texts(path).decode
        at, values = ids.offsets.to_pylist(), ids.values.to_numpy(zero_copy_only=False)
        made = pa.array((of(values[a:b].tolist()) for a, b in zip(at, at[1:])), pa.string())
        trim()
        return made

    return replacing(docs, {text_column: text_of(F.col(ids_column))})
