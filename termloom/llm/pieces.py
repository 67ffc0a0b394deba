"""Encoding with a compiled piece model that keeps where every piece stood in the text.

Normalisation takes at each place the longest prefix that the model's compiled character
map knows, and notes for each byte it writes the byte of the text it came from. The
normalised text is cut into words, and a word's symbols are merged, best score first and
leftmost among equals, until no two neighbours make a piece. A piece's span is where its
first byte came from up to where the next piece's did. Words repeat, so each task keeps
the pieces of those it has met.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termloom.llm.shared import few

SPACE, REPLACEMENT = "▁".encode(), "�".encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
#: Words that a task remembers, and the longest of them in characters.
MEMORY, LONGEST = 1 << 19, 64
NEVER = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialised message's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """The compiled map of a model: a double array of units, and the replacements one after the other."""

    def __init__(self, compiled: bytes):
        size = struct.unpack("<I", compiled[:4])[0] if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.replacements = compiled[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """(what replaces it, its length) of the longest prefix of text[at:] that the map knows."""
        units, found = self.units, None
        if not units:
            return None
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        for end in range(at, len(text)):
            node ^= text[end]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[end]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = (units[node] & 0x7FFFFFFF, end + 1 - at)
        if found is None:
            return None
        start, length = found
        return self.replacements[start : self.replacements.index(b"\0", start)], length


class PieceModel:
    """A model of merged pieces, read from its file.

    Models of another kind, and those with user-defined or unused pieces, without pieces
    for bytes, or with the space after a word, raise ValueError.
    """

    def __init__(self, data: bytes):
        pieces, trainer, normal = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if trainer.get(3, 1) != BPE or trainer.get(24, 0) or not trainer.get(35, 0) or any(kind not in (NORMAL, UNKNOWN, CONTROL, BYTE) for _, _, kind in pieces):
            raise ValueError("not a model of merged pieces, or one with pieces that are not supported")
        self.ids = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.ranks = {piece: -score for piece, score, kind in pieces if kind == NORMAL}
        self.bytes = {int(piece[3:5], 16): i for i, (piece, _, kind) in enumerate(pieces) if kind == BYTE}
        special = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind != NORMAL}
        self.begin, self.end = (special.get(trainer.get(n, default).decode()) for n, default in ((46, b"<s>"), (47, b"</s>")))
        self.map = CharacterMap(normal.get(2, b""))
        self.prefix, self.single, self.marked = bool(normal.get(3, 1)), bool(normal.get(4, 1)), bool(normal.get(5, 1))
        self.space = SPACE if self.marked else b" "
        surface = trainer.get(44, " ⁇ ".encode())
        self.surfaces = [
            surface if kind == UNKNOWN else b"" if kind == CONTROL else bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.encode().replace(SPACE, b" ")
            for piece, _, kind in pieces]
        self.kinds = [kind for _, _, kind in pieces]
        self.sizes = np.array([1 if kind == BYTE else len(piece.encode()) for piece, _, kind in pieces])
        self.led = {i for piece, i in self.ids.items() if piece.encode().startswith(SPACE)}
        # words can be merged apart if no piece goes on after its last character into a space
        mark = SPACE.decode()
        apart = mark in self.ids and not any(re.search(f"[^{mark}]{mark}", piece) for piece in self.ids)
        self.words = re.compile(f"{mark}+[^{mark}]*|[^{mark}]+" if apart else r"(?s:.+)")
        self.known: dict[str, bytes] = {}

    # Normalisation

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The text that is cut into pieces, and for each of its bytes (and its end) where in `text` it came from."""
        if not text:
            return b"", np.zeros(1, np.int32)
        if not self.map.units and not self.single:
            try:
                text.decode()
                return self._unmapped(text)
            except UnicodeDecodeError:
                pass
        return self._mapped(text)

    def _unmapped(self, text: bytes) -> tuple[bytes, np.ndarray]:
        points = np.frombuffer(text, np.uint8)
        came = np.maximum.accumulate(np.where(points & 0xC0 != 0x80, np.arange(len(points), dtype=np.int32), 0))
        came = np.repeat(came, np.where(points == 32, len(self.space), 1))
        lead = self.space if self.prefix else b""
        ends = (np.zeros(len(lead), np.int32), came, np.array([len(text)], np.int32))
        return lead + text.replace(b" ", self.space), np.concatenate(ends)

    def _longest(self, text: bytes, at: int) -> tuple[bytes, int]:
        found = self.map.longest(text, at)
        if found is not None:
            return found
        first = text[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        try:
            text[at : at + size].decode()
            return text[at : at + size], size
        except UnicodeDecodeError:
            return REPLACEMENT, 1

    def _mapped(self, text: bytes) -> tuple[bytes, np.ndarray]:
        at, out, came = 0, bytearray(), []
        while self.single and at < len(text):
            piece, size = self._longest(text, at)
            if piece != b" ":
                break
            at += size
        if at == len(text):
            return b"", np.array([0], np.int32)
        if self.prefix:
            out += self.space
            came += [at] * len(self.space)
        after_space = self.single
        while at < len(text):
            piece, size = self._longest(text, at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                after_space = self.single and piece.endswith(b" ")
                piece = piece.replace(b" ", self.space)
                out += piece
                came += [at] * len(piece)
            at += size
            after_space = after_space and self.single
        while self.single and out.endswith(self.space):
            at = came[len(out) - len(self.space)]
            del out[len(out) - len(self.space) :], came[len(out) :]
        return bytes(out), np.array([*came, at], np.int32)

    # Pieces

    def merged(self, word: str) -> list[str]:
        """The word's characters, merged to pieces."""
        return self._merged_short(word) if len(word) <= LONGEST else self._merged_long(word)

    def _merged_short(self, word: str) -> list[str]:
        parts, rank = list(word), self.ranks.get
        ranks = [rank(one + other, NEVER) for one, other in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            ranks.pop(i)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        return parts

    def _merged_long(self, word: str) -> list[str]:
        """The same by a queue of pairs, as the other way is quadratic."""
        symbols: list[str | None] = list(word)
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        waiting: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(symbols):
                both = symbols[left] + symbols[after[left]]
                if both in self.ranks:
                    heapq.heappush(waiting, (self.ranks[both], left, both))

        for i in range(len(word) - 1):
            offer(i)
        while waiting:
            _, left, both = heapq.heappop(waiting)
            right = after[left] if symbols[left] is not None else len(symbols)
            if right >= len(symbols) or symbols[left] + symbols[right] != both:
                continue  # one of the two was merged meanwhile
            symbols[left], symbols[right] = both, None
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [s for s in symbols if s is not None]

    def _pieces(self, word: str) -> bytes:
        """The ids of a word's pieces, as they are given out; a character that is none is one for each of its bytes."""
        ids: list[int] = []
        for symbol in self.merged(word):
            own = self.ids.get(symbol)
            if own is None:
                ids += [self.bytes[b] for b in symbol.encode()]
            else:
                ids.append(own)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encoded(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each piece starts, where it ends) without begin and end; places are bytes of the text."""
        data, came = self.normalised(text)
        words = self.words.findall(data.decode())
        if len(self.known) >= MEMORY:
            self.known.clear()
        found = list(map(self.known.get, words))
        if None in found:
            new = {word: self._pieces(word) for word in {w for w, ids in zip(words, found, strict=True) if ids is None}}
            found = [new[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]
            self.known.update((word, ids) for word, ids in new.items() if len(word) <= LONGEST)
        ids = np.frombuffer(b"".join(found), "<u4")
        bounds = came[np.concatenate([[0], np.cumsum(self.sizes[ids])])]
        return ids, bounds[:-1], bounds[1:]

    # And back

    def decoded(self, ids: list[int]) -> str:
        """The text of some ids; begin and end have none, the prefix goes, bytes that make no character become U+FFFD."""
        told = next((k for k, i in enumerate(ids) if self.kinds[i] != CONTROL), len(ids))
        surfaces = [self.surfaces[i] for i in ids]
        # without its space the first piece may be empty; where spaces are single, the next one loses its own, too
        while told < len(ids) and ids[told] in self.led and (self.prefix or self.single):
            surfaces[told] = surfaces[told][1:]
            if not self.single or surfaces[told]:
                break
            told = next((k for k in range(told + 1, len(ids)) if self.kinds[ids[k]] != CONTROL), len(ids))
        try:
            return b"".join(surfaces).decode()
        except UnicodeDecodeError:
            return "".join(
                _characters(b"".join(surface for _, surface in run)).decode() if of_bytes else b"".join(surface for _, surface in run).decode()
                for of_bytes, run in groupby(zip(ids, surfaces, strict=True), lambda x: self.kinds[x[0]] == BYTE))


def _characters(data: bytes) -> bytes:
    try:
        data.decode()
        return data
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        first = data[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        try:
            data[at : at + size].decode()
            out.append(data[at : at + size])
            at += size
        except UnicodeDecodeError:
            out.append(REPLACEMENT)
            at += 1
    return b"".join(out)


@lru_cache(2)
def piece_model(path: str) -> PieceModel:
    with open(path, "rb") as file:
        return PieceModel(file.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids, starts, ends: the pieces of every text, with begin and end, and the bytes of the text that each stands for.

    ids, starts and ends are unsigned 32-bit numbers, little-endian, one after the other.
    The prefix space, begin and end stand for no byte; of a character that is written as
    several byte pieces the last one has its bytes. A null text counts as empty, which is
    begin and end. Rows with a null or repeated id are encoded each on its own, empty
    tables give no rows, extra columns are left out. `path` is read by the executors.
    """
    schema = StructType([docs.schema[id_col]]).add("ids", "binary").add("starts", "binary").add("ends", "binary")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in few(batches):
            out: list[tuple[bytes, bytes, bytes]] = []
            for text in batch.column(1).to_pylist():
                text = text or b""
                ids, starts, ends = model.encoded(text)
                around = [(model.begin, 0, 0)], [(model.end, len(text), len(text))]
                whole = [np.concatenate([[a], own, [z]]).astype("<u4").tobytes() for a, own, z in zip(around[0][0], (ids, starts, ends), around[1][0], strict=True)]
                out.append(tuple(whole))
            columns = zip(*out, strict=True) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.binary()) for c in columns)], schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text")).mapInArrow(pieces, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of `encoded` with their text, as `decoded`; null ids give a null text, an id that the model lacks raises IndexError."""
    schema = StructType([*encoded.schema.fields]).add("decoded", "string")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in few(batches):
            rows = batch.column("ids").to_pylist()
            out = [None if ids is None else model.decoded(np.frombuffer(ids, "<u4").tolist()) for ids in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], schema.names)

    return encoded.mapInArrow(texts, schema)
