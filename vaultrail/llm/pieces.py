"""Exact SentencePiece BPE ids by backtracking over longest matches, and texts from ids.

An encoding of a text is the one that merging gives if and only if each two neighbouring tokens, put together and merged
anew, come apart into the same two tokens: the first merge across their border would be the first in the pair as well. So a
text is covered from the left with the longest piece that an Aho-Corasick automaton finds at a place; a piece that
doesn't agree with its left neighbour gives way to the next shorter one, and where none is left the neighbour itself
does. A bitfield remembers the places from which the rest can't be covered, so each place fails at most once.

Merges never cross a place between two characters that no piece has side by side. No piece of these vocabularies has a space
after another character (verified when a model is loaded), nor any letter beside a digit or a mark; a text is cut there, and a
worker remembers the ids of the parts it has met lately.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vaultrail.llm.tables import pick

#: Parts in each of the two generations that a worker remembers, and the length from which a part isn't remembered.
REMEMBERED, LONG = 400_000, 64
#: Pairs of neighbours whose agreement a worker remembers.
PAIRS = 1_000_000
#: Texts whose parts are looked up together.
TOGETHER = 32

SPACE = "▁"
_NEVER = float("-inf")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class PieceModel:
    """A BPE model with byte fallback, whose texts are taken as they are apart from spaces."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trainer, rules = model.trainer_spec, model.normalizer_spec
        kinds = [p.type for p in model.pieces]
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: not a BPE model with byte fallback and spaces in front")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces):
            raise ValueError(f"{path}: texts would be normalised by rules that are not known here")
        if set(kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or kinds.count(_BYTE) != 256:
            raise ValueError(f"{path}: pieces of kinds that are not known here")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError(f"{path}: a piece has a space after another character")
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.end = trainer.eos_id
        self.byte = [0] * 256
        self.surface: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == _BYTE:
                value = int(p.piece[3:-1], 16)
                self.byte[value] = i
                self.surface.append(bytes([value]))
            else:
                self.surface.append({_UNKNOWN: trainer.unk_surface, _CONTROL: ""}.get(p.type, p.piece.replace(SPACE, " ")).encode())
        self.begins = np.array([p.type == _NORMAL and p.piece[:1] == SPACE for p in model.pieces])
        self.silent = np.array([p.type == _CONTROL for p in model.pieces])
        self.matches = ahocorasick.Automaton()
        # A piece that merging never makes of its own text takes no part.
        self.made = {p for p in self.ids if self.merged(p) == [p]}
        for piece in self.made:
            self.matches.add_word(piece, len(piece))
        self.matches.make_automaton()
        # Between two characters that no piece has side by side nothing merges, so texts are cut around those in no pair.
        joined = {c for p in self.made if len(p) > 1 for c in p} - {SPACE}
        word = "".join(map(re.escape, sorted(joined)))
        self.parts = re.compile(f"{SPACE}*[{word}]+|{SPACE}+|[^{SPACE}{word}]+").findall
        self.prefix: dict[str, str | None] = {}
        self.agree: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str, border: int = 0) -> list[str] | None:
        """The text in pieces by merging: the pair of highest score first, of equal ones the leftmost.

        None as soon as a merge crosses the ``border`` (a number of characters), if one is given.
        """
        parts, score = list(text), self.score.get
        values = [score(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        first = border  # the part that begins at the border
        while values:
            best = max(values)
            if best == _NEVER:
                break
            at = values.index(best)
            if at < first:
                if at + 1 == first:
                    return None
                first -= 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del values[at]
            if at:
                values[at - 1] = score(parts[at - 1] + parts[at], _NEVER)
            if at < len(values):
                values[at] = score(parts[at] + parts[at + 1], _NEVER)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether two pieces that stand side by side stay as they are when their text is merged anew."""
        if len(self.agree) >= PAIRS:
            self.agree.clear()
        known = self.agree[left, right] = self.merged(left + right, len(left)) == [left, right]
        return known

    def shorter(self, piece: str) -> str | None:
        """The longest piece, or single character, that the piece begins with."""
        if piece not in self.prefix:
            self.prefix[piece] = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if n == 1 or piece[:n] in self.made), None)
        return self.prefix[piece] if len(piece) > 1 else None

    def cover(self, text: str) -> list[str]:
        """The pieces of a text; a character without a piece stands alone."""
        longest = [1] * len(text)
        for end, length in self.matches.iter(text):
            longest[end + 1 - length] = length  # ends ascend, so the longest comes last
        size, agree = len(text), self.agree
        possible = bytearray(b"\1") * (size + 1)
        chosen: list[str] = []
        last, at = "", 0
        piece: str | None = text[: longest[0]] if text else None
        while piece is not None:
            end = at + len(piece)
            if possible[end]:
                fits = not last or agree.get((last, piece))
                if fits is None:
                    fits = self.compatible(last, piece)
                if fits:
                    chosen.append(piece)
                    last, at = piece, end
                    piece = text[at : at + longest[at]] if at < size else None
                    continue
            piece = self.shorter(piece)
            if piece is None:
                # Nothing fits from here on: the piece before has to end elsewhere.
                possible[at] = 0
                piece = chosen.pop()
                at -= len(piece)
                last = chosen[-1] if chosen else ""
        return chosen

    def part_ids(self, part: str) -> bytes:
        """Ids of a part, as little-endian 32-bit numbers."""
        out: list[int] = []
        for piece in self.cover(part):
            known = self.ids.get(piece)
            out.extend([known] if known is not None else [self.byte[b] for b in piece.encode()])
        return array("I", out).tobytes()

    def learn(self, parts: set[str]) -> dict[str, bytes]:
        fresh = parts.difference(self.known)
        if not fresh:
            return self.known
        found = {p: self.older[p] if p in self.older else self.part_ids(p) for p in fresh}
        kept = {p: i for p, i in found.items() if len(p) < LONG}
        if len(self.known) + len(kept) > REMEMBERED:
            before, self.older, self.known = self.known, self.known, kept
            return {p: found[p] if p in found else before[p] for p in parts}
        self.known.update(kept)
        return self.known if len(kept) == len(found) else {p: found[p] if p in found else self.known[p] for p in parts}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts without begin or end, as little-endian 32-bit numbers; a null text has none."""
        out: list[bytes] = []
        for begin in range(0, len(texts), TOGETHER):
            parts = [self.parts(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts[begin : begin + TOGETHER]]
            known = self.learn(set().union(*parts))
            out += [b"".join(map(known.__getitem__, p)) for p in parts]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: one leading space goes, control ids are silent, bytes that are no UTF-8 become U+FFFD each."""
        silent = np.flatnonzero(self.silent[ids])
        loud = ids if not len(silent) else np.delete(ids, silent)
        raw = b"".join(map(self.surface.__getitem__, loud.tolist()))
        spaced = bool(len(loud)) and bool(self.begins[loud[0]])
        try:
            if len(silent) and silent[0] < len(loud):
                # Bytes on both sides of a silent id are no common character.
                return "".join(_text(b"".join(map(self.surface.__getitem__, x[~self.silent[x]].tolist()))) for x in np.split(ids, silent))[spaced:]
            return raw[spaced:].decode()
        except UnicodeDecodeError:
            return _text(raw[spaced:])


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return _mended(raw)


def _mended(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        size = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
        try:
            out.append(raw[at : at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model for each file and worker."""
    return PieceModel(path)


def _encoded(path: str, end: bool, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        tail = array("I", [model.end] if end else []).tobytes()
        for batch in batches:
            for begin in range(0, len(batch), 100):
                part = batch.slice(begin, 100)
                raws = [raw + tail for raw in model.encode(part.column("text").to_pylist())]
                bounds = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raws])])
                ids = np.frombuffer(b"".join(raws), "<i4")
                columns = {"doc_id": part.column("doc_id").cast(pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))}
                if decoded:
                    columns["decoded"] = pa.array([model.decode(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def encode(documents: DataFrame, path: str, end: bool = True, decoded: bool = False) -> DataFrame:
    """Per row: doc_id, ids of the whole text as the library gives them (``end`` adds the end id), on request the text decoded again.

    A null text is empty: no ids but the end. Every row counts, repeated ones and those without doc_id too, and very long
    texts are encoded whole; an empty table gives none; other columns are ignored.
    """
    schema = "doc_id long, ids array<int>" + (", decoded string" if decoded else "")
    return pick(documents, "doc_id", "text").mapInArrow(_encoded(path, end, decoded), schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id and the text of its ids. Null ids give an empty text; an id outside the vocabulary fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            texts = [model.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pick(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, text string")
