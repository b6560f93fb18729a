"""Token ids of whole texts, as the tokenizers library gives them, with a memory of words.

A text is cut at places where the tokenizer's own rules always separate tokens, so the ids of the parts are
the ids of the text. The parts of several texts are numbered by Arrow, so that each distinct one is looked up once.
A worker remembers the ids of the parts it has met lately, up to twice ``REMEMBERED``.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache
from string import ascii_letters, digits, punctuation
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts in each of the two generations that a worker remembers, and the length from which a part isn't remembered.
REMEMBERED, LONG = 600_000, 64
#: Texts whose parts are looked up together, and the characters after which fewer are.
TOGETHER, CHARACTERS = 2000, 8_000_000
#: Texts or parts that the library encodes in one call.
AT_ONCE = 32

_SPACE = r"\s\u180e\u200b\u2060\ufeff"
_MARK = "\x02"
_OTHER_SPACE = re.compile(rf"(?![ \n])[{_SPACE}{_MARK}]")
_CUT = re.compile(rf"(?<![{_SPACE}])(?=[ \n](?![{_SPACE}])(?!\Z))")
_MARKS = frozenset(punctuation)
#: Letters that normal forms leave alone and whose small forms are among them; with the digits, and as a word with what may precede it.
_LETTERS = ascii_letters + "ªµº" + "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
_ALNUM = frozenset(_LETTERS + digits)
_WORD = re.compile(rf"({_MARK}[ \n]?)?([{_LETTERS}]+)")
#: The two sets of rules by which texts may be cut. Other files' texts are encoded whole.
_BYTE_RULES = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
_WORD_RULES = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)


def _byte_characters() -> str:
    """The character that stands for each byte in a byte-level model."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return "".join(chr(b if b in own else next(other)) for b in range(256))


_BYTES = _byte_characters()


_SPACED, _LINE = _BYTES[32], _MARK + "\n"
#: What precedes a word that has no space in front.
_BARE = (_MARK, _LINE)


class Encoder:
    """Ids of texts. ``spaces`` tells whether the tokenizer keeps white space, in front of the word that follows."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        plain = not any(w.isalnum() for t in told["added_tokens"] for w in re.findall(r"\w+|.", t["content"])[:1])
        self.special = [t["content"] for t in told["added_tokens"]]
        self.cuts = plain and told["model"]["type"] == "BPE" and (told["normalizer"], told["pre_tokenizer"]) in (_BYTE_RULES, _WORD_RULES)
        # A tokenizer with a normalizer here drops white space altogether; one without keeps it byte by byte.
        self.spaces = self.tokenizer.normalizer is None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.line = array("I", self.tokenizer.encode("\n", add_special_tokens=False).ids).tobytes()

    def spaced(self, text: str) -> str | None:
        """The text with a space between any two parts, each preceded by one in the text unless it is marked in front.

        None if white space in the text does not stand alone between other characters.
        """
        if not self.spaces:
            return text.replace("\n", " ")
        # Of the characters that are printable, only the space is a space.
        odd = not text.replace("\n", "").isprintable() and _OTHER_SPACE.search(text)
        if odd or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n":
            return None
        # Every space and line end stands alone between other characters, and belongs to what follows.
        return _MARK + text.replace("\n", f" {_MARK}\n")

    def _text(self, part: str) -> str:
        return part if not self.spaces else part[1:] if part[:1] == _MARK else " " + part

    def _word(self, part: str) -> str | None:
        """What the model takes for a part of plain letters, which is one word to the tokenizer's rules."""
        if part.isascii() and part.isalpha():
            return _SPACED + part if self.spaces else part.lower()
        found = _WORD.fullmatch(part)
        if not found or not self.spaces and found[1]:
            return None
        if not self.spaces:
            return charmap_decode(part.lower().encode(), "strict", _BYTES)[0]
        word = charmap_decode(found[2].encode(), "strict", _BYTES)[0]
        return word if found[1] in _BARE else _SPACED + word

    def _closes(self, char: str) -> bool:
        """Whether a letter or digit is still one at the end, after the tokenizer's normalizer."""
        return char in _ALNUM or char.isalnum() and (self.spaces or normalize("NFC", char).lower()[-1].isalnum())

    def _library(self, texts: list[str]) -> Iterator[bytes]:
        for begin in range(0, len(texts), AT_ONCE):
            for found in self.tokenizer.encode_batch_fast(texts[begin : begin + AT_ONCE], add_special_tokens=False):
                yield array("I", found.ids).tobytes()

    def _encode(self, parts: set[str]) -> dict[str, bytes]:
        words = list(map(self._word, parts))
        tokenize = self.model.tokenize
        found = {p: array("I", [t.id for t in tokenize(w)]).tobytes() for p, w in zip(parts, words, strict=True) if w is not None}
        if self.spaces:
            found.update({p: self.line + i for p, i in found.items() if p.startswith(_LINE)})
        rest = [p for p, w in zip(parts, words, strict=True) if w is None]
        found.update(zip(rest, self._library([self._text(p) for p in rest]), strict=True))
        return found

    def learn(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, remembered or encoded now, as little-endian 32-bit numbers."""
        ids = list(map(self.known.get, parts))
        fresh = [p for p, i in zip(parts, ids, strict=True) if i is None]
        if not fresh:
            return ids
        older = list(map(self.older.get, fresh))
        found = {p: i for p, i in zip(fresh, older, strict=True) if i is not None}
        fresh = [p for p, i in zip(fresh, older, strict=True) if i is None]
        # Letters or digits that ASCII marks end have their own ids and then those of the marks, unless a special string holds some of both.
        ended = [p for p in fresh if p[-1:] in _MARKS and self._closes(p.rstrip(punctuation)[-1:]) and not any(c in p for c in self.special)]
        heads = [p.rstrip(punctuation) for p in ended]
        mark = _MARK if self.spaces else ""
        tails = [mark + p[len(h) :] for p, h in zip(ended, heads, strict=True)]
        new = set(fresh).difference(ended)
        others = list({*heads, *tails}.difference(new, found))
        had = {w: o if k is None else k for w, k, o in zip(others, map(self.known.get, others), map(self.older.get, others), strict=True) if k is not None or o is not None}
        found.update(had)
        new.update(w for w in others if w not in had)
        found.update(self._encode(new))
        found.update({p: found[h] + found[t] for p, h, t in zip(ended, heads, tails, strict=True)})
        if len(self.known) + len(found) > REMEMBERED:
            self.older, self.known = self.known, {}
        self.known.update(found)
        for p in [p for p in found if len(p) >= LONG]:
            del self.known[p]
        return [found[p] if i is None else i for p, i in zip(parts, ids, strict=True)]

    def _joined(self, texts: pa.ListArray) -> Iterator[bytes]:
        """Ids of texts that are given in parts."""
        parts = texts.values.dictionary_encode()
        ids = pa.array(self.learn(parts.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(parts.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[texts.offsets.to_numpy()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return (bytes(data[a:b]) for a, b in zip(ends, ends[1:]))

    def _together(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return list(self._library(texts))
        spaced = [self.spaced(t) if t else None for t in texts]
        even = self._joined(pc.split_pattern(pa.array([s for s in spaced if s is not None], pa.large_string()), " "))
        odd = self._joined(pa.array([[_MARK + p for p in _CUT.split(t)] for t, s in zip(texts, spaced, strict=True) if t and s is None], pa.list_(pa.large_string())))
        return [b"" if not t else next(odd if s is None else even) for t, s in zip(texts, spaced, strict=True)]

    def raws(self, texts: list[str | None]) -> list[bytes]:
        """Ids without added special tokens, as little-endian 32-bit numbers; special strings as the library has them.

        A null text has none, as an empty one.
        """
        out: list[bytes] = []
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if len(held) >= TOGETHER or size >= CHARACTERS:
                out += self._together(held)
                held, size = [], 0
        return out + self._together(held) if held else out

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.raws([text])[0], "<u4")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker."""
    return Encoder(path)
