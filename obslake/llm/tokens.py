"""Token ids of whole texts with a tokenizer file of the ``tokenizers``
library.

A tokenizer that drops white space and runs BPE inside each piece between
white space gives the same ids for a text as for its pieces one after
another.  For such files the ids of a piece are kept in a bounded table, as
words repeat; any other file encodes texts whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from sys import byteorder

import numpy as np

from obslake.llm.common import word_blocks

# Letters (any case), then signs that the word rule keeps together; the
# apostrophe is left out as it starts English endings.
_PLAIN = re.compile(rb"([A-Za-z]+)([!-&(-/:-@\[-`{-~]*)")
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_KEPT_PIECES = 400_000  # of a generation; two are kept in a worker, about 160 MB


def _byte_letters() -> list[str]:
    """Byte-level BPE's letter for each byte: printable Latin-1 stands for
    itself, the others follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def splits_at_white_space(spec: dict) -> bool:
    """Whether a tokenizer file normalises and splits in a way that no token
    depends on anything beyond ASCII white space."""
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    norms, pres = norm.get("normalizers", []), pre.get("pretokenizers", [])
    return (
        [n["type"] for n in norms] == ["NFC", "Replace", "Lowercase"]
        and norms[1]["pattern"] == {"Regex": "\\s+"}
        and [p["type"] for p in pres] == ["Split", "ByteLevel"]
        and pres[0]["behavior"] == "Removed" and pres[0]["invert"]
        and pres[0]["pattern"]["Regex"].endswith("|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
        and not pres[1]["add_prefix_space"] and not pres[1]["use_regex"]
        and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
        and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]
                    for t in spec.get("added_tokens", []))
    )


def ids_bytes(ids: list[int]) -> bytes:
    """As little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes() if byteorder == "little" else np.array(ids, dtype="<u4").tobytes()


class Encoder(dict):
    """``encode(text)``: ids as little-endian unsigned 32-bit integers.
    The dict holds the ids of pieces; when it is full it becomes the earlier
    generation, from which pieces that still occur come back."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.earlier: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.tails: dict[bytes, bytes] = {b"": b""}
        self.letters = dict(enumerate(_byte_letters()))
        with open(path, encoding="utf-8") as f:
            self.by_piece = splits_at_white_space(json.load(f))

    def whole(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def word(self, letters: str) -> bytes:
        return ids_bytes([t.id for t in self.model.tokenize(letters)])

    def kept_word(self, lower: bytes) -> bytes:
        """Ids of a word in lower case, which may be kept as a piece."""
        ids = self.get(lower) or self.earlier.get(lower)
        if ids is None:
            letters = lower.decode() if lower.isascii() else lower.decode("latin-1").translate(self.letters)
            ids = self.word(letters)
        return ids

    def tail(self, signs: bytes) -> bytes:
        ids = self.tails.get(signs)
        if ids is None:
            ids = self.whole(signs)
            if len(self.tails) < 10_000:
                self.tails[signs] = ids
        return ids

    def piece(self, piece: bytes) -> bytes:
        if piece.isalpha():  # A-Z in either case
            return self.kept_word(piece.lower())
        if m := _PLAIN.fullmatch(piece):
            return self.kept_word(m[1].lower()) + self.tail(m[2])
        core = piece.rstrip(_SIGNS)
        text = core.decode("utf-8", "replace")
        # Below U+0250 letters are composed already and have plain lower
        # cases, but for the dotted capital I.
        if text.isalpha() and max(text) < "ɐ" and "İ" not in text:
            return self.kept_word(text.lower().encode()) + self.tail(piece[len(core):])
        return self.whole(piece)

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= _KEPT_PIECES:
            self.earlier = dict(self)
            self.clear()
        ids = self.earlier.get(piece)
        if ids is None:
            ids = self.piece(piece)
        self[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        if not self.by_piece:
            return self.whole(text)
        return b"".join([b"".join(map(self.__getitem__, words)) for words in word_blocks(text)])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker and file: workers outlive tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
