"""Token ids of texts with a public tokenizer, with a memo of pieces.

The tokenizer lower-cases, cuts a text into runs of letters, single digits and runs of marks, and
never looks across a cut, so the ids of a text are those of its pieces, one after the other. Texts
of plain Latin letters, digits and marks are cut here and each new piece goes through the
tokenizer's own model once; any other text goes through the tokenizer as a whole. Tests hold both
ways against each other.
"""

from __future__ import annotations

import re
import struct

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*\Z")  # no marks to compose, and letters that have one small form
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


class Encoder:
    """Ids as little-endian integers of the smallest of two or four bytes that the vocabulary fits."""

    def __init__(self, path: str, memo: int = 500_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}
        self.limit = memo
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(33, 256) if _PLAIN.match(chr(c))]
        self.bytes_of = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        # the short way holds for tokenizers that treat a probe of its cases alike
        probe = "".join(letters) + " It's we'll DON'T 12a É'd !?s'\n\tx\x0by " + " ".join(letters)
        self.short = self._pieces(probe) == self._whole(probe)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize(piece.translate(self.bytes_of))]
        found = struct.pack(f"<{len(ids)}{self.code}", *ids)
        if len(self.memo) < self.limit:
            self.memo[piece] = found
        return found

    def _pieces(self, text: str) -> bytes:
        get, new = self.memo.get, self._piece
        return b"".join([new(p) if (found := get(p)) is None else found for p in _PIECE.findall(text.lower())])

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, without special tokens around it."""
        if self.short and _PLAIN.match(text) and not any(s in text for s in self.special):
            return self._pieces(text)
        return self._whole(text)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker and vocabulary file; its memo lasts as long as the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
