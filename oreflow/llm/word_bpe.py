"""Ids of a word-end BPE tokenizer, word by word with a bounded cache.

The tokenizer splits at white space before anything else, so a text's ids are
those of its words one after another. Words of plain Latin letters, digits and
signs are cut into pieces here and only their merges are asked of the
tokenizer; all others go through it whole.
"""

from __future__ import annotations

import re
import struct

#: Entries of a worker's caches of words and of their parts; emptied when full.
CACHED_WORDS, CACHED_PARTS = 500_000, 800_000

_LETTER = "a-z\xdf-\xf6\xf8-\xff"
_PLAIN = re.compile(rf"[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
#: The splitting pattern of the tokenizer file, for plain words.
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9]+")


def _byte_letters() -> dict[int, str]:
    """Printable stand-ins for bytes: itself where printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Its special tokens are found inside texts, as the library does by itself.
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit numbers."""
        known, fresh = self.words.get, self._fresh
        # Bytes split at ASCII white space only; other separators belong to words.
        return b"".join([known(w) or fresh(w) for w in text.split()])

    def _fresh(self, data: bytes) -> bytes:
        word = data.decode("utf-8", "replace")
        if len(word) <= 4096 and _PLAIN.fullmatch(word) and "<|" not in word:
            ids = b"".join([self.parts.get(p) or self._part(p) for p in _PIECES.findall(word.lower())])
        else:
            ids = _packed(self.whole.encode(word, add_special_tokens=False).ids)
        if len(data) <= 64:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            self.words[data] = ids
        return ids

    def _part(self, part: str) -> bytes:
        letters = self.letters
        mapped = "".join([letters[b] for b in part.encode()])
        ids = _packed([t.id for t in self.model.tokenize(mapped)])
        if len(part) <= 48:
            if len(self.parts) >= CACHED_PARTS:
                self.parts.clear()
            self.parts[part] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_WORKER: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process."""
    if path not in _WORKER:
        _WORKER[path] = WordEncoder(path)
    return _WORKER[path]
