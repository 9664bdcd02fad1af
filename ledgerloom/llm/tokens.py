"""Token ids of whole texts, word by word.

The tokenizer drops white space and never joins what it parts, so the ids of a
text are the ids of its words in turn. Each worker keeps the ids of the words
it has met, which is several times faster than encoding every text anew, and
memory stays small for texts of any length.
"""

from __future__ import annotations

import os
import re

import numpy as np

from ledgerloom.llm.words import WordStore

#: File name of the tokenizer, looked up in the installed package of public tokenizers.
TOKENIZER = "word_bpe_49k.json"
#: How the tokenizer's file parts lower-case text of the plain letters below.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u017F]+|[0-9]|[^\sa-z0-9\u00C0-\u017F]+")
#: ASCII and Latin letters, which normalisation leaves alone and lower-casing maps one to one.
_PLAIN = re.compile(r"[\x21-\x7E\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F]+")
_SPECIAL = "<|"
#: The byte level writes bytes that are no visible Latin-1 character as U+0100 and up, in order.
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_BYTE_LEVEL = {byte: 0x100 + place for place, byte in enumerate(_HIDDEN)}
_ENCODERS: dict[str, Encoder] = {}
#: Each id as it is written.
_WRITTEN = [number.to_bytes(2, "little") for number in range(1 << 16)]


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A path as it is, or the installed file of that name."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian unsigned 16-bit bytes."""

    def __init__(self, name: str = TOKENIZER) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path(name))
        if self._tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer need more than 16 bits")
        self._tokenize = self._tokenizer.model.tokenize
        self._parts = WordStore(self._part)
        self._words = WordStore(self._word, 600_000)

    def _part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_LEVEL)
        return b"".join([_WRITTEN[token.id] for token in self._tokenize(shown)])

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters, which are one part
            return self._part(word.decode("ascii").lower())
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and _SPECIAL not in text:
            parts = self._parts
            return b"".join([parts[part] for part in _PARTS.findall(text.lower())])
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def ids(self, text: bytes | None) -> bytes:
        """Ids of ``text``; none for null."""
        return b"".join(map(self._words.__getitem__, text.split())) if text else b""

    def count(self, word: bytes) -> int:
        """Number of ids of one word."""
        return len(self._words[word]) // 2


def encoder(name: str = TOKENIZER) -> Encoder:
    """The encoder of this Python worker."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]


def wide(ids: bytes) -> np.ndarray:
    """16-bit ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(ids, "<u2").astype("<u4")
