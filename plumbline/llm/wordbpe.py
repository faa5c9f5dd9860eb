"""Encoding with a ``tokenizers`` file in which a worker encodes each word once.

Byte-pair merges never cross the pieces that the tokenizer's own pattern cuts a text into, and that
pattern always cuts where white space meets a word. Texts are therefore cut into words with the
space before them, and the ids of words met before are looked up. A new word of ASCII characters is
cut by the pattern and given to the library's model piece by piece; other plain words go to the
library as they are. A lower-casing tokenizer drops white space, so any of it will do there. A text
with a character on which Unicode versions may differ, or with a special token in it, goes to the
library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import regex

# Characters on which all Unicode versions agree about case, class and composition.
PLAIN = "\\t-\\r\\x20-\\x7e¡-įı-ɏ‐-‧‰-⁞€"

UNUSUAL = re.compile(f"[^{PLAIN}]")
#: Characters that neither words nor the white space of plain texts hold; some of them split Python's words.
CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
#: Before a word that follows no space.
FIRST = "\x02"
#: Before white space that stands for itself.
SPACE = "\x03"
#: What often ends a word, as pieces of its own.
TAIL = ",.;:!?"
#: Words with the one space before them, and white space: of a run, the last character stands apart if a word follows.
RUNS = re.compile(r" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
#: Pieces of an ASCII word, as the patterns of the two kinds of tokenizer cut it.
# The patterns of the two kinds of tokenizer, for words with at most one space, before them.
PIECES = regex.compile(r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^ \p{L}\p{N}]+")
PIECES_LOWERED = regex.compile(r"'(?:s|t|re|ve|m|ll|d)|\p{L}+|\p{N}|[^\p{L}\p{N}]+")
#: A cut word that needs no closer look: visible characters only.
VISIBLE = re.compile(rf"{FIRST}?[!-~¡-įı-ɏ‐-‧‰-⁞€]+")

#: Words whose ids a worker remembers: two generations of this many. A word met again moves to the younger one.
REMEMBERED = 200_000


class _Uneven(Exception):
    """A text can't be cut in the plain way."""


class _Known(dict):
    """Ids of words; a missing word comes from the elder generation or is encoded."""

    def __init__(self, make):
        super().__init__()
        self.make, self.elder = make, {}

    def __missing__(self, word: str) -> bytes:
        got = self.elder.get(word)
        if got is None:
            got = self.make(word)
        if len(self) >= REMEMBERED:
            self.elder = dict(self)
            self.clear()
        self[word] = got
        return got


class WordEncoder:
    """Ids of texts as little-endian unsigned 16- or 32-bit numbers, equal to the library's ``encode``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocab = self.library.get_vocab(with_added_tokens=False)
        self.lowered = any(w.endswith("</w>") for w in vocab)
        #: Bytes as the characters that a byte-level tokenizer writes for them: those that Latin-1 can't show follow from 256 on.
        hidden = [i for i in range(256) if not (33 <= i <= 126 or 161 <= i <= 172 or i >= 174)]
        self.alphabet = {c: 256 + i for i, c in enumerate(hidden)}
        self.tokens = [self.library.id_to_token(i) or "" for i in range(self.size)]
        self.known = _Known(self._lowered_word if self.lowered else self._word)

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _of(self, pieces: list[str]) -> bytes:
        """Ids of pieces, each written in the byte-level alphabet for the library's model."""
        return self._pieces([p.encode("utf-8").decode("latin-1").translate(self.alphabet) for p in pieces])

    def _word(self, word: str) -> bytes:
        """Ids of a cut word, its space included."""
        if word.isalpha() and word.isascii():
            return self._pieces(["Ġ" + word])
        core = word.rstrip(TAIL)
        if core != word and core.isalpha():
            return self.known[core] + self.known[FIRST + word[len(core) :]]
        if VISIBLE.fullmatch(word):
            return self._of(PIECES.findall(word[1:] if word[0] == FIRST else f" {word}"))
        if word == "\n" or word[:1] == SPACE:
            return self._whole(word.lstrip(SPACE))
        raise _Uneven

    def _pieces(self, pieces: list[str]) -> bytes:
        cut = self.model.tokenize
        return array(self.kind, [t.id for p in pieces for t in cut(p)]).tobytes()

    def _lowered_word(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            return self._pieces([word])
        core = word.rstrip(TAIL)
        if core != word and core.isalpha():
            return self.known[core] + self.known[word[len(core) :]]
        return self._of(PIECES_LOWERED.findall(word))

    def _encoded(self, text: str) -> bytes:
        if any(s in text for s in self.special) or not text.isascii() and UNUSUAL.search(text):
            return self._whole(text)
        get = self.known.__getitem__
        if self.lowered:
            return self._whole(text) if CONTROL.search(text) else b"".join(map(get, text.lower().split()))
        if FIRST in text or SPACE in text:
            return self._whole(text)
        try:
            return b"".join(map(get, (FIRST + text.replace("\n", f" \n {FIRST}")).split(" ")))
        except _Uneven:
            pass
        if CONTROL.search(text):
            return self._whole(text)
        return b"".join(get(SPACE + x if x.isspace() else x[1:] if x[0] == " " else FIRST + x) for x in RUNS.findall(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(self._encoded, texts))

    def ids(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.dtype)

    def decode(self, raw: bytes) -> str:
        """As the library's ``decode(ids, skip_special_tokens=False)``."""
        if self.library.decoder is None:
            return " ".join(map(self.tokens.__getitem__, self.ids(raw).tolist()))
        return self.library.decode(self.ids(raw).tolist(), skip_special_tokens=False)


@lru_cache(2)
def word_encoder(path: str) -> WordEncoder:
    """A worker's encoder for a file, loaded once."""
    return WordEncoder(path)
