"""Byte-level BPE ids of whole texts through the tokenizers library.

The pre-tokenizer of a byte-level BPE never joins a lone space or a lone line
break to what stands before it, so a text falls into chunks at those places whose
ids do not depend on each other; punctuation that ends a chunk stands apart from
the word as well. A worker keeps the ids of chunks it has seen (bounded) and asks
the library for the others; those that are a single word go to the library's model,
past the pre-tokenizer. A text in which a space or line break touches more white space is
given to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

END_ID = 0
CACHED_CHUNKS = 400_000  # about 80 MB in a worker
_END = np.array([END_ID], dtype="<u4").tobytes()
_TOUCHING = re.compile(r"\x00|[ \n]\s|\s[ \n]")
_MARKS = ".,;:!?"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 bytes stand for themselves, the others for the letters from
    256 on in their order.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class _Chunks(dict):
    """Ids of the chunks met so far; asks ``encode`` for one that is missing."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self._encode(chunk)
        return ids


class Encoder:
    """Ids by a vocabulary file; keeps those of up to ``cached_chunks`` chunks.

    When there are more, the fifth met first stays: mostly the common ones.
    """

    def __init__(self, vocabulary: str, cached_chunks: int = CACHED_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._tokenize = self._tokenizer.model.tokenize
        letters = _byte_letters()
        self._letters = dict(enumerate(letters))
        self._space = letters[ord(" ")]
        self._known = _Chunks(self._chunk)
        self._cached_chunks = cached_chunks

    def _library(self, text: str) -> bytes:
        encoded = self._tokenizer.encode(text, add_special_tokens=False)
        return array("I", encoded.ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        word = chunk.rstrip(_MARKS)
        if len(word) < len(chunk) and word[-1:].isalnum():
            return self._known[word] + self._known[chunk[len(word) :]]
        if not chunk.lstrip(" ").isalpha():
            return self._library(chunk)
        # a word of letters, with or without a space before: one piece for the model
        if chunk.isascii():
            spelled = chunk.replace(" ", self._space)
        else:
            spelled = chunk.encode().decode("latin-1").translate(self._letters)
        return array("I", [token.id for token in self._tokenize(spelled)]).tobytes()

    def ids(self, text: str | None) -> bytes:
        """Ids of the text and the end id, as little-endian unsigned 32-bit integers."""
        if not text:
            return _END
        spaced = text.replace("\n", " ")
        if "  " in spaced or not spaced.isprintable():  # white space besides lone ones
            if _TOUCHING.search(text):
                return self._library(text) + _END
        known = self._known
        if len(known) > self._cached_chunks:
            for chunk in list(known)[self._cached_chunks // 5 :]:
                del known[chunk]
        chunks = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
        return b"".join(map(known.__getitem__, chunks)) + _END


@lru_cache(maxsize=1)
def encoder(vocabulary: str, cached_chunks: int = CACHED_CHUNKS) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(vocabulary, cached_chunks)
