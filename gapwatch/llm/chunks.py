"""Token ids of whole texts from those of their white-space-free chunks.

A tokenizer that drops white space and never joins tokens across it gives a
text the ids of its chunks in turn. Chunks repeat, so each worker keeps the
ids of those it has met, in a memory of bounded size.
"""

from __future__ import annotations

import os
import string
import struct
from collections.abc import Callable, Iterable
from functools import cache
from itertools import chain

import numpy as np
import regex

#: Fixed by Unicode: what Python's split() takes for white space and White_Space does not.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
LONGEST_KEPT = 256
_SPACE = regex.compile(r"\p{White_Space}+")


def chunks_of(text: str) -> list[str]:
    if any(c in text for c in _NOT_SPACE):
        return [c for c in _SPACE.split(text) if c]
    return text.split()


def packed(ids: Iterable[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    ids = list(ids)
    return struct.pack(f"<{len(ids)}I", *ids)


def plain_words(chunk: str) -> tuple[str, ...] | None:
    """The words of a chunk of ASCII letters and signs behind them, as the tokenizer files cut it; None for any other."""
    if chunk.isascii():
        letters = chunk.rstrip(string.punctuation)
        if letters.isalpha():
            return (letters.lower(),) if len(letters) == len(chunk) else (letters.lower(), chunk[len(letters):])
    return None


def latin_word(chunk: str) -> tuple[str, str]:
    """The word of a chunk and the signs behind it, if it is letters up to U+00FF (which stay as they are in NFC and are
    lower-cased one by one) and then signs, which the tokenizer files cut as they do; else two empty texts."""
    letters = chunk.rstrip(string.punctuation)
    if letters.isalpha() and (letters.isascii() or max(letters) <= "\xff"):
        return letters.lower(), chunk[len(letters):]
    return "", ""


class ChunkIds:
    """Ids of texts; ``encode`` gives the ids of each of a list of chunks, as the bytes of ``packed``.

    At most ``most`` chunks of up to LONGEST_KEPT characters are remembered, about 200 bytes each.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], most: int = 400_000):
        self._encode, self._most, self._known = encode, most, {}

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; chunks that no text had before are encoded in one call for all of them."""
        split = [chunks_of(text) for text in texts]
        chunks = list(chain.from_iterable(split))
        found = list(map(self._known.get, chunks))
        places = [i for i, ids in enumerate(found) if ids is None]
        if places:
            missing = list(dict.fromkeys([chunks[i] for i in places]))
            new = dict(zip(missing, self._encode(missing)))
            for i in places:
                found[i] = new[chunks[i]]
            if len(self._known) + len(missing) > self._most:
                self._known = {}
            self._known.update(new)
            for c in missing:
                if len(c) > LONGEST_KEPT:
                    del self._known[c]
        ends = np.cumsum([len(own) for own in split]).tolist()
        return [np.frombuffer(b"".join(found[a:b]), dtype="<u4") for a, b in zip([0, *ends], ends)]

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of([text])[0]


@cache
def tokenizer_of(path: str):
    """The tokenizer of a file, loaded once per Python worker, whole texts, without threads of its own.

    Spark's tasks already use all cores; the library's threads would compete with them.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def words_only(tokenizer):
    """The tokenizer without the steps that words of ``latin_word`` no longer need: normalizing, cutting by pattern."""
    from tokenizers import Tokenizer, pre_tokenizers

    plain = Tokenizer(tokenizer.model)
    plain.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return plain
