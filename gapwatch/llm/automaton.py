"""BPE as a deterministic automaton over tokens, built merge by merge.

States are tokens (what was read last), arcs are tokens: an arc ``y`` leaves
state ``x`` if ``x y`` can stand next to each other in a BPE tokenization.
Without merges every arc exists. The gadget of a merge ``(a, b) -> c`` takes
the arc ``b`` away from ``a``, gives ``c`` the arcs that left ``b`` at that
time, and lets ``c`` follow whatever ``a`` could follow. All tokenizations of
BPE, and no others, are paths of the result, so a word has exactly one path
to each of its prefixes and is encoded by a left-to-right walk over the table.

The full table has billions of cells. It is stored factored, as the gadgets'
copies: per token the chain of states it was copied from, each with the merge
up to which copies count. An arc is read off two short chains and then kept
in the table of arcs met so far, which has a bounded size.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gapwatch.llm.chunks import LONGEST_KEPT, ChunkIds, packed, plain_words
from gapwatch.llm.common import id_and_text, small_batches

_NEVER = 1 << 60
_MOST_ARCS = 2_000_000
_MOST_WORDS = 400_000
#: Letters of a word whose states are looked up as they are needed.
LONGEST_WALKED = 256
#: Fixed by the tokenizer file: the pattern of words (only this one is supported) and the end-of-word mark.
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
END = "</w>"


def _byte_letters() -> list[str]:
    """The printable letter that byte-level tokenizers write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class MergeAutomaton:
    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]]):
        self._ids = vocabulary
        # Chains: (state copied from, merge before which its gadgets count).
        self._after = {i: [(i, _NEVER)] for i in vocabulary.values()}
        self._before = {i: [(i, _NEVER)] for i in vocabulary.values()}
        self._rank: dict[tuple[int, int], int] = {}
        made = set()
        for rank, (first, second) in enumerate(merges):
            a, b, c = vocabulary[first], vocabulary[second], vocabulary[first + second]
            if c in made:
                raise ValueError(f"two merges make {first + second!r}")
            made.add(c)
            self._rank[a, b] = rank
            self._after[c] = [(c, _NEVER)] + [(x, min(rank, until)) for x, until in self._after[b]]
            self._before[c] = [(c, _NEVER)] + [(y, min(rank, until)) for y, until in self._before[a]]
        self._arcs: dict[tuple[int, int], bool] = {}
        # The labels read from their ends: each ending of a label, with the label's token if it is one itself.
        self._endings = {label[k:]: -1 for label in vocabulary for k in range(1, len(label))}
        self._endings.update(vocabulary)

    def has_arc(self, state: int, token: int) -> bool:
        found = self._arcs.get((state, token))
        if found is None:
            found = True
            for x, until_x in self._after[state]:
                for y, until_y in self._before[token]:
                    rank = self._rank.get((x, y))
                    if rank is not None and rank < until_x and rank <= until_y:
                        found = False
            if len(self._arcs) >= _MOST_ARCS:
                self._arcs.clear()
            self._arcs[state, token] = found
        return found

    def path(self, letters: str, end: str = END) -> list[int]:
        """The arcs (token ids) from the start to the end of a word, given as byte letters."""
        whole = self._ids.get(letters + end)
        if whole is not None:
            return [whole]
        n, endings, arcs = len(letters), self._endings.get, self._arcs
        state: list[int] = [-1] * (n + 1)
        back = [0] * (n + 1)

        def reach(i: int, tail: str) -> int:
            """The state after ``i`` letters; of earlier places only those a label of the vocabulary starts at are visited."""
            starts = []
            for j in range(i - 1, -1, -1):
                token = endings(letters[j:i] + tail if tail else letters[j:i])
                if token is None:
                    break
                if token >= 0:
                    starts.append((j, token))
            # Long labels first: there is one arc in, and it is usually one of those.
            for j, token in reversed(starts):
                if j:
                    last = state[j] if state[j] >= 0 else reach(j, "")
                    found = arcs.get((last, token))
                    if not (self.has_arc(last, token) if found is None else found):
                        continue
                state[i], back[i] = token, j
                return token
            raise ValueError(f"no path for {letters!r}")

        if n > LONGEST_WALKED:
            # In order, so that no visit leads to another.
            for i in range(1, n):
                reach(i, "")
        if n:
            reach(n, end)
        out = []
        while n:
            out.append(state[n])
            n = back[n]
        return out[::-1]


class WordBpe:
    """A word-level BPE tokenizer file (lower case, white space dropped) run as an automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        patterns = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or patterns != [WORDS]:
            raise ValueError(f"{path} is no tokenizer of the supported kind")
        self.automaton = MergeAutomaton(model["vocab"], [tuple(m) for m in model["merges"]])
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*model["vocab"].values(), *self.specials.values()]) + 1
        self.labels = [""] * size
        for label, i in [*model["vocab"].items(), *self.specials.items()]:
            self.labels[i] = label
        self._letters = _byte_letters()
        self._words = regex.compile(WORDS.replace("\\s", "\\p{White_Space}"))
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        # Words met lately: chunks differ in case and punctuation more than in words.
        self._known: dict[str, bytes] = {}
        self._ids = ChunkIds(lambda chunks: map(self._encode_chunk, chunks))

    def _encode_word(self, word: str) -> bytes:
        letters = word if word.isascii() and word.isprintable() else "".join([self._letters[b] for b in word.encode()])
        ids = packed(self.automaton.path(letters))
        if len(word) <= LONGEST_KEPT:
            if len(self._known) >= _MOST_WORDS:
                self._known.clear()
            self._known[word] = ids
        return ids

    def _encode_chunk(self, chunk: str) -> bytes:
        plain, known = plain_words(chunk), self._known.get
        if plain:
            return b"".join([known(word) or self._encode_word(word) for word in plain])
        out: list[bytes] = []
        for part in self._special.split(chunk) if self._special and "<" in chunk else [chunk]:
            if part in self.specials:
                out.append(packed([self.specials[part]]))
                continue
            if not part.isascii():
                # Letter by letter: the final form of sigma is not chosen by its place.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            for word in self._words.findall(part.lower()):
                out.append(known(word) or self._encode_word(word))
        return out[0] if len(out) == 1 else b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        return self._ids.ids(text)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        return self._ids.ids_of(texts)

    def decode(self, ids: Iterable[int]) -> str:
        """The labels of the arcs, joined by spaces, as the file names no decoder."""
        labels = self.labels
        return " ".join([labels[i] for i in ids])


@cache
def _bpe_of(path: str) -> WordBpe:
    """The automaton of a file, built once per Python worker."""
    return WordBpe(path)


def _round_trip(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.large_string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe_of(path)
        for batch in batches:
            ids = bpe.encode_all(batch.column("text").to_pylist())
            offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
            values = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                pa.array([bpe.decode(i.tolist()) for i in ids], pa.string())],
                names=schema.names)

    return run


def encode_and_decode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` of every whole text.

    The ids are those of the tokenizer file at ``path`` on every machine. Null
    and empty texts have no ids and decode to the empty string. Repeated rows
    give repeated results; other columns are left behind. Nothing is shuffled.
    """
    return small_batches(id_and_text(docs, id_column, text_column)).mapInArrow(
        _round_trip(path), "doc_id bigint, ids array<int>, decoded string")
