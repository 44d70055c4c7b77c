"""Packing of token sequences under several limits at once.

Vector bin packing by the dot-product heuristic: every piece has a demand
(tokens, one segment, loss-bearing tokens), every open sequence what is left
of each limit, and the piece whose demand points most in the direction of what
is left, among those that fit, is placed next. Where cutting is allowed the
piece chosen last is cut to fill the sequence.

Each task packs the documents it reads: nothing is shuffled, a document of any
length is cut into pieces, and what is lost to padding is one unfinished
sequence per task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.chunks import LONGEST_KEPT, ChunkIds, latin_word, packed, tokenizer_of, words_only
from gapwatch.llm.common import small_batches

#: Pieces that compete for a place at a time.
POOL = 4096
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("segment", pa.int32()), ("offset", pa.int64())])
DDL = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, loss_tokens bigint, "
       "sequence_id bigint, segment int, offset bigint")


class Packer:
    """Places pieces into sequences; ``place`` and ``finish`` give finished placements.

    ``loss`` of a piece marks, per token, whether it bears loss (None: all do).
    """

    def __init__(self, first_id: int, tokens: int, segments: int, loss_tokens: int, cut: bool):
        if min(tokens, segments, loss_tokens) < 1:
            raise ValueError("every limit must be at least 1")
        self._limits = np.array([tokens, segments, loss_tokens], dtype=np.float64)
        self._next, self._cut = first_id, cut
        self._pieces: list[tuple | None] = []

    def _demand(self, piece: tuple) -> tuple[int, int, int]:
        _, _, ids, _, loss = piece
        return len(ids), 1, len(ids) if loss is None else int(loss.sum())

    def add(self, piece: tuple) -> None:
        """A piece is (document, its first token's place, ids, tokens of the document, loss marks)."""
        self._pieces.append(piece)

    def __len__(self) -> int:
        return len(self._pieces)

    def _head(self, piece: tuple, left: np.ndarray) -> int:
        """Tokens of ``piece`` that fit into what is left."""
        most = int(left[0])
        loss = piece[4]
        if loss is None:
            return min(most, int(left[2]), len(piece[2]))
        used = np.cumsum(loss[:most])
        return min(most, int(np.searchsorted(used, left[2], side="right")), len(piece[2]))

    def pack(self, until: int) -> Iterator[tuple]:
        """Fill sequences until at most ``until`` pieces are left: (piece, sequence, segment, offset)."""
        pieces = self._pieces
        # one row per limit; a piece that was placed demands more than there is
        demands = np.array([self._demand(p) for p in pieces], dtype=np.float64).reshape(-1, 3).T.copy()
        gone, count = float(self._limits.max()) * 2, len(pieces)
        while count > until:
            left, segment, offset = self._limits.copy(), 0, 0
            while count:
                fits = (demands[0] <= left[0]) & (demands[1] <= left[1]) & (demands[2] <= left[2])
                along = self._along(demands, left)
                along[~fits] = -1.0
                best = int(along.argmax())
                if fits[best]:
                    piece = pieces[best]
                    pieces[best], demands[:, best] = None, gone
                    count -= 1
                else:
                    head, best = 0, -1
                    if (self._cut or not segment) and left[1] >= 1 and left[0] >= 1:
                        along = self._along(demands, left)
                        along[demands[1] == gone] = -1.0
                        best = int(along.argmax())
                        head = self._head(pieces[best], left)
                    if head < 1:
                        break
                    doc, start, ids, total, loss = pieces[best]
                    piece = (doc, start, ids[:head], total, None if loss is None else loss[:head])
                    pieces[best] = (doc, start + head, ids[head:], total, None if loss is None else loss[head:])
                    demands[:, best] = self._demand(pieces[best])
                yield piece, self._next, segment, offset
                left -= self._demand(piece)
                segment += 1
                offset += len(piece[2])
                if left[0] < 1 or left[1] < 1:
                    break
            self._next += 1
        self._pieces = [p for p in pieces if p is not None]

    def _along(self, demands: np.ndarray, left: np.ndarray) -> np.ndarray:
        return (left / self._limits / self._limits) @ demands


def _rows(placed: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    out: dict[str, list] = {f.name: [] for f in _SCHEMA}
    for (doc, start, ids, total, loss), sequence, segment, offset in placed:
        for name, value in zip(out, (doc, start, len(ids), ids.tobytes(), total,
                                     len(ids) if loss is None else int(loss.sum()), sequence, segment, offset)):
            out[name].append(value)
        if len(out["start"]) >= 2048:
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _SCHEMA], schema=_SCHEMA)
            out = {f.name: [] for f in _SCHEMA}
    if out["start"]:
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _SCHEMA], schema=_SCHEMA)


class WordIds:
    """Ids of chunks, as the bytes of ``packed``; words met lately are remembered, new ones go to the library many at a time.

    ``plain`` encodes lines of words of ``latin_word`` (default: the tokenizer itself).
    """

    def __init__(self, tokenizer, plain=None, most: int = 400_000, at_once: int = 256):
        self._tokenizer, self._plain = tokenizer, plain or tokenizer
        self._most, self._at_once, self._known = most, at_once, {}
        vocabulary, end = tokenizer.get_vocab(with_added_tokens=False), tokenizer.model.end_of_word_suffix
        self._ends = np.zeros(tokenizer.get_vocab_size() + 1, dtype=bool)
        self._ends[[i for label, i in vocabulary.items() if end and label.endswith(end)]] = True

    def _each(self, words: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _together(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters: those of a line of them, cut behind each last token of a word."""
        lines = [words[at: at + self._at_once] for at in range(0, len(words), self._at_once)]
        for line, found in zip(lines, self._plain.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(found.ids, dtype="<u4")
            bounds = (4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()
            if len(bounds) != len(line):
                yield from self._each(line)
                continue
            raw = ids.tobytes()
            yield from [raw[a:b] for a, b in zip([0, *bounds], bounds)]

    def __call__(self, chunks: list[str]) -> list[bytes]:
        if len(self._known) > self._most:
            self._known.clear()
        known, heads, tails, other = self._known, [], [], []
        for chunk in chunks:
            word, sign = latin_word(chunk)
            heads.append(word or chunk)
            tails.append(sign)
            if not word:
                other.append(chunk)
        known[""] = b""
        other = [c for c in dict.fromkeys(other + tails) if c not in known]
        known.update(zip(other, self._each(other)))
        plain = list(dict.fromkeys([w for w in heads if w not in known]))
        known.update(zip(plain, self._together(plain)))
        ids = list(map(add, map(known.__getitem__, heads), map(known.__getitem__, tails)))
        for w in chain(plain, other):
            if len(w) > LONGEST_KEPT:
                del known[w]
        return ids


def _pack_batches(path: str, end: int | None, limits: dict, has_loss: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(path)
        encoder = ChunkIds(WordIds(tokenizer, words_only(tokenizer)), most=600_000)
        packer = Packer(TaskContext.get().partitionId() << 33, **limits)
        last = np.array([] if end is None else [end], dtype="<u4")
        for batch in batches:
            encoded = encoder.ids_of(batch.column("text").to_pylist())
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                ids = np.concatenate((encoded[i], last)).astype("<u4")
                bears = None
                if has_loss:
                    bears = np.full(len(ids), bool(batch.column("bears_loss")[i].as_py()))
                step = limits["tokens"]
                for at in range(0, len(ids), step):
                    packer.add((doc_id, at, ids[at: at + step], len(ids), None if bears is None else bears[at: at + step]))
                if len(packer) >= POOL:
                    yield from _rows(packer.pack(POOL // 4))
        yield from _rows(packer.pack(0))

    return pack


def pack(
    docs: DataFrame, path: str, tokens: int = 2048, segments: int = 256, loss_tokens: int | None = None,
    cut: bool = True, end: int | None = 1, id_column: str = "doc_id", text_column: str = "text",
    loss_column: str | None = None,
) -> DataFrame:
    """One row per piece of a document: its tokens, and its place in a sequence.

    A sequence has at most ``tokens`` tokens, ``segments`` pieces and
    ``loss_tokens`` loss-bearing tokens (default: as many as tokens). The
    tokens of a row bear loss unless its ``loss_column`` is false or null.
    ``end`` is the id appended to each text. Without ``cut`` a text is cut only
    where it alone exceeds a limit.

    Columns: ``doc_id, start, length, ids`` (little-endian 32-bit), ``doc_tokens,
    loss_tokens, sequence_id, segment, offset``. Null and empty texts are just
    the end id (no row without one). Repeated rows are packed each on its own.
    An empty table gives no rows. Sequence numbers are unique, not gapless;
    they and the placement follow the partitions that ``docs`` is read in.
    """
    columns = [F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")]
    if loss_column:
        columns.append(F.coalesce(F.col(loss_column), F.lit(False)).alias("bears_loss"))
    limits = {"tokens": tokens, "segments": segments, "loss_tokens": loss_tokens or tokens, "cut": cut}
    return small_batches(docs.select(*columns)).mapInArrow(_pack_batches(path, end, limits, bool(loss_column)), DDL)
