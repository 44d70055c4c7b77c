"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is its tokens: words (A-Z lower-cased, cut at white space), then one
end. A word is its bytes and a space, the end a sign of its own; each byte is a
path of bits in a fixed binary code that is short for frequent bytes.

* Predictors: for each context (the last 1, 2, 3, 4 symbols, which reach into the
  word before; all bytes of the word so far; these and the whole word before) a
  hashed table counts which symbol followed, over all training texts. A bit's
  prediction is the log odds of a one among the symbols that its place in the
  code leaves possible.
* Mixing: predictions are summed in the logistic domain with weights learned
  online, a step at a time, each bit predicted from all counts but its own. Two mixers are gated
  differently: by the place in the code, and by how often the longest contexts
  were met.
* Refinement: a word's probability by its bits is blended with that by its count
  in the training texts (which gives an unseen word nothing but a share of its
  spelling by the bits) and, along a text, with how often the text has used it so
  far. Each mixer, share and strength is one blend; a text weights the blends by
  how well they have predicted it up to there (Bayes).

The score is the log probability of the token sequence. No context reaches further
back than the word before, so blocks of texts need the bits of each distinct
pair of neighbours once. All texts count; tables have a fixed number
of slots, so the model that is broadcast has a fixed bound.

Counts of whole words for the base score are summed by hash ranges, whose number
grows with the input: no dictionary is collected or broadcast.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.common import groups, id_and_text, small_batches, written
from gapwatch.llm.shingles import lowered, mixed, word_spans

#: Symbols in the order of their usual frequency; the rest of the bytes share an escape.
_COMMON = b" etaoinshrdlucmfwgypbvk,.jxqz\xc3\xa9-'\"0123456789!?:;()"
END, SYMBOLS = 94, 96
ESCAPE = SYMBOLS - 1
#: Bits of the slots of each context: 1, 2, 3, 4 symbols, all bytes of the word so far, these and the word before.
SLOT_BITS = (7, 13, 14, 15, 15, 16)
CONTEXTS = len(SLOT_BITS)
LAST = CONTEXTS - 2
SPREAD = np.uint64(0x9E3779B97F4A7C15)
PRIOR = 0.15
RANGE_BITS = 10
LEVELS = 6
#: Strengths (in tokens) of what the model says against what the text has used; the last one ignores the text.
STRENGTHS = (150.0, 1500.0, np.inf)
#: Shares of the whole-word counts in the blends; the rest is the bits' probability, which any word has.
WORD_SHARES = (0.6, 0.96)
BLOCK_TOKENS = 500_000
BLOCK_DOCS = 50_000
TOKENS_A_RANGE = 5_000_000
#: Words whose contexts are made at once.
UNITS = 2000
EVEN = 0.3
END_HASH = np.uint64(0x0E4D0E4D0E4D0E4D)


@dataclass
class Code:
    symbol_of: np.ndarray
    length: np.ndarray
    first: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    under: np.ndarray


def _code() -> Code:
    """A Huffman code of weights that fall with the place in the order of frequency."""
    order = list(_COMMON)
    order += [b for b in [*range(0x21, 0x7F), 0xC2, *range(0xA0, 0xC0)] if b not in order and not 65 <= b <= 90]
    order = order[:END]
    symbol_of = np.full(256, ESCAPE, dtype=np.uint8)
    symbol_of[order] = np.arange(len(order))
    weight = [1 / (i + 8) ** 2 for i in range(SYMBOLS)]
    weight[END] = weight[40]
    heap = [(w, i, i) for i, w in enumerate(weight)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    while len(heap) > 1:
        (w, _, a), (v, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        children.append((a, b))
        heapq.heappush(heap, (w + v, SYMBOLS + len(children), SYMBOLS + len(children) - 1))
    paths: dict[int, list] = {}
    waiting: list[tuple[int, list]] = [(SYMBOLS + len(children) - 1, [])]
    while waiting:
        node, path = waiting.pop()
        if node < SYMBOLS:
            paths[node] = path
        else:
            waiting += [(child, [*path, (node - SYMBOLS, bit)]) for bit, child in enumerate(children[node - SYMBOLS])]
    nodes, bits = [], []
    under = np.zeros((2, SYMBOLS, SYMBOLS - 1), dtype=np.float32)
    for s in range(SYMBOLS):
        for at, b in paths[s]:
            nodes.append(at)
            bits.append(b)
            under[b, s, at] = 1
    length = np.array([len(paths[s]) for s in range(SYMBOLS)])
    return Code(symbol_of, length, np.cumsum(length) - length, np.array(nodes), np.array(bits, dtype=np.float32), under)


CODE = _code()


def symbols_of(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of words (bytes in a row) with a space after each; a word of no bytes is the end sign."""
    sizes = np.maximum(lengths, 0) + 1
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    last = np.cumsum(sizes) - 1
    inner = np.ones(len(out), dtype=bool)
    inner[last] = False
    out[inner] = CODE.symbol_of[words]
    out[last[lengths == 0]] = END
    return out, sizes


class Spelled:
    """Distinct words as symbols, with what the contexts take from a word: its symbols so far, its end, its hash."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        self.symbols, self.sizes = symbols_of(words, lengths)
        n = len(self.symbols)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.age = np.arange(n) - np.repeat(self.firsts, self.sizes)
        held = self.symbols.astype(np.uint64) + np.uint64(1)
        self.last = np.zeros(n, dtype=np.uint64)
        ends = self.firsts + self.sizes - 1
        self.ending = np.zeros(len(self.sizes), dtype=np.uint64)
        for k in range(LAST):
            shifted = np.zeros(n, dtype=np.uint64)
            shifted[k + 1:] = held[:-k - 1]
            shifted[self.age <= k] = 0
            self.last |= shifted << np.uint64(7 * k)
            self.ending |= np.where(self.sizes > k, held[np.maximum(ends - k, 0)], 0).astype(np.uint64) << np.uint64(7 * k)
        # All bytes so far: a hash that is carried along the word, one step for all words at a time.
        self.whole = np.zeros(n, dtype=np.uint64)
        self.whole[self.firsts] = 7
        live, left = self.firsts[self.sizes > 1], self.sizes[self.sizes > 1] - 1
        carry, at = np.full(len(live), 7, dtype=np.uint64), 0
        while len(live):
            carry = mixed(carry * np.uint64(31) + held[live + at])
            at += 1
            self.whole[live + at] = carry
            more = left > at
            live, left, carry = live[more], left[more], carry[more]
        self.hash = self.whole[ends]


def pairs_of(index: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """For each token its word and the word before it in its text (0: none, else 1 and more), as one number.

    Sorted, pairs of one word stand together, so the slots that they share are still in the cache.
    """
    before = np.concatenate(([-1], index[:-1])).astype(np.int64)[: len(index)]
    before[(np.cumsum(per_text) - per_text)[per_text > 0]] = -1
    return index.astype(np.int64) << 32 | before + 1


def _unpaired(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pairs >> 32, (pairs & 0xFFFFFFFF) - 1


def context_slots(words: Spelled, own: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Symbols of the words ``own``, their number per word, and each symbol's slot in each context.

    The contexts go on into the words ``before`` (-1: a text starts here): the last 1 to 4 symbols, the bytes of
    the word so far, and these together with the whole word before.
    """
    sizes = words.sizes[own]
    at = np.arange(int(sizes.sum())) + np.repeat(words.firsts[own] - (np.cumsum(sizes) - sizes), sizes)
    none = before < 0
    ending = np.where(none, np.uint64(0), words.ending[before])
    whole_before = np.where(none, np.uint64(0), words.hash[before])
    reach = np.minimum(words.age.take(at), LAST).astype(np.uint64) * np.uint64(7)
    last = words.last.take(at) | np.repeat(ending, sizes) << reach
    slots = [(last & np.uint64(127)).astype(np.int64)]
    for k in range(2, LAST + 1):
        slots.append((last & np.uint64((1 << 7 * k) - 1), SLOT_BITS[k - 1]))
    whole = words.whole.take(at)
    slots.append((whole, SLOT_BITS[LAST]))
    slots.append((whole ^ np.repeat(whole_before * SPREAD, sizes), SLOT_BITS[LAST + 1]))
    slots[1:] = [(((context + np.uint64(1)) * SPREAD) >> np.uint64(64 - bits)).astype(np.int64) for context, bits in slots[1:]]
    return words.symbols.take(at), sizes, slots


def _alone(words: np.ndarray, lengths: np.ndarray) -> tuple[Spelled, np.ndarray, np.ndarray]:
    """Words that each start a text."""
    return Spelled(words, lengths), np.arange(len(lengths)), np.full(len(lengths), -1)


class Counts:
    """Symbol counts per context slot."""

    def __init__(self):
        self.tables = [np.zeros((1 << b) * SYMBOLS, dtype=np.int64) for b in SLOT_BITS]

    def add(self, words: np.ndarray, lengths: np.ndarray, counts: np.ndarray, pairs: np.ndarray | None = None) -> None:
        """Words (each at the start of a text), or ``pairs`` of them, each met ``counts`` times."""
        spelled, own, before = _alone(words, lengths)
        if pairs is not None:
            own, before = _unpaired(pairs)
        for at in range(0, len(own), UNITS):
            part = slice(at, at + UNITS)
            symbols, sizes, slots = context_slots(spelled, own[part], before[part])
            times = np.repeat(counts[part], sizes)
            for table, slot in zip(self.tables, slots):
                np.add.at(table, slot * SYMBOLS + symbols, times)


@dataclass
class Model:
    """``odds``: per context, slot x node; ``levels``: familiarity of the two longest contexts; the mixers' weights.

    With ``left_out``, odds are per slot x node x value of the bit, from the counts without that bit itself.
    """

    odds: list[np.ndarray]
    levels: list[np.ndarray]
    by_node: np.ndarray
    by_gate: np.ndarray
    left_out: bool = False


def _levels(tables: list[np.ndarray], left_out: int) -> list[np.ndarray]:
    many = [np.maximum(t.reshape(-1, SYMBOLS).sum(axis=1) - left_out, 0) for t in tables[-2:]]
    return [np.minimum(LEVELS - 1, np.log2(n + 1) / 2.5).astype(np.int64) for n in many]


def _even() -> tuple[np.ndarray, np.ndarray]:
    even = np.full(CONTEXTS, EVEN)
    return np.tile(even, (SYMBOLS - 1, 1)), np.tile(even, (LEVELS * LEVELS, 1))


def untrained(tables: list[np.ndarray]) -> Model:
    odds = []
    for table in tables:
        counts = table.reshape(-1, SYMBOLS).astype(np.float32)
        odds.append(np.log((counts @ CODE.under[1] + PRIOR) / (counts @ CODE.under[0] + PRIOR)).astype(np.float32).reshape(-1))
    return Model(odds, _levels(tables, 0), *_even())


def learner(tables: list[np.ndarray]) -> Model:
    """A model that predicts each bit from the counts of all texts but that bit itself."""
    odds = []
    for table in tables:
        counts = table.reshape(-1, SYMBOLS).astype(np.float32)
        zeros, ones = counts @ CODE.under[0], counts @ CODE.under[1]
        both = np.empty((*zeros.shape, 2), dtype=np.float32)
        both[..., 0] = np.log((ones + PRIOR) / (np.maximum(zeros - 1, 0) + PRIOR))
        both[..., 1] = np.log((np.maximum(ones - 1, 0) + PRIOR) / (zeros + PRIOR))
        odds.append(both.reshape(-1))
    return Model(odds, _levels(tables, 1), *_even(), left_out=True)


@dataclass
class Tables:
    """Summed counts as they are sent to the workers, each of which makes its models once."""

    pressed: list[bytes]

    def counts(self) -> list[np.ndarray]:
        return [_unpressed(t, np.float32) for t in self.pressed]

    @cached_property
    def learner(self) -> Model:
        return learner(self.counts())

    @cached_property
    def untrained(self) -> Model:
        self.__dict__.pop("learner", None)  # one of them is held at a time
        return untrained(self.counts())


def tables_of(counts: Counts) -> Tables:
    # single precision, as only their logarithms count
    return Tables([_pressed(t.astype(np.float32)) for t in counts.tables])


def _bits(symbols: np.ndarray, slots: list[np.ndarray], model: Model) -> tuple[np.ndarray, ...]:
    """Per bit: its row among the symbols, its node, its value, the inputs, and the gate of familiarity."""
    steps = CODE.length.take(symbols)
    row = np.repeat(np.arange(len(symbols)), steps)
    place = np.arange(len(row)) + np.repeat(CODE.first.take(symbols) - (np.cumsum(steps) - steps), steps)
    node, bit = CODE.nodes.take(place), CODE.bits.take(place)
    inputs = np.empty((CONTEXTS, len(row)), dtype=np.float32)
    width, within = (2 * (SYMBOLS - 1), 2 * node + bit.astype(np.int64)) if model.left_out else (SYMBOLS - 1, node)
    for own, odds, slot in zip(inputs, model.odds, slots):
        odds.take((slot * width).take(row) + within, out=own, mode="clip")
    gate = (model.levels[0].take(slots[-2]) * LEVELS + model.levels[1].take(slots[-1])).take(row)
    return row, node, bit, inputs, gate


def _logit(weights: np.ndarray, index: np.ndarray, inputs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(index), dtype=np.float32)
    for own, x in zip(np.ascontiguousarray(weights.T, dtype=np.float32), inputs):
        total += own.take(index) * x
    return np.clip(total, -20, 20, out=total)


@dataclass
class Seen:
    """How many bits each weight was learned from, and the steps taken."""

    by_node: np.ndarray
    by_gate: np.ndarray
    steps: int = 0


def nothing_seen() -> Seen:
    return Seen(np.zeros(SYMBOLS - 1), np.zeros(LEVELS * LEVELS))


def _learn(model: Model, symbols: np.ndarray, slots: list[np.ndarray], times: np.ndarray, seen: Seen, rate: float) -> None:
    """One step: the bits of the symbols are predicted, then learned from."""
    row, node, bit, inputs, gate = _bits(symbols, slots, model)
    weight = times.take(row)
    pace = rate / (1 + seen.steps / 200)
    seen.steps += 1
    for weights, index, known in ((model.by_node, node, seen.by_node), (model.by_gate, gate, seen.by_gate)):
        p = 1 / (1 + np.exp(-_logit(weights, index, inputs)))
        many = np.bincount(index, weights=weight, minlength=len(weights))
        error = (bit - p) * weight
        change = np.stack([np.bincount(index, weights=error * x, minlength=len(weights)) for x in inputs], axis=1)
        # a step as by the root of the bits, but no longer than that of 400 bits
        weights += pace * change / np.maximum(np.sqrt(np.maximum(many, 1)), many / 20)[:, None]
        known += many


def learn_online(
    model: Model, words: np.ndarray, lengths: np.ndarray, times: np.ndarray | None = None, seen: Seen | None = None,
    rate: float = 0.02, step: int = 1000, pairs: np.ndarray | None = None,
) -> None:
    """The mixers' weights from words (each at the start of a text) or ``pairs`` of them, each ``times`` met, ``step`` at a time."""
    seen = seen or nothing_seen()
    spelled, own, before = _alone(words, lengths)
    if pairs is not None:
        own, before = _unpaired(pairs)
    times = np.ones(len(own)) if times is None else times.astype(float)
    for at in range(0, len(own), UNITS):
        symbols, sizes, slots = context_slots(spelled, own[at: at + UNITS], before[at: at + UNITS])
        weight, ends = np.repeat(times[at: at + UNITS], sizes), np.concatenate(([0], np.cumsum(sizes)))[::step]
        for part in map(slice, ends, [*ends[1:], len(symbols)]):
            if part.start < part.stop:
                _learn(model, symbols[part], [s[part] for s in slots], weight[part], seen, rate)


def learn_block(
    tables: list[np.ndarray] | Tables, words: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, pairs: np.ndarray | None = None,
) -> tuple[Model, Seen] | None:
    """Weights learned from all ``tokens`` (places among the words) or their ``pairs``, each bit without its own count.

    Equal pairs are learned from at once with their number, in the order in which they are first met.
    """
    if pairs is None:
        pairs = pairs_of(tokens, np.ones(len(tokens), dtype=np.int64))
    if not len(pairs):
        return None
    model, seen = tables.learner if isinstance(tables, Tables) else learner(tables), nothing_seen()
    model.by_node, model.by_gate = _even()
    pairs, first, times = np.unique(pairs, return_index=True, return_counts=True)
    order = np.argsort(first)
    learn_online(model, words, lengths, times[order], seen, pairs=pairs[order])
    return model, seen


def word_scores(model: Model, words: np.ndarray, lengths: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """Natural log probability of each word (at the start of a text), or pair, for each mixer: by node, by gate, both averaged."""
    spelled, owns, befores = _alone(words, lengths)
    if pairs is not None:
        owns, befores = _unpaired(pairs)
    out = np.zeros((len(owns), 3))
    for at in range(0, len(owns), UNITS):
        own = owns[at: at + UNITS]
        symbols, sizes, slots = context_slots(spelled, own, befores[at: at + UNITS])
        row, node, bit, inputs, gate = _bits(symbols, slots, model)
        one, two = _logit(model.by_node, node, inputs), _logit(model.by_gate, gate, inputs)
        sign = 1 - 2 * bit
        firsts = np.cumsum(sizes) - sizes
        first_bit = np.concatenate(([0], np.cumsum(CODE.length.take(symbols))[:-1]))[firsts]
        escapes = np.add.reduceat((symbols == ESCAPE).astype(float), firsts) * np.log(1 / 256)
        for k, logit in enumerate((one, two, (one + two) / 2)):
            cost = np.log(1 + np.exp(sign * logit))
            out[at: at + len(own), k] = escapes - np.add.reduceat(cost, first_bit, dtype=np.float64)
    return out


def blends(bits: np.ndarray, counts: np.ndarray, train_tokens: int, vocabulary: int) -> np.ndarray:
    """Natural log probability of each word for each blend of bits and whole-word counts.

    The counts give their unseen mass to no word of its own but to the bits'
    spelling, so a blend sums to at most one over all words there can be.
    """
    if not vocabulary:
        return bits
    counts, total = counts[:, None], train_tokens + 0.1 * (vocabulary + 1)
    seen = np.where(counts > 0, np.log(counts + 0.1) - np.log(total), -np.inf)
    word = np.logaddexp(seen, np.log(0.1 / total) + bits[:, 1:])
    return np.hstack([np.logaddexp(np.log(share) + word, np.log(1 - share) + bits[:, 1:]) for share in WORD_SHARES])


def mixed_score(bits: np.ndarray) -> float:
    """log10 probability of a text from its tokens' bits alone (token x mixer), each mixer equally likely."""
    totals = bits.sum(axis=0)
    return float((np.logaddexp.reduce(totals) - np.log(len(totals))) / np.log(10))


def text_score(scores: np.ndarray, used_before: np.ndarray) -> float:
    """log10 probability of a text from its tokens' scores (token x blend) and earlier uses of each token."""
    places = np.arange(len(scores))
    totals = []
    for strength in STRENGTHS:
        blend = scores if np.isinf(strength) else np.logaddexp(
            scores + np.log(strength), np.log(np.maximum(used_before, 1e-300))[:, None]) - np.log(places + strength)[:, None]
        totals.append(blend.sum(axis=0))
    totals = np.concatenate(totals)
    return float((np.logaddexp.reduce(totals) - np.log(len(totals))) / np.log(10))


_PRESS = zstandard.ZstdCompressor(level=1)


def _pressed(values: np.ndarray) -> bytes:
    return _PRESS.compress(np.ascontiguousarray(values).tobytes())


def _unpressed(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


def _row(kind: str, block: int = 0, part: int = 0, **payload) -> pa.RecordBatch:
    names = ("a", "b", "c", "d")
    return pa.RecordBatch.from_pydict({
        "kind": pa.array([kind]), "block": pa.array([block], pa.int64()), "part": pa.array([part], pa.int64()),
        **{n: pa.array([payload.get(n)], pa.binary()) for n in names}})


def _gather(parts: int):
    """Blocks of texts, their distinct words by hash range, and the context counts of the training texts."""

    def block_rows(block: int, held: list, counts: Counts) -> Iterator[pa.RecordBatch]:
        raws, hashes, starts, lengths, per_doc, trains, rows = (list(x) for x in zip(*held))
        # each text: its words, then the end as a word of no bytes
        raw = np.concatenate(raws)
        hashes, starts, lengths = map(np.concatenate, (hashes, starts, lengths))
        per_doc = np.array(per_doc)
        distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
        trained = np.repeat(np.array(trains), per_doc)
        count = np.bincount(index[trained], minlength=len(distinct))
        size = lengths[first]
        shift = np.repeat(starts[first] - (np.cumsum(size) - size), size)
        words = raw[np.arange(int(size.sum())) + shift]
        counts.add(words, size, *np.unique(pairs_of(index, per_doc)[trained], return_counts=True)[::-1])
        yield _row("texts", block, a=_pressed(np.array((rows, trains), dtype=np.int64)), b=_pressed(per_doc.astype(np.int64)),
                   c=_pressed(index.astype(np.uint32)), d=_pressed(np.concatenate((size.astype(np.uint32).view(np.uint8), words))))
        bounds = np.searchsorted(distinct, (np.arange(1, parts, dtype=object) * (1 << 64) // parts).astype(np.uint64))
        for part, (own, of) in enumerate(zip(np.split(distinct, bounds), np.split(count, bounds))):
            yield _row("words", block, part, a=_pressed(own), b=_pressed(of.astype(np.uint32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, tokens, base = Counts(), [], 0, 0
        block = first_block = TaskContext.get().partitionId() << 20
        for batch in batches:
            for text, train, key in zip(*(batch.column(c).to_pylist() for c in ("text", "train", "key"))):
                raw = lowered(text)
                hashes, starts, lengths = word_spans(raw)
                n = len(hashes) + 1
                held.append((raw, np.append(hashes, END_HASH), np.append(starts, 0) + base, np.append(lengths, 0), n, train, key))
                base += len(raw)
                tokens += n
                if tokens >= BLOCK_TOKENS or len(held) >= BLOCK_DOCS:
                    yield from block_rows(block, held, counts)
                    held, tokens, base, block = [], 0, 0, block + 1
        if held:
            yield from block_rows(block, held, counts)
        if held or block > first_block:
            yield from _count_rows(counts)

    return run


def _count_rows(counts: Counts) -> Iterator[pa.RecordBatch]:
    for context, table in enumerate(counts.tables):
        width = min(len(table), SYMBOLS << RANGE_BITS)
        for at in range(0, len(table), width):
            if table[at: at + width].any():
                yield _row("contexts", context, at // width, a=_pressed(table[at: at + width]))


def _sum_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the count ranges, one row at a time; batches are sorted by context and range."""
    held, key = None, None
    for batch in batches:
        for context, part, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "a"))):
            if (context, part) != key:
                if key is not None:
                    yield _row("contexts", *key, a=_pressed(held))
                held, key = np.zeros_like(_unpressed(raw, np.int64)), (context, part)
            held = held + _unpressed(raw, np.int64)
    if key is not None:
        yield _row("contexts", *key, a=_pressed(held))


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the words of a hash range: each block's words with their counts over all blocks."""
    for rows in groups(batches, ["part"]):
        blocks, part = rows.column("block").to_pylist(), rows.column("part")[0].as_py()
        own = [_unpressed(a, np.uint64) for a in rows.column("a").to_pylist()]
        counts = np.concatenate([_unpressed(b, np.uint32) for b in rows.column("b").to_pylist()]).astype(np.int64)
        distinct, index = np.unique(np.concatenate(own), return_inverse=True)
        total = np.bincount(index, weights=counts, minlength=len(distinct)).astype(np.int64)
        yield _row("totals", -1, part, a=_pressed(np.array([total.sum(), (total > 0).sum()])))
        for block, answer in zip(blocks, np.split(total[index], np.cumsum([len(o) for o in own])[:-1])):
            yield _row("answers", block, part, a=_pressed(answer))


_ROW = "kind string, block bigint, part bigint, a binary, b binary, c binary, d binary"


_LEARNED = pa.schema([("place", pa.int64()), ("context", pa.int64()), ("n", pa.float64()), ("total", pa.float64())])


def _learn_blocks(shared):
    """The mixers' weights of each block, learned from all its training texts, times the bits they come from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, c, d in zip(*(batch.column(x) for x in "abcd")):
                per_doc = _unpressed(b.as_py(), np.int64)
                trained = np.repeat(_unpressed(a.as_py(), np.int64)[len(per_doc):] > 0, per_doc)
                index = _unpressed(c.as_py(), np.uint32).astype(np.int64)
                packed = _unpressed(d.as_py(), np.uint8)
                many = int(index.max()) + 1  # each word of a block is used in it
                lengths = packed[: 4 * many].view(np.uint32).astype(np.int64)
                pairs = pairs_of(index, per_doc)[trained]
                found = learn_block(shared.value, packed[4 * many:], lengths, index[trained], pairs)
                if found is None:
                    continue
                weights = np.vstack((found[0].by_node, found[0].by_gate))
                n = np.repeat(np.concatenate((found[1].by_node, found[1].by_gate)), CONTEXTS)
                place, context = np.divmod(np.arange(weights.size), CONTEXTS)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (place, context, n, weights.reshape(-1) * n)], schema=_LEARNED)

    return run


def learned_weights(texts: DataFrame, shared) -> np.ndarray:
    """Node and gate weights: the blocks' own, averaged by the bits that each was learned from."""
    rows = texts.mapInArrow(_learn_blocks(shared), "place bigint, context bigint, n double, total double")
    # decimals, so that the sums do not depend on the order of rows
    rows = rows.groupBy("place", "context").agg(
        *(F.sum(F.col(c).cast("decimal(38,6)")).cast("double").alias(c) for c in ("n", "total")))
    weights = np.full((SYMBOLS - 1 + LEVELS * LEVELS, CONTEXTS), EVEN)
    for r in rows.filter("n > 0").collect():  # one row per weight
        weights[r["place"], r["context"]] = r["total"] / r["n"]
    return weights


def _score_blocks(shared, weights: np.ndarray, train_tokens: int, vocabulary: int):
    schema = pa.schema([
        ("key", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
        ("bits_score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value.untrained
        model.by_node, model.by_gate = np.split(weights, [SYMBOLS - 1])
        for rows in groups(batches, ["block"]):
            kinds = rows.column("kind").to_pylist()
            at = kinds.index("texts")
            keys, per_doc = (_unpressed(rows.column(c)[at].as_py(), np.int64) for c in "ab")
            keys = keys[: len(per_doc)]
            index = _unpressed(rows.column("c")[at].as_py(), np.uint32).astype(np.int64)
            answers = sorted(
                (p, a) for k, p, a in zip(kinds, rows.column("part").to_pylist(), rows.column("a").to_pylist()) if k == "answers")
            count = np.concatenate([_unpressed(a, np.int64) for _, a in answers])
            packed = _unpressed(rows.column("d")[at].as_py(), np.uint8)
            lengths = packed[: 4 * len(count)].view(np.uint32).astype(np.int64)
            pairs, of = np.unique(pairs_of(index, per_doc), return_inverse=True)
            bits = word_scores(model, packed[4 * len(count):], lengths, pairs)
            scores = blends(bits, count[_unpaired(pairs)[0]], train_tokens, vocabulary)
            base = np.log10((count + 0.1) / (train_tokens + 0.1 * (vocabulary + 1)))
            ends = np.cumsum(per_doc)
            out: dict[str, list] = {f.name: [] for f in schema}
            for key, end, n in zip(keys.tolist(), ends.tolist(), per_doc.tolist()):
                own, pair = index[end - n: end], of[end - n: end]
                order = np.argsort(own, kind="stable")
                new = np.concatenate(([True], own[order][1:] != own[order][:-1]))
                used = np.empty(n)
                used[order] = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
                values = (
                    key, n, int((count[own] > 0).sum()), float(base[own].sum()), text_score(scores[pair], used), mixed_score(bits[pair]))
                for name, value in zip(out, values):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def score_texts(
    docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_score`` per document.

    ``held_out`` is a condition on ``doc_id``; all other documents are learned
    from. ``base_score`` is that of smoothed word counts, ``score`` the model's
    log10 probability of the text, ``bits_score`` that of the mixed bits alone. The mixers' weights are learned block by
    block from all training texts, with tables that lack the counts of the texts
    at hand, and averaged.

    Null and empty texts are one token, the end. Repeated rows each count and
    get a row; rows with one id and different texts are scored apart. With no
    training text the counts are 0 and the base score is that of unseen
    tokens. An empty table gives no rows. Other columns are left behind.
    """
    spark = docs.sparkSession
    docs = id_and_text(docs, id_column, text_column)
    docs = docs.select("doc_id", "text", F.coalesce(~held_out, F.lit(True)).alias("train"), F.xxhash64("doc_id", "text").alias("key"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    parts = max(1, -(-int((size["bytes"] or 0) // 6) // TOKENS_A_RANGE))
    gathered = written(small_batches(docs).mapInArrow(_gather(parts), _ROW), "mixing")

    contexts = gathered.filter("kind = 'contexts'")
    # Twice, so that no range waits for the rows of all tasks.
    salted = contexts.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(16)))
    once = salted.repartition("block", "part", "salt").sortWithinPartitions("salt", "block", "part").select(
        *contexts.columns).mapInArrow(_sum_contexts, _ROW)
    summed = once.repartition("block", "part").sortWithinPartitions("block", "part").mapInArrow(_sum_contexts, _ROW)
    counts = Counts()
    for r in summed.select("block", "part", "a").collect():  # at most one row per range of a table of fixed size
        own = _unpressed(bytes(r["a"]), np.int64)
        width = min(len(counts.tables[r["block"]]), SYMBOLS << RANGE_BITS)
        counts.tables[r["block"]][r["part"] * width: (r["part"] + 1) * width] = own
    shared = spark.sparkContext.broadcast(tables_of(counts))  # a fixed number of slots
    weights = learned_weights(gathered.filter("kind = 'texts'"), shared)

    words = gathered.filter("kind = 'words'").repartitionByRange(max(1, parts), "part").sortWithinPartitions("part")
    answers = written(words.mapInArrow(_answer, _ROW), "mixing-answers")
    totals = answers.filter("kind = 'totals'").select("a").collect()  # one row per range
    total = sum((_unpressed(bytes(r["a"]), np.int64) for r in totals), np.zeros(2, dtype=np.int64))
    blocks = gathered.filter("kind = 'texts'").union(answers.filter("kind = 'answers'"))
    scored = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(
        _score_blocks(shared, weights, int(total[0]), int(total[1])),
        "key bigint, n_tokens bigint, n_known bigint, base_score double, score double, bits_score double")
    scored = scored.dropDuplicates(["key"])
    return docs.select("doc_id", "key", (~F.col("train")).alias("held_out")).join(scored, "key").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total[0])).cast("bigint").alias("train_tokens"),
        "base_score", "score", "bits_score")
