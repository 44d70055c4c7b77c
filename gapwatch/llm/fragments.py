"""Exact similarity join of documents on word n-grams by vertical partitioning.

1. A table of bounded size counts all n-grams by hash bucket. It fixes one global
   order of n-grams, rare buckets first, and cuts it into fragments of about equal mass.
2. Documents with equal sets are one node. Two nodes as similar as wanted share an
   n-gram among the first of each in the global order (its prefix): nodes that
   share one are candidates. Of each such group the smallest node meets all others,
   so a group of n near copies gives about n pairs.
3. A pair's overlap is counted in each fragment on its own, where the fragment's
   segments of the two sets meet, and summed per pair. That is exact.
4. Groups whose other members still lie in different components are compared in blocks: by
   bounds first, then, for rows that may still be linked, with each fragment's overlap added
   until it decides the pair. No pairs but links leave a block.
5. Before a pair is counted, its sizes and the parity of its n-grams by bucket
   bound its overlap from above; the bound loses no link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.common import groups, id_and_text, small_batches, table, written
from gapwatch.llm.neardup import components
from gapwatch.llm.shingles import shingle_set, word_hashes

SHINGLE_WORDS = 5
#: Buckets of the global order, and the slices in which their counts travel.
BUCKET_BITS, SLICES = 20, 64
#: Ranges of the global order in which overlaps are counted apart.
FRAGMENTS = 8
#: Pairs of one node that a task counts together.
STAR = 256
#: Nodes, and n-grams of all their sets, that a block is meant to hold; bytes of sets that a task keeps of them.
BLOCK, BLOCK_GRAMS, HELD_BYTES = 1024, 1 << 20, 32 << 20
#: Parity bits of a set: a power of two within these, of at least 2 per n-gram, or so many in the blocks.
LEAST_BITS, MOST_BITS, WIDE = 64, 1 << 16, 16


def shingles_of(text: str) -> np.ndarray:
    return shingle_set(word_hashes(text), SHINGLE_WORDS)


def buckets_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Order:
    """The global order: n-grams go by the rank of their bucket, then by their hash."""

    rank: np.ndarray
    cuts: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray, fragments: int) -> Order:
        """Rare buckets first; the cuts give every fragment about the same mass."""
        by_count = np.argsort(counts, kind="stable")
        rank = np.empty(len(counts), dtype=np.int32)
        rank[by_count] = np.arange(len(counts), dtype=np.int32)
        mass = np.cumsum(counts[by_count])
        return cls(rank, np.searchsorted(mass, mass[-1] * np.arange(1, fragments) / fragments))

    def prefix(self, grams: np.ndarray, percent: int) -> np.ndarray:
        """The first n-grams of a set, of which a set as similar as ``percent`` has one among its own first ones."""
        wanted = len(grams) - -(-percent * len(grams) // 100) + 1
        return grams[np.argsort(self.rank[buckets_of(grams)], kind="stable")[:wanted]]

    def segments(self, grams: np.ndarray) -> list[np.ndarray]:
        """The part of a sorted set in each fragment, still sorted."""
        fragment = np.searchsorted(self.cuts, self.rank[buckets_of(grams)], side="left")
        return [grams[fragment == i] for i in range(len(self.cuts) + 1)]


def common_grams(one: np.ndarray, other: np.ndarray) -> int:
    """How many n-grams two sorted segments share."""
    if not len(one) or not len(other):
        return 0
    return int((one[np.minimum(np.searchsorted(one, other), len(one) - 1)] == other).sum())


def overlap_reaches(one: list[np.ndarray], other: list[np.ndarray], percent: int) -> bool:
    """Whether the overlaps of the segments add up to a link; ends with the fragment that decides it."""
    left, right = sum(map(len, one)), sum(map(len, other))
    wanted = -(-percent * (left + right) // (100 + percent))
    common = 0
    for a, b in zip(one, other):
        if common + min(left, right) < wanted:
            return False
        common += common_grams(a, b)
        left, right = left - len(a), right - len(b)
    return common >= wanted


def parity(grams: np.ndarray, per_gram: int = 2) -> np.ndarray:
    """For each bucket of low bits, whether an odd number of n-grams lies in it; packed."""
    bits = LEAST_BITS
    while bits < min(per_gram * len(grams), MOST_BITS):
        bits *= 2
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of parities as they are for fewer buckets."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def may_link(one: np.ndarray, n_one: int, others: np.ndarray, n_others: np.ndarray, percent: int) -> np.ndarray:
    """Which sets can be as similar to ``one``: sets differ in at least as many n-grams as their parities do."""
    width = min(one.shape[-1], others.shape[-1])
    apart = np.bitwise_count(_folded(one, width) ^ _folded(others, width)).sum(axis=-1, dtype=np.int64)
    both = n_one + n_others
    return (100 + percent) * (both - apart) >= 2 * percent * both


# Each task's counts, and their sum.

_COUNTS = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])


def _rows_of_counts(counts: np.ndarray) -> pa.RecordBatch:
    press = zstandard.ZstdCompressor(level=1)
    parts = counts.reshape(SLICES, -1)
    return table({"slice": range(SLICES), "counts": [press.compress(part.tobytes()) for part in parts]}, _COUNTS)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for batch in batches:
        for text in batch.column("text"):
            grams = buckets_of(shingles_of(text.as_py()))
            if len(grams) < len(counts) // 64:
                np.add.at(counts, grams, 1)
            else:
                counts += np.bincount(grams, minlength=len(counts))
    if counts.any():
        yield _rows_of_counts(counts)


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press, open_ = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    held, total = None, None
    for batch in batches:
        for number, packed in zip(*(batch.column(c).to_pylist() for c in _COUNTS.names)):
            counts = np.frombuffer(open_.decompress(packed), np.int64)
            if number == held:
                total = total + counts
                continue
            if held is not None:
                yield table({"slice": [held], "counts": [press.compress(total.tobytes())]}, _COUNTS)
            held, total = number, counts
    if held is not None:
        yield table({"slice": [held], "counts": [press.compress(total.tobytes())]}, _COUNTS)


def global_order(docs: DataFrame, fragments: int = FRAGMENTS) -> Order:
    """The order from the n-grams of all documents; 2^BUCKET_BITS counts reach the driver, however many documents there are."""
    counted = docs.mapInArrow(_tally, "slice int, counts binary").repartition(SLICES, "slice").sortWithinPartitions("slice").mapInArrow(
        _sum_slices, "slice int, counts binary").collect()
    counts = np.zeros((SLICES, (1 << BUCKET_BITS) // SLICES), dtype=np.int64)
    for number, packed in counted:
        counts[number] = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int64)
    return Order.from_counts(counts.ravel(), fragments)


_DESCRIBED = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("bits", pa.binary()),
    ("prefix", pa.list_(pa.int64()))])


def _describe(order: Order, percent: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text_hash, text in zip(*(batch.column(c) for c in ("doc_id", "text_hash", "text"))):
                grams = shingles_of(text.as_py())
                about = (hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), parity(grams).tobytes(),
                         order.prefix(grams, percent).view(np.int64)) if len(grams) else (None, None, None)
                rows.append((doc_id.as_py(), text_hash.as_py(), len(grams), *about))
            if rows:
                yield table(dict(zip(_DESCRIBED.names, zip(*rows))), _DESCRIBED)

    return describe


def _pack_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("packed_text", pa.binary())])
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [press.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")]
        yield table({"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "packed_text": texts}, schema)


_SEGMENTS = pa.schema([("node", pa.int64()), ("fragment", pa.int32()), ("n", pa.int64()), ("grams", pa.binary())])


def _cut(order: Order):
    """The segments of each node's set."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for node, packed in zip(batch.column("node").to_pylist(), batch.column("packed_text")):
                grams = shingles_of(open_.decompress(packed.as_py()).decode("utf-8", "surrogatepass"))
                rows.extend((node, i, len(grams), part.tobytes()) for i, part in enumerate(order.segments(grams)) if len(part))
            if rows:
                yield table(dict(zip(_SEGMENTS.names, zip(*rows))), _SEGMENTS)

    return cut


def _count_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial overlaps of pairs; in each fragment the first row of a star is the segment of its centre."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("common", pa.int64()), ("both", pa.int64())])
    held, centre, n_centre = None, np.empty(0, np.uint64), 0
    for batch in batches:
        out = []
        places = zip(*(batch.column(c).to_pylist() for c in ("u", "part", "fragment", "v", "n")))
        for (u, part, fragment, v, n), grams in zip(places, batch.column("grams")):
            segment = np.frombuffer(grams.as_buffer(), np.uint64)
            if v is None:
                held, centre, n_centre = (u, part, fragment), segment.copy(), n
                continue
            if held != (u, part, fragment):
                continue  # the centre has nothing in this fragment
            common = common_grams(centre, segment)
            if common:
                out.append((u, v, common, n_centre + n))
        if out:
            yield table(dict(zip(schema.names, zip(*out))), schema)


_PAIR = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _likely(percent: int):
    """Keeps pairs that sizes and parities allow."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs, u_n, v_n = (batch.column(c).to_numpy() for c in ("u", "v", "u_n", "v_n"))
            sides = zip(*(batch.column(c) for c in ("u_bits", "v_bits")))
            keep = [bool(may_link(*(np.frombuffer(x.as_buffer(), np.uint8) if i % 2 == 0 else x for i, x in enumerate((a, n, b, m))), percent))
                    for (a, b), n, m in zip(sides, u_n.tolist(), v_n.tolist())]
            yield table({"u": us[keep], "v": vs[keep]}, _PAIR)

    return likely


class _Held:
    """Segments of the sets of a block's rows, made when asked for, the oldest dropped beyond a number of bytes."""

    def __init__(self, texts: pa.ChunkedArray, order: Order):
        self._texts, self._order, self._held, self._size = texts, order, {}, 0
        self._open = zstandard.ZstdDecompressor()

    def grams(self, i: int) -> np.ndarray:
        return shingles_of(self._open.decompress(self._texts[i].as_py()).decode("utf-8", "surrogatepass"))

    def segments(self, i: int) -> list[np.ndarray]:
        if i not in self._held:
            self._held[i] = self._order.segments(self.grams(i))
            self._size += sum(part.nbytes for part in self._held[i])
            while self._size > HELD_BYTES and len(self._held) > 2:
                self._size -= sum(part.nbytes for part in self._held.pop(next(iter(self._held))))
        return self._held[i]


def _stacked(bits: list[np.ndarray], rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and their parities, by the parities' width."""
    widths = np.array([len(bits[i]) for i in rows])
    return [(same, np.stack([bits[i] for i in same])) for w in np.unique(widths) for same in [rows[widths == w]]]


def _likely_rows(i: int, bits: list[np.ndarray], stacks: list, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Rows of the stacks that sizes and parities allow to be linked to row ``i``."""
    found = [at[may_link(bits[i], int(sizes[i]), stack, sizes[at], percent)] for at, stack in stacks]
    return np.concatenate(found) if found else np.empty(0, np.int64)


_BLOCK_KEYS = ("gram", "first_block", "second_block")
_BLOCK_ROWS = "gram bigint, first_block int, second_block int, node bigint, component bigint, n bigint, bits binary, block int"


def _still_open(percent: int):
    """The rows of two blocks that sizes and parities allow a partner in another component; needs no texts."""

    def still_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for rows in groups(batches, list(_BLOCK_KEYS)):
            parts, sizes, block = (rows.column(c).to_numpy() for c in ("component", "n", "block"))
            first, second = rows.column("first_block")[0].as_py(), rows.column("second_block")[0].as_py()
            bits = [np.frombuffer(b.as_buffer(), np.uint8) for b in rows.column("bits")]
            near = _stacked(bits, np.flatnonzero(block == second))
            keep = np.zeros(len(parts), dtype=bool)
            for i in np.flatnonzero(block == first).tolist():
                found = _likely_rows(i, bits, near, sizes, percent)
                found = found[parts[found] != parts[i]]
                keep[found] = True
                keep[i] |= len(found) > 0
            if keep.any():
                held.append(rows.filter(pa.array(keep)))
            if sum(t.num_rows for t in held) >= BLOCK:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return still_open


def _link_blocks(order: Order, percent: int):
    """Links that join components between two blocks of a group.

    Pairs of one component, as far as it is known here, need no look. Rows that
    can be linked to many go first, so the centre of a group of copies joins it
    and no other pair of the group is compared.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, list(_BLOCK_KEYS)):
            nodes, parts, sizes, block = (rows.column(c).to_numpy() for c in ("node", "component", "n", "block"))
            parts = parts.copy()
            first, second = rows.column("first_block")[0].as_py(), rows.column("second_block")[0].as_py()
            held = _Held(rows.column("packed_text"), order)
            left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
            bits = [np.frombuffer(b.as_buffer(), np.uint8) for b in rows.column("bits")]
            near, some = _stacked(bits, right), _stacked(bits, right[::max(1, len(right) // 64)])
            wide = wide_stacks = None
            kept: list[tuple[int, int]] = []
            for i in sorted(left.tolist(), key=lambda i: -len(_likely_rows(i, bits, some, sizes, percent))):
                found = _likely_rows(i, bits, near, sizes, percent)
                if (parts[found] == parts[i]).all():
                    continue
                if wide is None:
                    # What ends above needs no texts.
                    wide = [parity(held.grams(k), WIDE) for k in range(len(nodes))]
                    wide_stacks = _stacked(wide, right)
                for j in _likely_rows(i, wide, wide_stacks, sizes, percent).tolist():
                    if parts[j] != parts[i] and overlap_reaches(held.segments(i), held.segments(j), percent):
                        parts[parts == parts[j]] = parts[i]
                        kept.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
            if kept:
                yield table(dict(zip(_PAIR.names, zip(*kept))), _PAIR)

    return link


def similar_groups(
    docs: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text", fragments: int = FRAGMENTS,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Documents are linked if 100 * intersection >= percent * union of their sets
    of five-word shingles (A-Z lower-cased; a shorter text is one shingle);
    ``component_id`` is the smallest id reachable over links. No link between
    different sets is lost, at any size of a group.

    Null, empty and blank texts have an empty set, are linked with nothing and
    keep their own id. Repeated rows each give a row. A null id, where others are
    in the group, is not the smallest. Very long texts are compared whole. Other
    columns are left behind; an empty table gives no rows.
    """
    docs = small_batches(id_and_text(docs, id_column, text_column).withColumn("text_hash", F.xxhash64("text")))
    order = global_order(docs, fragments)
    described = written(docs.mapInArrow(
        _describe(order, percent),
        "doc_id bigint, text_hash bigint, n_shingles bigint, key binary, bits binary, prefix array<bigint>"), "described")
    nodes = written(
        described.filter("key IS NOT NULL").groupBy("key").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("rep"), F.first("n_shingles").alias("n"),
            F.first("bits").alias("bits"), F.first("prefix").alias("prefix"))
        .select("key", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"), "n", "bits", "prefix",
                F.monotonically_increasing_id().alias("node")), "nodes")

    # Nodes that share an n-gram of their prefixes, and the smallest of each group.
    postings = nodes.select("node", F.explode("prefix").alias("gram"))
    shared = postings.groupBy("gram").agg(F.min("node").alias("pivot"), F.count("*").alias("members")).filter("members > 1")
    members = written(postings.join(shared, "gram"), "members")
    # Plain keys for a null id, so that dropping repeated rows needs no shuffle of its own.
    place = lambda id_, text_hash: (F.coalesce(id_, F.lit(0)).alias("id"), F.col(id_).isNull().alias("no_id"), F.col(text_hash).alias("text_hash"))
    wanted = members.select("node").distinct().join(nodes.select("node", "rep_id", "rep_hash"), "node").select(
        "node", *place("rep_id", "rep_hash"))
    texts = docs.mapInArrow(_pack_text, "doc_id bigint, text_hash bigint, packed_text binary").select(
        *place("doc_id", "text_hash"), "packed_text")
    candidates = written(texts.join(wanted, ["id", "no_id", "text_hash"]).dropDuplicates(
        ["id", "no_id", "text_hash", "node"]).select("node", "packed_text"), "candidates")

    about = nodes.select("node", "n", "bits")
    side = lambda name: about.select(*(F.col(c).alias(name if c == "node" else f"{name}_{c}") for c in about.columns))
    small, large = F.least("u_n", "v_n"), F.greatest("u_n", "v_n")
    stars = members.filter("node != pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    stars = written(stars.join(side("u"), "u").join(side("v"), "v").filter(100 * small >= percent * large).mapInArrow(
        _likely(percent), "u bigint, v bigint"), "stars")

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs whose overlap, summed over the fragments, is large enough."""
        pairs = written(pairs, "pairs")
        needed = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        segments = written(candidates.join(needed, "node").mapInArrow(
            _cut(order), "node bigint, fragment int, n bigint, grams binary"), "segments")
        # A node with many pairs is the centre of several stars.
        centres = pairs.groupBy("u").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
        ends = pairs.join(centres, "u").select("u", F.pmod(F.xxhash64("v"), "parts").cast("int").alias("part"), "v").join(
            segments.withColumnRenamed("node", "v"), "v")
        own = centres.select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(
            segments.withColumnRenamed("node", "u"), "u").withColumn("v", F.lit(None).cast("bigint"))
        columns = ("u", "part", "fragment", "v", "n", "grams")
        met = own.select(*columns).unionByName(ends.select(*columns)).repartition("u", "part", "fragment").sortWithinPartitions(
            "u", "part", "fragment", F.asc_nulls_first("v"))
        overlaps = met.mapInArrow(_count_overlaps, "u bigint, v bigint, common bigint, both bigint").groupBy("u", "v").agg(
            F.sum("common").alias("common"), F.first("both").alias("both"))
        return written(overlaps.filter(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("u", "v"), "links")

    def labelled(links: DataFrame) -> DataFrame:
        return written(components(links), "components")

    def crossing(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs whose ends are in different components so far."""
        of = lambda name: labels.select(F.col("node").alias(name), F.col("component").alias(f"{name}_component"))
        return pairs.join(of("u"), "u", "left").join(of("v"), "v", "left").filter(
            F.coalesce("u_component", "u") != F.coalesce("v_component", "v")).select("u", "v")

    # One pair per node first: it settles most groups.
    first = stars.groupBy("v").agg(F.min("u").alias("u")).select("u", "v")
    links = linked(first)
    rest = crossing(stars.join(first, ["u", "v"], "left_anti"), labelled(links))
    links = links.unionByName(linked(rest))
    labels = labelled(links)

    # Groups whose other members still lie apart; of those with the same members one is enough.
    placed = members.filter("node != pivot").join(labels, "node", "left").select(
        "gram", "node", F.coalesce("component", "node").alias("component"))
    open_groups = placed.groupBy("gram").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("count"),
        F.bit_xor(F.xxhash64("node")).alias("bag"), F.sum(F.shiftright(F.xxhash64("node", F.lit(1)), 24)).alias("sum"),
    ).filter("low != high").groupBy("count", "bag", "sum").agg(F.min("gram").alias("gram")).select("gram")
    rows = placed.join(open_groups, "gram").join(about, "node")
    blocks = rows.groupBy("gram").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK, F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    rows = rows.join(blocks, "gram").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "gram", F.least("block", "other").alias("first_block"), F.greatest("block", "other").alias("second_block"),
        "node", "component", "n", "bits", "block")
    # Only rows that may still be linked meet with their texts; of blocks with the same such rows one is enough.
    by_block = lambda frame: frame.repartition(*_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS)
    rows = written(by_block(rows).mapInArrow(_still_open(percent), _BLOCK_ROWS), "open")
    sided = ("node", F.col("block") == F.col("first_block"), F.col("block") == F.col("second_block"))
    once = rows.groupBy(*_BLOCK_KEYS).agg(
        F.count("*").alias("count"), F.bit_xor(F.xxhash64(*sided)).alias("bag"),
        F.sum(F.shiftright(F.xxhash64(*sided, F.lit(1)), 24)).alias("sum"),
    ).groupBy("count", "bag", "sum").agg(F.min(F.struct(*_BLOCK_KEYS)).alias("at")).select("at.*")
    rows = rows.join(once, list(_BLOCK_KEYS))
    # Written, so that Spark knows their size before it chooses how to fetch the texts.
    needed = written(rows.select("node").distinct(), "needed")
    texts = candidates.join(needed, "node")
    more = written(by_block(rows.join(texts, "node")).mapInArrow(
        _link_blocks(order, percent), "u bigint, v bigint").distinct(), "links")
    labels = labelled(links.unionByName(more))

    of_node = nodes.select("node", "key", "rep_id").join(labels, "node", "left").select(
        "key", "rep_id", F.coalesce("component", "node").alias("component"))
    smallest = of_node.groupBy("component").agg(F.min("rep_id").alias("component_id"))
    of_key = of_node.join(smallest, "component").select("key", "component_id")
    return described.select("doc_id", "n_shingles", "key").join(of_key, "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
