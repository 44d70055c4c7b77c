"""Near duplicates by b-bit MinHash, with exact confirmation and whole components.

1. Each document becomes its set of word shingles, the set's key, b low bits of
   each MinHash minimum packed into a few bytes, and a hash per band of minima.
   Documents with equal sets share a key and are one node from here on.
2. Nodes that share a band bucket are candidates. Each bucket first compares
   its members with one of them (a star, so a group of n near copies gives n
   pairs). Packed signatures are compared by counting bits; pairs whose
   similarity, corrected for chance collisions of b bits, is clearly too low end here.
3. The remaining pairs are confirmed on their whole shingle sets.
4. Buckets whose members are still in different components are compared in
   full, in blocks of bounded size, each with the sets of its rows: the components
   are those of all links between members of a bucket, but no clique is ever spelled out.
5. Components by alternating star contraction, each step written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.common import groups, id_and_text, small_batches, table, written
from gapwatch.llm.shingles import mixed, shingle_set, word_hashes

SHINGLE_WORDS = 5
BANDS, ROWS = 32, 4
BITS = 2
#: Standard errors that an estimate may fall below the threshold before the pair is given up.
MARGIN = 5.5
#: Nodes, and shingles of all their sets, that a block is meant to hold; bytes of sets that a task keeps of them.
BLOCK, BLOCK_SHINGLES, HELD_BYTES = 1024, 1 << 20, 32 << 20

_SEEDS = np.random.default_rng(20240229)
_MULTIPLY = _SEEDS.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _SEEDS.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_BAND_SEEDS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The MinHash minima of a set, one per hash function."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at: at + 2048, None] * _MULTIPLY + _ADD
        least = np.minimum(least, (part >> np.uint64(32)).min(axis=0))
    return least


def packed(least: np.ndarray) -> bytes:
    """The low BITS bits of each minimum, packed."""
    bits = (least[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8)).tobytes()


def band_hashes(least: np.ndarray) -> np.ndarray:
    total = _BAND_SEEDS.copy()
    for column in least.reshape(BANDS, ROWS).T:
        total = mixed(total + column)
    return total.view(np.int64)


def estimated(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures (rows of uint8), corrected for collisions of BITS random bits."""
    differing = np.bitwise_or.reduce(
        [((one ^ other) >> np.uint8(i)) & np.uint8(0x55 if BITS == 2 else 0xFF) for i in range(BITS)])
    same = 1 - np.bitwise_count(differing).sum(axis=-1) / (BANDS * ROWS)
    chance = 2.0 ** -BITS
    return (same - chance) / (1 - chance)


def least_estimate(threshold: float) -> float:
    """The estimate that a pair at ``threshold`` falls below with negligible chance."""
    chance = 2.0 ** -BITS
    same = threshold + (1 - threshold) * chance
    return threshold - MARGIN * (same * (1 - same) / (BANDS * ROWS)) ** 0.5 / (1 - chance)


_SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("signature", pa.binary()),
    ("bands", pa.list_(pa.int64()))])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {f.name: [] for f in _SIGNED}
        for doc_id, text_hash, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash")), batch.column("text")):
            found = shingle_set(word_hashes(text.as_py()), SHINGLE_WORDS)
            out["doc_id"].append(doc_id)
            out["text_hash"].append(text_hash)
            out["n_shingles"].append(len(found))
            if not len(found):
                for name in ("key", "signature", "bands"):
                    out[name].append(None)
                continue
            least = minima(found)
            out["key"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            out["signature"].append(packed(least))
            out["bands"].append(band_hashes(least))
        yield table(out, _SIGNED)


def _pack_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("packed_text", pa.binary())])
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [press.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")]
        yield table({"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "packed_text": texts}, schema)


def _unpacked_set(packed_text: bytes) -> np.ndarray:
    text = zstandard.ZstdDecompressor().decompress(packed_text).decode("utf-8", "surrogatepass")
    return shingle_set(word_hashes(text), SHINGLE_WORDS)


def _confirm(percent: int):
    """Keeps the pairs whose whole sets are similar enough."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_node = None, None
        for batch in batches:
            us, vs = batch.column("u").to_pylist(), batch.column("v").to_pylist()
            kept: dict[str, list] = {"u": [], "v": []}
            for i, (u, v) in enumerate(zip(us, vs)):
                if u != held_node:
                    held, held_node = _unpacked_set(batch.column("u_text")[i].as_py()), u
                other = _unpacked_set(batch.column("v_text")[i].as_py())
                common = _in_common(held, other)
                if 100 * common >= percent * (len(held) + len(other) - common):
                    kept["u"].append(u)
                    kept["v"].append(v)
            yield table(kept, schema)

    return confirm


class _HeldSets:
    """The sets of a block's rows, made when asked for; the oldest are dropped beyond a number of bytes."""

    def __init__(self, texts: pa.ChunkedArray):
        self._texts, self._held, self._size = texts, {}, 0

    def __getitem__(self, i: int) -> np.ndarray:
        found = self._held.get(i)
        if found is None:
            found = self._held[i] = _unpacked_set(self._texts[i].as_py())
            self._size += found.nbytes
            while self._size > HELD_BYTES and len(self._held) > 2:
                self._size -= self._held.pop(next(iter(self._held))).nbytes
        return found


def _in_common(one: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sets as sorted arrays."""
    return int((one[np.minimum(np.searchsorted(one, other), len(one) - 1)] == other).sum())


def _link_blocks(percent: int):
    """Links that join components among the rows of a block pair, confirmed on whole sets.

    Pairs of one component, as far as it is known here, need no check, so a group
    of copies costs a link per copy.
    """
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    floor = least_estimate(percent / 100)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, ["band", "first_block", "second_block"]):
            nodes, parts, sizes, block = (
                rows.column(c).to_numpy() for c in ("node", "component", "n_shingles", "block"))
            first, second = rows.column("first_block")[0].as_py(), rows.column("second_block")[0].as_py()
            signatures = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(len(nodes), -1)
            sets = _HeldSets(rows.column("packed_text"))
            parts = parts.copy()
            right = np.flatnonzero(block == second)
            kept: dict[str, list] = {"u": [], "v": []}
            for i in np.flatnonzero(block == first):
                against = right[right > i] if first == second else right
                against = against[
                    (parts[against] != parts[i])
                    & (100 * np.minimum(sizes[against], sizes[i]) >= percent * np.maximum(sizes[against], sizes[i]))]
                if not len(against):
                    continue
                for j in against[estimated(signatures[i], signatures[against]) >= floor].tolist():
                    if parts[j] == parts[i]:
                        continue
                    one, other = sets[int(i)], sets[j]
                    common = _in_common(one, other)
                    if 100 * common >= percent * (len(one) + len(other) - common):
                        parts[parts == parts[j]] = parts[i]
                        kept["u"].append(int(min(nodes[i], nodes[j])))
                        kept["v"].append(int(max(nodes[i], nodes[j])))
            if kept["u"]:
                yield table(kept, schema)

    return link


def _likely(percent: int):
    """Keeps pairs whose sizes and packed signatures allow the wanted similarity."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    floor = least_estimate(percent / 100)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, other = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for c in ("u_signature", "v_signature"))
            keep = pa.array(estimated(one, other) >= floor)
            yield pa.RecordBatch.from_arrays(
                [batch.column("u").filter(keep), batch.column("v").filter(keep)], schema=schema)

    return likely


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(u, v)``; the component is its smallest node.

    Large-star and small-star steps in turn until nothing changes. A star's
    centre with any number of links is a minimum and a join, never a group in one task.
    """
    def undirected(edges):
        return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def signature(edges):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    # Kept as (u, v) with v < u.
    edges = written(links.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    known = signature(edges)
    while known[0]:
        both = undirected(edges)
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u != v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(
            F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = signature(edges)
        if now == known:
            break
        known = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_duplicates(
    docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if 100 * intersection >= percent * union of their
    sets of five-word shingles (A-Z lower-cased; a shorter text is one shingle).
    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the document's own.

    A pair at the threshold shares no bucket with a chance of 5e-6. Null, empty
    and blank texts have an empty set and are linked with nothing. Repeated
    rows each give a row; rows with one id and different texts stay apart
    unless linked. A null id is kept only if its group has no other id.
    """
    return grouped(docs, percent, id_column, text_column).select("doc_id", "n_shingles", "component_id", "kept")


def one_per_group(docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of one row per group of near duplicates, one with the smallest id, and of one per (id, text) in no group.

    Ids may be null or shared by different texts: only rows that are linked, or
    repeat both id and text, stand for each other.
    """
    rows = docs.withColumns({"_id": F.col(id_column).cast("bigint"), "_hash": _text_hash(F.coalesce(F.col(text_column), F.lit("")))})
    kept = grouped(docs, percent, id_column, text_column).filter("kept").groupBy(
        "component", "doc_id", F.when(F.col("component").isNull(), F.col("text_hash")).alias("alone")).agg(
        F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash").distinct()
    found = rows.join(kept, rows["_id"].eqNullSafe(kept["doc_id"]) & (rows["_hash"] == kept["text_hash"]), "left_semi")
    return found.dropDuplicates(["_id", "_hash"]).drop("_id", "_hash")


def _text_hash(text):
    return F.xxhash64(text)


def grouped(docs: DataFrame, percent: int, id_column: str, text_column: str) -> DataFrame:
    """``near_duplicates`` with ``text_hash``, and ``component``, a number per group that is null for an empty set."""
    docs = small_batches(id_and_text(docs, id_column, text_column).withColumn("text_hash", _text_hash(F.col("text"))))
    signed = written(docs.mapInArrow(
        _sign, "doc_id bigint, text_hash bigint, n_shingles bigint, key binary, signature binary, bands array<bigint>"), "signed")
    nodes = written(
        signed.filter("key IS NOT NULL").groupBy("key").agg(
            # a row with the smallest id that is not null, if there is one, and its text
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("rep"), F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"), F.first("bands").alias("bands"))
        .withColumns({"rep_id": F.col("rep.doc_id"), "rep_hash": F.col("rep.text_hash")}).drop("rep")
        .withColumn("node", F.monotonically_increasing_id()), "nodes")

    # Buckets of two nodes or more, and their smallest node.
    members = nodes.select("node", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("members")).filter("members > 1")
    members = written(members.join(shared, "band"), "members")
    stars = members.filter("node != pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()

    # Texts of all nodes that share a bucket, once.
    wanted = members.select("node").distinct().join(nodes.select("node", "rep_id", "rep_hash", "n_shingles", "signature"), "node")
    texts = docs.mapInArrow(_pack_text, "doc_id bigint, text_hash bigint, packed_text binary")
    candidates = written(
        texts.join(wanted, texts.doc_id.eqNullSafe(wanted.rep_id) & (texts.text_hash == wanted.rep_hash)).groupBy("node").agg(
            F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
            F.first("packed_text").alias("packed_text")), "candidates")

    def confirmed(pairs: DataFrame) -> DataFrame:
        one = candidates.select(*(F.col(c).alias(f"u_{c}") for c in candidates.columns))
        other = candidates.select(*(F.col(c).alias(f"v_{c}") for c in candidates.columns))
        pairs = pairs.join(one.drop("u_packed_text"), F.col("u") == F.col("u_node")).join(
            other.drop("v_packed_text"), F.col("v") == F.col("v_node")).filter(
            100 * F.least("u_n_shingles", "v_n_shingles") >= percent * F.greatest("u_n_shingles", "v_n_shingles")
        ).select("u", "v", "u_signature", "v_signature").mapInArrow(_likely(percent), "u bigint, v bigint")
        with_texts = pairs.join(one, F.col("u") == F.col("u_node")).join(other, F.col("v") == F.col("v_node")).select(
            "u", "v", F.col("u_packed_text").alias("u_text"), F.col("v_packed_text").alias("v_text"))
        return written(with_texts.mapInArrow(_confirm(percent), "u bigint, v bigint"), "confirmed")

    links = confirmed(stars)
    labels = written(components(links), "components")

    # Buckets that still hold several components, compared in blocks.
    placed = members.join(labels, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component"))
    # Of buckets with the same members (near copies share many bands) one is compared.
    open_buckets = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("bag"), F.sum(F.shiftright(F.xxhash64("node", F.lit(1)), 24)).alias("sum"),
    ).filter("low != high").groupBy("n", "bag", "sum").agg(F.min("band").alias("band")).select("band")
    rows = placed.join(open_buckets, "band").join(nodes.select("node", "n_shingles"), "node")
    blocks = rows.groupBy("band").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    rows = rows.drop("n_shingles").join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(candidates, "node").select(
        "band", "node", "component", "n_shingles", "signature", "packed_text", "block",
        F.least("block", "other").alias("first_block"), F.greatest("block", "other").alias("second_block"))
    more = written(rows.repartition("band", "first_block", "second_block").sortWithinPartitions(
        "band", "first_block", "second_block").mapInArrow(_link_blocks(percent), "u bigint, v bigint").distinct(), "confirmed")
    # The second contraction works on components, not on nodes.
    label_of = lambda n: labels.select(F.col("node").alias(n), F.col("component").alias(f"{n}_component"))
    joined = more.join(label_of("u"), "u", "left").join(label_of("v"), "v", "left").select(
        F.coalesce("u_component", "u").alias("u"), F.coalesce("v_component", "v").alias("v"))
    merged = components(joined).select(F.col("node").alias("component"), F.col("component").alias("merged"))
    of_node = nodes.select("node", "key", "rep_id").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")).join(merged, "component", "left").select(
        "key", "rep_id", F.coalesce("merged", "component").alias("component"))
    smallest = of_node.groupBy("component").agg(F.min("rep_id").alias("component_id"))
    of_key = of_node.join(smallest, "component").select("key", "component", "component_id")
    return signed.select("doc_id", "text_hash", "n_shingles", "key").join(of_key, "key", "left").select(
        "doc_id", "text_hash", "n_shingles", "component", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
