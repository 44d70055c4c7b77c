"""Improbable-feature digests: the rarest byte windows of a text in chained Bloom filters.

1. Every window of WINDOW bytes has the entropy of its bytes. Its rarity is how
   far that entropy lies from what windows of text usually have.
2. Of each WINDOW consecutive windows the rarest one (the first among equals)
   gains a point; windows with at least POPULAR points are features.
3. Features go, in order, into Bloom filters of BITS bits, FEATURES to a filter.
4. Two digests are compared filter by filter: common bits between what chance
   gives and the most that is possible, each filter of the shorter digest with
   its best partner, averaged by the features they hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.common import id_and_text, small_batches, table, written
from gapwatch.llm.shingles import mixed

WINDOW = 64
POPULAR = 16
BITS = 2048
HASHES = 5
FEATURES = 160
#: Entropies in thousandths of a bit per byte: usual value and scale of text; windows below the floor are never features.
USUAL, SCALE, FLOOR = 3700, 40, 1000

_COUNTS = np.arange(WINDOW + 1, dtype=np.float64)
#: Contribution of a byte seen c times: c log2 c, in fixed point so that sums are exact in any order.
_TERM = np.round(np.where(_COUNTS > 0, _COUNTS * np.log2(np.maximum(_COUNTS, 1)), 0) * 1000).astype(np.int64)
_GAIN = np.diff(_TERM).astype(np.int32)
_WEIGHTS = mixed(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy of each window, in thousandths of a bit per byte."""
    before = np.zeros(len(data), dtype=np.uint8)
    after = np.zeros(len(data), dtype=np.uint8)
    for lag in range(1, WINDOW):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    # A window's sum of c log c: what its bytes added when they entered, less what they took when they left.
    entered = np.cumsum(_GAIN[before], dtype=np.int64)
    left = np.cumsum(_GAIN[after], dtype=np.int64)
    total = entered[WINDOW - 1:].copy()
    total[1:] -= left[:len(total) - 1]
    return int(np.log2(WINDOW) * 1000) - total // WINDOW


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` (a power of two) values."""
    step = 1
    while step < width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values


def features(data: np.ndarray, h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the features of the bytes of one text; ``h``: the entropies of its windows."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(data) < WINDOW:
        whole = np.zeros(WINDOW, dtype=np.uint64)
        whole[:len(data)] = data.astype(np.uint64) + np.uint64(1)
        return np.zeros(1, np.int64), mixed((whole * _WEIGHTS).sum(keepdims=True))
    if h is None:
        h = entropies(data)
    rank = 255 - np.minimum(255, np.abs(h - USUAL) * 4 // SCALE)  # 0: the rarest
    rank[h < FLOOR] = 255
    order = (rank << 40) | np.arange(len(rank))
    width = min(WINDOW, 1 << (len(order).bit_length() - 1))
    winners = _least(order, width) & ((1 << 40) - 1)
    # A place wins in one run of consecutive windows, so points are run lengths.
    starts = np.flatnonzero(np.concatenate(([True], winners[1:] != winners[:-1])))
    points = np.diff(np.concatenate((starts, [len(winners)])))
    chosen = winners[starts[points >= min(POPULAR, len(winners))]]
    chosen = chosen[rank[chosen] < 255] if (rank[chosen] < 255).any() else chosen
    windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[chosen].astype(np.uint64) + np.uint64(1)
    return chosen, mixed((windows * _WEIGHTS).sum(axis=1, dtype=np.uint64))


def digest(hashes: np.ndarray) -> np.ndarray:
    """Chained Bloom filters, one row each."""
    filters = np.zeros((-(-len(hashes) // FEATURES), BITS), dtype=np.uint8)
    row = np.arange(len(hashes)) // FEATURES
    for k in range(HASHES):
        filters[row, ((hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(filters, axis=1)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """0 to 1; equal digests give 1, an empty and another one 0."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    if len(one) > len(other) or (len(one) == len(other) and one.tobytes() > other.tobytes()):
        one, other = other, one
    ones, others = (np.bitwise_count(f).sum(axis=1).astype(np.float64) for f in (one, other))
    total = weight = 0.0
    for filter_, n in zip(one, ones):
        common = np.bitwise_count(filter_ & other).sum(axis=1)
        chance = n * others / BITS
        most = np.minimum(n, others)
        score = np.where(most > chance, (common - chance) / np.maximum(most - chance, 1e-9), 0.0)
        # A small filter inside a full one shows less than two of a size.
        total += n * float(np.clip(score * most / np.maximum(n, np.minimum(others, ones.max())), 0, 1).max())
        weight += n
    return total / weight


def fingerprint(text: str) -> np.ndarray:
    return digest(features(_bytes(text))[1])


def digests(texts: list[str], at_once: int = 1 << 16) -> list[np.ndarray]:
    """The digest of each text; short ones are taken together, as windows know nothing of their surroundings."""
    out: list[np.ndarray] = []
    held: list[np.ndarray] = []

    def flush() -> None:
        data = np.concatenate(held)
        h = entropies(data) if len(data) >= WINDOW else None
        place = 0
        for part in held:
            own = h[place: place + len(part) - WINDOW + 1] if len(part) >= WINDOW else None
            out.append(digest(features(part, own)[1]))
            place += len(part)
        held.clear()

    size = 0
    for text in texts:
        held.append(_bytes(text))
        size += len(held[-1])
        if size >= at_once:
            flush()
            size = 0
    if held:
        flush()
    return out


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


def as_text(filters: np.ndarray) -> str:
    return filters.tobytes().hex()


def _filters(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint8).reshape(-1, BITS // 8)


def _digest_rows(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [d.tobytes() for d in digests(texts)]
            columns = {"doc_id": batch.column("doc_id"), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                       "digest": pa.array(found, pa.binary())}
            if keep_text:
                columns |= {"packed": pa.array([press.compress(t.encode("utf-8", "surrogatepass")) for t in texts], pa.binary()),
                            "bucket": batch.column("bucket"), "ahead": batch.column("ahead"), "tie": batch.column("tie")}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_chars, digest`` (filters of BITS / 8 bytes in a row).

    Null and empty texts have an empty digest; texts shorter than a window are
    one feature as a whole. Equal texts have equal digests. Repeated rows give
    repeated results; other columns are left behind. Nothing is shuffled.
    """
    return small_batches(id_and_text(docs, id_column, text_column)).mapInArrow(
        _digest_rows(False), "doc_id bigint, n_chars bigint, digest binary")


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("digest", pa.binary()),
        ("edited_digest", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    unpress = zstandard.ZstdDecompressor()
    before: tuple | None = None
    for batch in batches:
        rows = []
        for doc_id, n, raw, packed, bucket, ahead in zip(*(batch.column(c).to_pylist() for c in (
                "doc_id", "n_chars", "digest", "packed", "bucket", "ahead"))):
            text = unpress.decompress(packed).decode("utf-8", "surrogatepass")
            if before is not None and before[4] == bucket:
                own_id, own_n, own_text, own_raw, _ = before
                cut = own_n // 3
                rows.append((own_id, own_n, own_text[:own_n - cut] + text[:cut], own_raw, raw))
            before = None if ahead else (doc_id, n, text, raw, bucket)
        out: dict[str, list] = {f.name: [] for f in schema}
        for (own_id, own_n, edited, own_raw, next_raw), changed in zip(rows, digests([r[2] for r in rows])):
            own = _filters(own_raw)
            for name, value in zip(out, (
                    own_id, own_n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own_raw,
                    changed.tobytes(), likeness(own, changed), likeness(own, _filters(next_raw)))):
                out[name].append(value)
        yield table(out, schema)


def compare_with_edited(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows: int = 20_000) -> DataFrame:
    """Each document's digest beside those of its edited text and of the next document.

    The next document is the one with the next smaller id; after the last comes
    the first. The edited text is the text with its last third (rounded down)
    replaced by as many first characters of the next document, or all it has.

    Ids are cut into ranges of about ``rows`` documents at values found by
    approximate quantiles. A range also gets the first document of the one
    after it, so texts are shuffled once. Null ids come last, in one order with
    null texts as empty; rows that share an id follow each other in a fixed order of their texts. A single document follows itself. An empty table gives no rows.
    """
    docs = id_and_text(docs, id_column, text_column)
    known = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    ids = docs.select(known.alias("at"))
    ranges = max(1, ids.count() // rows)
    points = ids.agg(F.percentile_approx("at", [i / ranges for i in range(ranges)] or [0.0], 10_000).alias("points")).first()
    cuts = sorted(set(points["points"] or []))[1:]
    bucket = F.lit(0)
    for part in range(0, len(cuts), 64):
        bucket = bucket + F.aggregate(
            F.array(*(F.lit(c).cast("bigint") for c in cuts[part: part + 64])), F.lit(0), lambda a, c: a + (known >= c).cast("int"))
    placed = docs.withColumn("bucket", bucket)
    # The first document (in descending order) of each range, and of all.
    largest = written(placed.groupBy("bucket").agg(F.max(known).alias("at")), "largest-ids").collect()  # a row per range
    order = sorted((r["bucket"], r["at"]) for r in largest)
    if not order:
        return docs.select(
            "doc_id", F.lit(0).cast("bigint").alias("n_chars"), F.col("text").alias("edited_sha256"),
            F.lit(b"").alias("digest"), F.lit(b"").alias("edited_digest"), F.lit(0.0).alias("near_edited"),
            F.lit(0.0).alias("near_next")).limit(0)
    above = {at: order[i + 1][0] if i + 1 < len(order) else order[0][0] for i, (_, at) in enumerate(order)}
    # Of rows that share the id, the one with the least hash comes first.
    heads = placed.filter(known.isin(list(above))).groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    target = F.create_map(*(F.lit(v).cast(t) for k, b in above.items() for v, t in ((k, "bigint"), (b, "int"))))
    heads = heads.withColumn("bucket", F.element_at(target, known))
    both = placed.withColumn("ahead", F.lit(False)).unionByName(heads.withColumn("ahead", F.lit(True)))
    digested = small_batches(both.withColumn("tie", F.xxhash64("text"))).mapInArrow(
        _digest_rows(True),
        "doc_id bigint, n_chars bigint, digest binary, packed binary, bucket int, ahead boolean, tie bigint")
    sorted_ = digested.repartition("bucket").sortWithinPartitions(
        "bucket", "ahead", F.desc_nulls_last("doc_id"), "tie")
    return sorted_.mapInArrow(
        _with_next, "doc_id bigint, n_chars bigint, edited_sha256 string, digest binary, edited_digest binary, "
        "near_edited double, near_next double")
