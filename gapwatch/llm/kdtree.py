"""K-d tree partitioning into shards of near equal bytes.

The tree is built from histograms: a split needs the weighted median of one
coordinate within a node, found digit by digit (radix bins summed by Spark,
a bounded number of bins to the driver). Rows are never sorted or collected
for it. Equal coordinates, such as those of a source with a third of all
rows, are cut apart by a tie-break that follows the document, so a hot value
can't make a shard too large.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwatch.llm.common import written

COORDINATE_BITS = 30
TIE_BITS = 30
DIGIT_BITS = 12


@dataclass
class _Node:
    """A node that is to become the shards ``first`` to ``first + count - 1``."""

    first: int
    count: int


def _scaled(value: Column, low: float | None, high: float | None) -> Column:
    """``value`` as a whole number of COORDINATE_BITS bits; null takes the lowest place."""
    if low is None or high is None or low == high:
        return F.lit(0).cast("bigint")
    share = (value - low) / (high - low)
    return F.coalesce(F.floor(share * ((1 << COORDINATE_BITS) - 1)).cast("bigint"), F.lit(0).cast("bigint"))


def _by_node(node: Column, values: dict[int, int], other: int) -> Column:
    """The value of the row's node, from a constant array."""
    last = max(values, default=0)
    return F.coalesce(
        F.get(F.array(*(F.lit(values.get(k, other)).cast("bigint") for k in range(last + 1))), node),
        F.lit(other).cast("bigint"))


def _split_points(
    rows: DataFrame, node: Column, wanted: dict[int, float], tolerance: float
) -> dict[int, int]:
    """For each node the value of ``_at`` below which the wanted weight lies.

    ``rows`` has ``_at`` (the coordinate with its tie-break) and ``_weight``.
    Each pass sums one digit of DIGIT_BITS bits for all nodes at once; it ends
    when the bin that holds the cut is one row or weighs less than ``tolerance`` of the wanted weight.
    """
    bits = COORDINATE_BITS + TIE_BITS
    prefix = {k: 0 for k in wanted}
    before = {k: 0.0 for k in wanted}
    open_nodes = set(wanted)
    while bits > 0 and open_nodes:
        shift = max(0, bits - DIGIT_BITS)
        searched = _by_node(node, {k: prefix[k] for k in open_nodes}, -1)
        sums: dict[int, list[tuple[int, int, float]]] = {k: [] for k in open_nodes}
        for r in (
            rows.filter(F.shiftright("_at", bits) == searched)
            .groupBy(node.alias("node"), F.shiftright("_at", shift).alias("bin"))
            .agg(F.sum("_weight").alias("weight"), F.count("*").alias("rows")).collect()  # at most nodes x 4096 bins
        ):
            sums[r["node"]].append((r["bin"], r["rows"], float(r["weight"])))
        for k in list(open_nodes):
            total, last = before[k], None
            for at, count, weight in sorted(sums[k]):
                last = (at, weight, count)
                if total + weight >= wanted[k]:
                    break
                total += weight
            if last is None:
                open_nodes.discard(k)
                prefix[k] <<= bits
                continue
            prefix[k], before[k] = last[0], total
            if last[1] <= tolerance * wanted[k] or last[2] == 1 or shift == 0:
                # the cut goes to whichever end of the bin is nearer
                nearer = (wanted[k] - total) * 2 > last[1]
                prefix[k] = (last[0] + int(nearer)) << shift
                open_nodes.discard(k)
        bits = shift
    return prefix


def kd_shards(
    docs: DataFrame,
    shards: int = 24,
    id_column: str = "doc_id",
    text_column: str = "text",
    dimensions: dict[str, Column] | None = None,
    tolerance: float = 0.0005,
    rows_per_piece: int = 200_000,
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the UTF-8 bytes of the text plus 8, ``text_crc32`` its CRC-32.
    ``dimensions`` names the metadata (numeric columns of ``docs``) that may be
    split; by default the id, the logarithm of the size and the source's hash
    where there is such a column. A node splits along the dimension with the
    largest extent relative to the whole table. Shards differ in bytes by
    little more than the tolerance and one document.

    Null texts count as empty, null ids and dimensions take the lowest place.
    Repeated rows each get a slot of their own. An empty table gives an empty
    result. Other columns of ``docs`` are left behind.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    size = (F.octet_length(text) + 8).cast("bigint")
    if dimensions is None:
        dimensions = {"id": F.col(id_column).cast("double"), "bytes": F.log2(size.cast("double"))}
        if "source" in docs.columns:
            dimensions["source"] = F.xxhash64("source").cast("double")
    names = [f"_d{i}" for i in range(len(dimensions))]
    meta = written(
        docs.select(
            F.col(id_column).cast("bigint").alias("doc_id"), size.alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            *(column.cast("double").alias(name) for name, column in zip(names, dimensions.values())),
            # Tells rows of one id and text apart; fixed from here on.
            F.monotonically_increasing_id().alias("_row"),
        ), "shard-rows")
    extent = meta.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        *(f(n).alias(n + s) for n in names for f, s in ((F.min, "l"), (F.max, "h"))),
    ).first()
    tie = F.pmod(F.xxhash64("doc_id", "text_crc32", "_row"), F.lit(1 << TIE_BITS))
    rows = meta.select(
        "doc_id", "size", "text_crc32", tie.alias("_tie"), F.col("size").alias("_weight"),
        *(_scaled(F.col(n), extent[n + "l"], extent[n + "h"]).alias(n) for n in names),
    )
    nodes = {0: _Node(0, shards)}
    placed = written(rows.withColumn("_node", F.lit(0)), "shard-level")
    while any(n.count > 1 for n in nodes.values()):
        spans = {
            r["_node"]: r for r in placed.groupBy("_node").agg(
                F.sum("_weight").alias("bytes"),
                *(f(n).alias(n + s) for n in names for f, s in ((F.min, "l"), (F.max, "h"))),
            ).collect()  # one row per node
        }
        splitting = {k: n for k, n in nodes.items() if n.count > 1 and k in spans}
        if not splitting:
            break
        axis = {k: max(names, key=lambda n: spans[k][n + "h"] - spans[k][n + "l"]) for k in splitting}
        along = F.get(F.array(*names), _by_node(F.col("_node"), {k: names.index(a) for k, a in axis.items()}, 0).cast("int"))
        at = placed.withColumn("_at", F.shiftleft(along, TIE_BITS) + F.col("_tie")).select("_node", "_at", "_weight")
        wanted = {k: float(spans[k]["bytes"]) * (n.count // 2) / n.count for k, n in splitting.items()}
        cuts = _split_points(at, F.col("_node"), wanted, tolerance)
        where = F.shiftleft(along, TIE_BITS) + F.col("_tie")
        grown = {k: n for k, n in nodes.items() if k not in splitting}
        for k, n in splitting.items():
            half = n.count // 2
            grown[k], grown[n.first + half] = _Node(n.first, half), _Node(n.first + half, n.count - half)
        jump = _by_node(F.col("_node"), {k: n.count // 2 for k, n in splitting.items()}, 0)
        cut = _by_node(F.col("_node"), cuts, 1 << (COORDINATE_BITS + TIE_BITS + 1))
        moved = (F.col("_node") + F.when(where >= cut, jump).otherwise(F.lit(0))).cast("int")
        nodes = grown
        # Written at each level: the next one's histograms read it several times.
        placed = written(placed.withColumn("_node", moved), "shard-level")
    # Slots: numbers within pieces of bounded size, moved by the rows of the pieces before.
    pieces = max(1, -(-extent["rows"] // (shards * rows_per_piece))) * 4
    placed = placed.select(
        "doc_id", "size", "text_crc32", F.col("_node").alias("shard"),
        F.pmod(F.col("_tie"), F.lit(pieces)).cast("int").alias("_piece"))
    counts = placed.groupBy("shard", "_piece").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("shard", "_piece").orderBy("doc_id", "text_crc32")
    numbered = placed.withColumn("_within", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "_piece"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_before") + F.col("_within")).cast("bigint").alias("slot"))
