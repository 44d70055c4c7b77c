"""Joining rows to a table with one row per sequence, whatever sequences hold most rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that a heavy sequence is cut into; a sequence is heavy with more than this share of all rows.
PARTS, HEAVY_SHARE = 32, 1 / 128
#: Counters that look for heavy sequences, well beyond the 1 / HEAVY_SHARE that can exist.
_COUNTERS = 10_000


def heavy_sequences(rows: DataFrame, share: float = HEAVY_SHARE):
    """Scalar: the sequences with more than ``share`` of all rows, at most 1 / share of them, as an array.

    One aggregate of bounded size over the key column, so a task per split and one row
    each. It may miss or add a sequence near the bound; results do not depend on it.
    """
    most = round(1 / share)
    keys = rows.select(F.col("sequence_id").alias("key")).filter("key IS NOT NULL")
    counted = keys.agg(F.call_function("approx_top_k", "key", F.lit(most), F.lit(_COUNTERS)).alias("top"), F.count("key").alias("n"))
    heavy = F.filter("top", lambda entry: entry["count"] > F.col("n") * share)
    return counted.select(F.transform(heavy, lambda entry: entry["item"])).scalar()


def look_up(rows: DataFrame, per_sequence: DataFrame, how: str = "left", parts: int = PARTS) -> DataFrame:
    """``rows`` joined to the one row their sequence has in ``per_sequence``.

    A plain join brings all rows of a sequence to one task. Rows of the heavy
    sequences are dealt over ``parts`` parts by their number, equal rows too, and the
    one row of such a sequence is repeated per part; all other sequences are
    joined plainly. (Skew handling at run time would not help: it needs a shuffle
    right below both sides of the join, and the per-sequence side is usually an
    aggregate.) Where one side is small Spark broadcasts it and shuffles neither.
    """
    heavy = heavy_sequences(rows)
    is_heavy = F.coalesce(F.array_contains(heavy, F.col("sequence_id")), F.lit(False))
    every_part = F.explode(F.when(is_heavy, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0))))
    part = F.when(is_heavy, F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")).otherwise(0)
    return rows.withColumn("part", part).join(
        per_sequence.withColumn("part", every_part), ["sequence_id", "part"], how
    ).drop("part")
