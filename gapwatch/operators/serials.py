"""Events reduced to one row per (sequence, serial), and measures in serial order."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapwatch.functions.bitmaps import (
    arrival_order, bits_of, block_of, highest_serial, inner_gap_lengths, lowest_serial,
)

# Ordered measures look at one stretch of 2**18 serials at a time. After
# de-duplication a stretch has at most that many rows, so no task ever sorts
# a whole sequence, however long it is.
STRETCH_BITS = 18


def received_serials(events: DataFrame) -> DataFrame:
    """De-duplicated events: of several copies the smallest (arrival, type, offset) stays.

    The minimum combines before the shuffle, so a serial delivered millions of
    times sends one row per task, and a long sequence is spread by its serials.
    """
    return (
        events.groupBy("sequence_id", "serial_id")
        .agg(F.min(F.struct("arrival", "event_type", "offset_ms")).alias("kept"))
        .select("sequence_id", "serial_id", "kept.*")
    )


def ordering_violations(serials: DataFrame, stretch_bits: int = STRETCH_BITS) -> DataFrame:
    """How often offset or arrival decreases as the serial grows, and in how many sequences.

    Inside a stretch of serials each one is compared with the one before by
    ``lag``. The first of a stretch follows the last of the stretch before, so
    a stretch is folded to its counts and its two ends, and only those rows
    are put in order per sequence.
    """
    inside = Window.partitionBy("sequence_id", "stretch").orderBy("serial_id")
    compared = serials.select(
        "sequence_id", F.shiftright("serial_id", stretch_bits).alias("stretch"), "serial_id", "offset_ms", "arrival"
    ).select(
        "*",
        (F.col("offset_ms") < F.lag("offset_ms").over(inside)).alias("offset_back"),
        (F.col("arrival") < F.lag("arrival").over(inside)).alias("arrival_back"),
    )
    stretches = compared.groupBy("sequence_id", "stretch").agg(
        F.count_if("offset_back").alias("offsets"),
        F.count_if("arrival_back").alias("arrivals"),
        *[pick(name, "serial_id").alias(f"{end}_{name}")
          for end, pick in (("start", F.min_by), ("end", F.max_by)) for name in ("offset_ms", "arrival")],
    )
    across = Window.partitionBy("sequence_id").orderBy("stretch")
    sequences = (
        stretches.select(
            "sequence_id",
            "offsets",
            "arrivals",
            (F.col("start_offset_ms") < F.lag("end_offset_ms").over(across)).alias("offset_back"),
            (F.col("start_arrival") < F.lag("end_arrival").over(across)).alias("arrival_back"),
        )
        .groupBy("sequence_id")
        .agg(
            (F.sum("offsets") + F.count_if("offset_back")).alias("offsets"),
            (F.sum("arrivals") + F.count_if("arrival_back")).alias("arrivals"),
        )
    )
    none = F.lit(0).cast("bigint")
    return sequences.agg(
        F.coalesce(F.sum("offsets"), none).alias("offset_decreases"),
        F.coalesce(F.sum("arrivals"), none).alias("arrival_decreases"),
        F.count_if(F.col("arrivals") > 0).alias("sequences_with_arrival_decrease"),
    )


def gap_runs(events: DataFrame, stretch_bits: int = STRETCH_BITS) -> DataFrame:
    """Inner gaps as runs of consecutive absent serials: ``(gap_run, runs)`` by length.

    Works on block bitmaps: runs inside a block are read off its bits, runs
    across blocks lie between the end of one received block and the start of
    the next. Nothing larger than a row per block is shuffled or sorted.
    """
    blocks = events.groupBy("sequence_id", block_of("serial_id").alias("block")).agg(bits_of("serial_id").alias("bits"))
    # First and last serial come from the bits, so all branches below read one shuffle.
    blocks = blocks.select(
        "sequence_id",
        "block",
        F.shiftright("block", stretch_bits).alias("stretch"),
        lowest_serial("block", "bits").alias("start"),
        highest_serial("block", "bits").alias("end"),
        inner_gap_lengths("bits").alias("inner"),
    )
    inside = Window.partitionBy("sequence_id", "stretch").orderBy("block")
    before = F.col("start") - F.lag("end").over(inside) - 1
    within = blocks.select("inner", before.alias("before")).select(
        F.explode(F.concat("inner", F.array("before"))).alias("gap_run")
    )

    stretches = blocks.groupBy("sequence_id", "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    across = Window.partitionBy("sequence_id").orderBy("stretch")
    joints = stretches.select((F.col("start") - F.lag("end").over(across) - 1).alias("gap_run"))

    return (
        within.unionByName(joints).filter("gap_run > 0")
        .groupBy("gap_run").agg(F.count(F.lit(1)).alias("runs")).orderBy("gap_run")
    )


def last_types_by_ordering(serials: DataFrame) -> DataFrame:
    """Sequences per pair of last types: the last by serial against the last by arrival.

    Equal arrivals are decided by the serial. The events fold per (sequence, type)
    to two plain numbers, which combine in a hash aggregate before the shuffle;
    types are compared only between the few rows of a sequence that are left.
    """
    types = serials.groupBy("sequence_id", "event_type").agg(
        F.max("serial_id").alias("serial"), F.max(arrival_order("arrival", "serial_id")).alias("order")
    )
    last = types.groupBy("sequence_id").agg(
        F.max(F.struct("serial", "event_type")).alias("by_serial"),
        F.max(F.struct("order", "event_type")).alias("by_arrival"),
    )
    return (
        last.groupBy(
            F.col("by_serial.event_type").alias("type_by_serial"),
            F.col("by_arrival.event_type").alias("type_by_arrival"),
        )
        .agg(F.count(F.lit(1)).alias("sequences"))
    )


def last_event_by_ordering(serials: DataFrame) -> DataFrame:
    """Tidy ``(ordering, event_type, sequences)`` for both orderings."""
    pairs = last_types_by_ordering(serials)
    either = F.array(*[
        F.struct(F.lit(name).alias("ordering"), F.col(f"type_by_{name}").alias("event_type"))
        for name in ("serial", "arrival")
    ])
    return (
        pairs.select("sequences", F.inline(either))
        .groupBy("ordering", "event_type")
        .agg(F.sum("sequences").alias("sequences"))
        .orderBy("ordering", "event_type")
    )


def last_event_disagreements(serials: DataFrame) -> DataFrame:
    """One row: sequences whose last type depends on the ordering."""
    differs = F.col("type_by_serial") != F.col("type_by_arrival")
    return last_types_by_ordering(serials).agg(
        F.coalesce(F.sum(F.when(differs, F.col("sequences"))), F.lit(0).cast("bigint")).alias("sequences")
    )


def max_offset_ties(serials: DataFrame) -> DataFrame:
    """One row: sequences with several events at their largest offset, and of those with several types.

    Grouping by (sequence, offset) first makes the largest offset a plain
    maximum of rows that already carry their tie counts; no join back.
    """
    per_offset = serials.groupBy("sequence_id", "offset_ms").agg(
        F.count(F.lit(1)).alias("events"), (F.min("event_type") != F.max("event_type")).alias("mixed")
    )
    at_maximum = per_offset.groupBy("sequence_id").agg(
        F.max_by("events", "offset_ms").alias("events"), F.max_by("mixed", "offset_ms").alias("mixed")
    )
    return at_maximum.agg(
        F.count_if(F.col("events") > 1).alias("tied_sequences"), F.count_if("mixed").alias("tied_between_types")
    )
