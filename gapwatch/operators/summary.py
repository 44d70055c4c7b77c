"""The per-sequence summary every completeness result is built on."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwatch.functions.bitmaps import (
    LAST_POSITION, bits_of, block_of, copy_order, ordered_position, position_of, serial_at,
)
from gapwatch.functions.times import from_micros, micros, start_of_hour
from gapwatch.names import ALL_SEGMENTS
from gapwatch.operators.registry import attach_registry, filter_segment

SUMMARY_COLUMNS = (
    "sequence_id", "segment", "has_registry",
    "first_serial_id", "last_serial_id", "received_events", "duplicate_events",
    "first_event_type", "last_event_type", "implied_start",
    "missing_prefix", "missing_inner", "lost_events", "started_before_window",
)


def typed_blocks(events: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Events folded to one row per (sequence, block of 64 serials, type).

    All aggregates are plain longs, so this is one hash aggregation that
    shrinks the events before anything is shuffled, combines copies, and
    spreads a huge sequence over as many tasks as it has blocks. Everything
    below is derived from these rows. ``per`` names further columns to keep
    apart, such as a time window.
    """
    return events.groupBy(*per, "sequence_id", block_of("serial_id").alias("block"), "event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        bits_of("serial_id").alias("bits"),
        F.min(copy_order(position_of("serial_id"), "arrival")).alias("first_copy"),
        F.min(copy_order(LAST_POSITION - position_of("serial_id"), "arrival")).alias("last_copy"),
        F.min(micros("arrival") - F.col("offset_ms") * 1000).alias("started"),
        F.min("arrival").alias("first_arrival"),
    )


def facts_from_blocks(typed: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """One row per sequence: what arrived, measured from the events alone.

    * ``received_events`` counts distinct serials, ``duplicate_events`` the
      copies beyond the first of each.
    * ``first_event_type`` / ``last_event_type`` sit at the lowest / highest
      serial; of several copies the one with the smallest (arrival, type) counts.
    * ``implied_start`` is the smallest ``arrival - offset``. An event cannot
      arrive before it happens, so it is an upper bound of the start.
    * ``missing_prefix`` are the serials below the first one received,
      ``missing_inner`` the holes up to the last; ``lost_events`` is their sum.
      Serials after the last received one cannot be seen, so it is a lower bound.
    * ``conflicting_serials`` counts serials whose copies differ in type, once
      per further type. Where it is 0 the types' bitmaps do not overlap.
    """
    distinct = F.bit_count("bits").cast("bigint")
    blocks = typed.groupBy(*per, "sequence_id", "block").agg(
        F.sum("rows").alias("rows"),
        F.sum(distinct).alias("typed_serials"),
        F.bit_or("bits").alias("bits"),
        F.min(F.struct("first_copy", "event_type")).alias("first"),
        F.min(F.struct("last_copy", "event_type")).alias("last"),
        F.min("started").alias("started"),
        F.min("first_arrival").alias("first_arrival"),
    )
    numbered = F.col("block").isNotNull()
    sequences = blocks.groupBy(*per, "sequence_id").agg(
        F.sum("rows").alias("rows"),
        F.sum(distinct).alias("received_events"),
        F.sum(F.col("typed_serials") - distinct).alias("conflicting_serials"),
        F.min(F.when(numbered, F.struct("block", "first"))).alias("head"),
        F.max(F.when(numbered, F.struct("block", "last"))).alias("tail"),
        F.min("started").alias("started"),
        F.min("first_arrival").alias("first_arrival"),
    )
    first_serial = serial_at("head.block", ordered_position("head.first.first_copy"))
    last_serial = serial_at("tail.block", LAST_POSITION - ordered_position("tail.last.last_copy"))
    received = F.col("received_events")
    return sequences.select(
        *per,
        "sequence_id",
        first_serial.alias("first_serial_id"),
        last_serial.alias("last_serial_id"),
        received,
        (F.col("rows") - received).alias("duplicate_events"),
        F.col("head.first.event_type").alias("first_event_type"),
        F.col("tail.last.event_type").alias("last_event_type"),
        from_micros("started").alias("implied_start"),
        first_serial.alias("missing_prefix"),
        (last_serial - first_serial + 1 - received).alias("missing_inner"),
        (last_serial + 1 - received).alias("lost_events"),
        "first_arrival",
        "conflicting_serials",
    )


def sequence_facts(events: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """``facts_from_blocks`` straight from events."""
    return facts_from_blocks(typed_blocks(events, per), per)


def window_start_of(frame: DataFrame, arrival: str = "arrival") -> Column:
    """Scalar: the hour of the earliest arrival, which opens the data window."""
    return frame.agg(start_of_hour(F.min(arrival))).scalar()


def summary_of(
    facts: DataFrame,
    registry: DataFrame,
    segment: str = ALL_SEGMENTS,
    segments: Sequence[str] = (),
    window_start: Column | None = None,
) -> DataFrame:
    """Facts per sequence with its segment and the window flag.

    ``started_before_window`` says the sequence provably started before the
    window opened; false means "not proven". Without ``window_start`` the
    window opens at the hour of the earliest arrival in the chosen segment.
    """
    chosen = filter_segment(attach_registry(facts, registry), segment, segments)
    opens = window_start_of(chosen, "first_arrival") if window_start is None else window_start
    return chosen.withColumn("started_before_window", F.col("implied_start") < opens).select(*SUMMARY_COLUMNS)


def sequence_summary(
    events: DataFrame,
    registry: DataFrame,
    segment: str = ALL_SEGMENTS,
    segments: Sequence[str] = (),
    window_start: Column | None = None,
) -> DataFrame:
    """``summary_of`` straight from events."""
    if window_start is None:
        # Asked of the events, the earliest arrival is a scan of one column,
        # or for one segment a single grouping by sequence. Asked of the facts
        # it would fold the events a second time.
        scope = events.select("arrival")
        if segment != ALL_SEGMENTS:
            earliest = events.groupBy("sequence_id").agg(F.min("arrival").alias("arrival"))
            scope = filter_segment(attach_registry(earliest, registry), segment, segments)
        window_start = window_start_of(scope)
    return summary_of(sequence_facts(events), registry, segment, segments, window_start)
