"""Loss against an announced number of events, with absent tails as a class of their own."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwatch.functions.bitmaps import bits_of, block_of, highest_serial, lowest_serial, received_between


def reconcile(events: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per sequence on either side, ``expected`` being ``(sequence_id, expected_events)``.

    Of the announced serials 0 … expected − 1, those received are counted on
    the bitmaps; the others are ``missing_prefix`` (before the first received),
    ``missing_inner`` or ``missing_tail`` (after the last). ``beyond_expected`` are received
    serials past the announced ones. Status: ``complete``, ``lossy``, ``unseen``
    (announced, nothing received: all of it is ``missing_tail``), ``unannounced``.
    Several announcements of a sequence count as the largest; without one the measures are null.
    """
    blocks = events.groupBy("sequence_id", block_of("serial_id").alias("block")).agg(bits_of("serial_id").alias("bits"))
    announced = expected.groupBy("sequence_id").agg(F.max("expected_events").alias("expected_events"))
    last_expected = F.col("expected_events") - 1
    lowest, highest = lowest_serial("block", "bits"), highest_serial("block", "bits")
    sequences = (
        blocks.join(announced, "sequence_id", "full_outer")
        .groupBy("sequence_id")
        .agg(
            F.max("expected_events").alias("expected_events"),
            F.coalesce(F.sum(F.bit_count("bits").cast("bigint")), F.lit(0)).alias("received_events"),
            F.coalesce(F.sum(received_between("block", "bits", F.lit(0), last_expected)), F.lit(0)).alias("received_expected"),
            F.min(lowest).alias("first_serial_id"),
            F.max(highest).alias("last_serial_id"),
        )
    )
    first = F.least(F.coalesce("first_serial_id", F.lit(0)), F.col("expected_events"))
    tail = F.greatest(F.col("expected_events") - 1 - F.coalesce("last_serial_id", F.lit(-1)), F.lit(0))
    absent = F.col("expected_events") - F.col("received_expected")
    status = (
        F.when(F.col("expected_events").isNull(), "unannounced")
        .when(F.col("received_events") == 0, F.when(F.col("expected_events") > 0, "unseen").otherwise("complete"))
        .when(absent > 0, "lossy").otherwise("complete")
    )
    measures = {
        "missing_prefix": first, "missing_inner": absent - first - tail, "missing_tail": tail,
        "beyond_expected": F.col("received_events") - F.col("received_expected"),
    }
    return sequences.select(
        "sequence_id", "expected_events", "received_events",
        *[F.when(F.col("expected_events").isNotNull(), measure).alias(name) for name, measure in measures.items()],
        status.alias("status"),
    )
