"""How far events and registry cover each other, per window, exact and as sketches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwatch.monitoring.windows import window_start


def _share(part: str, of: str):
    return F.when(F.col(of) > 0, F.round(F.col(part) / F.col(of), 4))


def coverage_by_window(events: DataFrame, registry: DataFrame, width: str = "1 hour") -> DataFrame:
    """Sequences with events in a window that have no registry row, and rows registered in it that have no event.

    A window counts a sequence once. Both shares are null where nothing could be covered.
    """
    seen = events.select("sequence_id", window_start(width).alias("window_start")).distinct()
    listed = registry.filter("registered_at IS NOT NULL").select(
        "sequence_id", window_start(width, "registered_at").alias("window_start")).distinct()
    # Windows and the other side's keys meet in one grouping by sequence.
    keys = events.select("sequence_id", F.lit(True).alias("event")).unionByName(
        registry.select("sequence_id", F.lit(False).alias("event"))).groupBy("sequence_id").agg(
        F.bool_or("event").alias("has_events"), F.bool_or(~F.col("event")).alias("has_registry"))
    both = seen.withColumn("event", F.lit(True)).unionByName(listed.withColumn("event", F.lit(False))).join(keys, "sequence_id")
    counted = both.groupBy("window_start").agg(
        F.count_if("event").alias("with_events"),
        F.count_if(F.col("event") & ~F.col("has_registry")).alias("without_registry"),
        F.count_if(~F.col("event")).alias("registered"),
        F.count_if(~F.col("event") & ~F.col("has_events")).alias("without_events"),
    )
    return counted.withColumns({
        "share_without_registry": _share("without_registry", "with_events"),
        "share_without_events": _share("without_events", "registered"),
    })


def key_sketches(frame: DataFrame, time: str, width: str = "1 hour", nominal: int = 12) -> DataFrame:
    """One theta sketch of the sequences per window; 2^nominal keys at most, whatever the window holds."""
    return frame.filter(F.col(time).isNotNull()).groupBy(window_start(width, time).alias("window_start")).agg(
        F.theta_sketch_agg("sequence_id", nominal).alias("keys"))


def merge_key_sketches(sketches: DataFrame, width: str) -> DataFrame:
    return sketches.groupBy(window_start(width, "window_start").alias("window_start")).agg(
        F.theta_union_agg("keys").alias("keys"))


def sketched_coverage(seen: DataFrame, listed: DataFrame) -> DataFrame:
    """``coverage_by_window`` estimated from the sketches of both sides; only sketches are read."""
    all_seen, all_listed = (side.agg(F.theta_union_agg("keys")).scalar() for side in (seen, listed))
    one = seen.select(
        "window_start", F.theta_sketch_estimate("keys").alias("with_events"),
        F.theta_sketch_estimate(F.theta_difference("keys", all_listed)).alias("without_registry"))
    other = listed.select(
        "window_start", F.theta_sketch_estimate("keys").alias("registered"),
        F.theta_sketch_estimate(F.theta_difference("keys", all_seen)).alias("without_events"))
    return one.join(other, "window_start", "full_outer").fillna(0)
