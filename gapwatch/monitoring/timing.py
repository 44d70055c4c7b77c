"""How far arrivals lie from the registry's clock, as sketches that merge and as exact ranks."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwatch.functions.quantiles import ranked_values
from gapwatch.functions.times import micros
from gapwatch.monitoring.windows import window_start
from gapwatch.operators.lookup import look_up
from gapwatch.operators.registry import one_row_per_sequence

PERCENTS = (1, 50, 99)
#: Size parameter of the sketches: larger is nearer, and more bytes per group.
SKETCH_K = 800


def timing_residuals(events: DataFrame, registry: DataFrame, width: str = "1 hour") -> DataFrame:
    """``window_start, segment, residual_us`` of every event of a sequence with a registry time.

    The residual is the arrival less the (earliest) registry time less the offset.
    """
    timed = registry.groupBy("sequence_id").agg(F.min("registered_at").alias("registered_at")).filter("registered_at IS NOT NULL")
    known = timed.join(one_row_per_sequence(registry).drop("has_registry"), "sequence_id")
    residual = micros("arrival") - micros("registered_at") - F.col("offset_ms") * 1000
    return look_up(events, known, how="inner").select(
        window_start(width).alias("window_start"), F.coalesce("segment", F.lit("unknown")).alias("segment"), residual.alias("residual_us"))


def residual_sketches(residuals: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One sketch of bounded size per (window, segment); combines before the shuffle."""
    return residuals.groupBy("window_start", "segment").agg(
        F.kll_sketch_agg_bigint("residual_us", F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, width: str) -> DataFrame:
    """Sketches of a larger width, from those of a smaller one; no event is read again."""
    return sketches.groupBy(window_start(width, "window_start").alias("window_start"), "segment").agg(
        F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, percents: Sequence[int] = PERCENTS) -> DataFrame:
    """``window_start, segment, percent, residual_us, n`` read off the sketches."""
    ranks = F.array(*[F.lit(p / 100) for p in percents])
    values = F.arrays_zip(
        F.array(*[F.lit(p) for p in percents]).alias("percent"),
        F.kll_sketch_get_quantile_bigint("sketch", ranks).alias("residual_us"))
    return sketches.select(
        "window_start", "segment", F.kll_sketch_get_n_bigint("sketch").alias("n"), F.inline(values))


def exact_residuals(residuals: DataFrame, percents: Sequence[int] = PERCENTS) -> DataFrame:
    """The same without error: the residual at each rank, from counts of equal residuals."""
    counts = residuals.groupBy("window_start", "segment", "residual_us").agg(F.count(F.lit(1)).alias("copies"))
    return ranked_values(counts, ("window_start", "segment"), "residual_us", "copies", percents)
