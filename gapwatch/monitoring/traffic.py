"""Traffic against its own time of day, and events per sequence by type."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwatch.functions.quantiles import ranked_values
from gapwatch.monitoring.windows import window_start
from gapwatch.operators.registry import attach_registry

#: A normal distribution's standard deviation per median absolute deviation.
SIGMAS = 1.4826


def _median(values: Column) -> Column:
    ordered, size = F.array_sort(values), F.size(values)
    middle = lambda at: F.get(ordered, at)
    return F.when(size > 0, (middle(F.floor((size - 1) / 2).cast("int")) + middle(F.floor(size / 2).cast("int"))) / 2)


def hourly_traffic(events: DataFrame, registry: DataFrame) -> DataFrame:
    """``window_start, segment, rows`` per hour; sequences are joined after counting."""
    counted = events.groupBy(window_start("1 hour").alias("window_start"), "sequence_id").agg(F.count(F.lit(1)).alias("rows"))
    return attach_registry(counted, registry).groupBy("window_start", "segment").agg(F.sum("rows").alias("rows"))


def time_of_day_baseline(
    traffic: DataFrame, measure: str = "rows", days: int = 28, bound: float = 3.0, least_days: int = 5
) -> DataFrame:
    """Each hour's measure against the median of the same hour and segment on earlier days.

    The baseline are the last ``days`` earlier days that have the hour: median
    and median absolute deviation. An hour ``deviates`` if it is further from
    the median than ``bound`` standard deviations as the deviation implies them, and at least by
    one; null with fewer than ``least_days`` earlier days.
    """
    earlier = Window.partitionBy(F.hour("window_start"), "segment").orderBy("window_start").rowsBetween(-days, -1)
    past = traffic.select("*", F.collect_list(measure).over(earlier).alias("past"))
    centred = past.withColumn("median", _median(F.col("past")))
    spread = centred.withColumn(
        "deviation", _median(F.transform("past", lambda x: F.abs(x - F.col("median")))))
    distance = F.abs(F.col(measure) - F.col("median"))
    return spread.select(
        "window_start", "segment", measure, F.size("past").alias("days"), "median", "deviation",
        F.when(F.size("past") >= least_days, distance > F.greatest(bound * SIGMAS * F.col("deviation"), F.lit(1.0))).alias("deviates"))


def events_per_sequence(counted: DataFrame, percents: Sequence[int] = (50, 95, 99)) -> DataFrame:
    """``event_type, percent, events, n``: events of a type per sequence that has it, at exact ranks.

    ``counted`` has a row per (sequence, type). Sequences are counted per number
    of events first, so what is put in order are the few distinct numbers.
    """
    counts = counted.groupBy("event_type", "events").agg(F.count(F.lit(1)).alias("sequences"))
    return ranked_values(counts, ("event_type",), "events", "sequences", percents)
