"""Exact ranks and quantiles without bringing all values into one task."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that a bracket of values is cut into per pass.
BUCKETS = 1024


@dataclass(frozen=True)
class _Bracket:
    """Values low … high, with so many values below them."""

    low: float
    high: float
    below: int


def exact_quantiles(values: DataFrame, column: str, probabilities: Sequence[float], buckets: int = BUCKETS) -> DataFrame:
    """Rows ``(probability, value)``, interpolated between neighbours like ``percentile``.

    ``percentile`` keeps every distinct value in one task. Here each wanted rank
    has a bracket of values, at first all of them. A pass counts the values per
    range of every bracket; the range that holds the rank is the next bracket, with its own
    smallest and largest value as ends, until these are equal. No value is ever
    put in order: per pass, at most ``buckets`` counts per rank leave the tasks.
    A rank that no range holds is an error. Without values there are no rows.
    """
    spark = values.sparkSession
    schema = "probability double, value double"
    values = values.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
        if not n:
            return spark.createDataFrame([], schema)
        positions = [p * (n - 1) for p in probabilities]
        ranks = {int(position) for position in positions} | {min(int(position) + 1, n - 1) for position in positions}
        brackets = dict.fromkeys(ranks, _Bracket(low, high, 0))
        while any(bracket.low < bracket.high for bracket in brackets.values()):
            brackets = _narrowed(values, brackets, buckets)
    finally:
        values.unpersist()
    found = []
    for p, position in zip(probabilities, positions):
        lower, upper = (brackets[min(int(position) + i, n - 1)].low for i in (0, 1))
        found.append((float(p), lower + (position - int(position)) * (upper - lower)))
    return spark.createDataFrame(sorted(found), schema)


def _narrowed(values: DataFrame, brackets: dict[int, _Bracket], buckets: int) -> dict[int, _Bracket]:
    """The brackets after one more pass."""
    wide = sorted({b for b in brackets.values() if b.low < b.high}, key=lambda b: b.low)
    v = F.col("v")
    # Brackets are equal or apart, so a value lies in one of them at most.
    place, width, start = F.lit(None).cast("int"), F.lit(1.0), F.lit(0.0)
    for i, bracket in enumerate(wide):
        inside = v.between(bracket.low, bracket.high)
        place, width, start = (F.when(inside, value).otherwise(other) for value, other in (
            (F.lit(i), place), (F.lit(bracket.high - bracket.low), width), (F.lit(bracket.low), start)))
    bucket = F.least(F.floor((v - start) / width * buckets), F.lit(buckets - 1))
    counted = values.select(place.alias("place"), bucket.alias("bucket"), "v").filter("place IS NOT NULL").groupBy("place", "bucket").agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("place", "bucket").collect()
    narrowed = {}
    for rank, bracket in brackets.items():
        if bracket.low == bracket.high:
            narrowed[rank] = bracket
            continue
        below = bracket.below
        for row in counted:
            if row["place"] != wide.index(bracket):
                continue
            if rank < below + row["n"]:
                narrowed[rank] = _Bracket(row["low"], row["high"], below)
                break
            below += row["n"]
        else:
            raise AssertionError(f"rank {rank} is outside its bracket: the values changed between passes")
    return narrowed


def ranked_values(
    counts: DataFrame, keys: Sequence[str], value: str, copies: str, percents: Sequence[int], coarse_bits: int = 16
) -> DataFrame:
    """``(keys…, percent, value, n)``: per group the smallest value with at least ``percent`` % of all at or below it.

    ``counts`` has a row per group and distinct integer value with its number of
    ``copies``. Prefix sums run over ranges of 2^coarse_bits values first; only
    the ranges that hold a rank are opened, so a task orders a group's ranges, or
    the values of one range.
    """
    counts = counts.select(
        *keys, F.col(value).alias("_value"), F.col(copies).alias("_copies"), F.shiftright(value, coarse_bits).alias("_range"))
    whole, upto = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_range")
    ranges = counts.groupBy(*keys, "_range").agg(F.sum("_copies").alias("_inside")).select(
        *keys, "_range", "_inside", F.sum("_inside").over(upto).alias("_upto"), F.sum("_inside").over(whole).alias("_n"))
    wanted = ranges.select("*", F.explode(F.array(*[F.lit(p) for p in percents])).alias("_percent"))
    rank = F.greatest(F.call_function("div", F.col("_percent") * F.col("_n") + 99, F.lit(100)), F.lit(1).cast("bigint"))
    places = [*keys, "_range"]
    opened = (
        wanted.withColumn("_rank", rank - (F.col("_upto") - F.col("_inside")))
        .filter("_rank > 0 AND _rank <= _inside")
        .select(*(F.col(name).alias(f"_its_{name}") for name in places), "_percent", "_rank", "_n")
    )
    # Keys may be null.
    held = counts.join(opened, reduce(and_, (F.col(name).eqNullSafe(F.col(f"_its_{name}")) for name in places)))
    in_order = Window.partitionBy(*keys, "_percent").orderBy("_value")
    return (
        held.withColumn("_reached", F.sum("_copies").over(in_order))
        .filter("_reached >= _rank AND _reached - _copies < _rank")
        .select(*keys, F.col("_percent").alias("percent"), F.col("_value").alias(value), F.col("_n").alias("n"))
    )
