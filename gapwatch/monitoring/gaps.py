"""Where and when events went missing: inner gaps put into the windows between their neighbours' arrivals."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwatch.functions.bitmaps import bits_of, block_of, highest_serial, inner_gaps, lowest_serial
from gapwatch.functions.times import from_micros, micros
from gapwatch.monitoring.windows import interval, window_start
from gapwatch.operators.registry import attach_registry
from gapwatch.operators.serials import STRETCH_BITS


def gap_edges(events: DataFrame, stretch_bits: int = STRETCH_BITS) -> DataFrame:
    """``(sequence_id, before, after)`` of every inner gap: the received serials around a run of absent ones.

    Read off block bitmaps, like the lengths of ``gap_runs``; events are not sorted.
    """
    blocks = events.groupBy("sequence_id", block_of("serial_id").alias("block")).agg(bits_of("serial_id").alias("bits"))
    blocks = blocks.select(
        "sequence_id", F.shiftright("block", stretch_bits).alias("stretch"), "block",
        lowest_serial("block", "bits").alias("start"), highest_serial("block", "bits").alias("end"),
        inner_gaps("block", "bits").alias("inner"))
    inside = Window.partitionBy("sequence_id", "stretch").orderBy("block")
    joint = lambda over: F.struct(F.lag("end").over(over).alias("before"), F.col("start").alias("after"))
    within = blocks.select("sequence_id", "inner", joint(inside).alias("joint")).select(
        "sequence_id", F.inline(F.concat("inner", F.array("joint"))))
    stretches = blocks.groupBy("sequence_id", "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    across = Window.partitionBy("sequence_id").orderBy("stretch")
    joints = stretches.select("sequence_id", joint(across).alias("gap")).select("sequence_id", "gap.*")
    return within.unionByName(joints).filter(F.col("after") > F.col("before") + 1)


def dated_gaps(events: DataFrame, edges: DataFrame) -> DataFrame:
    """``edges`` with the earliest arrivals of both neighbours, ``from_us`` and ``to_us``, the earlier one first.

    Only neighbours of gaps are looked up, so few rows of the events are grouped.
    """
    ends = edges.select("sequence_id", F.explode(F.array("before", "after")).alias("serial_id")).distinct()
    arrivals = events.join(ends, ["sequence_id", "serial_id"], "left_semi").groupBy("sequence_id", "serial_id").agg(
        micros(F.min("arrival")).alias("at"))
    side = lambda name: arrivals.select("sequence_id", F.col("serial_id").alias(name), F.col("at").alias(f"{name}_at"))
    dated = edges.join(side("before"), ["sequence_id", "before"]).join(side("after"), ["sequence_id", "after"])
    return dated.select(
        "sequence_id", "before", "after",
        F.least("before_at", "after_at").alias("from_us"), F.greatest("before_at", "after_at").alias("to_us"))


def _absent_until(end_us: Column) -> Column:
    """How many of a gap's n absent serials fall before an instant.

    They are thought to be spread evenly between the arrivals, serial j at
    from + floor(j * (to - from) / (n + 1)).
    """
    absent = F.col("after") - F.col("before") - 1
    wide = lambda c: c.cast("decimal(19,0)")
    span = F.col("to_us") - F.col("from_us")
    share = wide(end_us - F.col("from_us")) * wide(absent + 1)
    passed = F.call_function("div", share + wide(span) - F.lit(1), F.greatest(wide(span), F.lit(1)))
    return (
        F.when(end_us <= F.col("from_us"), 0)
        .when((span == 0) | (end_us > F.col("to_us")), absent)
        .otherwise(F.least(absent, passed - 1))
    )


def gaps_by_window(gaps: DataFrame, width: str = "1 hour") -> DataFrame:
    """``(window_start, sequence_id, absent_events)``; the sum over windows is the length of all inner gaps."""
    step = interval(width)
    first, last = (window_start(width, name) for name in ("from_at", "to_at"))
    # One value in one window is the common case; windows are spelled out where a gap spans several.
    spread = gaps.select("*", from_micros("from_us").alias("from_at"), from_micros("to_us").alias("to_at")).select(
        "*", first.alias("first_start")).select("*", last.alias("last_start")).select(
        "*", F.explode(F.sequence("first_start", "last_start", step)).alias("window_start"))
    absent = _absent_until(micros(F.col("window_start") + step)) - _absent_until(micros("window_start"))
    return spread.select("window_start", "sequence_id", absent.cast("bigint").alias("absent_events")).filter("absent_events > 0")


def gap_rate(events: DataFrame, registry: DataFrame, width: str = "1 hour") -> DataFrame:
    """Inner loss per (window, segment): ``absent_events``, ``sequences_with_gaps``, ``received_rows``, ``absent_per_1000``.

    The rate is null in windows that received nothing.
    """
    per_sequence = ("window_start", "sequence_id")
    received = events.groupBy(window_start(width).alias("window_start"), "sequence_id").agg(F.count(F.lit(1)).alias("received"))
    absent = gaps_by_window(dated_gaps(events, gap_edges(events)), width).groupBy(*per_sequence).agg(
        F.sum("absent_events").alias("absent"))
    both = received.withColumn("absent", F.lit(None).cast("bigint")).unionByName(
        absent.withColumn("received", F.lit(None).cast("bigint")))
    counted = attach_registry(both, registry).groupBy("window_start", "segment").agg(
        F.coalesce(F.sum("absent"), F.lit(0)).alias("absent_events"),
        F.count("absent").alias("sequences_with_gaps"),
        F.coalesce(F.sum("received"), F.lit(0)).alias("received_rows"),
    )
    rate = F.when(F.col("received_rows") > 0, F.round(F.col("absent_events") * 1000 / F.col("received_rows"), 3))
    return counted.withColumn("absent_per_1000", rate)


def copy_delays(events: DataFrame, registry: DataFrame, width: str = "1 hour") -> DataFrame:
    """Copies per (window of the copy's arrival, segment, delay): ``copies`` in a logarithmic histogram.

    The first copy of a serial is the earliest arrival; every further row is a
    copy, late by its distance to the first. ``delay_ms_from`` is the lower end of the
    delay's bucket: 0, 1, 2, 4, 8, … milliseconds. Rows of equal arrival are
    counted together, so nothing is sorted, and histograms of windows add up.
    """
    at = events.groupBy("sequence_id", "serial_id", "arrival").agg(F.count(F.lit(1)).alias("rows"))
    first = at.groupBy("sequence_id", "serial_id").agg(F.min("arrival").alias("first_arrival"), F.sum("rows").alias("all_rows"))
    repeated = first.filter("all_rows > 1").select("sequence_id", "serial_id", "first_arrival")
    later = at.join(repeated, ["sequence_id", "serial_id"])
    delay = F.call_function("div", micros("arrival") - micros("first_arrival"), F.lit(1000))
    copies = F.col("rows") - (F.col("arrival") == F.col("first_arrival")).cast("bigint")
    per_sequence = later.select("sequence_id", "arrival", delay.alias("delay_ms"), copies.alias("copies")).filter("copies > 0").groupBy(
        window_start(width).alias("window_start"), "sequence_id",
        # the highest bit of the delay
        F.when(F.col("delay_ms") > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin("delay_ms")) - 1)).otherwise(0).alias("delay_ms_from"),
    ).agg(F.sum("copies").alias("copies"))
    return attach_registry(per_sequence, registry).groupBy("window_start", "segment", "delay_ms_from").agg(
        F.sum("copies").alias("copies"))


def copy_rate(delays: DataFrame, events: DataFrame, registry: DataFrame, width: str = "1 hour") -> DataFrame:
    """Rows and copies per (window, segment), with the copies' share."""
    received = attach_registry(
        events.groupBy(window_start(width).alias("window_start"), "sequence_id").agg(F.count(F.lit(1)).alias("rows")), registry
    ).groupBy("window_start", "segment").agg(F.sum("rows").alias("rows"))
    copies = delays.groupBy("window_start", "segment").agg(F.sum("copies").alias("copies"))
    joined = received.join(copies, ["window_start", "segment"], "left").fillna(0, ["copies"])
    return joined.withColumn("copy_share", F.round(F.col("copies") / F.col("rows"), 4))
