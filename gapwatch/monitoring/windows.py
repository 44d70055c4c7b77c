"""Bitmaps of received serials per window of arrivals, and completeness judged across the windows' boundaries."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwatch.functions.bitmaps import bits_of, block_of, highest_serial, lowest_serial, received_between


def window_start(width: str, arrival: str = "arrival") -> Column:
    return F.window(arrival, width).start


def interval(width: str) -> Column:
    return F.expr(f"INTERVAL {width}")


def window_blocks(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Events folded to one row per (window, sequence, block of 64 serials): ``bits, rows, last_arrival``.

    These rows can be stored and merged: bits are united, rows added up.
    """
    return events.groupBy(
        window_start(width).alias("window_start"), "sequence_id", block_of("serial_id").alias("block")
    ).agg(bits_of("serial_id").alias("bits"), F.count(F.lit(1)).alias("rows"), F.max("arrival").alias("last_arrival"))


def latest_arrival(events: DataFrame) -> Column:
    """What ``boundary_completeness`` takes from the blocks of ``events`` for ``as_of``, read without folding them."""
    return events.agg(F.max("arrival")).scalar()


def boundary_completeness(
    blocks: DataFrame, width: str = "1 hour", lateness: str = "10 minutes", as_of: Column | None = None
) -> DataFrame:
    """Loss per (window, sequence), with a look back and a look ahead of one window.

    ``blocks`` are ``window_blocks`` of the same width. A window answers for
    the serials up to the last one it received, starting after the last one of the
    window before, or at its own first one if that is lower or there is nothing
    before. ``lost_events`` counts those of them that none of the three windows
    received: a sequence that runs on over a boundary loses nothing, nor does one whose
    events come an hour late. ``unseen_prefix`` are the serials before the first one of a
    sequence that the window before did not see; whether they came earlier is
    not known here. ``judged`` says that the last event around is older
    than ``lateness`` at ``as_of``, the latest arrival unless given.
    """
    step = interval(width)
    own, before = F.col("place") == 0, F.col("place") == -1
    places = F.array(*[
        F.struct(start.alias("window_start"), F.lit(place).alias("place"))
        for place, start in ((0, F.col("start")), (-1, F.col("start") + step), (1, F.col("start") - step))
    ])
    # One shuffle: what follows groups by these two columns, or by them and more.
    around = (
        blocks.filter("sequence_id IS NOT NULL")
        .withColumnRenamed("window_start", "start")
        .select("sequence_id", "block", "bits", "rows", "last_arrival", F.inline(places))
        .repartition("window_start", "sequence_id")
        .groupBy("window_start", "sequence_id", "block")
        .agg(
            F.bit_or("bits").alias("bits"),
            F.bit_or(F.when(own, F.col("bits"))).alias("own_bits"),
            F.bit_or(F.when(before, F.col("bits"))).alias("bits_before"),
            F.sum(F.when(own, F.col("rows"))).alias("rows"),
            F.max("last_arrival").alias("last_arrival"),
        )
    )
    every_block = Window.partitionBy("window_start", "sequence_id")
    inside = (
        around.select(
            "window_start",
            "sequence_id",
            "block",
            "bits",
            F.min(lowest_serial("block", "own_bits")).over(every_block).alias("first_serial_id"),
            F.max(highest_serial("block", "own_bits")).over(every_block).alias("last_serial_id"),
            F.max(highest_serial("block", "bits_before")).over(every_block).alias("last_before"),
            F.sum("rows").over(every_block).alias("rows"),
            F.max("last_arrival").over(every_block).alias("last_arrival"),
        )
        .filter("last_serial_id IS NOT NULL")
        .withColumn("from_serial_id", F.least(F.col("first_serial_id"), F.col("last_before") + 1))
    )
    # Blocks outside the range hold nothing the window answers for.
    counted = inside.groupBy(*[c for c in inside.columns if c not in ("block", "bits")]).agg(
        F.sum(received_between("block", "bits", F.col("from_serial_id"), F.col("last_serial_id"))).alias("received"))
    latest = blocks.agg(F.max("last_arrival")).scalar() if as_of is None else as_of
    return counted.select(
        "window_start",
        "sequence_id",
        "first_serial_id",
        "last_serial_id",
        "rows",
        (F.col("last_serial_id") - F.col("from_serial_id") + 1 - F.col("received")).alias("lost_events"),
        F.when(F.col("last_before").isNull(), F.col("first_serial_id")).otherwise(0).alias("unseen_prefix"),
        (F.col("last_arrival") + interval(lateness) <= latest).alias("judged"),
    )


def merge_windows(blocks: DataFrame, width: str) -> DataFrame:
    """``window_blocks`` of a larger width from those of a smaller one that divides it."""
    return blocks.groupBy(window_start(width, "window_start").alias("window_start"), "sequence_id", "block").agg(
        F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"), F.max("last_arrival").alias("last_arrival"))
