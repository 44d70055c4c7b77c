"""Bit arithmetic on blocks, and packed orders, against plain loops."""

import random
from datetime import datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from gapwatch.functions import bitmaps

TOP = 1 << 63


def _maps(seed):
    """Every power of two, everything below and between them, and random maps from sparse to dense."""
    pick = random.Random(seed)
    maps = {1 << n for n in range(64)} | {(1 << n) - 1 for n in range(1, 65)} | {TOP | 1 << n for n in range(63)}
    while len(maps) < 3000:
        drawn = [pick.getrandbits(64) for _ in range(pick.randint(1, 3))]
        value = drawn[0] >> pick.randrange(64)
        for other in drawn[1:]:
            value = value & other if pick.random() < 0.5 else value | other
        maps.add(value)
    return sorted(maps - {0})


@pytest.mark.parametrize("seed", [1, 2])
def test_ends_and_holes_of_blocks(spark, seed):
    maps = _maps(seed)
    frame = spark.createDataFrame([(3, m - (1 << 64) if m >= TOP else m) for m in maps], "block bigint, bits bigint")
    found = frame.select(
        "bits", bitmaps.lowest_serial("block", "bits").alias("low"), bitmaps.highest_serial("block", "bits").alias("high"),
        bitmaps.inner_gap_lengths("bits").alias("lengths"), bitmaps.inner_gaps("block", "bits").alias("gaps"))
    for row in found.collect():
        received = [192 + n for n in range(64) if row.bits >> n & 1]
        holes = [(a, b) for a, b in zip(received, received[1:]) if b > a + 1]
        assert (row.low, row.high) == (received[0], received[-1])
        assert row.lengths == [b - a - 1 for a, b in holes]
        assert [tuple(gap) for gap in row.gaps] == holes


def test_a_block_without_number_has_no_ends(spark):
    frame = spark.createDataFrame([(None, None)], "block bigint, bits bigint")
    ends = frame.select(bitmaps.lowest_serial("block", "bits"), bitmaps.highest_serial("block", "bits"))
    assert rows_of(ends) == [(None, None)]


def test_arrival_order_sorts_like_a_struct(spark):
    instants = [None, datetime(1, 1, 2), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1),
                datetime(2031, 9, 6, 13, 0, 0, 1), datetime(9999, 12, 30)]
    serials = [None, -TOP + 1, -1, 0, 1, TOP - 1]
    frame = spark.createDataFrame([(a, s) for a in instants for s in serials], "arrival timestamp, serial bigint")
    packed = frame.orderBy(bitmaps.arrival_order("arrival", "serial")).select(F.struct("arrival", "serial")).collect()
    plain = frame.orderBy(F.struct("arrival", "serial")).select(F.struct("arrival", "serial")).collect()
    assert packed == plain
