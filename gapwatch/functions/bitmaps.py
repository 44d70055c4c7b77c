"""Received serials as 64-bit maps.

A sequence's serials are cut into blocks of 64. Inside a block the set of
received serials is one long, built with ``bit_or``: an aggregate that
combines before the shuffle and needs constant space per block, however many
copies of a serial arrive. That replaces ``count(DISTINCT serial)``, which
would send every serial through two shuffles.
"""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK_SHIFT = 6  # 2**6 serials per block: the bits of a long
LAST_POSITION = (1 << _BLOCK_SHIFT) - 1
_ARRIVALS = 1 << 64  # more than the instants a timestamp can hold, in microseconds


def block_of(serial: str) -> Column:
    return F.shiftright(serial, _BLOCK_SHIFT)


def position_of(serial: str) -> Column:
    """Position of a serial in its block, 0 to 63."""
    return F.col(serial).bitwiseAND(F.lit(LAST_POSITION))


def serial_at(block: str, position: Column) -> Column:
    return F.call_function("shiftleft", F.col(block), F.lit(_BLOCK_SHIFT)) + position


def bits_of(serial: str) -> Column:
    """Aggregate: the received serials of one block as a bitmap."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), position_of(serial).cast("int")))


def copy_order(position: Column, arrival: str) -> Column:
    """One number that sorts the copies of a block by position, then by arrival.

    Its minimum is a plain decimal, which a hash aggregate can keep; a struct
    would force sorting. Every instant of a timestamp has its own place; a
    null arrival comes before all of them, as in ``received_serials``.
    """
    instant = F.unix_micros(arrival).cast("decimal(20,0)") + F.lit(Decimal(_ARRIVALS // 2))
    upper = position.cast("decimal(3,0)") * F.lit(Decimal(_ARRIVALS))
    return (upper + F.coalesce(instant, F.lit(Decimal(0)))).cast("decimal(24,0)")


def arrival_order(arrival: str, serial: str) -> Column:
    """One number that sorts events by arrival, then by serial; nulls come first, as in a struct of the two.

    Years 1 to 9999 in microseconds keep within 2**58, so the product fits the 38 digits of a decimal.
    """
    instant = F.coalesce(F.unix_micros(arrival), F.lit(-(1 << 58))).cast("decimal(18,0)")
    lowest = F.lit(-(1 << 63))
    return (instant * F.lit(Decimal(_ARRIVALS)) + F.coalesce(F.col(serial), lowest)).cast("decimal(38,0)")


def ordered_position(order: str) -> Column:
    """The position a ``copy_order`` value was made from.

    Instants of timestamps lie near the middle of their range, so the rounding
    of the quotient can't carry into the position.
    """
    return F.floor(F.col(order) / F.lit(Decimal(_ARRIVALS))).cast("bigint")


def _down(bits: Column, by) -> Column:
    """Bits moved down, zeros from above."""
    return F.call_function("shiftrightunsigned", bits, by)


def _lowest(bits: Column) -> Column:
    """Position of the lowest bit. The sign bit is set aside: arithmetic below it can't overflow."""
    below = bits.bitwiseAND(F.lit((1 << LAST_POSITION) - 1))
    return F.when(below == 0, LAST_POSITION).otherwise(F.bit_count((below - 1).bitwiseAND(F.bitwise_not(below))))


def _highest(bits: Column) -> Column:
    """Position of the highest bit.

    Bits under a set bit are cleared first. What is left has no two ones side by side,
    so it lies below 4/3 of its power of two, and neither the double nor the
    logarithm, read a quarter up, can reach another one.
    """
    sparse = bits.bitwiseAND(F.bitwise_not(_down(bits, F.lit(1))))
    return F.when(bits < 0, LAST_POSITION).otherwise(F.floor(F.log2(sparse.cast("double")) + 0.25).cast("int"))


def _has_hole(bits: Column) -> Column:
    return F.bit_count(bits) < _highest(bits) - _lowest(bits) + 1


def lowest_serial(block, bits: str) -> Column:
    """The first received serial of a block."""
    return serial_at(block, _lowest(F.col(bits)))


def highest_serial(block, bits: str) -> Column:
    """The last received serial of a block."""
    return serial_at(block, _highest(F.col(bits)))


def _before_holes(bits: Column) -> Column:
    """Positions of received serials whose next one is absent while a later one is there."""
    ends = F.filter(
        F.sequence(F.lit(0), F.lit(LAST_POSITION - 1)),
        lambda at: (_down(bits, at).bitwiseAND(F.lit(3)) == 1) & (_down(bits, at + 1) != 0))
    # Blocks without a hole, nearly all of them, are not spelled out.
    return F.when(_has_hole(bits), ends).otherwise(F.array().cast("array<int>"))


def inner_gap_lengths(bits: str) -> Column:
    """Lengths of the runs of absent serials between received serials of one block."""
    return F.transform(
        _before_holes(F.col(bits)), lambda at: _lowest(_down(F.col(bits), at + 1)).cast("bigint"))


def inner_gaps(block, bits) -> Column:
    """Runs of absent serials between received serials of one block, as structs ``(before, after)`` of those serials."""
    return F.transform(_before_holes(F.col(bits)), lambda at: F.struct(
        serial_at(block, at).alias("before"),
        serial_at(block, at + 1 + _lowest(_down(F.col(bits), at + 1))).alias("after")))


def received_between(block: str, bits: str, first: Column, last: Column) -> Column:
    """How many received serials of a block lie in first … last."""
    start = serial_at(block, F.lit(0))
    low = F.greatest(first - start, F.lit(0)).cast("int")
    high = F.least(last - start, F.lit(LAST_POSITION)).cast("int")
    ones = F.lit(-1).cast("bigint")
    mask = F.call_function("shiftleft", ones, low).bitwiseAND(
        F.call_function("shiftrightunsigned", ones, F.lit(LAST_POSITION) - high))
    inside = (last >= start) & (first <= start + LAST_POSITION) & (first <= last)
    return F.when(inside, F.bit_count(F.col(bits).bitwiseAND(mask)).cast("bigint")).otherwise(0)
