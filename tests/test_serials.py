"""Measures in serial order, against brute force over the same rows."""

import random
from collections import Counter, defaultdict
from datetime import timedelta

import pytest
from conftest import CHANGE, CREATE, DOWN, EVENTS, HOUR, PAGE, rows_of
from pyspark.sql import functions as F

from gapwatch.operators import serials as ordered


def _random_rows(seed):
    """Long gaps, repeated serials, conflicting copies; serials up to 20 000."""
    dice = random.Random(seed)
    rows = []
    for sequence in range(12):
        serial = dice.choice([0, 0, 3, 63, 64, 700])
        for _ in range(dice.randrange(1, 120)):
            for _ in range(dice.choice([1, 1, 1, 2, 3])):
                arrival = HOUR + timedelta(seconds=dice.randrange(0, 40))
                rows.append((sequence, serial, dice.randrange(0, 30), arrival, dice.choice([PAGE, CREATE, CHANGE, DOWN])))
            serial += dice.choice([1, 1, 1, 2, 5, 62, 64, 65, 130, 4000])
    dice.shuffle(rows)
    return rows


def _kept(rows):
    best = {}
    for sequence, serial, offset, arrival, kind in rows:
        key = (sequence, serial)
        best[key] = min(best.get(key, (arrival, kind, offset)), (arrival, kind, offset))
    sequences = defaultdict(list)
    for (sequence, serial), (arrival, kind, offset) in sorted(best.items()):
        sequences[sequence].append((serial, arrival, kind, offset))
    return sequences


@pytest.mark.parametrize("seed, stretch_bits", [(1, 2), (2, 5), (3, 18)])
def test_against_brute_force(spark, seed, stretch_bits):
    rows = _random_rows(seed)
    events = spark.createDataFrame(rows, EVENTS)
    sequences = _kept(rows)

    gaps, offset_back, arrival_back, late_sequences = Counter(), 0, 0, set()
    tied = mixed = 0
    pairs = Counter()
    for sequence, events_of in sequences.items():
        for (s0, a0, _, o0), (s1, a1, _, o1) in zip(events_of, events_of[1:]):
            if s1 - s0 > 1:
                gaps[s1 - s0 - 1] += 1
            offset_back += o1 < o0
            arrival_back += a1 < a0
            if a1 < a0:
                late_sequences.add(sequence)
        top = max(o for *_, o in events_of)
        at_top = [kind for _, _, kind, o in events_of if o == top]
        tied += len(at_top) > 1
        mixed += len(set(at_top)) > 1
        by_arrival = max(events_of, key=lambda event: (event[1], event[0]))
        pairs[events_of[-1][2], by_arrival[2]] += 1

    assert dict(rows_of(ordered.gap_runs(events, stretch_bits))) == gaps
    kept = ordered.received_serials(events)
    assert kept.count() == sum(map(len, sequences.values()))
    assert rows_of(ordered.ordering_violations(kept, stretch_bits)) == [(offset_back, arrival_back, len(late_sequences))]
    assert rows_of(ordered.max_offset_ties(kept)) == [(tied, mixed)]
    found = {(a, b): n for a, b, n in rows_of(ordered.last_types_by_ordering(kept))}
    assert found == pairs
    assert rows_of(ordered.last_event_disagreements(kept)) == [(sum(n for (a, b), n in pairs.items() if a != b),)]


def test_input_order_and_later_copies_change_nothing(spark):
    rows = _random_rows(9)
    events = spark.createDataFrame(rows, EVENTS)
    later = [(sequence, serial, offset, HOUR + timedelta(hours=1), kind) for sequence, serial, offset, _, kind in rows[:50]]
    again = spark.createDataFrame(later + rows[::-1], EVENTS)
    kept = [sorted(rows_of(ordered.received_serials(frame))) for frame in (events, again)]
    assert kept[0] == kept[1]
    assert rows_of(ordered.gap_runs(events)) == rows_of(ordered.gap_runs(again))


def test_last_event_by_ordering(make_events):
    # Serial 1 is last in order, serial 0 arrives last.
    kept = ordered.received_serials(make_events([(1, 0, PAGE, 0, 10.0), (1, 1, DOWN), (2, 0, PAGE)]))
    assert rows_of(ordered.last_event_by_ordering(kept)) == [
        ("arrival", PAGE, 2), ("serial", DOWN, 1), ("serial", PAGE, 1)]


def test_measures_of_no_events(make_events):
    events = make_events([])
    kept = ordered.received_serials(events)
    assert rows_of(ordered.gap_runs(events)) == []
    assert rows_of(ordered.ordering_violations(kept)) == [(0, 0, 0)]
    assert rows_of(ordered.max_offset_ties(kept)) == [(0, 0)]
    assert rows_of(ordered.last_event_disagreements(kept)) == [(0,)]


def test_every_gap_length_within_and_across_blocks(spark):
    # Sequence n receives serials 0 and n + 1, so its only gap is n long.
    events = spark.range(1, 200).select(
        F.col("id").alias("sequence_id"), F.explode(F.array(F.lit(0).cast("bigint"), F.col("id") + 1)).alias("serial_id"))
    assert rows_of(ordered.gap_runs(events, 1)) == [(n, 1) for n in range(1, 200)]
