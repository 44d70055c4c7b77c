"""Definitions of the per-sequence summary and the results read off it."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import CHANGE, CREATE, DOWN, EVENTS, HOUR, PAGE, by_sequence, rows_of
from pyspark.sql import functions as F

from gapwatch.operators import results
from gapwatch.operators.frequency import event_type_frequency, types_from_blocks, types_per_sequence
from gapwatch.operators.serials import received_serials
from gapwatch.operators.summary import (
    SUMMARY_COLUMNS, sequence_facts, sequence_summary, typed_blocks,
)


@pytest.fixture
def summarise(make_registry):
    def build(events, registry_rows=(), **options):
        return sequence_summary(events, make_registry(registry_rows), **options)

    return build


def test_serials_across_many_blocks(spark, summarise):
    # 0..999 without 63, 64 and 500..699: holes at a block edge and over whole blocks.
    serials = spark.range(1000).filter("id NOT IN (63, 64) AND NOT id BETWEEN 500 AND 699")
    events = serials.select(
        F.lit(7).cast("bigint").alias("sequence_id"), F.col("id").alias("serial_id"), F.lit(0).cast("bigint").alias("offset_ms"),
        F.lit(HOUR).alias("arrival"), F.lit(PAGE).alias("event_type"))
    row = summarise(events.union(events.filter("serial_id % 3 = 0"))).first()
    assert (row["received_events"], row["missing_inner"], row["duplicate_events"]) == (798, 202, events.filter("serial_id % 3 = 0").count())


def test_conflicting_copies_the_smallest_arrival_then_type_wins(spark, summarise):
    rows = [
        (1, 0, 0, HOUR + timedelta(seconds=9), CREATE), (1, 0, 0, HOUR + timedelta(seconds=1), PAGE),
        (1, 4, 0, HOUR + timedelta(seconds=5), PAGE), (1, 4, 0, HOUR + timedelta(seconds=5), DOWN),
    ]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, EVENTS)
        row = summarise(frame).first()
        assert (row["first_event_type"], row["last_event_type"]) == (PAGE, DOWN)
        assert rows_of(received_serials(frame).orderBy("serial_id"), "serial_id", "event_type") == [(0, PAGE), (4, DOWN)]


def test_empty_events_give_empty_results(make_events, summarise):
    summary = summarise(make_events([]))
    frequency = event_type_frequency(types_per_sequence(received_serials(make_events([]))))
    assert summary.count() == 0 and frequency.count() == 0
    numbers = results.run_summary(summary, frequency, "all").first()
    assert (numbers["sequences"], numbers["lost_events"], numbers["max_lost_in_one_sequence"]) == (0, 0, 0)
    assert (numbers["most_common_last_event_type"], numbers["most_frequent_event_type"]) == ([], [])
    assert results.complete_share(summary).first()["complete_share"] == 0.0
    assert results.lost_buckets(summary).agg(F.sum("sequences")).first()[0] == 0


def test_types_from_blocks_agree_with_counting_serials(spark):
    # Types decided by the serial, arrivals and repeats scattered: no conflicting copies.
    base = spark.range(4000).select(
        (F.col("id") % 13).alias("sequence_id"), (F.pmod(F.xxhash64("id"), F.lit(300))).alias("serial_id"))
    events = base.select(
        "sequence_id", "serial_id", (F.col("serial_id") * 10).alias("offset_ms"),
        F.timestamp_micros(F.pmod(F.xxhash64("serial_id", "sequence_id"), F.lit(10**12))).alias("arrival"),
        F.get(F.array(F.lit(PAGE), F.lit(CREATE), F.lit(CHANGE)), F.col("serial_id") % 3).alias("event_type"))
    typed = typed_blocks(events)
    assert sequence_facts(events).agg(F.sum("conflicting_serials")).first()[0] == 0
    counted = types_per_sequence(received_serials(events))
    assert sorted(map(repr, types_from_blocks(typed).collect())) == sorted(map(repr, counted.collect()))


@pytest.mark.parametrize("year", [1, 1969, 1970, 2022, 4200, 4254, 5000, 9999])
def test_copies_are_ordered_by_arrival_in_any_year(spark, summarise, year):
    at = datetime(year, 6, 1, tzinfo=timezone.utc)
    rows = [(1, s, 0, at + timedelta(microseconds=us), kind) for s in (0, 63, 64, 130) for us, kind in ((1, DOWN), (2, CREATE))]
    row = summarise(spark.createDataFrame(rows, EVENTS)).first()
    assert (row["first_event_type"], row["last_event_type"]) == (DOWN, DOWN)
    assert (row["first_serial_id"], row["last_serial_id"], row["received_events"]) == (0, 130, 4)


def test_a_null_arrival_is_the_earliest_copy_on_both_paths(spark):
    rows = [(1, 0, 0, HOUR, DOWN), (1, 0, 0, None, PAGE), (1, 70, 0, None, CREATE), (1, 70, 0, HOUR, CHANGE)]
    frame = spark.createDataFrame(rows, EVENTS)
    facts = sequence_facts(frame).first()
    kept = dict(rows_of(received_serials(frame), "serial_id", "event_type"))
    assert (facts["first_event_type"], facts["last_event_type"]) == (kept[0], kept[70]) == (PAGE, CREATE)


def _random_events(seed):
    """Rows of twelve sequences over two hours, with holes, copies of one type, and arrivals that vary."""
    dice = random.Random(seed)
    kinds = {}
    return [
        (n, serial, serial * 700, HOUR + timedelta(minutes=dice.randrange(120), seconds=n),
         kinds.setdefault((n, serial), dice.choice([PAGE, CREATE, CHANGE, DOWN])))
        for n in range(12) for serial in (dice.randrange(3 + 9 * n) for _ in range(dice.randrange(1, 40)))]


@pytest.mark.parametrize("seed", [3, 8])
def test_results_against_plain_loops(spark, make_registry, seed):
    rows = _random_events(seed)
    segments = {n: ("a", "b")[n % 2] for n in range(9)}
    events, registry = spark.createDataFrame(rows, EVENTS), make_registry(list(segments.items()))
    for segment in ("all", "a"):
        own = [r for r in rows if segment == "all" or segments.get(r[0]) == segment]
        opens = min(r[3] for r in own).replace(minute=0, second=0)
        facts = {}
        for n, serial, offset, arrival, kind in own:
            f = facts.setdefault(n, {"kinds": {}, "rows": 0, "start": arrival})
            f["kinds"][serial] = kind
            f["rows"] += 1
            f["start"] = min(f["start"], arrival - timedelta(milliseconds=offset))
        summary = sequence_summary(events, registry, segment, ("a", "b"))
        assert summary.columns == list(SUMMARY_COLUMNS)
        found = by_sequence(summary)
        assert set(found) == set(facts)
        lost = {n: max(f["kinds"]) + 1 - len(f["kinds"]) for n, f in facts.items()}
        for n, f in facts.items():
            row, first, last = found[n], min(f["kinds"]), max(f["kinds"])
            assert (row["missing_prefix"], row["missing_inner"], row["lost_events"]) == (first, lost[n] - first, lost[n])
            assert row["duplicate_events"] == f["rows"] - len(f["kinds"])
            assert (row["first_event_type"], row["last_event_type"]) == (f["kinds"][first], f["kinds"][last])
            assert row["started_before_window"] == (f["start"] < opens)
            assert (row["segment"], row["has_registry"]) == (segments.get(n, "unknown"), n in segments)
        assert [r[0] for r in rows_of(results.incomplete_sequences(summary), "sequence_id")] == sorted(n for n in lost if lost[n])
        assert [r[0] for r in rows_of(results.not_from_zero(summary), "sequence_id")] == sorted(
            n for n, f in facts.items() if min(f["kinds"]) > 0)
        histogram = [(k, list(lost.values()).count(k)) for k in sorted(set(lost.values()))]
        assert rows_of(results.lost_histogram(summary), "lost_events", "sequences") == histogram
        starts = [start for start, _ in results.LOSS_BUCKETS]
        for position, _, sequences, flagged, unproven in rows_of(results.lost_buckets(summary)):
            end = starts[position] if position < len(starts) else float("inf")
            inside = [n for n in lost if starts[position - 1] <= lost[n] < end]
            assert (sequences, flagged) == (len(inside), sum(found[n]["started_before_window"] for n in inside))
            assert unproven == sequences - flagged
        lasts = [f["kinds"][max(f["kinds"])] for f in facts.values()]
        for kind, sequences, share, rank in rows_of(results.last_event_types(summary)):
            assert (sequences, share) == (lasts.count(kind), round(lasts.count(kind) / len(lasts), 4))
            assert rank == 1 + sum(lasts.count(other) > sequences for other in set(lasts))
        per_sequence = [list(f["kinds"].values()) for f in facts.values()]
        counted = types_per_sequence(received_serials(events))
        total = sum(map(len, per_sequence))
        for kind, n, having, leading, share, rank in rows_of(event_type_frequency(counted, registry, segment, ("a", "b"))):
            assert n == sum(k.count(kind) for k in per_sequence) and share == round(n / total, 4)
            assert having == sum(kind in k for k in per_sequence)
            assert leading == sum(kind in k and k.count(kind) == max(map(k.count, k)) for k in per_sequence)


def test_summary_against_brute_force(spark, summarise):
    dice = random.Random(5)
    rows = [
        (dice.randrange(20), dice.choice([0, 1, 2, 62, 63, 64, 65, 127, 128, 1000]), 0,
         HOUR + timedelta(seconds=dice.randrange(5)), dice.choice([PAGE, CREATE, CHANGE, DOWN]))
        for _ in range(800)]
    found = by_sequence(summarise(spark.createDataFrame(rows, EVENTS)))
    for sequence, row in found.items():
        own = sorted((serial, arrival, kind) for s, serial, _, arrival, kind in rows if s == sequence)
        serials = sorted({serial for serial, *_ in own})
        last = min((arrival, kind) for serial, arrival, kind in own if serial == serials[-1])
        assert (row["first_serial_id"], row["last_serial_id"]) == (serials[0], serials[-1])
        assert (row["received_events"], row["duplicate_events"]) == (len(serials), len(own) - len(serials))
        assert row["lost_events"] == serials[-1] + 1 - len(serials)
        assert (row["first_event_type"], row["last_event_type"]) == (own[0][2], last[1])


def test_typed_blocks_report_conflicting_copies(make_events):
    events = make_events([(1, 0, PAGE), (1, 0, DOWN), (1, 0, CREATE), (1, 1, PAGE), (1, 1, PAGE), (2, 0, PAGE)])
    conflicts = by_sequence(sequence_facts(events))
    assert {key: row["conflicting_serials"] for key, row in conflicts.items()} == {1: 2, 2: 0}
