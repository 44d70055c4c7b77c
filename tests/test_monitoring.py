"""Measures per window: definitions by hand, plain loops, and sketches against exact values."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import DOWN, EVENTS, HOUR, PAGE, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gapwatch.monitoring import coverage, drift, expected, gaps, timing, traffic, windows
from gapwatch.operators.summary import sequence_facts


def _at(spark, rows):
    """Events from ``(sequence, serial, minutes after the hour)``."""
    return spark.createDataFrame([(s, n, n * 1000, HOUR + timedelta(minutes=m), PAGE) for s, n, m in rows], EVENTS)


def _scattered(spark, seed, n=400):
    """Sequences with holes and copies, serials up to 300, over six hours."""
    draw = random.Random(seed)
    return _at(spark, [(draw.randrange(5), int(300 * draw.random() ** 2), draw.random() * 360) for _ in range(n)])


def _hour(n):
    return (HOUR + timedelta(hours=n)).replace(tzinfo=None)


def _completeness(events, **options):
    found = windows.boundary_completeness(windows.window_blocks(events), **options)
    return {(row["window_start"], row["sequence_id"]): row for row in found.withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")).collect()}


def test_a_complete_sequence_over_a_boundary_loses_nothing(spark):
    # 20 events over two hours; serial 8 arrives among those of the second hour, 12 among those of the first.
    minutes = {n: n * 6 for n in range(20)} | {8: 75, 12: 40}
    found = _completeness(_at(spark, [(1, n, m) for n, m in minutes.items()]))
    assert {key: (row["lost_events"], row["unseen_prefix"]) for key, row in found.items()} == {
        (_hour(0), 1): (0, 0), (_hour(1), 1): (0, 0)}
    # The summary of the second hour alone takes everything before for lost.
    later = sequence_facts(_at(spark, [(1, n, m) for n, m in minutes.items() if m >= 60]))
    assert later.first()["lost_events"] == 8 + 2  # 0 to 7, 9 and 12


def test_a_serial_lost_between_two_hours_is_counted_once(spark):
    events = _at(spark, [(1, n, 50 if n < 5 else 70) for n in range(10) if n != 5] + [(2, 7, 130), (2, 9, 131)])
    found = _completeness(events)
    assert found[_hour(0), 1]["lost_events"] == 0
    assert found[_hour(1), 1]["lost_events"] == 1
    assert (found[_hour(2), 2]["lost_events"], found[_hour(2), 2]["unseen_prefix"]) == (1, 7)


def test_completeness_folds_the_events_once_and_joins_nothing(spark, capsys):
    events = _at(spark, [(1, 0, 10), (None, 0, 50), (3, 0, 58)])
    found = windows.boundary_completeness(windows.window_blocks(events), as_of=windows.latest_arrival(events))
    assert [r["sequence_id"] for r in found.orderBy("sequence_id").collect()] == [1, 3]
    found.explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_judged_once_the_last_event_is_old_enough(spark):
    events = _at(spark, [(1, 0, 10), (2, 0, 55), (3, 0, 58)])
    found = _completeness(events, lateness="3 minutes")
    assert [found[_hour(0), s]["judged"] for s in (1, 2, 3)] == [True, True, False]


@pytest.mark.parametrize("seed", range(3))
def test_completeness_from_merged_windows(spark, seed):
    events = _scattered(spark, seed)
    halves = windows.window_blocks(events, "30 minutes")
    merged = windows.boundary_completeness(windows.merge_windows(halves, "1 hour"))
    direct = windows.boundary_completeness(windows.window_blocks(events))
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, direct.collect()))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("stretch_bits", [1, 18])
def test_gap_edges_agree_with_sorting(spark, seed, stretch_bits):
    events = _scattered(spark, seed, 150).unionByName(_at(spark, [(9, n, 1) for n in (0, 63, 64, 127, 500, 100_000)]))
    serials = {}
    for sequence, serial in rows_of(events, "sequence_id", "serial_id"):
        serials.setdefault(sequence, set()).add(serial)
    expected_edges = [
        (s, a, b) for s, known in serials.items() for a, b in zip(sorted(known), sorted(known)[1:]) if b > a + 1]
    assert sorted(rows_of(gaps.gap_edges(events, stretch_bits))) == sorted(expected_edges)


@pytest.mark.parametrize("seed", range(3))
def test_losses_by_hour_add_up_to_all_inner_gaps(spark, make_registry, seed):
    events = _scattered(spark, seed)
    registry = make_registry([(1, "phone"), (2, "desktop"), (3, "phone")])
    found = gaps.gap_rate(events, registry)
    assert found.agg(F.sum("absent_events")).first()[0] == sequence_facts(events).agg(F.sum("missing_inner")).first()[0]
    assert found.agg(F.sum("received_rows")).first()[0] == events.count()


def test_a_gap_is_spread_between_its_neighbours(spark):
    # Four absent serials between 13:30 and 15:30: thought to be at 13:54, 14:18, 14:42 and 15:06.
    events = _at(spark, [(1, 0, 30), (1, 5, 150)])
    found = gaps.gaps_by_window(gaps.dated_gaps(events, gaps.gap_edges(events)))
    assert sorted(rows_of(found.select(F.col("window_start").cast("timestamp_ntz"), "absent_events"))) == [
        (_hour(0), 1), (_hour(1), 2), (_hour(2), 1)]


@pytest.mark.parametrize("seed", range(3))
def test_copies_add_up_to_the_duplicates(spark, make_registry, seed):
    events = _scattered(spark, seed)
    events = events.unionByName(events.limit(50))  # copies of equal arrival
    found = gaps.copy_delays(events, make_registry([(1, "phone")]))
    assert found.agg(F.sum("copies")).first()[0] == sequence_facts(events).agg(F.sum("duplicate_events")).first()[0]
    delays = {}
    for s, n, at in rows_of(events, "sequence_id", "serial_id", "arrival"):
        delays.setdefault((s, n), []).append(at)
    wanted = {}
    for times in delays.values():
        for at in sorted(times)[1:]:
            ms = (at - min(times)) // timedelta(milliseconds=1)
            bucket = 1 << (ms.bit_length() - 1) if ms else 0
            wanted[bucket] = wanted.get(bucket, 0) + 1
    assert dict(rows_of(found.groupBy("delay_ms_from").agg(F.sum("copies")))) == wanted


def test_residual_sketches_merge_within_their_error(spark):
    draw = random.Random(5)
    residuals = spark.createDataFrame(
        [(HOUR + timedelta(minutes=draw.randrange(600)), draw.choice("ab"), int(draw.gauss(0, 1e6))) for _ in range(20_000)],
        "at timestamp, segment string, residual_us bigint")
    hourly = residuals.select(windows.window_start("1 hour", "at").alias("window_start"), "segment", "residual_us")
    daily = residuals.select(windows.window_start("1 day", "at").alias("window_start"), "segment", "residual_us")
    sketched = timing.sketched_quantiles(timing.merge_sketches(timing.residual_sketches(hourly), "1 day"))
    values = {}
    for start, segment, value in rows_of(daily):
        values.setdefault((start, segment), []).append(value)
    for row in sketched.collect():
        known = values[row["window_start"], row["segment"]]
        share = sum(v <= row["residual_us"] for v in known) / len(known)
        assert row["n"] == len(known) and abs(share - row["percent"] / 100) < 0.01
    for row in timing.exact_residuals(daily).collect():
        known = sorted(values[row["window_start"], row["segment"]])
        assert row["residual_us"] == known[(row["percent"] * len(known) + 99) // 100 - 1]


def test_sketched_coverage_is_near_the_exact_one(spark):
    n = 60_000
    events = spark.range(n).select(
        F.col("id").alias("sequence_id"), (F.lit(HOUR) + F.make_dt_interval(mins=(F.col("id") % 180).cast("int"))).alias("arrival"))
    registry = spark.range(n).filter("id % 5 > 0").unionByName(spark.range(n, n + 9000)).select(
        F.col("id").alias("sequence_id"), (F.lit(HOUR) + F.make_dt_interval(mins=(F.col("id") % 120).cast("int"))).alias("registered_at"))
    exact = {row["window_start"]: row for row in coverage.coverage_by_window(events, registry).collect()}
    half_hours = [coverage.key_sketches(events, "arrival", "30 minutes"), coverage.key_sketches(registry, "registered_at", "30 minutes")]
    found = coverage.sketched_coverage(*(coverage.merge_key_sketches(side, "1 hour") for side in half_hours)).collect()
    assert {row["window_start"] for row in found} == set(exact)
    for row in found:
        for name in ("with_events", "without_registry", "registered", "without_events"):
            # 4096 keys a sketch: a standard error of 1.6 % of the larger set
            assert abs(row[name] - exact[row["window_start"]][name]) <= 0.06 * n


def test_few_keys_are_covered_exactly(spark, make_registry):
    events = _at(spark, [(1, 0, 1), (1, 1, 2), (2, 0, 3), (3, 0, 61), (1, 2, 70)])
    registry = make_registry([(1, "phone"), (7, "phone")]).withColumn("registered_at", F.lit(HOUR))
    found = {row["window_start"]: row.asDict() for row in coverage.coverage_by_window(events, registry).collect()}
    first, second = (found[min(found) + timedelta(hours=n)] for n in (0, 1))
    assert (first["with_events"], first["without_registry"], first["registered"], first["without_events"]) == (2, 1, 2, 1)
    assert (second["with_events"], second["without_registry"], second["registered"], second["share_without_events"]) == (2, 1, 0, None)


def test_drift_of_nested_fields(spark):
    lines = ['{"a": 1, "b": {"c": 2.5, "d": [1]}}', '{"a": "x", "b": {"c": 3}}', '{"a": null, "e": true}', "[1]", "{", None]
    records = spark.createDataFrame([(line,) for line in lines], "line string")
    found = drift.field_drift(records, "line", StructType.fromDDL("a BIGINT, b STRUCT<c: DOUBLE, z: STRING>, f BOOLEAN"))
    assert sorted(rows_of(found, "path", "kind", "rows", "status"), key=repr) == sorted([
        ("a", "integer", 1, "declared"), ("a", "text", 1, "retyped"), ("a", "null", 1, "null"), ("b", "object", 2, "declared"),
        ("b.c", "number", 1, "declared"), ("b.c", "integer", 1, "declared"), ("b.d", "array", 1, "new"), ("b.z", None, 0, "vanished"),
        ("e", "boolean", 1, "new"), ("f", None, 0, "vanished"), (None, "broken", 1, "broken")], key=repr)


def test_tails_are_a_class_of_their_own(spark):
    events = _at(spark, [(1, n, n) for n in (0, 1, 3)] + [(2, n, n) for n in range(100)] + [(3, 2, 0)] + [(4, 0, 0)])
    announced = spark.createDataFrame([(1, 6), (2, 90), (3, 2), (5, 3), (6, 0)], "sequence_id bigint, expected_events bigint")
    found = {row["sequence_id"]: tuple(row)[1:] for row in expected.reconcile(events, announced).collect()}
    # expected, received, prefix, inner, tail, beyond
    assert found == {
        1: (6, 3, 0, 1, 2, 0, "lossy"), 2: (90, 100, 0, 0, 0, 10, "complete"), 3: (2, 1, 2, 0, 0, 1, "lossy"),
        4: (None, 1, None, None, None, None, "unannounced"), 5: (3, 0, 0, 0, 3, 0, "unseen"), 6: (0, 0, 0, 0, 0, 0, "complete")}


def test_an_hour_out_of_its_usual_range_deviates(spark):
    start = datetime(2031, 9, 1, 9, tzinfo=timezone.utc)
    usual = [(start + timedelta(days=d, hours=h), "phone", 100 + (d * 7) % 5 + 50 * h) for d in range(12) for h in range(2)]
    rows = usual + [(start + timedelta(days=12), "phone", 160), (start + timedelta(days=12, hours=1), "phone", 152)]
    found = traffic.time_of_day_baseline(spark.createDataFrame(rows, "window_start timestamp, segment string, rows bigint"))
    flags = {row["window_start"]: row["deviates"] for row in found.collect()}
    days = sorted(flags)
    assert [flags[at] for at in days[-2:]] == [True, False]
    assert [flags[at] for at in days[:10]] == [None] * 10  # fewer than five earlier days
    assert not any(flags[at] for at in days[10:-2])


def test_events_per_sequence(spark):
    counted = spark.createDataFrame([(s, DOWN, 1 + s % 10) for s in range(100)] + [(1, PAGE, 7)], "sequence_id bigint, event_type string, events bigint")
    assert sorted(rows_of(traffic.events_per_sequence(counted))) == [
        (DOWN, 50, 5, 100), (DOWN, 95, 10, 100), (DOWN, 99, 10, 100), (PAGE, 50, 7, 1), (PAGE, 95, 7, 1), (PAGE, 99, 7, 1)]
