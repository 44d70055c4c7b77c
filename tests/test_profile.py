"""Data-profile measures and the expressions below them."""

from datetime import timedelta

import pytest
from conftest import CHANGE, CREATE, DOWN, EVENTS, HOUR, PAGE, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwatch.functions import exact_quantiles, leaf_fields, payload_json, quantiles
from gapwatch.operators import profile as measures
from gapwatch.operators.summary import sequence_facts


def test_leaf_fields_of_nested_structs(spark):
    schema = T.StructType.fromDDL("a BIGINT, b STRUCT<x: DOUBLE, y: STRUCT<z: STRING>>, c ARRAY<STRING>")
    assert leaf_fields(schema) == ["a", "b.x", "b.y.z", "c"]


def test_null_profile_counts_nested_fields(spark):
    frame = spark.createDataFrame([(1, (None, 2.0)), (None, None), (3, (1.0, 1.0))], "a bigint, b struct<x: double, y: double>")
    assert rows_of(measures.null_profile(frame)) == [("a", 3, 1), ("b.x", 3, 2), ("b.y", 3, 1)]
    full = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    assert rows_of(measures.null_profile(full)) == []
    assert rows_of(measures.null_profile(full, only_absent=False)) == [("a", 1, 0), ("b", 1, 0)]


def test_field_counts_hold_what_single_measures_count(spark):
    rows = [(n, None if n % 5 == 0 else n % 3 == 0, None if n % 4 == 0 else (None if n % 7 == 0 else n * 1.0,)) for n in range(60)]
    frame = spark.createDataFrame(rows, "a bigint, flag boolean, b struct<x: double>")
    counts = measures.field_counts(frame, {"value": F.col("flag"), "small": F.col("a") < 9})
    assert counts.count() <= 6
    assert rows_of(measures.absent_fields(counts, frame.schema)) == [
        ("a", 60, 0), ("flag", 60, 12), ("b.x", 60, sum(r[2] is None or r[2][0] is None for r in rows))]
    assert rows_of(measures.value_counts(counts, "value")) == rows_of(measures.grouped_counts(frame.select(F.col("flag").alias("value")), "value"))
    assert rows_of(measures.value_counts(counts, "small")) == [(False, 51), (True, 9)]


def test_field_counts_of_nothing(spark):
    frame = spark.createDataFrame([], "a bigint, flag boolean")
    counts = measures.field_counts(frame, {"value": F.col("flag")})
    assert rows_of(measures.absent_fields(counts, frame.schema)) == [("a", 0, 0), ("flag", 0, 0)]
    assert rows_of(measures.value_counts(counts, "value")) == []


def test_payload_json_leaves_nulls_out(spark):
    frame = spark.createDataFrame([(1, None), (None, "x")], "a bigint, b string")
    assert rows_of(frame.select(payload_json(["a", "b"]))) == [('{"a":1}',), ('{"b":"x"}',)]


@pytest.mark.parametrize("as_json", [False, True])
def test_duplicate_profile(make_events, as_json):
    payload = [payload_json(["event_type", "offset_ms"])] if as_json else ["event_type", "offset_ms"]
    events = make_events([
        (1, 0, PAGE), (1, 1, CHANGE), (1, 1, CHANGE, 1000, 0.5), (1, 1, CHANGE, 1000, 8.0),
        (2, 0, PAGE), (2, 0, DOWN, 0, 2.0), (3, 0, PAGE)])
    assert rows_of(measures.duplicate_profile(events, payload)) == [(2, 2, 2, 2.0, 8.0)]


def test_duplicate_profile_without_duplicates(make_events):
    assert rows_of(measures.duplicate_profile(make_events([(1, 0, PAGE)]), ["event_type"])) == [(0, 0, None, None, None)]


def test_counts_keep_null_as_a_value(spark):
    frame = spark.createDataFrame([(True,), (None,), (True,), (False,)], "flag boolean")
    assert rows_of(measures.grouped_counts(frame, "flag")) == [(None, 1), (False, 1), (True, 2)]


def test_ranges(make_events):
    events = make_events([(1, 0, PAGE, 55), (2, 3, DOWN, 4000)])
    assert rows_of(measures.offset_range(events)) == [(55, 4000)]
    assert rows_of(measures.time_range(events, "arrival")) == [("2031-09-06 13:00:01.055", "2031-09-06 13:00:06")]


def test_tumbling_windows_are_labelled_by_start(spark):
    at = [HOUR + timedelta(minutes=m) for m in (0, 4, 5, 59)] + [HOUR + timedelta(days=1, minutes=1)]
    frame = spark.createDataFrame([(t,) for t in at], "t timestamp")
    assert rows_of(measures.tumbling_counts(frame, "t")) == [("13:00", 3), ("13:05", 1), ("13:55", 1)]


def test_first_serials(make_events):
    events = make_events([(n, serial, PAGE) for n, serial in enumerate([0, 0, 1, 12, 13, 9])] + [(0, 5, DOWN)])
    assert rows_of(measures.first_serial_distribution(events, 3)) == [(0, 2), (1, 1), (9, 1)]
    assert rows_of(measures.first_serial_above(events, 9)) == [(2,)]


def test_types_at_serial_zero_count_rows(make_events):
    events = make_events([(1, 0, PAGE), (1, 0, PAGE, 0, 1.0), (2, 0, CREATE), (2, 1, DOWN)])
    assert rows_of(measures.types_at_serial_zero(events)) == [(CREATE, 1), (PAGE, 2)]


def test_window_boundary(spark):
    summary = spark.createDataFrame(
        [(True, False, 0, 0), (True, False, 0, 2), (False, True, 4, 4)],
        "has_registry boolean, started_before_window boolean, first_serial_id bigint, lost_events bigint")
    assert rows_of(measures.window_boundary(summary)) == [(False, True, False, 1, 4), (True, False, True, 2, 2)]


def test_final_window_arrivals(spark):
    rows = [
        (1, 0, 0, HOUR, PAGE), (1, 1, 0, HOUR + timedelta(minutes=59), DOWN),
        (2, 0, 0, HOUR + timedelta(minutes=58, seconds=59), PAGE),
        (3, 0, 0, HOUR + timedelta(minutes=59, seconds=30), PAGE), (3, 1, 0, HOUR + timedelta(minutes=59, seconds=31), PAGE),
    ]
    events = spark.createDataFrame(rows, EVENTS)
    assert rows_of(measures.final_window_arrivals(events)) == [(2,)]
    assert rows_of(measures.final_window_arrivals(events, F.lit(HOUR + timedelta(minutes=59)), "1 minute")) == [(3,)]


def test_start_bound_quantiles(spark):
    events = spark.createDataFrame([(n, 0, 0, HOUR, PAGE) for n in range(11)], EVENTS)
    registry = spark.createDataFrame(
        [(n, HOUR + timedelta(milliseconds=n * 10)) for n in range(11)], "sequence_id bigint, registered_at timestamp")
    facts = sequence_facts(events)
    exact = rows_of(measures.start_bound_quantiles(facts, registry, (0.0, 0.5, 0.95, 1.0), exact=True))
    assert exact == [(0.0, 0.0), (0.5, 50.0), (0.95, 95.0), (1.0, 100.0)]
    assert rows_of(measures.start_bound_quantiles(facts, registry, (0.5,))) == [(0.5, 50.0)]


@pytest.mark.parametrize("expression", [
    "pmod(xxhash64(id), 1000003) / 7.0",      # spread
    "pmod(id, 3) * 1.0",                       # few values, many copies
    "CASE WHEN id % 3 = 0 THEN 42.0D ELSE id * 1.0D END",  # one value holds a third
    "CASE WHEN id = 5 THEN 1e12D ELSE id * -0.5D END",
])
def test_exact_quantiles_match_percentile(spark, expression):
    values = spark.range(60000).selectExpr(f"CAST({expression} AS DOUBLE) AS x")
    probabilities = [0.0, 0.01, 0.5, 0.77, 0.99, 1.0]
    expected = values.agg(F.percentile("x", probabilities)).first()[0]
    found = [row["value"] for row in exact_quantiles(values, "x", probabilities).collect()]
    assert found == pytest.approx(expected, rel=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20, 101])
def test_exact_quantiles_of_few_values(spark, n):
    values = spark.range(n).selectExpr("CAST(id * id AS DOUBLE) AS x")
    probabilities = [0.05, 0.25, 0.5, 0.9, 0.95]
    expected = values.agg(F.percentile("x", probabilities)).first()[0]
    found = [row["value"] for row in exact_quantiles(values, "x", probabilities).collect()]
    assert found == pytest.approx(expected, rel=1e-12)


def test_exact_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.range(0), "id", [0.5]).collect() == []


def test_no_pass_of_the_quantiles_hands_out_more_than_its_ranges(spark, monkeypatch):
    # A fixed share of the values lies between the sketch's bounds at any size; here a pass yields counts only.
    values = spark.range(200_000).selectExpr("CAST(pmod(xxhash64(id), 1000003) AS DOUBLE) AS x")
    brackets = dict.fromkeys((0, 99_999, 100_000, 199_999), quantiles._Bracket(0.0, 1_000_002.0, 0))
    seen = []
    collect = type(values).collect
    monkeypatch.setattr(type(values), "collect", lambda frame: seen.append(collect(frame)) or seen[-1])
    narrowed = quantiles._narrowed(values.withColumnRenamed("x", "v"), brackets, 50)
    assert len(seen[0]) <= 50 and sum(row["n"] for row in seen[0]) == 200_000
    assert all(b.high - b.low < 1_000_003 / 40 for b in narrowed.values())


def test_a_rank_outside_its_bracket_is_an_error(spark):
    values = spark.range(10).selectExpr("CAST(id AS DOUBLE) AS v")
    with pytest.raises(AssertionError, match="rank 50"):
        quantiles._narrowed(values, {50: quantiles._Bracket(0.0, 9.0, 0)}, 4)


@pytest.mark.parametrize("coarse_bits", [0, 3, 16])
def test_ranked_values_agree_with_sorting(spark, coarse_bits):
    rows = [(key, value * value - 40, 1 + (value * 7) % 5) for key in ("a", "b", None) for value in range(30)]
    counts = spark.createDataFrame(rows, "key string, x bigint, n bigint")
    found = rows_of(quantiles.ranked_values(counts, ("key",), "x", "n", (1, 50, 99, 100), coarse_bits), "key", "percent", "x")
    expected = []
    for key in ("a", "b", None):
        spelled = sorted(x for k, x, n in rows if k == key for _ in range(n))
        expected += [(key, p, spelled[max((p * len(spelled) + 99) // 100, 1) - 1]) for p in (1, 50, 99, 100)]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
