"""Relations that must hold between the results of one run, on the sample tables."""

import os

import pytest
from pyspark.sql import functions as F

from gapwatch.operators import results, serials
from gapwatch.operators.frequency import event_type_frequency, types_per_sequence
from gapwatch.operators.summary import sequence_summary
from gapwatch.sources import sample_tables as tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not there")


@pytest.fixture(params=["clicks", "lines"])
def reading(request, spark):
    events = getattr(tables, request.param)(spark, SF_DIR)
    registry = getattr(tables, f"{request.param[:-1]}_registry")(spark, SF_DIR)
    segments = tables.CLICK_SEGMENTS if request.param == "clicks" else tables.LINE_SEGMENTS
    summary = sequence_summary(events, registry).persist()
    yield events, registry, segments, summary
    summary.unpersist()


def test_results_of_a_run_agree(reading):
    events, _, _, summary = reading
    counted = types_per_sequence(serials.received_serials(events))
    frequency = event_type_frequency(counted)
    numbers = results.run_summary(summary, frequency, "all").first()

    assert results.incomplete_sequences(summary).count() == numbers["incomplete_sequences"]
    assert results.not_from_zero(summary).count() == numbers["not_from_zero"]
    histogram = results.lost_histogram(summary)
    totals = histogram.agg(F.sum(F.col("lost_events") * F.col("sequences")), F.sum("sequences")).first()
    assert tuple(totals) == (numbers["lost_events"], numbers["sequences"])
    assert numbers["lost_in_prefix"] + numbers["lost_in_inner_gaps"] == numbers["lost_events"]
    last = results.last_event_types(summary).agg(F.sum("sequences")).first()[0]
    assert last == numbers["sequences"]
    buckets = results.lost_buckets(summary).agg(F.sum("sequences")).first()[0]
    assert buckets == numbers["incomplete_sequences"]

    received, copies = summary.agg(F.sum("received_events"), F.sum("duplicate_events")).first()
    assert received + copies == events.count()
    assert frequency.agg(F.sum("events")).first()[0] == received
    runs = serials.gap_runs(events).agg(F.sum(F.col("gap_run") * F.col("runs"))).first()[0]
    assert (runs or 0) == numbers["lost_in_inner_gaps"]


def test_segments_are_part_of_all(reading):
    events, registry, segments, summary = reading
    whole = {row["sequence_id"]: row["lost_events"] for row in summary.collect()}
    known = {row["sequence_id"] for row in summary.filter("segment <> 'unknown'").collect()}
    seen = set()
    for segment in segments:
        for row in sequence_summary(events, registry, segment, segments).collect():
            assert row["segment"] == segment and row["lost_events"] == whole[row["sequence_id"]]
            assert row["sequence_id"] not in seen
            seen.add(row["sequence_id"])
    assert seen == known
