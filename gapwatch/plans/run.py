"""The whole run: check the events, derive every result, write them."""

from collections.abc import Mapping
from contextlib import ExitStack

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwatch.names import ALL_SEGMENTS
from gapwatch.operators import results
from gapwatch.operators.frequency import event_type_frequency, types_resolved
from gapwatch.operators.summary import facts_from_blocks, summary_of, typed_blocks
from gapwatch.operators.validate import assert_valid, watch_violations
from gapwatch.plans.session import use_utc
from gapwatch.sinks import WRITERS, write_json
from gapwatch.sources import feed


def keep(frame: DataFrame, until: ExitStack) -> DataFrame:
    """Store ``frame`` when first computed; released when ``until`` closes, on failure too."""
    until.callback(frame.unpersist)
    return frame.persist(StorageLevel.MEMORY_AND_DISK)


def completeness_results(summary: DataFrame, frequency: DataFrame, segment: str) -> dict[str, DataFrame]:
    """All results of one run as lazy frames over one summary and one frequency table."""
    return {
        "incomplete_sequences": results.incomplete_sequences(summary),
        "not_from_zero": results.not_from_zero(summary),
        "lost_histogram": results.lost_histogram(summary),
        "lost_buckets": results.lost_buckets(summary),
        "last_event_types": results.last_event_types(summary),
        "event_type_frequency": frequency,
        "run_summary": results.run_summary(summary, frequency, segment),
    }


def checked_facts(events: DataFrame, until: ExitStack) -> tuple[DataFrame, DataFrame]:
    """Facts per sequence and events per (sequence, type) of events that passed the checks.

    One pass over the source does it: the required-field counts ride along
    while the events fold into typed blocks, and the blocks, not the events,
    are stored. Counting types looks at events again only in the blocks whose
    copies of a serial differ in type.
    """
    watched, watch = watch_violations(events)
    typed = keep(typed_blocks(watched), until)
    facts = keep(facts_from_blocks(typed), until)
    # Without any event nothing was watched, and nothing can be wrong.
    if facts.count() and any(watch.get.values()):
        assert_valid(events)
    return facts, types_resolved(typed, events)


def run(
    events: DataFrame,
    registry: DataFrame,
    out_dir: str,
    segment: str = ALL_SEGMENTS,
    segments: tuple[str, ...] = (),
    file_format: str = "csv",
    column_names: Mapping[str, str] | None = None,
) -> None:
    """Check ``events``, then write one directory per result below ``out_dir``.

    The checks cover all events, before the segment is chosen: a row that lost
    its key has no segment. ``column_names`` renames result columns on the way out.
    """
    with ExitStack() as until:
        facts, counted = checked_facts(events, until)
        summary = keep(summary_of(facts, registry, segment, segments), until)
        frequency = keep(event_type_frequency(counted, registry, segment, segments), until)
        for name, result in completeness_results(summary, frequency, segment).items():
            write = write_json if name == "run_summary" else WRITERS[file_format]
            write(result.withColumnsRenamed(dict(column_names or {})), f"{out_dir.rstrip('/')}/{name}")


def run_feed(
    spark: SparkSession, data_dir: str, out_dir: str, segment: str = ALL_SEGMENTS, quarantine: bool = False, **options
) -> None:
    """``run`` over the feed's files.

    With ``quarantine`` records that don't read as declared do not fail the run:
    they are written to ``quarantine``, their number by file to ``quarantine_counts``.
    """
    use_utc(spark)
    if quarantine:
        events, registry, bad = feed.load_apart(spark, data_dir)
        write_json(bad, f"{out_dir.rstrip('/')}/quarantine")
        write_json(bad.groupBy("file", "kind").agg(F.count("record").alias("records")), f"{out_dir.rstrip('/')}/quarantine_counts")
    else:
        events, registry = feed.load_received(spark, data_dir), feed.load_registry(spark, data_dir)
    run(events, registry, out_dir, segment=segment, segments=feed.SEGMENTS, **options)
