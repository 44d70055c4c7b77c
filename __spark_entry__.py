
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import oracle_monitoring
import oracle_queries
from gapwatch.functions.payload import payload_json
from gapwatch.monitoring import coverage, drift, expected, gaps, timing, traffic, windows
from gapwatch.operators import frequency, profile, registry, results, serials, summary, validate
from gapwatch.plans.session import use_utc
from gapwatch.sources import feed
from gapwatch.sources import sample_tables as tables
from gapwatch.streaming import hourly_summary, merged_blocks

Query = Callable[[SparkSession, str], DataFrame]


def _portable(result: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps and arrays as text, so both engines show the same values."""
    columns = []
    for name, data_type in result.dtypes:
        if data_type == "timestamp":
            columns.append(F.col(name).cast("timestamp_ntz").alias(name))
        elif data_type.startswith("array"):
            columns.append(F.array_join(name, "|").alias(name))
        else:
            columns.append(F.col(name))
    return result.select(*columns)


class _Reading:
    """One way of reading the tables: events, registry and what derives from them."""

    def __init__(self, events, registry_, segments: tuple[str, ...], segment: str):
        self.events, self.registry, self.segments, self.segment = events, registry_, segments, segment

    def summary(self, spark: SparkSession, sf_dir: str, segment: str = "all") -> DataFrame:
        return summary.sequence_summary(
            self.events(spark, sf_dir), self.registry(spark, sf_dir), segment, self.segments
        )

    def serials(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return serials.received_serials(self.events(spark, sf_dir))

    def frequency(self, spark: SparkSession, sf_dir: str, segment: str = "all") -> DataFrame:
        return frequency.event_type_frequency(
            frequency.types_per_sequence(self.serials(spark, sf_dir)),
            self.registry(spark, sf_dir), segment, self.segments,
        )

    def run_summary(self, spark: SparkSession, sf_dir: str, segment: str = "all") -> DataFrame:
        return results.run_summary(
            self.summary(spark, sf_dir, segment), self.frequency(spark, sf_dir, segment), segment
        )

    def typed_blocks(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return summary.typed_blocks(self.events(spark, sf_dir))


_CLICKS = _Reading(tables.clicks, tables.click_registry, tables.CLICK_SEGMENTS, "3")
_LINES = _Reading(tables.lines, tables.line_registry, tables.LINE_SEGMENTS, "2-HIGH")
_COARSE = _Reading(tables.coarse_clicks, tables.click_registry, tables.CLICK_SEGMENTS, "3")
_STABLE = _Reading(tables.stable_clicks, tables.click_registry, tables.CLICK_SEGMENTS, "3")
_TURNS = _Reading(tables.turns, tables.click_registry, (), "all")


def _event_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two sources, whole tables with all their types, as one bag."""
    return feed.union_events({"clicks": tables.clicks(spark, sf_dir), "turns": tables.turns(spark, sf_dir)})


def _broken_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with required fields gone wrong where the data meets a condition."""
    value, kind = F.col("value"), F.col("event_type")
    return tables.read(spark, sf_dir, "events").select(
        F.when((kind == "signup") & (value < 5), None).otherwise(F.col("user_id")).alias("sequence_id"),
        F.when(value < 20, F.regexp_extract("props", "([0-9]+)", 1).cast("bigint") - F.lit(1)).alias("serial_id"),
        F.floor((value - 1) * 1000).alias("offset_ms"),
        F.when(~((kind == "error") & (value < 2)), F.col("ts").cast("timestamp")).alias("arrival"),
        kind,
    )


def _payload_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with a nested and a boolean payload field, present for some types only."""
    value, kind = F.col("value"), F.col("event_type")
    size = F.struct(
        F.floor(value).alias("height"), F.when(value >= 5, F.floor(value * 2)).alias("width")
    )
    return tables.read(spark, sf_dir, "events").select(
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("serial_id"),
        F.when(kind == "view", size).alias("size"),
        F.when(kind == "click", value >= 10).alias("visible"),
    )


def _feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks rendered as records of the feed and read back with its declared schema."""
    events = tables.clicks(spark, sf_dir)
    record = payload_json([
        F.date_format("arrival", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("eventTime"),
        F.col("sequence_id").alias("navigation"),
        F.col("serial_id").alias("serialId"),
        F.col("offset_ms").alias("relativeTimeMs"),
    ])
    parsed = events.select("event_type", F.from_json(record, feed.SHARED_SCHEMA, {"mode": "FAILFAST"}).alias("r"))
    return feed.canonical_events(parsed.select("r.*", "event_type"), F.col("event_type"))


def _window_end() -> Column:
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def _per_reading() -> dict[str, Callable[[_Reading], Query]]:
    """Queries registered for both readings, the second with suffix ``_b``."""
    return {
        "registry_attach": lambda r: lambda s, d: registry.attach_registry_to_events(r.events(s, d), r.registry(s, d)),
        "segment_filtered": lambda r: lambda s, d: registry.filter_segment(
            registry.attach_registry_to_events(r.events(s, d), r.registry(s, d)), r.segment, r.segments),
        "sequence_summary": lambda r: r.summary,
        "sequence_summary_segment": lambda r: lambda s, d: r.summary(s, d, r.segment),
        "incomplete_sequences": lambda r: lambda s, d: results.incomplete_sequences(r.summary(s, d)),
        "not_from_zero": lambda r: lambda s, d: results.not_from_zero(r.summary(s, d)),
        "lost_histogram": lambda r: lambda s, d: results.lost_histogram(r.summary(s, d)),
        "lost_buckets": lambda r: lambda s, d: results.lost_buckets(r.summary(s, d)),
        "complete_share": lambda r: lambda s, d: results.complete_share(r.summary(s, d)),
        "last_event_types": lambda r: lambda s, d: results.last_event_types(r.summary(s, d)),
        "event_type_frequency": lambda r: r.frequency,
        "event_type_frequency_segment": lambda r: lambda s, d: r.frequency(s, d, r.segment),
        "run_summary": lambda r: r.run_summary,
        "run_summary_segment": lambda r: lambda s, d: r.run_summary(s, d, r.segment),
        "time_range": lambda r: lambda s, d: profile.time_range(r.events(s, d), "arrival"),
        "offset_range": lambda r: lambda s, d: profile.offset_range(r.events(s, d)),
        "segment_counts": lambda r: lambda s, d: profile.grouped_counts(r.registry(s, d), "segment"),
        "key_coverage": lambda r: lambda s, d: registry.key_coverage(r.events(s, d), r.registry(s, d)),
        "sequences_without_registry": lambda r: lambda s, d: registry.sequences_without_registry(
            r.events(s, d), r.registry(s, d)),
        "registry_without_events": lambda r: lambda s, d: registry.registry_without_events(
            r.events(s, d), r.registry(s, d)),
        "first_serial_distribution": lambda r: lambda s, d: profile.first_serial_distribution(r.events(s, d)),
        "first_serial_above_nine": lambda r: lambda s, d: profile.first_serial_above(r.events(s, d), 9),
        "types_at_serial_zero": lambda r: lambda s, d: profile.types_at_serial_zero(r.events(s, d)),
        "ordering_violations": lambda r: lambda s, d: serials.ordering_violations(r.serials(s, d)),
        "gap_runs": lambda r: lambda s, d: serials.gap_runs(r.events(s, d)),
        "last_event_by_ordering": lambda r: lambda s, d: serials.last_event_by_ordering(r.serials(s, d)),
        "last_event_disagreements": lambda r: lambda s, d: serials.last_event_disagreements(r.serials(s, d)),
        "window_boundary": lambda r: lambda s, d: profile.window_boundary(r.summary(s, d)),
    }


def _single() -> dict[str, Query]:
    """Queries that one reading has data for, or that differ between the readings."""
    return {
        "event_union": _event_union,
        "feed_records": _feed_records,
        "required_field_violations": lambda s, d: validate.violations(_broken_events(s, d)),
        "sequence_summary_control": _TURNS.summary,
        "sequence_summary_stable": _STABLE.summary,
        "frequency_from_blocks": lambda s, d: frequency.event_type_frequency(
            frequency.types_from_blocks(_STABLE.typed_blocks(s, d))),
        "hourly_summary": lambda s, d: hourly_summary(_CLICKS.events(s, d), _CLICKS.registry(s, d)),
        "conflicting_serials": lambda s, d: summary.sequence_facts(_CLICKS.events(s, d)).select(
            "sequence_id", "conflicting_serials"),
        "null_profile": lambda s, d: profile.null_profile(_payload_events(s, d)),
        "boolean_values": lambda s, d: profile.grouped_counts(_payload_events(s, d), "visible"),
        "size_fields": lambda s, d: profile.grouped_counts(
            _payload_events(s, d).select(
                (F.col("serial_id") == 0).alias("serial_0"), F.col("size").isNotNull().alias("has_size")),
            "serial_0", "has_size"),
        "duplicate_profile": lambda s, d: profile.duplicate_profile(_CLICKS.events(s, d), ["event_type", "offset_ms"]),
        "duplicate_profile_b": lambda s, d: profile.duplicate_profile(
            _LINES.events(s, d), [payload_json(["event_type", "offset_ms"])]),
        "registry_time_range_b": lambda s, d: profile.time_range(_LINES.registry(s, d), "registered_at"),
        "max_offset_ties": lambda s, d: serials.max_offset_ties(_COARSE.serials(s, d)),
        "max_offset_ties_b": lambda s, d: serials.max_offset_ties(_LINES.serials(s, d)),
        "start_bound_quantiles": lambda s, d: profile.start_bound_quantiles(
            summary.sequence_facts(_LINES.events(s, d)), _LINES.registry(s, d), exact=True
        ).withColumn("lead_ms", F.round("lead_ms", 3)),
        "final_window_arrivals": lambda s, d: profile.final_window_arrivals(_CLICKS.events(s, d), _window_end(), "1 day"),
        "final_window_arrivals_b": lambda s, d: profile.final_window_arrivals(_LINES.events(s, d)),
        "tumbling_counts": lambda s, d: profile.tumbling_counts(_CLICKS.events(s, d), "arrival"),
    }


def _raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as JSON text of a producer that has moved on: a retyped, a nested, a new and a broken part."""
    serial, kind, value = F.regexp_extract("props", "([0-9]+)", 1), F.col("event_type"), F.col("value")
    text = lambda c: c.cast("string")
    where = lambda condition, then: F.when(condition, then).otherwise("")
    nested = F.concat(F.lit(', "at": {"x": '), text(F.col("event_id") % 7), where(value > 10, F.lit(', "z": true')), F.lit("}"))
    record = F.concat(
        F.lit('{"k": '), F.when(kind == "error", F.concat(F.lit('"'), serial, F.lit('"'))).otherwise(serial), where(kind == "view", nested),
        where(kind == "click", F.lit(', "note": null')), F.lit(', "user": '), text(F.col("user_id")), F.lit("}"))
    broken = (kind == "signup") & (value < 3)
    return tables.read(spark, sf_dir, "events").select(F.when(broken, F.lit('{"k": ')).otherwise(record).alias("record"))


_DECLARED = "k BIGINT, at STRUCT<x: DOUBLE, y: DOUBLE>, note STRING, plan STRING"


def _lossy_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _TURNS.events(spark, sf_dir).filter("sequence_id % 3 > 0 OR serial_id % 3 != 1")


def _announced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A count per conversation by rule: too many, as many as there are, too few; some are missing, some have no event."""
    turns = _TURNS.events(spark, sf_dir)
    more = F.when(F.col("sequence_id") % 4 == 0, 3).when(F.col("sequence_id") % 4 == 2, 0).otherwise(1)
    known = turns.filter("sequence_id % 11 != 5").groupBy("sequence_id").agg(F.max("serial_id").alias("last")).select(
        "sequence_id", (F.col("last") + more).alias("expected_events"))
    absent = turns.filter("sequence_id % 9 = 0").select(F.col("sequence_id") + 1000000, F.lit(2).cast("bigint")).distinct()
    return known.union(absent)


def _merged_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four lots of clicks, folded apart and merged."""
    events, registry_ = _CLICKS.events(spark, sf_dir), _CLICKS.registry(spark, sf_dir)
    lots = [summary.typed_blocks(events.filter(F.pmod(F.xxhash64("arrival", "serial_id"), F.lit(4)) == lot)) for lot in range(4)]
    return summary.summary_of(summary.facts_from_blocks(merged_blocks(reduce(DataFrame.unionByName, lots))), registry_)


def _monitoring() -> dict[str, Query]:
    """Measures per window, on the reading that has data for them."""
    def copies(s, d):
        return gaps.copy_delays(_CLICKS.events(s, d), _CLICKS.registry(s, d), "1 day")

    return {
        "boundary_completeness": lambda s, d: windows.boundary_completeness(
            windows.window_blocks(_CLICKS.events(s, d), "1 day"), "1 day", as_of=windows.latest_arrival(_CLICKS.events(s, d))),
        "boundary_completeness_b": lambda s, d: windows.boundary_completeness(
            windows.window_blocks(_LINES.events(s, d), "7 days"), "7 days", as_of=windows.latest_arrival(_LINES.events(s, d))),
        "gap_rate": lambda s, d: gaps.gap_rate(_CLICKS.events(s, d), _CLICKS.registry(s, d), "1 day"),
        "copy_delays": copies,
        "copy_rate": lambda s, d: gaps.copy_rate(copies(s, d), _CLICKS.events(s, d), _CLICKS.registry(s, d), "1 day"),
        "coverage_by_window_b": lambda s, d: coverage.coverage_by_window(_LINES.events(s, d), _LINES.registry(s, d), "1 day"),
        "timing_residuals_b": lambda s, d: timing.exact_residuals(
            timing.timing_residuals(_LINES.events(s, d), _LINES.registry(s, d), "7 days")),
        "events_per_sequence": lambda s, d: traffic.events_per_sequence(frequency.types_per_sequence(_CLICKS.serials(s, d))),
        "events_per_sequence_b": lambda s, d: traffic.events_per_sequence(frequency.types_per_sequence(_LINES.serials(s, d))),
        "time_of_day_baseline": lambda s, d: traffic.time_of_day_baseline(
            traffic.hourly_traffic(_CLICKS.events(s, d), _CLICKS.registry(s, d))),
        "expected_events": lambda s, d: expected.reconcile(_lossy_turns(s, d), _announced(s, d)),
        "field_drift": lambda s, d: drift.field_drift(_raw_records(s, d), "record", StructType.fromDDL(_DECLARED)),
        "merged_summary": _merged_summary,
    }


#: The operators of training-data pipelines are there only if their folder, and what it needs, is.
try:
    from gapwatch.llm import queries as llm_queries
except ImportError:
    llm_queries = None


def _in_utc(query: Query) -> Query:
    return lambda spark, sf_dir: _portable(query(use_utc(spark), sf_dir))


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {}
    for name, query_of in _per_reading().items():
        registered[name] = query_of(_CLICKS)
        registered[f"{name}_b"] = query_of(_LINES)
    registered.update(_single())
    registered.update(_monitoring())
    registered = {name: _in_utc(query) for name, query in registered.items()}
    if llm_queries:
        registered.update(llm_queries.queries())
    return registered


def oracle_sql() -> dict[str, str]:
    """For each key of ``queries()``, SQL for DuckDB over the same tables."""
    return oracle_queries.all_queries() | oracle_monitoring.all_queries() | (llm_queries.oracle_sql() if llm_queries else {})


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the summary of every sequence in the smallest tables."""
    return queries()["sequence_summary"](spark, "/root/testdata/sf0.001")
