"""The data profile of the feed: every measure as a named, lazy, tidy frame."""

from contextlib import ExitStack
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwatch.operators import profile as measures
from gapwatch.operators import registry as keys
from gapwatch.operators import serials as ordered
from gapwatch.operators.summary import sequence_facts, summary_of
from gapwatch.plans.run import keep
from gapwatch.plans.session import use_utc
from gapwatch.sinks import write_json
from gapwatch.sources import feed

# Fixed by the feed: files with a boolean field, and the file whose first event carries a size.
BOOLEAN_FIELDS = (("box-create", "checkVisibility"), ("box-change", "visibility"), ("mouse-down", "activeElement"))
SIZE_FILE, SIZE_FIELD = "page-change", "clientSize"


def _tagged_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [frame.select(F.lit(name).alias(tag), "*") for name, frame in frames.items()])


def file_measures(files: dict[str, DataFrame], until: ExitStack) -> dict[str, DataFrame]:
    """Measures of the raw files, which carry the payload fields."""
    # A few rows per file, kept: all counts of its fields come from one parse of it.
    values = {name: {"value": F.col(field)} for name, field in BOOLEAN_FIELDS}
    values[SIZE_FILE] = {"serial_0": F.col("serialId") == 0, "has_client_size": F.col(SIZE_FIELD).isNotNull()}
    counts = {name: keep(measures.field_counts(frame, values.get(name)), until) for name, frame in files.items()}
    fields = _tagged_union({name: measures.absent_fields(counts[name], frame.schema) for name, frame in files.items()}, "file")
    event_files = {name: frame for name, frame in files.items() if name != feed.REGISTRY_FILE}
    duplicates = {
        name: measures.duplicate_profile(
            frame.select(
                F.col("navigation").alias("sequence_id"), F.col("serialId").alias("serial_id"),
                feed.parse_utc("eventTime").alias("arrival"),
                *[c for c in frame.columns if c not in ("navigation", "serialId", "eventTime")],
            ),
            payload=[c for c in frame.columns if c not in ("navigation", "serialId", "eventTime")],
        )
        for name, frame in event_files.items()
    }
    booleans = {f"{name}.{field}": measures.value_counts(counts[name], "value") for name, field in BOOLEAN_FIELDS}
    return {
        "file_rows": fields.groupBy("file").agg(F.max("rows").alias("rows")),
        "absent_fields": fields.filter("absent > 0"),
        "duplicates_within_file": _tagged_union(duplicates, "file"),
        "boolean_values": _tagged_union(booleans, "field"),
        "page_change_size_fields": measures.value_counts(counts[SIZE_FILE], "serial_0", "has_client_size"),
    }


def event_measures(events: DataFrame, registry: DataFrame, serials: DataFrame, facts: DataFrame) -> dict[str, DataFrame]:
    """Measures of the canonical frames. ``serials`` and ``facts`` derive from ``events``."""
    summary = summary_of(facts, registry)
    ranges = {
        "registry": measures.time_range(registry, "registered_at"),
        "events": measures.time_range(events, "arrival"),
    }
    return {
        "time_range": _tagged_union(ranges, "frame"),
        "registry_rows_per_5_minutes": measures.tumbling_counts(registry, "registered_at"),
        "segments": measures.grouped_counts(registry, "segment"),
        "offset_range": measures.offset_range(events),
        "key_coverage": keys.key_coverage(events, registry),
        "first_serial_distribution": measures.first_serial_distribution(events),
        "first_serial_above_9": measures.first_serial_above(events),
        "types_at_serial_zero": measures.types_at_serial_zero(events),
        "ordering_violations": ordered.ordering_violations(serials),
        "gap_runs": ordered.gap_runs(events),
        "last_event_by_ordering": ordered.last_event_by_ordering(serials),
        "last_event_disagreements": ordered.last_event_disagreements(serials),
        "max_offset_ties": ordered.max_offset_ties(serials),
        "window_boundary": measures.window_boundary(summary),
        "start_bound_quantiles": measures.start_bound_quantiles(facts, registry),
        "final_window_arrivals": measures.final_window_arrivals(events),
    }


def profile(spark: SparkSession, data_dir: str, out_dir: str) -> None:
    """Write every measure of the feed below ``out_dir``, one directory of JSON lines each."""
    use_utc(spark)
    files = {name: feed.read_file(spark, data_dir, name) for name in (feed.REGISTRY_FILE, *feed.EVENT_TYPES)}
    with ExitStack() as until:
        events = keep(feed.load_received(spark, data_dir), until)
        serials = keep(ordered.received_serials(events), until)
        facts = keep(sequence_facts(events), until)
        registry = feed.load_registry(spark, data_dir)
        found = {**file_measures(files, until), **event_measures(events, registry, serials, facts)}
        for name, measure in found.items():
            write_json(measure, f"{out_dir.rstrip('/')}/{name}")
