"""The client-event feed: JSON lines, one compressed file per event type plus the registry."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwatch.functions.times import parse_utc
from gapwatch.operators.registry import attach_registry_to_events

# File names and fields of the feed. Declared, never inferred:
# inference costs a pass and takes types from the values it happens to see.
REGISTRY_FILE = "request"
REGISTRY_SCHEMA = "eventTime STRING, hwType STRING, navigation BIGINT"
SHARED_SCHEMA = "eventTime STRING, navigation BIGINT, serialId BIGINT, relativeTimeMs BIGINT"
PAYLOAD_SCHEMAS = {
    "page-change": "clientSize STRUCT<height: BIGINT, width: BIGINT>, "
                   "relativeLayoutSize STRUCT<height: DOUBLE, width: DOUBLE>",
    "box-create": "boxIndex BIGINT, checkVisibility BOOLEAN",
    "box-change": "boxIndex BIGINT, relativePosition STRUCT<x: DOUBLE, y: DOUBLE>, "
                  "relativeSize STRUCT<height: DOUBLE, width: DOUBLE>, visibility BOOLEAN",
    "mouse-down": "boxIndex BIGINT, activeElement BOOLEAN",
}
SEGMENTS = ("phone", "desktop", "tablet")

EVENT_TYPES = tuple(PAYLOAD_SCHEMAS)


def schema_of(name: str) -> str:
    """Declared fields of one file; its payload fields included."""
    return REGISTRY_SCHEMA if name == REGISTRY_FILE else f"{SHARED_SCHEMA}, {PAYLOAD_SCHEMAS[name]}"


def _found(files: DataFrame, data_dir: str, name: str) -> DataFrame:
    # A type without a file would look like a type without events.
    if not files.inputFiles():
        raise FileNotFoundError(f"no file {name}*.json* in {data_dir}")
    return files


def read_file(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """The files ``name*.json*`` below ``data_dir`` as declared, in any codec Spark reads.

    ``data_dir`` may be a glob, and may have folders ``key=value``, which become
    columns. Broken JSON or a value of the wrong type fails the job. A key that is
    missing reads as null; ``validate`` covers the required ones.
    """
    reader = spark.read.schema(schema_of(name)).options(mode="FAILFAST", pathGlobFilter=f"{name}*.json*")
    return _found(reader.json(data_dir), data_dir, name)


def read_apart(spark: SparkSession, data_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: records that read as declared in every field, and the others, as ``file, kind, record``.

    Each record is in one of the two. Lines are parsed as a whole: a JSON scan would
    parse the fields that a query needs, and find other records bad for each query.
    """
    lines = _found(spark.read.options(pathGlobFilter=f"{name}*.json*").text(data_dir), data_dir, name)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record"}
    parsed = lines.filter(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"), "value", F.from_json("value", f"{schema_of(name)}, _record STRING", options).alias("r"))
    is_good = F.col("r").isNotNull() & F.col("r._record").isNull()
    return parsed.filter(is_good).select("r.*", "file").drop("_record"), parsed.filter(~is_good).select(
        "file", F.lit(name).alias("kind"), F.col("value").alias("record"))


def canonical_registry(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("navigation").alias("sequence_id"),
        F.col("hwType").alias("segment"),
        parse_utc("eventTime").alias("registered_at"),
    )


def canonical_events(source: DataFrame, event_type: str | Column) -> DataFrame:
    """The shared columns only, so no payload travels through a shuffle."""
    return source.select(
        F.col("navigation").alias("sequence_id"),
        F.col("serialId").alias("serial_id"),
        F.col("relativeTimeMs").alias("offset_ms"),
        parse_utc("eventTime").alias("arrival"),
        F.lit(event_type).alias("event_type"),
    )


def load_registry(spark: SparkSession, data_dir: str) -> DataFrame:
    return canonical_registry(read_file(spark, data_dir, REGISTRY_FILE))


def union_events(sources: dict[str, DataFrame]) -> DataFrame:
    """One bag of canonical events from a frame per event type."""
    return reduce(DataFrame.unionByName, sources.values())


def load_received(spark: SparkSession, data_dir: str) -> DataFrame:
    """Received events of all event types, without their segment."""
    return union_events({
        name: canonical_events(read_file(spark, data_dir, name), name) for name in EVENT_TYPES
    })


def load_events(spark: SparkSession, data_dir: str) -> DataFrame:
    """Received events with segment and registry flag on every row."""
    return attach_registry_to_events(load_received(spark, data_dir), load_registry(spark, data_dir))


def load_apart(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Received events, registry, and the quarantine of all records that don't read as declared."""
    apart = {name: read_apart(spark, data_dir, name) for name in (REGISTRY_FILE, *EVENT_TYPES)}
    events = union_events({name: canonical_events(apart[name][0], name) for name in EVENT_TYPES})
    quarantine = reduce(DataFrame.unionByName, [bad for _, bad in apart.values()])
    return events, canonical_registry(apart[REGISTRY_FILE][0]), quarantine
