"""Any table as canonical frames: name the columns, or give expressions for them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwatch.functions.times import as_utc


def _column(given: str | Column) -> Column:
    return F.col(given) if isinstance(given, str) else given


def events_from(
    table: DataFrame,
    *,
    sequence_id: str | Column,
    serial_id: str | Column,
    offset_ms: str | Column,
    arrival: str | Column,
    event_type: str | Column,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Received events from ``table``; ``keep`` names payload columns to carry along."""
    return table.select(
        _column(sequence_id).alias("sequence_id"),
        _column(serial_id).cast("bigint").alias("serial_id"),
        _column(offset_ms).cast("bigint").alias("offset_ms"),
        as_utc(arrival).alias("arrival"),
        _column(event_type).alias("event_type"),
        *keep,
    )


def registry_from(
    table: DataFrame, *, sequence_id: str | Column, segment: str | Column, registered_at: str | Column | None = None
) -> DataFrame:
    columns = [_column(sequence_id).alias("sequence_id"), _column(segment).alias("segment")]
    if registered_at is not None:
        columns.append(as_utc(registered_at).alias("registered_at"))
    return table.select(*columns)
