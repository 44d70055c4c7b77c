"""Column names of the canonical frames and the fixed labels results use.

Received events, one row per delivery (re-deliveries are kept)::

    sequence_id   any     group key
    serial_id     bigint  position in the sequence, counted from 0
    offset_ms     bigint  milliseconds since the sequence started, client clock
    arrival       timestamp  arrival at the collecting servers, UTC
    event_type    string

Registry, any number of rows per sequence::

    sequence_id   any
    segment       string
    registered_at timestamp  (only the start-bound check reads it)
"""

EVENT_COLUMNS = ("sequence_id", "serial_id", "offset_ms", "arrival", "event_type")
SEGMENT_COLUMNS = ("segment", "has_registry")

ALL_SEGMENTS = "all"
UNKNOWN_SEGMENT = "unknown"
