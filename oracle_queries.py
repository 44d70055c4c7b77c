"""The registered queries once more, as DuckDB SQL over the same tables.

Written apart from the Spark code on purpose: ``row_number``, ``count(DISTINCT)``
and correlated windows over whole sequences, where the Spark side uses block
bitmaps, two-level minima and stretches.
"""

# How each reading of the tables yields received events and a registry.
_CLICKS = """
received AS (
  SELECT user_id AS sequence_id, k AS serial_id,
         k * 60000 + CAST(floor(value * 1000) AS BIGINT) AS offset_ms, ts AS arrival, event_type
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
),
registry AS (
  SELECT s_suppkey AS sequence_id, CAST(s_nationkey AS VARCHAR) AS segment, CAST(NULL AS TIMESTAMP) AS registered_at
  FROM supplier
)"""
_COARSE = _CLICKS.replace("k * 60000 + CAST(floor(value * 1000) AS BIGINT)", "(k // 4) * 240000")
_STABLE = _CLICKS.replace(
    "ts AS arrival, event_type", "ts AS arrival, ['click', 'error', 'purchase', 'signup', 'view'][k % 5 + 1] AS event_type"
)
_LINES = """
received AS (
  SELECT l_orderkey AS sequence_id, CAST(l_linenumber AS BIGINT) - 1 AS serial_id,
         (CAST(l_linenumber AS BIGINT) - 1) * 86400000 AS offset_ms, l_shipdate AS arrival, l_returnflag AS event_type
  FROM lineitem
),
registry AS (
  SELECT o_orderkey AS sequence_id, o_orderpriority AS segment, o_orderdate AS registered_at
  FROM orders
)"""
_TURNS = """
received AS (
  SELECT conv_id AS sequence_id, turn AS serial_id, turn * 1000 AS offset_ms,
         make_timestamp(turn * 1000000) AS arrival, role AS event_type
  FROM conversations
),
registry AS (
  SELECT s_suppkey AS sequence_id, CAST(s_nationkey AS VARCHAR) AS segment, CAST(NULL AS TIMESTAMP) AS registered_at
  FROM supplier
)"""


def _attached(source: str, segment: str | None) -> str:
    chosen = f"WHERE g.segment = '{segment}'" if segment else ""
    return f"""WITH {source},
attached AS (
  SELECT r.*, coalesce(g.segment, 'unknown') AS segment, g.sequence_id IS NOT NULL AS has_registry
  FROM received r LEFT JOIN (
    SELECT sequence_id, CASE WHEN count(DISTINCT segment) = 1 THEN min(segment) END AS segment
    FROM registry GROUP BY sequence_id
  ) g ON r.sequence_id = g.sequence_id
  {chosen}
),
kept AS (
  SELECT * EXCLUDE copy_no FROM (
    SELECT *, row_number() OVER (PARTITION BY sequence_id, serial_id ORDER BY arrival, event_type, offset_ms) AS copy_no
    FROM attached
  ) WHERE copy_no = 1
)"""


def _summarised(source: str, segment: str | None = None) -> str:
    return _attached(source, segment) + """,
totals AS (
  SELECT sequence_id, min(segment) AS segment, bool_or(has_registry) AS has_registry,
         min(serial_id) AS first_serial_id, max(serial_id) AS last_serial_id,
         count(DISTINCT serial_id) AS received_events,
         count(*) - count(DISTINCT serial_id) AS duplicate_events,
         min(epoch_us(arrival) - offset_ms * 1000) AS implied_us
  FROM attached GROUP BY sequence_id
),
summary AS (
  SELECT t.sequence_id, t.segment, t.has_registry, t.first_serial_id, t.last_serial_id,
         t.received_events, t.duplicate_events,
         a.event_type AS first_event_type, z.event_type AS last_event_type,
         make_timestamp(t.implied_us) AS implied_start,
         t.first_serial_id AS missing_prefix,
         t.last_serial_id - t.first_serial_id + 1 - t.received_events AS missing_inner,
         t.last_serial_id + 1 - t.received_events AS lost_events,
         t.implied_us < epoch_us((SELECT date_trunc('hour', min(arrival)) FROM attached)) AS started_before_window
  FROM totals t
  JOIN kept a ON a.sequence_id = t.sequence_id AND a.serial_id = t.first_serial_id
  JOIN kept z ON z.sequence_id = t.sequence_id AND z.serial_id = t.last_serial_id
)"""


def _hourly(source: str) -> str:
    return _attached(source, None) + """,
hourly AS (
  SELECT *, date_trunc('hour', arrival) AS h FROM attached
),
picked AS (
  SELECT *,
    first_value(event_type) OVER (PARTITION BY h, sequence_id ORDER BY serial_id, arrival, event_type) AS first_type,
    first_value(event_type) OVER (PARTITION BY h, sequence_id ORDER BY serial_id DESC, arrival, event_type) AS last_type
  FROM hourly
)
SELECT h AS window_start, sequence_id, min(segment) AS segment, bool_or(has_registry) AS has_registry,
  min(serial_id) AS first_serial_id, max(serial_id) AS last_serial_id,
  count(DISTINCT serial_id) AS received_events, count(*) - count(DISTINCT serial_id) AS duplicate_events,
  min(first_type) AS first_event_type, min(last_type) AS last_event_type,
  make_timestamp(min(epoch_us(arrival) - offset_ms * 1000)) AS implied_start,
  min(serial_id) AS missing_prefix,
  max(serial_id) - min(serial_id) + 1 - count(DISTINCT serial_id) AS missing_inner,
  max(serial_id) + 1 - count(DISTINCT serial_id) AS lost_events,
  min(epoch_us(arrival) - offset_ms * 1000) < epoch_us(h) AS started_before_window
FROM picked GROUP BY h, sequence_id"""


_LAST_TYPES = """
last_types AS (
  SELECT event_type, sequences,
         round(sequences / (SELECT count(*) FROM summary), 4) AS share_of_sequences,
         1 + (SELECT count(*) FROM last_counts o WHERE o.sequences > c.sequences) AS rank
  FROM last_counts c
)"""
_LAST_COUNTS = """
last_counts AS (SELECT last_event_type AS event_type, count(*) AS sequences FROM summary GROUP BY 1)"""
_FREQUENCY = """
per_sequence AS (SELECT sequence_id, event_type, count(*) AS n FROM kept GROUP BY ALL),
type_counts AS (
  SELECT p.event_type, CAST(sum(p.n) AS BIGINT) AS events, count(*) AS sequences_with_type,
         count(*) FILTER (WHERE p.n = m.most) AS sequences_where_most_frequent
  FROM per_sequence p
  JOIN (SELECT sequence_id, max(n) AS most FROM per_sequence GROUP BY 1) m ON m.sequence_id = p.sequence_id
  GROUP BY 1
),
frequency AS (
  SELECT *, round(events / (SELECT count(*) FROM kept), 4) AS share_of_events,
         1 + (SELECT count(*) FROM type_counts o WHERE o.events > c.events) AS rank
  FROM type_counts c
)"""


def _run_summary(source: str, label: str, segment: str | None = None) -> str:
    return _summarised(source, segment) + f",{_LAST_COUNTS},{_LAST_TYPES},{_FREQUENCY}" + f"""
SELECT '{label}' AS segment, count(*) AS sequences,
  count(*) FILTER (WHERE NOT has_registry) AS sequences_without_registry,
  count(*) FILTER (WHERE lost_events > 0) AS incomplete_sequences,
  count(*) FILTER (WHERE lost_events > 0 AND started_before_window) AS incomplete_started_before_window,
  count(*) FILTER (WHERE first_serial_id > 0) AS not_from_zero,
  count(*) FILTER (WHERE first_serial_id > 0 AND started_before_window) AS not_from_zero_started_before_window,
  CAST(coalesce(sum(lost_events), 0) AS BIGINT) AS lost_events,
  CAST(coalesce(sum(missing_prefix), 0) AS BIGINT) AS lost_in_prefix,
  CAST(coalesce(sum(missing_inner), 0) AS BIGINT) AS lost_in_inner_gaps,
  CAST(coalesce(sum(lost_events) FILTER (WHERE started_before_window), 0) AS BIGINT)
    AS lost_in_sequences_started_before_window,
  CAST(coalesce(max(lost_events), 0) AS BIGINT) AS max_lost_in_one_sequence,
  count(*) FILTER (WHERE duplicate_events > 0) AS sequences_with_duplicates,
  CAST(coalesce(sum(duplicate_events), 0) AS BIGINT) AS duplicate_events,
  coalesce((SELECT string_agg(event_type, '|' ORDER BY event_type) FROM last_types WHERE rank = 1), '')
    AS most_common_last_event_type,
  coalesce((SELECT string_agg(event_type, '|' ORDER BY event_type) FROM frequency WHERE rank = 1), '')
    AS most_frequent_event_type
FROM summary"""


_INCOMPLETE = """ SELECT sequence_id, segment, has_registry, first_serial_id, last_serial_id, received_events,
  missing_prefix, missing_inner, lost_events, duplicate_events, started_before_window
FROM summary WHERE lost_events > 0 ORDER BY sequence_id"""
_NOT_FROM_ZERO = """ SELECT sequence_id, segment, has_registry, first_serial_id, first_event_type, received_events,
  implied_start, started_before_window
FROM summary WHERE first_serial_id > 0 ORDER BY sequence_id"""
_HISTOGRAM = """ SELECT lost_events, count(*) AS sequences,
  count(*) FILTER (WHERE started_before_window) AS sequences_started_before_window
FROM summary GROUP BY 1 ORDER BY 1"""
_BUCKETS = """, bounds(position, bucket, low, high) AS (VALUES
  (1, '1', 1, 1), (2, '2', 2, 2), (3, '3-5', 3, 5), (4, '6-10', 6, 10),
  (5, '11-20', 11, 20), (6, '21-50', 21, 50), (7, '51-100', 51, 100), (8, '101+', 101, 9223372036854775807))
SELECT CAST(b.position AS BIGINT) AS position, b.bucket, count(s.sequence_id) AS sequences,
  count(s.sequence_id) FILTER (WHERE s.started_before_window) AS started_before_window,
  count(s.sequence_id) FILTER (WHERE NOT s.started_before_window) AS not_proven_before_window
FROM bounds b LEFT JOIN summary s ON s.lost_events BETWEEN b.low AND b.high
GROUP BY ALL ORDER BY 1"""
_COMPLETE = """ SELECT count(*) AS sequences, count(*) FILTER (WHERE lost_events = 0) AS complete_sequences,
  round(count(*) FILTER (WHERE lost_events = 0) / count(*), 4) AS complete_share FROM summary"""
_BOUNDARY = """ SELECT has_registry, started_before_window, first_serial_id = 0 AS has_serial_0,
  count(*) AS sequences, CAST(sum(lost_events) AS BIGINT) AS lost_events FROM summary GROUP BY ALL"""


def _duplicates(source: str, payload: str) -> str:
    return f"""WITH {source}
SELECT count(*) AS repeated_serials, count(DISTINCT sequence_id) AS sequences,
  max(payloads) AS max_distinct_payloads, min(spread) AS min_arrival_spread_s, max(spread) AS max_arrival_spread_s
FROM (
  SELECT sequence_id, serial_id, count(*) AS copies, count(DISTINCT {payload}) AS payloads,
         (max(epoch_us(arrival)) - min(epoch_us(arrival))) / 1e6 AS spread
  FROM received GROUP BY ALL
) WHERE copies > 1"""


_ORDERING = """ SELECT CAST(sum(CAST(back AS BIGINT)) AS BIGINT) AS offset_decreases,
  CAST(sum(CAST(late AS BIGINT)) AS BIGINT) AS arrival_decreases,
  count(DISTINCT sequence_id) FILTER (WHERE late) AS sequences_with_arrival_decrease
FROM (SELECT sequence_id, offset_ms < lag(offset_ms) OVER w AS back, arrival < lag(arrival) OVER w AS late
      FROM kept WINDOW w AS (PARTITION BY sequence_id ORDER BY serial_id))"""
_GAPS = """ SELECT gap_run, count(*) AS runs FROM (
  SELECT serial_id - lag(serial_id) OVER (PARTITION BY sequence_id ORDER BY serial_id) - 1 AS gap_run FROM kept
) WHERE gap_run > 0 GROUP BY 1 ORDER BY 1"""
_LAST_PAIRS = """,
by_serial AS (SELECT sequence_id, event_type FROM kept
  QUALIFY row_number() OVER (PARTITION BY sequence_id ORDER BY serial_id DESC) = 1),
by_arrival AS (SELECT sequence_id, event_type FROM kept
  QUALIFY row_number() OVER (PARTITION BY sequence_id ORDER BY arrival DESC, serial_id DESC) = 1)"""
_LAST_BY_ORDERING = _LAST_PAIRS + """
SELECT ordering, event_type, count(*) AS sequences FROM (
  SELECT 'serial' AS ordering, event_type FROM by_serial UNION ALL SELECT 'arrival', event_type FROM by_arrival
) GROUP BY ALL"""
_LAST_DISAGREE = _LAST_PAIRS + """
SELECT count(*) AS sequences FROM by_serial s JOIN by_arrival a USING (sequence_id) WHERE s.event_type <> a.event_type"""
_TIES = """ SELECT count(*) FILTER (WHERE n > 1) AS tied_sequences, count(*) FILTER (WHERE types > 1) AS tied_between_types
FROM (
  SELECT k.sequence_id, count(*) AS n, count(DISTINCT k.event_type) AS types
  FROM kept k JOIN (SELECT sequence_id, max(offset_ms) AS top FROM kept GROUP BY 1) m
    ON m.sequence_id = k.sequence_id AND m.top = k.offset_ms
  GROUP BY 1)"""
_FIRSTS = """, firsts AS (SELECT sequence_id, min(serial_id) AS first_serial_id FROM received GROUP BY 1)"""
_FIRST_DISTRIBUTION = _FIRSTS + """
SELECT first_serial_id, count(*) AS sequences FROM firsts GROUP BY 1 ORDER BY 1 LIMIT 10"""
_FIRST_ABOVE = _FIRSTS + """
SELECT count(*) AS sequences FROM firsts WHERE first_serial_id > 9"""
_ZERO_TYPES = """ SELECT event_type, count(*) AS rows FROM received WHERE serial_id = 0 GROUP BY 1"""
_COVERAGE = """,
e AS (SELECT DISTINCT sequence_id FROM received), g AS (SELECT DISTINCT sequence_id FROM registry)
SELECT (SELECT count(*) FROM e) AS with_events, (SELECT count(*) FROM g) AS with_registry,
  (SELECT count(*) FROM e ANTI JOIN g USING (sequence_id)) AS events_without_registry,
  (SELECT count(*) FROM g ANTI JOIN e USING (sequence_id)) AS registry_without_events,
  (SELECT count(*) FROM registry) - (SELECT count(*) FROM g) AS surplus_registry_rows"""
_EVENTS_ONLY = """ SELECT DISTINCT sequence_id FROM received WHERE sequence_id NOT IN (SELECT sequence_id FROM registry)"""
_REGISTRY_ONLY = """ SELECT DISTINCT sequence_id FROM registry WHERE sequence_id NOT IN (SELECT sequence_id FROM received)"""
_RANGE = """ SELECT CAST(min(arrival) AS VARCHAR) AS earliest, CAST(max(arrival) AS VARCHAR) AS latest FROM received"""
_REGISTRY_RANGE = """ SELECT CAST(min(registered_at) AS VARCHAR) AS earliest,
  CAST(max(registered_at) AS VARCHAR) AS latest FROM registry"""
_OFFSETS = """ SELECT min(offset_ms) AS smallest, max(offset_ms) AS largest FROM received"""
_SEGMENTS = """ SELECT segment, count(*) AS rows FROM registry GROUP BY 1"""
_QUANTILES = """, leads AS (
  SELECT (epoch_us(g.registered_at) - epoch_us(s.implied_start)) / 1000 AS lead_ms
  FROM summary s JOIN registry g ON g.sequence_id = s.sequence_id
)
SELECT CAST(p AS DOUBLE) AS probability, round(v, 3) AS lead_ms FROM (
  SELECT 0.01 AS p, quantile_cont(lead_ms, 0.01) AS v FROM leads
  UNION ALL SELECT 0.5, quantile_cont(lead_ms, 0.5) FROM leads
  UNION ALL SELECT 0.99, quantile_cont(lead_ms, 0.99) FROM leads)"""
_FINAL_DEFAULT = """ SELECT count(*) AS sequences FROM (
  SELECT sequence_id, max(arrival) AS latest FROM received GROUP BY 1
) WHERE latest >= (SELECT date_trunc('hour', min(arrival)) + INTERVAL 59 MINUTE FROM received)"""
_FINAL_DAY = """ SELECT count(*) AS sequences FROM (
  SELECT sequence_id, max(arrival) AS latest FROM received GROUP BY 1
) WHERE latest >= TIMESTAMP '2024-01-30 00:00:00'"""
_TUMBLING = """ SELECT strftime(time_bucket(INTERVAL 5 MINUTE, arrival), '%H:%M') AS window_start, count(*) AS rows
FROM received GROUP BY 1"""

_PAYLOAD = """
feed AS (
  SELECT user_id AS sequence_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS serial_id, ts AS arrival,
    event_type,
    CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) END AS height,
    CASE WHEN event_type = 'view' AND value >= 5 THEN CAST(floor(value * 2) AS BIGINT) END AS width,
    CASE WHEN event_type = 'click' THEN value >= 10 END AS visible
  FROM events
)"""


def _for_both(sql_of) -> dict[str, str]:
    return {"": sql_of(_CLICKS), "_b": sql_of(_LINES)}


def _pairs(name: str, sql_of) -> dict[str, str]:
    return {f"{name}{suffix}": sql for suffix, sql in _for_both(sql_of).items()}


def all_queries() -> dict[str, str]:
    attached_columns = " SELECT * FROM attached"
    sql: dict[str, str] = {
        **_pairs("registry_attach", lambda s: _attached(s, None) + attached_columns),
        "event_union": """
          SELECT user_id AS sequence_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS serial_id,
                 CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) * 60000 + CAST(floor(value * 1000) AS BIGINT) AS offset_ms,
                 ts AS arrival, event_type
          FROM events
          UNION ALL
          SELECT conv_id, turn, turn * 1000, make_timestamp(turn * 1000000), role FROM conversations""",
        "segment_filtered": _attached(_CLICKS, "3") + attached_columns,
        "segment_filtered_b": _attached(_LINES, "2-HIGH") + attached_columns,
        "required_field_violations": """
SELECT 'sequence_id is missing' AS problem, count(*) FILTER (WHERE event_type = 'signup' AND value < 5) AS rows FROM events
UNION ALL SELECT 'serial_id is missing or negative',
  count(*) FILTER (WHERE value >= 20 OR regexp_extract(props, '([0-9]+)', 1) = '0') FROM events
UNION ALL SELECT 'offset_ms is missing or negative', count(*) FILTER (WHERE floor((value - 1) * 1000) < 0) FROM events
UNION ALL SELECT 'arrival is missing', count(*) FILTER (WHERE event_type = 'error' AND value < 2) FROM events""",
        **_pairs("sequence_summary", lambda s: _summarised(s) + " SELECT * FROM summary"),
        "sequence_summary_control": _summarised(_TURNS) + " SELECT * FROM summary",
        "sequence_summary_segment": _summarised(_CLICKS, "3") + " SELECT * FROM summary",
        "sequence_summary_segment_b": _summarised(_LINES, "2-HIGH") + " SELECT * FROM summary",
        "sequence_summary_stable": _summarised(_STABLE) + " SELECT * FROM summary",
        "frequency_from_blocks": _attached(_STABLE, None) + f",{_FREQUENCY} SELECT * FROM frequency",
        "hourly_summary": _hourly(_CLICKS),
        "conflicting_serials": f"""WITH {_CLICKS}
SELECT sequence_id, CAST(sum(types - 1) AS BIGINT) AS conflicting_serials
FROM (SELECT sequence_id, serial_id, count(DISTINCT event_type) AS types FROM received GROUP BY ALL) GROUP BY 1""",
        **_pairs("incomplete_sequences", lambda s: _summarised(s) + _INCOMPLETE),
        **_pairs("not_from_zero", lambda s: _summarised(s) + _NOT_FROM_ZERO),
        **_pairs("lost_histogram", lambda s: _summarised(s) + _HISTOGRAM),
        **_pairs("lost_buckets", lambda s: _summarised(s) + _BUCKETS),
        **_pairs("complete_share", lambda s: _summarised(s) + _COMPLETE),
        **_pairs("last_event_types",
                 lambda s: _summarised(s) + f",{_LAST_COUNTS},{_LAST_TYPES} SELECT * FROM last_types"),
        **_pairs("event_type_frequency", lambda s: _attached(s, None) + f",{_FREQUENCY} SELECT * FROM frequency"),
        "event_type_frequency_segment": _attached(_CLICKS, "3") + f",{_FREQUENCY} SELECT * FROM frequency",
        "event_type_frequency_segment_b": _attached(_LINES, "2-HIGH") + f",{_FREQUENCY} SELECT * FROM frequency",
        **_pairs("run_summary", lambda s: _run_summary(s, "all")),
        "run_summary_segment": _run_summary(_CLICKS, "3", "3"),
        "run_summary_segment_b": _run_summary(_LINES, "2-HIGH", "2-HIGH"),
        "null_profile": f"""WITH {_PAYLOAD}
SELECT * FROM (
  SELECT 'size.height' AS field, count(*) AS rows, count(*) - count(height) AS absent FROM feed
  UNION ALL SELECT 'size.width', count(*), count(*) - count(width) FROM feed
  UNION ALL SELECT 'visible', count(*), count(*) - count(visible) FROM feed
) WHERE absent > 0""",
        "boolean_values": f"WITH {_PAYLOAD} SELECT visible, count(*) AS rows FROM feed GROUP BY 1",
        "size_fields": f"""WITH {_PAYLOAD}
SELECT serial_id = 0 AS serial_0, event_type = 'view' AS has_size, count(*) AS rows FROM feed GROUP BY ALL""",
        "duplicate_profile": _duplicates(_CLICKS, "(event_type, offset_ms)"),
        "duplicate_profile_b": _duplicates(_LINES, "(event_type, offset_ms)"),
        **_pairs("time_range", lambda s: f"WITH {s}" + _RANGE),
        "registry_time_range_b": f"WITH {_LINES}" + _REGISTRY_RANGE,
        **_pairs("offset_range", lambda s: f"WITH {s}" + _OFFSETS),
        **_pairs("segment_counts", lambda s: f"WITH {s}" + _SEGMENTS),
        **_pairs("key_coverage", lambda s: f"WITH {s}" + _COVERAGE),
        **_pairs("sequences_without_registry", lambda s: f"WITH {s}" + _EVENTS_ONLY),
        **_pairs("registry_without_events", lambda s: f"WITH {s}" + _REGISTRY_ONLY),
        **_pairs("first_serial_distribution", lambda s: f"WITH {s}" + _FIRST_DISTRIBUTION),
        **_pairs("first_serial_above_nine", lambda s: f"WITH {s}" + _FIRST_ABOVE),
        **_pairs("types_at_serial_zero", lambda s: f"WITH {s}" + _ZERO_TYPES),
        **_pairs("ordering_violations", lambda s: _attached(s, None) + _ORDERING),
        **_pairs("gap_runs", lambda s: _attached(s, None) + _GAPS),
        **_pairs("last_event_by_ordering", lambda s: _attached(s, None) + _LAST_BY_ORDERING),
        **_pairs("last_event_disagreements", lambda s: _attached(s, None) + _LAST_DISAGREE),
        "max_offset_ties": _attached(_COARSE, None) + _TIES,
        "max_offset_ties_b": _attached(_LINES, None) + _TIES,
        **_pairs("window_boundary", lambda s: _summarised(s) + _BOUNDARY),
        "start_bound_quantiles": _summarised(_LINES) + _QUANTILES,
        "final_window_arrivals": f"WITH {_CLICKS}" + _FINAL_DAY,
        "final_window_arrivals_b": f"WITH {_LINES}" + _FINAL_DEFAULT,
        "tumbling_counts": f"WITH {_CLICKS}" + _TUMBLING,
        "feed_records": f"WITH {_CLICKS} SELECT * FROM received",
    }
    return sql
