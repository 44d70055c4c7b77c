"""The registered monitoring queries once more, as DuckDB SQL: serials spelled out one by one, windows by time_bucket."""

from oracle_queries import _CLICKS, _LINES, _TURNS, _attached, _summarised

_DAY = "date_trunc('day', arrival)"
_WEEK = "time_bucket(INTERVAL 7 DAY, arrival, TIMESTAMP '1970-01-01')"
_ALL_SERIALS = "SELECT DISTINCT sequence_id, serial_id FROM received"


def _boundary(source: str, window: str, days: int) -> str:
    return f"""WITH {source},
windowed AS (SELECT {window} AS w, * FROM received),
own AS (
  SELECT w, sequence_id, min(serial_id) AS lo, max(serial_id) AS hi, max(arrival) AS latest, count(*) AS n FROM windowed GROUP BY ALL
),
judged AS (
  SELECT o.*, b.hi AS hi_before, greatest(o.latest, b.latest, a.latest) AS latest_around, least(o.lo, b.hi + 1) AS lo_wanted
  FROM own o LEFT JOIN own b ON b.sequence_id = o.sequence_id AND b.w = o.w - INTERVAL {days} DAY
  LEFT JOIN own a ON a.sequence_id = o.sequence_id AND a.w = o.w + INTERVAL {days} DAY
),
wanted AS (SELECT w, sequence_id, unnest(range(lo_wanted, hi + 1)) AS serial_id FROM judged),
absent AS (
  SELECT w, sequence_id, count(*) AS lost FROM wanted x WHERE NOT EXISTS (
    SELECT 1 FROM windowed r WHERE r.sequence_id = x.sequence_id AND r.serial_id = x.serial_id
      AND r.w BETWEEN x.w - INTERVAL {days} DAY AND x.w + INTERVAL {days} DAY)
  GROUP BY ALL
)
SELECT j.w::TIMESTAMP AS window_start, j.sequence_id, j.lo AS first_serial_id, j.hi AS last_serial_id, j.n AS rows,
  coalesce(x.lost, 0) AS lost_events, CASE WHEN j.hi_before IS NULL THEN j.lo ELSE 0 END AS unseen_prefix,
  j.latest_around + INTERVAL 10 MINUTE <= (SELECT max(arrival) FROM received) AS judged
FROM judged j LEFT JOIN absent x ON x.w = j.w AND x.sequence_id = j.sequence_id"""


_GAP_RATE = f"""WITH {_CLICKS},
firsts AS (SELECT sequence_id, serial_id, min(epoch_us(arrival)) AS us FROM received GROUP BY ALL),
steps AS (
  SELECT sequence_id, serial_id, us, lag(serial_id) OVER w AS before, lag(us) OVER w AS before_us
  FROM firsts WINDOW w AS (PARTITION BY sequence_id ORDER BY serial_id)
),
lost AS (
  SELECT sequence_id, least(us, before_us) + (unnest(range(1, serial_id - before))::HUGEINT * abs(us - before_us)) // (serial_id - before) AS us
  FROM steps WHERE serial_id > before + 1
),
joined AS (
  SELECT date_trunc('day', make_timestamp(us::BIGINT)) AS w, sequence_id, count(*) AS absent, 0 AS received FROM lost GROUP BY ALL
  UNION ALL
  SELECT {_DAY}, sequence_id, 0, count(*) FROM received GROUP BY ALL
),
segments AS (
  SELECT sequence_id, CASE WHEN count(DISTINCT segment) = 1 THEN min(segment) END AS segment FROM registry GROUP BY 1
)
SELECT w::TIMESTAMP AS window_start, coalesce(segment, 'unknown') AS segment, sum(absent)::BIGINT AS absent_events,
  count(*) FILTER (WHERE absent > 0) AS sequences_with_gaps, sum(received)::BIGINT AS received_rows,
  CASE WHEN sum(received) > 0 THEN round(sum(absent)::BIGINT * 1000 / sum(received)::BIGINT, 3) END AS absent_per_1000
FROM joined LEFT JOIN segments USING (sequence_id) GROUP BY ALL"""

_COPIES = f"""{_attached(_CLICKS, None)},
numbered AS (
  SELECT segment, date_trunc('day', arrival)::TIMESTAMP AS w,
    (epoch_us(arrival) - epoch_us(first_value(arrival) OVER o)) // 1000 AS delay, row_number() OVER o AS copy_no
  FROM attached WINDOW o AS (PARTITION BY sequence_id, serial_id ORDER BY arrival)
)"""
_COPY_DELAYS = _COPIES + """
SELECT w AS window_start, segment, CASE WHEN delay > 0 THEN (2 ** floor(log2(delay)))::BIGINT ELSE 0 END AS delay_ms_from, count(*) AS copies
FROM numbered WHERE copy_no > 1 GROUP BY ALL"""
_COPY_RATE = _COPIES + """
SELECT w AS window_start, segment, count(*) AS rows, count(*) FILTER (WHERE copy_no > 1) AS copies,
  round(count(*) FILTER (WHERE copy_no > 1) / count(*), 4) AS copy_share
FROM numbered GROUP BY ALL"""

_COVERAGE = f"""WITH {_LINES},
seen AS (SELECT DISTINCT {_DAY} AS w, sequence_id FROM received),
listed AS (SELECT DISTINCT date_trunc('day', registered_at) AS w, sequence_id FROM registry),
one AS (
  SELECT w, count(*) AS with_events, count(*) FILTER (WHERE sequence_id NOT IN (SELECT sequence_id FROM registry)) AS without_registry
  FROM seen GROUP BY 1
),
other AS (
  SELECT w, count(*) AS registered, count(*) FILTER (WHERE sequence_id NOT IN (SELECT sequence_id FROM received)) AS without_events
  FROM listed GROUP BY 1
)
SELECT w::TIMESTAMP AS window_start, coalesce(with_events, 0) AS with_events, coalesce(without_registry, 0) AS without_registry,
  coalesce(registered, 0) AS registered, coalesce(without_events, 0) AS without_events,
  CASE WHEN with_events > 0 THEN round(without_registry / with_events, 4) END AS share_without_registry,
  CASE WHEN registered > 0 THEN round(without_events / registered, 4) END AS share_without_events
FROM one FULL JOIN other USING (w)"""


def _ranked(values: str, keys: str, value: str, percents: str) -> str:
    return f"""
ordered AS (
  SELECT {keys}, {value}, row_number() OVER (PARTITION BY {keys} ORDER BY {value}) AS place, count(*) OVER (PARTITION BY {keys}) AS n
  FROM {values}
)
SELECT {keys}, percent, {value}, n FROM ordered, (SELECT unnest({percents}) AS percent)
WHERE place = greatest((percent * n + 99) // 100, 1)"""


_TIMING = f"""WITH {_LINES},
first_times AS (
  SELECT sequence_id, min(registered_at) AS registered_at, CASE WHEN count(DISTINCT segment) = 1 THEN min(segment) ELSE 'unknown' END AS segment
  FROM registry GROUP BY 1
),
residuals AS (
  SELECT {_WEEK}::TIMESTAMP AS window_start, segment, epoch_us(arrival) - epoch_us(registered_at) - offset_ms * 1000 AS residual_us
  FROM received JOIN first_times USING (sequence_id)
),{_ranked('residuals', 'window_start, segment', 'residual_us', '[1, 50, 99]')}"""


def _per_type(source: str) -> str:
    return f"""{_attached(source, None)},
per_sequence AS (SELECT event_type, sequence_id, count(*) AS events FROM kept GROUP BY ALL),
{_ranked('per_sequence', 'event_type', 'events', '[50, 95, 99]')}"""


_BASELINE = f"""{_attached(_CLICKS, None)},
hours AS (SELECT date_trunc('hour', arrival)::TIMESTAMP AS window_start, segment, count(*) AS rows FROM attached GROUP BY ALL),
past AS (
  SELECT *, coalesce(list(rows) OVER (PARTITION BY hour(window_start), segment ORDER BY window_start ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), []) AS past
  FROM hours
),
centred AS (SELECT *, list_median(past)::DOUBLE AS median FROM past),
spread AS (SELECT *, list_median(list_transform(past, lambda x: abs(x - median)))::DOUBLE AS deviation FROM centred)
SELECT window_start, segment, rows, len(past)::INTEGER AS days, median, deviation,
  CASE WHEN len(past) >= 5 THEN abs(rows - median) > greatest(3.0::DOUBLE * 1.4826::DOUBLE * deviation, 1.0) END AS deviates
FROM spread"""

_EXPECTED = f"""WITH {_TURNS},
announced AS (
  SELECT sequence_id, max(serial_id) + CASE sequence_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE 1 END AS expected_events
  FROM received WHERE sequence_id % 11 <> 5 GROUP BY 1
  UNION ALL SELECT sequence_id + 1000000, 2 FROM (SELECT DISTINCT sequence_id FROM received WHERE sequence_id % 9 = 0)
),
got AS (SELECT DISTINCT sequence_id, serial_id FROM received WHERE sequence_id % 3 > 0 OR serial_id % 3 <> 1),
facts AS (SELECT sequence_id, count(*) AS n, min(serial_id) AS lo, max(serial_id) AS hi FROM got GROUP BY 1),
wanted AS (SELECT sequence_id, unnest(range(expected_events)) AS serial_id FROM announced),
placed AS (
  SELECT w.sequence_id,
    count(*) FILTER (WHERE g.serial_id IS NULL AND f.n > 0 AND w.serial_id < f.lo) AS missing_prefix,
    count(*) FILTER (WHERE g.serial_id IS NULL AND w.serial_id BETWEEN f.lo AND f.hi) AS missing_inner,
    count(*) FILTER (WHERE g.serial_id IS NULL AND (f.n IS NULL OR w.serial_id > f.hi)) AS missing_tail
  FROM wanted w LEFT JOIN got g USING (sequence_id, serial_id) LEFT JOIN facts f USING (sequence_id) GROUP BY 1
)
SELECT sequence_id, a.expected_events, coalesce(f.n, 0) AS received_events,
  CASE WHEN a.expected_events IS NOT NULL THEN coalesce(p.missing_prefix, 0) END AS missing_prefix,
  CASE WHEN a.expected_events IS NOT NULL THEN coalesce(p.missing_inner, 0) END AS missing_inner,
  CASE WHEN a.expected_events IS NOT NULL THEN coalesce(p.missing_tail, 0) END AS missing_tail,
  CASE WHEN a.expected_events IS NOT NULL THEN (SELECT count(*) FROM got g WHERE g.sequence_id = a.sequence_id AND g.serial_id >= a.expected_events) END
    AS beyond_expected,
  CASE WHEN a.expected_events IS NULL THEN 'unannounced' WHEN f.n IS NULL THEN CASE WHEN a.expected_events > 0 THEN 'unseen' ELSE 'complete' END
    WHEN p.missing_prefix + p.missing_inner + p.missing_tail > 0 THEN 'lossy' ELSE 'complete' END AS status
FROM announced a FULL JOIN facts f USING (sequence_id) LEFT JOIN placed p USING (sequence_id)"""

_DRIFT = """WITH records AS (
  SELECT CASE WHEN event_type = 'signup' AND value < 3 THEN '{"k": ' ELSE
    '{"k": ' || CASE WHEN event_type = 'error' THEN '"' || regexp_extract(props, '([0-9]+)', 1) || '"' ELSE regexp_extract(props, '([0-9]+)', 1) END ||
    CASE WHEN event_type = 'view' THEN ', "at": {"x": ' || event_id % 7 || CASE WHEN value > 10 THEN ', "z": true' ELSE '' END || '}' ELSE '' END ||
    CASE WHEN event_type = 'click' THEN ', "note": null' ELSE '' END || ', "user": ' || user_id || '}' END AS record
  FROM events
),
valid AS (SELECT record::JSON AS j FROM records WHERE json_valid(record)),
top AS (SELECT key AS path, j -> ('$.' || key) AS v FROM (SELECT j, unnest(json_keys(j)) AS key FROM valid)),
nested AS (
  SELECT path || '.' || key AS path, v -> ('$.' || key) AS v
  FROM (SELECT path, v, unnest(json_keys(v)) AS key FROM top WHERE json_type(v) = 'OBJECT')
),
sent AS (
  SELECT path, CASE json_type(v) WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean'
    WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN 'null' ELSE 'other' END AS kind, count(*) AS rows
  FROM (SELECT * FROM top UNION ALL SELECT * FROM nested) GROUP BY ALL
  UNION ALL SELECT NULL, 'broken', count(*) FROM records WHERE NOT json_valid(record) HAVING count(*) > 0
),
declared(path, declared_kind) AS (VALUES ('k', 'integer'), ('at', 'object'), ('at.x', 'number'), ('at.y', 'number'), ('note', 'text'), ('plan', 'text'))
SELECT path, declared_kind, kind, coalesce(rows, 0) AS rows,
  CASE WHEN kind = 'broken' THEN 'broken' WHEN kind IS NULL THEN 'vanished' WHEN declared_kind IS NULL THEN 'new' WHEN kind = 'null' THEN 'null'
    WHEN kind = declared_kind OR (declared_kind = 'number' AND kind = 'integer') THEN 'declared' ELSE 'retyped' END AS status
FROM sent FULL JOIN declared USING (path)"""


def all_queries() -> dict[str, str]:
    return {
        "boundary_completeness": _boundary(_CLICKS, _DAY, 1),
        "boundary_completeness_b": _boundary(_LINES, _WEEK, 7),
        "gap_rate": _GAP_RATE,
        "copy_delays": _COPY_DELAYS,
        "copy_rate": _COPY_RATE,
        "coverage_by_window_b": _COVERAGE,
        "timing_residuals_b": _TIMING,
        "events_per_sequence": _per_type(_CLICKS),
        "events_per_sequence_b": _per_type(_LINES),
        "time_of_day_baseline": _BASELINE,
        "expected_events": _EXPECTED,
        "field_drift": _DRIFT,
        "merged_summary": _summarised(_CLICKS) + " SELECT * FROM summary",
    }
