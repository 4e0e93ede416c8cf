"""Reference SQL (DuckDB dialect) for the registered queries.

Each statement recomputes a query's result from the ``events`` view with
plain SQL, independently of the Spark code path, so the two can be compared
row for row. Double columns are rounded to the same number of places as the
Spark side.
"""

from __future__ import annotations

from towerlens.plans import catalog as C
from towerlens.sources.events import CORRUPT_AT, CORRUPT_EVERY, FAULTS

D = C.DIGITS

_PAYLOAD = ["hour", "lat", "long", "signal", "network", "operator", "status",
            "description", "speed", "satellites", "precission", "provider",
            "activity", "postal_code"]

_CLEAN_WIRE = {
    "hour": "strftime(ts, '%H:%M:%S')",
    "lat": "'41.' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0')",
    "long": "'2.' || lpad(CAST((user_id * 7) % 1000 AS VARCHAR), 3, '0')",
    "signal": "k_text",
    "network": "'net_' || CAST(user_id % 3 AS VARCHAR)",
    "operator": "event_type",
    "status": "CAST(k % 4 AS VARCHAR)",
    "description": "'state_' || CAST(k % 4 AS VARCHAR)",
    "speed": "CAST(value AS VARCHAR)",
    "satellites": "''",
    "precission": "CAST(value AS VARCHAR)",
    "provider": "'null'",
    "activity": "'act_' || CAST(user_id % 5 AS VARCHAR)",
    "postal_code": "'08' || lpad(CAST(user_id % 20 AS VARCHAR), 3, '0')",
}


def _faulty(field: str) -> str:
    """The adapter's faulty records; a later rule goes before an earlier one."""
    cases = "".join(
        f" WHEN event_id % {every} = {at} THEN " + ("NULL" if text is None else f"'{text}'")
        for fields, every, at, text in reversed(FAULTS) if field in fields)
    return f"CASE{cases} ELSE {_CLEAN_WIRE[field]} END"


_WIRE = f"""
ev AS (
  SELECT *, json_extract_string(props, '$.k') AS k_text,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
wire AS (
  SELECT {', '.join(f'{_faulty(c)} AS {c}' for c in _PAYLOAD)}, ts AS record_ts, event_id AS record_id
  FROM ev
)"""

_TYPED = """
typed AS (
  SELECT hour AS measured_at_text, TRY_CAST(lat AS DOUBLE) AS lat,
         TRY_CAST(long AS DOUBLE) AS long,
         TRY_CAST(trunc(TRY_CAST(signal AS DOUBLE)) AS INTEGER) AS signal,
         network, operator, status, description,
         TRY_CAST(speed AS DOUBLE) AS speed, TRY_CAST(satellites AS DOUBLE) AS satellites,
         TRY_CAST(precission AS DOUBLE) AS precission, provider, activity, postal_code,
         record_ts, record_id
  FROM wire
)"""


def _blank_flags() -> str:
    # drop-null-fields rule: a text column is blank when every trimmed value
    # is '' or 'null' (a NULL value is not blank)
    flags = ",\n         ".join(
        f"coalesce(bool_and(coalesce(trim({c}) IN ('', 'null'), false)), true) AS {c}"
        for c in _PAYLOAD)
    return f"""
blank AS (
  SELECT {flags}
  FROM wire
)"""


def _mapped() -> str:
    def kept(c: str) -> str:
        return f"CASE WHEN (SELECT {c} FROM blank) THEN NULL ELSE w.{c} END"
    cols = {c: kept(c) for c in _PAYLOAD}
    body = f"""
cleaned AS (
  SELECT {', '.join(f'{cols[c]} AS {c}' for c in _PAYLOAD)}, w.record_ts
  FROM wire w
),
nonblank AS (
  SELECT * FROM cleaned
  WHERE NOT ({' AND '.join(f"coalesce(trim({c}), '') = ''" for c in _PAYLOAD)})
),
mapped AS (
  SELECT hour, lat, long, TRY_CAST(trunc(TRY_CAST(signal AS DOUBLE)) AS INTEGER) AS signal,
         network, operator, status, description, speed, satellites,
         TRY_CAST(precission AS DOUBLE) AS precission, provider, activity, postal_code,
         record_ts
  FROM nonblank
)"""
    return _blank_flags() + "," + body


def _kpi() -> str:
    return """
kpi AS (
  SELECT CAST(floor(epoch_us(record_ts) / 100000000) AS BIGINT) AS batch_window, operator,
         avg(signal) AS avg_signal, avg(precission) AS avg_precission,
         CAST(sum(signal) AS BIGINT) AS sum_signal, count(signal) AS n_signal,
         sum(precission) AS sum_precission, count(precission) AS n_precission,
         strftime(min(record_ts), '%Y') AS ingest_year, strftime(min(record_ts), '%m') AS ingest_month,
         strftime(min(record_ts), '%d') AS ingest_day, strftime(min(record_ts), '%H') AS ingest_hour
  FROM mapped GROUP BY 1, operator
),
status_kpi AS (
  SELECT CAST(floor(epoch_us(record_ts) / 100000000) AS BIGINT) AS batch_window,
         postal_code, description, count(status) AS status_count,
         strftime(min(record_ts), '%Y') AS ingest_year, strftime(min(record_ts), '%m') AS ingest_month,
         strftime(min(record_ts), '%d') AS ingest_day, strftime(min(record_ts), '%H') AS ingest_hour
  FROM mapped GROUP BY 1, postal_code, description
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


W = _with(_WIRE)
T = _with(_WIRE, _TYPED)
M = _with(_WIRE, _mapped())
K = _with(_WIRE, _mapped(), _kpi())


def _hours(text: str, mode: str = "interval") -> int:
    from towerlens.functions.timeparts import parse_range_hours
    return parse_range_hours(text, mode)


LABEL = "ingest_year || '-' || ingest_month || '-' || ingest_day || ' ' || ingest_hour || ':00:00'"


def _bound(range_text: str, mode: str = "interval") -> str:
    return (f"strftime(TIMESTAMP '{C.AS_OF}' - INTERVAL {_hours(range_text, mode)} HOUR, "
            f"'%Y-%m-%d %H:%M:%S')")


def _r(expr: str) -> str:
    return f"round({expr}, {D})"


def _rs(expr: str) -> str:
    """Rounding for sums of doubles (see catalog.SUM_DIGITS)."""
    return f"round({expr}, {C.SUM_DIGITS})"


OP_METRICS = f"""
op_metrics AS (
  SELECT operator, avg(avg_signal) AS avg_signal_strength, avg(avg_precission) AS avg_precision
  FROM kpi WHERE {LABEL} >= {_bound(C.OPERATOR_RANGE)}
  GROUP BY operator
),
postal AS (
  SELECT postal_code, description AS status_description,
         CAST(sum(status_count) AS BIGINT) AS status_count
  FROM status_kpi WHERE {LABEL} >= {_bound(C.OPERATOR_RANGE)}
  GROUP BY postal_code, description
)"""

KO = _with(_WIRE, _mapped(), _kpi(), OP_METRICS)

_AVG_BY_OP = f"""
SELECT operator, {_r('avg(signal)')} AS avg_signal, {_r('avg(precission)')} AS avg_precission,
       CAST(sum(signal) AS BIGINT) AS sum_signal, count(signal) AS n_signal,
       {_rs('sum(precission)')} AS sum_precission, count(precission) AS n_precission
FROM mapped GROUP BY operator"""

_KPI_ROWS = f"""
SELECT batch_window, operator, {_r('avg_signal')} AS avg_signal,
       {_r('avg_precission')} AS avg_precission, sum_signal, n_signal,
       {_rs('sum_precission')} AS sum_precission, n_precission,
       ingest_year, ingest_month, ingest_day, ingest_hour
FROM kpi"""

_STATUS_ROWS = """
SELECT batch_window, postal_code, description, status_count,
       ingest_year, ingest_month, ingest_day, ingest_hour
FROM status_kpi"""

_WIRE_COLS = ", ".join(_PAYLOAD)
_CAL = ("CAST(year(record_ts) AS INTEGER) AS year, CAST(month(record_ts) AS INTEGER) AS month, "
        "CAST(day(record_ts) AS INTEGER) AS day, CAST(hour(record_ts) AS INTEGER) AS hour")
_INGEST = ("strftime(record_ts, '%Y') AS ingest_year, strftime(record_ts, '%m') AS ingest_month, "
           "strftime(record_ts, '%d') AS ingest_day, strftime(record_ts, '%H') AS ingest_hour")

_KEPT = [c for c in _PAYLOAD if c not in ("satellites", "provider")]

_LEFT = ", ".join(f"CASE WHEN (SELECT {c} FROM blank) THEN NULL ELSE '{c}=' || coalesce({c}, '<null>') END"
                  for c in _PAYLOAD)

_NO_JSON = f"record_id % {CORRUPT_EVERY} = {CORRUPT_AT}"
_PARSED = (", ".join(f"CASE WHEN {_NO_JSON} THEN NULL ELSE {c} END AS {c}" for c in _PAYLOAD)
           + f", CASE WHEN {_NO_JSON} THEN 'no json ' || record_id END AS _corrupt")
_KEYED = f"coalesce(nullif(network, ''), 'time') AS key, {_WIRE_COLS}, CAST(NULL AS VARCHAR) AS _corrupt"

_NUMBERS = ("lat", "long", "signal", "speed", "satellites", "precission")


def _describe(c: str) -> str:
    number = f"CAST({c} AS DOUBLE)" if c in _NUMBERS else f"TRY_CAST({c} AS DOUBLE)"
    ends = (f"{_r(f'min({number})')} AS min_value, {_r(f'max({number})')} AS max_value, "
            "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text" if c in _NUMBERS else
            "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, "
            f"min({c}) AS min_text, max({c}) AS max_text")
    return (f"SELECT '{c}' AS column_name, count({c}) AS count, {_r(f'avg({number})')} AS mean, "
            f"{_r(f'stddev_samp({number})')} AS stddev, {ends} FROM typed")


def _event_windows(width: str, delay: str | None, extra_where: str = "") -> str:
    close = (f"AND window_start + INTERVAL {width} <= "
             f"(SELECT max(ts) FROM events) - INTERVAL {delay}") if delay else ""
    return f"""{T}
SELECT window_start, window_start + INTERVAL {width} AS window_end, operator,
       {_r('avg(signal)')} AS avg_signal_strength,
       {_r('avg(precission)')} AS avg_gps_precision, count(*) AS n_records
FROM (SELECT *, time_bucket(INTERVAL {width}, record_ts) AS window_start FROM typed)
WHERE true {close} {extra_where}
GROUP BY window_start, operator"""


def _pivot_sql() -> str:
    cols = ", ".join(
        f"CAST(sum(CASE WHEN coalesce(status_description, '') = '{s}' THEN status_count ELSE 0 END) AS BIGINT) AS {n}"
        for s, n in [("", "blank"), *((f"state_{i}", f"state_{i}") for i in range(4))])
    return f"""{KO}
SELECT coalesce(postal_code, '') AS postal_code, {cols}
FROM postal GROUP BY 1"""


_JOINED = f"""{W},
s AS (SELECT operator, avg(TRY_CAST(signal AS DOUBLE)) AS avg_signal_strength FROM wire GROUP BY operator),
p AS (SELECT operator, avg(TRY_CAST(precission AS DOUBLE)) AS avg_gps_precision FROM wire GROUP BY operator)
SELECT s.operator, {_r('avg_signal_strength')} AS avg_signal_strength,
       {_r('avg_gps_precision')} AS avg_gps_precision
FROM s JOIN p ON s.operator = p.operator"""

_OPERATOR_ROWS = f"""
SELECT operator, {_r('avg_signal_strength')} AS avg_signal_strength,
       {_r('avg_precision')} AS avg_precision FROM op_metrics"""

_HOURLY_ROWS = f"""
SELECT operator, strptime({LABEL}, '%Y-%m-%d %H:%M:%S') AS hour,
       {_r('avg(avg_signal)')} AS avg_signal_strength,
       {_r('avg(avg_precission)')} AS avg_precision
FROM kpi WHERE {LABEL} >= {_bound(C.HOURLY_RANGE)}
GROUP BY operator, {LABEL}"""


ORACLE: dict[str, str] = {
    "average_by_operator": f"{M}\n{_AVG_BY_OP}",
    "status_by_postal_code": f"""{M}
SELECT postal_code, description, count(status) AS status_count
FROM mapped GROUP BY postal_code, description""",
    "signal_by_operator_hour": f"""{T}
SELECT operator, {_CAL}, {_r('avg(signal)')} AS avg_signal_strength
FROM typed GROUP BY ALL""",
    "precision_by_operator_hour": f"""{T}
SELECT operator, {_CAL}, {_r('avg(precission)')} AS avg_gps_precision
FROM typed GROUP BY ALL""",
    "status_by_postal_hour": f"""{T}
SELECT postal_code AS postal_code_str, description, {_CAL}, count(*) AS status_count
FROM typed GROUP BY ALL""",
    "avg_signal_batch": f"""{W}
SELECT operator, {_r('avg(TRY_CAST(signal AS DOUBLE))')} AS avg_signal_strength
FROM wire GROUP BY operator""",
    "avg_precision_batch": f"""{W}
SELECT operator, {_r('avg(TRY_CAST(precission AS DOUBLE))')} AS avg_gps_precision
FROM wire GROUP BY operator""",
    "status_count_batch": f"""{W}
SELECT postal_code, status, count(*) AS status_count FROM wire GROUP BY postal_code, status""",
    "kpi_operator_join": _JOINED,
    "operator_kpis": _JOINED,
    "generic_aggregate": f"""{T}
SELECT network, max(signal) AS max_signal, {_r('min(speed)')} AS min_speed,
       count(status) AS count_status
FROM typed GROUP BY network""",
    "generic_aggregate_global": f"""{T}
SELECT {_r('avg(signal)')} AS avg_signal, {_rs('sum(precission)')} AS sum_precission,
       count(status) AS count_status
FROM typed""",
    "distinct_values": f"""{W}
SELECT DISTINCT 'network' AS column_name, network AS value FROM wire
UNION SELECT DISTINCT 'operator', operator FROM wire
UNION SELECT DISTINCT 'activity', activity FROM wire""",
    "distinct_profile": f"""{W}
SELECT 'network' AS column_name, count(*) AS n_distinct FROM (SELECT DISTINCT network FROM wire)
UNION ALL SELECT 'operator', count(*) FROM (SELECT DISTINCT operator FROM wire)
UNION ALL SELECT 'activity', count(*) FROM (SELECT DISTINCT activity FROM wire)
UNION ALL SELECT 'description', count(*) FROM (SELECT DISTINCT description FROM wire)""",
    "row_count": "SELECT count(*) AS n_rows FROM events",
    "describe_columns": f"{T}\n" + "\nUNION ALL ".join(map(_describe, ["measured_at_text", *_PAYLOAD[1:]])),
    "preview_rows": f"SELECT least(count(*), {C.PREVIEW}) AS n_rows FROM events",
    "calendar_parts": f"{T}\nSELECT record_id, {_CAL} FROM typed",
    "hour_label": f"""{K}
SELECT batch_window, operator, {LABEL} AS hour_label FROM kpi""",
    "time_range_filter": f"""{K}
SELECT batch_window, operator, {_r('avg_signal')} AS avg_signal,
       {_r('avg_precission')} AS avg_precission,
       ingest_year, ingest_month, ingest_day, ingest_hour
FROM kpi WHERE {LABEL} >= {_bound(C.OPERATOR_RANGE)}""",
    "ingest_partitions": f"{W}\nSELECT record_id, {_INGEST} FROM wire",
    "cast_numeric": f"""{W}
SELECT record_id, {_r('TRY_CAST(signal AS DOUBLE)')} AS signal,
       {_r('TRY_CAST(precission AS DOUBLE)')} AS precission FROM wire""",
    "apply_mapping": f"""{W}
SELECT hour, lat, long, TRY_CAST(trunc(TRY_CAST(signal AS DOUBLE)) AS INTEGER) AS signal, network,
       operator, status, description, speed, satellites,
       {_r('TRY_CAST(precission AS DOUBLE)')} AS precission, provider, activity, postal_code,
       record_ts
FROM wire""",
    "remove_null_rows": f"""{W}
SELECT * FROM wire
WHERE NOT ({' AND '.join(f"coalesce(trim({c}), '') = ''" for c in _PAYLOAD)})""",
    "drop_null_fields": f"{W},{_blank_flags()}\nSELECT record_id, record_ts, concat_ws('|', {_LEFT}) AS fields FROM wire",
    "drop_fields": f"{W}\nSELECT record_id, record_ts, {', '.join(_KEPT)} FROM wire",
    "parse_records": f"{W}\nSELECT record_id, {_PARSED} FROM wire",
    "with_record_ts": "SELECT event_id AS record_id, ts AS record_ts FROM events",
    "with_processing_time": f"{W}\nSELECT record_id, operator, true AS has_processing_time FROM wire",
    "operator_metrics": f"""{KO}
SELECT operator, {_r('avg_signal_strength')} AS avg_signal_strength,
       {_r('avg_precision')} AS avg_precision FROM op_metrics""",
    "operator_metrics_weighted": f"""{K}
SELECT operator, {_r('sum(sum_signal) / sum(n_signal)')} AS avg_signal_strength,
       {_r('sum(sum_precission) / sum(n_precission)')} AS avg_precision
FROM kpi WHERE {LABEL} >= {_bound(C.OPERATOR_RANGE)} GROUP BY operator""",
    "hourly_metrics": f"""{K}
SELECT operator, strptime({LABEL}, '%Y-%m-%d %H:%M:%S') AS hour,
       {_r('avg(avg_signal)')} AS avg_signal_strength,
       {_r('avg(avg_precission)')} AS avg_precision
FROM kpi WHERE {LABEL} >= {_bound(C.HOURLY_RANGE)}
GROUP BY operator, {LABEL}""",
    "postal_code_status": f"{KO}\nSELECT * FROM postal",
    "summary_cards": f"""{KO}
SELECT (SELECT count(*) FROM op_metrics) AS operators,
       (SELECT {_r('avg(avg_signal_strength)')} FROM op_metrics) AS avg_signal,
       (SELECT {_r('avg(avg_precision)')} FROM op_metrics) AS avg_precision,
       (SELECT count(DISTINCT coalesce(postal_code, '')) FROM postal) AS postal_codes""",
    "pivot_status": _pivot_sql(),
    "distinct_status": f"{KO}\nSELECT DISTINCT coalesce(status_description, '') AS status_description FROM postal",
    "operator_metrics_order": f"""{KO}
SELECT *, rank() OVER (ORDER BY avg_signal_strength DESC NULLS LAST) AS position FROM ({_OPERATOR_ROWS})""",
    "postal_code_status_order": f"""{KO}
SELECT *, rank() OVER (ORDER BY postal_code NULLS LAST, status_count DESC NULLS LAST) AS position FROM postal""",
    "hourly_metrics_order": f"""{K}
SELECT *, rank() OVER (ORDER BY hour NULLS LAST, operator NULLS LAST) AS position FROM ({_HOURLY_ROWS})""",
    "operator_metrics_reference_range": f"""{K}
SELECT operator, {_r('avg(avg_signal)')} AS avg_signal_strength, {_r('avg(avg_precission)')} AS avg_precision
FROM kpi WHERE {LABEL} >= {_bound(C.OPERATOR_RANGE, 'reference')} GROUP BY operator""",
    "lake_operator_metrics": f"{KO}{_OPERATOR_ROWS}",
    "lake_hourly_metrics": f"{K}{_HOURLY_ROWS}",
    "lake_postal_code_status": f"{KO}\nSELECT * FROM postal",
    "scan_kpi_table": f"""{KO}
SELECT operator, {_r('avg_signal_strength')} AS avg_signal_strength,
       {_r('avg_precision')} AS avg_precision FROM op_metrics""",
    "batch_raw_sink": f"{W}\nSELECT *, {_INGEST} FROM wire",
    "batch_kpi_sink": f"{K}\n{_STATUS_ROWS}",
    "register_tables": f"{K}\n{_STATUS_ROWS}",
    "compacted_kpi_table": f"{K}\n{_KPI_ROWS}",
    "write_result": f"""{KO}
SELECT operator, {_r('avg_signal_strength')} AS avg_signal_strength,
       {_r('avg_precision')} AS avg_precision FROM op_metrics""",
    "replay_records": f"{W}\nSELECT {_KEYED} FROM wire",
    "replay_first_n": f"{W}\nSELECT {_KEYED} FROM (SELECT * FROM wire ORDER BY record_id LIMIT {C.FIRST_N})",
    "scan_csv_null_token": f"{W}\nSELECT {_WIRE_COLS} FROM wire",
    "microbatch_kpis": f"{K}\n{_KPI_ROWS}",
    "stream_restart": f"{K}\n{_STATUS_ROWS}",
    "stream_kpi_append": _event_windows("1 HOUR", "1 MINUTE"),
    "stream_kpi_update": f"""{T}
SELECT time_bucket(INTERVAL 1 HOUR, record_ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, record_ts) + INTERVAL 1 HOUR AS window_end,
       postal_code, description, count(*) AS status_count
FROM typed GROUP BY ALL""",
    "stream_raw_sink": f"""{W}
SELECT hour AS measured_at_text, lat, long, signal, network, operator, status, description,
       speed, satellites, precission, provider, activity, postal_code, record_ts, record_id,
       {_CAL} FROM wire""",
    "stream_source": f"""{W}
SELECT * FROM wire WHERE record_ts >= TIMESTAMP '{C.STREAM_START}'""",
    "stream_source_earliest": f"{W}\nSELECT {_PARSED} FROM wire",
    "late_data_drop": _event_windows("1 DAY", "1 HOUR"),
}
ORACLE |= {f"lake_{k}": ORACLE[k] for k in ("summary_cards", "pivot_status", "distinct_status")}

# Event-time ledger: every other record arrives again at the end, late where its day had ended.
_WATERMARK = "(SELECT max(ts) FROM events) - INTERVAL 1 HOUR"
_DAYS = f"""{T},
days AS (SELECT *, time_bucket(INTERVAL 1 DAY, record_ts) AS window_start,
                time_bucket(INTERVAL 1 DAY, record_ts) + INTERVAL 1 DAY AS window_end FROM typed),
again AS (SELECT * FROM days WHERE record_id % 2 = 0),
counted AS (SELECT * FROM days UNION ALL SELECT * FROM again WHERE window_end > {_WATERMARK})"""


def _ledger_operators(test: str) -> str:
    return f"""{_DAYS}
SELECT window_start, window_end, operator, {_r('avg(signal)')} AS avg_signal_strength,
       {_r('avg(precission)')} AS avg_gps_precision, count(*) AS n_records
FROM counted WHERE window_end {test} {_WATERMARK} GROUP BY ALL"""


def _window_blank() -> str:
    flags = ", ".join(f"bool_and(coalesce(trim({c}) IN ('', 'null'), false)) AS {c}" for c in _PAYLOAD)
    cols = ", ".join(f"CASE WHEN b.{c} THEN NULL ELSE w.{c} END AS {c}" for c in _PAYLOAD)
    empty = " AND ".join(f"coalesce(trim({c}), '') = ''" for c in _PAYLOAD)
    return f"""{W},
tagged AS (SELECT *, CAST(floor(epoch_us(record_ts) / 100000000) AS BIGINT) AS batch_window FROM wire),
blank AS (SELECT batch_window, {flags} FROM tagged GROUP BY batch_window),
cleaned AS (SELECT {cols}, w.record_ts FROM tagged w JOIN blank b ON w.batch_window = b.batch_window),
mapped AS (
  SELECT TRY_CAST(trunc(TRY_CAST(signal AS DOUBLE)) AS INTEGER) AS signal, operator, status, description,
         TRY_CAST(precission AS DOUBLE) AS precission, postal_code, record_ts
  FROM cleaned WHERE NOT ({empty})
),{_kpi()}"""


_CUT = """date_trunc('day', (SELECT min(ts) + (max(ts) - min(ts)) * 2 / 3 FROM events))"""
ORACLE |= {
    "late_records": f"""{_DAYS}
SELECT * REPLACE ({', '.join(f"{_r(c)} AS {c}" for c in ('lat', 'long', 'speed', 'satellites', 'precission'))}),
       {_WATERMARK} AS watermark
FROM again WHERE window_end <= {_WATERMARK}""",
    "ledger_operator_windows": _ledger_operators("<="),
    "ledger_open_windows": _ledger_operators(">"),
    "ledger_status_windows": f"""{_DAYS}
SELECT window_start, window_end, postal_code, description, count(*) AS status_count
FROM counted WHERE window_end <= {_WATERMARK} GROUP BY ALL""",
    "committed_kpis": f"""{K}
SELECT 'average_by_operator' AS table_name, batch_window, CAST(sum(n_signal) AS BIGINT) AS n
FROM kpi WHERE to_timestamp(batch_window * 100)::TIMESTAMP < {_CUT} GROUP BY ALL
UNION ALL
SELECT 'status_by_postal_code', batch_window, CAST(sum(status_count) AS BIGINT)
FROM status_kpi WHERE to_timestamp(batch_window * 100)::TIMESTAMP < {_CUT} GROUP BY ALL""",
    "window_blank_kpis": f"{_window_blank()}\n{_KPI_ROWS}",
}
_BAD = "ts = (SELECT min(ts) FROM events)"


def _good(expr: str, name: str) -> str:
    return f"CASE WHEN {_BAD} THEN NULL ELSE {expr} END AS {name}"


ORACLE["stream_inferred_schema"] = f"""
SELECT {_good('event_id', 'record_id')}, {_good('event_type', 'operator')}, {_good(_r('value'), 'precission')},
       {_good('user_id', 'user_id')}, {_good("strftime(ts, '%H:%M')", '"at"')},
       {_good("CASE WHEN event_id % 2 = 0 THEN '[' || user_id || ']' ELSE CAST(user_id AS VARCHAR) END", 'mixed')},
       {_good("CASE WHEN event_id = (SELECT max(event_id) FROM events) THEN 'seen' END", 'rare')},
       CASE WHEN {_BAD} THEN 'no json' END AS _corrupt
FROM events"""


def _dashboard_sql() -> str:
    columns = ["operator", "avg_signal_strength", "avg_precision", "hour", "postal_code", "status_description",
               "status_count", "operators", "avg_signal", "postal_codes"]
    have = {"operators": columns[:3], "weighted": columns[:3], "hours": columns[:4], "status": columns[4:7],
            "cards": ["operators", "avg_signal", "avg_precision", "postal_codes"]}
    keys = {"operators": "operator_metrics", "weighted": "operator_metrics_weighted", "hours": "hourly_metrics",
            "status": "postal_code_status", "cards": "summary_cards"}
    parts = [f"SELECT '{name}' AS result, {', '.join(c if c in have[name] else f'NULL AS {c}' for c in columns)} "
             f"FROM ({ORACLE[key]})" for name, key in keys.items()]
    return " UNION ALL ".join(parts)


ORACLE["rollup_dashboard"] = _dashboard_sql()
