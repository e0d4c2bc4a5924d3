"""Independent SQL (DuckDB dialect) for each registered query, over the same
driver tables. The fixture shapes are the views of FIXTURES.md section C,
inlined as ``WITH`` clauses; the result columns carry the same names as the
Spark results."""

from __future__ import annotations

from slotwise.operators.outputs import HOUR_SLOTS, HOURS, QUARTER_SLOTS

ORACLE: dict[str, str] = {}

V_READINGS_SRC = """readings_src AS (
  SELECT user_id % 50 AS point_id, user_id AS account_id, CAST(user_id % 101 AS INTEGER) AS period_count,
    CASE WHEN event_id % 10 = 9 THEN 60 ELSE 15 END AS interval_min, value AS reading,
    CASE event_type WHEN 'click' THEN 1101 WHEN 'view' THEN 1102 WHEN 'purchase' THEN 1103
      WHEN 'error' THEN 9104 ELSE 7777 END AS channel,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS read_date,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS read_time,
    CAST(CAST(ts AS DATE) AS VARCHAR) || ' ' || lpad(CAST(extract(hour FROM ts) AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(CAST(floor(extract(minute FROM ts) / 15) * 15 AS INTEGER) AS VARCHAR), 2, '0') || ':00' AS slot_ts,
    CAST(CAST(ts AS DATE) AS VARCHAR) || ' ' || lpad(CAST(extract(hour FROM ts) AS VARCHAR), 2, '0') || ':00:00' AS hour_ts,
    CASE event_id % 5 WHEN 0 THEN ' kwh_del ' WHEN 1 THEN 'KWH' WHEN 2 THEN 'KWH_NET' WHEN 3 THEN 'Kwh_Rec'
      ELSE 'KVARH' END AS unit_raw,
    CASE WHEN event_id % 7 = 0 THEN 'Estimated' WHEN event_id % 7 = 1 THEN NULL ELSE 'Read' END AS status_raw,
    CASE WHEN event_id % 11 = 0 THEN 1 WHEN event_id % 11 = 1 THEN NULL ELSE 0 END AS outage
  FROM events)"""


def _readings_view(value_sql: str = "CAST(reading AS DECIMAL(18,4))",
                   factor_sql: str = "CASE WHEN interval_min = 15 THEN 4 ELSE 1 END",
                   window=("2024-01-19", "2024-01-22"), interval: int = 15) -> str:
    return f"""readings AS (
  SELECT CAST(point_id AS VARCHAR) AS sp, CAST(account_id AS VARCHAR) AS sa,
    CASE WHEN period_count % 23 = 0 OR period_count % 24 = 0 OR period_count % 25 = 0
      THEN 'complete' ELSE 'partial' END AS rsc,
    CAST(interval_min AS VARCHAR) AS im, {value_sql} AS rm, CAST(channel AS VARCHAR) AS chnl,
    replace(read_date, '-', '') AS rd, read_date AS pfd, read_time AS rdng_dttm,
    CASE WHEN interval_min = 15 THEN replace(substr(slot_ts, 12, 5), ':', '')
      WHEN interval_min = 60 THEN replace(substr(hour_ts, 12, 5), ':', '') END AS qtr_intr,
    substr(hour_ts, 12, 2) AS hr_intr, substr(slot_ts, 12, 10) AS qtr_intr_10,
    CAST(period_count AS VARCHAR) AS pc,
    CASE WHEN upper(trim(unit_raw)) = 'KVARH' THEN 'kv'
      WHEN upper(trim(unit_raw)) IN ('KWH_DEL', 'KWH') THEN 'kd'
      WHEN upper(trim(unit_raw)) = 'KWH_NET' THEN 'kn'
      WHEN upper(trim(unit_raw)) = 'KWH_REC' THEN 'kr' END AS uom,
    CASE WHEN status_raw = 'Estimated' THEN 'ESTIMATED' ELSE 'ACTUAL' END AS st, outage AS oi,
    {factor_sql} AS demand_factor
  FROM readings_src
  WHERE read_date BETWEEN '{window[0]}' AND '{window[1]}' AND interval_min = {interval}
    AND channel IN (1101, 1102, 1103, 9104))"""


V_DIMS = """accounts AS (
  SELECT c_custkey AS account_id, c_mktsegment AS plan_code, c_nationkey AS plan_id FROM customer),
plans AS (
  SELECT n_nationkey AS plan_id, ' ' || CAST(n_regionkey AS VARCHAR) || ' ' AS use_type FROM nation),
plan_assignments AS (
  SELECT c_custkey AS account_id, DATE '2023-12-20' AS assign_start,
    CASE WHEN c_custkey % 2 = 0 THEN DATE '2024-01-21' ELSE DATE '2024-03-01' END AS assign_end FROM customer),
seasons AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS use_type, s.start_date, s.end_date, s.season FROM region
  CROSS JOIN (SELECT DATE '2023-10-01' AS start_date, DATE '2024-01-20' AS end_date, 'W' AS season
    UNION ALL SELECT DATE '2024-01-21', DATE '2024-05-31', 'S') s),
calendar AS (
  SELECT DISTINCT CAST(ts AS DATE) AS cal_date,
    CASE WHEN extract(day FROM ts) % 7 IN (6, 0) THEN 'WE' ELSE 'WD' END AS day_type FROM events),
dayparts AS (
  SELECT n_nationkey AS plan_id, p.part, p.t0, p.t1, p.day_type, p.season FROM nation CROSS JOIN (
    SELECT 'OFF' AS part, '00:00:00' AS t0, '07:59:59' AS t1, 'WD' AS day_type, 'W' AS season
    UNION ALL SELECT 'MID', '08:00:00', '15:59:59', 'WD', 'W'
    UNION ALL SELECT 'ON', '16:00:00', '20:59:59', 'WD', 'W'
    UNION ALL SELECT 'SOF', '20:00:00', '23:59:59', 'WE', 'S') p)"""

V_DAYPARTS_SRC = """dayparts_src AS (
  SELECT n_nationkey AS plan_id, p.* FROM nation CROSS JOIN (
    SELECT ' ON ' AS part_raw, 'KWHSNP ' AS measure_raw, TIMESTAMP '2017-01-01 08:00:00' AS t0_local,
      TIMESTAMP '2017-01-01 11:59:59' AS t1_local, 'WD' AS day_type, 'W' AS season,
      DATE '2023-01-01' AS valid_from, DATE '2024-12-31' AS valid_to
    UNION ALL SELECT 'OFF', 'KWHWFP', TIMESTAMP '2017-01-01 14:00:00', TIMESTAMP '2017-01-01 18:00:00', 'WE', 'S', DATE '2023-01-01', DATE '2024-01-10'
    UNION ALL SELECT NULL, 'KWHSMP', TIMESTAMP '2017-01-01 00:00:00', TIMESTAMP '2017-01-01 01:00:00', 'WD', 'W', DATE '2023-01-01', DATE '2024-12-31'
    UNION ALL SELECT 'BAD', 'KWHSMP', TIMESTAMP '2017-01-01 00:00:00', TIMESTAMP '2017-01-01 01:00:00', 'WD', 'W', DATE '2023-01-01', DATE '2024-12-31'
    UNION ALL SELECT 'MID', 'OTHER', TIMESTAMP '2017-01-01 00:00:00', TIMESTAMP '2017-01-01 01:00:00', 'WD', 'W', DATE '2023-01-01', DATE '2024-12-31') p)"""

READING_COLS = ("sp, sa, rsc, im, CAST(rm AS DOUBLE) AS rm, chnl, rd, pfd, rdng_dttm, qtr_intr, hr_intr, qtr_intr_10, pc, uom, st, "
                "oi, demand_factor")


def _enriched_view(day_match: bool = False, window=("2024-01-19", "2024-01-22")) -> str:
    extra = " AND c.cal_date = CAST(r.pfd AS DATE)" if day_match else ""
    return f"""enriched AS (
  SELECT r.*, s.season AS si, c.cal_date, d.part AS pi
  FROM readings r
  JOIN accounts a ON r.sa = CAST(a.account_id AS VARCHAR) AND a.plan_code <> 'MACHINERY'
  JOIN plans p ON p.plan_id = a.plan_id
  JOIN plan_assignments pa ON pa.account_id = a.account_id
    AND CAST(r.pfd AS DATE) >= pa.assign_start AND CAST(r.pfd AS DATE) < pa.assign_end
  JOIN seasons s ON s.use_type = trim(p.use_type)
    AND CAST(r.pfd AS DATE) >= s.start_date AND CAST(r.pfd AS DATE) <= s.end_date
  JOIN (SELECT * FROM calendar WHERE cal_date BETWEEN DATE '{window[0]}' AND DATE '{window[1]}') c
    ON c.cal_date >= s.start_date AND c.cal_date <= s.end_date{extra}
  LEFT JOIN dayparts d ON d.plan_id = p.plan_id AND r.qtr_intr_10 >= d.t0 AND r.qtr_intr_10 <= d.t1
    AND c.day_type = d.day_type AND s.season = d.season)"""


def _with(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


ENRICHED = _with(V_READINGS_SRC, _readings_view(), V_DIMS, _enriched_view())
ENRICHED_DAY = _with(V_READINGS_SRC, _readings_view(), V_DIMS, _enriched_view(day_match=True))


def _pivot_cols(slot_col: str, value: str, slots, prefix: str, fill: str | None = None,
                as_double: bool = False) -> str:
    cols = []
    for s in slots:
        e = f"max(CASE WHEN {slot_col} = '{s}' THEN {value} END)"
        if fill is not None:
            e = f"coalesce({e}, {fill})"
        if as_double:
            e = f"CAST({e} AS DOUBLE)"
        cols.append(f"{e} AS {prefix}{s}")
    return ",\n  ".join(cols)


ORACLE["reading_normalise"] = _with(V_READINGS_SRC, _readings_view()) + f"SELECT {READING_COLS} FROM readings"
ORACLE["reading_normalise_text"] = _with(
    V_READINGS_SRC, _readings_view("CAST(reading AS VARCHAR)", "CASE WHEN interval_min = 15 THEN '4' ELSE '1' END")
) + f"SELECT {READING_COLS.replace('CAST(rm AS DOUBLE) AS rm', 'rm')} FROM readings"
ORACLE["reading_scan_sql"] = _with(V_READINGS_SRC) + """SELECT point_id AS serv_pnt_id, account_id AS serv_acct_id,
  period_count AS periodcount, interval_min AS interval_measure, reading AS rdng_meas, channel AS rdng_chnl_num,
  read_date AS pcfc_day_per_dt, read_time AS rdng_dttm, slot_ts AS pcfc_qtr_hr_per_strt_dttm,
  hour_ts AS pcfc_hr_per_strt_dttm, unit_raw AS unit_of_meas_cd, status_raw AS status, outage AS outage_ind
FROM readings_src WHERE read_date BETWEEN '2024-01-19' AND '2024-01-22' AND interval_min = 15
  AND channel IN (1101, 1102, 1103, 9104)"""
ORACLE["accounts_filter"] = _with(V_DIMS) + "SELECT account_id, plan_code, plan_id FROM accounts WHERE plan_code <> 'MACHINERY'"
ORACLE["plans_clean"] = _with(V_DIMS) + "SELECT plan_id, trim(use_type) AS use_type FROM plans"
ORACLE["seasons_clean"] = _with(V_DIMS) + """SELECT use_type, CAST(start_date AS VARCHAR) AS season_start,
  CAST(end_date AS VARCHAR) AS season_end, season AS si FROM seasons"""
ORACLE["calendar_filter"] = _with(V_DIMS) + """SELECT CAST(cal_date AS VARCHAR) AS cal_date, day_type FROM calendar
WHERE cal_date BETWEEN DATE '2024-01-19' AND DATE '2024-01-22'"""


def _daypart_sql(as_of: str) -> str:
    return _with(V_DAYPARTS_SRC) + f"""SELECT coalesce(trim(part_raw), '') AS pi, plan_id,
  strftime(t0_local + INTERVAL 8 HOUR, '%H:%M:%S') AS t0, strftime(t1_local + INTERVAL 8 HOUR, '%H:%M:%S') AS t1,
  trim(day_type) AS day_type, trim(season) AS season
FROM dayparts_src
WHERE trim(part_raw) IN ('MID', 'OFF', 'ON', 'SOF')
  AND trim(measure_raw) IN ('KWHSFP', 'KWHSNP', 'KWHSMP', 'KWHWFP', 'KWHWNP', 'KWHWMP', 'KWHSSP', 'KWHWSP')
  AND DATE '{as_of}' >= valid_from AND DATE '{as_of}' <= valid_to - INTERVAL 1 DAY"""


ORACLE["daypart_asof"] = _daypart_sql("2024-01-05")
ORACLE["daypart_asof_late"] = _daypart_sql("2024-01-15")

_ENRICHED_COLS = READING_COLS + ", si, CAST(cal_date AS VARCHAR) AS cal_date, pi"
ORACLE["enrich_range_calendar"] = ENRICHED + f"SELECT {_ENRICHED_COLS} FROM enriched"
ORACLE["enrich_split_hot_accounts"] = ENRICHED + f"SELECT {_ENRICHED_COLS} FROM enriched"
ORACLE["enrich_bucketed"] = ORACLE["enrich_ordered_ranges"] = ORACLE["enrich_range_calendar"]
ORACLE["orders_in_periods"] = """SELECT a.o_orderkey, CAST(CAST(a.o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
  b.o_orderkey AS period_key, CAST(CAST(b.o_orderdate AS DATE) + 120 AS VARCHAR) AS closes
FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey AND CAST(a.o_orderdate AS DATE) >= CAST(b.o_orderdate AS DATE)
  AND CAST(a.o_orderdate AS DATE) < CAST(b.o_orderdate AS DATE) + 120"""
ORACLE["enrich_day_calendar"] = ENRICHED_DAY + f"SELECT {_ENRICHED_COLS} FROM enriched"
ORACLE["slot_list"] = ENRICHED + "SELECT DISTINCT qtr_intr FROM enriched WHERE qtr_intr IS NOT NULL"
ORACLE["hour_list"] = ENRICHED + "SELECT DISTINCT hr_intr FROM enriched WHERE hr_intr IS NOT NULL"

_RK = "sa, sp, im, uom, pc, pfd, rd, si, rsc"
ORACLE["reading_pivot"] = ENRICHED + f"""SELECT {_RK},
  {_pivot_cols('qtr_intr', 'rm', QUARTER_SLOTS, 's', '0', True)},
  'rdng_meas' AS rec_type
FROM enriched GROUP BY {_RK}"""
ORACLE["reading_pivot_text"] = ENRICHED + f"""SELECT {_RK},
  {_pivot_cols('qtr_intr', 'CAST(rm AS VARCHAR)', QUARTER_SLOTS, 's')},
  'rdng_meas' AS rec_type
FROM enriched GROUP BY {_RK}"""
ORACLE["reading_pivot_text_numeric"] = ENRICHED + f"""SELECT {_RK},
  {_pivot_cols('qtr_intr', 'CAST(CAST(rm AS VARCHAR) AS DOUBLE)', QUARTER_SLOTS, 's', '0', True)},
  'rdng_meas' AS rec_type
FROM enriched GROUP BY {_RK}"""
ORACLE["hourly_sum"] = ENRICHED + """SELECT sa, sp, uom, rd, hr_intr, im, CAST(round(sum(rm), 4) AS DOUBLE) AS hs
FROM enriched GROUP BY sa, sp, uom, rd, hr_intr, im"""
_hcols = ",\n  ".join(
    f"coalesce(CAST(round(sum(CASE WHEN hr_intr = '{h}' THEN rm END), 4) AS DOUBLE), 0) AS h{h}" for h in HOURS)
ORACLE["hourly_pivot"] = ENRICHED + f"""SELECT sa, sp, uom, rd, im,
  {_hcols},
  'hrly_sum' AS rec_type
FROM enriched GROUP BY sa, sp, uom, rd, im"""
ORACLE["daily_sum"] = ENRICHED + """SELECT sa, sp, rd, im, uom, CAST(round(sum(rm), 4) AS DOUBLE) AS ds,
  'daily_sum' AS rec_type FROM enriched GROUP BY sa, sp, rd, im, uom"""
ORACLE["daily_sum_day_calendar"] = ENRICHED_DAY + """SELECT sa, sp, rd, im, uom, CAST(round(sum(rm), 4) AS DOUBLE) AS ds,
  'daily_sum' AS rec_type FROM enriched GROUP BY sa, sp, rd, im, uom"""
ORACLE["daily_demand"] = ENRICHED + """SELECT sa, sp, rd, pfd, im, demand_factor,
  max(CAST(rm AS DOUBLE)) * demand_factor AS dmkd, 'daily_max' AS rec_type,
  pfd || ' 00:00:00' AS mstkd, CAST(CAST(pfd AS DATE) + INTERVAL 1 DAY AS DATE) || ' 00:00:00' AS metkd
FROM enriched WHERE uom = 'kd' GROUP BY sa, sp, rd, pfd, im, demand_factor"""
ORACLE["peak_pivot"] = ENRICHED + f"""SELECT sa, sp, rd, im,
  {_pivot_cols('qtr_intr', 'pi', QUARTER_SLOTS, 's')},
  'peak_ind' AS rec_type
FROM enriched GROUP BY sa, sp, rd, im"""
ORACLE["outage_pivot"] = ENRICHED + f"""SELECT sa, sp, rd, im,
  {_pivot_cols('qtr_intr', 'oi', QUARTER_SLOTS, 's', '0')},
  'outage_ind' AS rec_type
FROM enriched GROUP BY sa, sp, rd, im"""
ORACLE["status_pivot"] = ENRICHED + f"""SELECT sa, sp, uom, rd, im,
  {_pivot_cols('qtr_intr', 'st', QUARTER_SLOTS, 's')},
  'status' AS rec_type
FROM enriched GROUP BY sa, sp, uom, rd, im"""

# ---- column profile, frequencies, dedup -------------------------------------------------

# Column lists of the profiled driver tables (schemas in FIXTURES.md section B).
PROFILED = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
}


def _profile_sql(table: str, report: bool = False) -> str:
    parts = []
    for c in PROFILED[table]:
        v = f"CAST({c} AS VARCHAR)"
        distinct = f"(count(DISTINCT {v}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))"
        measures = {
            "is_distinct": f"count(*) = {distinct}",
            "has_blanks": f"coalesce(bool_or(regexp_full_match({v}, '\\s*')), false)",
            "has_nulls": f"coalesce(bool_or({c} IS NULL), false)",
        }
        if report:
            flags = ", ".join(f"CASE WHEN {e} THEN 'TRUE' ELSE 'FALSE' END AS {k}" for k, e in measures.items())
        else:
            flags = ", ".join(f"{e} AS {k}" for k, e in measures.items())
        tail = "" if report else f", count(*) AS row_count, {distinct} AS distinct_count"
        parts.append(
            f"SELECT 'testdata' AS db, '{table}' AS table_name, '{c}' AS column_name, {flags},\n"
            f"  CAST(max(length(coalesce({v}, 'None'))) AS INTEGER) AS max_length,\n"
            f"  CAST(min(length(coalesce({v}, 'None'))) AS INTEGER) AS min_length{tail}\nFROM {table}")
    return "\nUNION ALL\n".join(parts)


ORACLE["column_profile"] = _profile_sql("customer")
ORACLE["column_profile_events"] = _profile_sql("events")
ORACLE["column_profile_documents"] = _profile_sql("documents")
ORACLE["column_profile_lineitem"] = _profile_sql("lineitem")
ORACLE["report_round_trip"] = _profile_sql("customer", report=True)

ORACLE["profile_merged_months"] = f"""SELECT db, table_name, column_name,
  CASE WHEN exact THEN is_distinct END AS is_distinct, has_blanks, has_nulls, max_length, min_length, row_count,
  CASE WHEN exact THEN distinct_count END AS distinct_count, exact
FROM (SELECT *, column_name IN ('event_id', 'user_id') AS exact FROM ({_profile_sql("events")}))"""

ORACLE["value_frequency"] = """SELECT event_type, count(event_type) AS cnt FROM events GROUP BY event_type
ORDER BY cnt DESC, event_type ASC NULLS FIRST LIMIT 10"""
ORACLE["value_frequency_top"] = """SELECT user_id, count(user_id) AS cnt FROM events GROUP BY user_id
ORDER BY cnt DESC, user_id ASC NULLS FIRST LIMIT 10"""
ORACLE["value_frequency_nulls"] = _with(V_READINGS_SRC) + """SELECT status_raw AS status, count(status_raw) AS cnt
FROM readings_src GROUP BY status_raw ORDER BY cnt DESC, status_raw ASC NULLS FIRST LIMIT 10"""
ORACLE["value_frequency_nulls_counted"] = _with(V_READINGS_SRC) + """SELECT status_raw AS status, count(*) AS cnt
FROM readings_src GROUP BY status_raw ORDER BY cnt DESC, status_raw ASC NULLS FIRST LIMIT 10"""
ORACLE["group_count"] = _with(V_READINGS_SRC) + """SELECT n_groups, n_groups > 1 AS several FROM (
  SELECT CAST(count(DISTINCT status_raw) + max(CASE WHEN status_raw IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_groups
  FROM readings_src) g"""

_ORDERS = ("o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
           "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate, o_orderpriority")
ORACLE["dedup_first"] = f"""SELECT {_ORDERS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS FIRST,
    o_orderkey ASC NULLS FIRST) AS rn FROM orders) t WHERE rn = 1"""
ORACLE["dedup_first_window"] = ORACLE["dedup_first"]
ORACLE["dedup_last"] = f"""SELECT {_ORDERS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST,
    o_orderkey DESC NULLS LAST) AS rn FROM orders) t WHERE rn = 1"""
ORACLE["dedup_any"] = "SELECT DISTINCT o_custkey FROM orders"
ORACLE["column_match"] = """SELECT l_orderkey, l_linenumber,
  CASE WHEN o_orderstatus = l_linestatus THEN l_linestatus ELSE 'no match' END AS status_match
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

# ---- tokens and streams ------------------------------------------------------------------

ORACLE["token_sort"] = """SELECT CAST(t AS BIGINT) AS num, 1 AS unit_count FROM (
  SELECT unnest(string_split(trim(regexp_replace(props, '[^0-9]+', ' ', 'g')), ' ')) AS t FROM events) s"""
_WORDS = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"
ORACLE["word_count"] = f"SELECT word, count(*) AS cnt FROM ({_WORDS}) w GROUP BY word"
ORACLE["stream_batch_words"] = f"SELECT word, count(*) AS cnt, 0 AS batch_id FROM ({_WORDS}) w GROUP BY word"
ORACLE["stream_batch_total"] = f"SELECT count(*) AS total, 0 AS batch_id FROM ({_WORDS}) w"

# ---- sinks -------------------------------------------------------------------------------

ORACLE["json_round_trip"] = ORACLE["daily_sum"]
ORACLE["interval_job_status_records"] = ORACLE["status_pivot"]

# ---- whole event range, day-matched calendar; interval 60 --------------------------------

ALL_DAYS = ("2024-01-01", "2024-12-31")
ENRICHED_ALL = _with(V_READINGS_SRC, _readings_view(window=ALL_DAYS), V_DIMS,
                     _enriched_view(day_match=True, window=ALL_DAYS))
ENRICHED_ALL_60 = _with(V_READINGS_SRC, _readings_view(window=ALL_DAYS, interval=60), V_DIMS,
                        _enriched_view(day_match=True, window=ALL_DAYS))
ORACLE["enrich_all_days"] = ENRICHED_ALL + f"SELECT {_ENRICHED_COLS} FROM enriched"
ORACLE["daily_sum_all_days"] = ENRICHED_ALL + """SELECT sa, sp, rd, im, uom, CAST(round(sum(rm), 4) AS DOUBLE) AS ds,
  'daily_sum' AS rec_type FROM enriched GROUP BY sa, sp, rd, im, uom"""
ORACLE["hourly_pivot_all_days"] = ENRICHED_ALL + f"""SELECT sa, sp, uom, rd, im,
  {_hcols},
  'hrly_sum' AS rec_type
FROM enriched GROUP BY sa, sp, uom, rd, im"""
ORACLE["reading_pivot_interval60"] = ENRICHED_ALL_60 + f"""SELECT {_RK},
  {_pivot_cols('qtr_intr', 'rm', HOUR_SLOTS, 's', '0', True)},
  'rdng_meas' AS rec_type
FROM enriched GROUP BY {_RK}"""
ORACLE["status_pivot_interval60"] = ENRICHED_ALL_60 + f"""SELECT sa, sp, uom, rd, im,
  {_pivot_cols('qtr_intr', 'st', HOUR_SLOTS, 's')},
  'status' AS rec_type
FROM enriched GROUP BY sa, sp, uom, rd, im"""


def _frequencies_sql(table: str, n: int = 10) -> str:
    per_col = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count({c}) AS cnt FROM {table} GROUP BY {c}"
        for c in PROFILED[table])
    return f"""SELECT column_name, value, cnt, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY cnt DESC, value ASC NULLS FIRST) AS rank
  FROM ({per_col}) c) r WHERE rank <= {n}"""


ORACLE["value_frequency_all_columns"] = _frequencies_sql("customer")


# ---- observed slots, text mode, malformed values, raw day parts, reruns --------------------

_QUARTER = "CAST(floor(extract(minute FROM ts) / 15) * 15 AS INTEGER)"
V_READINGS_OFFGRID = V_READINGS_SRC.replace(
    _QUARTER, f"CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN extract(minute FROM ts) ELSE {_QUARTER} END")
assert V_READINGS_OFFGRID != V_READINGS_SRC
ONE_DAY = ("2024-01-19", "2024-01-19")
_TEXT_READINGS = _readings_view("CAST(reading AS VARCHAR)", "CASE WHEN interval_min = 15 THEN '4' ELSE '1' END", ONE_DAY)
OFFGRID = _with(V_READINGS_OFFGRID, _readings_view(window=ONE_DAY), V_DIMS, _enriched_view(window=ONE_DAY))
OFFGRID_TEXT = _with(V_READINGS_OFFGRID, _TEXT_READINGS, V_DIMS, _enriched_view(window=ONE_DAY))
_SLOTS = "(SELECT DISTINCT qtr_intr AS slot FROM enriched WHERE qtr_intr IS NOT NULL) s"
_SK = "sa, sp, uom, rd, im"
ORACLE["reading_pivot_offgrid"] = OFFGRID + f"""SELECT {_RK}, slot,
  coalesce(CAST(max(CASE WHEN qtr_intr = slot THEN rm END) AS DOUBLE), 0) AS cell
FROM enriched CROSS JOIN {_SLOTS} GROUP BY {_RK}, slot"""
ORACLE["reading_pivot_offgrid_text"] = OFFGRID_TEXT + f"""SELECT {_RK}, slot, max(CASE WHEN qtr_intr = slot THEN rm END) AS cell
FROM enriched CROSS JOIN {_SLOTS} GROUP BY {_RK}, slot"""
ORACLE["status_pivot_offgrid"] = OFFGRID + f"""SELECT {_SK}, slot, max(CASE WHEN qtr_intr = slot THEN st END) AS cell
FROM enriched CROSS JOIN {_SLOTS} GROUP BY {_SK}, slot"""
ORACLE["peak_pivot_filled"] = ENRICHED + f"""SELECT sa, sp, rd, im,
  {_pivot_cols('qtr_intr', 'pi', QUARTER_SLOTS, 's', "'-'")},
  'peak_ind' AS rec_type
FROM enriched GROUP BY sa, sp, rd, im"""


def _cells_sql(rec_type: str, keys: str, value: str, names: str, name: str, text: bool, fill: str | None = None) -> str:
    """One row per key and name: the pivoted record's fields that are stored."""
    cell = f"max(CASE WHEN {names} = name THEN {value} END)" if names else value
    cell = cell if fill is None else f"coalesce({cell}, {fill})"
    cross = f" CROSS JOIN (SELECT DISTINCT {names} AS name FROM enriched WHERE {names} IS NOT NULL) n" if names else f" CROSS JOIN (SELECT '{name}' AS name) n"
    num, txt = ("CAST(NULL AS DOUBLE)", cell) if text else (f"CAST({cell} AS DOUBLE)", "CAST(NULL AS VARCHAR)")
    where = " WHERE uom = 'kd'" if rec_type == "daily_max" else ""
    return f"""SELECT * FROM (SELECT '{rec_type}' AS rec_type, concat_ws('|', {keys}) AS key, name, {num} AS num, {txt} AS txt
FROM enriched{cross}{where} GROUP BY {keys}, name) t WHERE num IS NOT NULL OR txt IS NOT NULL"""


_DK = "sa, sp, rd, pfd, im, demand_factor"
_IK = "sa, sp, rd, im"
ORACLE["interval_job_all_records"] = OFFGRID_TEXT + "\nUNION ALL\n".join([
    _cells_sql("rdng_meas", _RK, "rm", "qtr_intr", "", False),
    f"""SELECT 'hrly_sum' AS rec_type, concat_ws('|', {_SK}) AS key, hr_intr AS name, round(sum(CAST(rm AS DOUBLE)), 4) AS num,
  CAST(NULL AS VARCHAR) AS txt FROM enriched WHERE hr_intr IS NOT NULL GROUP BY {_SK}, hr_intr HAVING sum(CAST(rm AS DOUBLE)) IS NOT NULL""",
    _cells_sql("daily_sum", "sa, sp, rd, im, uom", "round(sum(CAST(rm AS DOUBLE)), 4)", "", "ds", False),
    _cells_sql("daily_max", _DK, "max(CAST(rm AS DOUBLE)) * CAST(demand_factor AS INTEGER)", "", "dmkd", False),
    _cells_sql("daily_max", _DK, "max(pfd) || ' 00:00:00'", "", "mstkd", True),
    _cells_sql("daily_max", _DK, "CAST(CAST(max(pfd) AS DATE) + INTERVAL 1 DAY AS DATE) || ' 00:00:00'", "", "metkd", True),
    _cells_sql("peak_ind", _IK, "pi", "qtr_intr", "", True),
    _cells_sql("outage_ind", _IK, "oi", "qtr_intr", "", False, "0"),
    _cells_sql("status", _SK, "st", "qtr_intr", "", True),
])

V_READINGS_MALFORMED = V_READINGS_SRC.replace(
    "value AS reading", "CASE WHEN event_id % 19 = 0 THEN 'x1' ELSE CAST(value AS VARCHAR) END AS reading")
assert V_READINGS_MALFORMED != V_READINGS_SRC
ORACLE["hourly_sum_lenient"] = _with(
    V_READINGS_MALFORMED, _readings_view("reading", "CASE WHEN interval_min = 15 THEN '4' ELSE '1' END"), V_DIMS, _enriched_view()
) + """SELECT sa, sp, uom, rd, hr_intr, im, round(sum(TRY_CAST(rm AS DOUBLE)), 4) AS hs
FROM enriched GROUP BY sa, sp, uom, rd, hr_intr, im"""
ORACLE["daily_sum_lenient_typed"] = _with(
    V_READINGS_MALFORMED, _readings_view("TRY_CAST(reading AS DECIMAL(18,4))"), V_DIMS, _enriched_view()
) + """SELECT sa, sp, rd, im, uom, CAST(round(sum(rm), 4) AS DOUBLE) AS ds, 'daily_sum' AS rec_type
FROM enriched GROUP BY sa, sp, rd, im, uom"""

# Local bounds in Los Angeles: eight hours behind UTC in January, seven in July.
V_RAW_PARTS = """raw_parts AS (
  SELECT n_nationkey AS plan_id, p.part, p.day_type, p.season,
    strftime(p.t0 + INTERVAL 1 HOUR * p.shift, '%H:%M:%S') AS t0, strftime(p.t1 + INTERVAL 1 HOUR * p.shift, '%H:%M:%S') AS t1
  FROM nation CROSS JOIN (
    SELECT 'OFF' AS part, TIMESTAMP '2017-01-01 16:00:00' AS t0, TIMESTAMP '2017-01-01 18:00:00' AS t1, 8 AS shift, 'WD' AS day_type, 'W' AS season
    UNION ALL SELECT 'MID', TIMESTAMP '2017-01-01 02:00:00', TIMESTAMP '2017-01-01 06:00:00', 8, 'WD', 'W'
    UNION ALL SELECT 'ON', TIMESTAMP '2017-01-01 06:00:00', TIMESTAMP '2017-01-01 09:00:00', 8, 'WD', 'W'
    UNION ALL SELECT 'ON', TIMESTAMP '2017-01-01 06:00:00', TIMESTAMP '2017-01-01 09:00:00', 8, 'WD', 'W'
    UNION ALL SELECT 'SOF', TIMESTAMP '2017-07-01 07:00:00', TIMESTAMP '2017-07-01 12:00:00', 7, 'WE', 'S'
    UNION ALL SELECT 'MID', TIMESTAMP '2017-07-01 12:00:00', TIMESTAMP '2017-07-01 16:59:59', 7, 'WE', 'S') p)"""


def _raw_parts_sql(parts: str, inside: str) -> str:
    view = _enriched_view(day_match=True, window=ALL_DAYS)
    condition = "r.qtr_intr_10 >= d.t0 AND r.qtr_intr_10 <= d.t1"
    assert condition in view
    view = view.replace("LEFT JOIN dayparts d", f"LEFT JOIN {parts} d").replace(condition, inside)
    return _with(V_READINGS_SRC, _readings_view(window=ALL_DAYS), V_DIMS, V_RAW_PARTS, view) + (
        "SELECT rd, qtr_intr, si, pi, count(*) AS readings FROM enriched GROUP BY rd, qtr_intr, si, pi")


ORACLE["raw_dayparts"] = _raw_parts_sql("raw_parts", "r.qtr_intr_10 >= d.t0 AND r.qtr_intr_10 <= d.t1")
# a part's last moment belongs to the part that begins then, if there is one
ORACLE["raw_dayparts_unique"] = _raw_parts_sql(
    """(SELECT DISTINCT a.*, EXISTS (SELECT 1 FROM raw_parts b WHERE b.plan_id = a.plan_id AND b.day_type = a.day_type
      AND b.season = a.season AND b.t0 = a.t1) AS open_end FROM raw_parts a)""",
    "substr(r.qtr_intr_10, 1, 8) >= d.t0 AND (substr(r.qtr_intr_10, 1, 8) < d.t1 OR (NOT d.open_end AND substr(r.qtr_intr_10, 1, 8) = d.t1))")
ORACLE["raw_dayparts_wrap"] = _raw_parts_sql(
    "raw_parts", """CASE WHEN d.t0 <= d.t1 THEN substr(r.qtr_intr_10, 1, 8) >= d.t0 AND substr(r.qtr_intr_10, 1, 8) <= d.t1
      ELSE substr(r.qtr_intr_10, 1, 8) >= d.t0 OR substr(r.qtr_intr_10, 1, 8) <= d.t1 END""")

ORACLE["json_rerun_empties"] = ENRICHED + """SELECT sa, sp, rd, CAST(round(sum(rm), 4) AS DOUBLE) AS ds, uom,
  'daily_sum' AS rec_type, '2024-01-22' AS dt, '15' AS im FROM enriched GROUP BY sa, sp, rd, im, uom"""
ORACLE["stream_part_words"] = """SELECT part, word, count(*) AS cnt FROM (
  SELECT CAST(doc_id % 3 AS INTEGER) AS part, unnest(string_split(text, ' ')) AS word FROM documents) w GROUP BY part, word
UNION ALL SELECT -1, 'batches', 4"""
ORACLE["partition_rows"] = "SELECT CAST(count(*) AS BIGINT) AS rows FROM events"

# ---- grains, quarantine, order, publication, compaction, runs --------------------------------

ORACLE["sums_by_grain"] = ENRICHED_ALL + """SELECT sa, sp, im, uom, rd || hr_intr AS period, CAST(round(sum(rm), 4) AS DOUBLE) AS total
FROM enriched GROUP BY sa, sp, im, uom, rd || hr_intr
UNION ALL SELECT sa, sp, im, uom, rd, CAST(round(sum(rm), 4) AS DOUBLE) FROM enriched GROUP BY sa, sp, im, uom, rd
UNION ALL SELECT sa, sp, im, uom, substr(rd, 1, 6), CAST(round(sum(rm), 4) AS DOUBLE) FROM enriched GROUP BY sa, sp, im, uom, substr(rd, 1, 6)"""
ORACLE["readings_quarantine"] = _with(
    V_READINGS_MALFORMED,
    _readings_view("CAST(reading AS DECIMAL(18,4))").replace("FROM readings_src\n", "FROM readings_src WHERE reading <> 'x1' OR reading IS NULL\n")
    .replace("IS NULL\n  WHERE", "IS NULL)\n  AND").replace("WHERE reading <>", "WHERE (reading <>")) + """
SELECT 'good' AS side, uom AS name, CAST(NULL AS VARCHAR) AS raw, CAST(sum(rm) AS DOUBLE) AS total, count(*) AS rows
FROM readings GROUP BY uom
UNION ALL SELECT 'malformed', 'value', reading, NULL, count(*) FROM readings_src WHERE reading = 'x1' GROUP BY reading"""
ORACLE["daily_sum_in_order"] = f"""SELECT *, row_number() OVER (
  ORDER BY sa NULLS FIRST, sp NULLS FIRST, rd NULLS FIRST, uom NULLS FIRST) AS position FROM ({ORACLE["daily_sum_all_days"]})"""
ORACLE["published_rerun"] = ORACLE["daily_sum"]
ORACLE["stream_compacted"] = """SELECT word, count(*) AS cnt, batch_id FROM (
  SELECT unnest(string_split(text, ' ')) AS word, doc_id % 6 AS batch_id FROM documents) w GROUP BY word, batch_id"""
ORACLE["dedup_across_runs"] = ORACLE["dedup_first"]
ORACLE["value_frequency_bounded"] = """SELECT CAST(l_partkey AS VARCHAR) AS value, count(*) AS cnt,
  CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) AS INTEGER) AS rank, true AS certain
FROM lineitem GROUP BY l_partkey ORDER BY rank LIMIT 20"""
ORACLE["text_lines"] = """SELECT word, count(*) AS cnt FROM (
  SELECT unnest(string_split(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), ' ')) AS word FROM documents WHERE text IS NOT NULL) w GROUP BY word"""
ORACLE["json_max_files"] = f"SELECT count(*) AS rows, 3 AS files FROM ({ORACLE['daily_sum']}) d"
