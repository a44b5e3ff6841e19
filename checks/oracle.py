"""DuckDB SQL with the results of the queries in ``checks.registry``.

The SQL is written from the payroll rules, on the test tables alone.
"""

from __future__ import annotations

BLANKS = "' ' || chr(9)"

CUSTOMER_EMPLOYEES = """
customer_employees AS (
  SELECT c_custkey AS id, 'Customer' AS first_name, c_name AS last_name,
    CASE WHEN c_custkey % 10 = 7 THEN 'former' || c_custkey || '@example.org'
         ELSE 'cust' || c_custkey || '@example.com' END AS email,
    c_mktsegment AS department,
    CAST(20 + c_custkey % 60 AS DECIMAL(10,2)) AS hourly_rate,
    'FR76' || lpad(CAST(c_custkey AS VARCHAR), 30, '0') AS bank_account
  FROM customer)"""

EVENT_ROWS = """
event_rows AS (
  SELECT event_id, user_id, ts,
    CASE WHEN event_id % 5 = 0 THEN ' cust' || user_id || '@example.com' || chr(9)
         ELSE 'cust' || user_id || '@example.com' END AS email,
    CASE WHEN event_id % 97 = 0 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d') END AS work_date,
    CASE WHEN event_id % 89 = 0 THEN 'not-a-number' WHEN event_id % 83 = 0 THEN '0.00'
         ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END AS hours_worked
  FROM events)"""

SHEET = f"""
sheet AS (
  SELECT event_id, user_id, ts, CAST(202401 AS BIGINT) AS payroll_run_id,
    trim(email, {BLANKS}) AS email, trim(work_date, {BLANKS}) AS work_date,
    trim(hours_worked, {BLANKS}) AS hours_worked
  FROM event_rows)"""

CLASSIFIED = """
parsed AS (
  SELECT *, TRY_CAST(hours_worked AS DECIMAL(38,18)) AS hours_value,
    CASE WHEN regexp_full_match(work_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
         THEN TRY_CAST(work_date AS DATE) END AS day
  FROM sheet),
classified AS (
  SELECT p.*, e.id AS employee_id,
    CASE WHEN hours_value IS NULL THEN 'not_a_number'
         WHEN NOT (hours_value > 0 AND hours_value <= 24) THEN 'out_of_range'
         WHEN day IS NULL THEN 'bad_date'
         WHEN e.id IS NULL THEN 'unknown_email' ELSE 'ok' END AS outcome,
    CASE WHEN hours_value IS NULL THEN 'hours_worked is not a valid number: ' || hours_worked
         WHEN NOT (hours_value > 0 AND hours_value <= 24)
           THEN 'hours_worked must be > 0 and <= 24, was: ' || hours_worked
         WHEN day IS NULL THEN 'work_date is not a valid ISO date: ' || work_date
         WHEN e.id IS NULL THEN 'Unknown employee email: ' || p.email END AS reason
  FROM parsed p LEFT JOIN customer_employees e ON p.email = e.email)"""

EVENTS = ",".join([CUSTOMER_EMPLOYEES, EVENT_ROWS, SHEET, CLASSIFIED])

EVENT_ENTRIES = """
event_entries AS (
  SELECT employee_id, day AS work_date, CAST(hours_value AS DECIMAL(4,2)) AS hours_worked
  FROM classified WHERE outcome = 'ok')"""

EVENT_HOURS = """
event_runs AS (
  SELECT DISTINCT extract(year FROM ts) AS period_year, extract(month FROM ts) AS period_month
  FROM events),
event_hours AS (
  SELECT r.period_year * 100 + r.period_month AS payroll_run_id, t.employee_id, e.hourly_rate,
    CAST(sum(t.hours_worked) AS DECIMAL(14,2)) AS total_hours
  FROM event_runs r, event_entries t JOIN customer_employees e ON e.id = t.employee_id
  WHERE extract(year FROM t.work_date) = r.period_year
    AND extract(month FROM t.work_date) = r.period_month
  GROUP BY r.period_year, r.period_month, t.employee_id, e.hourly_rate)"""

SUPPLIER_EMPLOYEES = """
supplier_employees AS (
  SELECT s_suppkey AS id, 'Supplier' AS first_name, s_name AS last_name,
    'supp' || s_suppkey || '@example.com' AS email,
    'Nation ' || s_nationkey AS department,
    CAST(20 + s_suppkey % 60 AS DECIMAL(10,2)) AS hourly_rate
  FROM supplier)"""

LINEITEM_ENTRIES = """
lineitem_entries AS (
  SELECT l_suppkey AS employee_id, CAST(l_shipdate AS DATE) AS work_date,
    CAST(l_quantity AS DECIMAL(4,2)) AS hours_worked
  FROM lineitem WHERE l_quantity > 0 AND l_quantity <= 24)"""

MONTHLY_RUNS = """
months AS (
  SELECT DISTINCT extract(year FROM o_orderdate) AS period_year,
    extract(month FROM o_orderdate) AS period_month FROM orders),
monthly_runs AS (
  SELECT period_year * 100 + period_month AS id, period_year, period_month FROM months
  UNION ALL
  SELECT 1000000 + period_year * 100 + period_month, period_year, period_month
  FROM months WHERE period_year >= 2000)"""

RUN_ENTRIES = """
run_entries AS (
  SELECT r.id AS payroll_run_id, t.employee_id, t.work_date, t.hours_worked
  FROM monthly_runs r, lineitem_entries t
  WHERE extract(year FROM t.work_date) = r.period_year
    AND extract(month FROM t.work_date) = r.period_month)"""

LINEITEM_HOURS = """
lineitem_hours AS (
  SELECT t.payroll_run_id, t.employee_id, e.hourly_rate,
    CAST(sum(t.hours_worked) AS DECIMAL(14,2)) AS total_hours
  FROM run_entries t JOIN supplier_employees e ON e.id = t.employee_id
  GROUP BY t.payroll_run_id, t.employee_id, e.hourly_rate)"""

LINEITEMS = ",".join([SUPPLIER_EMPLOYEES, LINEITEM_ENTRIES, MONTHLY_RUNS, RUN_ENTRIES, LINEITEM_HOURS])

ROUTED = """
flags AS (
  SELECT r.id AS payroll_run_id,
    count(h.employee_id) FILTER (WHERE h.total_hours > 150) AS anomaly_employee_count
  FROM monthly_runs r LEFT JOIN lineitem_hours h ON h.payroll_run_id = r.id GROUP BY r.id),
routed AS (
  SELECT payroll_run_id, anomaly_employee_count, anomaly_employee_count > 0 AS has_anomalies,
    CASE WHEN anomaly_employee_count > 0 THEN 'REVIEW_REQUIRED' ELSE 'PROCEED' END AS route
  FROM flags)"""

ORDER_RUNS = """
order_runs AS (
  SELECT o_orderkey AS id, extract(month FROM o_orderdate) AS period_month,
    extract(year FROM o_orderdate) AS period_year,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'STARTED'
         ELSE 'AWAITING_REVIEW' END AS status,
    o_orderdate AS started_at
  FROM orders)"""

RANGES = """
bounds AS (SELECT min(id) AS low, max(id) AS high FROM {employees}),
width AS (SELECT low, high, (high - low + 4) // 4 AS width FROM bounds),
ranges AS (
  SELECT n AS range_id, low + n * width AS min_id, least(low + n * width + width - 1, high) AS max_id
  FROM width, (SELECT unnest([0, 1, 2, 3]) AS n)
  WHERE low + n * width <= high)"""


def _slips(hours: str, overtime: str = "160", rate: str = "0.15") -> str:
    """Payslip CTE ``slips`` over a CTE of hours."""
    return f"""
grossed AS (
  SELECT payroll_run_id, employee_id, total_hours,
    CAST(round(CASE WHEN total_hours <= {overtime} THEN total_hours * hourly_rate
         ELSE {overtime} * hourly_rate
              + (total_hours - {overtime}) * hourly_rate * 1.5 END, 2) AS DECIMAL(24,2)) AS gross_pay
  FROM {hours}),
deducted AS (
  SELECT *, CAST(round(gross_pay * {rate}, 2) AS DECIMAL(24,2)) AS deductions FROM grossed),
slips AS (
  SELECT *, CAST(gross_pay - deductions AS DECIMAL(24,2)) AS net_pay FROM deducted)"""


STORED_SLIP = """CAST(total_hours AS DECIMAL(6,2)) AS total_hours,
  CAST(gross_pay AS DECIMAL(10,2)) AS gross_pay,
  CAST(deductions AS DECIMAL(10,2)) AS deductions,
  CAST(net_pay AS DECIMAL(10,2)) AS net_pay"""
SLIP = "payroll_run_id, employee_id, total_hours, gross_pay, deductions, net_pay"
DATE_TEXT = "CAST(work_date AS VARCHAR) AS work_date"
EVENT_WITH = f"WITH {EVENTS}"
LINEITEM_WITH = f"WITH {LINEITEMS}"
ROUTED_WITH = f"WITH {LINEITEMS}, {ROUTED}"


def _micros(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}"


def _rejects(outcome: str) -> str:
    return f"""{EVENT_WITH}
SELECT email, work_date, hours_worked, reason FROM classified WHERE outcome = '{outcome}'"""


def _import_metrics() -> str:
    return f"""{EVENT_WITH}
SELECT user_id AS payroll_run_id, count(*) AS items_read,
  count(*) FILTER (WHERE outcome = 'ok') AS items_written,
  count(*) FILTER (WHERE outcome <> 'ok') AS items_skipped,
  CAST(0 AS BIGINT) AS read_skips,
  count(*) FILTER (WHERE outcome <> 'ok') AS process_skips,
  CAST(0 AS BIGINT) AS write_skips
FROM classified GROUP BY user_id"""


def _broken(table: str, rule: str, key: str, source: str, condition: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule, CAST({key} AS VARCHAR) AS "key",
  CAST(1 AS BIGINT) AS violations FROM {source} WHERE {condition}"""


def _nulls(table: str, column: str, source: str, condition: str) -> str:
    return f"""SELECT '{table}' AS table_name, 'not_null' AS rule, '{column}' AS "key",
  count(*) AS violations FROM {source} WHERE {condition} HAVING count(*) > 0"""


def _orphans(table: str, rule: str, keys: str, parents: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule, CAST(k AS VARCHAR) AS "key",
  count(*) AS violations FROM ({keys}) WHERE k NOT IN ({parents}) GROUP BY k"""


ORACLE: dict[str, str] = {
    # Reading and checking of timesheet rows.
    "csv_import": f"WITH {EVENT_ROWS}, {SHEET} SELECT email, work_date, hours_worked FROM sheet",
    "malformed_lines": f"""WITH {EVENT_ROWS}
SELECT CASE WHEN event_id % 71 = 0 THEN email || ',' || work_date
            ELSE email || ',' || work_date || ',' || hours_worked || ',extra' END AS raw_line,
  'wrong number of fields, expected 3' AS reason
FROM event_rows WHERE event_id % 71 = 0 OR event_id % 73 = 0""",
    "lineage_counts": f"""{EVENT_WITH}
SELECT '2024-02-01 03:00:00.000000' AS imported_at, count(*) AS entries, count(*) AS entries_of_csv_files
FROM classified WHERE outcome = 'ok'""",
    "lineage_of_rows": f"""{EVENT_WITH}
SELECT employee_id, CAST(day AS VARCHAR) AS work_date, CAST(hours_value AS DECIMAL(4,2)) AS hours_worked,
  'batch-' || (event_id % 3) AS file FROM classified WHERE outcome = 'ok'""",
    "normalise_raw": f"""WITH {EVENT_ROWS}
SELECT event_id, trim(email, {BLANKS}) AS email,
  CASE WHEN event_id % 79 = 0 THEN '' ELSE work_date END AS work_date,
  CASE WHEN event_id % 61 = 0 THEN '' ELSE hours_worked END AS hours_worked
FROM event_rows""",
    "reject_not_number": _rejects("not_a_number"),
    "reject_out_of_range": _rejects("out_of_range"),
    "reject_bad_date": _rejects("bad_date"),
    "resolve_employee": f"""{EVENT_WITH}
SELECT email, work_date, hours_worked, employee_id FROM classified""",
    "unknown_emails": f"""{EVENT_WITH}
SELECT s.email, count(*) AS rows FROM sheet s
WHERE NOT EXISTS (SELECT 1 FROM customer_employees e WHERE e.email = s.email) GROUP BY s.email""",
    "import_classify": f"""{EVENT_WITH}
SELECT email, work_date, hours_worked, employee_id, outcome, reason FROM classified""",
    "import_accepted": f"""{EVENT_WITH}, {EVENT_ENTRIES}
SELECT employee_id, {DATE_TEXT}, hours_worked, extract(year FROM work_date) AS work_year,
  extract(month FROM work_date) AS work_month FROM event_entries""",
    "import_rejected": f"""{EVENT_WITH}
SELECT substr(email || ',' || work_date || ',' || hours_worked, 1, 500) AS raw_line,
  substr(reason, 1, 255) AS reason, payroll_run_id FROM classified WHERE outcome <> 'ok'""",
    "reject_record": """
WITH lines AS (
  SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS hours_worked
  FROM documents)
SELECT substr('cust' || doc_id || '@example.com,2024-01-15,' || hours_worked, 1, 500) AS raw_line,
  substr('hours_worked is not a valid number: ' || hours_worked, 1, 255) AS reason,
  CAST(202401 AS BIGINT) AS payroll_run_id
FROM lines""",
    "skip_limit_gate": f"""{EVENT_WITH}
SELECT user_id AS payroll_run_id, count(*) FILTER (WHERE outcome <> 'ok') AS rejected,
  CAST(50 AS BIGINT) AS skip_limit, count(*) FILTER (WHERE outcome <> 'ok') > 50 AS exceeded
FROM classified GROUP BY user_id""",
    "import_metrics": _import_metrics(),
    "reject_report": f"""{EVENT_WITH}
SELECT payroll_run_id, outcome AS reason_class, count(*) AS rejected
FROM classified WHERE outcome <> 'ok' GROUP BY payroll_run_id, outcome""",
    # Hours per employee and run.
    "period_entries": f"""WITH {LINEITEM_ENTRIES}
SELECT employee_id, {DATE_TEXT}, hours_worked FROM lineitem_entries
WHERE extract(year FROM work_date) = 1998 AND extract(month FROM work_date) = 3""",
    "entries_for_runs": f"""{LINEITEM_WITH}
SELECT payroll_run_id, employee_id, {DATE_TEXT}, hours_worked FROM run_entries""",
    "hours_by_employee": f"""{LINEITEM_WITH}
SELECT payroll_run_id, employee_id, hourly_rate, total_hours FROM lineitem_hours""",
    "hours_by_email": f"""{EVENT_WITH}, {EVENT_ENTRIES}, {EVENT_HOURS}
SELECT payroll_run_id, employee_id, hourly_rate, total_hours FROM event_hours""",
    "hours_in_id_range": f"""{LINEITEM_WITH}, {RANGES.format(employees="supplier_employees")}
SELECT CAST(g.range_id AS BIGINT) AS range_id, g.min_id, g.max_id, h.payroll_run_id, h.employee_id, h.total_hours
FROM lineitem_hours h JOIN ranges g ON h.employee_id BETWEEN g.min_id AND g.max_id""",
    "hours_between_ids": f"""{LINEITEM_WITH},
cut AS (SELECT (min(id) + max(id)) // 2 AS middle FROM supplier_employees)
SELECT CAST(employee_id > middle AS BIGINT) AS span, payroll_run_id, employee_id, total_hours
FROM lineitem_hours, cut""",
    "anomalous_employees": f"""{EVENT_WITH}, {EVENT_ENTRIES}, {EVENT_HOURS}
SELECT payroll_run_id, employee_id, total_hours FROM event_hours WHERE total_hours > 300""",
    # Payslips.
    "gross_pay": f"""{LINEITEM_WITH}, {_slips("lineitem_hours", "100")}
SELECT payroll_run_id, employee_id, gross_pay FROM grossed""",
    "payslips": f"""{EVENT_WITH}, {EVENT_ENTRIES}, {EVENT_HOURS}, {_slips("event_hours")}
SELECT {SLIP} FROM slips""",
    "payslips_many_runs": f"""{LINEITEM_WITH}, {_slips("lineitem_hours", "100")}
SELECT {SLIP} FROM slips""",
    "payroll_summary": f"""{LINEITEM_WITH}, {_slips("lineitem_hours", "100")}
SELECT payroll_run_id, employee_id, first_name, last_name, email, department,
  total_hours, gross_pay, deductions, net_pay
FROM slips JOIN supplier_employees e ON e.id = employee_id
ORDER BY payroll_run_id, employee_id""",
    # Review.
    "review_flags": f"""{ROUTED_WITH}
SELECT payroll_run_id, anomaly_employee_count, has_anomalies FROM routed""",
    "route_runs": f"{ROUTED_WITH} SELECT payroll_run_id, route FROM routed",
    "held_runs": f"""{ROUTED_WITH}
SELECT id, period_month, period_year, 'AWAITING_REVIEW' AS status
FROM monthly_runs JOIN routed ON payroll_run_id = id WHERE route = 'REVIEW_REQUIRED'""",
    "completed_runs": f"""{ROUTED_WITH}
SELECT id, period_month, period_year, 'COMPLETED' AS status,
  '2024-02-01 03:00:00.000000' AS completed_at
FROM monthly_runs JOIN routed ON payroll_run_id = id WHERE route = 'PROCEED'""",
    "payslips_released": f"""{ROUTED_WITH}, {_slips("lineitem_hours", "100")}
SELECT {SLIP} FROM slips JOIN routed USING (payroll_run_id) WHERE route = 'PROCEED'""",
    # Runs.
    "current_run_state": f"""
WITH states AS (
  SELECT event_id, user_id, ts,
    CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED'
         WHEN 'click' THEN 'AWAITING_REVIEW' ELSE 'STARTED' END AS status
  FROM events),
current AS (
  SELECT user_id AS id, arg_max(extract(month FROM ts), event_id) AS period_month,
    arg_max(extract(year FROM ts), event_id) AS period_year, arg_max(status, event_id) AS status,
    min(ts) AS started_at, max(ts) FILTER (WHERE status = 'COMPLETED') AS completed_at
  FROM states GROUP BY user_id)
SELECT id, period_month, period_year, status, {_micros("started_at")}, {_micros("completed_at")} FROM current""",
    "run_lookup": f"""WITH {ORDER_RUNS}
SELECT o_orderkey * 2 AS id, r.status,
  CASE WHEN r.id IS NULL THEN 'PayrollRun not found: ' || (o_orderkey * 2) END AS error
FROM orders LEFT JOIN order_runs r ON r.id = o_orderkey * 2""",
    "run_request_errors": """
SELECT o_orderkey AS id, concat_ws(',',
  CASE WHEN o_orderkey % 15 NOT BETWEEN 1 AND 12 THEN 'periodMonth' END,
  CASE WHEN 1990 + o_orderkey % 40 < 2000 THEN 'periodYear' END) AS invalid_fields
FROM orders""",
    "created_runs": """
SELECT o_orderkey AS id, o_orderkey % 15 AS period_month, 1990 + o_orderkey % 40 AS period_year,
  'STARTED' AS status, '2024-02-01 03:00:00.000000' AS started_at
FROM orders WHERE o_orderkey % 15 BETWEEN 1 AND 12 AND 1990 + o_orderkey % 40 >= 2000""",
    "resume_outcomes": f"""WITH {ORDER_RUNS}
SELECT o_orderkey * 2 AS id,
  CASE WHEN r.status = 'AWAITING_REVIEW' THEN 'STARTED' ELSE r.status END AS status,
  CASE WHEN r.id IS NULL THEN 'PayrollRun not found: ' || (o_orderkey * 2)
       WHEN r.status <> 'AWAITING_REVIEW' THEN 'PayrollRun ' || r.id
         || ' cannot be resumed: status is ' || r.status || ', expected AWAITING_REVIEW' END AS error
FROM orders LEFT JOIN order_runs r ON r.id = o_orderkey * 2""",
    "launch_guard": f"""WITH {ORDER_RUNS}
SELECT 'monthlyPayrollJob' AS job_name, id AS payroll_run_id, strftime(started_at, '%Y-%m') AS period
FROM order_runs WHERE status <> 'COMPLETED'
UNION ALL
SELECT 'payrollFinalizeJob', id, strftime(started_at, '%Y-%m') FROM order_runs""",
    "run_history_page": f"""WITH {ORDER_RUNS}
SELECT id, period_month, period_year, status, {_micros("started_at")}
FROM (SELECT * FROM order_runs ORDER BY started_at DESC, id LIMIT 20 OFFSET 60)""",
    "run_history_middle_page": f"""WITH {ORDER_RUNS},
placed AS (
  SELECT *, row_number() OVER (ORDER BY status, period_month DESC, id) - 1 AS place, count(*) OVER () AS total FROM order_runs)
SELECT id, status, period_month FROM placed WHERE place // 20 = ((total + 19) // 20) // 2""",
    "run_page_totals": """
SELECT count(*) AS total_elements, CAST((count(*) + 19) // 20 AS BIGINT) AS total_pages FROM orders""",
    "previous_period": """
SELECT o_orderkey AS id, strftime(o_orderdate - INTERVAL 1 MONTH, '%Y-%m') AS period FROM orders""",
    "execution_elapsed": """
SELECT user_id AS execution_id, coalesce((
    epoch_us(max(CASE WHEN event_id % 50 <> 0 THEN ts + to_seconds(event_id % 60) END))
    - epoch_us(min(ts))) // 1000, 0) AS elapsed_ms
FROM events GROUP BY user_id""",
    # Id ranges.
    "id_bounds": "SELECT min(c_custkey) AS min_id, max(c_custkey) AS max_id FROM customer",
    "id_ranges": f"""WITH {CUSTOMER_EMPLOYEES}, {RANGES.format(employees="customer_employees")}
SELECT CAST(range_id AS BIGINT) AS range_id, min_id, max_id FROM ranges""",
    "range_metrics": f"""{LINEITEM_WITH}, {RANGES.format(employees="supplier_employees")}
SELECT CAST(range_id AS BIGINT) AS range_id, min_id, max_id,
  count(employee_id) AS items_read, count(employee_id) AS items_written
FROM ranges LEFT JOIN lineitem_hours ON employee_id BETWEEN min_id AND max_id
GROUP BY range_id, min_id, max_id""",
    # Writing and reading back.
    "entries_roundtrip": f"""{EVENT_WITH}, {EVENT_ENTRIES}, {LINEITEM_ENTRIES},
both_sources AS (
  SELECT employee_id, work_date, hours_worked, 'events.csv' AS source_file FROM event_entries
  UNION ALL
  SELECT employee_id, work_date, hours_worked, 'lineitem' FROM lineitem_entries)
SELECT employee_id, {DATE_TEXT}, hours_worked, source_file,
  extract(year FROM b.work_date) AS work_year, extract(month FROM b.work_date) AS work_month
FROM both_sources b""",
    "month_sums": f"""{EVENT_WITH}, {EVENT_ENTRIES}, {LINEITEM_ENTRIES},
both_sources AS (SELECT * FROM event_entries UNION ALL SELECT * FROM lineitem_entries)
SELECT employee_id, extract(year FROM work_date) AS work_year, extract(month FROM work_date) AS work_month,
  CAST(sum(hours_worked) AS DECIMAL(14,2)) AS hours_worked
FROM both_sources GROUP BY ALL""",
    "repeated_job": f"""{EVENT_WITH}, {EVENT_ENTRIES}, {EVENT_HOURS}
SELECT payroll_run_id AS id, 'COMPLETED' AS status, count(*) AS payslips,
  CAST(sum(total_hours) AS DECIMAL(14,2)) AS total_hours,
  (SELECT count(*) FROM classified WHERE outcome <> 'ok') AS rejects
FROM event_hours GROUP BY payroll_run_id""",
    "rejects_roundtrip": f"""{EVENT_WITH}
SELECT substr(email || ',' || work_date || ',' || hours_worked, 1, 500) AS raw_line,
  substr(reason, 1, 255) AS reason, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS payroll_run_id
FROM classified WHERE outcome <> 'ok'""",
    "rejects_of_run": f"""{EVENT_WITH}
SELECT substr(email || ',' || work_date || ',' || hours_worked, 1, 500) AS raw_line,
  substr(reason, 1, 255) AS reason, CAST(202402 AS BIGINT) AS payroll_run_id
FROM classified WHERE outcome <> 'ok'""",
    "found_employees": f"""WITH {CUSTOMER_EMPLOYEES},
keys AS (SELECT min(c_custkey) AS low, max(c_custkey) AS high FROM customer GROUP BY c_nationkey)
SELECT found_by, id, email, department, hourly_rate FROM customer_employees
JOIN (SELECT 'id' AS found_by, low AS id FROM keys UNION ALL SELECT 'email', high FROM keys) USING (id)""",
    "payslips_rerun": f"""{LINEITEM_WITH},
before AS (SELECT * FROM lineitem_hours WHERE payroll_run_id < 199801),
after AS (SELECT * FROM lineitem_hours WHERE payroll_run_id >= 199801),
first_slips AS (WITH {_slips("before")} SELECT {SLIP} FROM slips),
second_slips AS (WITH {_slips("after", "100")} SELECT {SLIP} FROM slips)
SELECT payroll_run_id, employee_id, {STORED_SLIP}
FROM (SELECT * FROM first_slips UNION ALL SELECT * FROM second_slips)""",
    "summary_roundtrip": f"""{LINEITEM_WITH}, {_slips("lineitem_hours", "100")},
exported AS (
  SELECT printf('%04d-%02d', period_year, period_month) AS period, max(id) AS id
  FROM monthly_runs GROUP BY period_year, period_month)
SELECT period, employee_id, first_name, last_name, email, department, {STORED_SLIP}
FROM slips JOIN exported x ON x.id = payroll_run_id
JOIN supplier_employees e ON e.id = employee_id""",
    "monthly_job": f"""{ROUTED_WITH}, {_slips("lineitem_hours", "100")},
paid AS (
  SELECT payroll_run_id, count(*) AS payslips, CAST(sum(net_pay) AS DECIMAL(24,2)) AS net_pay
  FROM slips GROUP BY payroll_run_id)
SELECT r.payroll_run_id AS id,
  CASE WHEN route = 'PROCEED' THEN 'COMPLETED' ELSE 'AWAITING_REVIEW' END AS status,
  p.payslips, p.net_pay
FROM routed r LEFT JOIN paid p ON p.payroll_run_id = r.payroll_run_id AND route = 'PROCEED'""",
    "finalized_payslips": f"""{ROUTED_WITH}, {_slips("lineitem_hours", "100")}
SELECT payroll_run_id, employee_id, {STORED_SLIP}
FROM slips JOIN routed USING (payroll_run_id) WHERE route = 'REVIEW_REQUIRED'""",
    # Constraints.
    "null_violations": "\nUNION ALL\n".join(
        [
            _nulls("employees", "department", "customer", "c_custkey % 50 = 0"),
            _nulls("timesheet_entries", "work_date", "events", "event_id % 97 = 0"),
            _nulls("timesheet_entries", "hours_worked", "events", "event_id % 61 = 0"),
            _nulls("payslips", "employee_id", "lineitem", "l_linenumber = 4"),
            _nulls("payslips", "net_pay", "lineitem", "l_suppkey % 10 = 3"),
            _nulls("rejected_timesheet_entries", "raw_line", "documents", "text IS NULL"),
            _nulls("rejected_timesheet_entries", "reason", "documents", "doc_id % 7 = 0 OR source IS NULL"),
        ]
    ),
    "duplicate_emails": f"""WITH {CUSTOMER_EMPLOYEES}
SELECT 'employees' AS table_name, 'unique_email' AS rule,
  CASE WHEN id % 103 = 0 THEN 'shared' || (id % 3) || '@example.com' ELSE email END AS "key",
  count(*) AS violations
FROM customer_employees GROUP BY 3 HAVING count(*) > 1""",
    "duplicate_ids": f"""WITH {CUSTOMER_EMPLOYEES}
SELECT 'employees' AS table_name, 'unique_id' AS rule, CAST("key" AS VARCHAR) AS "key", count(*) AS violations
FROM (SELECT CASE WHEN id % 5 = 0 THEN id // 10 ELSE id END AS "key" FROM customer_employees)
GROUP BY "key" HAVING count(*) > 1""",
    "import_job": f"""{EVENT_WITH}, {EVENT_ENTRIES}
SELECT 'accepted' AS kind, CAST(employee_id AS VARCHAR) AS who,
  strftime(work_date, '%Y-%m-%d') || ',' || CAST(hours_worked AS VARCHAR) AS what, true AS traced FROM event_entries
UNION ALL
SELECT 'rejected', substr(email || ',' || work_date || ',' || hours_worked, 1, 500), substr(reason, 1, 255), true
FROM classified WHERE outcome <> 'ok'""",
    "run_history_by_completion": f"""WITH {ORDER_RUNS}
SELECT id, status, {_micros("completed_at")}
FROM (SELECT *, CASE WHEN status = 'COMPLETED' THEN started_at END AS completed_at FROM order_runs
  ORDER BY completed_at DESC NULLS FIRST, started_at ASC NULLS LAST, id LIMIT 20 OFFSET 40)""",
    "check_violations": "\nUNION ALL\n".join(
        [
            _broken("employees", "hourly_rate_positive", "c_custkey", "customer", "c_custkey % 101 = 0"),
            _broken(
                "timesheet_entries", "hours_in_range", "event_id", "events",
                "NOT (CAST(value AS DECIMAL(10,2)) > 0 AND CAST(value AS DECIMAL(10,2)) <= 24)",
            ),
        ]
    ),
    "run_check_violations": "\nUNION ALL\n".join(
        [
            _broken(
                "payroll_runs", "period_month_in_range", "o_orderkey", "orders",
                "o_orderkey % 15 NOT BETWEEN 1 AND 12",
            ),
            _broken("payroll_runs", "status_known", "o_orderkey", "orders", "o_orderstatus NOT IN ('F', 'O')"),
        ]
    ),
    "length_violations": "\nUNION ALL\n".join(
        [
            _broken("rejected_timesheet_entries", "raw_line_length", "doc_id", "documents", "length(text) > 500"),
            _broken("employees", "bank_account_length", "c_custkey", "customer", "c_custkey % 100 = 0"),
            _broken("timesheet_entries", "source_file_length", "event_id", "events", "event_id % 113 = 0"),
            _broken("payroll_runs", "status_length", "o_orderkey", "orders", "o_orderkey % 127 = 0"),
        ]
    ),
    "fk_violations": "\nUNION ALL\n".join(
        [
            _orphans(
                "timesheet_entries", "employee_exists",
                "SELECT CASE WHEN event_id % 107 = 0 THEN user_id + 1000000000 ELSE user_id END AS k FROM events",
                "SELECT c_custkey FROM customer",
            ),
            _orphans(
                "payslips", "run_exists",
                "SELECT CASE WHEN l_linenumber = 7 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS k"
                " FROM lineitem",
                "SELECT o_orderkey FROM orders",
            ),
            _orphans(
                "payslips", "employee_exists",
                "SELECT CASE WHEN l_linenumber = 6 THEN l_suppkey + 1000000000 ELSE l_suppkey END AS k"
                " FROM lineitem",
                "SELECT s_suppkey FROM supplier",
            ),
            _orphans(
                "rejected_timesheet_entries", "run_exists",
                "SELECT CASE WHEN event_id % 211 = 0 THEN -event_id - 1 ELSE event_id % 100 END AS k FROM events",
                "SELECT o_orderkey FROM orders",
            ),
        ]
    ),
}

# A snapshot and a tail give what the whole log does.
ORACLE["compacted_run_state"] = ORACLE["current_run_state"]
