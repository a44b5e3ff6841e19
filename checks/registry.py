"""One query per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from tallyroll.functions import pay, periods
from tallyroll.operators import hours as hours_ops
from tallyroll.operators import imports, metrics, quality, ranges, review
from tallyroll.operators import payslips as payslip_ops
from tallyroll.operators import runs as run_ops
from tallyroll.plans import monthly
from tallyroll.schemas import AWAITING_REVIEW, STARTED, SUMMARY_COLUMNS, Params
from tallyroll.sources import sinks, timesheets
from tallyroll.sources.storage import list_names, replace_path, stage, working_folder, write_text
from tallyroll.sources.tables import find, load_month_sums, load_table

GRID = Params().grid_size
LIMITS = fx.LINEITEM_PARAMS
PAGE_SIZE = 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _bigint(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


# Reading and checking of timesheet rows.


@query
def csv_import(spark, sf_dir):
    folder = _events_as_csv(spark, sf_dir)
    return timesheets.read_timesheets(spark, folder).select(*timesheets.RAW_FIELDS)


@query
def malformed_lines(spark, sf_dir):
    event = F.col("event_id")
    line = F.concat_ws(",", *timesheets.RAW_FIELDS)
    rows = fx.event_rows(spark, sf_dir).select(
        F.when(event % 71 == 0, F.concat_ws(",", "email", "work_date"))
        .when(event % 73 == 0, F.concat(line, F.lit(",extra")))
        .otherwise(line)
        .alias(",".join(timesheets.RAW_FIELDS))
    )
    folder = working_folder(spark, "malformed")
    _write_csv(rows, folder, sep="\x01")
    scanned = timesheets.scan_timesheets(spark, folder)
    return timesheets.malformed_lines(scanned).select("raw_line", "reason")


@query
def lineage_counts(spark, sf_dir):
    folder = _events_as_csv(spark, sf_dir)
    rows = timesheets.read_timesheets(spark, folder)
    entries = imports.import_accepted(rows, fx.customer_employees(spark, sf_dir))
    traced = timesheets.with_lineage(entries, fx.AT)
    return traced.groupBy(fx.timestamp_text("imported_at").alias("imported_at")).agg(
        F.count("*").alias("entries"),
        F.count_if(F.col("source_file").endswith(".csv")).alias("entries_of_csv_files"),
    )


@query
def lineage_of_rows(spark, sf_dir):
    """Each accepted row with the file it came from: the rows of three folders, in files named after them."""
    folder = working_folder(spark, "lineage")
    rows = fx.event_rows(spark, sf_dir).select(*timesheets.RAW_FIELDS, (F.col("event_id") % 3).alias("batch"))
    _write_csv(rows, f"{folder}/written", sep=",", partition_by=["batch"])
    for batch in [n for n in list_names(spark, f"{folder}/written") if "=" in n]:
        for part in [n for n in list_names(spark, f"{folder}/written/{batch}") if n.endswith(".csv")]:
            target = f"{folder}/files/{batch.replace('=', '-')}.{part}"
            replace_path(spark, f"{folder}/written/{batch}/{part}", target)
    read = timesheets.read_timesheets(spark, f"{folder}/files")
    entries = timesheets.with_lineage(imports.import_accepted(read, fx.customer_employees(spark, sf_dir)), fx.AT)
    return entries.select(
        "employee_id",
        fx.text("work_date").alias("work_date"),
        "hours_worked",
        F.substring_index("source_file", ".", 1).alias("file"),
    )


def _events_as_csv(spark: SparkSession, sf_dir: str) -> str:
    folder = working_folder(spark, "events")
    _write_csv(fx.event_rows(spark, sf_dir).select(*timesheets.RAW_FIELDS), folder, sep=",")
    return folder


def _write_csv(rows: DataFrame, folder: str, sep: str, partition_by: list[str] | None = None) -> None:
    (
        rows.write.mode("overwrite")
        .partitionBy(*(partition_by or []))
        .options(header=True, sep=sep, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(folder)
    )


@query
def normalise_raw(spark, sf_dir):
    event = F.col("event_id")
    rows = fx.event_rows(spark, sf_dir).select(
        "event_id",
        "email",
        F.when(event % 79 == 0, F.lit(" \t ")).otherwise(F.col("work_date")).alias("work_date"),
        F.when(event % 61 != 0, F.concat(F.lit("\t"), "hours_worked")).alias("hours_worked"),
    )
    return timesheets.normalise_raw(rows)


@query
def reject_not_number(spark, sf_dir):
    return _rejects(spark, sf_dir, imports.NOT_A_NUMBER)


@query
def reject_out_of_range(spark, sf_dir):
    return _rejects(spark, sf_dir, imports.OUT_OF_RANGE)


@query
def reject_bad_date(spark, sf_dir):
    return _rejects(spark, sf_dir, imports.BAD_DATE)


def _rejects(spark: SparkSession, sf_dir: str, outcome: str) -> DataFrame:
    return _classified_events(spark, sf_dir).filter(F.col("outcome") == outcome).select(
        "email", "work_date", "hours_worked", "reason"
    )


def _classified_events(spark: SparkSession, sf_dir: str, run_id: Column | None = None) -> DataFrame:
    rows = fx.event_timesheet(spark, sf_dir, run_id)
    return imports.classify(rows, fx.customer_employees(spark, sf_dir))


@query
def resolve_employee(spark, sf_dir):
    rows = fx.event_timesheet(spark, sf_dir)
    return imports.resolve_employee(rows, fx.customer_employees(spark, sf_dir)).select(
        "email", "work_date", "hours_worked", "employee_id"
    )


@query
def unknown_emails(spark, sf_dir):
    rows = fx.event_timesheet(spark, sf_dir)
    return imports.unknown_emails(rows, fx.customer_employees(spark, sf_dir))


@query
def import_classify(spark, sf_dir):
    return _classified_events(spark, sf_dir).select(
        "email", "work_date", "hours_worked", "employee_id", "outcome", "reason"
    )


@query
def import_accepted(spark, sf_dir):
    rows = fx.event_timesheet(spark, sf_dir)
    return imports.import_accepted(rows, fx.customer_employees(spark, sf_dir)).select(
        "employee_id",
        fx.text("work_date").alias("work_date"),
        "hours_worked",
        _bigint("work_year"),
        _bigint("work_month"),
    )


@query
def import_rejected(spark, sf_dir):
    return imports.rejected_rows(_classified_events(spark, sf_dir))


@query
def reject_record(spark, sf_dir):
    rows = fx.document_timesheet(spark, sf_dir)
    return imports.rejected_rows(imports.classify(rows, fx.customer_employees(spark, sf_dir)))


@query
def skip_limit_gate(spark, sf_dir):
    # Each user's rows are a file of their own, so some files stay within the limit.
    classified = _classified_events(spark, sf_dir, F.col("user_id"))
    return imports.skip_limit_report(classified, Params().skip_limit)


@query
def import_metrics(spark, sf_dir):
    return metrics.import_metrics(_classified_events(spark, sf_dir, F.col("user_id")))


@query
def reject_report(spark, sf_dir):
    return metrics.reject_report(imports.rejected_rows(_classified_events(spark, sf_dir)))


# Hours per employee and run.


@query
def period_entries(spark, sf_dir):
    return hours_ops.period_entries(fx.lineitem_entries(spark, sf_dir), 1998, 3).select(
        "employee_id", fx.text("work_date").alias("work_date"), "hours_worked"
    )


@query
def entries_for_runs(spark, sf_dir):
    runs, entries = fx.monthly_runs(spark, sf_dir), fx.lineitem_entries(spark, sf_dir)
    return hours_ops.entries_for_runs(runs, entries).select(
        "payroll_run_id", "employee_id", fx.text("work_date").alias("work_date"), "hours_worked"
    )


def _lineitem_hours(spark: SparkSession, sf_dir: str, runs: DataFrame | None = None) -> DataFrame:
    return hours_ops.hours_by_employee(
        fx.lineitem_entries(spark, sf_dir),
        fx.supplier_employees(spark, sf_dir),
        fx.monthly_runs(spark, sf_dir) if runs is None else runs,
    )


def _event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = imports.valid_rows(fx.event_timesheet(spark, sf_dir))
    return hours_ops.hours_by_email(rows, fx.customer_employees(spark, sf_dir), fx.event_runs(spark, sf_dir))


@query
def hours_by_employee(spark, sf_dir):
    return _lineitem_hours(spark, sf_dir)


@query
def hours_by_email(spark, sf_dir):
    return _event_hours(spark, sf_dir)


@query
def hours_in_id_range(spark, sf_dir):
    # Every range of the plan, so their union is all of the hours.
    employees = fx.supplier_employees(spark, sf_dir)
    placed = ranges.assign_range(_lineitem_hours(spark, sf_dir), employees, GRID)
    return placed.join(ranges.id_ranges(employees, GRID), "range_id").select(
        _bigint("range_id"), "min_id", "max_id", "payroll_run_id", "employee_id", "total_hours"
    )


@query
def hours_between_ids(spark, sf_dir):
    """Hours of two spans of ids, cut in the middle of the bounds; together they are all of the hours."""
    employees = fx.supplier_employees(spark, sf_dir)
    bounds = ranges.id_bounds(employees).first()
    low, high = bounds.min_id or 0, bounds.max_id or 0
    middle = (low + high) // 2
    spans = [(low, middle), (middle + 1, high)]
    entries, runs = fx.lineitem_entries(spark, sf_dir), fx.monthly_runs(spark, sf_dir)
    lower, upper = (
        hours_ops.hours_by_employee(entries, employees, runs, id_range=span).withColumn("span", F.lit(place).cast("bigint"))
        for place, span in enumerate(spans)
    )
    return lower.unionByName(upper).select("span", "payroll_run_id", "employee_id", "total_hours")


@query
def anomalous_employees(spark, sf_dir):
    found = review.anomalies(_event_hours(spark, sf_dir), Params().anomaly_threshold_hours)
    return found.select("payroll_run_id", "employee_id", "total_hours")


# Payslips.


def _lineitem_payslips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payslip_ops.payslips(_lineitem_hours(spark, sf_dir), LIMITS)


@query
def gross_pay(spark, sf_dir):
    gross = pay.gross_pay(F.col("total_hours"), F.col("hourly_rate"), LIMITS)
    return _lineitem_hours(spark, sf_dir).select(
        "payroll_run_id", "employee_id", gross.cast("decimal(24,2)").alias("gross_pay")
    )


@query
def payslips(spark, sf_dir):
    return payslip_ops.payslips(_event_hours(spark, sf_dir))


@query
def payslips_many_runs(spark, sf_dir):
    return _lineitem_payslips(spark, sf_dir)


@query
def payroll_summary(spark, sf_dir):
    return payslip_ops.payroll_summary(
        _lineitem_payslips(spark, sf_dir), fx.supplier_employees(spark, sf_dir)
    )


# Review.


def _flags(runs: DataFrame, hours: DataFrame) -> DataFrame:
    return review.review_flags(runs, hours, LIMITS.anomaly_threshold_hours)


@query
def review_flags(spark, sf_dir):
    runs = fx.monthly_runs(spark, sf_dir)
    return _flags(runs, _lineitem_hours(spark, sf_dir, runs))


@query
def route_runs(spark, sf_dir):
    runs = fx.monthly_runs(spark, sf_dir)
    flags = _flags(runs, _lineitem_hours(spark, sf_dir, runs))
    return review.route(flags).select("payroll_run_id", "route")


def _runs_routed(spark: SparkSession, sf_dir: str, way: str) -> DataFrame:
    runs = fx.monthly_runs(spark, sf_dir)
    routes = review.route(_flags(runs, _lineitem_hours(spark, sf_dir, runs)))
    chosen = review.runs_on(routes, way).withColumnRenamed("payroll_run_id", "id")
    return runs.join(chosen, "id", "left_semi")


@query
def held_runs(spark, sf_dir):
    held = run_ops.hold_runs(_runs_routed(spark, sf_dir, review.REVIEW_REQUIRED), fx.AT)
    return held.select("id", _bigint("period_month"), _bigint("period_year"), "status")


@query
def completed_runs(spark, sf_dir):
    done = run_ops.complete_runs(_runs_routed(spark, sf_dir, review.PROCEED), fx.AT)
    return done.select(
        "id",
        _bigint("period_month"),
        _bigint("period_year"),
        "status",
        fx.timestamp_text("completed_at").alias("completed_at"),
    )


@query
def payslips_released(spark, sf_dir):
    runs = fx.monthly_runs(spark, sf_dir)
    hours = _lineitem_hours(spark, sf_dir, runs)
    routes = review.route(_flags(runs, hours))
    return payslip_ops.payslips(review.release(hours, routes), LIMITS)


# Runs.


@query
def current_run_state(spark, sf_dir):
    folder = working_folder(spark, "states")
    sinks.append_run_state(fx.event_run_states(spark, sf_dir), folder)
    current = run_ops.current_runs(load_table(spark, folder, "payroll_run_states"), known_statuses=True)
    return current.select(
        "id",
        _bigint("period_month"),
        _bigint("period_year"),
        "status",
        fx.timestamp_text("started_at").alias("started_at"),
        fx.timestamp_text("completed_at").alias("completed_at"),
    )


@query
def compacted_run_state(spark, sf_dir):
    """The log in three commits, compacted after each of the first two: a snapshot and a tail."""
    folder = working_folder(spark, "states")
    states = fx.event_run_states(spark, sf_dir)
    for place in range(3):
        # Thirds by number, so that later commits hold later changes.
        third = F.call_function("div", F.col("seq") * 3, states.agg(F.max("seq") + 1).scalar())
        sinks.append_run_state(states.filter(third == place), folder)
        if place < 2:
            sinks.compact_run_states(spark, folder)
    current = run_ops.current_runs(load_table(spark, folder, "payroll_run_states"), known_statuses=True)
    return current.select(
        "id",
        _bigint("period_month"),
        _bigint("period_year"),
        "status",
        fx.timestamp_text("started_at").alias("started_at"),
        fx.timestamp_text("completed_at").alias("completed_at"),
    )


@query
def run_history_middle_page(spark, sf_dir):
    """The page in the middle of the history by status and month: far down, it is found by selection."""
    runs = fx.order_runs(spark, sf_dir)
    pages = run_ops.page_totals(runs, PAGE_SIZE).first().total_pages
    order = [("status", False), ("period_month", True)]
    page = run_ops.run_history_page(runs, page=pages // 2, size=PAGE_SIZE, sort=order)
    return page.select("id", "status", _bigint("period_month"))


@query
def run_lookup(spark, sf_dir):
    requests = fx.order_run_requests(spark, sf_dir)
    return run_ops.lookup_runs(requests, fx.order_runs(spark, sf_dir)).select("id", "status", "error")


@query
def run_request_errors(spark, sf_dir):
    checked = run_ops.validate_run_requests(fx.order_create_requests(spark, sf_dir))
    return checked.select("id", F.concat_ws(",", "invalid_fields").alias("invalid_fields"))


@query
def created_runs(spark, sf_dir):
    created = run_ops.create_runs(fx.order_create_requests(spark, sf_dir), fx.AT)
    return created.select(
        "id",
        _bigint("period_month"),
        _bigint("period_year"),
        "status",
        fx.timestamp_text("started_at").alias("started_at"),
    )


@query
def resume_outcomes(spark, sf_dir):
    requests = fx.order_run_requests(spark, sf_dir)
    return run_ops.resume(requests, fx.order_runs(spark, sf_dir)).select("id", "status", "error")


@query
def launch_guard(spark, sf_dir):
    runs = fx.order_runs(spark, sf_dir)
    requests = run_ops.launch_requests(runs, run_ops.MONTHLY_JOB).unionByName(
        run_ops.launch_requests(runs, run_ops.FINALIZE_JOB)
    )
    executions = run_ops.launch_requests(runs, run_ops.MONTHLY_JOB).join(
        runs.select(F.col("id").alias("payroll_run_id"), "status"), "payroll_run_id"
    )
    return run_ops.launchable(requests, executions)


@query
def run_history_page(spark, sf_dir):
    page = run_ops.run_history_page(fx.order_runs(spark, sf_dir), page=3, size=PAGE_SIZE)
    return page.select(
        "id",
        _bigint("period_month"),
        _bigint("period_year"),
        "status",
        fx.timestamp_text("started_at").alias("started_at"),
    )


@query
def run_page_totals(spark, sf_dir):
    return run_ops.page_totals(fx.order_runs(spark, sf_dir), PAGE_SIZE)


@query
def previous_period(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        periods.previous_period(F.col("o_orderdate").cast("date")).alias("period"),
    )


@query
def execution_elapsed(spark, sf_dir):
    return metrics.elapsed(fx.event_step_log(spark, sf_dir))


# Id ranges.


@query
def id_bounds(spark, sf_dir):
    return ranges.id_bounds(fx.customer_employees(spark, sf_dir))


@query
def id_ranges(spark, sf_dir):
    planned = ranges.id_ranges(fx.customer_employees(spark, sf_dir), GRID)
    return planned.select(_bigint("range_id"), "min_id", "max_id")


@query
def range_metrics(spark, sf_dir):
    employees = fx.supplier_employees(spark, sf_dir)
    hours = ranges.assign_range(_lineitem_hours(spark, sf_dir), employees, GRID)
    slips = ranges.assign_range(payslip_ops.payslips(hours, LIMITS), employees, GRID)
    counted = metrics.range_metrics(ranges.id_ranges(employees, GRID), hours, slips)
    return counted.select(_bigint("range_id"), "min_id", "max_id", "items_read", "items_written")


# Writing and reading back.


@query
def entries_roundtrip(spark, sf_dir):
    folder = working_folder(spark, "entries")
    imported = imports.import_accepted(
        fx.event_timesheet(spark, sf_dir), fx.customer_employees(spark, sf_dir)
    )
    first = timesheets.with_lineage(imported, fx.AT, "events.csv")
    second = timesheets.with_lineage(fx.lineitem_entries(spark, sf_dir), fx.LATER)
    sinks.write_entries(first, folder)
    sinks.write_entries(second, folder)
    return load_table(spark, folder, "timesheet_entries").select(
        "employee_id",
        fx.text("work_date").alias("work_date"),
        "hours_worked",
        "source_file",
        _bigint("work_year"),
        _bigint("work_month"),
    )


@query
def rejects_roundtrip(spark, sf_dir):
    folder = working_folder(spark, "rejects")
    # Each day's rows are imported for a run of their own.
    day = F.date_format("ts", "yyyyMMdd")
    classified = _classified_events(spark, sf_dir, day)
    sinks.write_rejected(imports.rejected_rows(classified), folder)
    return load_table(spark, folder, "rejected_timesheet_entries")


@query
def rejects_of_run(spark, sf_dir):
    """All rejects were imported for two runs; those of the second are read, from its folder alone."""
    folder = working_folder(spark, "rejects")
    rejected = imports.rejected_rows(_classified_events(spark, sf_dir))
    for run_id in (fx.EVENTS_RUN, fx.EVENTS_RUN + 1):
        sinks.write_rejected(rejected.withColumn("payroll_run_id", F.lit(run_id).cast("bigint")), folder)
    return payslip_ops.for_run(load_table(spark, folder, "rejected_timesheet_entries"), fx.EVENTS_RUN + 1)


@query
def found_employees(spark, sf_dir):
    """Of each nation the first customer by id and the last one by email, found by key in the stored table."""
    folder = working_folder(spark, "employees")
    employees = fx.customer_employees(spark, sf_dir)
    sinks.write_employees(employees, folder)
    # One row a nation: a bounded number of keys.
    nations = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey").join(employees, "id")
    keys = nations.groupBy("c_nationkey").agg(F.min("id").alias("id"), F.max_by("email", "id").alias("email")).collect()
    by_id = find(spark, folder, "employees", "id", [k.id for k in keys]).withColumn("found_by", F.lit("id"))
    by_email = find(spark, folder, "employees", "email", [k.email for k in keys]).withColumn("found_by", F.lit("email"))
    return by_id.unionByName(by_email).select("found_by", "id", "email", "department", "hourly_rate")


@query
def payslips_rerun(spark, sf_dir):
    folder = working_folder(spark, "payslips")
    hours = stage(_lineitem_hours(spark, sf_dir), f"{folder}/hours")
    sinks.write_payslips(payslip_ops.payslips(hours, Params(), fx.AT), folder)
    # The runs from 1998 on are paid again under other limits.
    again = hours.filter(F.col("payroll_run_id") >= 199801)
    sinks.write_payslips(payslip_ops.payslips(again, LIMITS, fx.LATER), folder)
    return load_table(spark, folder, "payslips").drop("generated_at")


@query
def summary_roundtrip(spark, sf_dir):
    folder = working_folder(spark, "export")
    runs = fx.monthly_runs(spark, sf_dir)
    calculated = payslip_ops.payslips(_lineitem_hours(spark, sf_dir, runs), LIMITS)
    slips = stage(payslip_ops.as_stored(calculated), f"{folder}/payslips")
    employees = fx.supplier_employees(spark, sf_dir)
    files = sinks.export_summary(spark, slips, employees, runs, f"{folder}/summaries")
    return _read_summaries(spark, files)


def _read_summaries(spark: SparkSession, files: list[str]) -> DataFrame:
    types = "bigint string string string string decimal(6,2) decimal(10,2) decimal(10,2) decimal(10,2)".split()
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(SUMMARY_COLUMNS, types, strict=True))
    period = F.regexp_extract(F.col("_metadata.file_path"), r"payroll-summary-(\d{4}-\d{2})", 1)
    return spark.read.schema(schema).csv(files, header=True).select(
        period.alias("period"), *SUMMARY_COLUMNS
    )


def _stored_month(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Tables with the employees, entries and created runs of the line items,
    and what the monthly job returned for all of the runs."""
    root = working_folder(spark, "job")
    fx.supplier_employees(spark, sf_dir).write.parquet(f"{root}/employees")
    entries = timesheets.with_lineage(fx.lineitem_entries(spark, sf_dir), fx.AT)
    sinks.write_entries(entries, root)
    # Stored as they are: requests before 2000 would be refused, the table takes them.
    runs = fx.monthly_runs(spark, sf_dir)
    sinks.append_run_state(run_ops.changed_state(runs, STARTED, fx.AT, run_ops.CREATE), root)
    requests = runs.select("id")
    return root, monthly.run_monthly(spark, root, requests, fx.AT, _job_params(root))


def _job_params(root: str) -> Params:
    return Params(
        overtime_threshold_hours=LIMITS.overtime_threshold_hours,
        anomaly_threshold_hours=LIMITS.anomaly_threshold_hours,
        export_dir=f"{root}/exports",
    )


@query
def monthly_job(spark, sf_dir):
    root, _ = _stored_month(spark, sf_dir)
    runs = run_ops.current_runs(load_table(spark, root, "payroll_run_states"))
    paid = load_table(spark, root, "payslips").groupBy(F.col("payroll_run_id").alias("id")).agg(
        F.count("*").alias("payslips"), F.sum("net_pay").cast("decimal(24,2)").alias("net_pay")
    )
    return runs.join(paid, "id", "left").select("id", "status", "payslips", "net_pay")


@query
def import_job(spark, sf_dir):
    """The production import of a CSV file, from the scan to the stored tables."""
    root = working_folder(spark, "import-job")
    fx.customer_employees(spark, sf_dir).write.parquet(f"{root}/employees")
    rejects_allowed = Params(skip_limit=2_147_483_647)
    monthly.import_timesheets(
        spark, root, _events_as_csv(spark, sf_dir), fx.EVENTS_RUN, fx.AT, rejects_allowed, "quarantine"
    )
    entries = load_table(spark, root, "timesheet_entries").select(
        F.lit("accepted").alias("kind"),
        fx.text("employee_id").alias("who"),
        F.concat_ws(",", fx.text("work_date"), fx.text("hours_worked")).alias("what"),
        (F.col("source_file").startswith("part-") & F.col("source_file").endswith(".csv")).alias("traced"),
    )
    rejects = load_table(spark, root, "rejected_timesheet_entries").select(
        F.lit("rejected").alias("kind"), F.col("raw_line").alias("who"), F.col("reason").alias("what"), F.lit(True).alias("traced")
    )
    return entries.unionByName(rejects)


@query
def month_sums(spark, sf_dir):
    """Hours by employee and month, kept up by two imports, the second one late."""
    root = working_folder(spark, "sums")
    first = timesheets.with_lineage(fx.lineitem_entries(spark, sf_dir), fx.AT)
    late = imports.import_accepted(fx.event_timesheet(spark, sf_dir), fx.customer_employees(spark, sf_dir))
    sinks.write_entries(first, root)
    sinks.write_entries(timesheets.with_lineage(late, fx.LATER, "events.csv"), root)
    sums = load_month_sums(spark, root).groupBy("employee_id", "work_year", "work_month")
    return sums.agg(F.sum("hours_worked").cast("decimal(14,2)").alias("hours_worked")).select(
        "employee_id", _bigint("work_year"), _bigint("work_month"), "hours_worked"
    )


@query
def repeated_job(spark, sf_dir):
    """Held runs whose payment fails before its commit, and its repeat: every run is paid once."""
    root = working_folder(spark, "repeat")
    fx.customer_employees(spark, sf_dir).write.parquet(f"{root}/employees")
    runs = fx.event_runs(spark, sf_dir)
    sinks.append_run_state(run_ops.changed_state(runs, STARTED, fx.AT, run_ops.CREATE), root)
    csv, params = _events_as_csv(spark, sf_dir), replace(_job_params(root), skip_limit=2_147_483_647)
    requests = stage(runs.select("id"), f"{root}/requests")
    monthly.run_monthly(spark, root, requests, fx.AT, params, csv, fx.EVENTS_RUN, "quarantine")
    # A file in place of the folder makes the export fail, after the payslips are written.
    write_text(spark, f"{root}/a-file", "")
    try:
        monthly.run_finalize(spark, root, requests, fx.LATER, replace(params, export_dir=f"{root}/a-file/exports"))
        raise AssertionError("the export must fail")
    except Py4JJavaError:
        monthly.run_finalize(spark, root, requests, fx.LATER, params)
    rejects = load_table(spark, root, "rejected_timesheet_entries").agg(F.count("*").alias("rejects"))
    slips = load_table(spark, root, "payslips").groupBy(F.col("payroll_run_id").alias("id")).agg(
        F.count("*").alias("payslips"), F.sum("total_hours").cast("decimal(14,2)").alias("total_hours")
    )
    current = run_ops.current_runs(load_table(spark, root, "payroll_run_states"), known_statuses=True)
    return current.join(slips, "id", "left").join(rejects).select("id", "status", "payslips", "total_hours", "rejects")


@query
def finalized_payslips(spark, sf_dir):
    root, routes = _stored_month(spark, sf_dir)
    requests = routes.select(F.col("payroll_run_id").alias("id"))
    outcomes = monthly.run_finalize(spark, root, requests, fx.LATER, _job_params(root))
    resumed = outcomes.filter(F.col("status") == STARTED).select(F.col("id").alias("payroll_run_id"))
    slips = load_table(spark, root, "payslips").join(resumed, "payroll_run_id", "left_semi")
    return slips.drop("generated_at")


# Constraints.


@query
def null_violations(spark, sf_dir):
    employees = fx.customer_employees(spark, sf_dir).withColumn(
        "department", F.when(F.col("id") % 50 != 0, F.col("department"))
    )
    rows = fx.event_rows(spark, sf_dir)
    entries = rows.select(
        F.col("user_id").alias("employee_id"),
        F.when(F.col("event_id") % 97 != 0, F.col("work_date")).alias("work_date"),
        F.when(F.col("event_id") % 61 != 0, F.col("hours_worked")).alias("hours_worked"),
    )
    slips = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("payroll_run_id"),
        F.when(F.col("l_linenumber") != 4, F.col("l_suppkey")).alias("employee_id"),
        F.when(F.col("l_suppkey") % 10 != 3, F.col("l_extendedprice")).alias("net_pay"),
    )
    rejects = fx.table(spark, sf_dir, "documents").select(
        F.col("text").alias("raw_line"), F.when(F.col("doc_id") % 7 != 0, F.col("source")).alias("reason")
    )
    return quality.union_reports(
        quality.null_violations(employees, "employees"),
        quality.null_violations(entries, "timesheet_entries"),
        quality.null_violations(fx.order_runs(spark, sf_dir), "payroll_runs", nullable=("completed_at",)),
        quality.null_violations(slips, "payslips"),
        quality.null_violations(rejects, "rejected_timesheet_entries"),
    )


@query
def duplicate_emails(spark, sf_dir):
    shared = F.concat(F.lit("shared"), fx.text(F.col("id") % 3), F.lit("@example.com"))
    employees = fx.customer_employees(spark, sf_dir).withColumn(
        "email", F.when(F.col("id") % 103 == 0, shared).otherwise(F.col("email"))
    )
    return quality.duplicate_emails(employees)


@query
def duplicate_ids(spark, sf_dir):
    # A fifth of the customers get the id of another one.
    employees = fx.customer_employees(spark, sf_dir).withColumn(
        "id", F.when(F.col("id") % 5 == 0, F.floor(F.col("id") / 10)).otherwise(F.col("id"))
    )
    return quality.duplicate_ids(employees, "employees")


@query
def run_history_by_completion(spark, sf_dir):
    # Open runs have no completion and come first, as nulls do in PostgreSQL.
    order = [("completed_at", True), ("started_at", False)]
    page = run_ops.run_history_page(fx.order_runs(spark, sf_dir), page=2, size=PAGE_SIZE, sort=order)
    return page.select("id", "status", fx.timestamp_text("completed_at").alias("completed_at"))


@query
def check_violations(spark, sf_dir):
    employees = fx.customer_employees(spark, sf_dir).withColumn(
        "hourly_rate", F.when(F.col("id") % 101 == 0, F.lit(0)).otherwise(F.col("hourly_rate"))
    )
    entries = fx.table(spark, sf_dir, "events").select(
        "event_id", F.col("value").cast("decimal(10,2)").alias("hours_worked")
    )
    return quality.union_reports(
        quality.rate_violations(employees), quality.hours_violations(entries, key="event_id")
    )


@query
def run_check_violations(spark, sf_dir):
    runs = fx.order_create_requests(spark, sf_dir).join(
        fx.order_runs(spark, sf_dir).select("id", "status"), "id"
    )
    odd = F.when(F.col("status") == AWAITING_REVIEW, F.lit("PAUSED")).otherwise(F.col("status"))
    return quality.run_check_violations(runs.withColumn("status", odd))


@query
def length_violations(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("raw_line"), F.concat_ws(" ", "source", "lang").alias("reason")
    )
    employees = fx.customer_employees(spark, sf_dir).withColumn(
        "bank_account", F.concat("bank_account", F.when(F.col("id") % 100 == 0, "0").otherwise(""))
    )
    entries = fx.table(spark, sf_dir, "events").select(
        "event_id", F.repeat(F.lit("x"), F.when(F.col("event_id") % 113 == 0, 256).otherwise(255)).alias("source_file")
    )
    runs = fx.order_runs(spark, sf_dir).withColumn(
        "status", F.when(F.col("id") % 127 == 0, F.rpad("status", 31, "-")).otherwise(F.col("status"))
    )
    return quality.union_reports(
        quality.length_violations(documents, "rejected_timesheet_entries", "doc_id"),
        quality.length_violations(employees, "employees", "id"),
        quality.length_violations(entries, "timesheet_entries", "event_id"),
        quality.length_violations(runs, "payroll_runs", "id"),
    )


@query
def fk_violations(spark, sf_dir):
    rows = fx.event_rows(spark, sf_dir)
    event, line = F.col("event_id"), F.col("l_linenumber")
    entries = rows.select(
        F.when(event % 107 == 0, F.col("user_id") + 1000000000).otherwise(F.col("user_id")).alias("employee_id")
    )
    rejects = rows.select(F.when(event % 211 == 0, -event - 1).otherwise(event % 100).alias("payroll_run_id"))
    slips = fx.table(spark, sf_dir, "lineitem").select(
        F.when(line == 7, F.col("l_orderkey") + 1000000000).otherwise(F.col("l_orderkey")).alias("payroll_run_id"),
        F.when(line == 6, F.col("l_suppkey") + 1000000000).otherwise(F.col("l_suppkey")).alias("employee_id"),
    )
    runs = fx.order_runs(spark, sf_dir)
    customers = fx.customer_employees(spark, sf_dir)
    suppliers = fx.supplier_employees(spark, sf_dir)
    check = quality.fk_violations
    return quality.union_reports(
        check(entries, "employee_id", customers, "id", "timesheet_entries", "employee_exists"),
        quality.fk_report(
            slips,
            "payslips",
            {"run_exists": ("payroll_run_id", runs, "id"), "employee_exists": ("employee_id", suppliers, "id")},
        ),
        check(rejects, "payroll_run_id", runs, "id", "rejected_timesheet_entries", "run_exists"),
    )
