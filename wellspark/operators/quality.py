"""Blocking quality gate (Q1-Q21).

All NOT NULL / range checks of a table are ``count_if`` columns of one global
aggregate (no shuffle beyond one partial row per task). Key uniqueness is one
``groupBy(key).count()`` -- the only shuffle, carrying (key, count) pairs, with
a map-side partial aggregate so a hot key shrinks to one row per task. The
one-row results become report rows with ``inline(array(named_struct(...)))``.

Report schema: ``check_order int, check_name string, ok boolean, details string``.
Check names and detail formats are the reference's, verbatim (fixed values).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .commute import commute_anomalies
from .config import Params

DEFAULT_PARAMS = Params()


@dataclass(frozen=True)
class Check:
    order: int
    key: str                 # query key, e.g. "qc_emp_id_null"
    name: str                # report name (fixed value)
    kind: str                # "rows" | "count_if" | "dup_keys" | "volume"
    label: str = ""          # details label: "<label>=<value>"
    predicate: str | None = None  # SQL predicate counted by count_if


# Check names and labels. The predicates count bad values; a NULL never
# compares as bad, so ranges need no NULL guard.
EMPLOYEE_CHECKS = (
    Check(1, "qc_emp_rows", "clean.employees row_count > 0", "rows", "row_count"),
    Check(2, "qc_emp_id_null", "clean.employees employee_id NOT NULL", "count_if", "nulls",
          "employee_id IS NULL"),
    Check(3, "qc_emp_id_unique", "clean.employees employee_id UNIQUE", "dup_keys", "duplicates"),
    Check(4, "qc_emp_salary_null", "clean.employees gross_salary NOT NULL", "count_if", "nulls",
          "gross_salary IS NULL"),
    Check(5, "qc_emp_salary_pos", "clean.employees gross_salary > 0", "count_if", "bad",
          "gross_salary <= 0"),
    Check(6, "qc_emp_address", "clean.employees home_address NOT NULL", "count_if", "null_or_empty",
          "home_address IS NULL OR home_address = ''"),
    Check(7, "qc_emp_mode", "clean.employees commute_mode NOT NULL", "count_if", "null_or_empty",
          "commute_mode IS NULL OR commute_mode = ''"),
)
ACTIVITY_CHECKS = (
    Check(11, "qc_act_id_null", "clean.activities activity_id NOT NULL", "count_if", "nulls",
          "activity_id IS NULL"),
    Check(12, "qc_act_id_unique", "clean.activities activity_id UNIQUE", "dup_keys", "duplicates"),
    Check(13, "qc_act_emp_null", "clean.activities employee_id NOT NULL", "count_if", "nulls",
          "employee_id IS NULL"),
    Check(14, "qc_act_elapsed", "clean.activities elapsed_s >= 0", "count_if", "bad", "elapsed_s < 0"),
    Check(15, "qc_act_distance", "clean.activities distance_m >= 0 (when present)", "count_if", "bad",
          "distance_m < 0"),
    Check(16, "qc_act_start_null", "clean.activities start_ts NOT NULL", "count_if", "nulls",
          "start_ts IS NULL"),
    Check(17, "qc_act_end_null", "clean.activities end_ts NOT NULL", "count_if", "nulls",
          "end_ts IS NULL"),
    Check(18, "qc_act_dates", "clean.activities end_ts >= start_ts", "count_if", "bad",
          "end_ts < start_ts"),
    Check(19, "qc_act_volume", "volumetry.activities_min_rows (post-generation)", "volume"),
)
CHECKS_TABLE_CHECKS = (
    Check(21, "qc_chk_emp_null", "raw.commute_distance_checks employee_id NOT NULL", "count_if", "nulls",
          "employee_id IS NULL"),
    Check(22, "qc_chk_distance", "raw.commute_distance_checks distance_km >= 0 (when present)", "count_if",
          "bad", "distance_km < 0"),
)
RULE_CHECK = Check(23, "qc_chk_rule", "business_rule.max_commute_distance_by_mode", "anomalies")

ACT_ROWS_ORDER, CHK_ROWS_ORDER = 10, 20
ACT_SKIP_ORDER, CHK_SKIP_ORDER, RULE_SKIP_ORDER = 11, 21, 23
ACT_ROWS_NAME = "clean.activities row_count"
CHK_ROWS_NAME = "raw.commute_distance_checks row_count"
ACT_SKIP = "clean.activities tests (SKIP)"
CHK_SKIP = "raw.commute_distance_checks tests (SKIP)"
RULE_SKIP = "business_rule.max_commute_distance_by_mode (SKIP)"
ACT_EMPTY, ACT_MISSING = "table empty (not generated yet)", "table missing (not generated yet)"
CHK_EMPTY, CHK_MISSING = "table empty (API/mock not run yet)", "table missing (API/mock not run yet)"
RULE_EMPTY, RULE_MISSING = "commute_distance_checks empty", "table missing"

REPORT_COLUMNS = ("check_order", "check_name", "ok", "details")


# ---------------------------------------------------------------------------
# Per-table metrics (one-row aggregates)
# ---------------------------------------------------------------------------
def table_metrics(df: DataFrame, checks, key: str | None) -> DataFrame:
    """One row: ``_rows`` plus one counter per check (``dup_keys`` -> duplicated keys).

    The ``count_if`` counters are a global aggregate (each task ships one partial
    row, no shuffle). Key uniqueness is a separate ``groupBy(key).count()`` whose
    shuffle carries only (key, count) -- not the counters -- and whose partial
    aggregate collapses a hot key inside each task. That is two scans of the table
    (three where the commute rule joins it), a deliberate trade: the key scan reads
    one column, and folding the counters into the per-key aggregate would shuffle
    all of them with every key. The one-row results are merged without a join.
    """
    preds = {c.key: F.expr(c.predicate) for c in checks if c.kind == "count_if"}
    counters = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(p).alias(k) for k, p in preds.items()])
    dups = [c.key for c in checks if c.kind == "dup_keys"]
    if not dups:
        return counters
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    dup_row = per_key.agg(*[F.count_if(F.col("_n") > 1).alias(k) for k in dups])
    return _merge_one_row(counters, dup_row)


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row(order: int, name: str, ok: str, details: str, when_empty) -> str:
    """One report row as a SQL ``named_struct`` (the whole array is one expression)."""
    flag = "CAST(NULL AS BOOLEAN)" if when_empty is None else ("TRUE" if when_empty else "FALSE")
    return (f"named_struct('check_order', {order}, 'check_name', {_sql(name)}, 'ok', {ok}, "
            f"'details', {details}, '_when_empty', {flag})")


def _detail(label: str, value: str) -> str:
    return f"concat({_sql(label + '=')}, CAST({value} AS STRING))"


def rule_detail_suffix(params: Params) -> str:
    return (f" (walk/run<={params.max_distance_walk_run_km}km; "
            f"bike/scooter/other<={params.max_distance_bike_scooter_km}km)")


def _check_row(c: Check, params: Params, when_empty: bool | None = False) -> str:
    """``when_empty``: False = only for a filled table, None = always."""
    v = "_rows" if c.kind in ("rows", "volume") else c.key
    if c.kind == "rows":
        return _row(c.order, c.name, f"{v} > 0", _detail(c.label, v), when_empty)
    if c.kind == "volume":
        m = params.min_activities_rows
        details = (f"concat('row_count=', CAST({v} AS STRING), CASE WHEN {v} >= {m} "
                   f"THEN {_sql(f' >= min_required={m}')} ELSE {_sql(f' < min_required={m}')} END)")
        return _row(c.order, c.name, f"{v} >= {m}", details, when_empty)
    if c.kind == "anomalies":
        return _row(c.order, c.name, f"{v} = 0",
                    f"concat('anomalies=', CAST({v} AS STRING), {_sql(rule_detail_suffix(params))})", when_empty)
    return _row(c.order, c.name, f"{v} = 0", _detail(c.label, v), when_empty)


def _explode(metrics: DataFrame, rows: list[str]) -> DataFrame:
    """Report rows from the one-row metrics; SKIP rows only when the table is empty."""
    out = metrics.selectExpr("_rows", f"inline(array({', '.join(rows)}))")
    out = out.where("_when_empty IS NULL OR _when_empty = (_rows = 0)")
    return out.select(*REPORT_COLUMNS)


def _merge_one_row(*frames: DataFrame) -> DataFrame:
    """Combine one-row frames with disjoint columns into one row (union + max, no join)."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


# ---------------------------------------------------------------------------
# Sections
# ---------------------------------------------------------------------------
def employee_section(employees: DataFrame, checks=EMPLOYEE_CHECKS,
                     params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Q1-Q7. Employees are never optional: a missing table is an error, and an empty one
    keeps all its rows in the report, of which Q1 (row count > 0) fails the gate."""
    return employee_rows(table_metrics(employees, checks, "employee_id"), checks, params)


def employee_rows(metrics: DataFrame, checks=EMPLOYEE_CHECKS, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Report rows of the employees' one-row metrics."""
    return _explode(metrics, [_check_row(c, params, when_empty=None) for c in checks])


def activity_section(activities: DataFrame | None, checks=ACTIVITY_CHECKS,
                     params: Params = DEFAULT_PARAMS, with_row_count: bool = True) -> DataFrame | None:
    """Q8-Q16; SKIP (passing) when the table is empty; ``None`` input = missing table."""
    if activities is None:
        return None
    return activity_rows(table_metrics(activities, checks, "activity_id"), checks, params, with_row_count)


def activity_rows(metrics: DataFrame, checks=ACTIVITY_CHECKS, params: Params = DEFAULT_PARAMS,
                  with_row_count: bool = True) -> DataFrame:
    """Report rows of the activities' one-row metrics."""
    rows = [_row(ACT_SKIP_ORDER, ACT_SKIP, "TRUE", _sql(ACT_EMPTY), True)]
    if with_row_count:
        rows.append(_row(ACT_ROWS_ORDER, ACT_ROWS_NAME, "TRUE", _detail("row_count", "_rows"), None))
    rows += [_check_row(c, params) for c in checks]
    return _explode(metrics, rows)


def commute_section(checks_df: DataFrame | None, employees: DataFrame, checks=CHECKS_TABLE_CHECKS,
                    with_rule: bool = True, params: Params = DEFAULT_PARAMS,
                    with_row_count: bool = True) -> DataFrame | None:
    """Q17-Q19; both SKIP rows when the checks table is empty; ``None`` = missing."""
    if checks_df is None:
        return None
    m = table_metrics(checks_df, checks, "check_id")
    if with_rule:
        n_anom = commute_anomalies(checks_df, employees, params).agg(
            F.count(F.lit(1)).alias(RULE_CHECK.key))
        m = _merge_one_row(m, n_anom)
    return commute_rows(m, checks, with_rule, params, with_row_count)


def commute_rows(metrics: DataFrame, checks=CHECKS_TABLE_CHECKS, with_rule: bool = True, params: Params = DEFAULT_PARAMS,
                 with_row_count: bool = True) -> DataFrame:
    """Report rows of the one-row metrics of the distance checks and their rule."""
    rows = [_row(CHK_SKIP_ORDER, CHK_SKIP, "TRUE", _sql(CHK_EMPTY), True)]
    if with_rule:
        rows.append(_row(RULE_SKIP_ORDER, RULE_SKIP, "TRUE", _sql(RULE_EMPTY), True))
    if with_row_count:
        rows.append(_row(CHK_ROWS_ORDER, CHK_ROWS_NAME, "TRUE", _detail("row_count", "_rows"), None))
    rows += [_check_row(c, params) for c in checks]
    if with_rule:
        rows.append(_check_row(RULE_CHECK, params))
    return _explode(metrics, rows)


def _missing_rows(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, "check_order int, check_name string, ok boolean, details string")


def quality_report(employees: DataFrame, activities: DataFrame | None,
                   commute_checks: DataFrame | None, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Q20: every check as a row; missing optional tables become passing SKIP rows."""
    return assemble_report(employees.sparkSession, employee_section(employees, params=params),
                           activity_section(activities, params=params),
                           commute_section(commute_checks, employees, params=params))


def assemble_report(spark, employee_part: DataFrame, activity_part: DataFrame | None,
                    commute_part: DataFrame | None) -> DataFrame:
    """One report of the tables' rows; a missing optional table is a passing SKIP row."""
    if activity_part is None:
        activity_part = _missing_rows(spark, [(ACT_SKIP_ORDER, ACT_SKIP, True, ACT_MISSING)])
    if commute_part is None:
        commute_part = _missing_rows(spark, [(CHK_SKIP_ORDER, CHK_SKIP, True, CHK_MISSING),
                                             (RULE_SKIP_ORDER, RULE_SKIP, True, RULE_MISSING)])
    return employee_part.unionByName(activity_part).unionByName(commute_part)


def single_check(key: str, employees: DataFrame, activities: DataFrame | None = None,
                 commute_checks: DataFrame | None = None, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """One check alone (only the columns it needs are scanned)."""
    for c in EMPLOYEE_CHECKS:
        if c.key == key:
            return employee_section(employees, (c,), params)
    for c in ACTIVITY_CHECKS:
        if c.key == key:
            return activity_section(activities, (c,), params, with_row_count=False)
    for c in CHECKS_TABLE_CHECKS:
        if c.key == key:
            return commute_section(commute_checks, employees, (c,), with_rule=False, params=params,
                                   with_row_count=False)
    if key == RULE_CHECK.key:
        return commute_section(commute_checks, employees, (), with_rule=True, params=params,
                               with_row_count=False)
    raise KeyError(key)


def quality_gate(report: DataFrame) -> DataFrame:
    """Q21: AND of all checks, as one row (``gate_ok``, failed and total counts)."""
    return report.agg(F.bool_and("ok").alias("gate_ok"),
                      F.count_if(~F.col("ok")).alias("failed_checks"),
                      F.count(F.lit(1)).alias("checks"))


def gate_passes(employees: DataFrame, activities: DataFrame | None, commute_checks: DataFrame | None,
                params: Params = DEFAULT_PARAMS) -> bool:
    """The verdict alone: the tables are checked one after the other, up to the first that fails."""
    sections = (lambda: employee_section(employees, params=params),
                lambda: activity_section(activities, params=params),
                lambda: commute_section(commute_checks, employees, params=params))
    for section in sections:
        part = section()
        if part is not None and not part.where("NOT ok").isEmpty():
            return False
    return True


def enforce_gate(report: DataFrame) -> bool:
    """Raise when the gate fails (the blocking behaviour).

    The report has one row per check (about 25, whatever the data size), so it
    is collected once: the underlying scans run a single time.
    """
    rows = report.select("check_name", "ok", "details").collect()
    failed = [r for r in rows if not r.ok]
    if failed:
        raise QualityGateError(failed)
    return True


class QualityGateError(RuntimeError):
    def __init__(self, failed):
        self.failed = failed
        super().__init__("quality gate failed: " + "; ".join(f"{r.check_name} ({r.details})" for r in failed))


def fail_pass_demo(employees: DataFrame, seeded: DataFrame, repaired: DataFrame,
                   params: Params = DEFAULT_PARAMS) -> DataFrame:
    """FAIL -> PASS: the commute rule on mock checks before and after their repair."""
    def stage(name, checks):
        return commute_anomalies(checks, employees, params).agg(
            F.count(F.lit(1)).alias("anomalies")).select(
            F.lit(name).alias("stage"), "anomalies", (F.col("anomalies") == 0).alias("rule_ok"))
    return stage("after_seed", seeded).unionByName(stage("after_repair", repaired))


ALL_CHECK_KEYS = tuple(c.key for c in EMPLOYEE_CHECKS + ACTIVITY_CHECKS + CHECKS_TABLE_CHECKS) + (RULE_CHECK.key,)
