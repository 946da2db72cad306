"""Declared table schemas (one StructType per table) and their constraints.

Parquet enforces none of the declared keys, foreign keys or CHECKs; they are
listed here as data so the validators in ``operators.constraints`` can apply
them to any DataFrame before it is written.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, B, D = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.DateType()
TS = T.TimestampNTZType()
MONEY, KM, RATE = T.DecimalType(12, 2), T.DecimalType(8, 3), T.DecimalType(6, 4)


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW_HR_SNAPSHOT = _schema(
    ("snapshot_id", L, False), ("ingested_ts", TS, False), ("source_file", S, False),
    ("employee_id_raw", S, True), ("last_name_raw", S, True), ("first_name_raw", S, True),
    ("birth_date_raw", S, True), ("bu_raw", S, True), ("hire_date_raw", S, True),
    ("gross_salary_raw", S, True), ("contract_type_raw", S, True), ("paid_leave_raw", S, True),
    ("home_address_raw", S, True), ("commute_mode_raw", S, True),
)

RAW_SPORT_SNAPSHOT = _schema(
    ("snapshot_id", L, False), ("ingested_ts", TS, False), ("source_file", S, False),
    ("employee_id_raw", S, True), ("sport_practice_raw", S, True),
)

COMMUTE_CHECKS = _schema(
    ("check_id", L, False), ("computed_ts", TS, False), ("employee_id", L, False),
    ("home_address", S, False), ("company_address", S, False), ("commute_mode", S, False),
    ("distance_km", KM, True), ("duration_s", I, True), ("api_provider", S, False),
    ("api_status", S, False), ("is_within_rule", B, True), ("rule_name", S, True),
    ("anomaly_reason", S, True),
)

EMPLOYEES = _schema(
    ("employee_id", L, False), ("last_name", S, False), ("first_name", S, False),
    ("birth_date", D, True), ("bu", S, True), ("hire_date", D, True),
    ("gross_salary", MONEY, False), ("contract_type", S, True), ("paid_leave_days", I, True),
    ("home_address", S, True), ("commute_mode", S, True), ("sport_profile", S, True),
    ("is_active", B, False), ("updated_ts", TS, False),
)

ACTIVITIES = _schema(
    ("activity_id", L, False), ("employee_id", L, False), ("start_ts", TS, False),
    ("end_ts", TS, False), ("sport_type", S, False), ("distance_m", I, True),
    ("elapsed_s", I, False), ("comment_text", S, True),
)

COMMUTE_VALIDATION = _schema(
    ("employee_id", L, False), ("last_computed_ts", TS, False), ("distance_km", KM, True),
    ("commute_mode", S, True), ("is_within_rule", B, True), ("rule_name", S, True),
    ("anomaly_reason", S, True), ("api_provider", S, False), ("api_status", S, False),
)

EMPLOYEE_BENEFITS = _schema(
    ("employee_id", L, False), ("eligibility_status", S, False), ("eligible_commute", B, False),
    ("eligible_wellness", B, False), ("sport_prime_eur", MONEY, False), ("wellness_days", I, False),
    ("commute_mode", S, True), ("sport_profile", S, True), ("gross_salary", MONEY, True),
    ("nb_activities_year", I, False), ("nb_sport_activities_year", I, False),
    ("rule_prime", S, False), ("rule_wellness", S, False), ("computed_ts", TS, False),
)

DIM_EMPLOYEE = _schema(
    ("employee_id", L, False), ("last_name", S, True), ("first_name", S, True), ("bu", S, True),
    ("hire_date", D, True), ("gross_salary", MONEY, True), ("contract_type", S, True),
    ("sport_profile", S, True), ("commute_mode", S, True),
)

FACT_ACTIVITY = _schema(
    ("activity_id", L, False), ("employee_id", L, False), ("activity_date", D, False), ("sport_type", S, False),
    ("distance_m", I, True), ("elapsed_s", I, True), ("comment_text", S, True),
)

FACT_SPORT_BONUS = _schema(
    ("employee_id", L, False), ("year", I, False), ("gross_salary", MONEY, False), ("prime_rate", RATE, False),
    ("prime_amount", MONEY, False), ("is_eligible", B, False), ("eligibility_reason", S, True),
    ("computed_ts", TS, False),
)

FACT_WELLNESS_DAYS = _schema(
    ("employee_id", L, False), ("year", I, False), ("activities_count", I, False), ("min_required", I, False),
    ("max_days", I, False), ("days_granted", I, False), ("is_eligible", B, False), ("computed_ts", TS, False),
)

FACT_DECLARATION_ANOMALIES = _schema(
    ("anomaly_id", L, False), ("employee_id", L, False), ("computed_ts", TS, False), ("commute_mode", S, True),
    ("distance_km", KM, True), ("rule_name", S, False), ("anomaly_reason", S, True),
)

KPI_PIPELINE_DAILY = _schema(
    ("kpi_date", D, False), ("dag_id", S, False), ("rows_rh_ingested", L, True), ("rows_sport_ingested", L, True),
    ("rows_activities_generated", L, True), ("anomalies_count", L, True), ("status", S, False),
)

PIPELINE_RUN = _schema(
    ("run_id", L, False), ("dag_id", S, False), ("status", S, False), ("started_ts", TS, False),
    ("ended_ts", TS, True), ("error_message", S, True),
)

PIPELINE_TASK_RUN = _schema(
    ("run_id", L, False), ("dag_id", S, False), ("task_id", S, False), ("status", S, False),
    ("started_ts", TS, True), ("ended_ts", TS, True), ("rows_in", L, True), ("rows_out", L, True),
    ("error_message", S, True),
)

QUALITY_REPORT = _schema(
    ("check_order", I, False), ("check_name", S, False), ("ok", B, False), ("details", S, True),
)

CONFIG_PARAMETERS = _schema(
    ("param_name", S, False), ("param_value_text", S, False), ("param_type", S, False),
    ("unit", S, True), ("description", S, True), ("effective_from", TS, False),
    ("effective_to", TS, True),
)

# Declared integrity, as data: table -> primary key, foreign keys, checks.
PRIMARY_KEYS = {
    "config_parameters": ("param_name",),
    "employees": ("employee_id",),
    "activities": ("activity_id",),
    "commute_distance_checks": ("check_id",),
    "rh_employees_snapshot": ("snapshot_id",),
    "sport_profile_snapshot": ("snapshot_id",),
    "commute_validation": ("employee_id",),
    "dim_employee": ("employee_id",),
    "fact_activity": ("activity_id",),
    "fact_sport_bonus": ("employee_id", "year"),
    "fact_wellness_days": ("employee_id", "year"),
    "fact_declaration_anomalies": ("anomaly_id",),
    "kpi_pipeline_daily": ("kpi_date", "dag_id"),
    "employee_benefits": ("employee_id",),
}

FOREIGN_KEYS = {  # child table -> (child column, parent table, parent column)
    "activities": [("employee_id", "employees", "employee_id")],
    "commute_validation": [("employee_id", "employees", "employee_id")],
    "fact_activity": [("employee_id", "dim_employee", "employee_id")],
    "fact_sport_bonus": [("employee_id", "dim_employee", "employee_id")],
    "fact_wellness_days": [("employee_id", "dim_employee", "employee_id")],
    "fact_declaration_anomalies": [("employee_id", "dim_employee", "employee_id")],
}

# SQL CHECK constraints (a NULL result passes, as in SQL).
CHECKS = {
    "config_parameters": {"param_type_enum": "param_type IN ('int','float','bool','text')"},
    "activities": {"distance_m_non_negative": "distance_m IS NULL OR distance_m >= 0",
                   "elapsed_s_non_negative": "elapsed_s >= 0"},
}

NOT_NULL = {name: tuple(f.name for f in schema.fields if not f.nullable)
            for name, schema in {"employees": EMPLOYEES, "activities": ACTIVITIES,
                                 "commute_checks": COMMUTE_CHECKS,
                                 "employee_benefits": EMPLOYEE_BENEFITS}.items()}

# What each job conforms its output to before it is written: (zone, table) -> schema.
TABLES = {
    ("raw", "rh_employees_snapshot"): RAW_HR_SNAPSHOT, ("raw", "sport_profile_snapshot"): RAW_SPORT_SNAPSHOT,
    ("raw", "activities_feed"): ACTIVITIES, ("raw", "commute_distance_checks"): COMMUTE_CHECKS,
    ("clean", "employees"): EMPLOYEES, ("clean", "activities"): ACTIVITIES,
    ("clean", "commute_validation"): COMMUTE_VALIDATION,
    ("analytics", "employee_benefits"): EMPLOYEE_BENEFITS, ("analytics", "dim_employee"): DIM_EMPLOYEE,
    ("analytics", "fact_activity"): FACT_ACTIVITY, ("analytics", "fact_sport_bonus"): FACT_SPORT_BONUS,
    ("analytics", "fact_wellness_days"): FACT_WELLNESS_DAYS,
    ("analytics", "fact_declaration_anomalies"): FACT_DECLARATION_ANOMALIES,
    ("analytics", "kpi_pipeline_daily"): KPI_PIPELINE_DAILY,
    ("meta", "quality_report"): QUALITY_REPORT, ("meta", "config_parameters"): CONFIG_PARAMETERS,
}
