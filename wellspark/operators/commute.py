"""Commute-distance rule (K1-K6).

A check row is an anomaly when its distance exceeds the limit of the
*employee's* declared mode: exact walking/running modes 15 km, any other
non-NULL mode 25 km (strict ``>``; a NULL mode is never flagged).

Plan notes: the check side is pre-filtered with ``distance_km > min(limits)``,
which reaches the parquet scan as a pushed filter; the employee side is
projected to two columns. The join runs on ``employee_id``; adaptive execution
turns it into a broadcast when the employee side is small at run time and
splits a hot employee's partition when it is not. "Latest check per employee"
is a ``row_number() = 1``, whose group limit keeps one row per employee and task
before the shuffle, so a hot employee never lands whole in one task.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.rules import ts_literal
from .config import Params

DEFAULT_PARAMS = Params()
CHECK_COLUMNS = ("check_id", "computed_ts", "employee_id", "home_address", "company_address",
                 "commute_mode", "distance_km", "duration_s", "api_provider", "api_status",
                 "is_within_rule", "rule_name", "anomaly_reason")


def _employee_modes(employees: DataFrame) -> DataFrame:
    return employees.select("employee_id", F.col("commute_mode").alias("employee_mode"))


def commute_anomalies(checks: DataFrame, employees: DataFrame,
                      params: Params = DEFAULT_PARAMS) -> DataFrame:
    """K1: every check row breaking the rule, with the employee's mode."""
    walk, other = params.max_distance_walk_run_km, params.max_distance_bike_scooter_km
    c = checks.select("check_id", "employee_id", "computed_ts", "distance_km").where(
        F.col("distance_km").isNotNull() & (F.col("distance_km") > F.lit(min(walk, other))))
    j = c.join(_employee_modes(employees), "employee_id", "inner")
    return j.where(rules.commute_anomaly(F.col("employee_mode"), F.col("distance_km"), walk, other)) \
        .select("check_id", "employee_id", "computed_ts",
                F.col("employee_mode").alias("commute_mode"), "distance_km")


def commute_anomalies_top5(checks: DataFrame, employees: DataFrame, n: int = 5,
                           params: Params = DEFAULT_PARAMS) -> DataFrame:
    """K2: the ``n`` largest anomalies (ties broken by employee, then check id).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: a per-task top-n
    and a merge of n rows per task, never a full sort.
    """
    return (commute_anomalies(checks, employees, params)
            .orderBy(F.col("distance_km").desc(), F.col("employee_id").asc(), F.col("check_id").asc())
            .limit(n)
            .select("employee_id", "commute_mode", "distance_km"))


def assess_commute(checks: DataFrame, employees: DataFrame,
                   params: Params = DEFAULT_PARAMS) -> DataFrame:
    """K3: fill ``is_within_rule`` / ``rule_name`` / ``anomaly_reason`` on every check.

    The verdict is NULL when the distance or the employee's mode is unknown.
    """
    walk, other = params.max_distance_walk_run_km, params.max_distance_bike_scooter_km
    j = checks.join(_employee_modes(employees), "employee_id", "left")
    mode, dist = F.col("employee_mode"), F.col("distance_km")
    anomaly = rules.commute_anomaly(mode, dist, walk, other)
    verdict = F.when(dist.isNull() | mode.isNull(), F.lit(None).cast("boolean")).otherwise(~anomaly)
    out = {
        "is_within_rule": verdict,
        "rule_name": F.lit(rules.COMMUTE_RULE_NAME),
        "anomaly_reason": F.when(anomaly, F.lit(rules.COMMUTE_ANOMALY_REASON)),
    }
    return j.select(*[out.get(c, F.col(c)).alias(c) for c in CHECK_COLUMNS])


def _mock_distance(emp_id) -> F.Column:
    m = emp_id % 3
    expr = None
    for rem, km in rules.MOCK_DISTANCE_BY_ID_MOD3.items():
        lit = F.lit(Decimal(km)).cast("decimal(8,3)")
        expr = F.when(m == rem, lit) if expr is None else expr.when(m == rem, lit)
    return expr.otherwise(F.lit(Decimal(rules.MOCK_DISTANCE_OTHER)).cast("decimal(8,3)"))


def seed_commute_checks(employees: DataFrame, computed_ts: datetime,
                        n: int = rules.MOCK_SEED_ROWS,
                        params: Params = DEFAULT_PARAMS) -> DataFrame:
    """K4: mock checks for the first ``n`` employees (by id) -- 50/10/20 km by id mod 3.

    The limit is the operator (a fixed-size demonstration set); the id
    numbering window only ever sees those ``n`` rows.
    """
    k = F.col("employee_id")
    top = employees.orderBy(k.asc()).limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(k.asc())).cast("bigint").alias("check_id"),
        ts_literal(computed_ts).alias("computed_ts"),
        k.alias("employee_id"),
        "home_address",
        F.lit(params.company_address).alias("company_address"),
        "commute_mode",
        _mock_distance(k).alias("distance_km"),
        F.lit(3600).alias("duration_s"),
        F.lit("MOCK").alias("api_provider"),
        F.lit("OK").alias("api_status"),
        F.lit(None).cast("boolean").alias("is_within_rule"),
        F.lit(rules.COMMUTE_RULE_NAME).alias("rule_name"),
        F.when(k % 3 == 0, F.lit(rules.COMMUTE_ANOMALY_REASON)).alias("anomaly_reason"),
    )


def repair_commute_checks(checks: DataFrame) -> DataFrame:
    """K5: rewrite every check below its limit using the *check's* own mode.

    Exact walking/running mode -> 12 km, anything else (NULL included) -> 22 km;
    all rows become within the rule with no anomaly reason.
    """
    km = (F.when(rules.is_walk_run_mode(F.col("commute_mode")),
                 F.lit(Decimal(rules.MOCK_REPAIR_WALK_RUN_KM)).cast("decimal(8,3)"))
          .otherwise(F.lit(Decimal(rules.MOCK_REPAIR_OTHER_KM)).cast("decimal(8,3)")))
    out = {"distance_km": km, "is_within_rule": F.lit(True),
           "anomaly_reason": F.lit(None).cast("string")}
    return checks.select(*[out.get(c, F.col(c)).alias(c) for c in checks.columns])


VALIDATION_PAYLOAD = ("distance_km", "commute_mode", "is_within_rule", "rule_name",
                      "anomaly_reason", "api_provider", "api_status")


def commute_validation(assessed: DataFrame, employees: DataFrame) -> DataFrame:
    """K6: one row per known employee -- the latest check (by time, then check id) and its verdict.

    Checks of unknown employees have no row here (the table's foreign key); the
    semi-join runs after the latest check of each employee is found, on one row each.
    """
    recent = Window.partitionBy("employee_id").orderBy(F.col("computed_ts").desc_nulls_last(),
                                                       F.col("check_id").desc_nulls_last())
    latest = (assessed.where(F.col("employee_id").isNotNull())
              .withColumn("_rn", F.row_number().over(recent)).where("_rn = 1"))
    known = employees.select("employee_id").where("employee_id IS NOT NULL")
    return (latest.join(known, "employee_id", "left_semi")
            .select("employee_id", F.col("computed_ts").alias("last_computed_ts"), *VALIDATION_PAYLOAD))
