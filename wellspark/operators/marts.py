"""Analytics marts (M1-M7): dimension, facts, daily KPIs and the run log.

The tables are declared by the reference without code; where it is silent the
choice made here is stated in the docstring. Multi-source daily figures are
combined with ``unionByName`` + one ``groupBy`` (one shuffle of a few rows per
day and task) rather than a chain of full outer joins.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.rules import ts_literal
from .benefits import DEFAULT_PARAMS, rules_applied
from .commute import commute_anomalies
from .config import Params, with_params_of_year


def dim_employee(employees: DataFrame) -> DataFrame:
    """M1: nine descriptive columns of the employee."""
    return employees.select("employee_id", "last_name", "first_name", "bu", "hire_date",
                            "gross_salary", "contract_type", "sport_profile", "commute_mode")


def fact_activity(activities: DataFrame) -> DataFrame:
    """M2: activity facts with their (UTC) calendar date."""
    return activities.select("activity_id", "employee_id", F.to_date("start_ts").alias("activity_date"),
                             "sport_type", "distance_m", "elapsed_s", "comment_text")


def fact_sport_bonus(employees: DataFrame, activities: DataFrame, as_of_year: int,
                     computed_ts: datetime, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """M3: bonus per (employee, year) with the configured rate and the reason.

    Reason (our wording): inactive / commute_not_sporty / salary_not_positive / eligible.
    """
    r = rules_applied(employees, activities, as_of_year, params)
    active = F.coalesce(F.col("is_active"), F.lit(False))
    reason = (F.when(~active, F.lit("inactive"))
              .when(~F.col("eligible_commute"), F.lit("commute_not_sporty"))
              .when(F.coalesce(F.col("gross_salary"), F.lit(0)) <= 0, F.lit("salary_not_positive"))
              .otherwise(F.lit("eligible")))
    return r.select(
        "employee_id", F.lit(as_of_year).alias("year"),
        F.coalesce(F.col("gross_salary"), F.lit(0)).cast("decimal(12,2)").alias("gross_salary"),
        F.lit(Decimal(params.prime_rate)).cast("decimal(6,4)").alias("prime_rate"),
        F.col("sport_prime_eur").alias("prime_amount"),
        (F.col("sport_prime_eur") > 0).alias("is_eligible"),
        reason.alias("eligibility_reason"),
        ts_literal(computed_ts).alias("computed_ts"),
    )


def fact_sport_bonus_by_year(employees: DataFrame, years: list[int], computed_ts: datetime, config: DataFrame) -> DataFrame:
    """M3 for several years at once, each at the rate valid at its end (P2 by date).

    One row per employee and year: the bonus depends on no activity, so this is a
    projection of the employees, with no join but the parameters' as-of lookup.
    """
    e = employees.select("employee_id", "commute_mode", "is_active",
                         F.coalesce(F.col("gross_salary"), F.lit(0)).cast("decimal(12,2)").alias("gross_salary"),
                         F.explode(F.array(*[F.lit(y) for y in years])).alias("year"))
    e = with_params_of_year(e, config, ("prime_rate",))
    active, sporty = F.coalesce(F.col("is_active"), F.lit(False)), rules.commute_eligible(F.col("commute_mode"))
    reason = (F.when(~active, F.lit("inactive")).when(~sporty, F.lit("commute_not_sporty"))
              .when(F.col("gross_salary") <= 0, F.lit("salary_not_positive")).otherwise(F.lit("eligible")))
    e = e.withColumn("eligibility_reason", reason)
    amount = F.round(F.col("gross_salary") * F.col("prime_rate"), 2)
    amount = F.when(F.col("eligibility_reason") == "eligible", amount).otherwise(F.lit(0)).cast("decimal(12,2)")
    return e.select("employee_id", "year", "gross_salary", F.col("prime_rate").cast("decimal(6,4)").alias("prime_rate"),
                    amount.alias("prime_amount"), (amount > 0).alias("is_eligible"), "eligibility_reason",
                    ts_literal(computed_ts).alias("computed_ts"))


def fact_wellness_days(employees: DataFrame, activities: DataFrame, computed_ts: datetime,
                       params: Params = DEFAULT_PARAMS, config: DataFrame | None = None) -> DataFrame:
    """M4: valid sport activities per (employee, calendar year) and the days granted.

    Every year in which an existing employee has an activity gets a row;
    granted = the cap when the count reaches the minimum, else 0 (activity rule
    only -- the active flag is applied in ``employee_benefits``). With ``config``, the
    parameter table, every year is judged by the versions valid at its end.
    """
    valid = rules.valid_sport_activity(F.col("sport_type"), F.col("distance_m"), F.col("elapsed_s"))
    counts = (activities.where(F.col("start_ts").isNotNull() & F.col("employee_id").isNotNull())
              .groupBy("employee_id", F.year("start_ts").alias("year"))
              .agg(F.count_if(valid).cast("int").alias("activities_count")))
    known = employees.select("employee_id")
    counts = counts.join(known, "employee_id", "left_semi")
    names = ("min_activities_year", "max_wellbeing_days")
    if config is None:
        counts = counts.withColumns({n: F.lit(getattr(params, n)) for n in names})
    else:
        counts = with_params_of_year(counts, config, names)
    ok = F.col("activities_count") >= F.col("min_activities_year")
    return counts.select(
        "employee_id", "year", "activities_count",
        F.col("min_activities_year").alias("min_required"),
        F.col("max_wellbeing_days").alias("max_days"),
        F.when(ok, F.col("max_wellbeing_days")).otherwise(F.lit(0)).alias("days_granted"),
        ok.alias("is_eligible"),
        ts_literal(computed_ts).alias("computed_ts"),
    )


def fact_declaration_anomalies(checks: DataFrame, employees: DataFrame,
                               params: Params = DEFAULT_PARAMS) -> DataFrame:
    """M5: one row per anomalous check (its id is the anomaly id) with rule and reason."""
    return commute_anomalies(checks, employees, params).select(
        F.col("check_id").alias("anomaly_id"), "employee_id", "computed_ts", "commute_mode",
        "distance_km", F.lit(rules.COMMUTE_RULE_NAME).alias("rule_name"),
        F.lit(rules.COMMUTE_ANOMALY_REASON).alias("anomaly_reason"))


def kpi_pipeline_daily(hr_raw: DataFrame, sport_raw: DataFrame, activities: DataFrame,
                       anomalies: DataFrame, dag_id: str, gate: DataFrame | bool) -> DataFrame:
    """M6: per day, rows loaded per source, anomalies found and the run's status.

    The status is the quality gate's (Q21): ``gate`` is its outcome, or the one-row
    frame of ``quality_gate``, read as a scalar subquery. A gate without a verdict failed.

    A source without rows on a day has NULL for that day (full-outer-join
    semantics). All sources are tagged and unioned, then grouped once: one
    shuffle of (day, tag) partial counts.
    """
    tagged = [
        hr_raw.select(F.to_date("ingested_ts").alias("kpi_date"), F.lit(1).alias("_src")),
        sport_raw.select(F.to_date("ingested_ts").alias("kpi_date"), F.lit(2).alias("_src")),
        activities.select(F.to_date("start_ts").alias("kpi_date"), F.lit(3).alias("_src")),
        anomalies.select(F.to_date("computed_ts").alias("kpi_date"), F.lit(4).alias("_src")),
    ]
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    names = ("rows_rh_ingested", "rows_sport_ingested", "rows_activities_generated", "anomalies_count")
    # a source without rows on a day counts 0 -> NULL, as a full outer join of daily counts would give
    daily = u.where(F.col("kpi_date").isNotNull()).groupBy("kpi_date").agg(
        *[F.nullif(F.count_if(F.col("_src") == i + 1), F.lit(0)).alias(n) for i, n in enumerate(names)])
    return daily.select(
        "kpi_date", F.lit(dag_id).alias("dag_id"), *names,
        F.when(F.lit(gate) if isinstance(gate, bool) else gate.select("gate_ok").scalar(), F.lit("success"))
         .otherwise(F.lit("failed")).alias("status"))


def run_log(runs: DataFrame, tasks: DataFrame) -> DataFrame:
    """M7: the tasks of every run as they were written while it went on, with the run's own outcome.

    ``runs`` and ``tasks`` are the log's tables (``plans.runlog``). A failed task shows the kind of
    its error, a task that was not reached the reason.
    """
    run = runs.select("run_id", F.col("status").alias("run_status"), F.col("started_ts").alias("run_started_ts"),
                      F.col("ended_ts").alias("run_ended_ts"))
    return tasks.join(run, "run_id", "left").select(
        "run_id", "run_status", "dag_id", "task_id", "status", "started_ts", "ended_ts", "rows_in", "rows_out",
        F.timestamp_diff("SECOND", F.col("started_ts"), F.col("ended_ts")).alias("seconds"),
        F.regexp_extract("error_message", "^[^:]*", 0).alias("error_kind"), "run_started_ts", "run_ended_ts")
