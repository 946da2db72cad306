"""Benefit rules (B1-B9): yearly activity counts, eligibility, bonus and wellness days.

Plan shape of the flagship ``employee_benefits``: the activity scan is filtered
to the as-of year (pushed into parquet), aggregated by ``employee_id`` with a
map-side partial aggregate (so a hot employee collapses to one row per task
before the shuffle), then left-joined to employees. All rules are CASE
expressions evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.rules import ts_literal, year_bounds
from ..sources.salting import PLACE, SALTED
from .config import Params

DEFAULT_PARAMS = Params()


def _in_year(activities: DataFrame, as_of_year: int):
    lo, hi = year_bounds(as_of_year)
    dtype = activities.schema["start_ts"].dataType
    return (F.col("start_ts") >= ts_literal(lo, dtype)) & (F.col("start_ts") < ts_literal(hi, dtype))


def as_of_year_activities(activities: DataFrame, as_of_year: int) -> DataFrame:
    """Activities whose start falls in [1 Jan as_of_year, 1 Jan as_of_year+1)."""
    return activities.where(_in_year(activities, as_of_year))


def activity_year_counts(activities: DataFrame, as_of_year: int,
                         prefilter: bool = False, by_place: bool = False) -> DataFrame:
    """B1: per employee, activities of the year and valid sport activities of the year.

    With ``prefilter=False`` every employee that has any activity gets a row
    (zeros included), exactly like a filtered COUNT over the whole table. With
    ``prefilter=True`` rows outside the year are dropped at the scan first --
    the counts of the employees that remain are identical, and the benefit
    table (which coalesces missing counts to 0) is unchanged.
    """
    in_year = _in_year(activities, as_of_year)
    valid = in_year & rules.valid_sport_activity(F.col("sport_type"), F.col("distance_m"),
                                                 F.col("elapsed_s"))
    src = activities
    if prefilter:
        src = activities.where(in_year)
        if "activity_year" in activities.columns:  # year-partitioned table: read one partition
            src = src.where(F.col("activity_year") == F.lit(as_of_year))
    keys = (PLACE, SALTED, "employee_id") if by_place else ("employee_id",)
    return src.groupBy(*keys).agg(
        F.count_if(in_year).alias("nb_activities_year"),
        F.count_if(valid).alias("nb_sport_activities_year"),
    )


def year_counts_by_place(activities: DataFrame, as_of_year: int) -> tuple[DataFrame, DataFrame]:
    """B1 on activities bucketed by place: counts of ordinary and of hot employees.

    Both are grouped inside the buckets. An ordinary employee's count is whole then, and
    ``place`` is the employee's id; a hot one's is in as many rows as it has places,
    and only those few rows are shuffled to be added up.
    """
    counts = activity_year_counts(activities, as_of_year, prefilter=True, by_place=True)
    ordinary = counts.where(~F.col(SALTED)).drop(SALTED, "employee_id")
    hot = (counts.where(SALTED).groupBy("employee_id")
           .agg(*[F.sum(c).alias(c) for c in ("nb_activities_year", "nb_sport_activities_year")]))
    return ordinary, hot


def benefits_base(employees: DataFrame, counts: DataFrame | tuple[DataFrame, DataFrame], extra_cols=()) -> DataFrame:
    """B2: employees LEFT JOIN yearly counts; employees without activity get 0.

    ``counts`` may be those of ``year_counts_by_place``: the ordinary ones meet the
    employees bucket by bucket, the hot ones (a row per hot employee, of whom there are
    no more than rows / ``salt_above``) are broadcast.
    """
    cols = ["employee_id", "commute_mode", "sport_profile", "gross_salary", "is_active", *extra_cols]
    e = employees.select(*cols)
    if isinstance(counts, tuple):
        ordinary, hot = counts
        both = ("nb_activities_year", "nb_sport_activities_year")
        hot = hot.select(F.col("employee_id").alias("_hot"), *[F.col(c).alias(f"_{c}") for c in both])
        joined = (e.join(ordinary, e["employee_id"] == ordinary[PLACE], "left")
                  .join(F.broadcast(hot), F.col("employee_id") == F.col("_hot"), "left"))
        return joined.select(*cols, *[F.coalesce(F.col(c), F.col(f"_{c}"), F.lit(0)).cast("int").alias(c) for c in both])
    return e.join(counts, "employee_id", "left").select(
        *cols,
        F.coalesce(F.col("nb_activities_year"), F.lit(0)).cast("int").alias("nb_activities_year"),
        F.coalesce(F.col("nb_sport_activities_year"), F.lit(0)).cast("int")
         .alias("nb_sport_activities_year"),
    )


def with_commute_eligible(base: DataFrame) -> DataFrame:
    """B3 (R1): sporty commute declared by HR."""
    return base.withColumn("eligible_commute", rules.commute_eligible(F.col("commute_mode")))


def with_wellness_eligible(base: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """B4 (R4): at least ``min_activities_year`` valid sport activities this year."""
    return base.withColumn("eligible_wellness",
                           F.col("nb_sport_activities_year") >= F.lit(params.min_activities_year))


def _active() -> F.Column:
    return F.coalesce(F.col("is_active"), F.lit(False))


def with_sport_bonus(df: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """B5 (R2+R3): active, sporty commute and positive salary -> rate x salary, 2 decimals."""
    rate = F.lit(params.prime_rate)
    ok = _active() & F.coalesce(F.col("eligible_commute"), F.lit(False)) & \
        (F.coalesce(F.col("gross_salary"), F.lit(0)) > 0)
    amount = F.round(F.col("gross_salary").cast("decimal(12,2)") * rate, 2)
    return df.withColumn("sport_prime_eur",
                         F.when(ok, amount).otherwise(F.lit(0)).cast("decimal(12,2)"))


def with_wellness_days(df: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """B6 (R7): active and wellness-eligible -> the fixed number of days, else 0."""
    ok = _active() & F.coalesce(F.col("eligible_wellness"), F.lit(False))
    return df.withColumn("wellness_days",
                         F.when(ok, F.lit(params.max_wellbeing_days)).otherwise(F.lit(0)).cast("int"))


def with_eligibility_status(df: DataFrame) -> DataFrame:
    """B7 (R8-R10): inactive -> NON_ELIGIBLE; any eligibility -> ELIGIBLE; else NON_ELIGIBLE."""
    any_rule = F.coalesce(F.col("eligible_commute"), F.lit(False)) | \
        F.coalesce(F.col("eligible_wellness"), F.lit(False))
    status = F.when(_active() & any_rule, F.lit(rules.ELIGIBLE)).otherwise(F.lit(rules.NON_ELIGIBLE))
    return df.withColumn("eligibility_status", status)


def rules_applied(employees: DataFrame, activities: DataFrame, as_of_year: int,
                  params: Params = DEFAULT_PARAMS, extra_cols=()) -> DataFrame:
    """B2-B7 chained (the CTE chain before projection); ``extra_cols`` ride along from employees."""
    if PLACE in activities.columns:
        counts = year_counts_by_place(activities, as_of_year)
    else:
        counts = activity_year_counts(activities, as_of_year, prefilter=True)
    df = benefits_base(employees, counts, extra_cols)
    df = with_commute_eligible(df)
    df = with_wellness_eligible(df, params)
    df = with_sport_bonus(df, params)
    df = with_wellness_days(df, params)
    return with_eligibility_status(df)


def employee_benefits(employees: DataFrame, activities: DataFrame, as_of_year: int,
                      computed_ts: datetime, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """One row per employee with status, eligibilities, bonus, days and traces."""
    df = rules_applied(employees, activities, as_of_year, params)
    return df.select(
        "employee_id", "eligibility_status", "eligible_commute", "eligible_wellness",
        "sport_prime_eur", "wellness_days", "commute_mode", "sport_profile",
        F.col("gross_salary").cast("decimal(12,2)").alias("gross_salary"),
        "nb_activities_year", "nb_sport_activities_year",
        F.lit(rules.rule_prime_text(params.prime_rate)).alias("rule_prime"),
        F.lit(rules.rule_wellness_text(params.min_activities_year, params.max_wellbeing_days)).alias("rule_wellness"),
        ts_literal(computed_ts).alias("computed_ts"),
    )
