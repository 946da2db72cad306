"""Dashboard figures (RP1-RP6) computed as Spark aggregates.

All are small grouped outputs over the benefit, employee, activity and anomaly
tables. Shares divide by a total computed once as a scalar subquery -- never a
window without partitioning and never a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .benefits import DEFAULT_PARAMS, rules_applied
from .commute import commute_anomalies
from .config import Params


def _with_share(counts: DataFrame, n_col: str) -> DataFrame:
    """Share of the total: the total is an uncorrelated scalar subquery (computed once), no join."""
    total = counts.select(F.sum(n_col)).scalar()
    return counts.withColumn("share", F.col(n_col) / total)


def report_wellness_days(employees: DataFrame, activities: DataFrame, as_of_year: int,
                         params: Params = DEFAULT_PARAMS) -> DataFrame:
    """RP1: wellness days granted, per business unit."""
    r = rules_applied(employees, activities, as_of_year, params, extra_cols=("bu",))
    return r.groupBy("bu").agg(
        F.sum("wellness_days").cast("bigint").alias("wellness_days_granted"),
        F.count_if(F.col("wellness_days") > 0).alias("employees_granted"))


def report_practices(employees: DataFrame) -> DataFrame:
    """RP2: split of declared sport practices (NULL = not declared), count and share."""
    counts = employees.groupBy("sport_profile").agg(F.count(F.lit(1)).alias("n_employees"))
    return _with_share(counts, "n_employees")


def report_activity_practices(activities: DataFrame) -> DataFrame:
    """RP2 (activity side): split of practised sports in the activity feed, count and share."""
    counts = activities.groupBy(F.lower("sport_type").alias("sport_type")).agg(
        F.count(F.lit(1)).alias("n_activities"),
        F.count_distinct("employee_id").alias("n_employees"))
    return _with_share(counts, "n_activities")


def report_benefit_cost(employees: DataFrame, activities: DataFrame, as_of_year: int,
                        params: Params = DEFAULT_PARAMS) -> DataFrame:
    """RP3: estimated bonus cost per business unit plus the grand total (ROLLUP)."""
    r = rules_applied(employees, activities, as_of_year, params, extra_cols=("bu",))
    return r.rollup("bu").agg(
        (F.grouping("bu") == 1).alias("is_total"),
        F.sum("sport_prime_eur").cast("decimal(18,2)").alias("bonus_cost_eur"),
        F.count_if(F.col("sport_prime_eur") > 0).alias("employees_with_bonus"),
        F.sum("wellness_days").cast("bigint").alias("wellness_days"))


def report_activity_volume(activities: DataFrame) -> DataFrame:
    """RP4: activities, valid distance and duration per calendar month."""
    return (activities.where(F.col("start_ts").isNotNull())
            .groupBy(F.trunc(F.to_date("start_ts"), "month").alias("month"))
            .agg(F.count(F.lit(1)).alias("n_activities"),
                 F.sum("distance_m").cast("bigint").alias("total_distance_m"),
                 F.sum("elapsed_s").cast("bigint").alias("total_elapsed_s")))


def report_anomalies(checks: DataFrame, employees: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """RP5: declaration anomalies per declared mode."""
    return commute_anomalies(checks, employees, params).groupBy("commute_mode").agg(
        F.count(F.lit(1)).alias("n_anomalies"),
        F.count_distinct("employee_id").alias("n_employees"),
        F.max("distance_km").alias("max_distance_km"))


def report_flow_breaks(activities: DataFrame, min_ratio_pct: int = 50) -> DataFrame:
    """RP6: days whose activity count drops below ``min_ratio_pct`` % of the previous
    calendar day (a day without rows counts 0).

    The calendar is generated from the observed min/max dates (one row per day),
    and "previous day" is an equi-join on ``date - 1`` -- no unpartitioned window.
    """
    daily = (activities.where(F.col("start_ts").isNotNull())
             .groupBy(F.to_date("start_ts").alias("activity_date"))
             .agg(F.count(F.lit(1)).alias("n")))
    bounds = daily.agg(F.min("activity_date").alias("lo"), F.max("activity_date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("activity_date"))
    filled = days.join(daily, "activity_date", "left").select(
        "activity_date", F.coalesce(F.col("n"), F.lit(0)).alias("n_activities"))
    prev = filled.select(F.date_add("activity_date", 1).alias("activity_date"),
                         F.col("n_activities").alias("prev_n_activities"))
    out = filled.join(prev, "activity_date", "left")
    brk = F.col("prev_n_activities").isNotNull() & \
        (F.col("n_activities") * 100 < F.col("prev_n_activities") * min_ratio_pct)
    return out.select("activity_date", "n_activities", "prev_n_activities", brk.alias("is_break"))
