"""Clean zone (C1-C9): typing, key repair, the sport-survey join and dedup.

Everything is a projection or filter over the raw snapshot except two steps:
the HR x survey join on the coerced id (C3), and activity dedup (C6), a
``row_number() = 1`` whose per-task limit runs before the shuffle, so a hot key
sends one row per task.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coerce, rules
from ..functions.keys import MAX_BIGINT_KEY, bounded_key
from ..functions.rules import ts_literal

ACTIVITY_COLUMNS = ("activity_id", "employee_id", "start_ts", "end_ts", "sport_type",
                    "distance_m", "elapsed_s", "comment_text")


def coerce_employee_id(raw: DataFrame) -> DataFrame:
    """Numeric ``employee_id`` from ``employee_id_raw``; rows that do not parse are dropped."""
    return raw.withColumn("employee_id", coerce.to_bigint_id(F.col("employee_id_raw"))) \
        .where(F.col("employee_id").isNotNull())


def rejected_ids(raw: DataFrame) -> DataFrame:
    """The rows C1 drops, kept as a quarantine with a reason."""
    parsed = coerce.to_bigint_id(F.col("employee_id_raw"))
    reason = (F.when(F.col("employee_id_raw").isNull(), F.lit("missing"))
              .when(coerce.to_number(F.col("employee_id_raw")).isNull(), F.lit("not_numeric"))
              .otherwise(F.lit("out_of_range")))
    return raw.where(parsed.isNull()).select(
        "ingested_ts", "source_file", "employee_id_raw", reason.alias("reject_reason"))


def join_sport_profile(hr: DataFrame, sport: DataFrame) -> DataFrame:
    """HR rows LEFT JOIN survey rows on the coerced id.

    Many-to-many on purpose: a duplicated survey id duplicates the HR row, which
    the primary-key validator then reports (it is not silently de-duplicated).

    One left join: two scans, two shuffles. A hot HR id is split by adaptive
    execution (left side of a left join); a survey id that repeats often would not
    be, but the job rejects a survey with duplicate ids before it joins
    (``duplicate_survey_ids``).
    """
    h = coerce_employee_id(hr)
    sp = coerce_employee_id(sport).select("employee_id", "sport_practice_raw")
    return h.join(sp, "employee_id", "left")


def duplicate_survey_ids(sport: DataFrame) -> DataFrame:
    """Survey ids answered more than once, with their number of answers (partial counts before the shuffle)."""
    return (coerce_employee_id(sport).groupBy("employee_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .where("n_rows > 1"))


def clean_employees(hr_latest: DataFrame, sport_latest: DataFrame, load_ts: datetime) -> DataFrame:
    """C4 + C5: the 14-column typed employee table.

    Dates that do not parse become NULL, a missing salary becomes 0, paid leave
    is rounded like an integer column would store it, everyone is active, and
    ``updated_ts`` is the load time (one value per load).
    """
    df = join_sport_profile(hr_latest, sport_latest)
    return df.select(
        "employee_id",
        F.col("last_name_raw").alias("last_name"),
        F.col("first_name_raw").alias("first_name"),
        coerce.to_date_lenient(F.col("birth_date_raw")).alias("birth_date"),
        F.col("bu_raw").alias("bu"),
        coerce.to_date_lenient(F.col("hire_date_raw")).alias("hire_date"),
        coerce.to_money(F.col("gross_salary_raw")).alias("gross_salary"),
        F.col("contract_type_raw").alias("contract_type"),
        coerce.to_int_rounded(F.col("paid_leave_raw")).alias("paid_leave_days"),
        F.col("home_address_raw").alias("home_address"),
        F.col("commute_mode_raw").alias("commute_mode"),
        F.col("sport_practice_raw").alias("sport_profile"),
        F.lit(True).alias("is_active"),
        ts_literal(load_ts).alias("updated_ts"),
    )


def clean_activities(activities: DataFrame) -> DataFrame:
    """One row per ``activity_id``; the kept row is the first by
    (start_ts, employee_id, end_ts, sport_type, distance_m, elapsed_s, comment_text),
    NULLs first -- a deterministic "keep first".

    ``row_number() = 1`` plans with a group limit of one row on both sides of the
    shuffle: a heavily repeated id costs one row per task.
    """
    order = ("start_ts", "employee_id", "end_ts", "sport_type", "distance_m", "elapsed_s", "comment_text")
    first = Window.partitionBy("activity_id").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (activities.select(*ACTIVITY_COLUMNS).withColumn("_rn", F.row_number().over(first))
            .where("_rn = 1").drop("_rn"))


ACTIVITY_NATURAL_KEY = ("employee_id", "start_ts", "end_ts", "sport_type", "distance_m", "elapsed_s")


def bounded_activity_id(activities: DataFrame, natural_key=ACTIVITY_NATURAL_KEY) -> DataFrame:
    """Replace ``activity_id`` by a reproducible hash of the natural key, in [0, 9e18)."""
    return activities.withColumn("activity_id", bounded_key(*[F.col(c) for c in natural_key]))


def activity_id_report(activities: DataFrame) -> DataFrame:
    """C7 check: ids are in range and as many as distinct natural keys (no collision)."""
    return activities.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("activity_id").alias("n_distinct_ids"),
        F.count_distinct(F.struct(*ACTIVITY_NATURAL_KEY)).alias("n_natural_keys"),
        F.bool_and((F.col("activity_id") >= 0) & (F.col("activity_id") < F.lit(MAX_BIGINT_KEY)))
         .alias("all_in_range"),
    )


def derive_activity_window(activities: DataFrame) -> DataFrame:
    """``end = start + elapsed`` when the end is missing, and the elapsed seconds of the window."""
    derived_end = F.col("start_ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("elapsed_s"))
    return activities.select(
        "activity_id", "start_ts",
        F.coalesce(F.col("end_ts"), derived_end).alias("end_ts"),
        F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts")).alias("window_s"),
        "elapsed_s",
    )


def _distance_band(sport):
    low = F.lower(sport)
    lo = F.lit(rules.DEFAULT_DISTANCE_BAND_M[0])
    hi = F.lit(rules.DEFAULT_DISTANCE_BAND_M[1])
    for name, (a, b) in rules.DISTANCE_BANDS_M.items():
        lo = F.when(low == name, F.lit(a)).otherwise(lo)
        hi = F.when(low == name, F.lit(b)).otherwise(hi)
    return lo, hi


def activity_plausibility(activities: DataFrame, as_of: datetime) -> DataFrame:
    """Per employee, how many activities fall outside the simulator's bands.

    Distance bands per sport, duration 600-7200 s, start within the 365 days
    before ``as_of``, and 5-30 activities per employee. One grouped aggregate.
    """
    lo, hi = _distance_band(F.col("sport_type"))
    dtype = activities.schema["start_ts"].dataType
    since = ts_literal(as_of - timedelta(days=rules.ACTIVITY_LOOKBACK_DAYS), dtype)
    until = ts_literal(as_of, dtype)
    dmin, dmax = rules.DURATION_BAND_S
    nmin, nmax = rules.ACTIVITIES_PER_EMPLOYEE
    agg = activities.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("n_activities"),
        F.count_if(~F.col("distance_m").between(lo, hi)).alias("n_distance_out_of_band"),
        F.count_if(~F.col("elapsed_s").between(dmin, dmax)).alias("n_duration_out_of_band"),
        F.count_if((F.col("start_ts") < since) | (F.col("start_ts") >= until)).alias("n_outside_lookback"),
    )
    return agg.withColumn("count_in_band", F.col("n_activities").between(nmin, nmax))
