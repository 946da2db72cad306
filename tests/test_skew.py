"""Hot keys: one key holding a third of the rows is split, reduced map-side, and exact.

Adaptive execution is forced into sort-merge joins with tiny skew thresholds so
the skew handling that would trigger at scale triggers on test data.
"""

import contextlib
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wellspark.operators import clean as C, commute as K


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _final_plan(df):
    df.collect()  # runs this DataFrame's own QueryExecution, so its adaptive plan is final
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan


@pytest.fixture()
def hot_checks(spark):
    """3,000 checks; employee 7 owns a third of them."""
    n = 3000
    base = spark.range(n).select(
        F.col("id").alias("check_id"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"), F.lit(0))).alias("computed_ts"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997 + 100).cast("bigint").alias("employee_id"),
        (F.lit(Decimal("10.000")) + (F.col("id") % 40)).cast("decimal(8,3)").alias("distance_km"),
    )
    return base


def test_hot_employee_in_commute_join(spark, hot_checks):
    emp = spark.range(0, 1200).select(F.col("id").alias("employee_id"),
                                      F.when(F.col("id") % 2 == 0, F.lit("Marche")).otherwise(F.lit("Vélo"))
                                      .alias("commute_mode"))
    expected = K.commute_anomalies(hot_checks, emp).count()
    with conf(spark, **SKEW):
        df = K.commute_anomalies(hot_checks, emp)
        plan = _final_plan(df)
        assert "SortMergeJoin" in plan and "skew=true" in plan
        assert df.count() == expected
    hot = hot_checks.where("employee_id = 7 AND distance_km > 25").count()  # id 7 is odd: "Vélo", 25 km
    assert K.commute_anomalies(hot_checks, emp).where("employee_id = 7").count() == hot


def test_hot_hr_id_is_split_in_the_survey_join(spark):
    sp = spark.range(0, 2000).select(F.col("id").cast("string").alias("employee_id_raw"),
                                     F.concat(F.lit("s"), F.col("id")).alias("sport_practice_raw"))
    hr = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 1500 + 1000).cast("string"))
        .alias("employee_id_raw"),
        F.concat(F.lit("n"), F.col("id")).alias("last_name_raw"))
    with conf(spark, **SKEW):
        df = C.join_sport_profile(hr, sp)
        assert "skew=true" in _final_plan(df)
        got = df.select("employee_id", "sport_practice_raw").collect()
    assert len(got) == 3000 and sum(1 for r in got if r[0] == 7) == 1000
    assert all(r[1] == (f"s{r[0]}" if r[0] < 2000 else None) for r in got)


def test_hot_key_latest_and_dedup_reduce_map_side(spark, hot_checks):
    checks = hot_checks.select("*", F.lit("Marche").alias("commute_mode"), F.lit(None).cast("boolean").alias("is_within_rule"),
                               F.lit("r").alias("rule_name"), F.lit(None).cast("string").alias("anomaly_reason"),
                               F.lit("P").alias("api_provider"), F.lit("OK").alias("api_status"))
    latest = {r.employee_id: r.last_computed_ts for r in K.commute_validation(checks, spark.range(1200).withColumnRenamed("id", "employee_id")).collect()}
    assert latest[7] == datetime(2024, 1, 1) + timedelta(minutes=2997)
    acts = hot_checks.select(F.when(F.col("check_id") % 3 == 0, F.lit(1)).otherwise(F.col("check_id")).alias("activity_id"),
                             F.col("employee_id"), F.col("computed_ts").alias("start_ts"),
                             F.col("computed_ts").alias("end_ts"), F.lit("running").alias("sport_type"),
                             F.lit(1000).alias("distance_m"), F.lit(600).alias("elapsed_s"),
                             F.lit(None).cast("string").alias("comment_text"))
    out = C.clean_activities(acts)
    assert out.count() == 2000 + 1 - 1  # 1,000 copies of id 1 (plus original id 1) collapse to one row
    assert out.where("activity_id = 1").first().start_ts == datetime(2024, 1, 1)
