"""Hand-written edge rows (FIXTURES.md A.6): every NULL / blank / bound branch of the rules."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wellspark.functions import coerce, rules
from wellspark.operators import benefits as B, clean as C, commute as K

EMP_SCHEMA = ("employee_id bigint, commute_mode string, sport_profile string, "
              "gross_salary decimal(12,2), is_active boolean")
ACT_SCHEMA = ("activity_id bigint, employee_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, "
              "sport_type string, distance_m int, elapsed_s int, comment_text string")


def test_id_coercion(spark):
    big = "9007199254740993"  # 2^53 + 1: a double would lose the last digit
    raw = ["123", "123.0", " 12 ", "1e3", "abc", "", None, "NaN", "inf", "1d", "12,5", big, "-7", "4.9"]
    df = spark.createDataFrame([(x,) for x in raw], "v string")
    got = dict(df.select("v", coerce.to_bigint_id(F.col("v")).alias("id")).collect())
    assert got["123"] == 123 and got["123.0"] == 123 and got[" 12 "] == 12 and got["1e3"] == 1000
    assert got["abc"] is None and got[""] is None and got[None] is None
    assert got["NaN"] is None and got["inf"] is None and got["1d"] is None and got["12,5"] is None
    assert got[big] == 9007199254740993
    assert got["-7"] == -7 and got["4.9"] == 4  # truncation toward zero


def test_date_money_leave_coercion(spark):
    rows = [("1990-05-12 00:00:00", "100.10", "25.5"), ("1990-05-12", None, "24.5"),
            ("31/12/1990", "n/a", "abc"), ("n/a", "0.30", "25"), (None, "", None)]
    df = spark.createDataFrame(rows, "d string, s string, l string")
    out = df.select(coerce.to_date_lenient(F.col("d")).alias("d"), coerce.to_money(F.col("s")).alias("s"),
                    coerce.to_int_rounded(F.col("l")).alias("l")).collect()
    assert [r.d for r in out] == [date(1990, 5, 12), date(1990, 5, 12), None, None, None]
    assert [r.s for r in out] == [Decimal("100.10"), Decimal("0.00"), Decimal("0.00"), Decimal("0.30"),
                                  Decimal("0.00")]
    assert [r.l for r in out] == [26, 25, None, 25, None]  # half away from zero, like an integer column


@pytest.mark.parametrize("mode,expected", [
    (None, False), ("", False), ("  ", False), ("Marche", True), ("Marche/running", True),
    ("course a pied", True), ("VÉLO", True), ("vélo", True), ("vélo", False), ("velo electrique", True),
    ("Trottinette", True), ("Voiture", False),
])
def test_commute_eligible(spark, mode, expected):
    df = spark.createDataFrame([(mode,)], "m string")
    assert df.select(rules.commute_eligible(F.col("m"))).first()[0] is expected


@pytest.mark.parametrize("mode,km,anomaly", [
    ("Marche", "15.000", False), ("Marche", "15.001", True), ("Running", "25.001", True),
    ("Vélo", "25.000", False), ("Vélo", "25.001", True), ("", "25.001", True), ("  ", "20.000", False),
    (None, "99.000", False), ("Marche/running", "20.000", False), ("course a pied", "16.000", True),
    ("Marche", None, False),
])
def test_commute_anomaly_bounds(spark, mode, km, anomaly):
    emp = spark.createDataFrame([(1, mode)], "employee_id bigint, commute_mode string")
    checks = spark.createDataFrame([(10, datetime(2024, 1, 1), 1, Decimal(km) if km else None)],
                                   "check_id bigint, computed_ts timestamp_ntz, employee_id bigint, "
                                   "distance_km decimal(8,3)")
    assert (K.commute_anomalies(checks, emp).count() == 1) is anomaly


def _acts(spark, emp_id, n_valid, extra=()):
    rows = [(emp_id * 1000 + i, emp_id, datetime(2024, 3, 1), datetime(2024, 3, 1, 1), "running", 5000, 3600, None)
            for i in range(n_valid)]
    return spark.createDataFrame(rows + list(extra), ACT_SCHEMA)


def test_benefit_branches(spark):
    emp = spark.createDataFrame([
        (1, "Marche", None, Decimal("100.10"), True),      # bonus 5.01 (half up)
        (2, "Marche", None, Decimal("0.30"), True),        # bonus 0.02
        (3, "Marche", None, Decimal("0.00"), True),        # eligible commute, bonus 0
        (4, "Voiture", None, Decimal("5000.00"), True),    # 15 valid -> wellness only
        (5, "Voiture", None, Decimal("5000.00"), True),    # 14 valid -> nothing
        (6, "Marche", None, Decimal("5000.00"), False),    # inactive
        (7, "Marche", None, Decimal("5000.00"), None),     # unknown activity flag = inactive
        (8, None, None, None, True),                       # NULL salary
    ], EMP_SCHEMA)
    boundary = [
        (90001, 5, datetime(2024, 1, 1), datetime(2024, 1, 1, 1), "walking", 10, 10, None),   # first instant: in
        (90002, 5, datetime(2025, 1, 1), datetime(2025, 1, 1, 1), "walking", 10, 10, None),   # next year: out
        (90003, 5, datetime(2024, 6, 1), datetime(2024, 6, 1, 1), "yoga", 10, 10, None),      # not a sport
        (90004, 5, datetime(2024, 6, 1), datetime(2024, 6, 1, 1), "Hiking", None, 10, None),  # NULL distance
    ]
    acts = _acts(spark, 4, 15).unionByName(_acts(spark, 5, 13, boundary))
    out = {r.employee_id: r for r in B.employee_benefits(emp, acts, 2024, datetime(2024, 2, 1)).collect()}
    assert out[1].sport_prime_eur == Decimal("5.01") and out[1].eligibility_status == "ELIGIBLE"
    assert out[2].sport_prime_eur == Decimal("0.02")
    assert out[3].sport_prime_eur == Decimal("0.00") and out[3].eligibility_status == "ELIGIBLE"
    assert out[4].eligible_wellness and out[4].wellness_days == 5 and out[4].nb_sport_activities_year == 15
    assert out[5].nb_activities_year == 16 and out[5].nb_sport_activities_year == 14
    assert not out[5].eligible_wellness and out[5].eligibility_status == "NON_ELIGIBLE"
    assert out[6].eligibility_status == "NON_ELIGIBLE" and out[6].sport_prime_eur == 0
    assert out[7].eligibility_status == "NON_ELIGIBLE" and out[7].eligible_commute
    assert out[8].sport_prime_eur == 0 and out[8].eligible_commute is False


def test_activity_dedup_keeps_first(spark):
    rows = [(1, 7, datetime(2024, 1, 2), None, "running", 5, 5, None),
            (1, 3, datetime(2024, 1, 1), None, "walking", 5, 5, None),
            (None, 1, None, None, "x", 1, 1, None), (None, 2, None, None, "x", 1, 1, None),
            (2, 5, datetime(2024, 1, 3), None, "cycling", 5, 5, None)]
    out = {r.activity_id: r for r in C.clean_activities(spark.createDataFrame(rows, ACT_SCHEMA)).collect()}
    assert len(out) == 3
    assert out[1].employee_id == 3 and out[1].sport_type == "walking"
    assert out[None].employee_id == 1


def test_latest_snapshot_empty_and_two_loads(spark):
    from wellspark.sources.ingest import latest_snapshot
    schema = "ingested_ts timestamp_ntz, v int"
    assert latest_snapshot(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1), (datetime(2024, 2, 1), 2), (datetime(2024, 2, 1), 3)],
                               schema)
    assert sorted(r.v for r in latest_snapshot(df).collect()) == [2, 3]


def test_duplicate_survey_id_fans_out_and_is_reported(spark):
    from wellspark.operators.constraints import pk_violations
    hr = spark.createDataFrame([("10", "A"), ("11", "B")], "employee_id_raw string, last_name_raw string")
    sp = spark.createDataFrame([("10", "Running"), ("10.0", "Tennis")], "employee_id_raw string, sport_practice_raw string")
    j = C.join_sport_profile(hr, sp)
    assert j.count() == 3
    v = pk_violations(j, ("employee_id",)).collect()
    assert [(r.employee_id, r.n_rows, r.violation) for r in v] == [(10, 2, "duplicate")]


def test_repair_uses_the_checks_own_mode(spark):
    checks = spark.createDataFrame([(1, "marche"), (2, "Vélo"), (3, None)], "check_id bigint, commute_mode string")
    checks = checks.withColumn("distance_km", F.lit(Decimal("50.000")).cast("decimal(8,3)")) \
        .withColumn("is_within_rule", F.lit(None).cast("boolean")).withColumn("anomaly_reason", F.lit("x"))
    out = {r.check_id: r for r in K.repair_commute_checks(checks).collect()}
    assert out[1].distance_km == Decimal("12.000") and out[2].distance_km == Decimal("22.000")
    assert out[3].distance_km == Decimal("22.000") and out[3].is_within_rule and out[3].anomaly_reason is None


def test_check_violations_null_passes(spark):
    from wellspark import schemas
    from wellspark.operators.constraints import check_violations
    df = spark.createDataFrame([(1, None, 5), (2, -1, -1), (3, 5, None)], "activity_id bigint, distance_m int, elapsed_s int")
    got = sorted((r.activity_id, r.constraint_name) for r in
                 check_violations(df, schemas.CHECKS["activities"], ("activity_id",)).collect())
    assert got == [(2, "distance_m_non_negative"), (2, "elapsed_s_non_negative")]


def test_seed_checks_first_15_by_id_and_negative_remainders(spark):
    emp = spark.createDataFrame([(i, "addr", "Marche") for i in list(range(-4, 30, 2))],
                                "employee_id bigint, home_address string, commute_mode string")
    out = {r.employee_id: r for r in K.seed_commute_checks(emp, datetime(2024, 2, 1)).collect()}
    assert sorted(out) == list(range(-4, 26, 2))                     # 15 smallest ids
    assert out[-4].distance_km == Decimal("20.000")                  # -4 % 3 = -1 -> default branch
    assert out[0].distance_km == Decimal("50.000") and out[4].distance_km == Decimal("10.000")
    assert out[0].anomaly_reason == rules.COMMUTE_ANOMALY_REASON and out[4].anomaly_reason is None
    assert sorted(r.check_id for r in out.values()) == list(range(1, 16))
