"""Expected values measured for the fixture mapping (FIXTURES.md, table B.7) at sf0.01."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from wellspark.operators import benefits as B, commute as K, constraints as V, quality as Q
from wellspark.plans.catalog import QUERIES
from wellspark.sources import fixtures as fx


@pytest.fixture(scope="module")
def benefits(spark, tables_mid):
    return B.employee_benefits(fx.employees(tables_mid), fx.activities(tables_mid), fx.AS_OF_YEAR,
                               fx.LOAD_TS).cache()


def test_benefit_counts(benefits):
    assert benefits.count() == 1500
    split = {(r.eligibility_status, r.eligible_commute, r.eligible_wellness): r.n for r in
             benefits.groupBy("eligibility_status", "eligible_commute", "eligible_wellness")
             .agg(F.count("*").alias("n")).collect()}
    assert split[("ELIGIBLE", True, False)] == 805
    assert split[("ELIGIBLE", True, True)] == 52
    assert split[("ELIGIBLE", False, True)] == 28
    assert split[("NON_ELIGIBLE", False, False)] == 418
    assert split[("NON_ELIGIBLE", True, False)] == 177
    assert split[("NON_ELIGIBLE", True, True)] == 16
    assert split[("NON_ELIGIBLE", False, True)] == 4
    assert benefits.where("eligibility_status = 'ELIGIBLE' AND eligible_commute AND sport_prime_eur = 0").count() == 64
    assert benefits.where("wellness_days = 5").count() == 80
    assert benefits.where("nb_activities_year = 0").count() == 1350
    assert benefits.agg(F.sum("sport_prime_eur")).first()[0] == Decimal("192657.64")


def test_commute_counts(tables_mid):
    checks, emp = fx.commute_checks(tables_mid), fx.employees(tables_mid)
    assert K.commute_anomalies(checks, emp).count() == 7231
    assert checks.where("distance_km IS NULL").count() == 883
    assert K.commute_validation(K.assess_commute(checks, emp), emp).count() == 1500


def test_clean_counts(spark):
    emp = QUERIES["clean_employees"](spark, SF_MID).cache()
    assert emp.count() == 1410
    assert emp.where("sport_profile IS NOT NULL").count() == 920
    assert emp.where("birth_date IS NULL").count() == 354
    assert emp.where("gross_salary = 0").count() == 156
    assert emp.where("paid_leave_days = 26").count() == 202
    assert emp.where("paid_leave_days IS NULL").count() == 202
    sport = fx.sport_raw(__import__("wellspark.sources.tables", fromlist=["Tables"]).Tables(spark, SF_MID))
    assert sport.count() == 1500
    assert sport.where("sport_practice_raw IS NOT NULL").count() == 1125
    assert sport.where("employee_id_raw = 'inconnu'").count() == 30


def test_dirty_gate_counts(spark, tables_mid):
    rep = {r.check_name: r.details for r in QUERIES["quality_report"](spark, SF_MID).collect()}
    assert rep["clean.employees row_count > 0"] == "row_count=1500"
    assert rep["clean.employees employee_id NOT NULL"] == "nulls=25"
    assert rep["clean.employees employee_id UNIQUE"] == "duplicates=26"
    assert rep["clean.employees gross_salary NOT NULL"] == "nulls=66"
    assert rep["clean.employees gross_salary > 0"] == "bad=121"
    assert rep["clean.employees home_address NOT NULL"] == "null_or_empty=232"
    assert rep["clean.employees commute_mode NOT NULL"] == "null_or_empty=150"
    assert rep["clean.activities activity_id NOT NULL"] == "nulls=189"
    assert rep["clean.activities activity_id UNIQUE"] == "duplicates=164"
    assert rep["clean.activities employee_id NOT NULL"] == "nulls=164"
    assert rep["clean.activities elapsed_s >= 0"] == "bad=104"
    assert rep["clean.activities distance_m >= 0 (when present)"] == "bad=137"
    assert rep["clean.activities start_ts NOT NULL"] == "nulls=150"
    assert rep["clean.activities end_ts NOT NULL"] == "nulls=141"
    assert rep["clean.activities end_ts >= start_ts"] == "bad=110"
    assert rep["volumetry.activities_min_rows (post-generation)"] == "row_count=10000 >= min_required=2000"
    assert rep["raw.commute_distance_checks employee_id NOT NULL"] == "nulls=149"
    assert rep["raw.commute_distance_checks distance_km >= 0 (when present)"] == "bad=146"
    nn = {r.column_name: r.null_count for r in
          V.not_null_violations(fx.dirty_employees(tables_mid), ("last_name",), "e").collect()}
    assert nn["last_name"] == 37
    assert V.fk_orphans(fx.dirty_activities(tables_mid), fx.employees(tables_mid), "employee_id").count() == 119


def test_fail_pass(spark):
    rows = {r.stage: (r.anomalies, r.rule_ok) for r in QUERIES["commute_fail_pass"](spark, SF_MID).collect()}
    assert rows == {"after_seed": (5, False), "after_repair": (0, True)}


def test_volume_threshold_small(spark):
    rep = {r.check_name: (r.ok, r.details) for r in QUERIES["quality_report_clean"](spark, "/root/testdata/sf0.001").collect()}
    assert rep["volumetry.activities_min_rows (post-generation)"] == (False, "row_count=1000 < min_required=2000")
