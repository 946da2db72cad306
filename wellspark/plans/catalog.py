"""The query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (through the fixture mapping) and runs the
operator over the whole of them; nothing is sampled or capped except where the
limit is the operator itself (the top-5 report, the 15-row mock seed).
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import benefits as B
from ..operators import clean as C
from ..operators import commute as K
from ..operators import constraints as V
from ..operators import marts as M
from ..operators import quality as Q
from ..operators.quality_state import QualityState
from ..operators import reports as R
from ..operators.config import with_params_at
from ..functions.rules import ts_literal
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import ingest as I
from ..sources import sinks as S
from ..sources.tables import Tables
from .runlog import RunLog, read_run_log, read_task_log

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# ---------------------------------------------------------------------------
# Benefits (B1-B9)
# ---------------------------------------------------------------------------
def _rules(spark, sf_dir):
    t = _t(spark, sf_dir)
    return B.rules_applied(fx.employees(t), fx.activities(t), fx.AS_OF_YEAR)


@query("activity_year_counts")
def q_activity_year_counts(spark, sf_dir):
    return B.activity_year_counts(fx.activities(_t(spark, sf_dir)), fx.AS_OF_YEAR)


@query("benefits_base")
def q_benefits_base(spark, sf_dir):
    t = _t(spark, sf_dir)
    counts = B.activity_year_counts(fx.activities(t), fx.AS_OF_YEAR, prefilter=True)
    return B.benefits_base(fx.employees(t), counts)


@query("commute_eligible")
def q_commute_eligible(spark, sf_dir):
    e = fx.employees(_t(spark, sf_dir)).select("employee_id", "commute_mode")
    return B.with_commute_eligible(e)


@query("wellness_eligible")
def q_wellness_eligible(spark, sf_dir):
    return _rules(spark, sf_dir).select("employee_id", "nb_sport_activities_year", "eligible_wellness")


@query("sport_bonus")
def q_sport_bonus(spark, sf_dir):
    return _rules(spark, sf_dir).select("employee_id", "gross_salary", "is_active", "eligible_commute",
                                        "sport_prime_eur")


@query("wellness_days")
def q_wellness_days(spark, sf_dir):
    return _rules(spark, sf_dir).select("employee_id", "is_active", "eligible_wellness", "wellness_days")


@query("eligibility_status")
def q_eligibility_status(spark, sf_dir):
    return _rules(spark, sf_dir).select("employee_id", "is_active", "eligible_commute",
                                        "eligible_wellness", "eligibility_status")


@query("employee_benefits")
def q_employee_benefits(spark, sf_dir):
    t = _t(spark, sf_dir)
    return B.employee_benefits(fx.employees(t), fx.activities(t), fx.AS_OF_YEAR, fx.LOAD_TS)


@query("as_of_year")
def q_as_of_year(spark, sf_dir):
    a = fx.activities(_t(spark, sf_dir))
    return B.as_of_year_activities(a, fx.AS_OF_YEAR).select("activity_id", "employee_id", "start_ts")


# ---------------------------------------------------------------------------
# Commute rule (K1-K6)
# ---------------------------------------------------------------------------
@query("commute_anomalies")
def q_commute_anomalies(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.commute_anomalies(fx.commute_checks(t), fx.employees(t))


@query("commute_anomalies_top5")
def q_commute_anomalies_top5(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.commute_anomalies_top5(fx.commute_checks(t), fx.employees(t))


@query("assess_commute")
def q_assess_commute(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.assess_commute(fx.commute_checks(t), fx.employees(t))


@query("seed_commute_checks")
def q_seed_commute_checks(spark, sf_dir):
    return K.seed_commute_checks(fx.employees(_t(spark, sf_dir)), fx.LOAD_TS)


@query("repair_commute_checks")
def q_repair_commute_checks(spark, sf_dir):
    return K.repair_commute_checks(fx.commute_checks(_t(spark, sf_dir)))


@query("commute_validation")
def q_commute_validation(spark, sf_dir):
    t = _t(spark, sf_dir)
    return K.commute_validation(K.assess_commute(fx.commute_checks(t), fx.employees(t)), fx.employees(t))


# ---------------------------------------------------------------------------
# Quality gate (Q1-Q21) on the dirty fixture variants
# ---------------------------------------------------------------------------
def _dirty(spark, sf_dir):
    t = _t(spark, sf_dir)
    return fx.dirty_employees(t), fx.dirty_activities(t), fx.dirty_commute_checks(t)


def _single(key):
    def run(spark, sf_dir):
        e, a, c = _dirty(spark, sf_dir)
        return Q.single_check(key, e, a, c)
    run.__name__ = f"q_{key}"
    return run


for _key in Q.ALL_CHECK_KEYS:
    query(_key)(_single(_key))


@query("quality_report")
def q_quality_report(spark, sf_dir):
    return Q.quality_report(*_dirty(spark, sf_dir))


def _absorbed(spark, sf_dir) -> QualityState:
    """Employees as one load, activities and checks as three loads each (dealt by hash; keys repeat across them)."""
    e, a, c = _dirty(spark, sf_dir)
    state = QualityState(spark, scratch_path(spark, "quality-state"))
    state.absorb_employees(e, 1)
    for load in range(3):
        state.absorb_activities(a.where(F.pmod(F.xxhash64("end_ts", "employee_id", "elapsed_s"), F.lit(3)) == load), load)
        state.absorb_checks(c.where(F.pmod(F.xxhash64("check_id"), F.lit(3)) == load), load)
    return state


@query("quality_report_incremental")
def q_quality_report_incremental(spark, sf_dir):
    """The report of all loads, each of which was read once, when it came."""
    return _absorbed(spark, sf_dir).report(_dirty(spark, sf_dir)[0])


@query("pk_violations_across_loads")
def q_pk_violations_across_loads(spark, sf_dir):
    a = _dirty(spark, sf_dir)[1]
    state = QualityState(spark, scratch_path(spark, "quality-state"))
    for load in range(3):
        state.absorb_activities(a.where(F.pmod(F.xxhash64("end_ts", "employee_id", "elapsed_s"), F.lit(3)) == load), load)
    return state.activities.duplicate_keys().withColumnRenamed("key", "activity_id")


@query("quality_gate")
def q_quality_gate(spark, sf_dir):
    return Q.quality_gate(Q.quality_report(*_dirty(spark, sf_dir)))


@query("quality_report_clean")
def q_quality_report_clean(spark, sf_dir):
    t = _t(spark, sf_dir)
    return Q.quality_report(fx.employees(t), fx.activities(t), fx.commute_checks(t))


def _no_employees(spark, sf_dir):
    """A load that went wrong: no employee arrived, the other tables are full."""
    t = _t(spark, sf_dir)
    e = fx.employees(t)
    return Q.quality_report(e.where(F.col("employee_id").isNull() & F.col("employee_id").isNotNull()),
                            fx.activities(t), fx.commute_checks(t))


@query("quality_report_no_employees")
def q_quality_report_no_employees(spark, sf_dir):
    return _no_employees(spark, sf_dir)


@query("quality_gate_no_employees")
def q_quality_gate_no_employees(spark, sf_dir):
    return Q.quality_gate(_no_employees(spark, sf_dir))


@query("commute_fail_pass")
def q_commute_fail_pass(spark, sf_dir):
    e = fx.employees(_t(spark, sf_dir))
    seeded = K.seed_commute_checks(e, fx.LOAD_TS)
    return Q.fail_pass_demo(e, seeded, K.repair_commute_checks(seeded))


# ---------------------------------------------------------------------------
# Declared constraints (V1-V4)
# ---------------------------------------------------------------------------
@query("pk_violations")
def q_pk_violations(spark, sf_dir):
    return V.pk_violations(fx.dirty_employees(_t(spark, sf_dir)), schemas.PRIMARY_KEYS["employees"])


@query("pk_violations_composite")
def q_pk_violations_composite(spark, sf_dir):
    t = _t(spark, sf_dir)
    facts = M.fact_sport_bonus(fx.dirty_employees(t), fx.dirty_activities(t), fx.AS_OF_YEAR, fx.LOAD_TS)
    return V.pk_violations(facts, schemas.PRIMARY_KEYS["fact_sport_bonus"])


@query("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    t = _t(spark, sf_dir)
    return V.fk_orphans(fx.dirty_activities(t), fx.employees(t), "employee_id").select("activity_id", "employee_id")


@query("check_violations")
def q_check_violations(spark, sf_dir):
    return V.check_violations(fx.dirty_activities(_t(spark, sf_dir)), schemas.CHECKS["activities"],
                              ("activity_id",))


@query("not_null_violations")
def q_not_null_violations(spark, sf_dir):
    return V.not_null_violations(fx.dirty_employees(_t(spark, sf_dir)), schemas.NOT_NULL["employees"],
                                 "clean.employees")


@query("rejected_checks")
def q_rejected_checks(spark, sf_dir):
    """Distance checks that the declared NOT NULLs keep out, with every reason."""
    judged = V.reject_reasons(fx.dirty_commute_checks(_t(spark, sf_dir)), schemas.NOT_NULL["commute_checks"], {})
    return judged.select("check_id", F.explode("reject_reasons").alias("reject_reason"))


@query("rejected_activities")
def q_rejected_activities(spark, sf_dir):
    """Activities that a NOT NULL, a CHECK or the employees keep out, in the batch and in the stream alike."""
    t = _t(spark, sf_dir)
    judged = V.reject_reasons(fx.dirty_activities(t), schemas.NOT_NULL["activities"], schemas.CHECKS["activities"],
                              fx.employees(t), "employee_id")
    return judged.select("activity_id", F.explode("reject_reasons").alias("reject_reason"))


# ---------------------------------------------------------------------------
# Ingest and sinks
# ---------------------------------------------------------------------------
@query("ingest_hr_snapshot")
def q_ingest_hr_snapshot(spark, sf_dir):
    raw = I.ingest_hr_snapshot(fx.hr_sheet(_t(spark, sf_dir)), fx.HR_SNAPSHOT_TS[1])
    return raw.drop("snapshot_id")


@query("ingest_sport_snapshot")
def q_ingest_sport_snapshot(spark, sf_dir):
    return fx.sport_raw(_t(spark, sf_dir)).drop("snapshot_id")


@query("stamp_snapshot")
def q_stamp_snapshot(spark, sf_dir):
    raw = I.number_snapshot(fx.hr_raw(_t(spark, sf_dir)))
    return raw.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_distinct("snapshot_id").alias("n_snapshot_ids"),
                   F.count_distinct("ingested_ts").alias("n_loads"))


@query("number_snapshot")
def q_number_snapshot(spark, sf_dir):
    """Two loads numbered one after the other, as the ingest job does it."""
    raw = fx.hr_raw(_t(spark, sf_dir))
    first, second = fx.HR_SNAPSHOT_TS
    one = I.number_snapshot(raw.where(F.col("ingested_ts") == ts_literal(first)))
    last = one.agg(F.max("snapshot_id")).first()[0] or 0
    return one.unionByName(I.number_snapshot(raw.where(F.col("ingested_ts") == ts_literal(second)), after=last))


@query("latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    return I.latest_snapshot(fx.hr_raw(_t(spark, sf_dir))).drop("snapshot_id")


def _clean_employees(t):
    hr = I.latest_snapshot(fx.hr_raw(t))
    sp = I.latest_snapshot(fx.sport_raw(t))
    return C.clean_employees(hr, sp, fx.LOAD_TS)


@query("full_refresh")
def q_full_refresh(spark, sf_dir):
    """Writes the clean employees twice (idempotent re-run) and reads the table back."""
    emp = _clean_employees(_t(spark, sf_dir))
    path = scratch_path(spark, "clean_employees")
    pk = lambda df: V.pk_violations(df, schemas.PRIMARY_KEYS["employees"])
    S.full_refresh(emp, path, [pk])
    return S.full_refresh(emp, path, [pk])


@query("cascade_refresh")
def q_cascade_refresh(spark, sf_dir):
    t = _t(spark, sf_dir)
    return S.cascade_refresh(fx.dirty_activities(t), fx.employees(t), mode="prune")


@query("cascade_truncate")
def q_cascade_truncate(spark, sf_dir):
    """The reference's cascade: the children are emptied, and the empty table is written and read back."""
    t = _t(spark, sf_dir)
    empty = S.cascade_refresh(fx.dirty_activities(t), fx.employees(t), mode="truncate")
    path = scratch_path(spark, "activities")
    return S.full_refresh(empty.withColumn("activity_year", F.year("start_ts")), path,
                          partition_by=["activity_year"]).drop("activity_year")


@query("rebuild_table")
def q_rebuild_table(spark, sf_dir):
    t = _t(spark, sf_dir)
    benefits = B.employee_benefits(fx.employees(t), fx.activities(t), fx.AS_OF_YEAR, fx.LOAD_TS)
    path = scratch_path(spark, "employee_benefits")
    return S.rebuild_table(benefits, path, schemas.EMPLOYEE_BENEFITS)


@query("require_non_empty")
def q_require_non_empty(spark, sf_dir):
    return I.require_non_empty(fx.employees(_t(spark, sf_dir)), "clean.employees").select("employee_id")


@query("optional_source")
def q_optional_source(spark, sf_dir):
    t = _t(spark, sf_dir)
    missing = I.optional_source(spark, t.path("activities_archive"))
    return I.source_status({"activities": fx.activities(t), "commute_checks": fx.commute_checks(t),
                            "activities_archive": missing})


# ---------------------------------------------------------------------------
# Clean zone
# ---------------------------------------------------------------------------
@query("coerce_employee_id")
def q_coerce_employee_id(spark, sf_dir):
    hr = I.latest_snapshot(fx.hr_raw(_t(spark, sf_dir)))
    return C.coerce_employee_id(hr).select("employee_id_raw", "employee_id")


@query("rejected_ids")
def q_rejected_ids(spark, sf_dir):
    return C.rejected_ids(I.latest_snapshot(fx.hr_raw(_t(spark, sf_dir))))


@query("join_sport_profile")
def q_join_sport_profile(spark, sf_dir):
    t = _t(spark, sf_dir)
    j = C.join_sport_profile(I.latest_snapshot(fx.hr_raw(t)), I.latest_snapshot(fx.sport_raw(t)))
    return j.select("employee_id", "employee_id_raw", "sport_practice_raw")


@query("clean_employees")
def q_clean_employees(spark, sf_dir):
    return _clean_employees(_t(spark, sf_dir))


@query("stamp_updated_ts")
def q_stamp_updated_ts(spark, sf_dir):
    return _clean_employees(_t(spark, sf_dir)).select("employee_id", "updated_ts")


@query("clean_activities")
def q_clean_activities(spark, sf_dir):
    return C.clean_activities(fx.dirty_activities(_t(spark, sf_dir)))


@query("bounded_activity_id")
def q_bounded_activity_id(spark, sf_dir):
    return C.activity_id_report(C.bounded_activity_id(fx.dirty_activities(_t(spark, sf_dir))))


@query("derive_activity_window")
def q_derive_activity_window(spark, sf_dir):
    return C.derive_activity_window(fx.dirty_activities(_t(spark, sf_dir)))


@query("activity_plausibility")
def q_activity_plausibility(spark, sf_dir):
    return C.activity_plausibility(fx.activities(_t(spark, sf_dir)), fx.LOAD_TS)


# ---------------------------------------------------------------------------
# Marts (M1-M7)
# ---------------------------------------------------------------------------
@query("dim_employee")
def q_dim_employee(spark, sf_dir):
    return M.dim_employee(fx.employees(_t(spark, sf_dir)))


@query("fact_activity")
def q_fact_activity(spark, sf_dir):
    return M.fact_activity(fx.activities(_t(spark, sf_dir)))


@query("fact_sport_bonus")
def q_fact_sport_bonus(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.fact_sport_bonus(fx.employees(t), fx.activities(t), fx.AS_OF_YEAR, fx.LOAD_TS)


@query("fact_wellness_days")
def q_fact_wellness_days(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.fact_wellness_days(fx.employees(t), fx.activities(t), fx.LOAD_TS)


@query("fact_sport_bonus_by_year")
def q_fact_sport_bonus_by_year(spark, sf_dir):
    """Several years, each at its own rate."""
    t = _t(spark, sf_dir)
    return M.fact_sport_bonus_by_year(fx.employees(t), list(fx.FACT_YEARS), fx.LOAD_TS, fx.parameter_versions(t))


@query("fact_wellness_days_by_year")
def q_fact_wellness_days_by_year(spark, sf_dir):
    """Each year's counts under the year's own minimum and days."""
    t = _t(spark, sf_dir)
    return M.fact_wellness_days(fx.employees(t), fx.activities(t), fx.LOAD_TS, config=fx.parameter_versions(t))


@query("activity_parameters")
def q_activity_parameters(spark, sf_dir):
    """Every activity with the parameters valid at its start."""
    t = _t(spark, sf_dir)
    names = ("prime_rate", "min_activities_year", "max_wellbeing_days")
    return with_params_at(fx.activities(t).select("activity_id", "start_ts"), F.col("start_ts"), fx.parameter_versions(t), names)


@query("fact_declaration_anomalies")
def q_fact_declaration_anomalies(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.fact_declaration_anomalies(fx.commute_checks(t), fx.employees(t))


KPI_DAG_ID = "wellspark_daily"


@query("kpi_pipeline_daily")
def q_kpi_pipeline_daily(spark, sf_dir):
    t = _t(spark, sf_dir)
    anomalies = K.commute_anomalies(fx.commute_checks(t), fx.employees(t))
    gate = Q.gate_passes(fx.employees(t), fx.activities(t), fx.commute_checks(t))
    return M.kpi_pipeline_daily(fx.hr_raw(t), fx.sport_raw(t), fx.activities(t), anomalies, KPI_DAG_ID, gate)


RUN_TASKS = ("ingest_hr", "ingest_sport", "build_clean_employees", "load_activities", "load_commute_checks",
             "check_raw_employees", "build_benefits")


@query("run_log")
def q_run_log(spark, sf_dir):
    """A run on a clock of its own (a minute between readings): tasks that succeed, one that is skipped,
    one that fails on its validator, one that is not reached; rows counted by the writes."""
    t, root = _t(spark, sf_dir), scratch_path(spark, "run-log")
    ticks = itertools.count()
    log = RunLog(spark, f"{root}/runs", f"{root}/tasks", 1, KPI_DAG_ID, RUN_TASKS,
                 clock=lambda: fx.LOAD_TS + timedelta(minutes=next(ticks)))
    pk = lambda df: V.pk_violations(df, schemas.PRIMARY_KEYS["employees"])
    try:
        with log:
            with log.task("ingest_hr") as task:
                raw = I.ingest_hr_snapshot(task.reads(fx.hr_sheet(t)), fx.HR_SNAPSHOT_TS[1])
                S.full_refresh(raw, f"{root}/hr", on_written=task.wrote)
            with log.task("ingest_sport") as task:
                raw = I.ingest_sport_snapshot(task.reads(fx.sport_sheet(t)), fx.SPORT_SNAPSHOT_TS)
                S.full_refresh(raw, f"{root}/sport", on_written=task.wrote)
            with log.task("build_clean_employees") as task:
                hr, sport = S.read_table(spark, f"{root}/hr"), S.read_table(spark, f"{root}/sport")
                S.full_refresh(C.clean_employees(task.reads(hr), sport, fx.LOAD_TS), f"{root}/employees", [pk], on_written=task.wrote)
            with log.task("load_activities") as task:
                S.full_refresh(C.clean_activities(task.reads(fx.dirty_activities(t))), f"{root}/activities", on_written=task.wrote)
            with log.task("load_commute_checks") as task:
                task.skipped = "no checks given"
            with log.task("check_raw_employees") as task:
                S.full_refresh(task.reads(fx.dirty_employees(t)), f"{root}/raw_employees", [pk], on_written=task.wrote)
            with log.task("build_benefits"):
                raise AssertionError("not reached")
    except S.ValidationError:
        pass
    return M.run_log(read_run_log(spark, f"{root}/runs"), read_task_log(spark, f"{root}/tasks"))


# ---------------------------------------------------------------------------
# Reports (RP1-RP6)
# ---------------------------------------------------------------------------
@query("report_wellness_days")
def q_report_wellness_days(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.report_wellness_days(fx.employees(t), fx.activities(t), fx.AS_OF_YEAR)


@query("report_practices")
def q_report_practices(spark, sf_dir):
    return R.report_practices(fx.employees(_t(spark, sf_dir)))


@query("report_activity_practices")
def q_report_activity_practices(spark, sf_dir):
    return R.report_activity_practices(fx.activities(_t(spark, sf_dir)))


@query("report_benefit_cost")
def q_report_benefit_cost(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.report_benefit_cost(fx.employees(t), fx.activities(t), fx.AS_OF_YEAR)


@query("report_activity_volume")
def q_report_activity_volume(spark, sf_dir):
    return R.report_activity_volume(fx.activities(_t(spark, sf_dir)))


@query("report_anomalies")
def q_report_anomalies(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.report_anomalies(fx.commute_checks(t), fx.employees(t))


@query("report_flow_breaks")
def q_report_flow_breaks(spark, sf_dir):
    return R.report_flow_breaks(fx.activities(_t(spark, sf_dir)))
