"""Jobs in dependency order: ingest -> clean -> activities -> gate -> benefits -> marts.

Each job reads its inputs from the zone tables, writes its outputs there, and
returns. Writing every zone table is also what cuts the lineage: a lost
executor re-reads written files instead of recomputing earlier jobs. Raw zone
tables are append-only histories partitioned by load date; clean activities
are partitioned by activity year so the benefit job's year filter prunes files.

Command line (every job, on the driver tables or on real exports)::

    python -m wellspark --sf-dir /root/testdata/sf0.01 --warehouse <shared path> [--database zones --buckets 512]
    python -m wellspark --hr-csv hr.csv --sport-csv sport.csv --activities feed/ [--checks checks/]
        --load-ts 2024-02-01T00:00:00 --as-of-year 2024 --warehouse <shared path>

With a catalog database and buckets, employees, activities and benefits are
bucketed by ``employee_id`` alike, so the benefit job aggregates and joins
them without any shuffle (``tests/test_jobs.py`` checks the plan).
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import benefits as B
from ..operators import clean as C
from ..operators import commute as K
from ..operators import constraints as V
from ..operators import marts as M
from ..operators import quality as Q
from ..operators import reports as R
from ..operators.config import Params, config_parameters, config_typed, load_params
from ..functions.rules import ts_literal
from ..session import scratch_path, shared_dir
from ..sources import ingest as I
from ..sources import sinks as S
from ..sources.salting import PLACE, SALTED, with_place
from .runlog import RunLog, utc_run_id

DAG_ID = "wellspark_daily"


# Tables keyed by employee: bucketed alike so the benefit job joins and groups them without a shuffle.
EMPLOYEE_KEYED = {("clean", "employees"), ("clean", "activities"), ("analytics", "employee_benefits"),
                  ("raw", "commute_distance_checks"), ("clean", "commute_validation")}


@dataclass(frozen=True)
class Warehouse:
    """Zone tables under one root on shared storage (raw / clean / analytics / meta).

    With ``database`` set, written tables are also registered in the Spark
    catalog as external tables, and with ``buckets`` > 0 the employee-keyed
    tables are bucketed by ``employee_id`` into that many buckets. With ``salt_above``
    an employee with more activities than that is spread over several buckets
    (``sources.salting``).
    """
    root: str
    database: str | None = None
    buckets: int = 0
    salt_above: int = 0

    def path(self, zone: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{table}"

    def table_name(self, zone: str, table: str) -> str | None:
        return f"{self.database}.{zone}_{table}" if self.database else None

    def read(self, spark: SparkSession, zone: str, table: str) -> DataFrame | None:
        name = self.table_name(zone, table)
        if name is not None and spark.catalog.tableExists(name):
            return spark.table(name)
        return I.optional_source(spark, self.path(zone, table))

    def sink(self, zone: str, table: str) -> dict:
        """Extra arguments for the sinks: catalog name and bucketing of this table."""
        name = self.table_name(zone, table)
        if name is None:
            return {}
        out = {"table": name}
        if self.buckets and (zone, table) in EMPLOYEE_KEYED:
            salted = self.salt_above and (zone, table) == ("clean", "activities")
            out.update(bucket_by=PLACE if salted else "employee_id", num_buckets=self.buckets)
        return out

    def prepare(self, spark: SparkSession) -> None:
        if self.database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} "
                      f"LOCATION '{self.root.rstrip('/')}/_catalog'")


def _pk(table: str):
    keys = schemas.PRIMARY_KEYS[table]

    def check(df: DataFrame) -> DataFrame:
        return V.pk_violations(df, keys)
    check.__name__ = f"pk_{table}"
    return check


def _not_null(table: str):
    cols = schemas.NOT_NULL[table]

    def check(df: DataFrame) -> DataFrame:
        return V.not_null_violations(df, cols, table).where(F.col("null_count") > 0)
    check.__name__ = f"not_null_{table}"
    return check


def _fk(table: str, parent: DataFrame):
    (child, _, column), = schemas.FOREIGN_KEYS[table]

    def check(df: DataFrame) -> DataFrame:
        return V.fk_orphans(df, parent, child, column)
    check.__name__ = f"fk_{table}"
    return check


def _write(wh: Warehouse, zone: str, table: str, df: DataFrame, validators=(), partition_by: list[str] | None = None,
           on_written=None) -> DataFrame:
    """Replace a zone table: conformed to its declared schema (partition columns ride along), validated, swapped in."""
    schema = schemas.TABLES.get((zone, table))
    if schema is not None:
        extra = [c for c in (PLACE, *(partition_by or ())) if c not in schema.fieldNames() and c in df.columns]
        df = S.conform(df, T.StructType([*schema.fields, *[df.schema[c] for c in extra]]))
    return S.full_refresh(df, wh.path(zone, table), list(validators), partition_by=partition_by,
                          on_written=on_written, **wh.sink(zone, table))


def _write_activities(wh: Warehouse, acts: DataFrame, validators=(), on_written=None) -> DataFrame:
    """Clean activities by year, and by place where the warehouse spreads hot employees."""
    if not (wh.salt_above and wh.buckets):
        return _write(wh, "clean", "activities", acts, validators, ["activity_year"], on_written)
    acts = with_place(acts.drop(PLACE, SALTED), "employee_id", wh.salt_above, F.col("activity_id"))
    return _write(wh, "clean", "activities", acts, validators, ["activity_year", SALTED], on_written)


def ingest_snapshots(spark: SparkSession, wh: Warehouse, hr_sheet: DataFrame, sport_sheet: DataFrame,
                     load_ts: datetime) -> dict[str, int]:
    """Entry 1a: append one load of each spreadsheet to the raw zone; returns the rows appended.

    Re-running the same load appends nothing: rows that are already in that load
    date's partition (pruned by a literal date) are skipped by a left-anti join on
    the whole row, NULLs equal to NULLs.
    """
    return {"rh_employees_snapshot": append_snapshot(spark, wh, "rh_employees_snapshot", I.ingest_hr_snapshot(hr_sheet, load_ts), load_ts),
            "sport_profile_snapshot": append_snapshot(spark, wh, "sport_profile_snapshot",
                                                      I.ingest_sport_snapshot(sport_sheet, load_ts), load_ts)}


def append_snapshot(spark: SparkSession, wh: Warehouse, table: str, snapshot: DataFrame, load_ts: datetime) -> int:
    """One spreadsheet's load: rows not there yet, each with a ``snapshot_id`` of its own; returns their number."""
    df = S.conform(snapshot, schemas.TABLES["raw", table]).withColumn("ingest_date", F.to_date("ingested_ts"))
    existing = wh.read(spark, "raw", table)
    if existing is not None:
        row = [c for c in df.columns if c not in ("snapshot_id", "ingest_date")]
        seen = existing.where(F.col("ingest_date") == F.lit(load_ts.date())).select(*[F.col(c).alias(f"_{c}") for c in row])
        df = df.join(seen, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in row]), "left_anti")
    # the next numbers after those in use (a scan of one column)
    used = None if existing is None else existing.agg(F.max("snapshot_id")).first()[0]
    return S.append(I.number_snapshot(df, after=used or 0), wh.path("raw", table), partition_by=["ingest_date"])


def land_activities(spark: SparkSession, wh: Warehouse, feed: DataFrame, load_ts: datetime) -> DataFrame:
    """Entry 2a: the feed as it came, one partition per load with its load time (``generated_ts``).

    Loads are only ever added; landing a load again replaces that load, so a bad
    clean table can be rebuilt from here.
    """
    path = f"{wh.path('raw', 'activities_feed')}/load={load_ts:%Y%m%dT%H%M%S}"
    S.observed_write(S.conform(feed, schemas.ACTIVITIES).withColumn("generated_ts", ts_literal(load_ts)), path)
    return spark.read.parquet(path)


def build_clean_employees(spark: SparkSession, wh: Warehouse, load_ts: datetime,
                          cascade: str = "prune", on_written=None) -> DataFrame:
    """Entry 1b: latest snapshots -> typed employees, validated, then written.

    Rows whose id does not parse or whose salary does not fit go to the quarantine
    with the reason. ``cascade`` decides what happens to dependent activities (I6).
    """
    hr = I.latest_snapshot(wh.read(spark, "raw", "rh_employees_snapshot"), partition_col="ingest_date")
    sp = I.latest_snapshot(wh.read(spark, "raw", "sport_profile_snapshot"), partition_col="ingest_date")
    twice = [r.asDict() for r in C.duplicate_survey_ids(sp).limit(5).collect()]
    if twice:
        raise S.ValidationError(f"pk_employees would fail: the survey answers twice for {twice}")
    emp = C.clean_employees(hr, sp, load_ts)
    oversized = (emp.where("gross_salary IS NULL")
                 .select(F.col("employee_id").cast("string").alias("employee_id_raw"), F.lit("salary_out_of_range").alias("reject_reason")))
    S.full_refresh(C.rejected_ids(hr).select("employee_id_raw", "reject_reason").unionByName(oversized),
                   wh.path("quarantine", "employees"), **wh.sink("quarantine", "employees"))
    written = _write(wh, "clean", "employees", emp.where("gross_salary IS NOT NULL"),
                     [_pk("employees"), _not_null("employees")], on_written=on_written)
    acts = wh.read(spark, "clean", "activities")
    if acts is not None:
        _write_activities(wh, S.cascade_refresh(acts, written, mode=cascade))
    validation = wh.read(spark, "clean", "commute_validation")
    if validation is not None:
        _write(wh, "clean", "commute_validation", S.cascade_refresh(validation, written, mode=cascade))
    return written


def load_activities(spark: SparkSession, wh: Warehouse, feed: DataFrame, on_written=None) -> DataFrame:
    """Entry 2b: activity feed -> de-duplicated clean.activities, partitioned by year.

    Rows that break a declared constraint (NULL in a required column, a CHECK, an
    unknown employee) go to the quarantine with all their reasons; the others are
    de-duplicated and written. Nothing is dropped unreported.
    """
    emp = wh.read(spark, "clean", "employees")
    I.require_non_empty(emp, "clean.employees")
    judged = V.reject_reasons(S.conform(feed, schemas.ACTIVITIES), schemas.NOT_NULL["activities"],
                              schemas.CHECKS["activities"], emp, "employee_id")
    scratch = scratch_path(spark, "judged-activities")
    S.observed_write(judged, scratch)  # computed once, read twice
    judged = spark.read.schema(judged.schema).parquet(scratch)
    S.full_refresh(judged.where(F.size("reject_reasons") > 0), wh.path("quarantine", "activities"),
                   **wh.sink("quarantine", "activities"))
    acts = C.clean_activities(judged.where(F.size("reject_reasons") == 0)).withColumn("activity_year", F.year("start_ts"))
    out = _write_activities(wh, acts, [_pk("activities")], on_written)
    S.delete(spark, scratch)
    return out


def follow_activities(spark: SparkSession, wh: Warehouse, feed: DataFrame, checkpoint: str | None = None,
                      available_now: bool = True):
    """Entry 2b as a stream: clean.activities kept current from a streaming feed, rejected rows beside it.

    Takes over the table that ``load_activities`` has written; returns the running query.
    """
    from ..streaming.activity_feed import start_clean_activities

    if wh.database or wh.salt_above:
        raise ValueError("a stream keeps path tables only: bucketed tables are rebuilt by load_activities")
    emp = wh.read(spark, "clean", "employees")
    I.require_non_empty(emp, "clean.employees")
    return start_clean_activities(feed, wh.path("clean", "activities"), checkpoint, available_now, emp)


def load_commute_checks(spark: SparkSession, wh: Warehouse, checks: DataFrame, on_written=None) -> DataFrame:
    """Distance checks into the raw zone: NULLs in required columns go to the quarantine, ids must not repeat."""
    table = "commute_distance_checks"
    judged = V.reject_reasons(S.conform(checks, schemas.COMMUTE_CHECKS), schemas.NOT_NULL["commute_checks"], {})
    bad = F.size("reject_reasons") > 0
    S.full_refresh(judged.where(bad), wh.path("quarantine", table), **wh.sink("quarantine", table))
    return _write(wh, "raw", table, judged.where(~bad), [_pk(table)], on_written=on_written)


def quality_gate(spark: SparkSession, wh: Warehouse, params: Params = Params(),
                 enforce: bool = True) -> DataFrame:
    """Entry 3: the blocking gate; the report is written first, then enforced."""
    emp = wh.read(spark, "clean", "employees")
    if emp is None:
        raise RuntimeError("clean.employees is missing")
    acts = wh.read(spark, "clean", "activities")
    checks = wh.read(spark, "raw", "commute_distance_checks")
    report = Q.quality_report(emp, acts.drop("activity_year") if acts is not None else None, checks, params)
    written = _write(wh, "meta", "quality_report", report)
    if enforce:
        Q.enforce_gate(written)
    return written


def build_benefits(spark: SparkSession, wh: Warehouse, as_of_year: int, computed_ts: datetime,
                   params: Params = Params(), on_written=None) -> DataFrame:
    """Entry 4: analytics.employee_benefits (rebuilt) and the marts built on the same inputs.

    Where there is a parameter table, every year is settled by the rate, minimum and days
    valid at its end; ``params`` gives the rest.
    """
    emp = wh.read(spark, "clean", "employees")
    acts = wh.read(spark, "clean", "activities")
    config = wh.read(spark, "meta", "config_parameters")
    if config is not None:
        settled = load_params(config_typed(config, datetime(as_of_year, 12, 31, 23, 59, 59, 999999)))
        params = replace(params, prime_rate=settled.prime_rate, min_activities_year=settled.min_activities_year,
                         max_wellbeing_days=settled.max_wellbeing_days)
    benefits = B.employee_benefits(emp, acts, as_of_year, computed_ts, params)
    out = _write(wh, "analytics", "employee_benefits", benefits, [_pk("employee_benefits"), _not_null("employee_benefits")],
                 on_written=on_written)
    dim = _write(wh, "analytics", "dim_employee", M.dim_employee(emp), [_pk("dim_employee")])
    facts = M.fact_activity(acts.drop("activity_year")).withColumn("activity_year", F.year("activity_date"))
    _write(wh, "analytics", "fact_activity", facts, [_pk("fact_activity"), _fk("fact_activity", dim)], ["activity_year"])
    _write(wh, "analytics", "fact_sport_bonus", M.fact_sport_bonus(emp, acts, as_of_year, computed_ts, params),
           [_pk("fact_sport_bonus"), _fk("fact_sport_bonus", dim)])
    _write(wh, "analytics", "fact_wellness_days", M.fact_wellness_days(emp, acts, computed_ts, params, config),
           [_pk("fact_wellness_days"), _fk("fact_wellness_days", dim)])
    checks = wh.read(spark, "raw", "commute_distance_checks")
    if checks is not None:
        _write(wh, "analytics", "fact_declaration_anomalies", M.fact_declaration_anomalies(checks, emp, params),
               [_pk("fact_declaration_anomalies"), _fk("fact_declaration_anomalies", dim)])
        _write(wh, "clean", "commute_validation", K.commute_validation(K.assess_commute(checks, emp, params), emp),
               [_pk("commute_validation"), _fk("commute_validation", emp)])
    _write(wh, "analytics", "report_benefit_cost", R.report_benefit_cost(emp, acts, as_of_year, params))
    return out


TASKS = ("ingest_hr", "ingest_sport", "build_clean_employees", "load_activities", "load_commute_checks", "quality_gate",
         "build_benefits", "build_reports")


def run_all(spark: SparkSession, wh: Warehouse, hr_sheet: DataFrame, sport_sheet: DataFrame,
            activity_feed: DataFrame, commute_checks: DataFrame | None, load_ts: datetime,
            as_of_year: int, params: Params = Params(), enforce_gate: bool = True) -> dict:
    """Every job in order; returns the gate outcome and the benefit row count.

    A gate that fails stops the run before the benefits (unless ``enforce_gate`` is
    False); the run log then says which task failed, why, and what was not reached.
    """
    wh.prepare(spark)
    log = RunLog(spark, wh.path("meta", "pipeline_run"), wh.path("meta", "pipeline_task_run"),
                 utc_run_id(load_ts), DAG_ID, TASKS)
    with log:
        with log.task("ingest_hr") as t:
            t.rows_in = hr_sheet.count()   # not observed: a re-run reads only what decides that nothing is new
            t.wrote(append_snapshot(spark, wh, "rh_employees_snapshot", I.ingest_hr_snapshot(hr_sheet, load_ts), load_ts))
        with log.task("ingest_sport") as t:
            t.rows_in = sport_sheet.count()
            t.wrote(append_snapshot(spark, wh, "sport_profile_snapshot", I.ingest_sport_snapshot(sport_sheet, load_ts), load_ts))
        with log.task("build_clean_employees") as t:
            t.rows_in = I.latest_snapshot(wh.read(spark, "raw", "rh_employees_snapshot"), partition_col="ingest_date").count()
            build_clean_employees(spark, wh, load_ts, on_written=t.wrote)
        with log.task("load_activities") as t:
            landed = land_activities(spark, wh, activity_feed, load_ts)
            t.rows_in = landed.count()
            load_activities(spark, wh, landed.drop("generated_ts"), on_written=t.wrote)
        with log.task("load_commute_checks") as t:
            if commute_checks is None:
                t.skipped = "no checks given"
            else:
                t.rows_in = commute_checks.count()
                load_commute_checks(spark, wh, commute_checks, on_written=t.wrote)
        with log.task("quality_gate"):
            report = quality_gate(spark, wh, params, enforce=enforce_gate)
            gate = Q.quality_gate(report).first()
        with log.task("build_benefits") as t:
            t.rows_in = wh.read(spark, "clean", "employees").count()
            build_benefits(spark, wh, as_of_year, load_ts, params, on_written=t.wrote)
            benefit_rows = t.rows_out
        with log.task("build_reports"):
            build_reports(spark, wh, as_of_year, params, bool(gate.gate_ok))
    return {"gate_ok": bool(gate.gate_ok), "failed_checks": int(gate.failed_checks), "benefit_rows": benefit_rows}


def build_reports(spark: SparkSession, wh: Warehouse, as_of_year: int, params: Params = Params(),
                  gate_ok: bool = False) -> None:
    """Dashboard tables (RP1-RP6) and the daily KPI table (M6) from the zone tables."""
    emp = wh.read(spark, "clean", "employees")
    acts = wh.read(spark, "clean", "activities").drop("activity_year")
    checks = wh.read(spark, "raw", "commute_distance_checks")
    out = {
        "report_wellness_days": R.report_wellness_days(emp, acts, as_of_year, params),
        "report_practices": R.report_practices(emp),
        "report_activity_volume": R.report_activity_volume(acts),
        "report_flow_breaks": R.report_flow_breaks(acts),
    }
    anomalies = None
    if checks is not None:
        out["report_anomalies"] = R.report_anomalies(checks, emp, params)
        anomalies = K.commute_anomalies(checks, emp, params)
    hr = wh.read(spark, "raw", "rh_employees_snapshot")
    sp = wh.read(spark, "raw", "sport_profile_snapshot")
    if hr is not None and sp is not None:
        if anomalies is None:
            anomalies = spark.createDataFrame([], "computed_ts timestamp_ntz")
        out["kpi_pipeline_daily"] = M.kpi_pipeline_daily(hr.drop("ingest_date"), sp.drop("ingest_date"), acts,
                                                        anomalies, DAG_ID, gate_ok)
    for name, df in out.items():
        _write(wh, "analytics", name, df)


def commute_fail_pass(spark: SparkSession, wh: Warehouse, computed_ts: datetime,
                      params: Params = Params()) -> dict:
    """The FAIL -> PASS demonstration on the zone tables.

    Seeds mock checks (K4) into raw.commute_distance_checks, runs the gate
    (the distance rule fails), repairs the same table in place (K5 through a
    staged rebuild, since the new content is computed from the table itself)
    and runs the gate again (the rule passes). Seeded rows whose address or
    mode is NULL break the checks table's NOT NULL declaration: they are
    counted and reported, not dropped.
    """
    emp = wh.read(spark, "clean", "employees")
    seeded = K.seed_commute_checks(emp, computed_ts, params=params)
    null_cols = V.not_null_violations(seeded, ("home_address", "commute_mode"), "commute_distance_checks")
    not_null = {r.column_name: r.null_count for r in null_cols.collect()}
    target = wh.path("raw", "commute_distance_checks")
    S.full_refresh(seeded, target, **wh.sink("raw", "commute_distance_checks"))
    before = {r.check_name: r.ok for r in quality_gate(spark, wh, params, enforce=False).collect()}
    current = wh.read(spark, "raw", "commute_distance_checks")
    S.rebuild_table(K.repair_commute_checks(current), target, **wh.sink("raw", "commute_distance_checks"))
    after = {r.check_name: r.ok for r in quality_gate(spark, wh, params, enforce=False).collect()}
    rule = Q.RULE_CHECK.name
    return {"rule_ok_after_seed": before[rule], "rule_ok_after_repair": after[rule],
            "seed_not_null_violations": not_null}


def seed_parameters(spark: SparkSession, wh: Warehouse, effective_from: datetime) -> DataFrame:
    """Write the seeded parameters where there is no parameter table; one that is there keeps its edits."""
    existing = wh.read(spark, "meta", "config_parameters")
    if existing is not None:
        return existing
    return _write(wh, "meta", "config_parameters", config_parameters(spark, effective_from), [_pk("config_parameters")])


def current_params(spark: SparkSession, wh: Warehouse, as_of: datetime) -> Params:
    """The parameter values valid at ``as_of``; defaults when the table is missing."""
    cfg = wh.read(spark, "meta", "config_parameters")
    return Params() if cfg is None else load_params(config_typed(cfg, as_of))


def main(argv=None) -> None:
    from ..session import local_session
    from ..sources import fixtures as fx
    from ..sources.tables import Tables

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_argument_group("inputs: either --sf-dir (driver tables through the fixture mapping) "
                                "or the four real sources")
    src.add_argument("--sf-dir", default=None)
    src.add_argument("--hr-csv", default=None, help="HR spreadsheet exported as CSV (original headers)")
    src.add_argument("--sport-csv", default=None, help="sport survey exported as CSV (original headers)")
    src.add_argument("--activities", default=None, help="activity feed (parquet, clean.activities columns)")
    src.add_argument("--checks", default=None, help="commute distance checks (parquet), optional")
    ap.add_argument("--load-ts", default=None, help="load time, ISO format (default: the fixture's)")
    ap.add_argument("--as-of-year", type=int, default=None, help="benefit year (default: the fixture's)")
    ap.add_argument("--warehouse", default=None, help="root of the zone tables (default: under spark.checkpoint.dir)")
    ap.add_argument("--cores", default="*")
    ap.add_argument("--no-enforce-gate", action="store_true", help="go on although the quality gate fails")
    ap.add_argument("--database", default=None, help="register zone tables in this catalog database")
    ap.add_argument("--buckets", type=int, default=0, help="bucket employee-keyed tables (needs --database)")
    ap.add_argument("--salt-above", type=int, default=0,
                    help="spread an employee with more activities than this over several buckets (needs --buckets)")
    ap.add_argument("--min-activities-rows", type=int, default=None,
                    help="volume threshold of the activity gate (default 2000)")
    a = ap.parse_args(argv)
    if bool(a.sf_dir) == bool(a.hr_csv):
        ap.error("give either --sf-dir or --hr-csv/--sport-csv/--activities")
    spark = local_session(a.cores)
    wh = Warehouse(a.warehouse or f"{shared_dir(spark).rstrip('/')}/warehouse", a.database, a.buckets, a.salt_above)
    load_ts = datetime.fromisoformat(a.load_ts) if a.load_ts else fx.LOAD_TS
    as_of_year = a.as_of_year or fx.AS_OF_YEAR
    if a.sf_dir:
        t = Tables(spark, a.sf_dir)
        hr, sport, feed, checks = fx.hr_sheet(t), fx.sport_sheet(t), fx.activities(t), fx.commute_checks(t)
    else:
        if not (a.sport_csv and a.activities):
            ap.error("--hr-csv needs --sport-csv and --activities")
        hr, sport = I.read_sheet(spark, a.hr_csv), I.read_sheet(spark, a.sport_csv)
        feed = spark.read.parquet(a.activities)
        checks = spark.read.parquet(a.checks) if a.checks else None
    wh.prepare(spark)
    seed_parameters(spark, wh, datetime(load_ts.year, 1, 1))
    params = current_params(spark, wh, load_ts)
    if a.min_activities_rows is not None:
        params = replace(params, min_activities_rows=a.min_activities_rows)
    result = run_all(spark, wh, hr, sport, feed, checks, load_ts, as_of_year, params=params,
                     enforce_gate=not a.no_enforce_gate)
    print({"warehouse": wh.root, **result})


if __name__ == "__main__":
    main()
