"""Parameters (P1/P2) and the declared-integrity validators (V1-V4) on hand-written rows."""

from datetime import datetime
from decimal import Decimal

import pytest

from wellspark import schemas
from wellspark.functions import rules
from wellspark.operators import constraints as V, quality as Q
from pyspark.sql import functions as F

from wellspark.operators import marts as M
from wellspark.operators.config import Params, config_parameters, config_typed, load_params, with_params_at, with_params_of_year
from wellspark.plans import jobs
from wellspark.sources import fixtures as fx
from wellspark.sources import sinks as S


def _cfg(spark, rows):
    return spark.createDataFrame(rows, schemas.CONFIG_PARAMETERS)


def test_validity_interval_is_half_open(spark):
    t0, t1, t2 = datetime(2024, 1, 1), datetime(2024, 6, 1), datetime(2025, 1, 1)
    cfg = _cfg(spark, [("prime_rate", "0.05", "float", "ratio", None, t0, t1),
                       ("prime_rate", "0.07", "float", "ratio", None, t1, None)])
    assert load_params(config_typed(cfg, datetime(2024, 5, 31))).prime_rate == Decimal("0.05")
    assert load_params(config_typed(cfg, t1)).prime_rate == Decimal("0.07")      # [from, to)
    assert load_params(config_typed(cfg, t2)).prime_rate == Decimal("0.07")      # open end


def test_typed_values_and_bad_text(spark):
    t0 = datetime(2024, 1, 1)
    cfg = _cfg(spark, [("min_activities_year", " 12 ", "int", "count", None, t0, None),
                       ("company_address", "Somewhere", "text", None, None, t0, None),
                       ("unknown_flag", "true", "bool", None, None, t0, None)])
    p = load_params(config_typed(cfg, t0))
    assert p.min_activities_year == 12 and p.company_address == "Somewhere"
    assert p.max_wellbeing_days == Params().max_wellbeing_days   # not in the table: the default
    for text, kind in (("many", "int"), ("0,06", "float"), ("maybe", "bool")):
        bad = _cfg(spark, [("prime_rate", text, kind, None, None, t0, None)])
        with pytest.raises(ValueError, match="no value of its type"):
            load_params(config_typed(bad, t0))
    rows = {r.param_name: r for r in config_typed(cfg, t0).collect()}
    assert rows["unknown_flag"].value_bool is True


def test_trace_texts_follow_the_parameters():
    assert rules.rule_prime_text("0.05") == rules.RULE_PRIME_TEXT
    assert rules.rule_wellness_text(15, 5) == rules.RULE_WELLNESS_TEXT
    assert "7.5% salaire" in rules.rule_prime_text("0.075") and "10% salaire" in rules.rule_prime_text("0.10")
    assert ">=12 activités" in rules.rule_wellness_text(12, 6) and "6 jours" in rules.rule_wellness_text(12, 6)
    suffix = Q.rule_detail_suffix(Params(max_distance_walk_run_km=10))
    assert suffix == " (walk/run<=10km; bike/scooter/other<=25km)"


def test_two_valid_versions_are_an_error(spark):
    t0 = datetime(2024, 1, 1)
    cfg = _cfg(spark, [("prime_rate", "0.05", "float", None, None, t0, None),
                       ("prime_rate", "0.06", "float", None, None, t0, None)])
    with pytest.raises(ValueError, match="more than one valid version"):
        load_params(config_typed(cfg, t0))


def test_config_checks_and_keys(spark):
    t0 = datetime(2024, 1, 1)
    seeded = config_parameters(spark, t0)
    assert V.pk_violations(seeded, schemas.PRIMARY_KEYS["config_parameters"]).count() == 0
    bad = _cfg(spark, [("x", "1", "integer", None, None, t0, None)])
    got = [(r.param_name, r.constraint_name) for r in
           V.check_violations(bad, schemas.CHECKS["config_parameters"], ("param_name",)).collect()]
    assert got == [("x", "param_type_enum")]


def test_composite_key_nulls_and_fk_nulls(spark):
    facts = spark.createDataFrame([(1, 2024), (1, 2024), (2, None), (None, 2024), (3, 2024)],
                                  "employee_id bigint, year int")
    got = sorted((r.employee_id or -1, r.year or -1, r.n_rows, r.violation)
                 for r in V.pk_violations(facts, ("employee_id", "year")).collect())
    assert got == [(-1, 2024, 1, "null_key"), (1, 2024, 2, "duplicate"), (2, -1, 1, "null_key")]
    parents = spark.createDataFrame([(1,), (2,), (None,)], "employee_id bigint")
    orphans = V.fk_orphans(facts, parents, "employee_id")
    assert [r.employee_id for r in orphans.collect()] == [3]     # NULL references pass


def test_conform_rejects_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "employee_id bigint")
    with pytest.raises(S.ValidationError, match="missing columns"):
        S.conform(df, schemas.EMPLOYEE_BENEFITS)


def test_not_null_counts_every_declared_column(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (None, None)], "employee_id bigint, last_name string")
    got = {r.column_name: r.null_count for r in V.not_null_violations(df, ("employee_id", "last_name"), "t").collect()}
    assert got == {"employee_id": 2, "last_name": 2}


def _dated(spark, *versions):
    return _cfg(spark, [("prime_rate", v, "float", None, None, since, until) for v, since, until in versions])


def test_facts_get_the_version_of_their_time(spark):
    """Half-open validity, gaps, NULL times, and two versions in one year."""
    a, b, c = datetime(2023, 7, 1), datetime(2024, 3, 1), datetime(2024, 9, 1)
    cfg = _dated(spark, ("0.04", a, b), (" 0.06", c, None))
    times = [datetime(2023, 6, 30), a, datetime(2024, 2, 29, 23, 59, 59), b, c, datetime(2030, 1, 1), None]
    facts = spark.createDataFrame(list(enumerate(times)), "i int, ts timestamp_ntz")
    got = {r.i: str(r.prime_rate) for r in with_params_at(facts, F.col("ts"), cfg, ("prime_rate",)).collect()}
    assert got == {0: "0.050000", 1: "0.040000", 2: "0.040000", 3: "0.050000", 4: "0.060000", 5: "0.060000", 6: "0.050000"}
    years = spark.createDataFrame([(y,) for y in (2022, 2023, 2024)], "year int")
    got = {r.year: str(r.prime_rate) for r in with_params_of_year(years, cfg, ("prime_rate",)).collect()}
    assert got == {2022: "0.050000", 2023: "0.040000", 2024: "0.060000"}
    none = with_params_at(facts, F.col("ts"), cfg.limit(0), ("min_activities_year", "company_address")).first()
    assert (none.min_activities_year, none.company_address) == (15, Params().company_address)


def test_the_lookup_joins_nothing(spark, tables_small):
    facts = fx.activities(tables_small).select("activity_id", "start_ts")
    out = with_params_at(facts, F.col("start_ts"), fx.parameter_versions(tables_small), ("prime_rate",))
    plan = out._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0]
    assert "Join" not in plan and "Cartesian" not in plan


def test_overlapping_or_unreadable_versions_stop_the_query(spark):
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 6, 1)
    facts = spark.createDataFrame([(1, t1)], "i int, ts timestamp_ntz")
    for cfg, why in ((_dated(spark, ("0.04", t0, None), ("0.05", t1, None)), "more than one valid version"),
                     (_dated(spark, ("a lot", t0, None)), "no value of its type"), (_dated(spark, ("", t0, None)), "no value")):
        with pytest.raises(Exception, match=why):
            with_params_at(facts, F.col("ts"), cfg, ("prime_rate",)).collect()
    early = facts.withColumn("ts", F.col("ts") - F.expr("interval 1 day"))   # one version only is valid here
    cfg = _dated(spark, ("0.04", t0, None), ("0.05", t1, None))
    assert str(with_params_at(early, F.col("ts"), cfg, ("prime_rate",)).first().prime_rate) == "0.040000"


def test_the_job_settles_a_year_by_its_own_versions(spark, tables_small):
    import tempfile
    t, wh = tables_small, jobs.Warehouse(tempfile.mkdtemp(prefix="ws-wh-"))
    jobs.ingest_snapshots(spark, wh, fx.hr_sheet(t), fx.sport_sheet(t), fx.LOAD_TS)
    emp = jobs.build_clean_employees(spark, wh, fx.LOAD_TS)
    jobs.load_activities(spark, wh, fx.activities(t))
    S.full_refresh(fx.parameter_versions(t), wh.path("meta", "config_parameters"))
    rates = {}
    for year in (2023, 2024):
        jobs.build_benefits(spark, wh, year, fx.LOAD_TS)
        bonus = wh.read(spark, "analytics", "fact_sport_bonus")
        rates[year] = {str(r.prime_rate) for r in bonus.select("prime_rate").distinct().collect()}
        mine = M.fact_sport_bonus_by_year(emp, [year], fx.LOAD_TS, fx.parameter_versions(t))
        key = ["employee_id", "year", "prime_rate", "prime_amount", "is_eligible", "eligibility_reason"]
        assert sorted(map(tuple, bonus.select(key).collect())) == sorted(map(tuple, mine.select(key).collect()))
    assert rates == {2023: {"0.0550"}, 2024: {"0.0600"}}
    wellness = wh.read(spark, "analytics", "fact_wellness_days").select("year", "min_required", "max_days").distinct().collect()
    assert {(r.min_required, r.max_days) for r in wellness if r.year == 2024} == {(3, 6)}
    assert {(r.min_required, r.max_days) for r in wellness if r.year == 2023} <= {(2, 4)}
