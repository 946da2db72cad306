"""States that add up: the report of all loads equals the report of all rows, and earlier loads are not read again."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from wellspark.operators import quality as Q
from wellspark.operators.config import Params
from wellspark.operators.quality_state import KEYS, QualityState
from wellspark.sources import fixtures as fx, versions


def _report(df):
    return sorted(tuple(r) for r in df.collect())


def _state(spark, params=Params()):
    return QualityState(spark, tempfile.mkdtemp(prefix="ws-state-"), params)


@pytest.mark.parametrize("dirty", [False, True])
def test_report_of_loads_equals_report_of_rows(spark, tables_small, dirty):
    t = tables_small
    e, a, c = ((fx.dirty_employees(t), fx.dirty_activities(t), fx.dirty_commute_checks(t)) if dirty
               else (fx.employees(t), fx.activities(t), fx.commute_checks(t)))
    state = _state(spark)
    assert state.absorb_employees(e.limit(5), 1)       # replaced by the next
    assert state.absorb_employees(e, 2)
    for load in range(3):
        assert state.absorb_activities(a.where(F.pmod(F.xxhash64("end_ts", "elapsed_s"), F.lit(3)) == load), load)
        assert state.absorb_checks(c.where(F.col("check_id") % 3 == load), load)
        assert not state.absorb_activities(a, load)    # again: nothing is counted twice
    want = _report(Q.quality_report(e, a, c))
    assert _report(state.report(e)) == want
    for table in (state.employees, state.activities, state.checks):
        table.compact()
    assert _report(state.report(e)) == want
    assert len(versions.current(spark, state.activities.root).folders[KEYS]) == 1
    state.absorb_activities(a, 3)                      # every key again
    twice = a.unionByName(a)
    assert _report(state.report(e)) == _report(Q.quality_report(e, twice, c))


def test_modes_that_change_change_the_rule(spark, tables_small):
    t, state = tables_small, _state(spark, Params(max_distance_walk_run_km=9, max_distance_bike_scooter_km=20))
    e, c = fx.employees(t), fx.commute_checks(t)
    state.absorb_employees(e, 1)
    state.absorb_checks(c.where("check_id % 2 = 0"), 0)
    state.absorb_checks(c.where("check_id % 2 = 1"), 1)
    moved = e.withColumn("commute_mode", F.when(F.col("employee_id") % 2 == 0, "running").otherwise(F.col("commute_mode")))
    for now in (e, moved, e.unionByName(e.limit(20))):
        n = Q.commute_anomalies(c, now, state.params).count()
        found = {r.check_name: r.details for r in state.report(now).collect()}[Q.RULE_CHECK.name]
        assert found.startswith(f"anomalies={n} ")


def test_a_new_load_reads_itself_only(spark, tables_small):
    a, root, state = fx.dirty_activities(tables_small), tempfile.mkdtemp(prefix="ws-loads-"), _state(spark)
    state.absorb_employees(fx.employees(tables_small), 1)
    for load in range(2):
        path = f"{root}/{load}"
        a.where(F.col("elapsed_s") % 2 == load if load else F.coalesce(F.col("elapsed_s") % 2 != 1, F.lit(True))) \
            .write.parquet(path)
        state.absorb_activities(spark.read.parquet(path), load)
        for f in os.listdir(path):                     # gone: whatever is read later is not this load
            os.remove(f"{path}/{f}")
    assert _report(state.report(fx.employees(tables_small))) == _report(Q.quality_report(fx.employees(tables_small), a, None))
    dup = {tuple(r) for r in state.activities.duplicate_keys().collect()}
    assert dup == {tuple(r) for r in a.groupBy("activity_id").count().where("count > 1 OR activity_id IS NULL").collect()}


def test_empty_missing_and_null_keys(spark, tables_small):
    t, state = tables_small, _state(spark)
    with pytest.raises(RuntimeError):
        state.report(fx.employees(t))
    e, a = fx.employees(t), fx.activities(t)
    state.absorb_employees(e, 1)
    assert _report(state.report(e)) == _report(Q.quality_report(e, None, None))
    state.absorb_activities(a.limit(0), 0)
    state.absorb_checks(fx.commute_checks(t).limit(0), 0)
    assert _report(state.report(e)) == _report(Q.quality_report(e, a.limit(0), fx.commute_checks(t).limit(0)))
    nulls = a.limit(3).withColumn("activity_id", F.lit(None).cast("bigint"))
    state.absorb_activities(nulls.limit(1), 1)
    state.absorb_activities(nulls.limit(1), 2)         # NULL repeats across the loads
    assert state.activities.metrics().first().qc_act_id_unique == 1
    assert [tuple(r) for r in state.activities.duplicate_keys().collect()] == [(None, 2)]


def test_two_loads_at_a_time_count_against_each_other(spark, tables_small, monkeypatch):
    a, state, real = fx.activities(tables_small), _state(spark), versions.commit
    state.absorb_activities(a.limit(0), 0)
    raced = []

    def race(*args, **kwargs):
        if not raced:
            raced.append(1)
            monkeypatch.setattr(versions, "commit", real)
            state.absorb_activities(a, 2)              # commits between the other's count and its commit
        return real(*args, **kwargs)

    monkeypatch.setattr(versions, "commit", race)
    state.absorb_activities(a, 1)
    assert state.activities.metrics().first().qc_act_id_unique == a.count()   # each key is in both loads


def test_gate_passes_agrees_with_the_gate(spark, tables_small):
    t = tables_small
    good = fx.employees(t).where("gross_salary > 0 AND home_address <> '' AND commute_mode <> ''")
    few = Params(min_activities_rows=10)
    quiet = fx.commute_checks(t).where("distance_km < 5")
    for e, a, c in ((good, fx.activities(t), quiet), (good, None, None), (good, fx.activities(t), fx.commute_checks(t)),
                    (good, fx.dirty_activities(t), None), (fx.employees(t), None, None), (good.limit(0), None, None)):
        assert Q.gate_passes(e, a, c, few) == Q.quality_gate(Q.quality_report(e, a, c, few)).first().gate_ok
