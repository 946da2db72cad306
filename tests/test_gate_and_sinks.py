"""Quality gate SKIP/blocking behaviour and the safety of the sinks."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from wellspark import schemas
from wellspark.operators import constraints as V, quality as Q
from wellspark.sources import fixtures as fx, sinks as S
from wellspark.sources.ingest import optional_source


def _report(df):
    return {r.check_name: (r.ok, r.details) for r in df.collect()}


def test_skip_when_tables_empty(spark, tables_small):
    emp = fx.employees(tables_small)
    rep = _report(Q.quality_report(emp, fx.activities(tables_small).limit(0),
                                   fx.commute_checks(tables_small).limit(0)))
    assert rep[Q.ACT_SKIP] == (True, Q.ACT_EMPTY)
    assert rep[Q.CHK_SKIP] == (True, Q.CHK_EMPTY)
    assert rep[Q.RULE_SKIP] == (True, Q.RULE_EMPTY)
    assert "clean.activities activity_id NOT NULL" not in rep
    assert rep[Q.ACT_ROWS_NAME] == (True, "row_count=0")


def test_skip_when_tables_missing(spark, tables_small):
    rep = _report(Q.quality_report(fx.employees(tables_small), None, None))
    assert rep[Q.ACT_SKIP] == (True, Q.ACT_MISSING)
    assert rep[Q.CHK_SKIP] == (True, Q.CHK_MISSING)
    assert rep[Q.RULE_SKIP] == (True, Q.RULE_MISSING)
    assert len(rep) == 7 + 3


def test_gate_blocks_and_passes(spark, tables_small):
    bad = Q.quality_report(fx.dirty_employees(tables_small), fx.dirty_activities(tables_small),
                           fx.dirty_commute_checks(tables_small))
    with pytest.raises(Q.QualityGateError) as err:
        Q.enforce_gate(bad)
    assert any(r.check_name == "clean.employees employee_id UNIQUE" for r in err.value.failed)
    good = spark.createDataFrame([(1, "x", True, "ok")], "check_order int, check_name string, ok boolean, details string")
    assert Q.enforce_gate(good)


def test_gate_one_key_shuffle_per_table(spark, tables_small):
    """Whatever the number of checks: one scan for the counters, one for the keys, and one shuffle, of keys."""
    plan = Q.employee_section(fx.employees(tables_small))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1
    assert plan.count("FileScan") <= 4  # customer and nation, each for the counters and for the keys


@pytest.mark.parametrize("emp", ["full", "empty"])
@pytest.mark.parametrize("act", ["full", "empty", "missing"])
@pytest.mark.parametrize("chk", ["full", "empty", "missing"])
def test_gate_on_every_mix_of_empty_and_missing(spark, tables_small, emp, act, chk):
    pick = lambda df, how: None if how == "missing" else df.limit(0) if how == "empty" else df
    t = tables_small
    report = Q.quality_report(pick(fx.employees(t), emp), pick(fx.activities(t), act), pick(fx.commute_checks(t), chk))
    rep = _report(report)
    assert rep["clean.employees row_count > 0"] == (emp == "full", f"row_count={150 if emp == 'full' else 0}")
    assert sum(n.startswith("clean.employees") for n in rep) == 7
    assert (Q.ACT_SKIP in rep) == (act != "full") and (Q.CHK_SKIP in rep) == (chk != "full") == (Q.RULE_SKIP in rep)
    if emp == "empty":
        assert Q.quality_gate(report).first().gate_ok is False


def test_empty_tables_pass_through_the_sinks(spark, tables_small):
    root = tempfile.mkdtemp(prefix="ws-sink-")
    acts = fx.activities(tables_small).withColumn("activity_year", F.year("start_ts"))
    out = S.full_refresh(acts.limit(0), root + "/t", partition_by=["activity_year"])
    assert out.count() == 0 and set(out.columns) == set(acts.columns)
    again = optional_source(spark, root + "/t")
    assert again.count() == 0 and again.schema["start_ts"].dataType == acts.schema["start_ts"].dataType
    assert S.full_refresh(acts, root + "/t", partition_by=["activity_year"]).count() == 1000
    assert optional_source(spark, root + "/none") is None
    with pytest.raises(Exception):
        S.full_refresh(acts.withColumn("boom", F.raise_error(F.lit("x"))), root + "/t")
    assert S.read_table(spark, root + "/t").count() == 1000 and os.listdir(root) == ["t"]


def test_crash_between_the_renames_is_repaired(spark):
    root = tempfile.mkdtemp(prefix="ws-sink-")
    S.full_refresh(spark.range(4), root + "/t")
    os.rename(root + "/t", root + "/t.__previous-abc")  # the job died here
    assert optional_source(spark, root + "/t").count() == 4
    assert os.listdir(root) == ["t"]


def test_bucketed_write_makes_few_files(spark, tables_small):
    root = tempfile.mkdtemp(prefix="ws-sink-")
    spark.sql("CREATE DATABASE IF NOT EXISTS ws_files")
    acts = fx.activities(tables_small).repartition(7).withColumn("activity_year", F.year("start_ts"))
    out = S.full_refresh(acts, root + "/t", partition_by=["activity_year"], table="ws_files.acts",
                         bucket_by="employee_id", num_buckets=4)
    years = acts.select("activity_year").distinct().count()
    files = [f for _, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]
    assert out.count() == 1000 and len(files) <= 4 * years
    spark.sql("DROP DATABASE ws_files CASCADE")


def test_full_refresh_validates_before_writing(spark, tables_small):
    path = tempfile.mkdtemp(prefix="ws-sink-") + "/emp"
    good = fx.employees(tables_small)
    pk = lambda df: V.pk_violations(df, ("employee_id",))
    first = sorted(tuple(r) for r in S.full_refresh(good, path, [pk]).collect())
    assert len(first) == 150
    with pytest.raises(S.ValidationError):
        S.full_refresh(fx.dirty_employees(tables_small), path, [pk])
    assert S.read_table(spark, path).count() == 150  # untouched by the rejected write
    again = sorted(tuple(r) for r in S.full_refresh(good, path, [pk]).collect())  # re-run: same table
    assert again == first


def test_rebuild_reads_its_own_target(spark, tables_small):
    path = tempfile.mkdtemp(prefix="ws-sink-") + "/t"
    spark.range(10).write.parquet(path)
    current = spark.read.parquet(path)
    out = S.rebuild_table(current.withColumn("id", F.col("id") * 2), path)
    assert sorted(r.id for r in out.collect()) == [i * 2 for i in range(10)]


def test_conform_orders_and_casts(spark, tables_small):
    from datetime import datetime
    from wellspark.operators.benefits import employee_benefits
    b = employee_benefits(fx.employees(tables_small), fx.activities(tables_small), 2024, datetime(2024, 2, 1))
    c = S.conform(b.select(*reversed(b.columns)), schemas.EMPLOYEE_BENEFITS)
    assert c.columns == schemas.EMPLOYEE_BENEFITS.fieldNames()


def test_cascade_modes(spark, tables_small):
    acts, emp = fx.dirty_activities(tables_small), fx.employees(tables_small)
    assert S.cascade_refresh(acts, emp, mode="truncate").count() == 0
    pruned = S.cascade_refresh(acts, emp, mode="prune")
    assert V.fk_orphans(pruned, emp, "employee_id").count() == 0
    assert pruned.where("employee_id IS NULL").count() == 0


def test_observed_write_counts_rows_in_the_write(spark, tables_small):
    path = tempfile.mkdtemp(prefix="ws-sink-") + "/acts"
    seen = []
    out = S.full_refresh(fx.activities(tables_small), path, on_written=seen.append)
    assert seen == [1000] and out.count() == 1000


def test_rebuild_rejected_keeps_target_and_leaves_no_staging(spark):
    root = tempfile.mkdtemp(prefix="ws-sink-")
    path = root + "/t"
    spark.range(5).write.parquet(path)
    dup = spark.range(5).union(spark.range(1))
    with pytest.raises(S.ValidationError):
        S.rebuild_table(dup, path, validators=[lambda df: V.pk_violations(df, ("id",))])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]
    S.rebuild_table(spark.range(3), path)
    assert sorted(r.id for r in S.read_table(spark, path).collect()) == [0, 1, 2]
    assert os.listdir(root) == ["t"]  # no staging or previous copies left behind
