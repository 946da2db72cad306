"""Activities bucketed by place: a hot employee is spread, the benefits stay exact and need no full shuffle."""

import os
import re
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_skew import conf
from wellspark.operators import benefits as B
from wellspark.plans import jobs
from wellspark.sources import fixtures as fx, salting

BUCKETS, ABOVE = 8, 40


def _skewed(t):
    """A third of all activities belong to employee 7, some more to 8."""
    a = fx.activities(t)
    return a.withColumn("employee_id", F.when(F.col("activity_id") % 3 == 0, F.lit(7)).when(F.col("activity_id") % 10 == 1, F.lit(8))
                        .otherwise(F.col("employee_id")))


@pytest.fixture(scope="module")
def warehouses(spark, tables_small):
    out = {}
    for name, above in (("ws_flat", 0), ("ws_salted", ABOVE)):
        wh = jobs.Warehouse(tempfile.mkdtemp(prefix="ws-wh-"), database=name, buckets=BUCKETS, salt_above=above)
        wh.prepare(spark)
        jobs.ingest_snapshots(spark, wh, fx.hr_sheet(tables_small), fx.sport_sheet(tables_small), fx.LOAD_TS)
        jobs.build_clean_employees(spark, wh, fx.LOAD_TS)
        jobs.load_activities(spark, wh, _skewed(tables_small))
        out[name] = wh
    yield out
    for name in out:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _benefits(spark, wh):
    return B.employee_benefits(wh.read(spark, "clean", "employees"), wh.read(spark, "clean", "activities"),
                               fx.AS_OF_YEAR, fx.LOAD_TS)


def _bucket_rows(spark, wh):
    rows = Counter()
    for path, n in (wh.read(spark, "clean", "activities").groupBy(F.input_file_name()).count().collect()):
        rows[int(re.search(r"_(\d{5})\.", os.path.basename(path)).group(1))] += n
    return rows


def test_result_is_exact_without_a_full_shuffle(spark, warehouses):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        want = sorted(map(tuple, _benefits(spark, warehouses["ws_flat"]).collect()))
        df = _benefits(spark, warehouses["ws_salted"])
        assert sorted(map(tuple, df.collect())) == want
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the only shuffle is of the hot employees' partial counts, already grouped in their buckets
    shuffles = [m.start() for m in re.finditer(r"Exchange hashpartitioning", plan)]
    assert len(shuffles) <= 1 and "SortMergeJoin" in plan
    for at in shuffles:
        below = plan[at:].split("\n")[1:4]
        assert any("HashAggregate" in line and "partial_sum" in line for line in below), below


def test_hot_buckets_are_split(spark, warehouses):
    flat, salted = (_bucket_rows(spark, warehouses[n]) for n in ("ws_flat", "ws_salted"))
    mean = sum(flat.values()) / BUCKETS
    assert sum(flat.values()) == sum(salted.values())
    assert max(flat.values()) > 2.5 * mean and max(salted.values()) < 2.2 * mean


def test_refresh_and_cascade_keep_the_places(spark, tables_small, warehouses):
    wh = warehouses["ws_salted"]
    before = sorted(r.activity_id for r in wh.read(spark, "clean", "activities").collect())
    jobs.build_clean_employees(spark, wh, fx.LOAD_TS)            # prunes activities: written again
    acts = wh.read(spark, "clean", "activities")
    assert sorted(r.activity_id for r in acts.collect()) == before
    hot = {r.employee_id for r in acts.where(salting.SALTED).select("employee_id").distinct().collect()}
    assert {7, 8} <= hot == {r.employee_id for r in acts.groupBy("employee_id").count().where(f"count > {ABOVE}").collect()}
    assert acts.where(~F.col(salting.SALTED)).where("place <> employee_id").count() == 0
    assert acts.where(salting.SALTED).groupBy("employee_id").agg(F.count_distinct("place").alias("n")).where("n < 2").count() == 0


def test_places_of_edge_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(9)] + [(1, i) for i in range(5)] + [(2, 0)], "k bigint, i int")
    got = salting.with_place(df, "k", 4, F.col("i"))
    assert got.count() == 15 and got.where("k IS NULL").where("place IS NOT NULL OR salted").count() == 0
    assert got.where("k = 1").where("salted").count() == 5 and got.where("k = 2").first().place == 2
    assert salting.with_place(df.limit(0), "k", 4, F.col("i")).count() == 0
