"""Physical-plan properties that matter at scale (pushdown, pruning, shuffles, top-k)."""

import contextlib
import io
import tempfile
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from wellspark.operators import benefits as B, clean as C, commute as K, quality as Q
from wellspark.operators.config import Params, config_parameters, config_typed, load_params
from wellspark.sources import fixtures as fx


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_commute_filter_reaches_parquet(spark, tables_small):
    path = tempfile.mkdtemp(prefix="ws-plan-") + "/checks"
    fx.commute_checks(tables_small).write.parquet(path)
    checks = spark.read.parquet(path)
    plan = _formatted(K.commute_anomalies(checks, fx.employees(tables_small)))
    assert "GreaterThan(distance_km,15.000)" in plan
    assert "ReadSchema: struct<check_id:bigint,computed_ts:timestamp_ntz,employee_id:bigint,distance_km:decimal(8,3)>" in plan


def test_top5_is_take_ordered(spark, tables_small):
    top = K.commute_anomalies_top5(fx.commute_checks(tables_small), fx.employees(tables_small))
    assert "TakeOrderedAndProject" in _plan(top)


def test_latest_and_dedup_limit_each_key_before_the_shuffle(spark, tables_small):
    emp = fx.employees(tables_small)
    k6 = K.commute_validation(K.assess_commute(fx.commute_checks(tables_small), emp), emp)
    c6 = C.clean_activities(fx.dirty_activities(tables_small))
    for df in (k6, c6):
        p = _plan(df)
        assert "SortAggregate" not in p
        final, partial = p.index(", Final"), p.index(", Partial")  # top down: the partial limit is below
        assert final < partial and "Exchange hashpartitioning" in p[final:partial]


def test_survey_join_is_one_left_join(spark, tables_small):
    path = tempfile.mkdtemp(prefix="ws-plan-")
    fx.hr_raw(tables_small).write.parquet(path + "/hr")
    fx.sport_raw(tables_small).write.parquet(path + "/sp")
    with_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    from tests.test_skew import conf
    with conf(spark, **with_conf):
        p = _plan(C.join_sport_profile(spark.read.parquet(path + "/hr"), spark.read.parquet(path + "/sp")))
    assert p.count("Exchange") == 2 and p.count("SortMergeJoin") == 1 and p.count("FileScan") == 2


def test_benefits_read_one_year_partition(spark, tables_small):
    path = tempfile.mkdtemp(prefix="ws-plan-") + "/acts"
    fx.activities(tables_small).withColumn("activity_year", F.year("start_ts")) \
        .write.partitionBy("activity_year").parquet(path)
    acts = spark.read.parquet(path)
    df = B.employee_benefits(fx.employees(tables_small), acts, 2024, datetime(2024, 2, 1))
    plan = _formatted(df)
    assert "PartitionFilters: [isnotnull(activity_year" in plan and "(activity_year#" in plan
    assert "PushedFilters: [IsNotNull(start_ts), GreaterThanOrEqual(start_ts,2024-01-01T00:00)" in plan
    assert df.count() == 150
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, B.employee_benefits(
        fx.employees(tables_small), fx.activities(tables_small), 2024, datetime(2024, 2, 1)).collect()))


def test_gate_one_shuffle_per_keyed_table(spark, tables_small):
    p = _plan(Q.activity_section(fx.dirty_activities(tables_small)))
    assert p.count("Exchange hashpartitioning") == 1


def test_params_from_seeded_config(spark):
    cfg = config_parameters(spark, datetime(2024, 1, 1))
    params = load_params(config_typed(cfg, datetime(2024, 2, 1)))
    assert params == Params()
    assert params.prime_rate == Decimal("0.05")
    # nothing is valid before the effective date: defaults are used
    assert load_params(config_typed(cfg, datetime(2023, 1, 1))) == Params()


def test_changed_rate_changes_bonus(spark, tables_small):
    base = B.employee_benefits(fx.employees(tables_small), fx.activities(tables_small), 2024, datetime(2024, 2, 1))
    doubled = B.employee_benefits(fx.employees(tables_small), fx.activities(tables_small), 2024,
                                  datetime(2024, 2, 1), Params(prime_rate=Decimal("0.10")))
    a = base.agg(F.sum("sport_prime_eur")).first()[0]
    b = doubled.agg(F.sum("sport_prime_eur")).first()[0]
    assert abs(b - 2 * a) <= Decimal("0.01") * base.where("sport_prime_eur > 0").count()


def test_latest_snapshot_prunes_to_newest_partition(spark, tables_small):
    from wellspark.sources.ingest import latest_snapshot
    path = tempfile.mkdtemp(prefix="ws-plan-") + "/raw"
    fx.hr_raw(tables_small).withColumn("ingest_date", F.to_date("ingested_ts")) \
        .write.partitionBy("ingest_date").parquet(path)
    raw = spark.read.parquet(path)
    out = latest_snapshot(raw, partition_col="ingest_date")
    assert "ingest_date" not in out.columns
    assert out.count() == 150
    assert "PartitionFilters: [isnotnull(ingest_date" in _formatted(out)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, latest_snapshot(fx.hr_raw(tables_small)).collect()))


def test_scale_conf_sizes_partitions():
    from wellspark.session import scale_conf
    tb = 1024 ** 4
    c = scale_conf(shuffle_bytes_estimate=20 * tb, executor_cores_total=4000)
    assert int(c["spark.sql.shuffle.partitions"]) == 20 * tb // (256 * 1024 ** 2)  # 81,920 x 256 MB
    assert c["spark.sql.adaptive.enabled"] == "true" and c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_conf(shuffle_bytes_estimate=1024 ** 3, executor_cores_total=4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 12000  # never fewer than 3 waves of cores


def test_a_union_of_bucketed_tables_is_grouped_right(spark):
    """Rows of one key in two tables bucketed alike belong together (see session.RECOMMENDED_CONF)."""
    import tempfile
    spark.sql("CREATE DATABASE IF NOT EXISTS ws_union")
    for k in (1, 2):
        (spark.range(3).select(F.col("id").alias("h")).write.bucketBy(4, "h")
         .option("path", tempfile.mkdtemp(prefix="ws-union-") + "/t").saveAsTable(f"ws_union.b{k}"))
    both = spark.table("ws_union.b1").unionByName(spark.table("ws_union.b2"))
    assert sorted(map(tuple, both.groupBy("h").count().collect())) == [(0, 2), (1, 2), (2, 2)]
    spark.sql("DROP DATABASE ws_union CASCADE")
