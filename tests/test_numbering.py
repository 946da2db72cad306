"""Row numbers: unique, gapless, by content, whatever the partitioning; repeated rows and split copies."""

import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wellspark.operators import constraints as V
from wellspark.plans import jobs
from wellspark.sources import fixtures as fx
from wellspark.sources.numbering import number_rows


@pytest.mark.parametrize("parts", [1, 7])
def test_numbers_follow_the_content(spark, parts):
    rows = [(i % 7 if i % 5 else None, "x" if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, `b c` string").repartition(parts)
    got = sorted(tuple(r) for r in number_rows(df, "id", after=10).collect())
    assert [r[0] for r in got] == list(range(11, 211))
    key = lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or ""))
    assert [r[1:] for r in got] == sorted(rows, key=key)


def test_copies_are_dealt_in_chunks(spark):
    df = spark.range(3).withColumn("id", F.lit(5)).union(spark.range(2)).unionByName(spark.range(1001).select(F.lit(9).alias("id")))
    got = number_rows(df, "n", chunk=100).collect()
    assert sorted(r.n for r in got) == list(range(1, 1007)) and sum(r.id == 9 for r in got) == 1001
    assert number_rows(df.limit(0), "n").count() == 0


def test_numbers_over_many_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number_rows(spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")), "n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert [r.k for r in sorted(got)] == sorted(i * 7919 % 5003 for i in range(5000))


def test_raw_snapshots_have_a_key(spark, tables_small):
    """Equal rows of a load, a second load and a re-run: every raw row keeps an id of its own."""
    wh = jobs.Warehouse(tempfile.mkdtemp(prefix="ws-wh-"))
    hr, sport = fx.hr_sheet(tables_small), fx.sport_sheet(tables_small)
    hr = hr.unionByName(hr.limit(10))
    for load in (datetime(2024, 1, 1), datetime(2024, 1, 1), datetime(2024, 2, 1)):
        jobs.ingest_snapshots(spark, wh, hr, sport, load)
    raw = wh.read(spark, "raw", "rh_employees_snapshot")
    assert raw.count() == 320 and V.pk_violations(raw, ("snapshot_id",)).count() == 0
    by_load = {r.ingested_ts: (r.lo, r.hi) for r in raw.groupBy("ingested_ts").agg(
        F.min("snapshot_id").alias("lo"), F.max("snapshot_id").alias("hi")).collect()}
    assert sorted(by_load.values()) == [(1, 160), (161, 320)]
