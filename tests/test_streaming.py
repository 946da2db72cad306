"""The streaming feed gives the same clean table as the batch operator."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark import schemas
from wellspark.operators.clean import clean_activities
from wellspark.operators.constraints import reject_reasons
from wellspark.sources import fixtures as fx, versions
from wellspark.sources.sinks import full_refresh, read_table
from wellspark.streaming import activity_feed as SF


def _write_batches(df, root, n):
    """Split a feed into ``n`` drops by id, as files arriving over time."""
    for i in range(n):
        df.where(F.pmod(F.coalesce(F.col("activity_id"), F.lit(0)), F.lit(n)) == i) \
          .coalesce(1).write.parquet(f"{root}/drop={i}")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_dedup_equals_batch_keys(spark, tables_small):
    feed = fx.dirty_activities(tables_small)
    src = tempfile.mkdtemp(prefix="ws-feed-")
    _write_batches(feed, src, 3)
    target = tempfile.mkdtemp(prefix="ws-clean-") + "/activities"
    stream = SF.read_activity_feed(spark, f"{src}/*", max_files_per_trigger=1)
    q = SF.start_clean_activities(stream, target, checkpoint=tempfile.mkdtemp(prefix="ws-ck-"))
    q.awaitTermination(300)
    got = read_table(spark, target)
    judged = reject_reasons(feed, schemas.NOT_NULL["activities"], schemas.CHECKS["activities"])
    want = clean_activities(judged.where("size(reject_reasons) = 0"))
    # every id lies in one batch here, so the stream keeps the very rows that the batch operator keeps
    assert _rows(got.drop("activity_year")) == _rows(want)
    assert SF.read_quarantine(spark, target).count() == judged.where("size(reject_reasons) > 0").count() > 0
    # a replay of the same files adds nothing (ids already written)
    q2 = SF.start_clean_activities(SF.read_activity_feed(spark, f"{src}/*"), target,
                                   checkpoint=tempfile.mkdtemp(prefix="ws-ck-"))
    q2.awaitTermination(300)
    assert read_table(spark, target).count() == want.count()


def test_stream_daily_volume_equals_batch(spark, tables_small):
    feed = fx.activities(tables_small)
    src = tempfile.mkdtemp(prefix="ws-feed-")
    _write_batches(feed, src, 2)
    q = SF.start_daily_volume(SF.read_activity_feed(spark, f"{src}/*", max_files_per_trigger=1), "ws_daily_test",
                              checkpoint=tempfile.mkdtemp(prefix="ws-ck-"))
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.table("ws_daily_test").collect())
    want = sorted(tuple(r) for r in SF.daily_volume(feed).collect())
    assert got == want


def test_restart_from_checkpoint_processes_only_new_files(spark, tables_small):
    feed = fx.activities(tables_small)
    src = tempfile.mkdtemp(prefix="ws-feed-")
    target = tempfile.mkdtemp(prefix="ws-clean-") + "/activities"
    ckpt = tempfile.mkdtemp(prefix="ws-ck-")
    first, second = feed.where("activity_id < 500"), feed.where("activity_id >= 500")
    first.coalesce(2).write.parquet(f"{src}/drop=0")
    SF.start_clean_activities(SF.read_activity_feed(spark, f"{src}/*"), target, checkpoint=ckpt).awaitTermination(300)
    assert read_table(spark, target).count() == 500
    # the query is gone (as after a driver restart); new files arrive; the same checkpoint resumes
    second.coalesce(2).write.parquet(f"{src}/drop=1")
    SF.start_clean_activities(SF.read_activity_feed(spark, f"{src}/*"), target, checkpoint=ckpt).awaitTermination(300)
    out = read_table(spark, target)
    assert out.count() == 1000 and out.select("activity_id").distinct().count() == 1000


def _row(i, year=2024, **other):
    row = {"activity_id": i, "employee_id": 1, "start_ts": dt.datetime(year, 1, 1), "end_ts": dt.datetime(year, 1, 1, 1),
           "sport_type": "running", "distance_m": 1, "elapsed_s": 1, "comment_text": None, **other}
    return tuple(row[c] for c in schemas.ACTIVITIES.fieldNames())


class Feed:
    """Files dropped one after the other, and a query that takes them up and ends."""

    def __init__(self, spark, employees=None):
        self.spark, self.employees = spark, employees
        self.source, self.ckpt = tempfile.mkdtemp(prefix="ws-feed-"), tempfile.mkdtemp(prefix="ws-ck-")
        self.target = tempfile.mkdtemp(prefix="ws-clean-") + "/activities"
        self.drops = 0

    def drop(self, *rows):
        df = self.spark.createDataFrame(list(rows), T.StructType([T.StructField(f.name, f.dataType) for f in schemas.ACTIVITIES]))
        df.coalesce(1).write.parquet(f"{self.source}/drop={self.drops:03d}")
        self.drops += 1

    def run(self, ckpt=None, **options):
        stream = SF.read_activity_feed(self.spark, f"{self.source}/*", **options)
        q = SF.start_clean_activities(stream, self.target, checkpoint=ckpt or self.ckpt, employees=self.employees)
        q.awaitTermination(300)
        assert q.exception() is None, q.exception()
        return q

    def ids(self):
        return sorted((r.activity_id, r.activity_year) for r in read_table(self.spark, self.target).collect())


def test_an_id_is_written_once_whatever_its_year(spark):
    f = Feed(spark)
    f.drop()                                   # an empty first batch
    f.run()
    f.drop(_row(7, 2023), _row(8, 2023))
    f.run()
    f.drop(_row(7, 2024), _row(9, 2024), _row(9, 2022), _row(9, 2025))
    f.run()
    assert f.ids() == [(7, 2023), (8, 2023), (9, 2022)]   # first of its batch, first of all batches
    SF.compact_activities(spark, f.target)
    f.drop(_row(8, 2025), _row(10, 2025))
    f.run()
    assert f.ids() == [(7, 2023), (8, 2023), (9, 2022), (10, 2025)]
    f.run(ckpt=tempfile.mkdtemp(prefix="ws-ck-"))         # a replay from a new checkpoint
    assert f.ids() == [(7, 2023), (8, 2023), (9, 2022), (10, 2025)]


def test_a_batch_touches_its_own_ids_only(spark):
    f = Feed(spark)
    f.drop(*[_row(i) for i in range(500)])
    f.run()
    f.drop(_row(3), _row(700), _row(700), _row(701))
    state = f.run().lastProgress["stateOperators"][0]
    assert state["numRowsUpdated"] == 3 and state["numRowsTotal"] == 502
    assert "rocksdbPutCount" in state["customMetrics"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "HDFSBacked").find("RocksDB") < 0


def test_dirty_rows_go_to_quarantine_and_nothing_is_cached(spark, tables_small):
    """The activity fixture with every fault: no bad row is written, each is kept with its reasons."""
    feed, emp = fx.dirty_activities(tables_small), fx.employees(tables_small)
    f = Feed(spark, emp)
    _write_batches(feed, f.source, 4)
    f.run(max_files_per_trigger=1)
    clean, bad = read_table(spark, f.target), SF.read_quarantine(spark, f.target)
    judged = reject_reasons(feed, schemas.NOT_NULL["activities"], schemas.CHECKS["activities"], emp, "employee_id")
    assert reject_reasons(clean, schemas.NOT_NULL["activities"], schemas.CHECKS["activities"], emp,
                          "employee_id").where("size(reject_reasons) > 0").count() == 0
    assert _rows(bad.drop("activity_year")) == _rows(judged.where("size(reject_reasons) > 0").select(*bad.drop("activity_year").columns))
    assert _rows(clean.drop("activity_year")) == _rows(clean_activities(judged.where("size(reject_reasons) = 0")))
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


def test_crash_before_and_after_the_commit(spark, monkeypatch):
    """A batch dies between its files and its commit, another after it: the same checkpoint makes both good."""
    f, real = Feed(spark), versions.commit
    f.drop(_row(1), _row(2, elapsed_s=-1))
    f.run()

    def dies_before(*args, **kwargs):
        raise OSError("lost before the commit")

    def dies_after(*args, **kwargs):
        real(*args, **kwargs)
        raise OSError("lost after the commit")

    for died, new in ((dies_before, 10), (dies_after, 20)):
        f.drop(_row(1), _row(new), _row(new + 1, start_ts=None))
        monkeypatch.setattr(versions, "commit", died)
        with pytest.raises(Exception, match="lost"):
            f.run()
        monkeypatch.setattr(versions, "commit", real)
        seen = f.ids()
        assert ((new, 2024) in seen) == (died is dies_after)   # both outputs or neither
        assert SF.read_quarantine(spark, f.target).where(F.col("activity_id") == new + 1).count() == (died is dies_after)
        f.run()
    f.drop(_row(30), _row(20))
    f.run()
    assert f.ids() == [(1, 2024), (10, 2024), (20, 2024), (30, 2024)]
    assert sorted(r.activity_id for r in SF.read_quarantine(spark, f.target).collect()) == [2, 11, 21]


def test_version_files_are_cleaned_up_as_batches_come(spark, monkeypatch):
    import os
    monkeypatch.setattr(SF, "VACUUM_EVERY", 2)
    monkeypatch.setattr(SF, "VERSIONS_KEPT", 3)
    f = Feed(spark)
    for i in range(7):
        f.drop(_row(i), _row(100 + i, elapsed_s=-1))
    f.run(max_files_per_trigger=1)
    files = [n for n in os.listdir(f"{f.target}/{versions.VERSIONS}") if n.endswith(".json")]
    assert len(files) <= 4 and [i for i, _ in f.ids()] == list(range(7))
    SF.compact_activities(spark, f.target)
    versions.vacuum(spark, f.target, keep=1)
    assert len(os.listdir(f"{f.target}/{versions.DATA}")) == 2      # one folder an output
    assert [i for i, _ in f.ids()] == list(range(7)) and SF.read_quarantine(spark, f.target).count() == 7


def test_a_batch_loaded_table_goes_on_as_a_stream(spark):
    """Ids that the batch job wrote are known to a stream that takes the table over."""
    f = Feed(spark)
    rows = spark.createDataFrame([_row(1, 2020), _row(2, 2021)], schemas.ACTIVITIES).withColumn("activity_year", F.year("start_ts"))
    full_refresh(rows, f.target, partition_by=["activity_year"])
    f.drop(_row(2, 2024), _row(3, 2024))
    f.run()
    assert f.ids() == [(1, 2020), (2, 2021), (3, 2024)]


def test_daily_volume_table_sink(spark, tables_small):
    feed = fx.activities(tables_small)
    src = tempfile.mkdtemp(prefix="ws-feed-")
    _write_batches(feed, src, 2)
    target = tempfile.mkdtemp(prefix="ws-daily-") + "/daily"
    SF.start_daily_volume_table(SF.read_activity_feed(spark, f"{src}/*", max_files_per_trigger=1), target,
                                checkpoint=tempfile.mkdtemp(prefix="ws-ck-")).awaitTermination(300)
    got = sorted(tuple(r) for r in read_table(spark, target).collect())
    assert got == sorted(tuple(r) for r in SF.daily_volume(feed).collect())
