"""Versioned tables: whole to every reader, retried commits, crashes, rival writers, compaction."""

import os
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from wellspark.sources import sinks as S, versions as V
from wellspark.sources.ingest import optional_source


def _root():
    return tempfile.mkdtemp(prefix="ws-versions-") + "/t"


def _ids(df):
    return sorted(r.id for r in df.collect())


def _write(spark, root, n, folder=None):
    folder = folder or V.new_folder()
    df = spark.range(n, n + 3)
    df.write.mode("overwrite").parquet(f"{root}/{folder}")
    return folder, df.schema


def test_a_reader_never_misses_the_table(spark):
    """While one thread swaps, another reads: always a whole table, old or new."""
    root = _root()
    S.full_refresh(spark.range(100).withColumn("v", F.lit(0)), root)
    done, seen, errors = threading.Event(), set(), []

    def read():
        while not done.is_set():
            try:
                rows = S.read_table(spark, root).groupBy("v").count().collect()
                assert len(rows) == 1 and rows[0]["count"] == 100
                seen.add(rows[0].v)
            except Exception as e:  # reported by the main thread
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for v in range(1, 6):
            S.full_refresh(spark.range(100).withColumn("v", F.lit(v)), root)
            # swaps wait for a read: a reader may hold the version before, not older ones
            while not errors and v not in seen:
                done.wait(0.05)
    finally:
        done.set()
        reader.join()
    assert not errors and seen >= {1, 2, 3, 4, 5}


def test_no_data_is_renamed(spark):
    root = _root()
    S.full_refresh(spark.range(5), root)
    before = {f: os.stat(f"{d}/{f}").st_ino for d, _, fs in os.walk(root) for f in fs if f.startswith("part-")}
    held = S.read_table(spark, root)          # planned before the swap
    S.full_refresh(spark.range(7), root)
    after = {f: os.stat(f"{d}/{f}").st_ino for d, _, fs in os.walk(root) for f in fs if f.startswith("part-")}
    assert before.items() <= after.items() and held.count() == 5 and S.read_table(spark, root).count() == 7
    S.full_refresh(spark.range(8), root)      # the first version is gone now, the second stays
    assert len(os.listdir(f"{root}/{V.DATA}")) == 2
    assert len(os.listdir(f"{root}/{V.VERSIONS}")) <= 4   # two versions and their checksums


def test_failed_writes_leave_the_version(spark):
    root = _root()
    S.full_refresh(spark.range(5), root)
    with pytest.raises(Exception):
        S.full_refresh(spark.range(3).withColumn("id", F.raise_error(F.lit("x")).cast("bigint")), root)
    _write(spark, root, 50)                    # a writer that died before its commit
    assert _ids(S.read_table(spark, root)) == [0, 1, 2, 3, 4]
    with pytest.raises(Exception):
        spark.read.parquet(root)               # a reader without versions finds no table, not all versions
    assert V.vacuum(spark, root) == []         # it may yet commit: too young to be an orphan
    assert len(V.vacuum(spark, root, orphan_age_s=0)) == 1 and _ids(optional_source(spark, root)) == [0, 1, 2, 3, 4]


def test_tokens_commit_once(spark):
    root = _root()
    for n in (0, 10, 10, 20):
        folder, schema = _write(spark, root, n, V.new_folder(name=f"s-{n}"))
        V.commit(spark, root, {V.ROWS: [folder]}, {V.ROWS: schema}, token=("s", n))
    assert _ids(V.read(spark, root)) == [0, 1, 2, 10, 11, 12, 20, 21, 22]
    assert V.current(spark, root).number == 3
    again = V.commit(spark, root, {V.ROWS: [V.new_folder(name="other")]}, {V.ROWS: schema}, token=("other", 10))
    assert again.number == 4                   # another source's batch 10 is not this one


def test_old_tokens_are_remembered_as_committed():
    v = V.Version(tokens={"s": tuple(range(5, 5 + V.TOKENS_KEPT))})
    assert v.holds(("s", 4)) and v.holds(("s", 5)) and not v.holds(("s", 5 + V.TOKENS_KEPT)) and not v.holds(None)


def test_rivals_take_different_numbers(spark):
    """Two writers that saw the same version: the second finds its number taken and goes on from the first."""
    root, real = _root(), V._create_once
    first, schema = _write(spark, root, 0)
    rival, _ = _write(spark, root, 10)
    mine, _ = _write(spark, root, 20)
    V.commit(spark, root, {V.ROWS: [first]}, {V.ROWS: schema})
    raced = []

    def race(s, path, text):
        if not raced:
            raced.append(1)
            V._create_once = real
            V.commit(spark, root, {V.ROWS: [rival]}, {V.ROWS: schema})
        return real(s, path, text)

    V._create_once = race
    try:
        V.commit(spark, root, {V.ROWS: [mine]}, {V.ROWS: schema})
    finally:
        V._create_once = real
    assert _ids(V.read(spark, root)) == [0, 1, 2, 10, 11, 12, 20, 21, 22] and V.current(spark, root).number == 3


def test_outputs_change_together_and_compaction_keeps_newcomers(spark):
    root = _root()
    for n in (0, 10):
        (a, schema), (b, _) = _write(spark, root, n), _write(spark, root, n + 100)
        V.commit(spark, root, {"good": [a], "bad": [b]}, {"good": schema, "bad": schema})
    before = V.current(spark, root)
    new, schema = _write(spark, root, 20)
    real = V.commit

    def late(*args, **kwargs):                 # a batch commits while the compaction writes
        V.commit = real
        real(spark, root, {"good": [new]}, {"good": schema})
        return real(*args, **kwargs)

    V.commit = late
    try:
        V.compact(spark, root, "good")
    finally:
        V.commit = real
    after = V.current(spark, root)
    assert len(before.folders["good"]) == 2 and len(after.folders["good"]) == 2 and after.folders["bad"] == before.folders["bad"]
    assert _ids(V.read(spark, root, "good")) == [0, 1, 2, 10, 11, 12, 20, 21, 22]
    assert _ids(V.read(spark, root, "bad")) == [100, 101, 102, 110, 111, 112]
    assert _ids(V.read(spark, root, "good", before)) == [0, 1, 2, 10, 11, 12]   # still there for its readers
    assert V.read(spark, root, "none") is None and V.read(spark, root + "x") is None


def test_plain_tables_become_versioned(spark):
    root = _root()
    spark.range(4).write.parquet(root)
    assert S.read_table(spark, root).count() == 4
    S.full_refresh(S.read_table(spark, root).where("id > 1"), root)
    assert _ids(S.read_table(spark, root)) == [2, 3] and sorted(os.listdir(root)) == [V.DATA, V.VERSIONS]


def test_catalog_name_changes_in_one_statement(spark):
    root = _root()
    spark.sql("CREATE DATABASE IF NOT EXISTS ws_versions")
    spark.sql(f"CREATE TABLE ws_versions.t USING parquet LOCATION '{root}' AS SELECT 1L AS id")   # as it was before
    for n in (3, 4, 5):
        out = S.full_refresh(spark.range(n), root, table="ws_versions.t", bucket_by="id", num_buckets=2)
        assert out.count() == n == spark.table("ws_versions.t").count()
    names = [t.name for t in spark.catalog.listTables("ws_versions")]
    assert "t" in names and len(names) == 3    # the view, its table and the one before
    spark.sql("DROP DATABASE ws_versions CASCADE")
