"""Incremental activity feed with Structured Streaming.

The batch job (``plans.jobs.load_activities``) rebuilds clean.activities from
the whole feed. This module keeps it current as new feed files arrive:

* ``start_clean_activities`` -- every row is judged by the declared constraints (NOT
  NULL, CHECK, known employee); rows that break one go to the target's quarantine with all
  their reasons. The others are de-duplicated by ``activity_id`` (the rule of the
  batch operator) by a keyed state in RocksDB, one row an id. No
  watermark: a late activity is still written, never dropped. An id seen in an earlier
  batch keeps its first version. A batch's clean and rejected rows are written
  at once and become visible in one commit (``sources.versions``), so a retried batch
  writes nothing twice. Ids that the target holds when a checkpoint is new are loaded into
  the state by the first batch: a replay adds nothing.
* ``start_daily_volume`` / ``start_daily_volume_table`` -- activities per day
  as a running aggregate (one state row per calendar day, so the state is
  bounded by the calendar, not by the data), in ``complete`` mode to a memory
  sink (tests) or to a table replaced by a staged swap on every trigger.

Checkpoints live under ``spark.checkpoint.dir`` so a restarted query resumes
from its last committed batch.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.constraints import reject_reasons
from ..session import scratch_path
from ..sources import versions
from ..sources.ingest import optional_source
from ..sources.sinks import conform, exists, full_refresh


def read_activity_feed(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files dropped into ``path`` as a stream (schema declared, never inferred)."""
    r = spark.readStream.schema(schemas.ACTIVITIES)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


QUARANTINE = "quarantine"   # the output of a target that holds its rejected rows
VACUUM_EVERY, VERSIONS_KEPT = 100, 20   # batches between clean-ups of the version files, and how many stay

# State per id lives in RocksDB on the executors, its changes under the checkpoint: a batch reads and
# writes the ids that it holds, however many there are.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_ORDER = ("start_ts", "employee_id", "end_ts", "sport_type", "distance_m", "elapsed_s", "comment_text")
_CLEAN = T.StructType([*schemas.ACTIVITIES.fields, T.StructField("activity_year", T.IntegerType())])
_REASONS = T.StructField("reject_reasons", T.ArrayType(T.StringType()))
_REJECTED = T.StructType([*schemas.ACTIVITIES.fields, _REASONS, T.StructField("activity_year", T.IntegerType())])


def first_versions(rows: DataFrame) -> DataFrame:
    """Streaming C6: an id's rows of the first batch that holds it, the first of them in the batch operator's order.

    ``rows`` has ``_new``: 0 for ids that are known already, which win over any row of
    their batch and are not put out. The state holds one row an id; in update
    mode a batch puts out the ids it touches, of which those seen before are told
    by the time of their first batch.
    """
    grouped = (rows.withColumn("_batch", F.current_timestamp()).groupBy("activity_id")
               .agg(F.min(F.struct("_batch", "_new", *_ORDER)).alias("first"), F.max("_batch").alias("last")))
    return (grouped.where((F.col("first._batch") == F.col("last")) & (F.col("first._new") == 1))
            .select("activity_id", *[F.col(f"first.{c}").alias(c) for c in _ORDER])
            .select(*schemas.ACTIVITIES.fieldNames()))


def _known_ids(spark: SparkSession, target: str, checkpoint: str) -> DataFrame:
    """A stream of the ids that the target held when the checkpoint was new: read whole by the first batch."""
    path = f"{checkpoint.rstrip('/')}__known"
    if versions.current(spark, path) is None:
        held = optional_source(spark, target)
        schema = T.StructType([schemas.ACTIVITIES["activity_id"]])
        full_refresh(spark.createDataFrame([], schema) if held is None else held.select("activity_id"), path)
    now = versions.current(spark, path)
    return spark.readStream.schema(now.schema()).parquet(*[f"{path}/{f}" for f in now.folders[versions.ROWS]])


def judged_feed(feed: DataFrame, target: str, checkpoint: str, employees: DataFrame | None) -> DataFrame:
    """Clean rows (no reject reasons) and rejected ones of the feed, as one stream in update mode."""
    judged = reject_reasons(conform(feed, schemas.ACTIVITIES), schemas.NOT_NULL["activities"],
                            schemas.CHECKS["activities"], employees, "employee_id")
    bad = F.size("reject_reasons") > 0
    valid = judged.where(~bad).drop("reject_reasons").withColumn("_new", F.lit(1))
    known = _known_ids(feed.sparkSession, target, checkpoint).withColumn("_new", F.lit(0))
    clean = first_versions(valid.unionByName(known, allowMissingColumns=True))
    clean = clean.withColumn("reject_reasons", F.array().cast("array<string>"))
    return clean.unionByName(judged.where(bad)).withColumn("activity_year", F.year("start_ts"))


def write_batch(batch: DataFrame, batch_id: int, target: str, source: str) -> None:
    """Write a batch's clean and rejected rows in one go and make both current in one commit.

    A batch that died before its commit left nothing visible and is written again, over
    its own folder. One that died after it runs again for its state alone.
    """
    spark, token = batch.sparkSession, (source, batch_id)
    now = versions.current(spark, target)
    if now is not None and now.holds(token):
        batch.write.format("noop").mode("overwrite").save()
        return
    folder = versions.new_write(f"{hashlib.md5(source.encode()).hexdigest()[:12]}-{batch_id}")
    output = F.when(F.size("reject_reasons") > 0, QUARANTINE).otherwise(versions.ROWS)
    (batch.withColumn(versions.OUTPUT, output).write.mode("overwrite").partitionBy(versions.OUTPUT, "activity_year")
     .parquet(f"{target.rstrip('/')}/{folder}"))
    schema_of = {versions.ROWS: _CLEAN, QUARANTINE: _REJECTED}
    folder_of = {o: f"{folder}/{versions.OUTPUT}={o}" for o in schema_of}
    written = {o: [f] if exists(spark, f"{target.rstrip('/')}/{f}") else [] for o, f in folder_of.items()}
    after = versions.commit(spark, target, written, schema_of, token=token)
    if after.number % VACUUM_EVERY == 0:
        versions.vacuum(spark, target, keep=VERSIONS_KEPT)


def read_quarantine(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows that the stream has rejected, each with all its reasons."""
    return versions.read(spark, target, QUARANTINE)


def compact_activities(spark: SparkSession, target: str) -> None:
    """Merge the folders that batches leave (a version names them all); batches may go on meanwhile.

    The old folders go with the next clean-up, once no version kept names them.
    """
    for output in (versions.ROWS, QUARANTINE):
        versions.compact(spark, target, output, ["activity_year"])


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_clean_activities(feed: DataFrame, target: str, checkpoint: str | None = None, available_now: bool = True,
                           employees: DataFrame | None = None) -> StreamingQuery:
    """Keep the clean table and its quarantine current as the feed grows, batch by batch.

    With ``employees``, as they are when the query starts, activities of others are rejected.
    """
    spark = feed.sparkSession
    ckpt = checkpoint or scratch_path(spark, "ckpt-clean-activities")
    w = (judged_feed(feed, target, ckpt, employees).writeStream.outputMode("update")
         .foreachBatch(lambda df, bid: write_batch(df, bid, target, ckpt))
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    with _settings(spark, STATE_CONF):
        return w.start()


def daily_volume(feed: DataFrame) -> DataFrame:
    """Streaming aggregate: activities and distance per calendar day of ``start_ts``."""
    return (feed.where(F.col("start_ts").isNotNull())
            .groupBy(F.to_date("start_ts").alias("activity_date"))
            .agg(F.count(F.lit(1)).alias("n_activities"),
                 F.sum("distance_m").cast("bigint").alias("total_distance_m")))


def start_daily_volume(feed: DataFrame, query_name: str, checkpoint: str | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Run ``daily_volume`` into an in-memory table named ``query_name`` (complete mode)."""
    spark = feed.sparkSession
    w = (daily_volume(feed).writeStream.outputMode("complete").format("memory").queryName(query_name)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"ckpt-{query_name}")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_daily_volume_table(feed: DataFrame, target: str, checkpoint: str | None = None,
                             available_now: bool = True) -> StreamingQuery:
    """``daily_volume`` kept as a table: each trigger's complete result (one row per day)
    replaces the target through the validated refresh of the batch sinks."""
    from ..operators.constraints import pk_violations

    def write(batch: DataFrame, batch_id: int) -> None:
        full_refresh(batch, target, [lambda df: pk_violations(df, ("activity_date",))])

    spark = feed.sparkSession
    w = (daily_volume(feed).writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-daily-volume")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
