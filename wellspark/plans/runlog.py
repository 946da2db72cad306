"""Run log (M7): one row per run and one per task, written as they happen.

Every row lives in a partition of its own (``run_id=.../task_id=...``) that is
overwritten, so a re-run replaces its rows instead of adding to them, and a task
that dies leaves ``running`` or ``failed`` with its error. Row counts come from
the writes themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources.sinks import conform

RUNNING, SUCCESS, FAILED, SKIPPED = "running", "success", "failed", "skipped"
ERROR_CHARS = 2000


def utc_run_id(load_ts: datetime) -> int:
    """Seconds since the epoch of the load time, read as UTC wherever the driver runs."""
    return int(load_ts.replace(tzinfo=load_ts.tzinfo or timezone.utc).timestamp())


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class Task:
    rows_in: int | None = None
    rows_out: int | None = None
    skipped: str | None = None
    _inputs: list[Observation] = field(default_factory=list)

    def reads(self, df: DataFrame) -> DataFrame:
        """``df``, whose rows are counted as the task's write reads it: no pass of its own.

        For an input that the write reads once and whole; a plan that may skip it (an anti-join
        with nothing left to find) has to count it by itself.
        """
        seen = Observation()
        self._inputs.append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def settle(self) -> None:
        """Take over what the inputs have counted; called when the task has ended well."""
        for seen in self._inputs:
            self.rows_in = (self.rows_in or 0) + int(seen.get["rows"])

    def wrote(self, rows: int) -> None:
        """For ``on_written`` of the sinks."""
        self.rows_out = (self.rows_out or 0) + rows


class RunLog:
    """``with RunLog(...) as log:`` logs a run; ``with log.task(name) as t:`` logs a task of it."""

    def __init__(self, spark: SparkSession, run_path: str, task_path: str, run_id: int, dag_id: str,
                 planned: tuple[str, ...] = (), clock: Callable[[], datetime] = _now):
        self.spark, self.run_path, self.task_path = spark, run_path.rstrip("/"), task_path.rstrip("/")
        self.run_id, self.dag_id, self.planned = run_id, dag_id, planned
        self.seen: list[str] = []
        self.clock = clock

    def _put(self, path: str, schema, row: dict) -> None:
        df = self.spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields)], schema)
        keys = [c for c in ("run_id", "task_id") if c in row]
        where = "/".join(f"{k}={row[k]}" for k in keys)
        conform(df, schema).drop(*keys).coalesce(1).write.mode("overwrite").parquet(f"{path}/{where}")

    def _run(self, status: str, started: datetime, ended: datetime | None = None, error: str | None = None) -> None:
        self._put(self.run_path, schemas.PIPELINE_RUN, {
            "run_id": self.run_id, "dag_id": self.dag_id, "status": status, "started_ts": started,
            "ended_ts": ended, "error_message": error})

    def _task(self, task_id: str, status: str, started: datetime | None, ended: datetime | None, task: Task,
              error: str | None = None) -> None:
        self._put(self.task_path, schemas.PIPELINE_TASK_RUN, {
            "run_id": self.run_id, "dag_id": self.dag_id, "task_id": task_id, "status": status,
            "started_ts": started, "ended_ts": ended, "rows_in": task.rows_in, "rows_out": task.rows_out,
            "error_message": error})

    def __enter__(self) -> "RunLog":
        self.started = self.clock()
        self._run(RUNNING, self.started)
        return self

    def __exit__(self, kind, error, _) -> None:
        for task_id in self.planned:
            if task_id not in self.seen:
                self._task(task_id, SKIPPED, None, None, Task(), "not reached")
        text = None if error is None else f"{kind.__name__}: {error}"[:ERROR_CHARS]
        self._run(SUCCESS if error is None else FAILED, self.started, self.clock(), text)

    @contextmanager
    def task(self, task_id: str):
        t, started = Task(), self.clock()
        self.seen.append(task_id)
        self._task(task_id, RUNNING, started, None, t)
        try:
            yield t
            t.settle()
        except BaseException as exc:
            self._task(task_id, FAILED, started, self.clock(), t, f"{type(exc).__name__}: {exc}"[:ERROR_CHARS])
            raise
        self._task(task_id, SKIPPED if t.skipped else SUCCESS, started, self.clock(), t, t.skipped)


def read_run_log(spark: SparkSession, run_path: str) -> DataFrame:
    """The run rows, with their declared types."""
    return conform(spark.read.parquet(run_path).withColumn("run_id", F.col("run_id").cast("bigint")), schemas.PIPELINE_RUN)


def read_task_log(spark: SparkSession, task_path: str):
    """The task rows, with their declared types."""
    return conform(spark.read.parquet(task_path).withColumn("run_id", F.col("run_id").cast("bigint")),
                   schemas.PIPELINE_TASK_RUN)
