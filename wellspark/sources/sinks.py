"""Sinks (I5-I7): validated overwrite, cascade handling and rebuild.

Writes go to paths (or catalog tables) on shared storage. New content is written
to a data folder of its own and validated there; only then does the table's pointer
name it (``sources.versions``): no data is renamed, and a reader finds the old
table or the new one, never none. In the catalog a table is a view over the
current folder's table, replaced in one statement.
Writing a table also cuts the lineage, so a lost executor re-reads the written
files instead of recomputing upstream stages.
"""

from __future__ import annotations

from collections.abc import Callable

import json
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions


class ValidationError(RuntimeError):
    pass


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order, cast to its types (extra columns dropped)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValidationError(f"missing columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


SCHEMA_FILE = "_wellspark_schema.json"  # readers skip names that begin with an underscore


def full_refresh(df: DataFrame, path: str, validators: list[Callable[[DataFrame], DataFrame]] = (),
                 partition_by: list[str] | None = None, fmt: str = "parquet",
                 on_written: Callable[[int], None] | None = None, table: str | None = None,
                 bucket_by: str | None = None, num_buckets: int = 0) -> DataFrame:
    """Replace the target's content with validated data; returns the written table.

    The data is computed once, into a folder of its own (rows counted while
    writing, for the M7 run log via ``on_written``). Validators read those
    written files -- not the upstream plan again -- and any violating row stops
    the job with the target untouched (unlike TRUNCATE-then-INSERT, which can
    leave it empty); whatever fails, the new folder is removed. Then one small version
    file makes the folder the table's content. The version before stays for
    readers that hold it, older ones go.

    With ``table`` the target is also a catalog table (needed for ``bucket_by``:
    tables bucketed alike on a key are joined and grouped without a shuffle): a view
    of that name, replaced as the last step, over a table of the folder.

    Because the target is only touched at the end, the input may read it. A target
    that was a plain folder before becomes a versioned one; its plain files go.
    """
    spark = df.sparkSession
    recover(spark, path)
    folder = versions.new_folder()
    new_loc = f"{path.rstrip('/')}/{folder}"
    name = _folder_table(table, folder)
    try:
        rows = observed_write(df, new_loc, "overwrite", partition_by, fmt, name, bucket_by, num_buckets)
        staged = versions.read_folders(spark, path, [folder], df.schema, fmt)
        for v in validators:
            bad = v(staged)
            if not bad.isEmpty():
                sample = [r.asDict() for r in bad.limit(5).collect()]
                raise ValidationError(f"{getattr(v, '__name__', 'validator')} failed: {sample}")
        after = versions.commit(spark, path, {versions.ROWS: [folder]}, {versions.ROWS: df.schema}, remove=None)
    except BaseException:
        if name is not None:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
        delete(spark, new_loc.rsplit("/", 1)[0])
        raise
    if table is not None:
        _show(spark, table, name)
    _drop_plain(spark, path)
    for gone in versions.vacuum(spark, path):
        if table is not None:
            spark.sql(f"DROP TABLE IF EXISTS {_folder_table(table, gone)}")
    if on_written is not None:
        on_written(rows)
    return spark.table(table) if table is not None else versions.read(spark, path, at=after, fmt=fmt)


def _folder_table(table: str | None, folder: str) -> str | None:
    return None if table is None else f"{table}__v_{folder.split('/')[1].removeprefix('_write=')}"


def _show(spark, table: str, folder_table: str) -> None:
    """Point the catalog name at the table of a folder, in one statement."""
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {table}")  # from before tables had versions
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {folder_table}")


def _drop_plain(spark, path: str) -> None:
    """Remove what a plain write had left in the root of a table that has versions now."""
    fs, root = versions.filesystem(spark, path)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name not in (versions.DATA, versions.VERSIONS):
            fs.delete(status.getPath(), True)


def _write_schema(spark, path: str, schema: T.StructType) -> None:
    versions.write_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}", schema.json())


def read_schema(spark, path: str) -> T.StructType | None:
    fs, target = versions.filesystem(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if not fs.exists(target):
        return None
    return T.StructType.fromJson(json.loads(versions.read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")))


def read_table(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """A written table, empty or not: its current version, or a plain folder with the schema on record, if any."""
    current = versions.read(spark, path, fmt=fmt)
    if current is not None:
        return current
    schema = read_schema(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(path)


def observed_write(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                   fmt: str = "parquet", table: str | None = None, bucket_by: str | None = None,
                   num_buckets: int = 0) -> int:
    """Write and return the number of rows written, counted by ``observe`` during the write
    itself (no second pass over the data)."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    if table is not None and bucket_by and num_buckets:
        # one task per bucket and, for a hot key, its share of the rows: at most buckets x partitions files
        df = df.repartition(num_buckets, bucket_by)
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table is not None:
        if bucket_by and num_buckets:
            w = w.bucketBy(num_buckets, bucket_by).sortBy(bucket_by)
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)
    return int(obs.get["rows"])


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> int:
    """Raw-zone history: append one load (optionally partitioned by load date); returns the rows appended."""
    rows = observed_write(df, path, "append", partition_by, fmt)
    if read_schema(df.sparkSession, path) is None:
        _write_schema(df.sparkSession, path, df.schema)
    return rows


def cascade_refresh(children: DataFrame, parents: DataFrame, child_col: str = "employee_id",
                    parent_col: str = "employee_id", mode: str = "prune") -> DataFrame:
    """What a parent refresh does to dependent rows.

    ``truncate`` reproduces a cascading TRUNCATE (children emptied);
    ``prune`` keeps the children whose parent still exists (a left-semi join).
    """
    if mode == "truncate":
        return children.limit(0)
    if mode != "prune":
        raise ValueError(mode)
    keys = parents.select(F.col(parent_col).alias("_k")).where(F.col("_k").isNotNull())
    return children.join(keys, children[child_col] == keys["_k"], "left_semi")


def rebuild_table(df: DataFrame, path: str, schema: T.StructType | None = None,
                  validators: list[Callable[[DataFrame], DataFrame]] = (), fmt: str = "parquet",
                  partition_by: list[str] | None = None, table: str | None = None,
                  bucket_by: str | None = None, num_buckets: int = 0) -> DataFrame:
    """Drop-and-recreate with the declared schema (columns in order, cast): written apart,
    validated, then made current by the pointer. The target is never missing."""
    out = conform(df, schema) if schema is not None else df
    return full_refresh(out, path, validators, partition_by, fmt, table=table, bucket_by=bucket_by,
                        num_buckets=num_buckets)


def recover(spark, target: str) -> None:
    """Put back a table that an earlier release, which renamed folders, left aside when it crashed."""
    fs, t = versions.filesystem(spark, target)
    parent = t.getParent()
    if fs.exists(t) or parent is None or not fs.exists(parent):
        return
    for status in fs.listStatus(parent):
        if status.getPath().getName().startswith(f"{t.getName()}.__previous-"):
            fs.rename(status.getPath(), t)
            return


def exists(spark, path: str) -> bool:
    fs, target = versions.filesystem(spark, path)
    return bool(fs.exists(target))


def delete(spark, path: str) -> None:
    fs, target = versions.filesystem(spark, path)
    fs.delete(target, True)
