"""Helpers shared by the training-data operators: reading tables, staging, text keys."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# The ASCII white space that separates words and is stripped from lines.
WHITE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Staged tables: zstd frees its native buffers with each file; snappy's wait for a garbage collection.
CODEC = "zstd"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OPEN: list[list[str]] = []   # tables staged in the scratches that are open, the innermost last


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged inside are deleted on leaving, however it is left.

    Whatever reads them must have been written by then (``stage(..., keep=True)``).
    """
    staged: list[str] = []
    _OPEN.append(staged)
    try:
        yield
    finally:
        _OPEN.remove(staged)
        for path in staged:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` that goes with the innermost open ``scratch``, if any."""
    path = scratch_path(spark, name)
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), keep: bool = False) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table every executor can read again, so a lost
    executor costs a re-read and not a recomputation of all that came before.
    Inside a ``scratch`` it lives as long as that, unless it is to be kept.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name) if keep else scratch_folder(spark, name)
    writer = df.write.mode("errorifexists").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept (``lower`` is only right for pure ASCII)."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_LOWER))


def fingerprint(*cols: Column, seed: int = 0) -> Column:
    """64-bit hash of the columns in which a NULL counts as a value of its own."""
    parts: list[Column] = [F.lit(seed)]
    for c in cols:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)


def hash_unit(*cols: Column) -> Column:
    """Uniform double in (0, 1) derived from the columns: the same on every rerun."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 12).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2 ** 52))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
