"""Row numbers 1, 2, 3 ... over a distributed table: unique, gapless, the same on every run.

Equal rows are interchangeable, so they are counted first (before the shuffle, in
part): a row that repeats a billion times is one row here. The distinct rows are sorted by range
over all tasks and staged; each task's part is summed up, the parts' offsets are
running totals of one row a task, and a row's first number is its part's offset plus
what its part holds before it. Numbers follow the rows' content (NULLs first), not their
partitioning. Copies are dealt out again in chunks, so a row repeated often is not
written by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

CHUNK = 1_000_000   # copies of one row that one task may write


def number_rows(df: DataFrame, name: str, after: int = 0, chunk: int = CHUNK) -> DataFrame:
    """All rows of ``df`` plus ``name``: a number from ``after`` + 1 on, first in the row."""
    spark, columns = df.sparkSession, df.columns
    order = [F.asc_nulls_first(F.col(f"`{c}`")) for c in columns]
    alike = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("__n"))
    at = F.monotonically_increasing_id()
    placed = (alike.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", at)
              .withColumn("__part", F.shiftright("__at", 33)))
    path = scratch_path(spark, "numbered")
    placed.write.mode("overwrite").parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)     # one row a task of the sort
    parts = (placed.groupBy(F.col("__part").alias("__p")).agg(F.sum("__n").alias("__total"), F.max("__n").alias("__most"))
             .withColumn("__offset", F.coalesce(F.sum("__total").over(before), F.lit(0))))
    within = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    first = F.lit(after) + F.col("__offset") + F.coalesce(F.sum("__n").over(within), F.lit(0)) + 1
    numbered = (placed.join(F.broadcast(parts.select("__p", "__offset")), F.col("__part") == F.col("__p"))
                .withColumn("__first", first)
                .withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(chunk).cast("long")))))
    if (parts.agg(F.max("__most")).first()[0] or 0) > chunk:
        numbered = numbered.repartition(F.col("__first"), F.col("__chunk"))
    last = F.least(F.col("__chunk") + chunk, F.col("__n")) - 1
    return numbered.select(F.explode(F.sequence(F.col("__first") + F.col("__chunk"), F.col("__first") + last)).alias(name),
                           *[F.col(f"`{c}`") for c in columns])
