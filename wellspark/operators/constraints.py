"""Declared-integrity validators (V1-V4): what a database would enforce on write.

Parquet enforces no key, reference or CHECK, so these run on a DataFrame before
it is written. Each returns the violating rows (or one row per column for
NOT NULL counts); an empty result means the constraint holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """V1: key values that repeat or contain a NULL part, with their row counts.

    A grouped count with map-side partial aggregation: a hot key is reduced to
    one row per task before the shuffle.
    """
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(any_null | (F.col("n_rows") > 1))
            .select(*keys, "n_rows",
                    F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate")).alias("violation")))


def fk_orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str | None = None) -> DataFrame:
    """V2: child rows whose non-NULL reference has no parent row (NULL references pass).

    A left-anti join; the parent side is projected to its key and de-duplicated
    (an aggregate, so duplicates never multiply the probe side).
    """
    parent_col = parent_col or child_col
    keys = parent.select(F.col(parent_col).alias("_parent_key")).where(F.col("_parent_key").isNotNull()).distinct()
    c = child.where(F.col(child_col).isNotNull())
    return c.join(keys, c[child_col] == keys["_parent_key"], "left_anti")


def check_violations(df: DataFrame, checks: dict[str, str], keys: tuple[str, ...] | list[str]) -> DataFrame:
    """V3: one row per (row, violated CHECK). A CHECK whose result is NULL passes.

    All conditions are evaluated in one scan: an array of the names of the
    violated constraints is built per row and exploded.
    """
    names = [F.when(~F.coalesce(F.expr(cond), F.lit(True)), F.lit(name)) for name, cond in checks.items()]
    violated = F.filter(F.array(*names), lambda x: x.isNotNull())
    return (df.select(*keys, violated.alias("_violated"))
            .where(F.size("_violated") > 0)
            .select(*keys, F.explode("_violated").alias("constraint_name")))


def reject_reasons(df: DataFrame, not_null: tuple[str, ...], checks: dict[str, str], parent: DataFrame | None = None,
                   column: str | None = None) -> DataFrame:
    """All rows of ``df`` plus ``reject_reasons``: an array, empty for a row that breaks no constraint.

    V2-V4 for a quarantine: one pass, and one join with the parent's distinct keys.
    """
    found = [F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in not_null]
    found += [F.when(~F.coalesce(F.expr(cond), F.lit(True)), F.lit(name)) for name, cond in checks.items()]
    if parent is not None:
        keys = parent.select(F.col(column).alias("_parent_key")).where(F.col("_parent_key").isNotNull()).distinct()
        df = df.join(keys, df[column] == keys["_parent_key"], "left")
        found.append(F.when(F.col(column).isNotNull() & F.col("_parent_key").isNull(), F.lit(f"unknown_{column}")))
    reasons = F.filter(F.array(*found), lambda x: x.isNotNull())
    return df.withColumn("reject_reasons", reasons).drop("_parent_key")


def not_null_violations(df: DataFrame, columns: tuple[str, ...] | list[str], table_name: str) -> DataFrame:
    """V4: NULL count per declared NOT NULL column, one global aggregate for all columns."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(F.lit(table_name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(c).alias("null_count")) for c in columns]
    return agg.select(F.inline(F.array(*rows)))
