"""Ingest operators (I1-I4, I8, I9): spreadsheets-as-tables into the raw zone.

The raw zone keeps every column as text so that ingestion never fails on a
badly typed cell; typing happens in ``operators.clean``. Each load is stamped
with one load time (a parameter, not a per-row clock) and appended, so the raw
tables are an append-only history of snapshots.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import bounded_key
from ..functions.rules import ts_literal
from .numbering import number_rows

# Spreadsheet header -> raw column, in sheet order.
HR_HEADERS = {
    "ID salarié": "employee_id_raw",
    "Nom": "last_name_raw",
    "Prénom": "first_name_raw",
    "Date de naissance": "birth_date_raw",
    "BU": "bu_raw",
    "Date d'embauche": "hire_date_raw",
    "Salaire brut": "gross_salary_raw",
    "Type de contrat": "contract_type_raw",
    "Nombre de jours de CP": "paid_leave_raw",
    "Adresse du domicile": "home_address_raw",
    "Moyen de déplacement": "commute_mode_raw",
}
SPORT_HEADERS = {
    "ID salarié": "employee_id_raw",
    "Pratique d'un sport": "sport_practice_raw",
}
HR_SOURCE_FILE = "Données RH.xlsx"
SPORT_SOURCE_FILE = "Données Sportive.xlsx"


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A tabular export of a spreadsheet. CSV is read as text, cells kept exactly
    (no type inference, no trimming: ``' 12 '`` stays as written)."""
    if fmt == "csv":
        return (spark.read.option("header", True).option("inferSchema", False)
                .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
                .csv(path))
    return spark.read.format(fmt).load(path)


def _ingest(sheet: DataFrame, headers: dict[str, str], source_file: str,
            ingested_ts: datetime) -> DataFrame:
    missing = [h for h in headers if h not in sheet.columns]
    if missing:
        raise ValueError(f"sheet lacks columns {missing}")
    raw_cols = [F.col(f"`{h}`").cast("string").alias(n) for h, n in headers.items()]
    out = sheet.select(F.lit(source_file).alias("source_file"), *raw_cols)
    return stamp_snapshot(out, ingested_ts)


def ingest_hr_snapshot(sheet: DataFrame, ingested_ts: datetime,
                       source_file: str = HR_SOURCE_FILE) -> DataFrame:
    """Rename the HR sheet's headers to ``*_raw`` text columns and stamp the load."""
    return _ingest(sheet, HR_HEADERS, source_file, ingested_ts)


def ingest_sport_snapshot(sheet: DataFrame, ingested_ts: datetime,
                          source_file: str = SPORT_SOURCE_FILE) -> DataFrame:
    """Same for the sport survey (id and practice)."""
    return _ingest(sheet, SPORT_HEADERS, source_file, ingested_ts)


def stamp_snapshot(df: DataFrame, ingested_ts: datetime) -> DataFrame:
    """One ``ingested_ts`` per load plus a reproducible ``snapshot_id``.

    The id hashes the load time and the row's content, NULLs included; it is stable
    across re-runs and partitionings. It labels a row and does not identify it:
    identical rows of one load share it until ``number_snapshot`` gives each row its
    own; what was loaded before is told by comparing whole rows.
    """
    data_cols = [c for c in df.columns]
    ts = ts_literal(ingested_ts)
    return df.select(
        bounded_key(ts, *[F.col(c) for c in data_cols]).alias("snapshot_id"),
        ts.alias("ingested_ts"),
        *data_cols,
    )


def number_snapshot(raw: DataFrame, after: int = 0) -> DataFrame:
    """I3 as a declared key: ``snapshot_id`` replaced by a number of its own for every row, from ``after`` + 1 on.

    Rows of a later load get higher numbers; equal rows of a load get different ones.
    """
    columns = ["ingested_ts", *[c for c in raw.columns if c not in ("snapshot_id", "ingested_ts")]]
    numbered = number_rows(raw.select(*columns), "snapshot_id", after)
    return numbered.select(*raw.columns)


def latest_snapshot(raw: DataFrame, ts_col: str = "ingested_ts",
                    partition_col: str | None = None) -> DataFrame:
    """I4: rows of the most recent load only; an empty table gives no rows.

    Written as an uncorrelated scalar subquery, so Spark evaluates ``max`` once
    and offers the value to the scan as a filter. When the history is
    partitioned by load date (``partition_col``), the newest partition is
    selected first: the subquery result becomes a partition filter, so the
    timestamp max and the rows are read from that partition only.
    """
    if partition_col is not None and partition_col in raw.columns:
        newest = raw.select(F.max(partition_col)).scalar()
        raw = raw.where(F.col(partition_col) == newest)
    latest = raw.select(F.max(ts_col)).scalar()
    out = raw.where(F.col(ts_col) == latest)
    return out.drop(partition_col) if partition_col is not None and partition_col in raw.columns else out


def require_non_empty(df: DataFrame, name: str) -> DataFrame:
    """I8: stop the job early when an upstream table is empty (a LIMIT 1 probe)."""
    if df.isEmpty():
        raise RuntimeError(f"{name} is empty; run its upstream job first")
    return df


def optional_source(spark: SparkSession, path: str) -> DataFrame | None:
    """A missing table is tolerated (``None``) instead of failing the job; an empty one is read as empty.

    A folder without a version, any data file and a recorded schema holds no table: missing.
    """
    from . import versions
    from .sinks import read_schema, read_table, recover

    recover(spark, path)
    fs, hpath = versions.filesystem(spark, path)
    if not fs.exists(hpath):
        return None
    current = versions.read(spark, path)
    if current is not None:
        return current
    if read_schema(spark, path) is None:
        files = fs.listFiles(hpath, True)
        while files.hasNext():
            if files.next().getPath().getName()[0] not in "._":
                break
        else:
            return None
    return read_table(spark, path)


def source_status(sources: dict[str, DataFrame | None]) -> DataFrame | None:
    """I9 report: one row per named source -- present or not, and its row count.

    Counts are global aggregates (one row each), assembled with ``unionByName``.
    """
    rows = []
    spark = None
    for name, df in sources.items():
        if df is not None:
            spark = df.sparkSession
            rows.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                        .select(F.lit(name).alias("source_name"), F.lit(True).alias("present"),
                                "row_count"))
    for name, df in sources.items():
        if df is None and spark is not None:
            rows.append(spark.range(1).select(F.lit(name).alias("source_name"),
                                              F.lit(False).alias("present"),
                                              F.lit(None).cast("bigint").alias("row_count")))
    if not rows:
        return None
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
