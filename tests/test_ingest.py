"""Ingest from a CSV export of the spreadsheets (original French headers, all text)."""

import tempfile
from datetime import datetime

from wellspark.sources import fixtures as fx, ingest as I


def test_csv_sheet_ingests_like_the_table(spark, tables_small):
    sheet = fx.hr_sheet(tables_small)
    path = tempfile.mkdtemp(prefix="ws-csv-") + "/hr"
    (sheet.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    from_csv = I.ingest_hr_snapshot(I.read_sheet(spark, path), datetime(2024, 2, 1))
    direct = I.ingest_hr_snapshot(sheet, datetime(2024, 2, 1))
    cols = [c for c in direct.columns if c != "snapshot_id"]
    # CSV writes NULL and '' alike; compare after mapping '' to NULL on both sides
    norm = lambda df: sorted((tuple("<null>" if v in (None, "") else str(v) for v in r)
                              for r in df.select(*cols).collect()))
    assert norm(from_csv) == norm(direct)
    assert from_csv.columns == direct.columns


def test_missing_header_is_an_error(spark):
    import pytest
    df = spark.createDataFrame([("1",)], "`ID salarié` string")
    with pytest.raises(ValueError):
        I.ingest_hr_snapshot(df, datetime(2024, 2, 1))


def test_optional_and_status(spark, tables_small):
    assert I.optional_source(spark, tempfile.mkdtemp(prefix="ws-none-") + "/nothing") is None
    st = {r.source_name: (r.present, r.row_count) for r in
          I.source_status({"events": tables_small.events, "gone": None}).collect()}
    assert st == {"events": (True, 1000), "gone": (False, None)}


def test_require_non_empty(spark, tables_small):
    import pytest
    assert I.require_non_empty(tables_small.nation, "nation") is not None
    with pytest.raises(RuntimeError, match="clean.employees is empty"):
        I.require_non_empty(tables_small.nation.limit(0), "clean.employees")
