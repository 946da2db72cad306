"""wellspark: a Spark-native HR and sport-benefits pipeline.

Every operator is a function from DataFrames (plus plain parameters) to a
DataFrame, written with built-in Spark SQL expressions so Catalyst can prune,
push down and plan it. Layout:

* ``sources``   -- reading the driver tables, the fixture mapping, ingest and sinks
* ``functions`` -- reusable Column expressions (coercion, business-rule predicates, keys)
* ``operators`` -- clean, config, benefits, commute, quality, constraints, marts, reports
* ``plans``     -- job order, the query registry and the DuckDB twins of each query
* ``streaming`` -- incremental activity feed with Structured Streaming
"""

__version__ = "0.1.0"

from .operators.benefits import employee_benefits  # noqa: E402  (flagship, B8)
from .operators.clean import clean_activities, clean_employees  # noqa: E402
from .operators.commute import commute_anomalies, commute_anomalies_top5, commute_validation  # noqa: E402
from .operators.quality import enforce_gate, quality_gate, quality_report  # noqa: E402
from .sources.ingest import ingest_hr_snapshot, ingest_sport_snapshot, latest_snapshot, read_sheet  # noqa: E402
from .sources.sinks import full_refresh, rebuild_table  # noqa: E402

__all__ = [
    "employee_benefits", "clean_activities", "clean_employees", "commute_anomalies",
    "commute_anomalies_top5", "commute_validation", "enforce_gate", "quality_gate", "quality_report",
    "ingest_hr_snapshot", "ingest_sport_snapshot", "latest_snapshot", "read_sheet",
    "full_refresh", "rebuild_table",
]
