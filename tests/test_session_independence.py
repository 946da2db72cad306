"""Results do not depend on session settings the driver might use differently."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck
from tests.test_skew import conf

OTHER_SESSION = {
    "spark.sql.session.timeZone": "Asia/Tokyo",
    "spark.sql.ansi.enabled": "false",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "1024",   # sort-merge joins everywhere
}
SUBSET = ("employee_benefits", "quality_report", "commute_anomalies_top5", "commute_validation",
          "clean_employees", "clean_activities", "kpi_pipeline_daily", "report_flow_breaks",
          "derive_activity_window", "fact_activity", "latest_snapshot", "report_practices")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SUBSET)
def test_same_results_under_other_settings(spark, con, name):
    with conf(spark, **OTHER_SESSION):
        r = compare(spark, con, name, SF_SMALL, E.queries()[name], E.oracle_sql()[name])
    assert r["ok"], r
