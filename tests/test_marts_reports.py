"""Hand-written rows for the mart and report rules (our documented choices)."""

from datetime import date, datetime

from pyspark.sql import functions as F

from wellspark.operators import clean as C, marts as M, reports as R

ACT = ("activity_id bigint, employee_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, "
       "sport_type string, distance_m int, elapsed_s int, comment_text string")


def _acts(spark, rows):
    return spark.createDataFrame([(i, e, ts, None, sport, dist, el, None)
                                  for i, (e, ts, sport, dist, el) in enumerate(rows)], ACT)


def test_flow_breaks_counts_missing_days_as_zero(spark):
    rows = [(1, datetime(2024, 1, 1, 9), "running", 100, 700)] * 4 + \
           [(1, datetime(2024, 1, 2, 9), "running", 100, 700)] * 1 + \
           [(1, datetime(2024, 1, 4, 9), "running", 100, 700)] * 2
    out = {r.activity_date: (r.n_activities, r.prev_n_activities, r.is_break)
           for r in R.report_flow_breaks(_acts(spark, rows)).collect()}
    assert out == {date(2024, 1, 1): (4, None, False), date(2024, 1, 2): (1, 4, True),
                   date(2024, 1, 3): (0, 1, True), date(2024, 1, 4): (2, 0, False)}


def test_kpi_null_when_source_absent_that_day(spark):
    hr = spark.createDataFrame([(datetime(2024, 1, 1),)] * 3, "ingested_ts timestamp_ntz")
    sp = spark.createDataFrame([(datetime(2024, 1, 2),)], "ingested_ts timestamp_ntz")
    acts = _acts(spark, [(1, datetime(2024, 1, 2, 8), "running", 1, 1)])
    anomalies = spark.createDataFrame([], "computed_ts timestamp_ntz")
    out = {r.kpi_date: r for r in M.kpi_pipeline_daily(hr, sp, acts, anomalies, "d", True).collect()}
    assert out[date(2024, 1, 1)].rows_rh_ingested == 3 and out[date(2024, 1, 1)].rows_sport_ingested is None
    assert out[date(2024, 1, 2)].rows_rh_ingested is None and out[date(2024, 1, 2)].rows_activities_generated == 1
    assert all(r.status == "success" and r.anomalies_count is None for r in out.values())


def test_kpi_status_is_the_gate(spark):
    hr = spark.createDataFrame([(datetime(2024, 1, 1),)], "ingested_ts timestamp_ntz")
    none = spark.createDataFrame([], "computed_ts timestamp_ntz")
    for ok, want in ((True, "success"), (False, "failed"), (None, "failed")):
        gate = spark.createDataFrame([(ok,)], "gate_ok boolean")
        got = M.kpi_pipeline_daily(hr, hr.limit(0), _acts(spark, []), none, "d", gate).collect()
        assert [r.status for r in got] == [want]


def test_wellness_facts_per_year_and_known_employees(spark):
    emp = spark.createDataFrame([(1,), (2,)], "employee_id bigint")
    rows = [(1, datetime(2023, 5, 1), "running", 1000, 700)] * 15 + \
           [(1, datetime(2024, 5, 1), "running", 1000, 700)] * 14 + \
           [(1, datetime(2024, 5, 1), "yoga", 1000, 700)] * 3 + \
           [(9, datetime(2024, 5, 1), "running", 1000, 700)] * 20        # unknown employee
    out = {(r.employee_id, r.year): (r.activities_count, r.days_granted, r.is_eligible)
           for r in M.fact_wellness_days(emp, _acts(spark, rows), datetime(2024, 2, 1)).collect()}
    assert out == {(1, 2023): (15, 5, True), (1, 2024): (14, 0, False)}


def test_plausibility_bands(spark):
    rows = [(1, datetime(2024, 1, 10), "walking", 1000, 600), (1, datetime(2024, 1, 10), "walking", 12001, 7200),
            (1, datetime(2024, 1, 10), "Running", 25000, 599), (1, datetime(2024, 1, 10), "cycling", 1999, 7201),
            (1, datetime(2022, 1, 10), "cycling", 60000, 700), (1, datetime(2024, 1, 10), "running", None, 700)]
    r = C.activity_plausibility(_acts(spark, rows), datetime(2024, 2, 1)).first()
    assert (r.n_activities, r.n_distance_out_of_band, r.n_duration_out_of_band, r.n_outside_lookback) == (6, 2, 2, 1)
    assert r.count_in_band is True


def test_window_derivation(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 10), None, 90), (2, datetime(2024, 1, 1, 10),
                                datetime(2024, 1, 1, 11), 10)],
                               "activity_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, elapsed_s int")
    out = {r.activity_id: r for r in C.derive_activity_window(df).collect()}
    assert out[1].end_ts == datetime(2024, 1, 1, 10, 1, 30) and out[1].window_s is None
    assert out[2].end_ts == datetime(2024, 1, 1, 11) and out[2].window_s == 3600


def test_practice_shares_sum_to_one(spark):
    emp = spark.createDataFrame([("Running",), ("Running",), (None,), ("Tennis",)], "sport_profile string")
    out = {r.sport_profile: (r.n_employees, r.share) for r in R.report_practices(emp).collect()}
    assert out == {"Running": (2, 0.5), None: (1, 0.25), "Tennis": (1, 0.25)}
    assert R.report_practices(emp).agg(F.sum("share")).first()[0] == 1.0
