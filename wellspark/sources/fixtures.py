"""Domain tables derived from the driver's TPC-H-like tables (FIXTURES.md, part B).

The reference ships no data, so each domain table is a deterministic function of
a driver table; every rule branch (NULL, blank, bound, duplicate, orphan) occurs
in the result. All derivations are narrow projections of one scan (plus the
25-row ``nation`` for names), so they scale with the driver tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import COMPANY_ADDRESS
from .ingest import ingest_hr_snapshot, ingest_sport_snapshot
from .tables import Tables

# Fixed values of the fixture mapping.
AS_OF_YEAR = 2024
LOAD_TS = datetime(2024, 2, 1)            # load clock of the clean zone / computed_ts
HR_SNAPSHOT_TS = (datetime(2024, 1, 1), datetime(2024, 2, 1))
SPORT_SNAPSHOT_TS = datetime(2024, 2, 1)
COMMUTE_MODES_BY_MOD10 = ("Marche", "Running", "Vélo", "velo electrique", "Trottinette",
                          "Voiture", "course a pied", "  ", "Marche/running", None)
# Parameter versions (name, text, type, from, to): each changes within 2024, the rate within 2023, too.
PARAMETER_VERSIONS = (
    ("prime_rate", "0.04", "float", datetime(2022, 1, 1), datetime(2023, 7, 1)),
    ("prime_rate", "0.055", "float", datetime(2023, 7, 1), datetime(2024, 3, 1)),
    ("prime_rate", " 0.06 ", "float", datetime(2024, 3, 1), None),
    ("min_activities_year", "2", "int", datetime(2022, 1, 1), datetime(2024, 1, 1)),
    ("min_activities_year", "3", "int", datetime(2024, 1, 1), None),
    ("max_wellbeing_days", "4", "int", datetime(2023, 1, 1), datetime(2024, 6, 1)),
    ("max_wellbeing_days", "6", "int", datetime(2024, 6, 1), None),
)
FACT_YEARS = (2021, 2022, 2023, 2024)     # no version is valid in 2021: the defaults are
SPORT_PROFILE_BY_MOD4 = ("Running", "Natation", None, "Tennis")
SPORT_TYPE_BY_EVENT = {"click": "Running", "view": "walking", "purchase": "CYCLING",
                       "error": "yoga"}
OTHER_SPORT_TYPE = "swimming"
ORPHAN_OFFSET = 1_000_000
UNKNOWN_SURVEY_OFFSET = 50_000_000_000


def memo(fn):
    """Reuse the lazy DataFrame built for the same tables and arguments."""
    def wrapper(t: Tables, *args, **kwargs):
        key = (fn.__name__, args, tuple(sorted(kwargs.items())))
        if key not in t.memo:
            t.memo[key] = fn(t, *args, **kwargs)
        return t.memo[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def _pick(key: Column, modulus: int, values) -> Column:
    """``values[key % modulus]`` as a CASE expression (NULL entries stay NULL)."""
    m = key % modulus
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(m == i, lit) if expr is None else expr.when(m == i, lit)
    return expr


@memo
def _customers(t: Tables) -> DataFrame:
    """customer JOIN nation with the columns used here (nation is broadcast if its size allows)."""
    cust = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return cust.join(nat, "c_nationkey", "inner")


def _home_address(k: Column) -> Column:
    return (F.when(k % 13 == 0, F.lit(None).cast("string"))
            .when(k % 13 == 1, F.lit(""))
            .otherwise(F.concat(F.col("n_name"), F.lit(" "), F.col("c_mktsegment"))))


@memo
def employees(t: Tables) -> DataFrame:
    """B.1 ``clean.employees`` shape (14 columns)."""
    k = F.col("c_custkey")
    is_active = (F.when(k % 11 == 0, F.lit(False)).when(k % 11 == 1, F.lit(None).cast("boolean"))
                 .otherwise(F.lit(True)))
    return _customers(t).select(
        k.alias("employee_id"),
        F.col("c_name").alias("last_name"),
        F.col("n_name").alias("first_name"),
        F.make_date(F.lit(1960) + (k % 40).cast("int"), F.lit(5), F.lit(12)).alias("birth_date"),
        F.col("c_mktsegment").alias("bu"),
        F.make_date(F.lit(2015), F.lit(1), F.lit(15)).alias("hire_date"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).cast("decimal(12,2)").alias("gross_salary"),
        F.lit("CDI").alias("contract_type"),
        F.lit(25).alias("paid_leave_days"),
        _home_address(k).alias("home_address"),
        _pick(k, 10, COMMUTE_MODES_BY_MOD10).alias("commute_mode"),
        _pick(k, 4, SPORT_PROFILE_BY_MOD4).alias("sport_profile"),
        is_active.alias("is_active"),
        F.make_timestamp_ntz(F.lit(LOAD_TS.year), F.lit(LOAD_TS.month), F.lit(LOAD_TS.day),
                             F.lit(0), F.lit(0), F.lit(0)).alias("updated_ts"),
    )


def _sport_type() -> Column:
    e = F.col("event_type")
    expr = None
    for ev, sport in SPORT_TYPE_BY_EVENT.items():
        expr = F.when(e == ev, F.lit(sport)) if expr is None else expr.when(e == ev, F.lit(sport))
    return expr.otherwise(F.lit(OTHER_SPORT_TYPE))


@memo
def activities(t: Tables) -> DataFrame:
    """B.2 ``clean.activities`` from ``events`` (start shifted back 0/200/400 days)."""
    eid = F.col("event_id")
    elapsed = (F.lit(600) + eid % 6600).cast("int")
    start = F.col("ts") - F.make_dt_interval((eid % 3).cast("int") * 200, F.lit(0), F.lit(0), F.lit(0))
    return t.events.select(
        eid.alias("activity_id"),
        F.col("user_id").alias("employee_id"),
        start.alias("start_ts"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), elapsed)).alias("end_ts"),
        _sport_type().alias("sport_type"),
        F.when(eid % 20 == 0, F.lit(None).cast("int"))
         .otherwise(F.floor(F.col("value") * 100).cast("int")).alias("distance_m"),
        elapsed.alias("elapsed_s"),
        F.lit(None).cast("string").alias("comment_text"),
    )


@memo
def commute_checks(t: Tables) -> DataFrame:
    """B.3 ``raw.commute_distance_checks`` from ``orders`` (exact decimal distances)."""
    ok = F.col("o_orderkey")
    dist = (F.floor(F.col("o_totalprice") / 10).cast("decimal(8,0)") * F.lit(0.001).cast("decimal(3,3)"))
    return t.orders.select(
        ok.alias("check_id"),
        F.col("o_orderdate").alias("computed_ts"),
        F.col("o_custkey").alias("employee_id"),
        F.concat(F.lit("address of "), F.col("o_custkey").cast("string")).alias("home_address"),
        F.lit(COMPANY_ADDRESS).alias("company_address"),
        _pick(F.col("o_custkey"), 10, COMMUTE_MODES_BY_MOD10).alias("commute_mode"),
        F.when(ok % 17 == 0, F.lit(None).cast("decimal(8,3)")).otherwise(dist.cast("decimal(8,3)"))
         .alias("distance_km"),
        F.lit(None).cast("int").alias("duration_s"),
        F.lit("FIXTURE").alias("api_provider"),
        F.lit("OK").alias("api_status"),
        F.lit(None).cast("boolean").alias("is_within_rule"),
        F.lit(None).cast("string").alias("rule_name"),
        F.lit(None).cast("string").alias("anomaly_reason"),
    )


def parameter_versions(t: Tables) -> DataFrame:
    """The versions above as a parameter table."""
    from .. import schemas
    rows = [(n, v, kind, None, None, since, until) for n, v, kind, since, until in PARAMETER_VERSIONS]
    return t.spark.createDataFrame(rows, schemas.CONFIG_PARAMETERS)


@memo
def hr_sheet(t: Tables, only_mod5: bool = False) -> DataFrame:
    """B.4 HR spreadsheet contents with its original (French) headers, all text."""
    k = F.col("c_custkey")
    ks = k.cast("string")
    m50 = k % 50
    emp_id = (F.when(m50 == 0, F.concat(F.lit("X"), ks))
              .when(m50 == 1, F.concat(ks, F.lit(".0")))
              .when(m50 == 2, F.concat(F.lit(" "), ks, F.lit(" ")))
              .when(m50 == 3, F.lit("NaN"))
              .when(m50 == 4, F.lit(None).cast("string"))
              .otherwise(ks))
    salary = F.when(k % 9 == 0, F.lit("n/a")).otherwise(
        F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    birth = (F.when(k % 8 == 0, F.lit("31/12/1990")).when(k % 8 == 1, F.lit("n/a"))
             .otherwise(F.concat(F.lit("19"), (F.lit(60) + k % 40).cast("string"),
                                 F.lit("-05-12 00:00:00"))))
    leave = F.when(k % 7 == 0, F.lit("25.5")).when(k % 7 == 1, F.lit("abc")).otherwise(F.lit("25"))
    src = _customers(t)
    if only_mod5:
        src = src.where(k % 5 == 0)
    return src.select(
        emp_id.alias("ID salarié"),
        F.col("c_name").alias("Nom"),
        F.col("n_name").alias("Prénom"),
        birth.alias("Date de naissance"),
        F.col("c_mktsegment").alias("BU"),
        F.lit("2015-01-15 00:00:00").alias("Date d'embauche"),
        salary.alias("Salaire brut"),
        F.lit("CDI").alias("Type de contrat"),
        leave.alias("Nombre de jours de CP"),
        _home_address(k).alias("Adresse du domicile"),
        _pick(k, 10, COMMUTE_MODES_BY_MOD10).alias("Moyen de déplacement"),
    )


@memo
def hr_raw(t: Tables) -> DataFrame:
    """B.4 raw HR history: an early partial load and a later full load."""
    first = ingest_hr_snapshot(hr_sheet(t, only_mod5=True), HR_SNAPSHOT_TS[0])
    second = ingest_hr_snapshot(hr_sheet(t), HR_SNAPSHOT_TS[1])
    return first.unionByName(second)


@memo
def sport_sheet(t: Tables) -> DataFrame:
    """B.5 sport survey contents with original headers: every customer answers, every sixth
    under an id that no employee has."""
    k = F.col("c_custkey")
    m50 = k % 50
    emp_id = (F.when(k % 6 == 0, (k + UNKNOWN_SURVEY_OFFSET).cast("string"))
              .when(m50 == 1, F.concat(k.cast("string"), F.lit(".0")))
              .when(m50 == 5, F.lit("inconnu"))
              .otherwise(k.cast("string")))
    return (t.customer.select("c_custkey")
            .select(emp_id.alias("ID salarié"),
                    _pick(k, 4, SPORT_PROFILE_BY_MOD4).alias("Pratique d'un sport")))


@memo
def sport_raw(t: Tables) -> DataFrame:
    """B.5 raw sport survey, one load."""
    return ingest_sport_snapshot(sport_sheet(t), SPORT_SNAPSHOT_TS)


# ---------------------------------------------------------------------------
# B.6 dirty variants for the quality gate
# ---------------------------------------------------------------------------
@memo
def dirty_employees(t: Tables) -> DataFrame:
    e = employees(t)
    k = F.col("employee_id")
    dirty = {
        "employee_id": F.when(k % 60 == 59, F.lit(None).cast("bigint")).when(k % 60 == 58, k - 1)
                        .otherwise(k),
        "last_name": F.when(k % 41 == 0, F.lit(None).cast("string")).otherwise(F.col("last_name")),
        "gross_salary": F.when(k % 23 == 0, F.lit(None).cast("decimal(12,2)"))
                         .otherwise(F.col("gross_salary")),
    }
    return e.select(*[dirty.get(c, F.col(c)).alias(c) for c in e.columns])


@memo
def dirty_activities(t: Tables) -> DataFrame:
    a = activities(t)
    i = F.col("activity_id")
    start = F.when(i % 67 == 0, F.lit(None).cast(a.schema["start_ts"].dataType)).otherwise(F.col("start_ts"))
    end = (F.when(i % 71 == 0, F.lit(None).cast(a.schema["end_ts"].dataType))
           .when(i % 89 == 0, F.col("start_ts") - F.make_dt_interval(F.lit(0), F.lit(1), F.lit(0), F.lit(0)))
           .otherwise(F.col("end_ts")))
    emp = (F.when(i % 61 == 0, F.lit(None).cast("bigint"))
           .when(i % 83 == 0, F.col("employee_id") + ORPHAN_OFFSET)
           .otherwise(F.col("employee_id")))
    return a.select(
        F.when(i % 53 == 0, F.lit(None).cast("bigint")).when(i % 59 == 1, i - 1).otherwise(i)
         .alias("activity_id"),
        emp.alias("employee_id"),
        start.alias("start_ts"),
        end.alias("end_ts"),
        "sport_type",
        F.when(i % 73 == 0, F.lit(-1)).otherwise(F.col("distance_m")).alias("distance_m"),
        F.when(i % 97 == 0, F.lit(-1)).otherwise(F.col("elapsed_s")).alias("elapsed_s"),
        "comment_text",
    )


@memo
def dirty_commute_checks(t: Tables) -> DataFrame:
    c = commute_checks(t)
    i = F.col("check_id")
    cols = []
    for name in c.columns:
        if name == "employee_id":
            cols.append(F.when(i % 101 == 0, F.lit(None).cast("bigint")).otherwise(F.col(name)).alias(name))
        elif name == "distance_km":
            cols.append(F.when(i % 103 == 0, F.lit(-1).cast("decimal(8,3)")).otherwise(F.col(name)).alias(name))
        else:
            cols.append(F.col(name))
    return c.select(*cols)
