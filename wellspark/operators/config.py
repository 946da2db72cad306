"""Business parameters (P1, P2): typed key/value rows with a validity interval, at one time or by date.

The parameter table is tiny and bounded by its primary key (one row per known
name), so reading it into a small Python object on the driver is safe; the
values then become literals that Catalyst folds into the plans.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules
from ..functions.rules import ts_literal

# The seeded parameters (name, value text, type, unit, description).
SEED_PARAMETERS = [
    ("prime_rate", "0.05", "float", "ratio", "Prime sportive"),
    ("min_activities_year", "15", "int", "count", "Min activités/an"),
    ("max_wellbeing_days", "5", "int", "days", "Plafond jours bien-être"),
    ("max_distance_walk_run_km", "15", "int", "km", "Max marche/running"),
    ("max_distance_bike_scooter_km", "25", "int", "km", "Max vélo/trottinette"),
    ("company_address", "1362 Av. des Platanes, 34970 Lattes", "text", None, "Adresse entreprise"),
]
PARAM_TYPES = ("int", "float", "bool", "text")


def config_parameters(spark: SparkSession, effective_from: datetime) -> DataFrame:
    """The seeded parameter rows, open-ended from ``effective_from``."""
    rows = [(n, v, t, u, d, effective_from, None) for n, v, t, u, d in SEED_PARAMETERS]
    return spark.createDataFrame(rows, schemas.CONFIG_PARAMETERS)


def config_typed(config: DataFrame, as_of: datetime) -> DataFrame:
    """Versions valid at ``as_of`` ([from, to), open end = NULL), typed by ``param_type``."""
    t = F.col("param_type")
    v = F.trim(F.col("param_value_text"))
    at = ts_literal(as_of, config.schema["effective_from"].dataType)
    valid = (F.col("effective_from") <= at) & (F.col("effective_to").isNull() | (at < F.col("effective_to")))
    return config.where(valid).select(
        "param_name", "param_type", "unit",
        F.when(t == "int", v.try_cast("bigint")).alias("value_int"),
        F.when(t == "float", v.try_cast("decimal(18,6)")).alias("value_decimal"),
        F.when(t == "bool", v.try_cast("boolean")).alias("value_bool"),
        F.when(t == "text", F.col("param_value_text")).alias("value_text"),
    )


@dataclass(frozen=True)
class Params:
    """Parameter values used by the rules; defaults equal the seeded configuration."""
    prime_rate: Decimal = Decimal(rules.DEFAULT_PRIME_RATE)
    min_activities_year: int = rules.DEFAULT_MIN_ACTIVITIES_YEAR
    max_wellbeing_days: int = rules.DEFAULT_WELLNESS_DAYS
    max_distance_walk_run_km: int = rules.DEFAULT_WALK_RUN_MAX_KM
    max_distance_bike_scooter_km: int = rules.DEFAULT_BIKE_SCOOTER_MAX_KM
    company_address: str = rules.COMPANY_ADDRESS
    min_activities_rows: int = rules.DEFAULT_MIN_ACTIVITIES_ROWS


def load_params(typed: DataFrame) -> Params:
    """Read the typed parameter rows (at most one per known name) into ``Params``."""
    known = [f for f in Params.__dataclass_fields__]
    mine = typed.where(F.col("param_name").isin(*known))
    # At most one name per field of Params, whatever the size of the table.
    repeated = mine.groupBy("param_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").collect()
    if repeated:
        raise ValueError(f"more than one valid version of {sorted(r.param_name for r in repeated)}")
    values: dict = {}
    for r in mine.collect():
        if all(v is None for v in (r.value_int, r.value_decimal, r.value_bool, r.value_text)):
            raise ValueError(f"parameter {r.param_name} has no value of its type ({r.param_type})")
        if r.value_int is not None:
            values[r.param_name] = int(r.value_int)
        elif r.value_decimal is not None:
            values[r.param_name] = Decimal(r.value_decimal).normalize()
        elif r.value_bool is not None:
            values[r.param_name] = bool(r.value_bool)
        elif r.value_text is not None:
            values[r.param_name] = r.value_text
    return Params(**values)


# ---------------------------------------------------------------------------
# Parameters by date: every fact under the version that was valid at its time
# ---------------------------------------------------------------------------
_SQL_TYPES = {"prime_rate": "decimal(18,6)", "company_address": "string"}


def _default(name: str):
    value = getattr(Params(), name)
    return F.lit(value).cast(_SQL_TYPES.get(name, "int"))


def with_params_at(facts: DataFrame, at: Column, config: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """As-of join: ``facts`` plus, per name, the value of the version valid at ``at``.

    Versions are few (a parameter changes now and then), facts are many: the versions
    become one row of arrays, read once as a scalar subquery, and every fact looks its
    own up -- no shuffle, no nested-loop join, whatever the number of facts. A version
    holds in [effective_from, effective_to), an open end is NULL. Without a valid version
    (or ``at``) the default holds; two valid versions, or a text that is not of its
    type, stop the query.
    """
    value = F.coalesce(F.col("param_value_text"), F.lit(""))
    every = {}
    for n in names:
        typed = value if _SQL_TYPES.get(n) == "string" else F.trim(value).try_cast(_SQL_TYPES.get(n, "int"))
        version = F.struct("effective_from", "effective_to", typed.alias("value"))
        every[n] = F.collect_list(F.when(F.col("param_name") == n, version))
    table = config.agg(F.struct(*[c.alias(n) for n, c in every.items()]).alias("versions")).scalar()
    out = facts.withColumn("__at", at.cast(config.schema["effective_from"].dataType)).withColumn("__versions", table)
    for n in names:
        valid = F.filter(F.col(f"__versions.{n}"), lambda v: (v.effective_from <= F.col("__at"))
                         & (v.effective_to.isNull() | (F.col("__at") < v.effective_to)))
        found = F.get(valid, F.lit(0))
        out = out.withColumn(n, F.when(F.size(valid) > 1, F.raise_error(F.lit(f"more than one valid version of {n}")))
                             .when(F.size(valid) < 1, _default(n))
                             .when(found["value"].isNull(), F.raise_error(F.lit(f"parameter {n} has no value of its type")))
                             .otherwise(found["value"]))
    return out.drop("__at", "__versions")


def end_of_year(year: Column) -> Column:
    """The last instant of a calendar year: what a year earns is settled by the parameters valid then."""
    return F.make_timestamp_ntz(year, F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59.999999))


def with_params_of_year(facts: DataFrame, config: DataFrame, names: tuple[str, ...], year: str = "year") -> DataFrame:
    """``with_params_at`` the end of each fact's year."""
    return with_params_at(facts, end_of_year(F.col(year)), config, names)
