"""Business-rule values and the Column predicates built on them.

The lists below are FIXED VALUES: they must equal the business rules being
reproduced, word for word (including accents), for results to match.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# A commute mode is "sporty" when its lower-cased text contains any of these.
SPORTY_COMMUTE_SUBSTRINGS = ("marche", "running", "course", "vélo", "velo", "trottinette")
# Sport types (lower-cased) that count as a valid sport activity.
VALID_SPORT_TYPES = ("running", "walking", "cycling", "hiking", "swimming")
# Commute-distance rule: modes (exact, lower-cased) held to the walking/running limit.
WALK_RUN_MODES = ("marche", "walk", "running", "course", "course a pied")
# Default limits and rates (same values as the seeded configuration).
DEFAULT_WALK_RUN_MAX_KM = 15
DEFAULT_BIKE_SCOOTER_MAX_KM = 25
DEFAULT_PRIME_RATE = "0.05"
DEFAULT_MIN_ACTIVITIES_YEAR = 15
DEFAULT_WELLNESS_DAYS = 5
DEFAULT_MIN_ACTIVITIES_ROWS = 2000
COMPANY_ADDRESS = "1362 Av. des Platanes, 34970 Lattes"
# Trace texts written next to every benefit row.
RULE_PRIME_TEXT = "R1+R2+R3: commute_mode sportif => 5% salaire brut annuel, actif requis"
RULE_WELLNESS_TEXT = "R4+R5+R6+R7: >=15 activités sportives valides/an => 5 jours, actif requis"


def rule_prime_text(rate) -> str:
    """The bonus trace with the rate that was applied."""
    return RULE_PRIME_TEXT.replace("5%", f"{(Decimal(rate) * 100).normalize():f}%")


def rule_wellness_text(minimum: int, days: int) -> str:
    """The wellness trace with the minimum and the days that were applied."""
    return RULE_WELLNESS_TEXT.replace(">=15", f">={minimum}").replace("5 jours", f"{days} jours")


# Commute-check verdict texts.
COMMUTE_RULE_NAME = "MAX_COMMUTE_DISTANCE_BY_MODE"
COMMUTE_ANOMALY_REASON = "Distance incohérente par rapport au mode de transport"
# Eligibility labels.
ELIGIBLE = "ELIGIBLE"
NON_ELIGIBLE = "NON_ELIGIBLE"
# Plausibility bands of simulated activities: sport -> (min_m, max_m); others use the default.
DISTANCE_BANDS_M = {"walking": (1000, 12000), "running": (1500, 25000)}
DEFAULT_DISTANCE_BAND_M = (2000, 60000)
DURATION_BAND_S = (600, 7200)
ACTIVITIES_PER_EMPLOYEE = (5, 30)
ACTIVITY_LOOKBACK_DAYS = 365
# Mock commute checks (FAIL -> PASS demonstration).
MOCK_SEED_ROWS = 15
MOCK_DISTANCE_BY_ID_MOD3 = {0: "50.000", 1: "10.000"}  # any other remainder: 20.000
MOCK_DISTANCE_OTHER = "20.000"
MOCK_REPAIR_WALK_RUN_KM = "12.000"
MOCK_REPAIR_OTHER_KM = "22.000"


# ---------------------------------------------------------------------------
# Predicates
# ---------------------------------------------------------------------------
def commute_eligible(mode: Column) -> Column:
    """A non-blank mode containing a sporty word; NULL or blank is false.

    ``btrim`` strips spaces only (as in SQL); accents are matched as written.
    """
    low = F.lower(mode)
    sporty = reduce(lambda a, b: a | b, [low.contains(w) for w in SPORTY_COMMUTE_SUBSTRINGS])
    return F.coalesce((F.btrim(mode) != F.lit("")) & sporty, F.lit(False))


def is_walk_run_mode(mode: Column) -> Column:
    """Exact (lower-cased) membership in the walking/running list; NULL stays NULL."""
    return F.lower(mode).isin(*WALK_RUN_MODES)


def commute_limit_km(mode: Column, walk_run_km=DEFAULT_WALK_RUN_MAX_KM,
                     other_km=DEFAULT_BIKE_SCOOTER_MAX_KM) -> Column:
    """Maximum plausible commute for the mode; a NULL mode has no limit (NULL)."""
    walk = is_walk_run_mode(mode)
    return F.when(walk, F.lit(walk_run_km)).when(~walk, F.lit(other_km))


def commute_anomaly(mode: Column, distance_km: Column, walk_run_km=DEFAULT_WALK_RUN_MAX_KM,
                    other_km=DEFAULT_BIKE_SCOOTER_MAX_KM) -> Column:
    """K1 predicate: the distance is strictly above the mode's limit.

    Three-valued like SQL: a NULL distance or a NULL mode yields NULL, which
    ``filter`` treats as "not an anomaly"; exactly 15.000 / 25.000 pass.
    """
    return distance_km > commute_limit_km(mode, walk_run_km, other_km)


def valid_sport_activity(sport_type: Column, distance_m: Column, elapsed_s: Column) -> Column:
    """Positive distance and duration (NULL counts as 0) and a listed sport."""
    return ((F.coalesce(distance_m, F.lit(0)) > 0)
            & (F.coalesce(elapsed_s, F.lit(0)) > 0)
            & F.lower(F.coalesce(sport_type, F.lit(""))).isin(*VALID_SPORT_TYPES))


# ---------------------------------------------------------------------------
# Time bounds
# ---------------------------------------------------------------------------
def year_bounds(as_of_year: int) -> tuple[datetime, datetime]:
    """Half-open [1 Jan as_of_year, 1 Jan as_of_year+1)."""
    return datetime(as_of_year, 1, 1), datetime(as_of_year + 1, 1, 1)


def ts_literal(value: datetime, like: T.DataType | None = None) -> Column:
    """A timestamp literal of the same flavour as the column it is compared with.

    ``timestamp_ntz`` columns get an NTZ literal, so the comparison never depends
    on the session time zone; zoned columns get a zoned literal read in UTC.
    """
    parts = [F.lit(v) for v in (value.year, value.month, value.day, value.hour, value.minute)]
    sec = F.lit(value.second)
    if like is None or isinstance(like, T.TimestampNTZType):
        return F.make_timestamp_ntz(*parts, sec)
    return F.make_timestamp(*parts, sec, F.lit("UTC"))
