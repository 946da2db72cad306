"""Lenient typing of spreadsheet text, done with built-in expressions.

The behaviour mirrors "coerce errors to missing" numeric/date parsing:
anything that is not a plain decimal number becomes NULL instead of failing
the job. Spark's ANSI casts are avoided on purpose: ``cast('123.0' as bigint)``
raises and ``try_cast('NaN' as double)`` is NaN, so the text is first checked
against a number pattern and then parsed as a wide decimal (no 2^53 loss).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted number syntax (optional sign, digits with optional
# fraction or a bare fraction, optional exponent).
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
WIDE_DECIMAL = "decimal(38,10)"
# The accepted date syntax: an ISO day, optionally with a time of day.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?)?$"


def to_number(text: Column) -> Column:
    """Text -> decimal(38,10), or NULL when it is not a number (NaN, inf, '12,5', '')."""
    t = F.trim(text.cast("string"))
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast(WIDE_DECIMAL))


def to_bigint_id(text: Column) -> Column:
    """Numeric id truncated toward zero, NULL when not numeric or out of range."""
    return F.when(to_number(text).isNotNull(), to_number(text).try_cast("bigint"))


def to_money(text: Column, default: int | None = 0) -> Column:
    """Salary text -> decimal(12,2); missing/invalid -> ``default`` (0 by the reference rule).

    A number too large for the column becomes NULL; the job quarantines its row.
    """
    num = to_number(text)
    if default is not None:
        num = F.coalesce(num, F.lit(default).cast(WIDE_DECIMAL))
    return num.try_cast("decimal(12,2)")


def to_int_rounded(text: Column) -> Column:
    """Number stored in an integer column: rounded half away from zero (25.5 -> 26, 24.5 -> 25),
    as a numeric value assigned to an integer column is; a plain cast would truncate."""
    return F.round(to_number(text), 0).try_cast("int")


def to_date_lenient(text: Column) -> Column:
    """'yyyy-mm-dd[ hh:mm:ss]' -> DATE, anything else (e.g. '31/12/1990', '1990-05-12 x') -> NULL.

    The pattern comes first: a cast alone ignores whatever follows the day.
    """
    t = F.trim(text.cast("string"))
    return F.when(t.rlike(DATE_PATTERN), t.try_cast("date"))
