"""Column helpers: parsing, rounding, calendar arithmetic, classes.

Dates are zone-free timestamps throughout, so results do not depend on the session's time zone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names from no purchase to high intensity; a class's code is its position.
INTENSITY_CLASSES = ["sin_compra", "baja", "media", "alta"]
# Smallest number of purchases for alta, media and baja.
LOCAL_THRESHOLDS = (4, 2, 1)
CLOUD_THRESHOLDS = (5, 3, 1)
# Right-closed score limits of the four classes.
SCORE_EDGES = [-0.5, 0.5, 1.5, 2.5, 3.5]
# Categories that are written in more than one way.
CATEGORY_NAMES = {
    "COMIDAS": "COMIDA",
    "DEPORTE": "DEPORTE",
    "DEPORTES": "DEPORTE",
    "LICORES Y CIGARRILLOS": "LICORES",
    "SALUD Y BELLEZA": "SALUD_BELLEZA",
}
DAYS_PER_YEAR = 365
#: Doubles below this have at most 26 digits before the point, which leaves 12 of 38 behind it.
DECIMALS_UPTO = 1e26
#: Doubles from here on have no decimals.
WHOLE_FROM = 2.0**53


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_timestamp(value: Column | str) -> Column:
    """Timestamp of a text; null where it does not parse."""
    return as_column(value).try_cast("timestamp_ntz")


def parse_number(value: Column | str) -> Column:
    """Number of a text; null where it does not parse."""
    return as_column(value).try_cast("double")


def round_even(value: Column | str, digits: int = 2) -> Column:
    """Round half to even at ``digits`` decimals; never returns negative zero.

    A number too large to have decimals stays as it is.
    """
    scale = float(10**digits)
    value = as_column(value).cast("double")
    return F.when(F.abs(value) < WHOLE_FROM, F.rint(value * scale) / scale).otherwise(value) + 0.0


def decimal_part(value: Column) -> Column:
    """A double as a decimal with 12 digits; null for NaN, infinities and what is too large."""
    return value.cast("double").try_cast("decimal(38,12)")


def odd_part(value: Column) -> Column:
    """What :func:`decimal_part` cannot hold; null for all other values."""
    value = value.cast("double")
    return F.when(~(F.abs(value) < DECIMALS_UPTO), value)


def whole_sum(decimals: Column, odd: Column) -> Column:
    """A double from the sum of the decimal parts and the sum of the others, null where both are."""
    return F.when(odd.isNull(), decimals.cast("double")).otherwise(odd + F.coalesce(decimals.cast("double"), F.lit(0.0)))


def exact_sum(value: Column) -> Column:
    """Sum of doubles; null without values.

    Values are added as decimals with 12 digits, which no order of addition changes. NaN, infinities and values from
    1e26 on do not fit and are added as doubles, so a NaN makes the sum NaN and a huge value counts in full.
    """
    return whole_sum(F.sum(decimal_part(value)), F.sum(odd_part(value)))


def steady(value: Column | str) -> Column:
    """Six decimals of a sum or mean."""
    return round_even(value, 6)


def total(value: Column | str, condition: Column | None = None) -> Column:
    """Sum of the rows where ``condition`` holds; 0 if there are none."""
    value = as_column(value)
    picked = value if condition is None else F.when(condition, value)
    return steady(F.coalesce(exact_sum(picked), F.lit(0.0)))


def mean(value: Column | str) -> Column:
    """Mean of the non-null values, from a sum that does not depend on the order of addition."""
    value = as_column(value).cast("double")
    return F.try_divide(steady(exact_sum(value)), F.count(value))


def occurrences(value: Column | str, condition: Column | None = None) -> Column:
    """Number of non-null values where ``condition`` holds."""
    value = as_column(value)
    return F.count(value if condition is None else F.when(condition, value))


def positive_part(value: Column | str) -> Column:
    value = as_column(value)
    return F.when(value > 0, value).otherwise(F.lit(0.0))


def negative_part(value: Column | str) -> Column:
    """Size of the negative values, 0 for the others."""
    value = as_column(value)
    return F.when(value < 0, -value).otherwise(F.lit(0.0))


def log10_plus_one(value: Column | str) -> Column:
    """``log10(x + 1)``; null where the argument is not positive."""
    shifted = as_column(value) + 1
    return F.when(shifted > 0, F.log10(shifted))


def months_before(value: Column | str, months: int) -> Column:
    """Calendar months back, clipped to the month's last day; keeps the time of day."""
    value = as_column(value)
    return value if months == 0 else value - F.make_ym_interval(F.lit(0), F.lit(months))


def month_key(value: Column | str) -> Column:
    """``yyyy-MM`` of a timestamp."""
    return F.date_format(as_column(value).cast("date"), "yyyy-MM")


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Full days between two timestamps, rounded down."""
    later, earlier = as_column(later), as_column(earlier)
    days = F.datediff(later, earlier)
    overshoots = earlier + F.make_dt_interval(days) > later
    return (days - F.when(overshoots, 1).otherwise(0)).cast("long")


def age_in_years(at: Column | str, born: Column | str) -> Column:
    """Age in years of 365 days, rounded down."""
    return F.floor(whole_days(at, born) / DAYS_PER_YEAR).cast("long")


def flag(condition: Column) -> Column:
    """Condition with null taken as false."""
    return F.coalesce(condition, F.lit(False))


def indicator(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return flag(condition).cast("int")


def is_negative_sale(kind: str = "tipo_transaccion", value: str = "valor_transaccion", points: str = "puntos") -> Column:
    """Sale booked with a negative amount or negative points."""
    negative = flag(F.col(value) < 0) | flag(F.col(points) < 0)
    return flag(F.col(kind) == "Sale") & negative


def row_total(names: Sequence[str]) -> Column:
    """Sum over columns of one row, nulls as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(n), F.lit(0.0)) for n in names], F.lit(0.0))


def canonical_category(value: Column | str) -> Column:
    """One spelling per category; names that are not listed stay as they are."""
    value = as_column(value)
    known = F.create_map(*[F.lit(x) for pair in CATEGORY_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, value), value)


def intensity_class(count: Column | str, thresholds: Sequence[int] = LOCAL_THRESHOLDS) -> Column:
    """Class of a purchase count: the highest class whose threshold it reaches."""
    count = as_column(count)
    none, low, mid, high = INTENSITY_CLASSES
    at_high, at_mid, at_low = thresholds
    return F.when(count >= at_high, high).when(count >= at_mid, mid).when(count >= at_low, low).otherwise(none)


def class_code(label: Column | str) -> Column:
    """Position of a class; null for an unknown name."""
    names = F.array(*[F.lit(c) for c in INTENSITY_CLASSES])
    position = F.array_position(names, as_column(label)).cast("int")
    return F.when(position > 0, position - 1)


def score_class(score: Column | str, clamp: bool = False) -> Column:
    """Class of a continuous score; null outside the outer limits, or with ``clamp`` the outermost class."""
    score = as_column(score)
    if clamp:
        inside = F.greatest(F.lit(SCORE_EDGES[0] + 0.25), F.least(F.lit(SCORE_EDGES[-1]), score))
        score = F.when(score.isNotNull(), inside)
    picked = F.lit(None).cast("string")
    for name, low, high in reversed(list(zip(INTENSITY_CLASSES, SCORE_EDGES, SCORE_EDGES[1:]))):
        picked = F.when((score > low) & (score <= high), name).otherwise(picked)
    return picked
