"""Column expressions shared by the operators; all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import SEASON_MONTHS, SEGMENT_NAMES


def round_half_even(value: Column) -> Column:
    """Round to whole numbers, ties to the even one. Adding zero turns -0.0 into 0.0."""
    return F.rint(value) + F.lit(0.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator, also under ANSI mode."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def zero_if(condition: Column, value: Column) -> Column:
    return F.when(condition, F.lit(0.0)).otherwise(value)


def null_keeping_sum(value: Column) -> Column:
    """Sum that is NULL as soon as one input is NULL."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def null_keeping_avg(value: Column) -> Column:
    """Mean that is NULL as soon as one input is NULL."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.avg(value))


def as_number(text: Column) -> Column:
    """Text to double; NULL where the text is no decimal number.

    The pattern test goes first because a failing cast raises and drops an exception for each value.
    """
    decimal = text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
    return F.when(decimal, text.try_cast("double"))


def normalize_code(code: Column) -> Column:
    """Repair species codes that went through scientific notation (``9.998e+09``); others stay as they are."""
    text = code.cast("string")
    # A substring test first: undamaged codes, nearly all of them, cost no parsing.
    damaged = text.contains("e+") | text.contains("E+")
    digits = as_number(text).try_cast("decimal(20,0)").cast("string")
    return F.when(damaged, F.coalesce(digits, text)).otherwise(text)


def expanded_count(number: Column, splittype: Column, splitlevel: Column) -> Column:
    """Individuals in the whole haul: a subsample counts for splittype^splitlevel of itself."""
    factor = as_number(splittype)
    count = number.cast("double")
    return F.when(factor.isNotNull(), count * F.pow(factor, as_number(splitlevel))).otherwise(count)


# English month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def calendar_date(text: Column) -> Column:
    """Text that spells year, month and day in this order to a date; NULL where there is no such day.

    The parts are digits with any other characters between them, or eight or six digits without any. A year of two digits lies in 1969 to
    2068. The month may be an English name or its first three letters. A time of day may follow.
    """
    value = F.lower(F.trim(text))
    apart = r"^(\d{4}|\d{2})[^0-9a-z]+(\d{1,2}|[a-z]{3,9})[^0-9a-z]+(\d{1,2})([t ].*)?$"
    joined = r"^(\d{4}|\d{2})(\d{2})(\d{2})$"
    year, month, day = (F.regexp_extract(value, apart, i) for i in (1, 2, 3))
    whole = value.rlike(joined)
    year, month, day = (F.when(whole, F.regexp_extract(value, joined, i)).otherwise(part) for i, part in ((1, year), (2, month), (3, day)))
    number = month
    for i, name in enumerate(MONTHS, 1):
        number = F.when((month == name) | (month == name[:3]), F.lit(str(i))).otherwise(number)
    century = F.when(F.length(year) == 4, "").when(year >= "69", "19").otherwise("20")
    spelled = F.concat(century, year, F.lit("-"), F.lpad(number, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"))
    return F.when(value.rlike(apart) | whole, spelled.try_cast("date"))


def season(month: Column) -> Column:
    first, *rest = SEASON_MONTHS.items()
    out = F.when(month.isin(*first[1]), F.lit(first[0]))
    for name, months in rest:
        out = out.when(month.isin(*months), F.lit(name))
    return out


def bay_code(reference: Column) -> Column:
    return F.substring(reference, 1, 2)


def segment_name(code: Column) -> Column:
    """Segment code to name; NULL for an unknown code."""
    pairs = [F.lit(part) for pair in SEGMENT_NAMES.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), code.cast("int"))
