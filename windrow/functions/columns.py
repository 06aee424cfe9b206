"""Column builders. All are built-in expressions, so scans and filters stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters with the Unicode White_Space property (fixed values).
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

#: Months of each season (fixed values).
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}


def code(column: str) -> Column:
    """Category code in upper case without surrounding white space of any kind.

    Trimming a whole set of characters costs several times what trimming blanks does, so it
    is left to codes that still start or end outside printable ASCII after the latter.
    """
    blanks_off = F.trim(F.upper(column))
    last = F.substring(blanks_off, -1, 1)
    plain = _printable(blanks_off) & _printable(last)
    return F.when(plain, blanks_off).otherwise(F.trim(blanks_off, F.lit(WHITESPACE)))


def _printable(text: Column) -> Column:
    """Whether a text starts with a printable ASCII character other than a blank."""
    return (text >= "!") & (text < "\u007f")


def speed_mph(distance: str = "Distance", minutes: str = "AirTime") -> Column:
    """Average speed; null when the air time is zero, where plain ``/`` would raise."""
    return F.try_divide(F.col(distance), F.col(minutes)) * 60


def hour_of(hhmm: str) -> Column:
    """Hour of an ``hhmm`` number, floored; 2400 stays hour 24."""
    return F.floor(F.col(hhmm) / 100).cast("int")


def season(month: Column | str, unknown: str = "Unknown") -> Column:
    """Season of a month number; a month outside 1..12 or null gives ``unknown``."""
    month = F.col(month) if isinstance(month, str) else month
    chosen = None
    for name, months in SEASONS.items():
        rule = month.isin(*months)
        chosen = F.when(rule, name) if chosen is None else chosen.when(rule, name)
    return chosen.otherwise(unknown)


def route(origin: str = "Origin", dest: str = "Dest") -> Column:
    """``Origin-Dest``; null when either end is null."""
    return F.concat(F.col(origin), F.lit("-"), F.col(dest))


def delay_category(delay: str = "ArrDelay") -> Column:
    """Four delay classes; a null delay falls through to the last one."""
    minutes = F.col(delay)
    return (
        F.when(minutes <= 0, "On Time")
        .when(minutes <= 15, "Minor Delay")
        .when(minutes <= 60, "Moderate Delay")
        .otherwise("Severe Delay")
    )


def iso_weekday(date: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(date) + 1


def is_late(threshold: float, delay: str = "ArrDelay") -> Column:
    """Strictly later than ``threshold`` minutes; null for a null delay."""
    return F.col(delay) > threshold


def ratio(total: Column | str, count: Column | str) -> Column:
    """Mean from a sum and a count: null, not an error, over no values."""
    return F.try_divide(total, count)
