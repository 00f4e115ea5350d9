"""Derived labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Moon-phase labels by upper edge of the band, and by exact phase.
BANDS = ((0.25, "waxing crescent"), (0.5, "waxing gibbous"), (0.75, "waning gibbous"))
QUARTERS = ((0.25, "first quarter"), (0.5, "full moon"), (0.75, "last quarter"))
NEW_MOON = "new moon"
LAST_BAND = "waning crescent"

# Dimension names whose observations arrive under another name.
RENAMED = (("CORSE DU SUD", "corse"), ("HAUTE CORSE", "corse0"))


# Weekdays in the order of `dayofweek`.
WEEKDAYS = "Sunday Monday Tuesday Wednesday Thursday Friday Saturday".split()


def moonphase_label(phase: Column | str, strict: bool = False) -> Column:
    """Label of a moon phase in [0, 1].

    By default a band includes its upper edge, so 0.25, 0.5 and 0.75 carry band labels and a
    missing phase falls into the last band. `strict` gives the three edges their quarter labels
    and a missing phase no label.
    """
    c = F.col(phase) if isinstance(phase, str) else phase
    label = F.when(c == 0, NEW_MOON)
    if strict:
        label = label.when(c.isNull(), F.lit(None).cast("string"))
        for value, name in QUARTERS:
            label = label.when(c == value, name)
    for upper, name in BANDS:
        label = label.when(c.between(0, upper), name)
    return label.otherwise(LAST_BAND)


def weekday_name(date: Column | str) -> Column:
    """English name of the weekday, looked up rather than formatted row by row."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(date))


def renamed(name: Column | str) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.coalesce(*[F.when(c == old, new) for old, new in RENAMED], c)


def month_key(date: Column | str) -> Column:
    return F.date_format(date, "yyyyMM")
