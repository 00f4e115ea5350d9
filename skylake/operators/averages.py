"""Whole-group averages next to every row (a window without order), without a window.

A window would move every row of a group into one task. Here one pass takes map-side partial sums of
all groupings at once, the averages are worked out on those few rows, and they are joined back.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylake.functions.numeric import avg_of_sums, exact_sums, round_half_even
from skylake.operators.lookup import lookup_join, settle_and_measure
from skylake.session import settle


class Average(NamedTuple):
    source: str
    digits: int
    name: str


def group_sums(df: DataFrame, keys: list[str], sources: list[str]) -> tuple[DataFrame, bool]:
    """One row per combination of keys with the exact sums of each source, written once; and whether
    that fits a broadcast."""
    sums = df.groupBy(*keys).agg(*[s for c in sources for s in exact_sums(c, c)])
    return settle_and_measure(sums, "sums")


def group_of(key: str) -> Column:
    """The key as a one-field struct: two such are equal also when both fields are NULL."""
    return F.struct(F.col(key).alias("key"))


def attach_averages(
    df: DataFrame, sums: DataFrame, key: str, averages: list[Average], small: bool | None = None
) -> DataFrame:
    """Add the averages of each row's group; rows with a NULL key form one group."""
    found = sums.groupBy(group_of(key).alias("__group")).agg(
        *[round_half_even(avg_of_sums(a.source), a.digits).alias(a.name) for a in averages]
    )
    return lookup_join(df, found, "__group", "left", key=group_of(key), small=small)


def with_group_averages(df: DataFrame, groupings: dict[str, list[Average]]) -> DataFrame:
    """Add averages for several keys. `df` is computed once and written, then read for the sums and for the rows; both
    jobs run when this is called."""
    df = settle(df, "grouped")
    sources = list(dict.fromkeys(a.source for averages in groupings.values() for a in averages))
    sums, small = group_sums(df, list(groupings), sources)
    # A grouping has at most as many rows as the combinations it is taken from.
    for key, averages in groupings.items():
        df = attach_averages(df, sums, key, averages, small or None)
    return df
