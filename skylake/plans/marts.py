"""Marts: observations joined with their department, plus region averages.

Place names are few and observations many, so names are cleaned and matched once per distinct name:
one pass over three columns finds the names and takes the sums for the averages, the match and the
region averages are worked out on those few rows, and one pass without a shuffle joins them back.
The pass over the names runs when a mart function is called, so `build` writes a mart once and everything else
reads the written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from skylake import schemas
from skylake.functions.text import name_key
from skylake.operators.averages import Average, attach_averages, group_sums
from skylake.operators.fuzzy import near_lookup
from skylake.operators.lookup import fits_in_broadcast, lookup_join, settle_and_measure
from skylake.sources.tables import in_order

REGION_AVERAGES = [
    Average("solarenergy_kwhpm2", 3, "avg_solarenergy_kwhpm2"),
    Average("solarradiation", 3, "avg_solarradiation"),
]


def _names(weather: DataFrame) -> DataFrame:
    """One row per department spelling: its key and the sums of its observations."""
    sums, _ = group_sums(weather, ["department"], [a.source for a in REGION_AVERAGES])
    return sums.withColumn("department_lower", name_key("department"))


def _finish(weather: DataFrame, matched: DataFrame, columns: list[str], regions_fit: bool, order: Sequence[str]) -> DataFrame:
    """Region averages for the matched names (regions come from the dimension, so where that fits a
    broadcast they do), then the observations with everything known of their department.

    A mart that is to be stored in `order` has its observations put in order here: they are fewer and narrower than the
    rows that the join makes of them, and a broadcast join keeps their order (a shuffled one does not, which costs readers some pruning).
    """
    matched = attach_averages(matched, matched, "reg_name", REGION_AVERAGES, regions_fit or None)
    known = matched.withColumnRenamed("geo_shape", "geojson")
    new = [c for c in known.columns if c in columns and c not in weather.columns]
    departments, small = settle_and_measure(known.select("department", *new), "departments")
    return lookup_join(in_order(weather, order) if order else weather, departments, "department", small=small).select(*columns)


def mart_newdata_(weather: DataFrame, depcode: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Observations joined to the dimension on equal name keys, with region averages. `order`: for `store(..., ordered=True)`."""
    small = fits_in_broadcast(depcode)
    matched = lookup_join(_names(weather), depcode, "department_lower", small=small)
    return _finish(weather.withColumnRenamed("snowdepth_filled", "snowdepth"), matched, schemas.MART_COLUMNS, small, order)


def mart_newdata(weather: DataFrame, depcode: DataFrame, best_only: bool = False, order: Sequence[str] = ()) -> DataFrame:
    """Observations joined to every department whose key is at most one edit away.

    `best_only` keeps only the closest departments of a name. `order`: for `store(..., ordered=True)`.
    """
    small = fits_in_broadcast(depcode)
    matched = near_lookup(_names(weather), depcode, "department_lower", "dep_distance", best_only, small)
    return _finish(weather, matched, schemas.FUZZY_MART_COLUMNS, small, order)
