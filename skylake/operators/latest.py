"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first in `newest_first` order.

    The `row_number() = 1` filter is pushed below the shuffle by Spark (a partial group limit), so
    each task sends at most one row per key and a hot key is reduced before it moves.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")
