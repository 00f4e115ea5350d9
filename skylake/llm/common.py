"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skylake.session import settle

# A table is broadcast only below both bounds; above them the join is shuffled.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle_counted(df: DataFrame, label: str, **totals: Column) -> tuple[DataFrame, dict[str, int]]:
    """Write `df` to the shared folder; the written table and its row count `n` and `totals`, counted in
    the same job. A task that runs twice can only raise counts, so they serve as bounds, not as results."""
    seen = Observation()
    wanted = [F.count(F.lit(1)).alias("n"), *(c.alias(k) for k, c in totals.items())]
    table = settle(df.observe(seen, *wanted), label)
    return table, {k: v or 0 for k, v in seen.get.items()}


def bounded(df: DataFrame, label: str, width: Column | None = None) -> DataFrame:
    """Write `df` and mark it for broadcast if it is within the bounds; `width` is a row's bytes where it
    has long fields. Beyond the bounds the table is returned as it is, for a shuffled join."""
    size = F.lit(64) if width is None else F.coalesce(width, F.lit(0)) + 64
    table, seen = settle_counted(df, label, bytes=F.sum(size.cast("bigint")))
    return F.broadcast(table) if seen["n"] <= BROADCAST_ROWS and seen["bytes"] <= BROADCAST_BYTES else table


def packed(df: DataFrame) -> Column:
    """A row as one column `__row`, so that columns put beside it cannot clash with any of its own; `__row.*` unpacks it."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__row")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two columns `__id`, `__th` that tell rows apart by id and text, null ids included; only rows
    that are equal in both share them."""
    return [F.coalesce(F.col(id_col), F.lit(0)).alias("__id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("__th")]
