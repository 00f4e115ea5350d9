"""Join an ordered list of texts in groups of fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylake.session import settle

_PLACE_BITS = 33  # of `monotonically_increasing_id`: the row's place in its task


def number_rows(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Add the 1-based position of each row in the order of unique `order` columns.

    Rows are range-partitioned, sorted, numbered inside their range and written in one pass with one
    shuffle; a position is the row's place plus the sizes of the ranges before it, which are added on reading.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    ranges = settle(placed, "ranges").withColumn("__range", F.shiftright("__id", _PLACE_BITS))
    # One row per range: as many rows as shuffle partitions, whatever the data.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
        .select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    )
    place = F.col("__id").bitwiseAND(F.lit(2**_PLACE_BITS - 1).cast("bigint")) + 1
    return (
        ranges.join(F.broadcast(offsets), "__range")
        .withColumn(name, place + F.col("__before"))
        .drop("__range", "__id", "__before")
    )


def join_in_chunks(
    df: DataFrame, value: str, order: list[str], size: int, separator: str = " | ", first: int | None = None
) -> DataFrame:
    """Chunks of `size` consecutive values: columns `chunk` (1, 2, ...) and `entries`.

    `first` keeps the chunks up to that number and must not exceed the number of chunks.
    """
    if size < 1:
        raise ValueError("chunk size must be at least 1")
    numbered = number_rows(df.select(*dict.fromkeys([*order, value])), order).withColumn(
        "chunk", F.floor((F.col("position") - 1) / F.lit(size)) + F.lit(1)
    )
    text = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("position", value))), lambda e: e[value]), separator
    )
    chunks = numbered.groupBy("chunk").agg(text.alias("entries"))
    if first is None:
        return chunks
    if first < 0 or first > (chunks.agg(F.max("chunk")).first()[0] or 0):
        raise ValueError(f"there are fewer than {first} chunks")
    return chunks.where(F.col("chunk") <= first)
