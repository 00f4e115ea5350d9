"""The archive of daily marts: month-partitioned Parquet, latest version wins.

Layout: `<root>/extraction_date=D/part=P/yyyymm=M/`. Every load owns its folders (the daily load of a
date, or one micro-batch), so loading it again replaces exactly its own files, costs nothing in
history size and never reads what it overwrites. Readers keep the latest version of each
(dates, department).
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylake import schemas
from skylake.functions.labels import month_key
from skylake.operators.latest import latest_version
from skylake.operators.lookup import settle_and_measure
from skylake.session import settle
from skylake.sources.tables import require_rows

KEYS = ("dates", "department")


def archived_data(history: DataFrame, mart: DataFrame) -> DataFrame:
    """History and the new mart, matched by name: the latest version of each (dates, department) with its month."""
    both = history.unionByName(mart, allowMissingColumns=True)
    return latest(both.withColumn("yyyymm", month_key("dates")))


DAILY = "daily"
OPEN_FILES = 16


@contextmanager
def _files_open(spark: SparkSession):
    """A task keeps up to OPEN_FILES folders open (a load has few months), instead of sorting its whole rows by folder; beyond that
    Spark sorts the rows that are left."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_batch(mart: DataFrame, root: str, extraction_date: str) -> None:
    """Load one day's mart; loading the same day again leaves one copy.

    Rows are written as they come, so a stored mart keeps its order and nothing is shuffled or sorted.
    """
    require_rows(mart, "Data to be archived")
    with _files_open(mart.sparkSession):
        mart.withColumn("yyyymm", month_key("dates")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "static").partitionBy("yyyymm") \
            .parquet(f"{root}/extraction_date={extraction_date}/part={DAILY}")


def append_dated(mart: DataFrame, root: str, part: str) -> None:
    """Load rows that carry their `extraction_date`, as they come; loading the same `part` again leaves one copy."""
    folders = ["extraction_date", "part", "yyyymm"]
    dated = mart.withColumn("part", F.lit(part)).withColumn("yyyymm", month_key("dates"))
    with _files_open(mart.sparkSession):
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(root)


def read_archive(spark: SparkSession, root: str, schema: T.StructType = schemas.ARCHIVED_DATA) -> DataFrame:
    """All versions, with `extraction_date` (date) and `yyyymm` (text) partition columns."""
    partitions = [T.StructField("extraction_date", T.DateType()), T.StructField("part", T.StringType()),
                  T.StructField("yyyymm", T.StringType())]
    return spark.read.schema(T.StructType([*schema.fields, *partitions])).parquet(root).drop("part")


def between_dates(archive: DataFrame, first: str, last: str) -> DataFrame:
    """Rows with first <= dates <= last; only the months in range are read. Filter before `latest`: Spark does not
    move the months' filter below it (`latest_between` does both)."""
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    return archive.where(
        F.col("dates").between(low, high)
        & F.col("yyyymm").between(first[:7].replace("-", ""), last[:7].replace("-", ""))
    )


def latest(archive: DataFrame) -> DataFrame:
    """Latest version of each (dates, department): of the latest extraction the observation with the highest id, and of
    that observation its closest department, the lowest code first.

    The versions are compared on the columns that decide, when this is called; the winners, few where they fit a broadcast, then pick their
    whole rows out of the scan. So no whole row that is not the latest is sorted or moved. More winners than that are compared as whole rows.
    """
    newest = [F.col("extraction_date").desc_nulls_last()] if "extraction_date" in archive.columns else []
    newest += [F.col("record_id").desc_nulls_last(), F.col("dep_distance").asc_nulls_last(), F.col("dep_code").asc_nulls_last()]
    deciding = [*KEYS, *(c for c in ("extraction_date", "record_id", "dep_distance", "dep_code") if c in archive.columns)]
    winners, small = settle_and_measure(latest_version(archive.select(*deciding), KEYS, newest), "latest")
    if small:
        renamed = F.broadcast(winners.toDF(*(f"__{c}" for c in deciding)))
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in deciding))
        archive = archive.join(renamed, same, "left_semi")
    return latest_version(archive, KEYS, newest)


_ROW_BITS, _BLOCK_BITS = 40, 15  # of a row's number in its file; of its number in a block of 32,768, for which one bitmap says what stays


def distinct(archive: DataFrame) -> DataFrame:
    """The different rows of an archive (or of any table that is read from Parquet files), as `DataFrame.distinct` gives them.

    Whole rows are not moved. Two 64-bit hashes of a row, of its columns and of what is null in either order (arrays by type, since a hash of
    many columns is more code than the JVM compiles), and its place, a file and a row number, are shuffled instead, when this is called; of a
    billion rows two different ones share both hashes with a probability of 10^-21. The first place of each row stays, as a bit, and the scan picks
    its rows by the broadcast bits. Bits beyond a broadcast, and tables with nested columns, whose nulls those hashes do not tell apart, are
    compared as whole rows.
    """
    fields = archive.schema.fields
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in fields):
        return archive.distinct()
    rows = archive.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))
    numbered = rows.select("__path").distinct().coalesce(1).withColumn("__file", F.monotonically_increasing_id())
    files = F.broadcast(settle(numbered, "files"))
    # As in a grouping, negative zero is zero.
    same = [F.col(f"`{f.name}`") + F.lit(0).cast(f.dataType) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in fields]
    kinds: dict = {}
    for f, c in zip(fields, same):
        kinds.setdefault(f.dataType, []).append(c)
    told = [F.array(*(c.isNull() for c in same)), *(F.array(*some) for some in kinds.values())]
    back = [*(F.array(*some[::-1]) for some in reversed(kinds.values())), told[0]]
    place = F.shiftleft("__file", _ROW_BITS) + F.col("__row")
    hashed = rows.join(files, "__path").select(F.xxhash64(*told).alias("a"), F.xxhash64(*back).alias("b"), place.alias("place"))
    first = hashed.groupBy("a", "b").agg(F.min("place").alias("place"))
    block = lambda row: F.shiftright(row, _BLOCK_BITS).alias("__block")
    at = lambda row: row.bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int")
    row = F.col("place").bitwiseAND((1 << _ROW_BITS) - 1)
    bits = first.groupBy(F.shiftright("place", _ROW_BITS).alias("__file"), block(row)) \
        .agg(F.bitmap_construct_agg(at(row)).alias("__bits"), F.max(at(row)).alias("__last"))
    bits = bits.withColumn("__bits", F.substring("__bits", F.lit(1), F.shiftright("__last", 3) + 1)).drop("__last")
    kept, small = settle_and_measure(bits.join(files, "__file").drop("__file"), "distinct")
    if not small:
        return archive.distinct()
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(at(F.col("__row")), 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.select("*", block(F.col("__row"))).join(F.broadcast(kept), ["__path", "__block"])
    stays = F.getbit(byte, at(F.col("__row")).bitwiseAND(7)) == 1
    return found.where(stays).select(*(c.alias(f.name) for c, f in zip(same, fields)))


def latest_between(archive: DataFrame, first: str, last: str) -> DataFrame:
    """Latest versions with first <= dates <= last. All versions of a row carry its date, so the months are filtered
    before versions are compared, and only theirs are read."""
    return latest(between_dates(archive, first, last))


def compact(archive: DataFrame, target: str) -> None:
    """Write the latest versions to a new root, sorted; readers switch to it when it is complete. Served queries read this
    table: it has one version per key, so a filter on any column reaches the files."""
    append_dated(by_month(latest(archive)).drop("yyyymm"), target, "compacted")


def by_month(rows: DataFrame) -> DataFrame:
    """One shuffle by month, cut into several parts where a month is large, each sorted. A range partitioning would compute the rows a
    second time to sample them."""
    return rows.hint("rebalance", "yyyymm").sortWithinPartitions("yyyymm", *KEYS)
