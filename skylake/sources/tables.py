"""Writes: Parquet datasets in the lake and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylake.functions.text import dated_file_name, file_date
from skylake.session import settle
from skylake.sources import files, landing, manifest
from skylake.sources.landing import conform


def require_rows(df: DataFrame, what: str = "Data") -> None:
    """Raise on an empty frame; Spark stops at the first row found."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty.")


def require_table(spark: SparkSession, table: str) -> None:
    if not spark.catalog.tableExists(table):
        raise ValueError(f"Table {table} does not exist.")


SORT_KEY = "skylake.sort"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_if_absent(spark: SparkSession, table: str, schema: T.StructType, location: str | None = None,
                     partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Create a table unless it is there. Loads keep the files of a table with `sort_by` sorted, so readers skip
    row groups by these columns; the key is kept as a table property."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        ddl += f" LOCATION {_quoted(location)}"
    if sort_by:
        ddl += f" TBLPROPERTIES ({_quoted(SORT_KEY)} = {_quoted(','.join(sort_by))})"
    spark.sql(ddl)


def sort_key(spark: SparkSession, table: str) -> list[str]:
    """The sort key a table was created with."""
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return [c for c in found.get(SORT_KEY, "").split(",") if c]


def table_names(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The tables and views of a database as rows (name)."""
    source = f" IN {database}" if database else ""
    return spark.sql(f"SHOW TABLES{source}").select(F.col("tableName").alias("name"))


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(r.name for r in table_names(spark, database).collect())


def run_query(spark: SparkSession, text: str, args: dict | list | None = None, **views: DataFrame) -> DataFrame:
    """SQL text over registered views; values go in as `args`, frames as `{name}`."""
    return spark.sql(text, args=args, **views)


def load_table(df: DataFrame, table: str, refresh: bool = False) -> None:
    """Append to a table, or replace all its rows, in whatever partition, when `refresh`; columns are matched by
    name, files are sorted by the table's key."""
    spark = df.sparkSession
    require_rows(df, "Data to be loaded")
    require_table(spark, table)
    _insert(df, table, refresh)


@contextmanager
def _whole_overwrite(spark: SparkSession):
    """An overwrite replaces the table, also where the session is set to replace single partitions."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "static")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _insert(df: DataFrame, table: str, refresh: bool = False) -> None:
    spark = df.sparkSession
    rows = conform(df, spark.table(table).schema)
    key = sort_key(spark, table)
    if key:
        rows = rows.hint("rebalance", key[0]).sortWithinPartitions(*key)
    with _whole_overwrite(spark):
        rows.write.insertInto(table, overwrite=refresh)


def merge_daily_data(spark: SparkSession, table: str, target: str, key: str = "id") -> None:
    """Append the rows of `table` to `target` by column name, those left out whose `key` is there already, so that a
    repeated merge changes nothing. Of the target only the key column is read. An empty source is an error."""
    daily = spark.table(table)
    require_rows(daily, f"Data from Table {table} to be appended")
    require_table(spark, target)
    known = spark.table(target).select(F.col(key).alias("__known")).distinct()
    # Written first: Spark does not overwrite or append to what a plan reads.
    _insert(settle(daily.join(known, F.col(key).eqNullSafe(F.col("__known")), "left_anti"), "merged"), target)


def store_extraction(df: DataFrame, root: str, extraction_date: str) -> None:
    """One extraction in the lake: its own dated folder, replaced when the day is run again."""
    require_rows(df)
    _sized(df).write.mode("overwrite").parquet(f"{root}/extraction_date={extraction_date}")


def store_snapshot(df: DataFrame, path: str) -> None:
    """Replace the staging snapshot of the day."""
    require_rows(df)
    _sized(df).write.mode("overwrite").parquet(path)


def _sized(df: DataFrame) -> DataFrame:
    """Let Spark choose the number of files from the data size, splitting large partitions."""
    return df.hint("rebalance")


class Compaction(NamedTuple):
    """Landed documents that were stored, and those set aside."""

    good: int
    rejected: int


def rejects_path(raw_root: str, extraction_date: str) -> str:
    """Where a compaction sets documents aside, next to the raw root and not in it."""
    return f"{raw_root.rstrip('/')}-rejects/extraction_date={extraction_date}"


def compact_envelopes(spark: SparkSession, source: str, raw_root: str, staging: str, extraction_date: str,
                      suffix: str | None = ".jsonl", delete_source: bool = False) -> Compaction:
    """Landed JSON lines to Parquet: bad lines to their own folder, the dated raw folder, then the staging snapshot
    from it; every line is parsed once and is in one of the two.

    With `delete_source` the files that were read, and no others, go after all is stored (`manifest`): a file that lands during the run stays
    for the next one, which adds a batch to the same date. Without it a repeated run replaces its batch.
    """
    log = f"{raw_root.rstrip('/')}-manifests/extraction_date={extraction_date}"
    dated = f"{raw_root}/extraction_date={extraction_date}"
    batch = manifest.next_batch(spark, log)
    with landing.scan_envelopes(spark, source, suffix).split() as found:
        found.rejects.write.mode("overwrite").parquet(f"{rejects_path(raw_root, extraction_date)}/batch={batch}")
        days = landing.flatten_envelopes(found.good)
        _sized(days).write.mode("overwrite").parquet(f"{dated}/batch={batch}")
        stored = spark.read.schema(days.schema).parquet(dated).select(*days.columns)
        store_snapshot(stored, staging)
        if delete_source:
            manifest.commit(found.files, log, batch)
            manifest.delete(spark, manifest.read(spark, log, batch))
    return Compaction(found.n_good, found.n_rejected)


def delete_files(spark: SparkSession, path: str, suffix: str) -> int:
    """Delete the files below `path` that end in `suffix`, whoever wrote them and whether they were read or not, and say how many. After a
    compaction its manifest says what may go (`manifest.delete`)."""
    listed = files.list_files(spark, path, suffix)
    return manifest.delete(spark, listed.select("path", "length", F.unix_millis("modified").alias("modified")))


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: T.StructType, delete_source: bool = False) -> None:
    """CSV files to one Parquet dataset with each file's new dated name and its date as columns. With `delete_source` the files
    that were read go after the dataset is written, and a later run adds a batch to it; else it is replaced."""
    log = f"{target.rstrip('/')}-manifests"
    batch = manifest.next_batch(spark, log)
    name = F.col("_metadata.file_name")
    rows = manifest.with_file(files.read_csv(spark, source, schema)
                              .select("*", dated_file_name(name).alias("file_name"), file_date(name).alias("file_date"), "_metadata"))
    stored = settle(rows.drop("_metadata"), "csv")
    stored.drop(*manifest.FILE_COLUMNS).write.mode("overwrite").parquet(f"{target}/batch={batch}")
    if delete_source:
        manifest.commit(manifest.of_rows(stored), log, batch)
        manifest.delete(spark, manifest.read(spark, log, batch))


def append_history(df: DataFrame, path: str, part: str) -> None:
    """Add rows to a consolidated history without rewriting it; it is created when absent. A part (the day, say) owns
    its folder, so adding it again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/part={part}")


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A history whose parts had differing columns; a column that a part lacks is NULL there. The schema is given, so
    no footer is read for it."""
    whole = T.StructType([*schema.fields, T.StructField("part", T.StringType())])
    return spark.read.schema(whole).parquet(path).drop("part")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


class Stored(NamedTuple):
    """A written model and the least value of its first sort column (NULL if it is empty)."""

    table: DataFrame
    first: object


ORDER = ("dates", "department")


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One shuffle by the first sort column; Spark cuts a hot value into several parts and each part is sorted."""
    return df.hint("rebalance", order[0]).sortWithinPartitions(*order)


def materialise(df: DataFrame, path: str, order: Sequence[str] = ORDER, ordered: bool = False) -> DataFrame:
    """Write a model as a dataset sorted by `order` and return the written table.

    Each file is sorted, so readers skip row groups by the first sort column. Rows that come in order already (`ordered`) are written
    as they come, without a shuffle.
    """
    return store(df, path, order, ordered).table


def store(df: DataFrame, path: str, order: Sequence[str] = ORDER, ordered: bool = False) -> Stored:
    """`materialise`, with the least value of the first column noted while it is written."""
    seen = Observation()
    noted = df.observe(seen, F.min(order[0]).alias("first"))
    (noted if ordered else in_order(noted, order)).write.mode("overwrite").parquet(path)
    return Stored(df.sparkSession.read.schema(df.schema).parquet(path), seen.get["first"])


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
