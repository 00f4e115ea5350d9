"""File scans and listings. Directories are read as one dataset; Spark splits the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylake.functions.text import base_name


def _reader(spark: SparkSession, suffix: str | None):
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", f"*{suffix}") if suffix else reader


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                 suffix: str | None = ".parquet") -> DataFrame:
    reader = _reader(spark, suffix)
    reader = reader.schema(schema) if schema else reader
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             suffix: str | None = ".csv") -> DataFrame:
    """CSV with a header; the schema keeps codes such as `01` or `2A` as text."""
    return _reader(spark, suffix).schema(schema).option("header", "true").option("enforceSchema", "false") \
        .csv(path)


def list_files(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """Files below `path` (a folder or a glob) as (path, name, length, modified); contents are not read."""
    return (
        _reader(spark, suffix).format("binaryFile").load(path)
        .select("path", base_name("path").alias("name"), "length", F.col("modificationTime").alias("modified"))
    )


def distinct_file_dates(names: DataFrame, column: str) -> DataFrame:
    """Distinct `YYYY_MM_DD` prefixes of file names."""
    prefix = F.substring(column, 1, 10)
    return names.select(prefix.alias("file_date")).where(F.col("file_date").rlike(r"^\d{4}_\d{2}_\d{2}$")).distinct()


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Concatenate by name; a column a frame lacks is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
