"""Landed JSON documents: scan with a fixed schema, set bad records aside, flatten to day rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylake import schemas
from skylake.functions.numeric import nan_columns_to_null
from skylake.functions.text import first_part, list_to_text
from skylake.session import fresh_path, remove
from skylake.sources import manifest


class Split(NamedTuple):
    """A scan that was parsed once and written: both sides, how many there are, and the files they come from."""

    good: DataFrame
    rejects: DataFrame
    files: DataFrame
    n_good: int
    n_rejected: int


class Scan:
    """Landed documents split into those that fit the schema and those that do not.

    A document is parsed as a whole whatever columns are read afterwards, so each one is on exactly one
    side: cut lines, other JSON than an object, and values of another type are rejects. Blank lines are
    no documents.
    """

    def __init__(self, lines: DataFrame, schema: T.StructType):
        """`lines` has the text of a document in `value`; `file_path` says where it came from."""
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
        parsed = F.from_json("value", schemas.with_corrupt(schema), options)
        # The list of one keeps Spark from parsing once for each condition on `p` and again for its fields.
        self._parsed = lines.select(*manifest.FILE_COLUMNS, "value", F.explode(F.array(parsed)).alias("p"))
        self._blank = F.trim("value") == ""
        self._fits = F.col("p").isNotNull() & F.col(f"p.{schemas.CORRUPT}").isNull()

    @property
    def good(self) -> DataFrame:
        return self._parsed.where(~self._blank & self._fits).select("p.*").drop(schemas.CORRUPT)

    def rejects(self) -> DataFrame:
        """(file_path, record text)."""
        return self._parsed.where(~self._blank & ~self._fits).select("file_path", F.col("value").alias("record"))

    @contextmanager
    def split(self) -> Iterator[Split]:
        """Both sides from one parse: every line goes to a written table, in a folder by its outcome, and is counted in the same job.
        The table goes when the block ends, so what is to last is written inside."""
        spark = self._parsed.sparkSession
        path, seen = fresh_path(spark, "landed"), Observation()
        outcome = F.when(self._blank, "blank").when(self._fits, "good").otherwise("rejected")
        said = lambda side: F.coalesce(F.sum((F.col("outcome") == side).cast("int")), F.lit(0)).alias(side)
        rows = self._parsed.select(
            *manifest.FILE_COLUMNS, outcome.alias("outcome"), F.when(outcome == "rejected", F.col("value")).alias("record"),
            F.when(outcome == "good", F.col("p").dropFields(schemas.CORRUPT)).alias("p"))
        rows.observe(seen, said("good"), said("rejected")).write.partitionBy("outcome").parquet(path)
        stored = spark.read.schema(rows.schema).parquet(path)
        side = lambda name: stored.where(F.col("outcome") == name)
        try:
            yield Split(side("good").select("p.*"), side("rejected").select("file_path", "record"), manifest.of_rows(stored),
                        seen.get["good"], seen.get["rejected"])
        finally:
            remove(spark, path)


def text_lines(reader, path: str, suffix: str | None, whole: bool = False) -> DataFrame:
    """(value, file_path, file_length, file_modified) of the documents below `path`: one per line, or one per file."""
    reader = reader.option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", f"*{suffix}") if suffix else reader
    return manifest.with_file(reader.text(path, wholetext=whole)).select("value", *manifest.FILE_COLUMNS)


def scan_payloads(spark: SparkSession, path: str, multiline: bool = True, suffix: str | None = ".json") -> Scan:
    """API documents `{locations: [...]}`; one per file, or one per line without `multiline`."""
    return Scan(text_lines(spark.read, path, suffix, multiline), schemas.PAYLOAD)


def scan_envelopes(spark: SparkSession, path: str, suffix: str | None = ".jsonl") -> Scan:
    """Landed lines `{_airbyte_raw_id, _airbyte_data: {...}}`."""
    return Scan(text_lines(spark.read, path, suffix), schemas.ENVELOPE)


def records(payloads: DataFrame, field: str = "locations") -> DataFrame:
    """One row per element of an array field, its fields as columns."""
    return payloads.select(F.explode(field).alias("r")).select("r.*")


def remove_fields(df: DataFrame, *fields: str) -> DataFrame:
    """Drop top-level columns or, as `a.b`, fields of a struct column; absent ones are ignored."""
    for name in fields:
        top, _, nested = name.partition(".")
        if not nested:
            df = df.drop(top)
        elif top in df.columns:
            df = df.withColumn(top, F.col(top).dropFields(nested))
    return df


def location_id(address: Column | str, extraction_date: str) -> Column:
    """Id of one location's extraction; the same input gives the same id in every run."""
    c = F.col(address) if isinstance(address, str) else address
    return F.sha2(F.concat_ws("|", c, F.lit(extraction_date)), 256)


def flatten_payloads(payloads: DataFrame, extraction_date: str) -> DataFrame:
    """Location metadata x days, in the layout of the current raw table (lists stay arrays)."""
    locations = records(payloads).withColumn("id", location_id("resolvedAddress", extraction_date))
    days = locations.select(
        "id", "resolvedAddress", "address", "latitude", "longitude", F.explode("days").alias("d")
    )
    flat = days.select("id", "resolvedAddress", "address", "latitude", "longitude", "d.*")
    return flat.withColumn("department", first_part("resolvedAddress")).select(*schemas.RAW_COLUMNS)


def flatten_envelopes(envelopes: DataFrame) -> DataFrame:
    """Landed envelopes x days, in the layout of the landed raw table (lists stay arrays)."""
    days = envelopes.select(
        F.col("_airbyte_raw_id").alias("_airbyte_ab_id"), "_airbyte_data.latitude", "_airbyte_data.longitude",
        "_airbyte_data.resolvedAddress", F.explode("_airbyte_data.days").alias("d"),
    )
    flat = days.select("_airbyte_ab_id", "latitude", "longitude", "resolvedAddress", "d.*")
    return flat.withColumn("department", first_part("resolvedAddress")).select(*schemas.LANDED_COLUMNS)


def dropped_locations(locations: DataFrame) -> DataFrame:
    """Locations that flatten to no row: their `days` are missing or empty."""
    return locations.where(F.coalesce(F.size("days"), F.lit(0)) <= 0)


def to_warehouse_form(df: DataFrame) -> DataFrame:
    """Lists become JSON text and NaN becomes NULL."""
    lists = {f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
    return nan_columns_to_null(
        df.select(*[list_to_text(c).alias(c) if c in lists else F.col(c) for c in df.columns])
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` in its order and types; any other column is left out."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def strings_for_objects(df: DataFrame, *columns: str) -> DataFrame:
    """Cast columns to text, NULL stays NULL."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in columns else F.col(c) for c in df.columns])


def filter_tagged(connections: DataFrame, tag: str) -> DataFrame:
    """Connections that carry a tag of this name, their tags reduced to names."""
    return connections.where(F.exists("tags", lambda t: t["name"] == tag)).select(
        "connectionId", "name", F.transform("tags", lambda t: t["name"]).alias("tags")
    )
