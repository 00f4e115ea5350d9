"""Build of the department dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skylake import schemas
from skylake.functions.geometry import wkb_to_geojson, wkb_to_wkt
from skylake.functions.text import normalize_name
from skylake.operators.lookup import lookup_join
from skylake.sources.landing import strings_for_objects

_CODES = schemas.DEPCODE_COLUMNS[2:]


def region_columns(df: DataFrame) -> DataFrame:
    """The columns of a wider geography file that the dimension needs."""
    return df.select(*schemas.DEPCODE_COLUMNS)


def build_depcode(geography: DataFrame, names: DataFrame) -> DataFrame:
    """Geography rows with text geometry and the normalised name of their department code."""
    named = names.select("department", "dep_current_code", normalize_name("department").alias("dep_normalized"))
    joined = lookup_join(strings_for_objects(geography, *_CODES), named, "dep_current_code", "left")
    return (
        joined.withColumn("geo_point_2d", wkb_to_wkt("geo_point_2d"))
        .withColumn("geo_shape", wkb_to_geojson("geo_shape"))
        .select(*schemas.DEPCODE_NAMED_COLUMNS)
    )
