"""Staging and intermediate models: rename, type, fill, derive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylake.functions import labels, numeric, text

# Staged observation columns that keep their raw name, in model order.
_LOCATED = ["latitude", "longitude", "solarenergy", "solarradiation"]
_MEASURED = """
    uvindex temp tempmax tempmin feelslike feelslikemax feelslikemin precip precipprob precipcover snow
""".split()
_AFTER_SNOW = "dew humidity winddir windspeed windgust pressure severerisk icon cloudcover conditions moonphase".split()
_SUN = "sunrise sunset source sunriseEpoch sunsetEpoch".split()


def stg_depcode(raw: DataFrame) -> DataFrame:
    """Dimension with short names and a status for every department."""
    return raw.select(
        "geo_point_2d", "geo_shape", "reg_name", "reg_code",
        F.col("dep_name_upper").alias("dep_name"), F.col("dep_current_code").alias("dep_code"),
        F.coalesce("dep_status", F.lit("undefined")).alias("dep_status"),
        *[c for c in ("department", "dep_normalized") if c in raw.columns],
    )


# The current dimension also carries `department` and `dep_normalized`.
stg_depcode_ = stg_depcode


def _staged_weather(raw: DataFrame, id_column: str) -> DataFrame:
    average = raw.select(numeric.rounded_avg("snowdepth", 1)).scalar()
    return raw.select(
        F.col(id_column).alias("record_id"), F.to_date("datetime").alias("dates"), "datetimeEpoch",
        "department", F.col("resolvedAddress").alias("locations"), *_LOCATED, *_MEASURED,
        F.coalesce(numeric.nan_to_null("snowdepth"), average).alias("snowdepth_filled"),
        *_AFTER_SNOW, F.col("description").alias("descriptions"), *_SUN,
    )


def stg_most_recent_weather(raw: DataFrame) -> DataFrame:
    """Landed observations; a missing snow depth gets the batch average."""
    return _staged_weather(raw, "_airbyte_ab_id")


def stg_most_recent_weather_(raw: DataFrame) -> DataFrame:
    """Current observations; a missing snow depth gets the batch average."""
    return _staged_weather(raw, "id")


def _keyed_depcode(staged: DataFrame, key) -> DataFrame:
    return staged.select(
        "geo_point_2d", "geo_shape", "reg_name", "reg_code", "dep_name", key.alias("department_lower"),
        "dep_code", "dep_status",
    )


def int_depcode(staged: DataFrame) -> DataFrame:
    """Dimension keyed by its upper-case name, two names remapped to the facts' spelling."""
    return _keyed_depcode(staged, text.plain_key(labels.renamed("dep_name")))


def int_depcode_(staged: DataFrame) -> DataFrame:
    """Dimension keyed by its normalised name."""
    return _keyed_depcode(staged, text.plain_key("dep_normalized"))


def int_most_recent_weather(staged: DataFrame, strict_labels: bool = False) -> DataFrame:
    """Observations with weekday, name key, kWh per square metre and moon-phase label."""
    return staged.select(
        "record_id", "dates", labels.weekday_name("dates").alias("weekday_name"), "datetimeEpoch",
        "department", text.name_key("department").alias("department_lower"), "locations", "latitude",
        "longitude", numeric.mj_to_kwh_per_m2("solarenergy").alias("solarenergy_kwhpm2"),
        "solarradiation", *_MEASURED, "snowdepth_filled", *_AFTER_SNOW,
        labels.moonphase_label("moonphase", strict_labels).alias("moonphase_label"), "descriptions", *_SUN,
    )


int_most_recent_weather_ = int_most_recent_weather
