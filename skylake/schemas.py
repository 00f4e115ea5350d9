"""Explicit schemas of every table; readers never infer."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "date": T.DateType(),
          "int": T.IntegerType(), "array<string>": T.ArrayType(T.StringType())}

# Fields of one day of observations that are not doubles.
_DAY_TYPES = {
    "datetime": "string", "datetimeEpoch": "bigint", "preciptype": "array<string>", "sunrise": "string",
    "sunriseEpoch": "bigint", "sunset": "string", "sunsetEpoch": "bigint", "conditions": "string",
    "description": "string", "icon": "string", "stations": "array<string>", "source": "string",
}

# The fields of one day, in the order of the current raw table.
DAY_FIELDS = """
    datetime datetimeEpoch tempmax tempmin temp feelslikemax feelslikemin feelslike dew humidity
    precip precipprob precipcover preciptype snow snowdepth windgust windspeed winddir pressure
    cloudcover visibility solarradiation solarenergy uvindex severerisk sunrise sunriseEpoch sunset
    sunsetEpoch moonphase conditions description icon stations source
""".split()

# Columns of the raw table filled by the compaction of landed envelopes.
LANDED_COLUMNS = """
    _airbyte_ab_id latitude longitude resolvedAddress cloudcover conditions datetime datetimeEpoch
    description dew feelslike feelslikemax feelslikemin humidity icon moonphase precip precipcover
    precipprob preciptype pressure severerisk snow snowdepth solarenergy solarradiation source
    stations sunrise sunriseEpoch sunset sunsetEpoch temp tempmax tempmin uvindex visibility winddir
    windgust windspeed department
""".split()

# Columns of the current raw table.
RAW_COLUMNS = ["id", "resolvedAddress", "address", "latitude", "longitude", *DAY_FIELDS, "department"]

# Columns of the two raw dimensions.
DEPCODE_COLUMNS = "geo_point_2d geo_shape reg_name reg_code dep_name_upper dep_current_code dep_status".split()
DEPCODE_NAMED_COLUMNS = [*DEPCODE_COLUMNS, "department", "dep_normalized"]

# Mart columns between the observation id and the two region averages.
_MART_BODY = """
    record_id dates datetimeEpoch weekday_name department dep_name dep_code dep_status reg_name
    reg_code geo_point_2d geojson locations latitude longitude solarenergy_kwhpm2 solarradiation
    uvindex temp tempmax tempmin feelslike feelslikemax feelslikemin precip precipprob precipcover
    snow {snowdepth} dew humidity winddir windspeed windgust pressure severerisk icon cloudcover
    conditions moonphase moonphase_label descriptions sunrise sunset source sunriseEpoch sunsetEpoch
"""
_REGION_AVERAGES = ["avg_solarenergy_kwhpm2", "avg_solarradiation"]
MART_COLUMNS = [*_MART_BODY.format(snowdepth="snowdepth").split(), *_REGION_AVERAGES]
FUZZY_MART_COLUMNS = [
    *_MART_BODY.format(snowdepth="snowdepth_filled").split(), "dep_distance", *_REGION_AVERAGES
]

_MART_STRINGS = set("""
    record_id weekday_name department dep_name dep_code dep_status reg_name reg_code geo_point_2d
    geojson locations icon conditions moonphase_label descriptions sunrise sunset source
""".split())
_MART_OTHER = {"dates": "date", "datetimeEpoch": "bigint", "sunriseEpoch": "bigint", "sunsetEpoch": "bigint",
               "dep_distance": "int"}


def _struct(names: list[str], type_of) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[type_of(n)]) for n in names])


def _day_type(name: str) -> str:
    return _DAY_TYPES.get(name, "double")


def _raw_type(name: str) -> str:
    """Type in the warehouse form: lists are held as text."""
    if name in ("_airbyte_ab_id", "id", "resolvedAddress", "address", "department"):
        return "string"
    kind = _day_type(name)
    return "string" if kind == "array<string>" else kind


def _mart_type(name: str) -> str:
    return "string" if name in _MART_STRINGS else _MART_OTHER.get(name, "double")


DAY = _struct(DAY_FIELDS, _day_type)
RAW_WEATHER_ = _struct(RAW_COLUMNS, _raw_type)
RAW_WEATHER = _struct(LANDED_COLUMNS, _raw_type)
RAW_DEPCODE = _struct(DEPCODE_COLUMNS, lambda _: "string")
RAW_DEPCODE_ = _struct(DEPCODE_NAMED_COLUMNS, lambda _: "string")
DEPARTMENT_CODES = _struct(["department", "dep_current_code"], lambda _: "string")
MART_NEWDATA_ = _struct(MART_COLUMNS, _mart_type)
MART_NEWDATA = _struct(FUZZY_MART_COLUMNS, _mart_type)
ARCHIVED_DATA = MART_NEWDATA

LOCATION = T.StructType([
    T.StructField("resolvedAddress", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("days", T.ArrayType(DAY)),
])
PAYLOAD = T.StructType([T.StructField("locations", T.ArrayType(LOCATION))])
ENVELOPE = T.StructType([
    T.StructField("_airbyte_raw_id", T.StringType()),
    T.StructField("_airbyte_data", T.StructType([f for f in LOCATION.fields if f.name != "address"])),
])

CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])

# Measures averaged in the history of a department or region.
HISTORY_MEASURES = ["solarenergy_kwhpm2", "solarradiation", "temp", "precip", "uvindex"]
