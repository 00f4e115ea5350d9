"""Weather-shaped raw tables derived from the benchmark tables.

Each text serves Spark and the SQL check: `{...}` marks table names and the few spellings that differ.
One observation per event, 25 departments x 30 days; every table grows with `events` (the dimension
with `nation`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEPCODE = """
select concat('POINT (', cast(n as string), ' ', cast(n + 40 as string), ')') as geo_point_2d,
  concat(chr(123), '"type": "Point", "coordinates": [', cast(n as string), '.0, ', cast(n + 40 as string), '.0]', chr(125)) as geo_shape,
  r_name as reg_name,
  cast(r_regionkey as string) as reg_code, dep_name as dep_name_upper, cast(n as string) as dep_current_code,
  case when n % 4 = 0 then null else 'rural' end as dep_status,
  case when n = 23 then 'Corse-du-Sud' when n = 24 then 'Haute Corse'
       when n % 3 = 0 then concat('Nation-', cast(n as string), '-d', chr(39), 'Été')
       when n % 3 = 1 then concat('Nation-', cast(n as string), ' Côtes')
       else concat('Nation-', cast(n as string)) end as department,
  dep_name as dep_normalized
from (
  select r_name, r_regionkey, n_nationkey as n,
    case when n_nationkey = 23 then 'CORSE DU SUD' when n_nationkey = 24 then 'HAUTE CORSE'
         when n_nationkey % 3 = 0 then concat('NATION ', cast(n_nationkey as string), ' D ETE')
         when n_nationkey % 3 = 1 then concat('NATION ', cast(n_nationkey as string), ' COTES')
         else concat('NATION ', cast(n_nationkey as string)) end as dep_name
  from {nation} join {region} on n_regionkey = r_regionkey
) t
"""

WEATHER_ = """
select concat('id-', cast(event_id as string)) as id,
  concat(department, ', ', reg_name, ', France') as resolvedAddress, concat(department, ', France') as address,
  40.0e0 + code / 10.0e0 as latitude, code / 5.0e0 as longitude,
  cast(cast(ts as date) as string) as datetime, event_id as datetimeEpoch,
  value / 10.0e0 as tempmax, value / 10.0e0 - 20.0e0 as tempmin, value / 10.0e0 - 10.0e0 as temp,
  value / 10.0e0 + 1.0e0 as feelslikemax, value / 10.0e0 - 21.0e0 as feelslikemin,
  value / 10.0e0 - 11.0e0 as feelslike, value / 20.0e0 as dew, k * 1.0e0 as humidity,
  value / 50.0e0 as precip, k * 1.0e0 as precipprob, k / 2.0e0 as precipcover,
  case when k % 2 = 0 then 'rain' else null end as preciptype, 0.0e0 as snow,
  case when k % 3 = 0 then null else value / 100.0e0 end as snowdepth,
  k / 2.0e0 as windgust, k / 4.0e0 as windspeed, k * 3.6e0 as winddir, 980.0e0 + value / 10.0e0 as pressure,
  k * 1.0e0 as cloudcover, 10.0e0 as visibility, value as solarradiation, value / 25.0e0 as solarenergy,
  k % 11 * 1.0e0 as uvindex, 10.0e0 as severerisk, '06:30:00' as sunrise, event_id as sunriseEpoch,
  '20:30:00' as sunset, event_id as sunsetEpoch, k % 5 / 4.0e0 as moonphase, event_type as conditions,
  event_type as description, event_type as icon, cast(null as string) as stations, 'fcst' as source, department
from (
  select e.event_id, e.ts, e.value, e.event_type, {k} as k, d.department, d.reg_name,
    cast(d.dep_current_code as int) as code
  from {events} e join {depcode} d on cast(e.user_id % 25 as string) = d.dep_current_code
) t
"""

# The landed layout; both Corsican departments are called Corse.
WEATHER = """
select id as _airbyte_ab_id, latitude, longitude, resolvedAddress, cloudcover, conditions, datetime, datetimeEpoch,
  description, dew, feelslike, feelslikemax, feelslikemin, humidity, icon, moonphase, precip, precipcover, precipprob,
  preciptype, pressure, severerisk, snow, snowdepth, solarenergy, solarradiation, source, stations, sunrise,
  sunriseEpoch, sunset, sunsetEpoch, temp, tempmax, tempmin, uvindex, visibility, winddir, windgust, windspeed,
  case when department in ('Corse-du-Sud', 'Haute Corse') then 'Corse' else department end as department
from {weather}
"""

SPARK_K = "cast(get_json_object(e.props, '$.k') as int)"
DUCK_K = "cast(json_extract_string(e.props, '$.k') as int)"


# Columns of the benchmark tables in use; a given schema spares a job that reads the footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_depcode_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DEPCODE, nation=table(spark, sf_dir, "nation"), region=table(spark, sf_dir, "region"))


def raw_depcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_depcode_(spark, sf_dir).drop("department", "dep_normalized")


def raw_weather_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension is broadcast: `nation` has 25 rows at every scale. Without the hint Spark
    broadcasts `events` where that file is the smaller one."""
    text = WEATHER_.replace("{k}", SPARK_K)
    events, depcode = table(spark, sf_dir, "events"), F.broadcast(raw_depcode_(spark, sf_dir))
    return spark.sql(text, events=events, depcode=depcode)


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(WEATHER, weather=raw_weather_(spark, sf_dir))


def duck(text: str) -> str:
    """The SQL check's spelling of an input."""
    names = {"nation": "nation", "region": "region", "events": "events", "depcode": "raw_depcode_",
             "weather": "raw_weather_", "k": DUCK_K}
    for token, spelling in names.items():
        text = text.replace("{" + token + "}", spelling)
    return text.strip()
