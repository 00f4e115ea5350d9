"""The registered queries in plain SQL, written from the definitions (cross joins, windows, NFD).

`CTES` holds the shared tables; a query gets those it names, and those they name, in front.
"""

from __future__ import annotations

import re

from skylake import schemas
from workload import inputs
from workload.queries import (
    DATE, DEPARTMENT, DOCUMENT_EVENTS, EXTRACTED, EXTRACTED_BEFORE, EXTRACTION, HISTORY_SHIFT, REGION,
)


def rnd(digits: int, x: str) -> str:
    return f"round_even(({x}) * 1e{digits}, 0) / 1e{digits}"


def avg(x: str, over: str = "") -> str:
    """A plain average, summed without loss of small parts."""
    return f"fsum({x}) {over} / count({x}) {over}"


def plain(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '[^A-Za-z0-9]', '', 'g')))"


def key(x: str) -> str:
    return plain(f"strip_accents({x})")


CTES: dict[str, str] = {
    "raw_depcode_": inputs.duck(inputs.DEPCODE),
    "raw_depcode": f"select {', '.join(schemas.DEPCODE_COLUMNS)} from raw_depcode_",
    "raw_weather_": inputs.duck(inputs.WEATHER_),
    "raw_weather": inputs.duck(inputs.WEATHER),
}

_STG_DEPCODE = """
select geo_point_2d, geo_shape, reg_name, reg_code, dep_name_upper as dep_name, dep_current_code as dep_code,
  coalesce(dep_status, 'undefined') as dep_status{more} from {raw}"""
CTES["stg_depcode"] = _STG_DEPCODE.format(more="", raw="raw_depcode")
CTES["stg_depcode_"] = _STG_DEPCODE.format(more=", department, dep_normalized", raw="raw_depcode_")

_STG_WEATHER = """
select {id} as record_id, cast(datetime as date) as dates, datetimeEpoch, department, resolvedAddress as locations,
  latitude, longitude, solarenergy, solarradiation, uvindex, temp, tempmax, tempmin, feelslike, feelslikemax,
  feelslikemin, precip, precipprob, precipcover, snow, coalesce(snowdepth, a.v) as snowdepth_filled, dew, humidity,
  winddir, windspeed, windgust, pressure, severerisk, icon, cloudcover, conditions, moonphase,
  description as descriptions, sunrise, sunset, source, sunriseEpoch, sunsetEpoch
from {raw}, (select {average} as v from {raw}) a"""
for _suffix, _id in (("", "_airbyte_ab_id"), ("_", "id")):
    CTES["stg_most_recent_weather" + _suffix] = _STG_WEATHER.format(
        id=_id, raw="raw_weather" + _suffix, average=rnd(1, avg("snowdepth"))
    )

_INT_DEPCODE = """
select geo_point_2d, geo_shape, reg_name, reg_code, dep_name, {key} as department_lower, dep_code, dep_status from {stg}"""
CTES["int_depcode"] = _INT_DEPCODE.format(
    key=plain("case dep_name when 'CORSE DU SUD' then 'corse' when 'HAUTE CORSE' then 'corse0' else dep_name end"),
    stg="stg_depcode",
)
CTES["int_depcode_"] = _INT_DEPCODE.format(key=plain("dep_normalized"), stg="stg_depcode_")

LABEL = """case when moonphase = 0 then 'new moon' when moonphase >= 0 and moonphase <= 0.25 then 'waxing crescent'
  when moonphase >= 0.25 and moonphase <= 0.5 then 'waxing gibbous'
  when moonphase >= 0.5 and moonphase <= 0.75 then 'waning gibbous' else 'waning crescent' end"""
STRICT = """case when moonphase = 0 then 'new moon' when moonphase = 0.25 then 'first quarter'
  when moonphase = 0.5 then 'full moon' when moonphase = 0.75 then 'last quarter' when moonphase is null then null
  when moonphase > 0 and moonphase < 0.25 then 'waxing crescent'
  when moonphase > 0.25 and moonphase < 0.5 then 'waxing gibbous'
  when moonphase > 0.5 and moonphase < 0.75 then 'waning gibbous' else 'waning crescent' end"""

for _suffix in ("", "_"):
    CTES["int_most_recent_weather" + _suffix] = f"""
select record_id, dates, dayname(dates) as weekday_name, datetimeEpoch, department,
  {key("department")} as department_lower, locations, latitude, longitude,
  {rnd(3, "solarenergy * 0.2778e0")} as solarenergy_kwhpm2, solarradiation, uvindex, temp, tempmax, tempmin,
  feelslike, feelslikemax, feelslikemin, precip, precipprob, precipcover, snow, snowdepth_filled, dew, humidity,
  winddir, windspeed, windgust, pressure, severerisk, icon, cloudcover, conditions, moonphase,
  {LABEL} as moonphase_label, descriptions, sunrise, sunset, source, sunriseEpoch, sunsetEpoch
from stg_most_recent_weather{_suffix}"""

_FROM_DIMENSION = {"dep_name": "d.dep_name", "dep_code": "d.dep_code", "dep_status": "d.dep_status",
                   "reg_name": "d.reg_name", "reg_code": "d.reg_code", "geo_point_2d": "d.geo_point_2d",
                   "geojson": "d.geo_shape as geojson"}


def _mart(columns: list[str], special: dict[str, str], weather: str, depcode: str, on: str) -> str:
    special = {
        **_FROM_DIMENSION, **special,
        "avg_solarenergy_kwhpm2":
            rnd(3, avg("o.solarenergy_kwhpm2", "over (partition by d.reg_name)")) + " as avg_solarenergy_kwhpm2",
        "avg_solarradiation":
            rnd(3, avg("o.solarradiation", "over (partition by d.reg_name)")) + " as avg_solarradiation",
    }
    listed = ", ".join(special.get(c, f"o.{c}") for c in columns)
    return f"select {listed} from {weather} o join {depcode} d on {on}"


_DISTANCE = "levenshtein(o.department_lower, d.department_lower)"
CTES["mart_newdata"] = _mart(
    schemas.FUZZY_MART_COLUMNS, {"dep_distance": f"{_DISTANCE} as dep_distance"},
    "int_most_recent_weather", "int_depcode", f"{_DISTANCE} <= 1",
)
CTES["mart_newdata_"] = _mart(
    schemas.MART_COLUMNS, {"snowdepth": "o.snowdepth_filled as snowdepth"},
    "int_most_recent_weather_", "int_depcode_", "o.department_lower = d.department_lower",
)
CTES["best_pairs"] = """select name, target, distance from (
  select o.name, d.department_lower as target, levenshtein(o.name, d.department_lower) as distance,
    min(levenshtein(o.name, d.department_lower)) over (partition by o.name) as best
  from (select distinct department_lower as name from int_most_recent_weather) o
  cross join (select distinct department_lower from int_depcode) d) t
where distance = best and distance <= 1"""
CTES["mart_newdata_best"] = _mart(
    schemas.FUZZY_MART_COLUMNS, {"dep_distance": "p.distance as dep_distance"},
    "int_most_recent_weather", "best_pairs",
    "o.department_lower = d.name",
).replace("best_pairs d on o.department_lower = d.name",
          "best_pairs p on o.department_lower = p.name join int_depcode d on p.target = d.department_lower")

MEASURES = {"temp": 1, "solarenergy_kwhpm2": 2, "solarradiation": 2, "humidity": 2, "windspeed": 2, "pressure": 2,
            "cloudcover": 2}
_REPORTED = ", ".join(["reg_name", "department", *MEASURES])
_FIRST_DAY = "(select min(dates) from mart_newdata_)"
CTES["mart_today"] = f"select {_REPORTED} from mart_newdata_ where dates = {_FIRST_DAY}"
CTES["mart_next_3_days"] = \
    f"select {_REPORTED} from mart_newdata_ where dates > {_FIRST_DAY} and dates <= {_FIRST_DAY} + 3"


def _over(measure: str, group: str, name: str) -> str:
    return f"{rnd(MEASURES[measure], avg(measure, f'over (partition by {group})'))} as {name}"


CTES["mart_today_stats"] = "select reg_name, department, " + ", ".join(
    f"{m}, {_over(m, 'reg_name', f'regavg_{m}')}" for m in MEASURES
) + " from mart_today"


def _c(measure: str) -> str:
    return "temp_c" if measure == "temp" else measure


CTES["mart_next_3_days_stats"] = "select reg_name, department, " + ", ".join(
    f"{m}, {_over(m, 'department', f'depavg_{_c(m)}')}, {_over(m, 'reg_name', f'regavg_{_c(m)}')}" for m in MEASURES
) + " from mart_next_3_days"

# Of each day and department: the latest extraction, of that the observation with the highest id, and of that
# observation the department whose name is closest.
_NEWEST = "record_id desc, dep_distance asc nulls last, dep_code"
CTES["archive"] = f"""select * exclude (rn) from (select *, row_number() over (
  partition by dates, department order by {_NEWEST}) as rn from mart_newdata) t where rn = 1"""
CTES["versions"] = f"""select *, strftime(dates, '%Y%m') as yyyymm from (
  select * replace (cast(dates - {HISTORY_SHIFT} as date) as dates, temp - 1.0e0 as temp), date '{EXTRACTED_BEFORE}' as extraction_date
  from mart_newdata union all by name select *, date '{EXTRACTED}' as extraction_date from mart_newdata) t"""
CTES["newest"] = f"""select * exclude (rn) from (select *, row_number() over (
  partition by dates, department order by extraction_date desc, {_NEWEST}) as rn from versions) t where rn = 1"""

_DAYS = ", ".join(c for c in schemas.LANDED_COLUMNS if c not in ("_airbyte_ab_id", "preciptype", "stations", "department"))
_LISTED = """case when preciptype is not null and uvindex < 3 then '["rain","snow"]'
  when preciptype is not null then '["rain"]' when uvindex < 3 then '["snow"]' else '[]' end"""
_RUN = f"cast(datetimeEpoch // {DOCUMENT_EVENTS} as varchar)"
CTES["landed"] = f"""select concat(resolvedAddress, '/', {_RUN}) as _airbyte_ab_id, {_DAYS},
  {_LISTED} as preciptype, concat('["', icon, '"]') as stations, department from raw_weather_"""
CTES["document_words"] = \
    "select distinct unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as w from documents"
CTES["spoken_words"] = \
    "select distinct unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as w from conversations"
for _side in ("document", "spoken"):
    CTES[f"{_side}_probes"] = f"""select distinct w, unnest(list_concat([w], list_transform(range(1, length(w) + 1),
  lambda i: concat(substr(w, 1, i - 1), substr(w, i + 1))))) as probe from {_side}_words"""

SQL: dict[str, str] = {name: f"select * from {name}" for name in (
    "stg_depcode stg_depcode_ stg_most_recent_weather stg_most_recent_weather_ int_depcode int_depcode_ "
    "int_most_recent_weather int_most_recent_weather_ mart_newdata mart_newdata_ mart_newdata_best mart_today "
    "mart_next_3_days mart_today_stats mart_next_3_days_stats"
).split()}

# Leaderboards: name -> (source, expression, column); direction and group come from the name.
_WORDS = {"cloudcover": "cloudcover", "humidity": "humidity", "radiation": "solarradiation",
          "solarenergy": "solarenergy_kwhpm2", "temperature": "temp", "windspeed": "windspeed"}


def _board(name: str) -> str:
    level, group = name[:3], "department" if name.startswith("dep") else "reg_name"
    word = re.search(r"(?:top3|bottom3)_([a-z]+)", name).group(1)
    order = "desc" if "top3" in name else "asc"
    measure = _WORDS[word]
    if "_3d_" in name:
        column = f"{level}avg_{'temperature' if word == 'temperature' else measure}"
        # The average of a group constant; rounding takes out the division noise.
        value = rnd(MEASURES[measure], avg(f"{level}avg_{_c(measure)}"))
        shown = f"select {group}, {value} as {column} from mart_next_3_days_stats group by {group}"
    elif level == "reg":
        column = f"regavg_{word}"
        shown = f"select {group}, {rnd(2, avg(measure))} as {column} from mart_today_stats group by {group}"
    else:
        column = "temperature" if word == "temperature" else measure
        shown = f"select department, {measure} as {column} from mart_today_stats"
    return f"select * from ({shown}) t order by {column} {order} nulls last, {group} limit 3"


for _level in ("dep", "reg"):
    for _word in ("cloudcover", "radiation", "solarenergy", "temperature"):
        SQL[f"{_level}_3d_bottom3_{_word}"] = ""
    for _word in ("cloudcover", "humidity", "radiation", "solarenergy", "temperature", "windspeed"):
        SQL[f"{_level}_3d_top3_{_word}"] = ""
    for _word in ("cloudcover", "temperature"):
        SQL[f"{_level}_bottom3_{_word}_today"] = ""
    for _word in ("cloudcover", "humidity", "solarenergy", "temperature", "windspeed"):
        SQL[f"{_level}_top3_{_word}_today"] = ""
SQL = {name: text or _board(name) for name, text in SQL.items()}

SQL["example_model"] = """select id from (select c_custkey as id from customer union all
  select cast(null as bigint) from customer) t where id = 1"""

SQL["daily_build"] = f"""select reg_name, {rnd(2, avg("regavg_humidity"))} as regavg_humidity,
  count(distinct department) as n_departments, count(*) as n_records from mart_next_3_days_stats group by reg_name
  order by regavg_humidity desc nulls last, reg_name limit 3"""

SQL["archived_data"] = "select * from newest"
SQL["archive_latest"] = "select * from archive"
SQL["archive_append_twice"] = "select * from mart_newdata"
SQL["archive_by_month"] = f"""select yyyymm, count(*) as n_records, {rnd(3, avg("temp"))} as avg_temp from versions group by yyyymm"""
SQL["archive_date_range"] = """select dates, department, dep_code, record_id, temp, extraction_date, yyyymm from newest
  where dates between date '2023-12-20' and date '2024-01-10'"""
SQL["archive_stream"] = \
    f"select * replace (temp + 1.0e0 as temp), date '{EXTRACTED}' as extraction_date from archive"
SQL["archive_two_streams"] = f"select distinct *, date '{EXTRACTED}' as extraction_date from mart_newdata"
SQL["archive_compacted"] = "select * from newest"
SQL["archive_refreshed"] = "select * from newest"
# The second load rewrites the months of the mart, the third that of its first day; months that only the history has stay as written.
SQL["archive_months_rewritten"] = """select yyyymm, cast(case
    when yyyymm = (select strftime(min(dates), '%Y%m') from mart_newdata_) then 2
    when yyyymm in (select strftime(dates, '%Y%m') from mart_newdata_) then 1 else 0 end as int) as held
  from (select distinct yyyymm from newest) m"""

_OF_DEPARTMENT = f"department = '{DEPARTMENT}'"
SQL["get_data"] = "select * from mart_newdata_"
SQL["get_temp_data"] = f"""select dates, weekday_name, department, temp, tempmin, tempmax, feelslike, feelslikemin,
  feelslikemax, descriptions from mart_newdata_ where {_OF_DEPARTMENT} order by dates"""
SQL["get_solarenergy_geo_data"] = f"""select dates, weekday_name, department, geo_point_2d, geojson, solarenergy_kwhpm2,
  solarradiation, reg_name, avg_solarenergy_kwhpm2, avg_solarradiation from mart_newdata_ where dates = date '{DATE}'"""
SQL["get_date"] = "select distinct dates from mart_newdata_"
SQL["get_tfptwgp"] = f"""select dates, department, reg_name, windspeed, windgust, pressure, solarenergy_kwhpm2, temp,
  feelslike, precip from mart_newdata_ where {_OF_DEPARTMENT} order by dates"""
SQL["get_sunshine_data"] = "select dates, reg_name, department, solarenergy_kwhpm2, solarradiation from mart_newdata_"
SQL["get_region_sunshine_data"] = f"""select reg_name, department, solarenergy_kwhpm2, solarradiation from mart_newdata_
  where reg_name = '{REGION}'"""
SQL["get_solarenergy_agg_pday"] = f"""select department, v as solarenergy_kwhpm2, v * 2.7e0 as available_solarenergy_kwhc,
  v * 2.7e0 * 0.217e0 as real_production_kwhpday from (select department, {avg("solarenergy_kwhpm2")} as v
  from mart_newdata_ where {_OF_DEPARTMENT} group by department) t"""
_HISTORY = ["solarenergy_kwhpm2", "solarradiation", "temp", "precip", "uvindex"]
SQL["get_entire_department_data"] = f"""select dates, department, {", ".join(f"{rnd(1, m)} as {m}" for m in _HISTORY)}
  from archive where {_OF_DEPARTMENT} order by dates"""
SQL["get_entire_region_data"] = f"""select dates, reg_name, {", ".join(f"{rnd(1, avg(m))} as {m}" for m in _HISTORY)}
  from archive where reg_name = '{REGION}' group by dates, reg_name order by dates, reg_name"""
SQL["region_history_sums"] = SQL["get_entire_region_data"].replace("from archive", "from newest")
SQL["landed_build"] = SQL["get_entire_region_data"]
SQL["get_ml_data"] = "select * from archive"
SQL["get_today_stats"] = "select * from mart_today_stats"
SQL["get_next_3_days_stats"] = "select * from mart_next_3_days_stats"
SQL["get_next_3_days_stats_of"] = f"select * from mart_next_3_days_stats where {_OF_DEPARTMENT}"
SQL["get_next_3_days_data"] = "select * from mart_next_3_days"
SQL["get_today_data"] = "select * from mart_today"

_STATS = ", ".join(f"{rnd(d, avg(m))} as {n}" for n, m, d in (
    ("temperature", "temp", 1), ("humidity", "humidity", 1), ("windspeed", "windspeed", 1), ("pressure", "pressure", 1),
    ("cloudcover", "cloudcover", 1), ("solarradiation", "solarradiation", 1), ("solarenergy", "solarenergy_kwhpm2", 2)))
for _level, _group in (("department", "department"), ("region", "reg_name")):
    for _period, _source in (("today", "mart_today"), ("next3days", "mart_next_3_days")):
        SQL[f"get_stats_{_level}_{_period}"] = \
            f"select {_group} as geo_name, {_STATS} from {_source} group by {_group}"
SQL["get_stats_warmest_departments"] = f"""select * from ({SQL["get_stats_department_next3days"]}) t
  order by temperature desc nulls last, geo_name limit 3"""

SQL["unit_conversions"] = f"""select event_id, {rnd(0, "(value - 32.0e0) * (5.0e0 / 9.0e0)")} as celsius,
  {rnd(0, "value * 2.54e0")} as cm, {rnd(2, "value * 25.4e0")} as mm, {rnd(1, "value * 1.60934e0")} as kph,
  {rnd(3, "value * 0.2778e0")} as kwhpm2 from events"""
SQL["conversions_in_sql"] = SQL["unit_conversions"].replace(
    " from events", f", {rnd(1, 'value / 3')} as third from events")
SQL["moonphase_labels"] = f"select id, moonphase, {LABEL} as label, {STRICT} as strict_label from raw_weather_"
SQL["normalize_names"] = r"""select doc_id, upper(trim(regexp_replace(regexp_replace(strip_accents(text),
  '[^\x00-\x7F]', '', 'g'), '[-''\s\x0b\x1c-\x1f]+', ' ', 'g'))) as normalized from documents"""
SQL["name_keys"] = f"select doc_id, {key('text')} as name_key from documents"
SQL["choose_first"] = "select id, split_part(resolvedAddress, ',', 1) as department from raw_weather_"
SQL["stringify_lists"] = f"select id, {_LISTED} as preciptype from raw_weather_"
SQL["nan_to_null"] = "select id, case when preciptype is null then temp end as temp from raw_weather_"
SQL["average_snowdepth"] = f"select {rnd(1, avg('snowdepth'))} as avg_snowdepth from raw_weather_"
SQL["ad_hoc_sql"] = """select department, min(temp) as min_temp, max(temp) as max_temp, count(*) as n_records
  from raw_weather_ where source = 'fcst' group by department"""

SQL["fuzzy_match_words"] = """select distinct a.w as word, b.w as spoken, levenshtein(a.w, b.w) as distance
  from document_probes a join spoken_probes b on a.probe = b.probe where levenshtein(a.w, b.w) <= 1"""
SQL["fuzzy_match_names"] = f"""select n.name, d.department_lower as key, levenshtein(n.name, d.department_lower) as distance
  from (select distinct {key("department")} as name from raw_weather) n, int_depcode d
  where levenshtein(n.name, d.department_lower) <= 1"""
_CHUNKS = """select (rn - 1) // 5 + 1 as chunk, string_agg(c_name, ' | ' order by rn) as entries
  from (select c_name, row_number() over (order by c_custkey) as rn from customer) t group by 1"""
SQL["chunk_locations"] = _CHUNKS
SQL["first_chunks"] = f"select * from ({_CHUNKS}) t where chunk <= 12"
SQL["filter_tagged"] = """select cast(s_suppkey as varchar) as connectionId, s_name as name,
  'daily,weather-team' as tags from supplier where s_nationkey % 3 = 0"""


def _short(x: str) -> str:
    return f"regexp_replace(cast({x} as varchar), '\\.0$', '')"


def _square(x: str, y: str) -> list[tuple[str, str]]:
    return [(x, y), (f"{x} + 1", y), (f"{x} + 1", f"{y} + 1"), (x, f"{y} + 1"), (x, y)]


def _point_wkt(x: str, y: str) -> str:
    return f"concat('POINT (', {_short(x)}, ' ', {_short(y)}, ')')"


def _square_wkt(x: str, y: str) -> str:
    points = ", ', ', ".join(f"{_short(a)}, ' ', {_short(b)}" for a, b in _square(x, y))
    return f"concat('POLYGON ((', {points}, '))')"


def _pair(a: str, b: str) -> str:
    return f"'[', cast({a} as varchar), ', ', cast({b} as varchar), ']'"


def _point_json(x: str, y: str) -> str:
    return f"concat('{{\"type\": \"Point\", \"coordinates\": ', {_pair(x, y)}, '}}')"


def _square_json(x: str, y: str) -> str:
    points = ", ', ', ".join(_pair(a, b) for a, b in _square(x, y))
    return f"concat('{{\"type\": \"Polygon\", \"coordinates\": [[', {points}, ']]}}')"


SQL["geo_to_geojson"] = f"""select id,
  case datetimeEpoch % 3 when 0 then {_point_wkt("longitude", "latitude")}
    when 1 then {_square_wkt("longitude", "latitude")} end as wkt,
  case datetimeEpoch % 3 when 0 then {_point_json("longitude", "latitude")}
    when 1 then {_square_json("longitude", "latitude")} end as geojson
from raw_weather_"""
SQL["dim_department"] = f"""select {_point_wkt("x", "y")} as geo_point_2d, {_square_json("x", "y")} as geo_shape,
  c_mktsegment as reg_name, cast(c_nationkey as varchar) as reg_code, upper(c_name) as dep_name_upper,
  cast(c_nationkey as varchar) as dep_current_code, case when c_acctbal > 0 then c_mktsegment end as dep_status,
  n.department, upper(trim(regexp_replace(strip_accents(n.department), '[-''\\s]+', ' ', 'g'))) as dep_normalized
from (select *, (c_custkey % 100) / 4.0e0 as x, (c_custkey % 100) / 4.0e0 + 40 as y from customer) c
left join (select * from raw_depcode_ where reg_name <> 'ASIA') n on cast(c_nationkey as varchar) = n.dep_current_code"""

_LANDED = f"select {', '.join(schemas.LANDED_COLUMNS)} from landed"
SQL["flatten_jsonl"] = _LANDED
SQL["compact_jsonl"] = _LANDED
SQL["compact_late_arrival"] = _LANDED.replace(" from landed", ", true as late_lines_kept, 0 as n_left from landed")
SQL["stream_ingest"] = _LANDED
SQL["flatten_payload"] = f"""select * replace (sha256(concat(resolvedAddress, '|{EXTRACTION}')) as id,
  {_LISTED} as preciptype, concat('["', icon, '"]') as stations) from raw_weather_"""
SQL["extract_records"] = f"""select resolvedAddress, latitude, longitude, cast(count(*) as int) as n_days from raw_weather_
  group by datetimeEpoch // {DOCUMENT_EVENTS}, resolvedAddress, latitude, longitude"""
_QUOTED = """case when datetimeEpoch % 7 = 0 then '"north"' else format('{:.1f}', latitude) end"""
_LINE = f"""concat('{{"_airbyte_raw_id":"', id, '","_airbyte_data":{{"latitude":', {_QUOTED},
  ',"resolvedAddress":"X","days":[{{"datetime":"2024-01-01"}}]}}}}')"""
_SIDES = f"""select case when preciptype is null then substr({_LINE}, 1, 30) when datetimeEpoch % 7 = 0 then {_LINE} else id end as record,
  preciptype is not null and datetimeEpoch % 7 <> 0 as accepted from raw_weather_"""
SQL["scan_rejects"] = SQL["stream_rejects"] = _SIDES
SQL["compact_rejects"] = f"""select record, accepted, cast(count(*) filter (accepted) over () as int) as n_good,
  cast(count(*) filter (not accepted) over () as int) as n_rejected, 0 as n_left from ({_SIDES}) t"""
SQL["flatten_payload_multiline"] = SQL["flatten_payload"]
SQL["list_by_suffix"] = "select distinct event_type from events"
SQL["list_by_glob"] = "select distinct event_type from events where event_type between 'c' and 'pzzz'"
SQL["catalog_tables"] = "select r_regionkey from region"
SQL["concat_mixed_schema"] = \
    "select * replace (case when datetimeEpoch % 2 = 0 then preciptype end as preciptype) from raw_weather_"
SQL["history_append"] = """select id, department, temp,
  case when cast(right(id, 1) as int) % 2 = 0 then preciptype end as preciptype from raw_weather_"""
SQL["select_by_schema"] = "select * from raw_weather_"
SQL["csv_round_trip"] = \
    "select department, lpad(cast(cast(longitude * 5 as int) as varchar), 2, '0') as dep_current_code from raw_weather_"
SQL["filename_dates"] = """select event_id, strftime(ts, 'france_weather_%Y-%m-%d.csv') as file_name,
  cast(ts as date) as file_date from events"""
SQL["distinct_file_dates"] = \
    "select distinct strftime(ts, '%Y_%m_%d') as file_date from events where event_type <> 'error'"
SQL["load_tables"] = """select * from raw_weather_ where datetimeEpoch % 2 = 0 and department like 'Nation-1%'
  or datetimeEpoch % 2 = 1 and department like 'Nation-2%'"""
SQL["merge_daily_data"] = "select id, department, temp from raw_weather_"
SQL["materialise_mart"] = "select * from mart_newdata_"

SQL["dq_unique"] = """select resolvedAddress, count(*) as n_records from raw_weather_ group by 1 having count(*) > 1"""
SQL["dq_unique_id"] = "select id, 2 as n_records from raw_weather_ where id like '%7'"
SQL["dq_not_null"] = "select id, department, datetime from raw_weather_ where snowdepth is null"
SQL["dq_primary_key"] = """select resolvedAddress, count(*) as n_records from raw_weather_ group by 1
  having count(*) > 1 or resolvedAddress is null"""
_ICON, _END = schemas.RAW_COLUMNS.index("icon"), len(schemas.RAW_COLUMNS)
SQL["dq_columns"] = f"""select * from (values ({_ICON}, 'pictogram', 'icon'), ({_END}, 'more', null)) t(position, found, expected)"""
SQL["dq_completeness_nan"] = """select 'id' as column_name, 1.0e0 as ratio, false as has_null union all
  select 'temp', count(*) filter (preciptype is null) / count(*), bool_or(preciptype is not null) from raw_weather_ union all
  select 'preciptype', count(preciptype) / count(*), bool_or(preciptype is null) from raw_weather_"""
SQL["dq_completeness"] = " union all ".join(
    f"select '{c}' as column_name, count({c}) / count(*) as ratio from raw_weather_" for c in schemas.RAW_COLUMNS)
SQL["dq_null_columns"] = " union all ".join(
    f"select '{c}' as column_name, count(*) > count({c}) as has_null from raw_weather_" for c in schemas.RAW_COLUMNS)
SQL["dq_unmatched_names"] = """select department_lower, count(*) as n_records from int_most_recent_weather
  where department_lower not in (select department_lower from int_depcode_) group by 1"""


def _named(text: str) -> list[str]:
    """Shared tables the text needs, in the order they must be defined."""
    needed: list[str] = []
    for word in re.findall(r"\b[a-z_0-9]+\b", text):
        if word in CTES and word not in needed:
            for name in _named(CTES[word]):
                if name not in needed:
                    needed.append(name)
            if word not in needed:
                needed.append(word)
    return needed


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, text in SQL.items():
        needed = _named(text)
        head = ", ".join(f"{n} as ({CTES[n].strip()})" for n in needed)
        out[name] = f"with {head} {text}" if needed else text
    return out
