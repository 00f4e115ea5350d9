"""The registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from unittest import mock

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylake import schemas
from skylake.functions import geometry, labels, numeric, sql, text
from skylake.operators import chunks, fuzzy, quality
from skylake.plans import build, dimension, marts, serving, staging, views
from skylake.session import fresh_path
from skylake.sources import archive, files, landing, served, tables
from skylake.streaming import ingest
from workload import inputs
from workload.inputs import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the served queries.
DEPARTMENT = "Nation-5"
REGION = "EUROPE"
DATE = "2024-01-05"
EXTRACTION = "2024-02-01"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- models ---------------------------------------------------------------------------------------

@query
def stg_depcode(spark, sf):
    return staging.stg_depcode(inputs.raw_depcode(spark, sf))


@query
def stg_depcode_(spark, sf):
    return staging.stg_depcode_(inputs.raw_depcode_(spark, sf))


@query
def stg_most_recent_weather(spark, sf):
    return staging.stg_most_recent_weather(inputs.raw_weather(spark, sf))


@query
def stg_most_recent_weather_(spark, sf):
    return staging.stg_most_recent_weather_(inputs.raw_weather_(spark, sf))


@query
def int_depcode(spark, sf):
    return staging.int_depcode(stg_depcode(spark, sf))


@query
def int_depcode_(spark, sf):
    return staging.int_depcode_(stg_depcode_(spark, sf))


@query
def int_most_recent_weather(spark, sf):
    return staging.int_most_recent_weather(stg_most_recent_weather(spark, sf))


@query
def int_most_recent_weather_(spark, sf):
    return staging.int_most_recent_weather_(stg_most_recent_weather_(spark, sf))


@query
def mart_newdata(spark, sf, order=()):
    return marts.mart_newdata(int_most_recent_weather(spark, sf), int_depcode(spark, sf), order=order)


@query
def mart_newdata_best(spark, sf):
    return marts.mart_newdata(int_most_recent_weather(spark, sf), int_depcode(spark, sf), best_only=True)


@query
def mart_newdata_(spark, sf, order=()):
    return marts.mart_newdata_(int_most_recent_weather_(spark, sf), int_depcode_(spark, sf), order=order)


_STORED: dict[tuple[str, str, str], tables.Stored] = {}


def stored(spark, sf, name: str) -> tables.Stored:
    """A mart, built and written once per session and data folder; reports and served queries read it."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        _STORED[key] = tables.store(QUERIES[name](spark, sf, order=tables.ORDER), fresh_path(spark, name), ordered=True)
    return _STORED[key]


def stored_mart_(spark, sf) -> DataFrame:
    return stored(spark, sf, "mart_newdata_").table


def stored_mart(spark, sf) -> DataFrame:
    return stored(spark, sf, "mart_newdata").table


@query
def mart_today(spark, sf):
    return views.mart_today(*stored(spark, sf, "mart_newdata_"))


@query
def mart_next_3_days(spark, sf):
    return views.mart_next_3_days(*stored(spark, sf, "mart_newdata_"))


@query
def mart_today_stats(spark, sf):
    return views.mart_today_stats(mart_today(spark, sf))


@query
def mart_next_3_days_stats(spark, sf):
    return views.mart_next_3_days_stats(mart_next_3_days(spark, sf))


def _register_board(name: str) -> None:
    def run(spark, sf):
        rows = mart_next_3_days(spark, sf) if views.LEADERBOARDS[name].three_days else mart_today(spark, sf)
        return views.leaderboard(name, rows)

    QUERIES[name] = run


for _name in views.LEADERBOARDS:
    _register_board(_name)


@query
def example_model(spark, sf):
    """Ids followed by a NULL id per source row, then the filter on one id."""
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    model = files.union_all(ids, ids.select(F.lit(None).cast("bigint").alias("id")))
    return model.where("id = 1")


@query
def daily_build(spark, sf):
    """All current models built and published, then asked in SQL."""
    build.build_current(
        inputs.raw_weather_(spark, sf), inputs.raw_depcode_(spark, sf), fresh_path(spark, "marts"))
    return spark.sql("""
        select b.reg_name, b.regavg_humidity, t.n_departments, t.n_records
        from reg_3d_top3_humidity b join (
          select reg_name, count(distinct department) as n_departments, count(*) as n_records
          from mart_next_3_days_stats group by reg_name) t on b.reg_name = t.reg_name""")


@query
def landed_build(spark, sf):
    """All landed models built and published, then loaded into an archive and read back."""
    models = build.build_landed(
        inputs.raw_weather(spark, sf), inputs.raw_depcode(spark, sf), fresh_path(spark, "marts"))
    root, served = fresh_path(spark, "archive"), fresh_path(spark, "archive")
    archive.append_batch(models["mart_newdata"], root, EXTRACTION)
    archive.compact(archive.read_archive(spark, root), served)
    return serving.get_entire_region_data(archive.read_archive(spark, served), REGION)


@query
def conversions_in_sql(spark, sf):
    sql.register_functions(spark)
    return tables.run_query(
        spark,
        "select event_id, convert_f_to_c(value) as celsius, convert_inch_to_cm(value) as cm, "
        "convert_inch_to_mm(value) as mm, convert_mph_to_kph(value) as kph, "
        "convert_mj_per_m2_to_kwh_per_m2(value) as kwhpm2, round_even(value / 3, 1) as third from {events}",
        events=table(spark, sf, "events"),
    )


# --- archive --------------------------------------------------------------------------------------

# The history was extracted a day before the new mart, and starts HISTORY_SHIFT days earlier: it reaches back into
# the month before, and both hold the days in between.
HISTORY_SHIFT = 16
EXTRACTED_BEFORE = "2024-02-01"
EXTRACTED = "2024-02-02"


def _dated(mart: DataFrame, day: str) -> DataFrame:
    return mart.withColumn("extraction_date", F.lit(day).cast("date"))


def _history(mart: DataFrame) -> DataFrame:
    return mart.withColumns({"dates": F.date_sub("dates", HISTORY_SHIFT), "temp": F.col("temp") - F.lit(1.0)})


def _two_loads(spark, sf) -> str:
    """An archive with the history and the new mart."""
    root, mart = fresh_path(spark, "archive"), stored_mart(spark, sf)
    archive.append_batch(_history(mart), root, EXTRACTED_BEFORE)
    archive.append_batch(mart, root, EXTRACTED)
    return root


@query
def archived_data(spark, sf):
    mart = stored_mart(spark, sf)
    return archive.archived_data(_dated(_history(mart), EXTRACTED_BEFORE), _dated(mart, EXTRACTED))


@query
def archive_latest(spark, sf):
    return archive.latest(stored_mart(spark, sf))


@query
def archive_append_twice(spark, sf):
    root = fresh_path(spark, "archive")
    mart = stored_mart(spark, sf)
    for _ in range(2):
        archive.append_batch(mart, root, EXTRACTION)
    return archive.read_archive(spark, root).drop("extraction_date", "yyyymm")


@query
def archive_by_month(spark, sf):
    months = archive.read_archive(spark, _two_loads(spark, sf)).groupBy("yyyymm")
    return months.agg(F.count(F.lit(1)).alias("n_records"), numeric.rounded_avg("temp", 3).alias("avg_temp"))


@query
def archive_date_range(spark, sf):
    found = archive.latest_between(archive.read_archive(spark, _two_loads(spark, sf)), "2023-12-20", "2024-01-10")
    return found.select("dates", "department", "dep_code", "record_id", "temp", "extraction_date", "yyyymm")


@query
def archive_stream(spark, sf):
    """Two daily deliveries through the stream; the second replaces the first for every key."""
    drop, root, marks = (fresh_path(spark, x) for x in ("drop", "archive", "marks"))
    mart = stored_mart(spark, sf)
    for day, shift in ((EXTRACTED_BEFORE, 0.0), (EXTRACTED, 1.0)):
        _dated(mart.withColumn("temp", F.col("temp") + F.lit(shift)), day).write.mode("append").parquet(drop)
        ingest.archive_daily(spark, drop, root, marks).awaitTermination()
    return archive.latest(archive.read_archive(spark, root)).drop("yyyymm")


@query
def archive_two_streams(spark, sf):
    """Two streams deliver the halves of one day into one archive, then a new checkpoint delivers the first half again."""
    root, mart = fresh_path(spark, "archive"), _dated(stored_mart(spark, sf), EXTRACTED)
    odd = F.col("datetimeEpoch") % 2 == 1
    drops = [fresh_path(spark, "drop") for _ in range(2)]
    for part, drop in zip((mart.where(odd), mart.where(~odd)), drops):
        part.write.parquet(drop)
    for drop in (*drops, drops[0]):
        ingest.archive_daily(spark, drop, root, fresh_path(spark, "marks")).awaitTermination()
    return archive.distinct(archive.read_archive(spark, root).drop("yyyymm"))


@query
def archive_compacted(spark, sf):
    target = fresh_path(spark, "archive")
    archive.compact(archive.read_archive(spark, _two_loads(spark, sf)), target)
    return archive.read_archive(spark, target)


@query
def archive_refreshed(spark, sf):
    """The served archive after a refresh for each of two loads: equal to a full compaction."""
    root, target, mart = fresh_path(spark, "archive"), fresh_path(spark, "served"), stored_mart(spark, sf)
    for rows, day in ((_history(mart), EXTRACTED_BEFORE), (mart, EXTRACTED)):
        archive.append_batch(rows, root, day)
        served.refresh(spark, root, target)
    return served.read(spark, target)


@query
def region_history_sums(spark, sf):
    """Region history from stored sums, after a load that was wrong is replaced: equal to averages over the newest rows."""
    root, target, mart = fresh_path(spark, "archive"), fresh_path(spark, "served"), stored_mart(spark, sf)
    wrong = mart.withColumn("temp", F.col("temp") + F.lit(7.0))
    for rows, day in ((_history(mart), EXTRACTED_BEFORE), (wrong, EXTRACTED), (mart, EXTRACTED)):
        archive.append_batch(rows, root, day)
        served.refresh(spark, root, target)
    return serving.get_region_history(served.region_sums(spark, target), REGION)


@query
def archive_months_rewritten(spark, sf):
    """The version that holds each month after three loads; the last has one day only and rewrites its month alone."""
    root, target, mart = fresh_path(spark, "archive"), fresh_path(spark, "served"), stored_mart(spark, sf)
    first = mart.agg(F.min("dates")).first()[0]
    for rows, day in ((_history(mart), EXTRACTED_BEFORE), (mart, EXTRACTED), (mart.where(F.col("dates") == F.lit(first)), "2024-02-03")):
        archive.append_batch(rows, root, day)
        served.refresh(spark, root, target)
    return served.held_months(spark, target)


# --- served queries -------------------------------------------------------------------------------

_ARCHIVES: dict[tuple[str, str], str] = {}


def served_archive(spark, sf) -> DataFrame:
    """The compacted archive of the landed mart, loaded and compacted once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ARCHIVES:
        root, target = fresh_path(spark, "archive"), fresh_path(spark, "archive")
        archive.append_batch(stored_mart(spark, sf), root, EXTRACTION)
        archive.compact(archive.read_archive(spark, root), target)
        _ARCHIVES[key] = target
    return archive.read_archive(spark, _ARCHIVES[key]).drop("extraction_date", "yyyymm")


@query
def get_data(spark, sf):
    return serving.get_data(stored_mart_(spark, sf))


@query
def get_temp_data(spark, sf):
    return serving.get_temp_data(stored_mart_(spark, sf), DEPARTMENT)


@query
def get_solarenergy_geo_data(spark, sf):
    return serving.get_solarenergy_geo_data(stored_mart_(spark, sf), DATE)


@query
def get_date(spark, sf):
    return serving.get_date(stored_mart_(spark, sf))


@query
def get_tfptwgp(spark, sf):
    return serving.get_tfptwgp(stored_mart_(spark, sf), DEPARTMENT)


@query
def get_sunshine_data(spark, sf):
    return serving.get_sunshine_data(stored_mart_(spark, sf))


@query
def get_region_sunshine_data(spark, sf):
    return serving.get_region_sunshine_data(stored_mart_(spark, sf), REGION)


@query
def get_solarenergy_agg_pday(spark, sf):
    return serving.get_solarenergy_agg_pday(stored_mart_(spark, sf), DEPARTMENT)


@query
def get_entire_department_data(spark, sf):
    return serving.get_entire_department_data(served_archive(spark, sf), DEPARTMENT)


@query
def get_entire_region_data(spark, sf):
    return serving.get_entire_region_data(served_archive(spark, sf), REGION)


@query
def get_ml_data(spark, sf):
    return serving.get_ml_data(served_archive(spark, sf))


@query
def get_today_stats(spark, sf):
    return serving.get_today_stats(mart_today_stats(spark, sf))


@query
def get_next_3_days_stats(spark, sf):
    return serving.get_next_3_days_stats(mart_next_3_days_stats(spark, sf))


@query
def get_next_3_days_stats_of(spark, sf):
    return serving.get_next_3_days_stats(mart_next_3_days_stats(spark, sf), DEPARTMENT)


@query
def get_next_3_days_data(spark, sf):
    return serving.get_next_3_days_data(mart_next_3_days(spark, sf))


@query
def get_today_data(spark, sf):
    return serving.get_today_data(mart_today(spark, sf))


def _stats(spark, sf, **arguments):
    return serving.get_stats(mart_today(spark, sf), mart_next_3_days(spark, sf), **arguments)


@query
def get_stats_department_today(spark, sf):
    return _stats(spark, sf, level="department", period="today")


@query
def get_stats_department_next3days(spark, sf):
    return _stats(spark, sf, level="department", period="next3days")


@query
def get_stats_region_today(spark, sf):
    return _stats(spark, sf, level="region", period="today")


@query
def get_stats_region_next3days(spark, sf):
    return _stats(spark, sf, level="region", period="next3days")


@query
def get_stats_warmest_departments(spark, sf):
    return _stats(spark, sf, level="department", period="next3days", rank_by="temperature")


# --- scalar functions -----------------------------------------------------------------------------

@query
def unit_conversions(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        numeric.fahrenheit_to_celsius("value").alias("celsius"),
        numeric.inch_to_cm("value").alias("cm"),
        numeric.inch_to_mm("value").alias("mm"),
        numeric.mph_to_kph("value").alias("kph"),
        numeric.mj_to_kwh_per_m2("value").alias("kwhpm2"),
    )


@query
def moonphase_labels(spark, sf):
    return inputs.raw_weather_(spark, sf).select(
        "id", "moonphase", labels.moonphase_label("moonphase").alias("label"),
        labels.moonphase_label("moonphase", strict=True).alias("strict_label"),
    )


@query
def normalize_names(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.normalize_name("text").alias("normalized"))


@query
def name_keys(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.name_key("text").alias("name_key"))


@query
def choose_first(spark, sf):
    raw = inputs.raw_weather_(spark, sf)
    return raw.select("id", text.first_part("resolvedAddress").alias("department"))


def _listed(spark, sf):
    rain, snow = F.col("preciptype"), F.when(F.col("uvindex") < 3, "snow")
    return inputs.raw_weather_(spark, sf).withColumn("preciptype", F.array_compact(F.array(rain, snow)))


@query
def stringify_lists(spark, sf):
    return landing.to_warehouse_form(_listed(spark, sf).select("id", "preciptype"))


@query
def nan_to_null(spark, sf):
    wet = F.col("preciptype").isNotNull()
    raw = inputs.raw_weather_(spark, sf).select(
        "id", F.when(wet, F.lit(float("nan"))).otherwise(F.col("temp")).alias("temp")
    )
    return numeric.nan_columns_to_null(raw)


@query
def average_snowdepth(spark, sf):
    return inputs.raw_weather_(spark, sf).agg(numeric.rounded_avg("snowdepth", 1).alias("avg_snowdepth"))


@query
def ad_hoc_sql(spark, sf):
    return tables.run_query(
        spark,
        "select department, min(temp) as min_temp, max(temp) as max_temp, count(*) as n_records "
        "from {weather} where source = :source group by department",
        args={"source": "fcst"}, weather=inputs.raw_weather_(spark, sf),
    )


# --- names ----------------------------------------------------------------------------------------

def _words(df: DataFrame, name: str) -> DataFrame:
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]+)"), 1)
    return df.select(F.explode(words).alias(name)).distinct()


@query
def fuzzy_match_words(spark, sf):
    left = _words(table(spark, sf, "documents"), "word")
    right = _words(table(spark, sf, "conversations"), "spoken")
    return fuzzy.near_pairs(left, right, "word", "spoken")


@query
def fuzzy_match_names(spark, sf):
    names = inputs.raw_weather(spark, sf).select(text.name_key("department").alias("name")).distinct()
    keys = int_depcode(spark, sf).select(F.col("department_lower").alias("key")).distinct()
    return fuzzy.near_pairs(names, keys, "name", "key")


@query
def chunk_locations(spark, sf):
    return chunks.join_in_chunks(table(spark, sf, "customer"), "c_name", ["c_custkey"], 5)


@query
def first_chunks(spark, sf):
    return chunks.join_in_chunks(table(spark, sf, "customer"), "c_name", ["c_custkey"], 5, first=12)


@query
def filter_tagged(spark, sf):
    def tag(name):
        return F.struct(name.alias("name"))

    team = F.when(F.col("s_nationkey") % 3 == 0, "weather-team").otherwise("other-team")
    connections = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("connectionId"), F.col("s_name").alias("name"),
        F.array(tag(F.lit("daily")), tag(team)).alias("tags"),
    )
    found = landing.filter_tagged(connections, "weather-team")
    return found.withColumn("tags", F.array_join("tags", ","))


# --- dimension and geometry -----------------------------------------------------------------------

@F.pandas_udf(T.BinaryType())
def _wkb(x: pd.Series, y: pd.Series, kind: pd.Series) -> pd.Series:
    """Well-known binary of a point or of a unit square at (x, y); kind 2 gives broken bytes."""
    import struct

    def encode(x, y, kind):
        if kind == 2:
            return b"\x01\x07"
        if kind == 0:
            return struct.pack("<BI2d", 1, 1, x, y)
        ring = (x, y, x + 1, y, x + 1, y + 1, x, y + 1, x, y)
        return struct.pack("<BIII10d", 1, 3, 1, 5, *ring)

    return pd.Series([encode(*v) for v in zip(x, y, kind)])


@query
def geo_to_geojson(spark, sf):
    raw = inputs.raw_weather_(spark, sf)
    shape = _wkb("longitude", "latitude", F.col("datetimeEpoch") % 3)
    return raw.select("id", shape.alias("shape")).select(
        "id", geometry.wkb_to_wkt("shape").alias("wkt"), geometry.wkb_to_geojson("shape").alias("geojson")
    )


@query
def dim_department(spark, sf):
    """One geography row per customer, named by its nation code; some codes have no name."""
    x = (F.col("c_custkey") % 100) / F.lit(4.0)
    geography = table(spark, sf, "customer").select(
        _wkb(x, x + 40, F.lit(0)).alias("geo_point_2d"), _wkb(x, x + 40, F.lit(1)).alias("geo_shape"),
        F.col("c_mktsegment").alias("reg_name"), F.col("c_nationkey").alias("reg_code"),
        F.upper("c_name").alias("dep_name_upper"), F.col("c_nationkey").alias("dep_current_code"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("dep_status"),
    )
    names = inputs.raw_depcode_(spark, sf).select("department", "dep_current_code").where("reg_name <> 'ASIA'")
    return dimension.build_depcode(dimension.region_columns(geography), names)


# --- landed documents and files -------------------------------------------------------------------

# Events per document and location; it bounds the days one document may hold.
DOCUMENT_EVENTS = 400


def _locations(spark, sf) -> DataFrame:
    """Nested locations: the days of one department within one run of event ids."""
    raw = _listed(spark, sf).withColumn("stations", F.array(F.col("icon")))
    day = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.DAY.fields])
    run = F.floor(F.col("datetimeEpoch") / F.lit(DOCUMENT_EVENTS)).alias("run")
    return raw.groupBy(run, "resolvedAddress", "address", "latitude", "longitude").agg(
        F.collect_list(day).alias("days")
    )


def _write_lines(df: DataFrame) -> str:
    path = fresh_path(df.sparkSession, "landed")
    df.write.json(path)
    return path


def _envelopes(spark, sf) -> str:
    raw_id = F.concat_ws("/", "resolvedAddress", F.col("run").cast("string"))
    nested = _locations(spark, sf).select(
        raw_id.alias("_airbyte_raw_id"),
        F.struct("latitude", "longitude", "resolvedAddress", "days").alias("_airbyte_data"),
    )
    return _write_lines(nested)


@query
def flatten_jsonl(spark, sf):
    landed = landing.scan_envelopes(spark, _envelopes(spark, sf), suffix=".json")
    return landing.to_warehouse_form(landing.flatten_envelopes(landed.good))


def _payloads(spark, sf) -> DataFrame:
    locations = _locations(spark, sf)
    return locations.groupBy("run", F.floor("longitude").alias("part")).agg(
        F.collect_list(F.struct("resolvedAddress", "address", "latitude", "longitude", "days")).alias("locations")
    ).select("locations")


@query
def flatten_payload(spark, sf):
    scan = landing.scan_payloads(spark, _write_lines(_payloads(spark, sf)), multiline=False)
    return landing.to_warehouse_form(landing.flatten_payloads(scan.good, EXTRACTION))


# For writes of many small files: tasks move their own files into place (the folder is read after the job only, and a repeated task writes
# the same names), and a file system of the machine writes no checksum file and sets no permissions beside each file.
SMALL_FILES = {
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true",
}


@query
def flatten_payload_multiline(spark, sf):
    """One indented document per file."""
    path = fresh_path(spark, "landed")
    text = _payloads(spark, sf).select(F.to_json(F.struct("locations"), {"pretty": "true"}).alias("value"))
    text.write.options(maxRecordsPerFile=1, **SMALL_FILES).text(path)
    scan = landing.scan_payloads(spark, path, suffix=".txt")
    return landing.to_warehouse_form(landing.flatten_payloads(scan.good, EXTRACTION))


@query
def extract_records(spark, sf):
    """Records of a payload without the removed fields."""
    extra = _locations(spark, sf).withColumn("tzoffset", F.lit(1.0)).withColumn("n_days", F.size("days"))
    payloads = extra.groupBy("run").agg(F.collect_list(F.struct(*[c for c in extra.columns if c != "run"])).alias("locations"))
    return landing.remove_fields(landing.records(payloads), "queryCost", "address", "tzoffset", "timezone", "days")


def _faulty_lines(spark, sf) -> str:
    """A line per observation with one day: dry ones are cut short, and every seventh has text for its latitude."""
    raw = inputs.raw_weather_(spark, sf)
    latitude = F.when(F.col("datetimeEpoch") % 7 == 0, F.lit("north")).otherwise(F.format_string("%.1f", "latitude"))
    quoted = F.when(F.col("datetimeEpoch") % 7 == 0, F.concat(F.lit('"'), latitude, F.lit('"'))).otherwise(latitude)
    line = F.concat(F.lit('{"_airbyte_raw_id":"'), "id", F.lit('","_airbyte_data":{"latitude":'), quoted,
                    F.lit(',"resolvedAddress":"X","days":[{"datetime":"2024-01-01"}]}}'))
    cut = F.when(F.col("preciptype").isNull(), F.substring(line, 1, 30)).otherwise(line)
    path = fresh_path(spark, "landed")
    raw.select(cut.alias("value")).write.text(path)
    return path


@query
def scan_rejects(spark, sf):
    """Lines cut short or of the wrong type are set aside, the others are read; each line is on one side."""
    scan = landing.scan_envelopes(spark, _faulty_lines(spark, sf), suffix=None)
    good = scan.good.select(F.col("_airbyte_raw_id").alias("record"), F.lit(True).alias("accepted"))
    return good.unionByName(scan.rejects().select("record", F.lit(False).alias("accepted")))


@query
def compact_rejects(spark, sf):
    """What a compaction of faulty lines stored and what it set aside; the landed files are gone."""
    landed, raw, staged = _faulty_lines(spark, sf), fresh_path(spark, "raw"), fresh_path(spark, "staging")
    counts = tables.compact_envelopes(spark, landed, raw, staged, EXTRACTION, suffix=".txt", delete_source=True)
    aside = spark.read.parquet(tables.rejects_path(raw, EXTRACTION)).select("record", F.lit(False).alias("accepted"))
    kept = files.read_parquet(spark, staged).select(F.col("_airbyte_ab_id").alias("record"), F.lit(True).alias("accepted"))
    left = files.list_files(spark, landed, ".txt").count()
    return kept.unionByName(aside).withColumns(
        {"n_good": F.lit(counts.good), "n_rejected": F.lit(counts.rejected), "n_left": F.lit(left)})


@query
def compact_late_arrival(spark, sf):
    """Two compactions of one date; half of the lines land while the first is running. They are kept and stored by the second."""
    lines = spark.read.text(_envelopes(spark, sf))
    late = F.crc32(F.col("value").cast("binary")) % 2 == 1
    landed, raw, staged = (fresh_path(spark, x) for x in ("landed", "raw", "staging"))
    lines.where(~late).write.text(landed)
    plain = tables.store_snapshot

    def arrives(*args):
        lines.where(late).write.mode("append").text(landed)
        plain(*args)

    with mock.patch.object(tables, "store_snapshot", arrives):
        tables.compact_envelopes(spark, landed, raw, staged, EXTRACTION, suffix=".txt", delete_source=True)
    kept = spark.read.text(landed, pathGlobFilter="*.txt").count()
    tables.compact_envelopes(spark, landed, raw, staged, EXTRACTION, suffix=".txt", delete_source=True)
    left = files.list_files(spark, landed, ".txt").where("length > 0").count()
    rows = landing.to_warehouse_form(files.read_parquet(spark, staged))
    return rows.withColumns({"late_lines_kept": F.lit(kept == lines.where(late).count()), "n_left": F.lit(left)})


@query
def stream_rejects(spark, sf):
    """The same lines through the stream, in two files sets and two runs."""
    landed, target, marks = _faulty_lines(spark, sf), fresh_path(spark, "silver"), fresh_path(spark, "marks")
    for _ in range(2):
        ingest.ingest_envelopes(spark, landed, target, marks, suffix=".txt").awaitTermination()
    kept = spark.read.parquet(target).select(F.col("_airbyte_ab_id").alias("record"), F.lit(True).alias("accepted"))
    aside = spark.read.parquet(f"{target}-rejects").select("record", F.lit(False).alias("accepted"))
    return kept.unionByName(aside)


@query
def compact_jsonl(spark, sf):
    landed, raw, staged = _envelopes(spark, sf), fresh_path(spark, "raw"), fresh_path(spark, "staging")
    tables.compact_envelopes(spark, landed, raw, staged, EXTRACTION, suffix=".json")
    return landing.to_warehouse_form(files.read_parquet(spark, staged))


@query
def stream_ingest(spark, sf):
    landed, target, marks = _envelopes(spark, sf), fresh_path(spark, "silver"), fresh_path(spark, "marks")
    ingest.ingest_envelopes(spark, landed, target, marks, suffix=".json").awaitTermination()
    return spark.read.schema(schemas.RAW_WEATHER).parquet(target).drop("part")


def _event_files(spark, sf) -> str:
    path = fresh_path(spark, "events")
    table(spark, sf, "events").select("event_id", "event_type").write.partitionBy("event_type").json(path)
    return path


def _types_of(listed: DataFrame) -> DataFrame:
    return listed.where("length > 0").select(F.regexp_extract("path", "event_type=([a-z]+)", 1).alias("event_type")).distinct()


@query
def list_by_suffix(spark, sf):
    """The folders that hold a JSON file; names without the suffix are not listed."""
    path = _event_files(spark, sf)
    return _types_of(files.list_files(spark, path, ".json").union(files.list_files(spark, path, ".none")))


@query
def list_by_glob(spark, sf):
    return _types_of(files.list_files(spark, f"{_event_files(spark, sf)}/event_type=[c-p]*", ".json"))


@query
def catalog_tables(spark, sf):
    """Tables of the catalog, one per region."""
    mark = "listed_" + fresh_path(spark, "x")[-32:]
    names = [r.r_regionkey for r in table(spark, sf, "region").collect()]
    for key in names:
        tables.create_if_absent(spark, f"{mark}_{key}", schemas.DEPARTMENT_CODES, fresh_path(spark, "table"), sort_by=["department"])
    found = tables.table_names(spark).where(F.col("name").startswith(mark))
    return found.select(F.substring_index("name", "_", -1).cast("int").alias("r_regionkey"))


@query
def concat_mixed_schema(spark, sf):
    raw = inputs.raw_weather_(spark, sf)
    odd = F.col("datetimeEpoch") % 2 == 1
    return files.union_all(raw.where(~odd), raw.where(odd).drop("preciptype"))


@query
def history_append(spark, sf):
    """Two parts with differing columns, the first one added twice."""
    path = fresh_path(spark, "history")
    raw = inputs.raw_weather_(spark, sf).select("id", "department", "temp", "preciptype")
    odd = F.substring("id", -1, 1).cast("int") % 2 == 1
    for _ in range(2):
        tables.append_history(raw.where(~odd), path, "even")
    tables.append_history(raw.where(odd).drop("preciptype"), path, "odd")
    return tables.read_history(spark, path, raw.schema)


@query
def select_by_schema(spark, sf):
    wide = inputs.raw_weather_(spark, sf).withColumn("tzoffset", F.lit(1.0)).withColumn("severerisk", F.lit(10))
    return landing.conform(wide, schemas.RAW_WEATHER_)


@query
def csv_round_trip(spark, sf):
    source, target = fresh_path(spark, "csv"), fresh_path(spark, "parquet")
    codes = inputs.raw_weather_(spark, sf).select(
        "department", F.format_string("%02d", (F.col("longitude") * 5).cast("int")).alias("dep_current_code")
    )
    tables.write_csv(codes, source)
    tables.csv_to_parquet(spark, source, target, schemas.DEPARTMENT_CODES)
    return files.read_parquet(spark, target, schemas.DEPARTMENT_CODES)


@query
def filename_dates(spark, sf):
    stamp = F.date_format("ts", "yyyyMMdd-HHmmss")
    names = table(spark, sf, "events").select("event_id", F.concat(F.lit("france_data_"), stamp, F.lit(".csv")).alias("f"))
    return names.select("event_id", text.dated_file_name("f").alias("file_name"), text.file_date("f").alias("file_date"))


@query
def distinct_file_dates(spark, sf):
    day = F.date_format("ts", "yyyy_MM_dd")
    prefix = F.when(F.col("event_type") == "error", "tmp_").otherwise("")
    path = F.concat(F.lit("raw/weatherdata/"), prefix, day, F.lit("_"), "event_id", F.lit(".jsonl"))
    names = table(spark, sf, "events").select(text.base_name(path).alias("name"))
    return files.distinct_file_dates(names, "name")


@query
def load_tables(spark, sf):
    """Refresh a partitioned table twice, then append; only the last refresh and the append remain."""
    raw = inputs.raw_weather_(spark, sf)
    location = fresh_path(spark, "table")
    name = "raw_weather_" + location[-32:]
    tables.create_if_absent(spark, name, schemas.RAW_WEATHER_, location, partition_by=["department"], sort_by=["datetime", "id"])
    odd = F.col("datetimeEpoch") % 2 == 1
    tables.load_table(raw, name, refresh=True)
    tables.load_table(raw.where(~odd & F.col("department").like("Nation-1%")), name, refresh=True)
    tables.load_table(raw.where(odd & F.col("department").like("Nation-2%")), name)
    return spark.table(name)


@query
def merge_daily_data(spark, sf):
    """Append a source table whose columns are in another order, twice."""
    raw = inputs.raw_weather_(spark, sf).select("id", "department", "temp")
    source, target = fresh_path(spark, "table"), fresh_path(spark, "table")
    source_name, target_name = "daily_" + source[-32:], "target_" + target[-32:]
    tables.create_if_absent(spark, source_name, raw.select("temp", "id", "department").schema, source)
    tables.create_if_absent(spark, target_name, raw.schema, target)
    tables.load_table(raw, source_name)
    for _ in range(2):
        tables.merge_daily_data(spark, source_name, target_name)
    return spark.table(target_name)


@query
def materialise_mart(spark, sf):
    return tables.materialise(stored_mart_(spark, sf), fresh_path(spark, "mart"))


# --- data quality ---------------------------------------------------------------------------------

@query
def dq_unique(spark, sf):
    return quality.duplicates(inputs.raw_weather_(spark, sf), "resolvedAddress")


@query
def dq_unique_id(spark, sf):
    raw = inputs.raw_weather_(spark, sf).select("id")
    return quality.duplicates(raw.unionAll(raw.where("id like '%7'")), "id")


@query
def dq_not_null(spark, sf):
    return quality.missing(inputs.raw_weather_(spark, sf), "snowdepth").select("id", "department", "datetime")


@query
def dq_primary_key(spark, sf):
    return quality.primary_key_violations(inputs.raw_weather_(spark, sf), "resolvedAddress")


@query
def dq_columns(spark, sf):
    """Columns that are not as declared."""
    found = inputs.raw_weather_(spark, sf).withColumnRenamed("icon", "pictogram").withColumn("more", F.lit(1))
    return quality.column_mismatches(found, schemas.RAW_COLUMNS)


def _with_nan(spark, sf):
    wet = F.col("preciptype").isNotNull()
    temp = F.when(wet, F.lit(float("nan"))).otherwise(F.col("temp"))
    return inputs.raw_weather_(spark, sf).select("id", temp.alias("temp"), "preciptype")


@query
def dq_completeness_nan(spark, sf):
    """NaN counts as missing, in the share and in the flag."""
    return quality.completeness(_with_nan(spark, sf)).join(quality.columns_with_nulls(_with_nan(spark, sf)), "column_name")


@query
def dq_completeness(spark, sf):
    return quality.completeness(inputs.raw_weather_(spark, sf))


@query
def dq_null_columns(spark, sf):
    return quality.columns_with_nulls(inputs.raw_weather_(spark, sf))


@query
def dq_unmatched_names(spark, sf):
    weather = int_most_recent_weather(spark, sf).select("department_lower")
    return quality.unmatched_names(weather, int_depcode_(spark, sf), "department_lower")
