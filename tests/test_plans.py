import datetime
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skylake import schemas
from skylake.operators import lookup
from skylake.plans import dimension, marts, serving, staging, views
from skylake.sources import tables

NAMES = [("Aude", "AUDE", "11", "Occitanie"), ("Aube", "AUBE", "10", "Grand Est"), ("Val-d'Oise", "VAL D OISE", "95", None),
         ("Corse-du-Sud", "CORSE DU SUD", "2A", "Corse"), ("Haute Corse", "HAUTE CORSE", "2B", "Corse")]


@pytest.fixture
def depcode(spark):
    data = [(None, "{}", reg, "1", upper, code, None if code == "11" else "rural", name, upper)
            for name, upper, code, reg in NAMES]
    return spark.createDataFrame(data, schemas.RAW_DEPCODE_)


def weather(spark, entries, schema):
    """entries: (id, department, date, temp, solarenergy, snowdepth)"""
    given = ("id", "department", "datetime", "temp", "solarenergy", "snowdepth")
    data = []
    for e in entries:
        values = dict(zip(given, e)) | {"_airbyte_ab_id": e[0], "solarradiation": e[4], "moonphase": 0.25}
        data.append(tuple(values.get(n) for n in schema.fieldNames()))
    return spark.createDataFrame(data, schema)


ENTRIES = [
    ("r1", "Aude", "2025-01-01", 1.0, 10.0, None), ("r2", "Aude", "2025-01-02", 2.0, 20.0, 3.0),
    ("r3", "Aube", "2025-01-04", 3.0, 30.0, 4.0), ("r4", "Val d’Oise", "2025-01-04", 4.0, 40.0, float("nan")),
    ("r5", "VAL-D'OISE", "2025-01-05", None, None, None), ("r6", "Corse", "2025-01-01", 6.0, 60.0, 5.0),
    ("r7", "Meuse", "2025-01-01", 7.0, 70.0, 5.0), ("r8", None, "2025-01-01", 8.0, 80.0, 5.0),
]


def models_(spark, depcode):
    raw = weather(spark, ENTRIES, schemas.RAW_WEATHER_)
    return (staging.int_most_recent_weather_(staging.stg_most_recent_weather_(raw)),
            staging.int_depcode_(staging.stg_depcode_(depcode)))


def models(spark, depcode):
    raw = weather(spark, ENTRIES, schemas.RAW_WEATHER)
    return (staging.int_most_recent_weather(staging.stg_most_recent_weather(raw)),
            staging.int_depcode(staging.stg_depcode(depcode.drop("department", "dep_normalized"))))


def test_staging(spark, depcode):
    w, d = models_(spark, depcode)
    snow = {r.record_id: r.snowdepth_filled for r in w.collect()}
    assert snow["r1"] == 4.4 and snow["r4"] == 4.4 and snow["r2"] == 3.0
    assert {r.dep_code: r.dep_status for r in d.collect()}["11"] == "undefined"
    first = w.where("record_id = 'r1'").first()
    assert (first.dates, first.weekday_name, first.solarenergy_kwhpm2) == (datetime.date(2025, 1, 1), "Wednesday", 2.778)


@pytest.mark.parametrize("small", [True, False])
def test_exact_mart(spark, depcode, small, monkeypatch):
    if not small:
        monkeypatch.setattr(lookup, "MAX_ROWS", 0)
    mart = marts.mart_newdata_(*models_(spark, depcode))
    assert [(f.name, f.dataType) for f in mart.schema] == [(f.name, f.dataType) for f in schemas.MART_NEWDATA_]
    got = {r.record_id: r for r in mart.collect()}
    assert {k: v.dep_name for k, v in got.items()} == {
        "r1": "AUDE", "r2": "AUDE", "r3": "AUBE", "r4": "VAL D OISE", "r5": "VAL D OISE"}
    assert (got["r1"].avg_solarradiation, got["r3"].avg_solarradiation) == (15.0, 30.0)
    # Departments without a region are one group, and a missing value does not count.
    assert got["r4"].reg_name is None and got["r5"].avg_solarradiation == 40.0


@pytest.mark.parametrize("small", [True, False])
def test_tolerant_mart(spark, depcode, small, monkeypatch):
    if not small:
        monkeypatch.setattr(lookup, "MAX_ROWS", 0)
    mart = marts.mart_newdata(*models(spark, depcode))
    assert mart.columns == schemas.FUZZY_MART_COLUMNS
    got = sorted((r.record_id, r.dep_code, r.dep_distance) for r in mart.collect())
    assert got == [("r1", "10", 1), ("r1", "11", 0), ("r2", "10", 1), ("r2", "11", 0), ("r3", "10", 0), ("r3", "11", 1),
                   ("r4", "95", 0), ("r5", "95", 0), ("r6", "2A", 0), ("r6", "2B", 1)]
    averages = {r.reg_name: r.avg_solarradiation for r in mart.collect()}
    assert averages == {"Occitanie": 20.0, "Grand Est": 20.0, "Corse": 60.0, None: 40.0}
    best = marts.mart_newdata(*models(spark, depcode), best_only=True)
    assert sorted((r.record_id, r.dep_code) for r in best.collect()) == [
        ("r1", "11"), ("r2", "11"), ("r3", "10"), ("r4", "95"), ("r5", "95"), ("r6", "2A")]


def test_mart_pass_has_no_shuffle(spark, depcode, plan):
    mart = marts.mart_newdata_(*models_(spark, depcode))
    text = plan(mart)
    main = text.split("Initial Plan")[0]
    assert "BroadcastHashJoin" in main and "Window" not in text and "hashpartitioning" not in main
    assert "NestedLoop" not in text and "Cartesian" not in text and "BatchEvalPython" not in text


def test_reports_and_served_queries_read_the_stored_mart_once(spark, depcode, tmp_path, plan):
    mart, first = tables.store(marts.mart_newdata_(*models_(spark, depcode)), str(tmp_path / "mart"))
    assert first == datetime.date(2025, 1, 1)
    served = [views.mart_today(mart, first), views.mart_next_3_days(mart, first), serving.get_temp_data(mart, "Aude"),
              views.leaderboard("dep_3d_top3_temperature", views.mart_next_3_days(mart, first)),
              serving.get_stats(views.mart_today(mart, first), views.mart_next_3_days(mart, first), "region")]
    for df in served:
        # Locations are cut in a plan's text, so the files say what is read; the text says that it is read once.
        assert {f.rsplit("/", 2)[1] for f in df.inputFiles()} == {"mart"}
        assert len(re.findall("FileScan parquet", plan(df).split("Initial Plan")[0])) == 1
    assert "PushedFilters: [IsNotNull(department), EqualTo(department,Aude)]" in plan(serving.get_temp_data(mart, "Aude"))
    assert [r.department for r in views.mart_today(mart, first).collect()] == ["Aude"]
    empty = tables.store(mart.where("false"), str(tmp_path / "empty"))
    assert empty.first is None and views.mart_today(*empty).count() == 0


def test_views_and_leaderboards(spark, depcode, plan):
    mart = marts.mart_newdata_(*models_(spark, depcode))
    today, following = views.mart_today(mart), views.mart_next_3_days(mart)
    assert [r.department for r in today.collect()] == ["Aude"]
    assert sorted(r.department for r in following.collect()) == ["Aube", "Aude", "Val d’Oise"]
    stats = views.mart_next_3_days_stats(following)
    w = {c: Window.partitionBy(c) for c in ("department", "reg_name")}
    by_window = following.withColumn("depavg_temp_c", F.round(F.avg("temp").over(w["department"]), 1)) \
        .withColumn("regavg_humidity", F.round(F.avg("humidity").over(w["reg_name"]), 2))
    names = ["department", "reg_name", "depavg_temp_c", "regavg_humidity"]
    assert sorted(map(tuple, stats.select(*names).collect()), key=repr) == \
        sorted(map(tuple, by_window.select(*names).collect()), key=repr)
    for name, board in views.LEADERBOARDS.items():
        rows = following if board.three_days else today
        result = views.leaderboard(name, rows)
        assert result.columns == [board.key, board.column]
    assert "TakeOrderedAndProject" in plan(views.leaderboard("reg_3d_top3_humidity", following))
    assert len(views.LEADERBOARDS) == 34


def test_three_day_boards_equal_the_stats_view(spark, depcode):
    mart = marts.mart_newdata_(*models_(spark, depcode))
    following = views.mart_next_3_days(mart)
    stats = views.mart_next_3_days_stats(following)
    direct = views.leaderboard("dep_3d_top3_temperature", following).collect()
    shown = stats.groupBy("department").agg(F.max("depavg_temp_c").alias("t")).orderBy(F.desc("t"), "department").limit(3).collect()
    assert [tuple(r) for r in direct] == [tuple(r) for r in shown]


def test_serving(spark, depcode):
    mart = marts.mart_newdata_(*models_(spark, depcode))
    assert [r.temp for r in serving.get_temp_data(mart, "Aude").collect()] == [1.0, 2.0]
    assert serving.get_temp_data(mart, "x' or 1=1 --").count() == 0
    assert serving.get_solarenergy_geo_data(mart, "2025-01-04").count() == 2
    energy = serving.get_solarenergy_agg_pday(mart, "Aude").first()
    assert (energy.solarenergy_kwhpm2, energy.available_solarenergy_kwhc) == (4.167, 4.167 * 2.7)
    assert [r.dates.day for r in serving.get_entire_region_data(mart, "Occitanie").collect()] == [1, 2]
    today, following = views.mart_today(mart), views.mart_next_3_days(mart)
    assert serving.get_stats(today, following, "region", "next3days").count() == 3
    lowest = serving.get_stats(today, following, "department", "next3days", top=False, rank_by="temperature", k=1)
    assert lowest.first().geo_name == "Aude"
    for bad in ({"level": "city"}, {"period": "week"}, {"rank_by": "height"}):
        with pytest.raises(ValueError):
            serving.get_stats(today, following, **bad)


def test_dimension(spark):
    names = spark.createDataFrame([("Côtes-d'Armor", "22"), ("Ain", "01")], schemas.DEPARTMENT_CODES)
    geography = spark.createDataFrame(
        [(None, bytearray(b"bad"), "Bretagne", 53, "COTES D ARMOR", "22", None), (None, None, "X", 1, "Y", "99", "urbain")],
        "geo_point_2d binary, geo_shape binary, reg_name string, reg_code int, dep_name_upper string, "
        "dep_current_code string, dep_status string")
    built = dimension.build_depcode(dimension.region_columns(geography), names)
    assert [(f.name, f.dataType) for f in built.schema] == [(f.name, f.dataType) for f in schemas.RAW_DEPCODE_]
    got = {r.dep_current_code: r for r in built.collect()}
    assert got["22"].dep_normalized == "COTES D ARMOR" and got["22"].geo_shape is None and got["22"].reg_code == "53"
    assert got["99"].department is None and got["99"].dep_status == "urbain"
