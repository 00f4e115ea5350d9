import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from skylake import schemas
from skylake.plans import serving
from skylake.session import fresh_path, shared_dir
from skylake.sources import archive, files, landing, served, tables
from skylake.streaming import ingest
from workload.queries import QUERIES


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(date, temp=1.0, **more):
    return {"datetime": date, "temp": temp, "preciptype": ["rain"], "unknown": 1, **more}


def location(name, days):
    return {"resolvedAddress": name, "address": name.lower(), "latitude": 1.5, "longitude": 2.5, "tzoffset": 1, "days": days}


@pytest.fixture
def payload_dir(tmp_path):
    for i, names in enumerate((["Aude, Occitanie, France", "Paris"], ["Gard, France"])):
        document = {"queryCost": 1, "locations": [location(n, [day("2025-01-01"), day("2025-01-02", 2.0)]) for n in names]}
        (tmp_path / f"p{i}.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "empty.json").write_text(json.dumps({"locations": [location("Nowhere", []), location("None", None)]}))
    (tmp_path / "broken.json").write_text('{"locations": [{"resolvedAddress": "X", ')
    (tmp_path / "ignored.txt").write_text("no json")
    return str(tmp_path)


def write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"{len(os.listdir(path))}.jsonl"), "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def envelope(key, name, days):
    data = {k: v for k, v in location(name, days).items() if k != "address"}
    return {"_airbyte_raw_id": key, "_airbyte_data": data}


def test_payloads(spark, payload_dir):
    scan = landing.scan_payloads(spark, payload_dir)
    flat = landing.flatten_payloads(scan.good, "2025-01-05")
    assert flat.columns == schemas.RAW_COLUMNS
    assert rows(flat.select("department", "datetime", "temp")) == [
        (d, date, t) for d in ("Aude", "Gard", "Paris") for date, t in (("2025-01-01", 1.0), ("2025-01-02", 2.0))]
    ids = flat.select("id", "department").distinct()
    assert ids.count() == 3 and ids.select("id").distinct().count() == 3
    assert rows(ids) == rows(landing.flatten_payloads(scan.good, "2025-01-05").select("id", "department").distinct())
    assert rows(ids) != rows(landing.flatten_payloads(scan.good, "2025-01-06").select("id", "department").distinct())
    [reject] = scan.rejects().collect()
    assert reject.file_path.endswith("broken.json") and reject.record.startswith('{"locations"')
    assert rows(landing.dropped_locations(landing.records(scan.good)).select("resolvedAddress")) == [("None",), ("Nowhere",)]


def test_a_document_is_parsed_once(spark, plan, payload_dir):
    """Conditions on the parsed document and its fields share one parse, in flattened rows and in rejects."""
    scan = landing.scan_payloads(spark, payload_dir)
    for df in (landing.to_warehouse_form(landing.flatten_payloads(scan.good, "2025-01-05")), scan.rejects()):
        assert plan(df).count("from_json(") == 1


def test_warehouse_form_and_schema(spark, payload_dir):
    flat = landing.flatten_payloads(landing.scan_payloads(spark, payload_dir).good, "2025-01-05")
    loaded = landing.conform(landing.to_warehouse_form(flat.withColumn("extra", F.lit(1))), schemas.RAW_WEATHER_)
    assert [(f.name, f.dataType) for f in loaded.schema] == [(f.name, f.dataType) for f in schemas.RAW_WEATHER_]
    assert {r[0] for r in loaded.select("preciptype").collect()} == {'["rain"]'}
    assert {r[0] for r in loaded.select("stations").collect()} == {None}


def test_remove_fields(spark):
    df = spark.range(1).select("id", F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")).alias("s"))
    assert landing.remove_fields(df, "s.a", "absent", "absent.x").schema.simpleString() == "struct<id:bigint,s:struct<b:int>>"
    assert landing.remove_fields(df, "id").columns == ["s"]


def test_filter_tagged(spark):
    df = spark.createDataFrame([("1", "a", [("weather-team",), ("x",)]), ("2", "b", [("x",)]), ("3", "c", []), ("4", "d", None)],
                               "connectionId string, name string, tags array<struct<name:string>>")
    assert [tuple(r) for r in landing.filter_tagged(df, "weather-team").collect()] == [("1", "a", ["weather-team", "x"])]


def test_envelopes_set_bad_lines_aside(spark, tmp_path):
    write_lines(tmp_path / "in", [envelope("k1", "Aude, France", [day("2025-01-01")]), '{"_airbyte_raw_id": "k2", "_airb',
                                  '{"_airbyte_raw_id": "k3", "_airbyte_data": {"latitude": "north"}}'])
    scan = landing.scan_envelopes(spark, str(tmp_path / "in"))
    assert rows(landing.flatten_envelopes(scan.good).select("_airbyte_ab_id", "department")) == [("k1", "Aude")]
    assert scan.rejects().count() == 2


BAD = ['{"_airbyte_raw_id": "k2", "_airb', '{"_airbyte_raw_id": "k3", "_airbyte_data": {"latitude": "north"}}', "[1, 2]", "null", "7", "text",
       '{"_airbyte_raw_id": "k4", "_airbyte_data": {"days": [{"temp": {}}]}}']
FEW = ["", "   ", {"unknown": 1}, {"_airbyte_raw_id": "k5", "_airbyte_data": None}]


def test_each_line_is_on_one_side(spark, tmp_path):
    """Whatever columns are read."""
    write_lines(tmp_path / "in", [envelope("k1", "Aude, France", [day("2025-01-01")]), *BAD, *FEW])
    scan = landing.scan_envelopes(spark, str(tmp_path / "in"))
    assert sorted(r.record for r in scan.rejects().collect()) == sorted(BAD)
    assert scan.good.count() == 3
    assert rows(scan.good.select("_airbyte_raw_id")) == [("k1",), ("k5",), (None,)]
    assert scan.good.select("_airbyte_data.latitude").collect() == scan.good.select(F.col("_airbyte_data")["latitude"]).collect()


def test_compaction_then_delete(spark, tmp_path):
    landed, raw, staged = (str(tmp_path / x) for x in ("landed", "raw", "staged"))
    write_lines(landed, [envelope("k1", "Aude", [day("2025-01-01"), day("2025-01-02")])])
    write_lines(landed, [envelope("k2", "Gard", [day("2025-01-01")])])
    write_lines(landed, BAD)
    for _ in range(2):
        assert tables.compact_envelopes(spark, landed, raw, staged, "2025-01-05") == (2, len(BAD))
    tables.compact_envelopes(spark, landed, raw, staged, "2025-01-06")
    aside = spark.read.parquet(tables.rejects_path(raw, "2025-01-05"))
    assert sorted(r.record for r in aside.collect()) == sorted(BAD)
    assert files.read_parquet(spark, staged).count() == 3
    stored = spark.read.parquet(raw)
    assert rows(stored.groupBy("extraction_date").count()) == [
        (datetime.date(2025, 1, 5), 3), (datetime.date(2025, 1, 6), 3)]
    assert rows(files.list_files(spark, landed, ".jsonl").select("name")) == [("0.jsonl",), ("1.jsonl",), ("2.jsonl",)]
    assert tables.delete_files(spark, landed, ".jsonl") == 3
    assert [f for f in os.listdir(landed) if f.endswith(".jsonl")] == []
    write_lines(landed, [envelope("k1", "Aude", [day("2025-01-01")])])
    tables.compact_envelopes(spark, landed, raw, staged, "2025-01-07", delete_source=True)
    assert [f for f in os.listdir(landed) if f.endswith(".jsonl")] == []
    assert tables.delete_files(spark, staged, ".parquet") >= 1 and files.list_files(spark, staged, ".parquet").count() == 0


def landed_names(landed):
    return sorted(f for f in os.listdir(landed) if f.endswith((".jsonl", ".csv")))


def test_a_file_that_lands_during_a_compaction_survives(spark, tmp_path, monkeypatch):
    landed, raw, staged = (str(tmp_path / x) for x in ("lan ded", "raw", "staged"))
    write_lines(landed, [envelope("k1", "Aude", [day("2025-01-01")]), "no json", " "])
    plain = landing.flatten_envelopes

    def late(envelopes):
        write_lines(landed, [envelope("k2", "Gard", [day("2025-01-01")])])
        with open(os.path.join(landed, "0.jsonl"), "a") as f:
            f.write("\n" + json.dumps(envelope("k3", "Lot", [day("2025-01-02")])))
        return plain(envelopes)

    monkeypatch.setattr(landing, "flatten_envelopes", late)
    assert tables.compact_envelopes(spark, landed, raw, staged, "2025-01-05", delete_source=True) == (1, 1)
    # The late file is there, and so is the one that has grown since it was read.
    assert landed_names(landed) == ["0.jsonl", "1.jsonl"]
    monkeypatch.setattr(landing, "flatten_envelopes", plain)
    tables.compact_envelopes(spark, landed, raw, staged, "2025-01-05", delete_source=True)
    assert landed_names(landed) == []
    assert {r._airbyte_ab_id for r in files.read_parquet(spark, staged).collect()} == {"k1", "k2", "k3"}


def test_a_run_after_a_failed_deletion_deletes_the_same_files(spark, tmp_path, monkeypatch):
    landed, raw, staged = (str(tmp_path / x) for x in ("landed", "raw", "staged"))
    write_lines(landed, [envelope("k1", "Aude", [day("2025-01-01")])])
    write_lines(landed, [envelope("k2", "Gard", [day("2025-01-01")])])

    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables.manifest, "delete", fails)
        with pytest.raises(RuntimeError, match="lost"):
            tables.compact_envelopes(spark, landed, raw, staged, "2025-01-05", delete_source=True)
    assert landed_names(landed) == ["0.jsonl", "1.jsonl"]
    write_lines(landed, [envelope("k3", "Lot", [day("2025-01-01")])])
    # What was committed goes first, unread files are stored once.
    assert tables.compact_envelopes(spark, landed, raw, staged, "2025-01-05", delete_source=True) == (1, 0)
    assert landed_names(landed) == []
    assert sorted(r._airbyte_ab_id for r in files.read_parquet(spark, staged).collect()) == ["k1", "k2", "k3"]
    with monkeypatch.context() as m:  # a run that fails before it commits is replaced by the next
        write_lines(landed, [envelope("k4", "Lot", [day("2025-01-01")])])
        m.setattr(tables, "store_snapshot", fails)
        with pytest.raises(RuntimeError, match="lost"):
            tables.compact_envelopes(spark, landed, raw, staged, "2025-01-05", delete_source=True)
    tables.compact_envelopes(spark, landed, raw, staged, "2025-01-05", delete_source=True)
    assert sorted(r._airbyte_ab_id for r in files.read_parquet(spark, staged).collect()) == ["k1", "k2", "k3", "k4"]


def test_landed_lines_are_parsed_once(spark, tmp_path, plan):
    landed = str(tmp_path / "landed")
    write_lines(landed, [envelope("k1", "Aude", [day("2025-01-01")]), *BAD, ""])
    with landing.scan_envelopes(spark, landed).split() as found:
        assert (found.n_good, found.n_rejected) == (1, len(BAD))
        assert found.good.count() == 1 and sorted(r.record for r in found.rejects.collect()) == sorted(BAD)
        for df in (found.good, found.rejects, found.files):
            text = plan(df)
            assert "from_json" not in text and "FileScan text" not in text
        assert [r.path.rsplit("/", 1)[1] for r in found.files.collect()] == ["0.jsonl"]


def test_csv_that_lands_during_a_conversion_survives(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "csv", str(tmp_path / "out")
    source.mkdir()
    (source / "a_20250101-000000.csv").write_text("department,dep_current_code\nAin,01")
    plain = tables.manifest.commit

    def late(*args):
        (source / "b_20250102-000000.csv").write_text("department,dep_current_code\nGuyane,973")
        plain(*args)

    with monkeypatch.context() as m:
        m.setattr(tables.manifest, "commit", late)
        tables.csv_to_parquet(spark, str(source), target, schemas.DEPARTMENT_CODES, delete_source=True)
    assert landed_names(source) == ["b_20250102-000000.csv"]
    tables.csv_to_parquet(spark, str(source), target, schemas.DEPARTMENT_CODES, delete_source=True)
    assert landed_names(source) == []
    assert rows(files.read_parquet(spark, target).select("department")) == [("Ain",), ("Guyane",)]


def test_refresh_rewrites_touched_months_only(spark, tmp_path, monkeypatch):
    root, target = str(tmp_path / "archive"), str(tmp_path / "served")
    files_of = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(target) for f in names if f.endswith(".parquet")}
    full = lambda: rows(archive.latest(archive.read_archive(spark, root)).select("dates", "department", "temp", "extraction_date", "yyyymm"))
    held = lambda: rows(served.read(spark, target).select("dates", "department", "temp", "extraction_date", "yyyymm"))
    with pytest.raises(Exception):
        served.refresh(spark, root, target)  # no archive yet
    archive.append_batch(mart(spark, [("a", "2025-01-30", "Aude", "11", 1.0), ("a", "2025-02-01", "Aude", "11", 2.0)]), root, "2025-01-30")
    assert served.refresh(spark, root, target) == ["202501", "202502"] and held() == full()
    assert served.refresh(spark, root, target) == []
    before = files_of()
    archive.append_batch(mart(spark, [("b", "2025-02-01", "Aude", "11", 3.0), ("b", "2025-02-02", "Gard", "30", 4.0)]), root, "2025-01-31")
    assert served.refresh(spark, root, target) == ["202502"] and held() == full() and len(held()) == 3
    assert {f for f in files_of() if f not in before} and all(files_of()[f] == t for f, t in before.items())
    assert all("yyyymm=202502" in f for f in files_of() if f not in before)
    # A load that is replaced by one of other months touches both; a failure before the log leaves the version before.
    archive.append_batch(mart(spark, [("c", "2025-03-01", "Aude", "11", 5.0)]), root, "2025-01-31")
    seen = held()
    with monkeypatch.context() as m:
        m.setattr(spark.createDataFrame([], "x int").write.__class__, "parquet", lambda self, path, *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            served.refresh(spark, root, target)
    assert held() == seen
    assert served.refresh(spark, root, target) == ["202502", "202503"] and held() == full() and len(held()) == 3
    assert served.vacuum(spark, target) and held() == full()
    assert rows(served.read(spark, target).where("yyyymm = '202503'").select("temp")) == [(5.0,)]


def test_region_sums_follow_replaced_loads(spark, tmp_path):
    root, target = str(tmp_path / "archive"), str(tmp_path / "served")
    loads = [("2025-01-30", [("a", "2025-01-30", "Aude", "11", 1.0), ("a", "2025-02-01", "Aude", "11", 2.0), ("a", "2025-02-01", "Gard", "30", None)]),
             ("2025-01-31", [("b", "2025-02-01", "Aude", "11", 30.25), ("b", "2025-02-01", "Lot", "46", 1e16)]),
             ("2025-01-31", [("b", "2025-02-01", "Gard", "30", 4.5), ("b", "2025-02-02", "Lot", "46", float("nan"))])]
    for day, some in loads:
        one = mart(spark, some).withColumn("reg_name", F.expr("if(department = 'Lot', null, 'Sud')"))
        archive.append_batch(one, root, day)
        served.refresh(spark, root, target)
        latest = archive.latest(archive.read_archive(spark, root))
        sums = served.region_sums(spark, target)
        stored, whole = serving.get_region_history(sums, "Sud"), serving.get_entire_region_data(latest, "Sud")
        assert stored.schema == whole.schema and rows(stored) == rows(whole)
        assert sums.count() == latest.select("dates", "reg_name").distinct().count()
    assert [r.temp for r in stored.collect()] == [1.0, 3.2]
    assert stored.inputFiles() and all(f"{target}-sums/" in f for f in stored.inputFiles())
    assert served.vacuum(spark, target) and rows(serving.get_region_history(served.region_sums(spark, target), "Sud")) == rows(whole)


def test_only_bad_lines_are_an_error_and_are_kept(spark, tmp_path):
    landed, raw, staged = (str(tmp_path / x) for x in ("landed", "raw", "staged"))
    write_lines(landed, BAD)
    with pytest.raises(ValueError, match="empty"):
        tables.compact_envelopes(spark, landed, raw, staged, "2025-01-05", delete_source=True)
    assert os.listdir(landed) and spark.read.parquet(tables.rejects_path(raw, "2025-01-05")).count() == len(BAD)


def test_empty_input_is_an_error(spark, tmp_path):
    empty = spark.createDataFrame([], "column1 int")
    for call in (lambda: tables.store_snapshot(empty, str(tmp_path / "x")), lambda: tables.load_table(empty, "any"),
                 lambda: tables.store_extraction(empty, str(tmp_path / "x"), "2025-01-01")):
        with pytest.raises(ValueError, match="empty"):
            call()


def test_missing_table_is_an_error(spark):
    with pytest.raises(ValueError, match="Table .* does not exist"):
        tables.load_table(spark.range(3), "absent_table")


def test_refresh_append_merge(spark):
    schema = spark.createDataFrame([], "id int, name string").schema
    for name in ("t_daily", "t_target"):
        tables.create_if_absent(spark, name, schema)
        tables.create_if_absent(spark, name, schema)
    assert {"t_daily", "t_target"} <= set(tables.list_tables(spark))
    with pytest.raises(ValueError, match="Data from Table .* to be appended is empty"):
        tables.merge_daily_data(spark, "t_daily", "t_target")
    swapped = spark.createDataFrame([("a", 1, True)], "name string, id int, more boolean")
    tables.load_table(swapped, "t_daily")
    tables.load_table(swapped, "t_daily")
    assert rows(spark.table("t_daily")) == [(1, "a"), (1, "a")]
    tables.load_table(swapped, "t_daily", refresh=True)
    for _ in range(2):
        tables.merge_daily_data(spark, "t_daily", "t_target")
    assert rows(spark.table("t_target")) == [(1, "a")]
    assert rows(tables.run_query(spark, "select name from t_target where id = :id", {"id": 1})) == [("a",)]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_refresh_of_a_partitioned_table_leaves_only_new_rows(spark, tmp_path, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        schema = spark.createDataFrame([], "id int, v int, part string").schema
        name = f"t_parted_{mode}"
        tables.create_if_absent(spark, name, schema, f"{tmp_path}/it's here", partition_by=["part"], sort_by=["v", "id"])
        assert tables.sort_key(spark, name) == ["v", "id"]
        tables.load_table(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], schema), name)
        many = spark.range(2000).selectExpr("cast(id as int) id", "cast(-id as int) v", "'a' part")
        tables.load_table(many, name, refresh=True)
        assert spark.table(name).count() == 2000 and spark.table(name).where("part = 'b'").count() == 0
        for file in files.list_files(spark, f"{tmp_path}/it's here/part=a", ".parquet").collect():
            values = [r.v for r in spark.read.parquet(file.path).collect()]
            assert values == sorted(values)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_csv_codes_stay_text(spark, tmp_path):
    names = [("Ain", "01"), ("Corse-du-Sud", "2A"), ("Guyane", "973")]
    source = tmp_path / "csv"
    source.mkdir()
    (source / "france_data_20250102-182912.csv").write_text(
        "department,dep_current_code\n" + "\n".join(",".join(n) for n in names))
    tables.csv_to_parquet(spark, str(source), str(tmp_path / "out"), schemas.DEPARTMENT_CODES)
    got = files.read_parquet(spark, str(tmp_path / "out"))
    assert rows(got) == [(*n, "france_weather_2025-01-02.csv", datetime.date(2025, 1, 2)) for n in names]
    tables.write_csv(got.select("department", "dep_current_code"), str(tmp_path / "again"))
    assert rows(files.read_csv(spark, str(tmp_path / "again"), schemas.DEPARTMENT_CODES)) == names


def test_history_with_differing_columns(spark, tmp_path):
    path = str(tmp_path / "h")
    for _ in range(2):
        tables.append_history(spark.createDataFrame([(1, "a")], "id int, t string"), path, "2025-01-01")
    tables.append_history(spark.createDataFrame([(2, 0.5)], "id int, v double"), path, "2025-01-02")
    schema = spark.createDataFrame([], "id int, t string, v double").schema
    assert rows(tables.read_history(spark, path, schema)) == [(1, "a", None), (2, None, 0.5)]


def test_concat_and_file_dates(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2,)], "a int")
    assert rows(files.union_all(a, b)) == [(1, "x"), (2, None)]
    names = spark.createDataFrame([("2025_01_02_x.jsonl",), ("2025_01_02_y.jsonl",), ("tmp_2025_01_02",), ("2025-01-02",)], "n string")
    assert rows(files.distinct_file_dates(names, "n")) == [("2025_01_02",)]


def mart(spark, entries):
    names = schemas.MART_NEWDATA.fieldNames()
    given = [dict(zip(("record_id", "dates", "department", "dep_code", "temp", "dep_distance"), e)) for e in entries]
    data = [tuple(datetime.date.fromisoformat(g[n]) if n == "dates" else g.get(n) for n in names) for g in given]
    return spark.createDataFrame(data, schemas.MART_NEWDATA)


SHOWN = ["record_id", "dates", "department", "temp"]
DAY1 = [("r1", "2025-01-30", "Aude", "11", 1.0), ("r1", "2025-01-31", "Aude", "11", 2.0), ("r2", "2025-02-01", "Gard", "30", 3.0)]
DAY2 = [("r9", "2025-01-31", "Aude", "11", 9.0), ("r8", "2025-02-02", "Gard", "30", 8.0)]


def test_archive_loads_are_idempotent(spark, tmp_path):
    root = str(tmp_path / "archive")
    for entries, date in ((DAY1, "2025-01-30"), (DAY2, "2025-01-31"), (DAY1, "2025-01-30")):
        archive.append_batch(mart(spark, entries), root, date)
    stored = archive.read_archive(spark, root)
    assert stored.count() == 5
    assert sorted({r.yyyymm for r in stored.collect()}) == ["202501", "202502"]
    newest = [(r, datetime.date.fromisoformat(d), n, t) for r, d, n, _, t in (DAY1[0], DAY2[0], DAY1[2], DAY2[1])]
    assert rows(archive.latest(stored).select(*SHOWN)) == sorted(newest, key=repr)
    archive.append_batch(mart(spark, DAY1[2:]), root, "2025-01-30")
    assert archive.read_archive(spark, root).count() == 3
    archive.compact(archive.read_archive(spark, root), str(tmp_path / "compact"))
    assert archive.read_archive(spark, str(tmp_path / "compact")).count() == 3


def test_the_closest_department_of_an_observation_is_archived(spark, tmp_path):
    """Aube (10) is one edit from Aude (11) and has the lower code."""
    entries = [("r1", "2025-01-30", "Aude", "10", 1.0, 1), ("r1", "2025-01-30", "Aude", "11", 1.0, 0), ("r1", "2025-01-30", "Aude", "09", 1.0, None),
               ("r2", "2025-01-31", "Aude", "10", 2.0, 1), ("r1", "2025-01-31", "Aude", "11", 1.0, 0)]
    got = archive.latest(mart(spark, entries)).select("dates", "record_id", "dep_code")
    assert rows(got) == [(datetime.date(2025, 1, 30), "r1", "11"), (datetime.date(2025, 1, 31), "r2", "10")]


def test_archived_data_takes_the_newest_of_both(spark):
    old = mart(spark, DAY1).withColumn("extraction_date", F.lit("2025-01-30").cast("date"))
    new = mart(spark, DAY2).withColumn("extraction_date", F.lit("2025-01-31").cast("date"))
    got = archive.archived_data(old, new).select(*SHOWN, "yyyymm")
    assert rows(got.select("record_id", "yyyymm")) == [("r1", "202501"), ("r2", "202502"), ("r8", "202502"), ("r9", "202501")]


def test_months_are_filtered_before_versions(spark, tmp_path, plan):
    root = str(tmp_path / "archive")
    for entries, date in ((DAY1, "2025-01-30"), (DAY2, "2025-01-31")):
        archive.append_batch(mart(spark, entries), root, date)
    found = archive.latest_between(archive.read_archive(spark, root), "2025-01-31", "2025-01-31")
    assert rows(found.select("record_id", "temp")) == [("r9", 9.0)]
    assert "PartitionFilters: [isnotnull(yyyymm" in plan(found)
    archive.compact(archive.read_archive(spark, root), str(tmp_path / "served"))
    region = archive.read_archive(spark, str(tmp_path / "served")).where("reg_name = 'X'")
    assert "EqualTo(reg_name,X)" in plan(region)


def test_archive_reads_only_the_months_asked_for(spark, tmp_path, plan):
    root = str(tmp_path / "archive")
    archive.append_batch(mart(spark, DAY1), root, "2025-01-30")
    found = archive.between_dates(archive.read_archive(spark, root), "2025-01-31", "2025-01-31")
    assert rows(found.select("record_id", "temp")) == [("r1", 2.0)]
    assert "PartitionFilters: [isnotnull(yyyymm" in plan(found)
    with pytest.raises(ValueError, match="empty"):
        archive.append_batch(mart(spark, []), root, "2025-01-30")


def test_stream_ingests_each_file_once(spark, tmp_path):
    landed, target, marks = (str(tmp_path / x) for x in ("landed", "silver", "marks"))
    write_lines(landed, [envelope("k1", "Aude", [day("2025-01-01")]), "broken"])
    ingest.ingest_envelopes(spark, landed, target, marks).awaitTermination()
    write_lines(landed, [envelope("k2", "Gard", [day("2025-01-01"), day("2025-01-02")])])
    for _ in range(2):
        ingest.ingest_envelopes(spark, landed, target, marks).awaitTermination()
    got = spark.read.schema(schemas.RAW_WEATHER).parquet(target)
    assert rows(got.groupBy("department", "preciptype").count()) == [("Aude", '["rain"]', 1), ("Gard", '["rain"]', 2)]
    aside = spark.read.parquet(f"{target}-rejects")
    assert [(r.record, r.file_path.endswith("0.jsonl")) for r in aside.collect()] == [("broken", True)]


def test_streams_do_not_erase_each_other(spark, tmp_path):
    root = str(tmp_path / "archive")
    for name, entries in (("a", DAY1[:1]), ("b", DAY1[1:])):
        mart(spark, entries).withColumn("extraction_date", F.lit("2025-01-30").cast("date")).write.parquet(str(tmp_path / name))
        ingest.archive_daily(spark, str(tmp_path / name), root, str(tmp_path / f"marks-{name}")).awaitTermination()
    assert archive.read_archive(spark, root).count() == 3
    ingest.archive_daily(spark, str(tmp_path / "a"), root, str(tmp_path / "marks-new")).awaitTermination()
    assert archive.latest(archive.read_archive(spark, root)).count() == 3


def test_archive_stream_keeps_all_files_of_a_day(spark, tmp_path):
    drop, root, marks = (str(tmp_path / x) for x in ("drop", "archive", "marks"))
    for entries, date in ((DAY1[:1], "2025-01-30"), (DAY1[1:], "2025-01-30"), (DAY2, "2025-01-31")):
        mart(spark, entries).withColumn("extraction_date", F.lit(date).cast("date")).coalesce(1).write.mode("append").parquet(drop)
    ingest.archive_daily(spark, drop, root, marks, max_files=1).awaitTermination()
    ingest.archive_daily(spark, drop, root, marks, max_files=1).awaitTermination()
    stored = archive.read_archive(spark, root)
    assert stored.count() == 5
    assert {r[0] for r in rows(archive.latest(stored).select("record_id"))} == {"r1", "r2", "r8", "r9"}


def test_intermediate_tables_go_to_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(f"{shared_dir(spark)}/skylake/{spark.sparkContext.applicationId}/x-")


class Cluster:
    """What `shared_dir` asks of a session."""

    def __init__(self, master, folder):
        self.sparkContext = type("C", (), {"master": master, "applicationId": "a"})
        self.conf = type("F", (), {"get": staticmethod(lambda *_: folder)})


@pytest.mark.parametrize("folder", [None, "file:/tmp/x"])
def test_a_cluster_needs_a_shared_folder(folder):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster("yarn", folder))
    assert shared_dir(Cluster("yarn", "hdfs://x/")) == "hdfs://x"


def versions(spark, n=40):
    """Rows of two departments and two months with all columns of the archive, in falling order of their ids."""
    some = {"record_id": F.format_string("r%03d", n - F.col("id")), "dep_distance": F.lit(0), "dep_code": F.lit("1"), "temp": F.col("id").cast("double"),
            "dates": F.date_add(F.lit("2024-01-30").cast("date"), (F.col("id") % 4).cast("int")), "department": F.concat(F.lit("d"), F.col("id") % 2)}
    return spark.range(0, n, 1, 1).select(*[some.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.ARCHIVED_DATA.fields])


def test_latest_moves_whole_rows_of_winners_only(spark, tmp_path, plan):
    archive.append_batch(versions(spark), str(tmp_path), "2024-02-01")
    archive.append_batch(versions(spark, 20), str(tmp_path), "2024-02-02")
    found = archive.latest(archive.read_archive(spark, str(tmp_path)))
    assert "LeftSemi" in plan(found)
    best = {(r.dates, r.department): r.record_id for r in versions(spark, 20).orderBy("record_id").collect()}
    assert rows(found.select("dates", "department", "record_id", F.col("extraction_date").cast("string"))) == sorted((*k, v, "2024-02-02") for k, v in best.items())


def test_many_winners_are_compared_as_whole_rows(spark, monkeypatch, plan):
    few = archive.latest(versions(spark))
    monkeypatch.setattr("skylake.operators.lookup.MAX_ROWS", 1)
    many = archive.latest(versions(spark))
    assert "LeftSemi" in plan(few) and "LeftSemi" not in plan(many) and rows(few) == rows(many)


def test_a_load_is_written_as_it_comes(spark, tmp_path):
    archive.append_batch(versions(spark), str(tmp_path), "2024-02-01")
    for month in ("202401", "202402"):
        held = spark.read.parquet(f"{tmp_path}/extraction_date=2024-02-01/part=daily/yyyymm={month}").coalesce(1).collect()
        assert held and [r.record_id for r in held] == sorted((r.record_id for r in held), reverse=True)


def test_a_mart_in_order_is_stored_without_a_shuffle(spark, tmp_path):
    stored = tables.store(versions(spark), str(tmp_path / "m"), ordered=True)
    assert [r.record_id for r in stored.table.coalesce(1).collect()] == [r.record_id for r in versions(spark).collect()]
    assert stored.first == datetime.date(2024, 1, 30)


def test_distinct_tells_rows_apart_like_spark(spark, tmp_path):
    n = F.col("id") % 40_000
    odd = spark.range(90_000).select(
        n.alias("k"), F.when(n % 3 == 0, "a").alias("s"), F.when(n % 3 == 1, "a").alias("t"), F.when(F.col("id") < 40_000, -0.0).otherwise(0.0).alias("x"),
        F.when(n % 5 == 0, float("nan")).when(n % 5 == 1, F.lit(None)).otherwise(1.5).cast("float").alias("y"), (n % 2 == 0).alias("b"))
    for part, some in enumerate((odd.coalesce(1), odd.where("k < 7"), odd.where("k is null"), odd.drop("k").withColumn("k", F.lit(None).cast("bigint")))):
        some.select(*odd.columns).write.parquet(f"{tmp_path}/part={part}")
    stored = spark.read.parquet(str(tmp_path)).drop("part")
    found, want = archive.distinct(stored), stored.distinct()
    assert found.dtypes == want.dtypes and sorted(map(repr, found.collect())) == sorted(map(repr, want.collect())) and want.count() > 40_000


def test_distinct_moves_no_whole_rows(spark, tmp_path, plan, monkeypatch):
    for part in "ab":
        archive.append_dated(versions(spark, 50).withColumn("extraction_date", F.lit("2024-02-01").cast("date")), str(tmp_path), part)
    stored = archive.read_archive(spark, str(tmp_path)).drop("yyyymm")
    found = archive.distinct(stored)
    assert rows(found) == rows(stored.distinct()) and found.count() == stored.count() / 2
    assert "Exchange hashpartitioning" not in plan(found)
    monkeypatch.setattr("skylake.operators.lookup.MAX_BYTES", 1)
    assert rows(archive.distinct(stored)) == rows(found)
    nested = stored.withColumn("list", F.array("record_id"))
    assert archive.distinct(nested).count() == found.count()


def test_two_streams_shuffle_no_whole_rows(spark, plan):
    assert "Exchange hashpartitioning" not in plan(QUERIES["archive_two_streams"](spark, "/root/testdata/sf0.001"))
