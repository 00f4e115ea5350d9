import math
import random
import struct
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from skylake.functions import geometry, labels, numeric, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize("value, digits, expected", [
    (0.5, 0, 0.0), (1.5, 0, 2.0), (2.5, 0, 2.0), (-2.5, 0, -2.0), (0.25, 1, 0.2), (0.35, 1, 0.4), (1.005, 2, 1.0),
    (None, 1, None),
])
def test_round_half_even(spark, value, digits, expected):
    assert one(spark, numeric.round_half_even(F.lit(value).cast("double"), digits)) == expected


@pytest.mark.parametrize("kind", ["thousandths", "tiny", "large", "fifteen digits", "mixed"])
def test_exact_avg_is_exact_in_any_order(spark, kind):
    rng = random.Random(1)
    make = {
        "thousandths": lambda: rng.randint(-(10**9), 10**9) / 1000, "tiny": lambda: rng.choice([1e-7, 3e-7, -2e-9]),
        "large": lambda: rng.choice([1e13, -3e13, 9.9e14]) + rng.random(), "fifteen digits": lambda: rng.uniform(-1, 1),
        "mixed": lambda: rng.uniform(-1, 1) * 10 ** rng.randint(-12, 14),
    }[kind]
    values = [make() for _ in range(2000)]
    expected = math.fsum(values) / len(values)
    for parts in (1, 3, 7):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        assert df.agg(numeric.exact_avg("v")).first()[0] == pytest.approx(expected, rel=1e-15)
        assert len({df.repartition(p).agg(numeric.exact_avg("v")).first()[0] for p in (1, 2, 5)}) == 1


@pytest.mark.parametrize("values, expected", [
    ([1e-7, 3e-7], 2e-7), ([1e-30, 3e-30], 2e-30), ([1e300, 1e300, 1.0], 2e300 / 3), ([math.inf, 1.0], math.inf), ([2.0**50, 2.0], 2.0**49 + 1),
    ([-math.inf, -math.inf], -math.inf), ([-0.5, -1.5], -1.0), ([0.1], 0.1), ([1e13, 1e-7], (1e13 + 1e-7) / 2)])
def test_no_value_is_cut(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(numeric.exact_avg("v")).first()[0] == pytest.approx(expected, rel=1e-15)


def test_exact_avg_missing_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", math.nan), ("a", 2.0), ("b", None)], "k string, v double")
    assert dict(df.groupBy("k").agg(numeric.exact_avg("v")).collect()) == {"a": 1.5, "b": None}
    assert df.where("false").agg(numeric.exact_avg("v")).first()[0] is None


def test_sums_of_sums_equal_one_average(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") / 8 - 50).alias("v"))
    merged = df.groupBy("k").agg(*numeric.exact_sums("v", "v")).agg(numeric.avg_of_sums("v")).first()[0]
    assert merged == df.agg(numeric.exact_avg("v")).first()[0]


def test_unit_conversions(spark):
    assert one(spark, numeric.fahrenheit_to_celsius(F.lit(212.0))) == 100.0
    assert one(spark, numeric.inch_to_cm(F.lit(10.0))) == 25.0
    assert one(spark, numeric.inch_to_mm(F.lit(1.5))) == 38.1
    assert one(spark, numeric.mph_to_kph(F.lit(100.0))) == 160.9
    assert one(spark, numeric.mj_to_kwh_per_m2(F.lit(10.0))) == 2.778


def test_nan_to_null_leaves_other_types(spark):
    df = spark.createDataFrame([(math.nan, "x", 1), (1.5, None, 2)], "a double, b string, c int")
    assert [tuple(r) for r in numeric.nan_columns_to_null(df).collect()] == [(None, "x", 1), (1.5, None, 2)]


def test_every_character_is_keyed_like_nfd(spark):
    """One row per code point: the translate table must equal NFD followed by dropping marks."""
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"]
    codes = [c for c in codes if c < 0x3100 or unicodedata.decomposition(chr(c))]
    bases = {c: [x for x in unicodedata.normalize("NFD", chr(c)) if ord(x) < 128] for c in codes}
    assert all(len(b) <= 1 for c, b in bases.items())
    df = spark.createDataFrame([(c, "a" + chr(c) + "z") for c in codes], "code int, s string")
    got = dict(df.select("code", text.name_key("s")).collect())
    wrong = [c for c in codes if got[c] != "a" + "".join(x for x in bases[c] if x.isalnum()).lower() + "z"]
    assert wrong == []


@pytest.mark.parametrize("raw, expected", [
    ("Val-d'Oise", "VAL D OISE"), ("  Côtes-d'Armor ", "COTES D ARMOR"), ("Hautes--Pyrénées", "HAUTES PYRENEES"),
    ("Œuvre\tÉté", "UVRE ETE"), (None, None), ("", ""),
])
def test_normalize_name(spark, raw, expected):
    assert one(spark, text.normalize_name(F.lit(raw).cast("string"))) == expected


def test_text_helpers(spark):
    assert one(spark, text.first_part(F.lit("Aude, Occitanie, France"))) == "Aude"
    assert one(spark, text.first_part(F.lit("Aude"))) == "Aude"
    assert one(spark, text.list_to_text(F.array(F.lit("rain"), F.lit("snow")))) == '["rain","snow"]'
    assert one(spark, text.base_name(F.lit("raw/weatherdata/2025_01_02_x.jsonl"))) == "2025_01_02_x.jsonl"
    name = F.lit("france_data_20250102-182912.csv")
    assert one(spark, text.dated_file_name(name)) == "france_weather_2025-01-02.csv"
    assert str(one(spark, text.file_date(name))) == "2025-01-02"
    assert one(spark, text.file_date(F.lit("france.csv"))) is None


def test_moonphase_labels(spark):
    phases = [0.0, 0.1, 0.25, 0.3, 0.5, 0.6, 0.75, 0.9, 1.0, None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(phases)], "i int, p double").orderBy("i")
    assert [r[0] for r in df.select(labels.moonphase_label("p")).collect()] == [
        "new moon", "waxing crescent", "waxing crescent", "waxing gibbous", "waxing gibbous", "waning gibbous",
        "waning gibbous", "waning crescent", "waning crescent", "waning crescent"]
    assert [r[0] for r in df.select(labels.moonphase_label("p", strict=True)).collect()] == [
        "new moon", "waxing crescent", "first quarter", "waxing gibbous", "full moon", "waning gibbous",
        "last quarter", "waning crescent", "waning crescent", None]


def test_weekday_and_month(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-07')) as d")
    got = days.select("d", labels.weekday_name("d").alias("w"), labels.month_key("d").alias("m")).collect()
    assert all(r.w == r.d.strftime("%A") and r.m == "202401" for r in got)


def test_renamed(spark):
    df = spark.createDataFrame([("CORSE DU SUD",), ("HAUTE CORSE",), ("AUDE",), (None,)], "n string")
    assert [r[0] for r in df.select(labels.renamed("n")).collect()] == ["corse", "corse0", "AUDE", None]


def square(x, order="<"):
    ring = (x, 0.0, x + 1, 0.0, x + 1, 1.5, x, 0.0)
    return struct.pack(order + "BIII8d", order == "<", 3, 1, 4, *ring)


GEOMETRIES = {
    "point": (struct.pack("<BI2d", 1, 1, 2.5, 48.0), "POINT (2.5 48)", '{"type": "Point", "coordinates": [2.5, 48.0]}'),
    "big endian": (struct.pack(">BI2d", 0, 1, 2.5, 48.0), "POINT (2.5 48)", '{"type": "Point", "coordinates": [2.5, 48.0]}'),
    "line": (struct.pack("<BII4d", 1, 2, 2, 0, 1, 2, 3), "LINESTRING (0 1, 2 3)",
             '{"type": "LineString", "coordinates": [[0.0, 1.0], [2.0, 3.0]]}'),
    "polygon": (square(0.0), "POLYGON ((0 0, 1 0, 1 1.5, 0 0))",
                '{"type": "Polygon", "coordinates": [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.5], [0.0, 0.0]]]}'),
    "multipolygon": (struct.pack("<BII", 1, 6, 2) + square(0.0) + square(5.0, ">"),
                     "MULTIPOLYGON (((0 0, 1 0, 1 1.5, 0 0)), ((5 0, 6 0, 6 1.5, 5 0)))", None),
    "multipoint": (struct.pack("<BII", 1, 4, 1) + struct.pack("<BI2d", 1, 1, 1, 2), "MULTIPOINT ((1 2))",
                   '{"type": "MultiPoint", "coordinates": [[1.0, 2.0]]}'),
    "point z": (struct.pack("<BI3d", 1, 1001, 1, 2, 3), "POINT Z (1 2 3)", '{"type": "Point", "coordinates": [1.0, 2.0, 3.0]}'),
    "point m": (struct.pack("<BI3d", 1, 0x40000001, 1, 2, 3), "POINT M (1 2 3)", '{"type": "Point", "coordinates": [1.0, 2.0]}'),
    "point zm with srid": (struct.pack("<BII4d", 1, 0xE0000001, 4326, 1, 2, 3, 4), "POINT ZM (1 2 3 4)",
                           '{"type": "Point", "coordinates": [1.0, 2.0, 3.0]}'),
    "empty point": (struct.pack("<BI2d", 1, 1, math.nan, math.nan), "POINT EMPTY", '{"type": "Point", "coordinates": []}'),
    "empty line": (struct.pack("<BII", 1, 2, 0), "LINESTRING EMPTY", '{"type": "LineString", "coordinates": []}'),
    "collection": (struct.pack("<BII", 1, 7, 2) + struct.pack("<BI2d", 1, 1, 1, 2) + struct.pack("<BII4d", 1, 2, 2, 0, 1, 2, 3),
                   "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 1, 2 3))",
                   '{"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1.0, 2.0]}, '
                   '{"type": "LineString", "coordinates": [[0.0, 1.0], [2.0, 3.0]]}]}'),
    "multi line z": (struct.pack("<BII", 1, 1005, 1) + struct.pack("<BII6d", 1, 1002, 2, 0, 1, 5, 2, 3, 5), "MULTILINESTRING Z ((0 1 5, 2 3 5))", None),
    "multipoint with empty": (struct.pack("<BII", 1, 4, 2) + struct.pack("<BI2d", 1, 1, math.nan, math.nan) + struct.pack("<BI2d", 1, 1, 1, 2),
                              "MULTIPOINT (EMPTY, (1 2))", '{"type": "MultiPoint", "coordinates": [[], [1.0, 2.0]]}'),
    "infinite": (struct.pack("<BI2d", 1, 1, math.inf, 1), None, None),
    "nan in a line": (struct.pack("<BII4d", 1, 2, 2, 0, 1, math.nan, 3), None, None),
    "deep": (struct.pack("<BII", 1, 7, 1) * 3000 + struct.pack("<BI2d", 1, 1, 1, 2), None, None),
    "wrong part": (struct.pack("<BII", 1, 4, 1) + struct.pack("<BII4d", 1, 2, 2, 0, 1, 2, 3), None, None),
    "truncated": (b"\x01\x01\x00\x00\x00\x00", None, None),
    "trailing": (struct.pack("<BI2d", 1, 1, 2.5, 48.0) + b"x", None, None),
    "unknown type": (struct.pack("<BI", 1, 99), None, None),
    "huge count": (struct.pack("<BII", 1, 2, 2**32 - 1), None, None),
    "empty": (b"", None, None),
    "null": (None, None, None),
}


def test_geometry(spark):
    df = spark.createDataFrame([(k, bytearray(v[0]) if v[0] is not None else None) for k, v in GEOMETRIES.items()],
                               "name string, wkb binary")
    for r in df.select("name", geometry.wkb_to_wkt("wkb").alias("w"), geometry.wkb_to_geojson("wkb").alias("g")).collect():
        _, wkt, geojson = GEOMETRIES[r.name]
        assert r.w == wkt, r.name
        if geojson or wkt is None:
            assert r.g == geojson, r.name
