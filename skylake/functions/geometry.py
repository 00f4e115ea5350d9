"""Well-known-binary geometry to text, as Arrow-batched column functions.

A value that cannot be decoded, or that text cannot express (infinite coordinates, nesting beyond MAX_DEPTH),
becomes NULL; it never fails the job. Points of NaN coordinates are empty.
"""

from __future__ import annotations

import json
import math
import struct
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# WKB type codes, the flags of the extended form, and the steps of the ISO form.
NAMES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
PARTS = {"MultiPoint": "Point", "MultiLineString": "LineString", "MultiPolygon": "Polygon"}
HAS_Z, HAS_M, HAS_SRID, ISO_STEP = 0x80000000, 0x40000000, 0x20000000, 1000
MAX_DEPTH = 32


class Shape(NamedTuple):
    """`tag`: "", "Z", "M" or "ZM"; `body`: nested coordinates, or the shapes of a multi geometry or collection."""

    name: str
    tag: str
    body: list


class _Reader:
    def __init__(self, data: bytes):
        self.data = data
        self.at = 0

    def take(self, fmt: str) -> tuple:
        values = struct.unpack_from(fmt, self.data, self.at)
        self.at += struct.calcsize(fmt)
        return values

    def points(self, order: str, width: int) -> list:
        (n,) = self.take(order + "I")
        flat = self.take(f"{order}{width * n}d")
        return [list(flat[i:i + width]) for i in range(0, width * n, width)]

    def shape(self, depth: int = 0) -> Shape:
        if depth > MAX_DEPTH:
            raise ValueError("nested too deeply")
        order = "<" if self.data[self.at] else ">"
        self.at += 1
        (code,) = self.take(order + "I")
        if code & HAS_SRID:
            self.take(order + "I")
        plain = code & 0x0FFFFFFF
        step, kind = divmod(plain, ISO_STEP)
        if kind not in NAMES or step > 3:
            raise ValueError(f"unsupported geometry type {code}")
        z, m = bool(code & HAS_Z) or step in (1, 3), bool(code & HAS_M) or step in (2, 3)
        name, tag, width = NAMES[kind], "Z" * z + "M" * m, 2 + z + m
        if name == "Point":
            point = list(self.take(f"{order}{width}d"))
            return Shape(name, tag, [] if all(map(math.isnan, point[:2])) else point)
        if name == "LineString":
            return Shape(name, tag, self.points(order, width))
        (n,) = self.take(order + "I")
        if name == "Polygon":
            return Shape(name, tag, [self.points(order, width) for _ in range(n)])
        parts = [self.shape(depth + 1) for _ in range(n)]
        if name in PARTS and any(p.name != PARTS[name] for p in parts):
            raise ValueError(f"{name} with another kind of part")
        return Shape(name, tag, parts)


def parse_wkb(data: bytes | None) -> Shape | None:
    """The shape, or None when the bytes are not a supported geometry."""
    if not data:
        return None
    try:
        reader = _Reader(bytes(data))
        shape = reader.shape()
    except (struct.error, ValueError, IndexError, MemoryError):
        return None
    return shape if reader.at == len(reader.data) else None


def _number(x: float) -> str:
    if not math.isfinite(x):
        raise ValueError("not a finite coordinate")
    return repr(int(x)) if x == int(x) else repr(x)


def _listed(c: list) -> str:
    """A point's numbers, or its parts in brackets."""
    if c and isinstance(c[0], float):
        return " ".join(map(_number, c))
    return "(" + ", ".join(map(_listed, c)) + ")" if c else "EMPTY"


def _wkt(shape: Shape, bare: bool = False) -> str:
    head = "" if bare else f"{shape.name.upper()} {shape.tag} " if shape.tag else f"{shape.name.upper()} "
    if not shape.body:
        return f"{head}EMPTY"
    if shape.name == "Point":
        return f"{head}({_listed(shape.body)})"
    if shape.name in PARTS or shape.name == "GeometryCollection":
        return f"{head}({', '.join(_wkt(p, shape.name in PARTS) for p in shape.body)})"
    return head + _listed(shape.body)


def _geojson(shape: Shape) -> dict:
    """Longitude, latitude and height; measures have no place in GeoJSON."""
    def coordinates(c: list) -> list:
        if c and isinstance(c[0], float):
            kept = c[:3] if shape.tag.startswith("Z") else c[:2]
            if not all(map(math.isfinite, kept)):
                raise ValueError("not a finite coordinate")
            return kept
        return [coordinates(x) for x in c]

    if shape.name == "GeometryCollection":
        return {"type": shape.name, "geometries": [_geojson(p) for p in shape.body]}
    if shape.name in PARTS:
        return {"type": shape.name, "coordinates": [_geojson(p)["coordinates"] for p in shape.body]}
    return {"type": shape.name, "coordinates": coordinates(shape.body)}


def _guarded(write, shape: Shape | None) -> str | None:
    try:
        return None if shape is None else write(shape)
    except (ValueError, OverflowError):
        return None


def to_wkt(shape: Shape | None) -> str | None:
    return _guarded(_wkt, shape)


def to_geojson(shape: Shape | None) -> str | None:
    return _guarded(lambda s: json.dumps(_geojson(s), allow_nan=False), shape)


TEXTS = T.StructType([T.StructField("wkt", T.StringType()), T.StructField("geojson", T.StringType())])


@F.pandas_udf(TEXTS)
def geometry_texts(data: pd.Series) -> pd.DataFrame:
    """Both text forms of a shape, which is parsed once."""
    shapes = [parse_wkb(x) for x in data]
    return pd.DataFrame({"wkt": [to_wkt(s) for s in shapes], "geojson": [to_geojson(s) for s in shapes]}, dtype=object)


def wkb_to_wkt(data: Column | str) -> Column:
    return geometry_texts(data)["wkt"]


def wkb_to_geojson(data: Column | str) -> Column:
    return geometry_texts(data)["geojson"]
