"""Validity of GeoJSON geometries without a geometry library.

The rules approximate the OGC's: a known type, finite coordinates, rings of four points or more that close, have an area
and do not cross themselves, and holes within their shell.  Touching rings of one polygon are not looked for.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

TYPES = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon", "GeometryCollection")


def _points(raw: list) -> list[tuple[float, float]]:
    out = []
    for p in raw:
        x, y = float(p[0]), float(p[1])
        if not (math.isfinite(x) and math.isfinite(y)):
            raise ValueError("coordinate is not finite")
        out.append((x, y))
    return out


def _turn(a, b, c) -> int:
    v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return (v > 0) - (v < 0)


def _on(a, b, p) -> bool:
    return _turn(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def _cross(a, b, c, d) -> bool:
    if _turn(a, b, c) != _turn(a, b, d) and _turn(c, d, a) != _turn(c, d, b):
        return True
    return _on(a, b, c) or _on(a, b, d) or _on(c, d, a) or _on(c, d, b)


def _ring_problem(ring: list[tuple[float, float]]) -> str | None:
    if len(ring) < 4:
        return "ring of fewer than four points"
    if ring[0] != ring[-1]:
        return "ring is not closed"
    if sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) == 0:
        return "ring has no area"
    n = len(ring) - 1
    # a sweep over x: only segments whose x-ranges meet are compared
    spans = sorted((min(ring[i][0], ring[i + 1][0]), max(ring[i][0], ring[i + 1][0]), i) for i in range(n))
    active: list[tuple[float, int]] = []
    for lo, hi, i in spans:
        active = [(h, j) for h, j in active if h >= lo]
        for _, j in active:
            if abs(i - j) in (1, n - 1):
                shared = ring[max(i, j)] if abs(i - j) == 1 else ring[0]
                ends = [p for p in (ring[i], ring[i + 1]) if p != shared] + [p for p in (ring[j], ring[j + 1]) if p != shared]
                if len(ends) == 2 and (_on(ring[i], ring[i + 1], ends[1]) or _on(ring[j], ring[j + 1], ends[0])):
                    return "ring folds back on itself"
            elif _cross(ring[i], ring[i + 1], ring[j], ring[j + 1]):
                return "ring crosses itself"
        active.append((hi, i))
    return None


def _inside(ring: list[tuple[float, float]], p: tuple[float, float]) -> bool:
    odd = False
    for a, b in zip(ring, ring[1:]):
        if _on(a, b, p):
            return True
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
            odd = not odd
    return odd


def problem(geometry: object) -> str | None:
    """What is wrong with a GeoJSON geometry (an object or its text); any error in reading it is a finding."""
    try:
        g = json.loads(geometry) if isinstance(geometry, str) else geometry
        kind = g["type"]
        if kind not in TYPES:
            return f"unknown geometry type {kind!r}"
        if kind == "GeometryCollection":
            return next((p for x in g["geometries"] if (p := problem(x))), None) if g["geometries"] else "empty geometry"
        c = g["coordinates"]
        if not c:
            return "empty geometry"
        if kind == "Point":
            _points([c])
        elif kind == "MultiPoint":
            _points(c)
        elif kind in ("LineString", "MultiLineString"):
            for line in [c] if kind == "LineString" else c:
                if len(set(_points(line))) < 2:
                    return "line of fewer than two points"
        else:
            for poly in [c] if kind == "Polygon" else c:
                rings = [_points(r) for r in poly]
                if not rings:
                    return "empty geometry"
                for r in rings:
                    if p := _ring_problem(r):
                        return p
                if any(not all(_inside(rings[0], p) for p in hole) for hole in rings[1:]):
                    return "hole outside its shell"
    except (KeyError, TypeError, ValueError, IndexError) as e:
        return f"malformed geometry: {e}"
    return None


@F.pandas_udf(StringType())
def _problems(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda g: None if g is None or g == "null" else problem(g))


def geometry_problem(geojson: Column) -> Column:
    """Null where the geometry is valid; missing geometries are counted apart (X01) and are null here too."""
    return _problems(geojson)


def is_missing(geojson: Column) -> Column:
    return geojson.isNull() | (geojson == "null") | (geojson == "{}")
