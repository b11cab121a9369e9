"""Geometry scalars as native column expressions.

Measures that visit every edge (area, border length, centre) are Arrow kernels instead, see
``landgrid.functions.measures``: lambda functions over arrays are interpreted, and took 4 to 8 times
as long on polygons of 5 to 69 vertices.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from landgrid.functions.measures import area, centroid, perimeter  # noqa: F401
from landgrid.schemas import GEOM_DDL


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(x, y) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


def rectangle(xmin, ymin, xmax, ymax) -> Column:
    """A one-ring polygon, counter-clockwise from the lower left corner."""
    a, b, c, d = (_col(v) for v in (xmin, ymin, xmax, ymax))
    ring = F.array(point(a, b), point(c, b), point(c, d), point(a, d), point(a, b))
    return F.array(F.array(ring)).cast(GEOM_DDL)


def point_buffer(x, y, radius: float, quarter_segments: int = 16) -> Column:
    """The disc around a point as a polygon with ``4 * quarter_segments`` sides."""
    sides = 4 * quarter_segments
    x, y = _col(x).cast("double"), _col(y).cast("double")

    def corner(i):
        turn = (i % sides) * F.lit(-2 * math.pi / sides)
        return point(x + F.lit(radius) * F.cos(turn), y + F.lit(radius) * F.sin(turn))

    return F.array(F.array(F.transform(F.sequence(F.lit(0), F.lit(sides)), corner)))


def bbox(geom) -> Column:
    vertices = F.flatten(F.flatten(_col(geom)))
    xs, ys = F.transform(vertices, lambda v: v.x), F.transform(vertices, lambda v: v.y)
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def vertex_count(geom) -> Column:
    return F.size(F.flatten(F.flatten(_col(geom))))


def map_vertices(geom, change) -> Column:
    """Apply ``change(x, y) -> (x, y)`` to each vertex."""
    def vertex(v):
        x, y = change(v.x, v.y)
        return point(x, y)

    return F.transform(_col(geom), lambda part: F.transform(part, lambda ring: F.transform(ring, vertex)))


def box_gap(a: Column, b: Column) -> Column:
    """Distance between two boxes, 0 where they meet."""
    dx = F.greatest(a.xmin - b.xmax, b.xmin - a.xmax, F.lit(0.0))
    dy = F.greatest(a.ymin - b.ymax, b.ymin - a.ymax, F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


def box_span(a: Column, b: Column) -> Column:
    """The largest distance between a point of one box and a point of the other."""
    dx = F.greatest(a.xmax - b.xmin, b.xmax - a.xmin)
    dy = F.greatest(a.ymax - b.ymin, b.ymax - a.ymin)
    return F.sqrt(dx * dx + dy * dy)


def boxes_meet(a: Column, b: Column) -> Column:
    return (a.xmin <= b.xmax) & (b.xmin <= a.xmax) & (a.ymin <= b.ymax) & (b.ymin <= a.ymax)


def grow(box: Column, by: float) -> Column:
    return F.struct((box.xmin - by).alias("xmin"), (box.ymin - by).alias("ymin"),
                    (box.xmax + by).alias("xmax"), (box.ymax + by).alias("ymax"))


# -- GeoJSON -----------------------------------------------------------------------------------

def from_geojson(kind, coordinates) -> Column:
    """Geometry from a GeoJSON type and the text of its coordinates; NULL for other types.

    What is missing in the text (a ring, a vertex, a number) is NULL in the geometry: see ``complete``.
    """
    def rings(part):
        return F.transform(part, lambda ring: F.transform(
            ring, lambda v: point(F.try_element_at(v, F.lit(1)), F.try_element_at(v, F.lit(2)))))

    ring_list = "array<array<array<double>>>"
    one = F.array(rings(F.from_json(_col(coordinates), ring_list)))
    many = F.transform(F.from_json(_col(coordinates), f"array<{ring_list}>"), rings)
    return (F.when(_col(kind) == "Polygon", one).when(_col(kind) == "MultiPolygon", many))


def complete(geom) -> Column:
    """Whether a geometry has parts, every part rings, every ring four vertices, every vertex two finite numbers."""
    def number(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))

    def filled(items, good, least=1):
        return items.isNotNull() & (F.size(items) >= least) & F.forall(items, lambda i: F.coalesce(good(i), F.lit(False)))

    return F.coalesce(filled(_col(geom), lambda part: filled(part, lambda ring: filled(
        ring, lambda v: number(v.x) & number(v.y), 4))), F.lit(False))
