"""Area, border length and centre of polygons on Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType

from landgrid.functions.arrow_geom import POINT_TYPE, Flat, flat
from landgrid.functions.predicates import ring_areas, ring_sums
from landgrid.schemas import POINT


def _signs(g: Flat) -> np.ndarray:
    """1 for shells, -1 for holes."""
    sign = -np.ones(len(g.ring) - 1)
    sign[g.part[:-1][np.diff(g.part) > 0]] = 1.0
    return sign


def areas(g: Flat) -> np.ndarray:
    return ring_sums(np.abs(ring_areas(g.x, g.y, g.ring)) * _signs(g), g.row_ring)


def centroids(g: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Area-weighted centres over all parts and holes, summed relative to each row's first vertex."""
    base = np.repeat(np.minimum(g.row_vertex[:-1], max(len(g.x) - 1, 0)), np.diff(g.row_vertex))
    u, v = g.x - g.x[base], g.y - g.y[base]
    weight = np.sign(ring_areas(g.x, g.y, g.ring)) * _signs(g)
    cross = np.zeros(len(u))
    cross[:-1] = u[:-1] * v[1:] - u[1:] * v[:-1]
    cross[g.ring[1:][np.diff(g.ring) > 0] - 1] = 0.0
    cross *= np.repeat(weight, np.diff(g.ring))
    total = ring_sums(cross, g.row_vertex) * 3
    out = []
    for axis, values in ((u, g.x), (v, g.y)):
        moment = cross.copy()
        moment[:-1] *= axis[:-1] + axis[1:]
        first = values[np.minimum(g.row_vertex[:-1], max(len(values) - 1, 0))] if len(values) else np.zeros(g.rows)
        with np.errstate(divide="ignore", invalid="ignore"):
            out.append(first + ring_sums(moment, g.row_vertex) / total)
    return out[0], out[1]


@arrow_udf(DoubleType())
def area(geom: pa.Array) -> pa.Array:
    return pa.array(areas(flat(geom)))


@arrow_udf(DoubleType())
def perimeter(geom: pa.Array) -> pa.Array:
    g = flat(geom)
    seg, _, offsets = g.segments()
    return pa.array(ring_sums(np.hypot(g.x[seg + 1] - g.x[seg], g.y[seg + 1] - g.y[seg]), offsets))


@arrow_udf(POINT)
def centroid(geom: pa.Array) -> pa.Array:
    x, y = centroids(flat(geom))
    return pa.StructArray.from_arrays([pa.array(x), pa.array(y)], fields=list(POINT_TYPE))
