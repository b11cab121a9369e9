"""Random shapes and their DataFrames."""

import numpy as np

from landgrid.functions.arrow_geom import from_rings
from landgrid.schemas import GEOM_DDL


def rect(x0, y0, x1, y1):
    return [[[[float(x0), float(y0)], [float(x1), float(y0)], [float(x1), float(y1)], [float(x0), float(y1)],
              [float(x0), float(y0)]]]]


def star(rng, cx, cy, n, radius):
    turn = 2 * np.pi * (np.arange(n) + rng.uniform(0.1, 0.9, n)) / n
    r = radius * rng.uniform(0.3, 1, n)
    ring = np.column_stack([cx + r * np.cos(turn), cy + r * np.sin(turn)]).tolist()
    return [[ring + ring[:1]]]


def layer(spark, shapes, key="fid"):
    rows = [(k, [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in shape])
            for k, shape in enumerate(shapes)]
    return spark.createDataFrame(rows, f"{key} long, geom {GEOM_DDL}")


def points(spark, xy, key="ID"):
    return spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(xy)], f"{key} long, x double, y double")


def flat_of(shapes):
    return from_rings([[[np.array(r, float) for r in p] for p in s] for s in shapes])


def crowd(rng, n, spread=2000.0):
    """Points of which a third lie in one small spot and a tenth are copies of one point."""
    xy = rng.uniform(0, spread, (n, 2))
    xy[: n // 3] = [spread / 2, spread / 2] + rng.normal(0, 3, (n // 3, 2))
    xy[n // 3: n // 3 + n // 10] = xy[0]
    return np.round(xy, 3)
