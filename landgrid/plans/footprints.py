"""Footprint tiles -> distinct footprints inside one boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrid.operators import grid, tables
from landgrid.operators.tables import reprojected
from landgrid.schemas import UTM_10N, require_same_srid

SQUARE = 1000.0     # side in metres of the grid squares the boundary is cut to


def named_area(areas: DataFrame, name: str) -> DataFrame:
    return tables.require_rows(areas.filter(F.col("name") == name), f"no area named {name!r}")


def boundary(states: DataFrame, name: str, target: int = UTM_10N) -> DataFrame:
    """The boundary of one named area in the target system."""
    return reprojected(named_area(states, name), target).select("name", "geom")


def inside(polygons: DataFrame, area: DataFrame, key: str, size: float = SQUARE) -> DataFrame:
    """Polygons that meet the area. The area is cut to grid squares, so a polygon in a square the
    area covers needs no exact test, and no task handles the whole outline."""
    require_same_srid(polygons, area)
    hits = grid.intersecting(polygons, area.select(F.lit(1).alias("area"), "geom"), key, "area", size, cut_left=False)
    return polygons.join(hits.select(key), key, "left_semi")


def state_footprints(polygons: DataFrame, states: DataFrame, name: str, target: int = UTM_10N) -> DataFrame:
    """Distinct footprint geometries inside the named state, in the target system."""
    area = boundary(states, name, target)
    return grid.distinct_inside(reprojected(polygons, target), area, SQUARE)
