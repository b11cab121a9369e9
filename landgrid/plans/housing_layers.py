"""Housing points, rasters and polygons -> ground layer, rooftop layer, tract summary, map data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrid.functions import geom as G
from landgrid.functions.crs import reproject
from landgrid.operators import clusters, grid, overlay, raster, tables
from landgrid.schemas import CALIFORNIA_ALBERS, WGS84, RasterGrid, srid_of
from landgrid.shared import saved
from landgrid.sources.readers import of_kind, union_of


@dataclass(frozen=True)
class Settings:
    """Distances in metres and areas in square metres."""

    aoi_radius: float = 250.0
    impervious_low: int = 1
    impervious_high: int = 20
    building_margin: float = 5.0
    single_reach: float = 30.0
    multi_reach: float = 100.0
    cluster_gap: float = 24.0       # buffers of half this width touch
    tolerance: float = 2.0
    least_area: float = 100.0
    square: float = 128.0           # grid side for joins with points and between buildings
    ground_square: float = 256.0    # grid side for the ground layer
    tract_square: float = 1024.0    # grid side to which tracts are cut


def points_of_kind(housing: DataFrame, kind: str) -> DataFrame:
    """Cleaned points of one kind as ``ID, x, y`` in the projected system."""
    clean = tables.clean_coordinates(of_kind(housing, kind), "lon", "lat")
    x, y = reproject("lon", "lat", WGS84, CALIFORNIA_ALBERS)
    return tables.with_id(clean, ["lon", "lat"]).select("ID", x.alias("x"), y.alias("y"))


def in_system(layer: DataFrame) -> DataFrame:
    """A tagged layer in the flow's system; an untagged one is taken to be in it."""
    return layer if srid_of(layer) is None else tables.reprojected(layer, CALIFORNIA_ALBERS)


# -- ground ----------------------------------------------------------------------------------------

def patches(cells: DataFrame, multi: DataFrame, grid_of_raster: RasterGrid, s: Settings) -> DataFrame:
    """Patches of little-sealed land around multifamily points: ``gid, geom``.

    The raster may be in a system of its own: points go there, and patches come back.
    """
    located = tables.points_in(multi, grid_of_raster.srid, CALIFORNIA_ALBERS)
    near = raster.clip_to_points(cells, located, s.aoi_radius, grid_of_raster)
    light = near.filter(F.col("value").between(s.impervious_low, s.impervious_high))
    labelled = raster.regions(raster.opened(light.select("cx", "cy")))
    drawn = raster.region_polygons(labelled, grid_of_raster)
    land = drawn.select(F.col("region").alias("gid"), "geom")
    return land if grid_of_raster.srid == CALIFORNIA_ALBERS else \
        tables.reprojected(land, CALIFORNIA_ALBERS, grid_of_raster.srid)


def ground_layer(land: DataFrame, exclusions: list[DataFrame], buildings: DataFrame,
                 second_raster: DataFrame, second_grid: RasterGrid, s: Settings) -> DataFrame:
    """Patches less public lands and grown buildings, in single parts of at least the least area,
    that hold a valid cell of the second raster; simplified. ``gid, geom``.

    Tagged layers in other systems are brought to that of the land first.
    """
    exclusions, buildings = [in_system(e) for e in exclusions], in_system(buildings)
    land = in_system(land) if any(srid_of(e) is not None for e in (*exclusions, buildings)) else land
    lands = union_of([e.select("geom") for e in exclusions])
    free = overlay.only_valid(overlay.difference(land, lands, "gid", s.ground_square))
    open_land = overlay.only_valid(overlay.difference(free, buildings, "gid", s.ground_square, s.building_margin))
    parts = tables.min_area(tables.exploded(tables.min_area(open_land, s.least_area)), s.least_area)
    parts = saved(parts.select(F.struct("gid", "part").alias("gid"), "geom"))
    asked = parts if second_grid.srid == CALIFORNIA_ALBERS else tables.reprojected(parts, second_grid.srid, CALIFORNIA_ALBERS)
    kept = raster.with_any_value(asked, second_raster, "gid", second_grid)
    marked = parts.join(kept, "gid", "left_semi").withColumn("has_impervious_overlap", F.lit(True))
    return overlay.simplified(marked.select("gid", "geom"), s.tolerance)


# -- rooftops --------------------------------------------------------------------------------------

def footprint_hits(buildings: DataFrame, multi: DataFrame, s: Settings) -> DataFrame:
    """Keys of the buildings that a multifamily point lies on."""
    return grid.within(buildings, multi, "fid", 0.0, s.square)


def near_single(buildings: DataFrame, hits: DataFrame, single: DataFrame, s: Settings) -> DataFrame:
    """Keys of the buildings without a hit that lie near a single-family point."""
    rest = buildings.join(hits, "fid", "left_anti")
    return grid.within(rest, single, "fid", s.single_reach, s.square)


def rooftop_candidates(buildings: DataFrame, multi: DataFrame, single: DataFrame, s: Settings) -> DataFrame:
    """All buildings but those near a single-family point; a hit protects a building."""
    return buildings.join(near_single(buildings, footprint_hits(buildings, multi, s), single, s), "fid", "left_anti")


def rooftops(buildings: DataFrame, multi: DataFrame, single: DataFrame, s: Settings) -> DataFrame:
    """Distinct buildings near a multifamily point: ``fid, ID, geom``.

    A geometry keeps the smallest ``ID`` among its nearest points. That is a minimum per building, so
    points that share a location are not multiplied into rows first.
    """
    candidates = saved(rooftop_candidates(buildings, multi, single, s))
    best = grid.nearest_label(candidates, multi, "fid", "ID", s.multi_reach, s.square)
    return tables.first_per_geometry(candidates.join(best, "fid").select("fid", "ID", "geom"), "ID")


def rooftop_layer(roofs: DataFrame, s: Settings) -> DataFrame:
    """Rooftops with their cluster number, simplified: ``fid, ID, geom, cluster``."""
    numbered = clusters.clusters(saved(roofs), "fid", s.cluster_gap, s.square)
    return overlay.simplified(numbered.select("fid", "ID", "geom", "cluster"), s.tolerance)


# -- summary ---------------------------------------------------------------------------------------

def tract_join(layer: DataFrame, tracts: DataFrame, key: str, size: float, cut: bool) -> DataFrame:
    """``GEOID, area_sqm`` once per tract that a polygon meets, with the polygon's full area."""
    measured = layer.withColumn("area_sqm", G.area("geom"))
    return grid.intersecting(measured, tracts, key, "GEOID", size, cut_left=cut, carry=("area_sqm",))


def tract_summary(ground: DataFrame, roofs: DataFrame, tracts: DataFrame, size: float,
                  ground_key: str = "gid", roof_key: str = "fid") -> DataFrame:
    """Area and number of polygons of both layers by tract."""
    def per_tract(layer, key, name, cut):
        return tract_join(layer, tracts, key, size, cut).groupBy("GEOID").agg(
            F.sum("area_sqm").alias(f"{name}_total_area_sqm"), F.count("area_sqm").alias(f"{name}_polygon_count"))

    both = per_tract(ground, ground_key, "ground", True).join(per_tract(roofs, roof_key, "rooftop", False), "GEOID", "full")
    return both.withColumnRenamed("GEOID", "census_tract_id").fillna(0, subset=METRICS)


# fixed values: the mapped columns and their titles
TITLES = {
    "rooftop_polygon_count": "Number of Rooftop Polygons",
    "ground_polygon_count": "Number of Ground Polygons",
    "rooftop_total_area_sqm": "Total Rooftop Area (sqm)",
    "ground_total_area_sqm": "Total Ground Area (sqm)",
}
METRICS = list(TITLES)


def mapped_tracts(tracts: DataFrame, summary: DataFrame) -> DataFrame:
    """Tracts with their metrics; tracts without polygons are left out."""
    joined = tracts.join(summary, tracts["GEOID"] == summary["census_tract_id"], "left").drop("census_tract_id")
    joined = joined.fillna(0, subset=METRICS)
    return joined.filter((F.col("rooftop_polygon_count") > 0) | (F.col("ground_polygon_count") > 0))


def title_of(metric) -> Column:
    pairs = [F.lit(v) for item in TITLES.items() for v in item]
    return F.element_at(F.create_map(*pairs), G._col(metric))


def map_feed(tracts: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per tract and metric, in longitude and latitude: ``GEOID, metric, title, value, geom``."""
    shown = in_degrees(mapped_tracts(tracts, summary))
    values = [F.col(m).cast("double").alias(m) for m in METRICS]
    long = shown.select("GEOID", "geom", *values).unpivot(["GEOID", "geom"], METRICS, "metric", "value")
    return long.withColumn("title", title_of("metric"))


def in_degrees(layer: DataFrame) -> DataFrame:
    return tables.reprojected(layer, WGS84, srid_of(layer) or CALIFORNIA_ALBERS)


def map_extent(shown: DataFrame) -> DataFrame:
    """Extent of the mapped tracts and its centre, in longitude and latitude."""
    return tables.extent(in_degrees(shown)).withColumns({
        "center_lon": (F.col("xmin") + F.col("xmax")) / 2, "center_lat": (F.col("ymin") + F.col("ymax")) / 2})
