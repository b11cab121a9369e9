"""One query per operator, over fixtures that Spark derives from the tables in a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrid import fixtures
from landgrid.functions import geom as G
from landgrid.functions.crs import reproject
from landgrid.operators import clusters, graph, grid, overlay, raster, tables
from landgrid.plans import footprints, ground_near_clusters, housing_layers
from landgrid.schemas import CALIFORNIA_ALBERS, CONUS_ALBERS, UTM_10N, WGS84, RasterGrid
from landgrid.shared import saved, shared_folder
from landgrid.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SETTINGS = housing_layers.Settings()
IMPERVIOUS = RasterGrid(30.0, 250)
SECOND = RasterGrid(30.0, -9999)
WINDOW = (1000.0, 700.0, 1900.0, 1500.0)


class Inputs:
    """The fixtures of one folder under the column names the operators use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.folder, name)

    def buildings(self, view: str = "f_footprint") -> DataFrame:
        return fixtures.shapes(self.table(view)).withColumnRenamed("bid", "fid")

    def points(self, kind: str) -> DataFrame:
        return self.table("f_point").filter(F.col("kind") == kind).select(F.col("id").alias("ID"), "x", "y")

    def housing(self) -> DataFrame:
        return self.table("f_housing").select(
            F.col("id").alias("ID"), F.col("x_raw").alias("lon"), F.col("y_raw").alias("lat"),
            F.col("kind").alias("single_or_multi"))

    def ground(self) -> DataFrame:
        return fixtures.shapes(self.table("f_ground"))

    def exclusions(self) -> DataFrame:
        return fixtures.shapes(self.table("f_layer"))

    def tracts(self) -> DataFrame:
        return fixtures.shapes(self.table("f_tract")).withColumnRenamed("geoid", "GEOID")

    def cells(self, value: str) -> DataFrame:
        return self.table("f_cell").select("cx", "cy", F.col(value).alias("value"))

    def manifest(self) -> DataFrame:
        messy = self.table("f_manifest").toDF(" Location ", "QuadKey ", " URL")
        return readers.require_columns(readers.normalized_header(messy), readers.MANIFEST_COLUMNS)

    def lines(self) -> DataFrame:
        return readers.parsed(self.table("f_geojson").select("p_partkey", "line"))

    def boundary(self) -> DataFrame:
        corners = (F.lit(v) for v in fixtures.BOUNDARY)
        return self.spark.range(1).select(F.col("id").alias("area"), G.rectangle(*corners).alias("geom"))


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Inputs(spark, folder))
    return build


BOX = ("xmin", "ymin", "xmax", "ymax")


def box_columns(geom: str = "geom") -> list[Column]:
    b = G.bbox(geom)
    return [b[c].alias(c) for c in BOX]


def rounded(value, digits: int = 3) -> Column:
    return F.round(G._col(value), digits)


# -- manifest and tiles ----------------------------------------------------------------------------

@query
def manifest_scan(t):
    return t.manifest().select("location", "quadkey", "url")


@query
def manifest_filter(t):
    return readers.manifest_tiles(t.manifest())


@query
def manifest_files(t):
    return readers.manifest_tiles(t.manifest()).select(readers.landed_name("Url", "QuadKey").alias("file_name"))


@query
def manifest_missing(t):
    tiles = readers.manifest_tiles(t.manifest())
    landed = tiles.filter(F.col("location") == "unitedstates")
    landed = landed.select(readers.landed_name("Url", "QuadKey").alias("file_name"))
    return readers.missing_tiles(tiles, landed).select("QuadKey", "file_name")


@query
def geojson_scan(t):
    shapes = readers.footprints(t.lines())
    return shapes.select("p_partkey", G.vertex_count("geom").alias("vertices"), *box_columns(), G.area("geom").alias("area"))


@query
def geojson_quarantine(t):
    return readers.quarantined(t.lines())


@query
def quarantine_sample(t):
    return readers.quarantined(t.lines()).orderBy("p_partkey").limit(5)


# -- housing ---------------------------------------------------------------------------------------

@query
def housing_scan(t):
    return t.housing()


@query
def housing_multi(t):
    return readers.of_kind(t.housing(), "Multi").select("ID")


@query
def housing_single(t):
    return readers.of_kind(t.housing(), "Single").select("ID")


@query
def housing_clean(t):
    return tables.clean_coordinates(t.housing(), "lon", "lat").select("ID", "lon", "lat")


@query
def housing_points(t):
    clean = tables.clean_coordinates(readers.of_kind(t.housing(), "Multi"), "lon", "lat")
    return clean.select("ID", G.point("lon", "lat").alias("p")).select("ID", "p.x", "p.y")


@query
def stage_metrics(t):
    x, y = tables.numeric("lon"), tables.numeric("lat")
    return tables.stage_counts(t.housing(), {
        "read": F.lit(True), "multi": F.trim("single_or_multi") == "Multi",
        "located": x.isNotNull() & y.isNotNull()})


@query
def row_ids(t):
    return tables.row_ids(t.table("f_footprint").select("bid", "x0", "y0"), ["x0", "y0", "bid"]).select("bid", "row_id")


# -- geometry scalars ------------------------------------------------------------------------------

@query
def polygon_area(t):
    return t.buildings().select("fid", G.area("geom").alias("area"))


def _with_hole(t) -> DataFrame:
    """Ground rectangles with a rectangular hole near their lower left corner."""
    r = t.table("f_ground")
    x, y, w, h = F.col("x0"), F.col("y0"), F.col("w"), F.col("h")
    outer = G.rectangle(x, y, x + w, y + h)
    inner = G.rectangle(x + 1, y + 1, x + 1 + w / 4, y + 1 + h / 4)
    geom = F.array(F.array(outer[0][0], F.reverse(inner[0][0])))
    return r.select("gid", geom.alias("geom"))


@query
def polygon_centroid(t):
    c = G.centroid("geom")
    return _with_hole(t).select("gid", rounded(c.x).alias("x"), rounded(c.y).alias("y"), rounded(G.area("geom")).alias("area"))


@query
def polygon_bbox(t):
    return _with_hole(t).select("gid", *box_columns())


@query
def point_buffer(t):
    discs = t.points("Multi").withColumn("geom", G.point_buffer("x", "y", SETTINGS.aoi_radius))
    return discs.select("ID", G.vertex_count("geom").alias("vertices"), rounded(G.area("geom")).alias("area"), *box_columns())


@query
def polygon_buffer_area(t):
    grown = overlay.buffered(t.buildings(), SETTINGS.building_margin)
    return grown.select("fid", rounded(G.area("geom")).alias("area"))


@query
def explode_parts(t):
    two = t.exclusions().withColumn("geom", F.concat("geom", G.map_vertices("geom", lambda x, y: (x + 2000, y))))
    return tables.exploded(two).select("eid", "part", *box_columns(), G.area("geom").alias("area"))


@query
def valid_filter_holes(t):
    """Rectangles with two holes each, which may meet, touch in a corner, lie in each other or leave the rectangle."""
    r = t.table("f_ground")

    def rectangle(dx, dy, side):
        return G.rectangle(F.col("x0") + dx, F.col("y0") + dy, F.col("x0") + dx + side, F.col("y0") + dy + side)[0][0]

    shell = G.rectangle("x0", "y0", F.col("x0") + F.col("w"), F.col("y0") + F.col("h"))[0][0]
    rings = F.array(shell, rectangle(F.lit(5), F.lit(5), 10), rectangle(F.col("gid") % 71, F.col("gid") % 53, 8))
    return overlay.only_valid(r.select("gid", F.array(rings).alias("geom"))).select("gid")


@query
def simplify_bounds(t):
    """Rectangles with a bump of 0.3 m on each side, which the tolerance removes."""
    r = t.table("f_footprint")
    a, b, c, d = F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    mx, my = (a + c) / 2, (b + d) / 2
    ring = F.array(G.point(a, b), G.point(mx, b - 0.3), G.point(c, b), G.point(c + 0.3, my), G.point(c, d),
                   G.point(mx, d + 0.3), G.point(a, d), G.point(a - 0.3, my), G.point(a, b))
    bumpy = r.select("bid", F.array(F.array(ring)).alias("geom"))
    return overlay.simplified(bumpy, SETTINGS.tolerance).select(
        "bid", G.vertex_count("geom").alias("vertices"), *box_columns(), G.area("geom").alias("area"))


@query
def valid_filter(t):
    """Rectangles of which some are twisted and some are left open."""
    r = t.table("f_ground")
    a, b, c, d = F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    twisted = F.array(G.point(a, b), G.point(c, d), G.point(c, b), G.point(a, d), G.point(a, b))
    unclosed = F.array(G.point(a, b), G.point(c, b), G.point(c, d), G.point(a, d))
    ring = (F.when(F.col("w") % 3 == 0, twisted).when(F.col("h") % 5 == 0, unclosed)
            .otherwise(G.rectangle(a, b, c, d)[0][0]))
    return overlay.only_valid(r.select("gid", F.array(F.array(ring)).alias("geom"))).select("gid")


@query
def layer_extent(t):
    return tables.extent(t.buildings())


@query
def project_albers(t):
    x, y = reproject("lon", "lat", WGS84, CALIFORNIA_ALBERS)
    return t.table("f_lonlat").select("id", rounded(x).alias("x"), rounded(y).alias("y"))


@query
def project_utm(t):
    x, y = reproject("lon", "lat", WGS84, UTM_10N)
    return t.table("f_lonlat").select("id", rounded(x).alias("x"), rounded(y).alias("y"))


@query
def project_inverse(t):
    """There and back over both systems."""
    flat = t.table("f_lonlat")
    for k, srid in enumerate((CALIFORNIA_ALBERS, UTM_10N)):
        x, y = reproject("lon", "lat", WGS84, srid)
        flat = flat.withColumns({f"x{k}": x, f"y{k}": y})
        lon, lat = reproject(f"x{k}", f"y{k}", srid, WGS84)
        flat = flat.withColumns({f"lon{k}": rounded(lon, 7), f"lat{k}": rounded(lat, 7)})
    return flat.select("id", "lon0", "lat0", "lon1", "lat1")


# -- footprints ------------------------------------------------------------------------------------

@query
def boundary_select(t):
    areas = t.tracts().select(F.col("GEOID").alias("name"), "geom")
    return footprints.named_area(areas, "06000000007").select("name", *box_columns(), G.area("geom").alias("area"))


@query
def boundary_filter(t):
    return footprints.inside(t.buildings(), t.boundary(), "fid").select("fid")


@query
def footprint_dedup(t):
    return tables.distinct_geometry(t.buildings("f_footprint_dup")).select(*box_columns())


@query
def distinct_footprints_inside(t):
    return grid.distinct_inside(t.buildings("f_footprint_dup"), t.boundary(), footprints.SQUARE).select(*box_columns())


# -- rooftops --------------------------------------------------------------------------------------

@query
def footprint_hits(t):
    return housing_layers.footprint_hits(t.buildings(), t.points("Multi"), SETTINGS)


@query
def near_single(t):
    buildings = t.buildings()
    hits = housing_layers.footprint_hits(buildings, t.points("Multi"), SETTINGS)
    return housing_layers.near_single(buildings, hits, t.points("Single"), SETTINGS)


@query
def rooftop_candidates(t):
    return housing_layers.rooftop_candidates(t.buildings(), t.points("Multi"), t.points("Single"), SETTINGS).select("fid")


@query
def nearest_multi(t):
    multi = t.points("Multi")
    left = saved(housing_layers.rooftop_candidates(t.buildings(), multi, t.points("Single"), SETTINGS))
    found = grid.nearest(left, multi, "fid", "ID", SETTINGS.multi_reach, SETTINGS.square)
    return found.select("fid", "ID", rounded("distance").alias("distance"))


@query
def rooftop_unique(t):
    roofs = housing_layers.rooftops(t.buildings("f_footprint_dup"), t.points("Multi"), t.points("Single"), SETTINGS)
    return roofs.select("ID", *box_columns())


@query
def proximity_pairs(t):
    return clusters.proximity_pairs(t.buildings(), "fid", SETTINGS.cluster_gap, SETTINGS.square)


@query
def rooftop_components(t):
    return clusters.proximity_components(t.buildings(), "fid", SETTINGS.cluster_gap, SETTINGS.square)


def _clustered(t) -> DataFrame:
    return clusters.clusters(t.buildings(), "fid", SETTINGS.cluster_gap, SETTINGS.square)


@query
def rooftop_clusters(t):
    return _clustered(t).select("fid", "cluster")


def _density(t, eps: float, least: int) -> DataFrame:
    c = G.centroid("geom")
    centers = t.buildings().select("fid", c.x.alias("x"), c.y.alias("y"))
    return graph.density_clusters(centers, "fid", eps, least)


@query
def density_clusters(t):
    return _density(t, 60.0, 5)


@query
def density_clusters_60_1(t):
    return _density(t, 60.0, 1)


@query
def density_clusters_100_5(t):
    return _density(t, 100.0, 5)


# -- ground ----------------------------------------------------------------------------------------

@query
def exclusion_union(t):
    """Three layers with unlike columns as one."""
    every = t.table("f_layer")
    schools = every.filter("layer = 'schools'").withColumnRenamed("eid", "school")
    lands = [every.filter(F.col("layer") == name) for name in ("cpad", "cced")]
    return readers.union_of([schools, *lands]).select("school", "eid", "layer", "x0", "y0", "w", "h")


@query
def overlay_difference(t):
    rest = overlay.difference(t.ground(), t.exclusions(), "gid", SETTINGS.ground_square)
    return rest.select("gid", *box_columns())


@query
def overlay_difference_area(t):
    rest = overlay.difference(t.ground(), t.exclusions(), "gid", SETTINGS.ground_square)
    return rest.select("gid", rounded(G.area("geom")).alias("area"))


@query
def ground_min_area(t):
    return tables.min_area(t.buildings(), SETTINGS.least_area).select("fid")


@query
def ground_raster_overlap(t):
    ground = t.ground()
    kept = raster.with_any_value(ground, t.cells("v2"), "gid", SECOND)
    return ground.join(kept, "gid", "left_semi").select("gid", F.lit(True).alias("has_impervious_overlap"))


@query
def raster_crop(t):
    return raster.crop_to_points(t.cells("v1"), t.points("Multi"), SETTINGS.aoi_radius, IMPERVIOUS)


@query
def raster_binary(t):
    light = F.col("value").between(SETTINGS.impervious_low, SETTINGS.impervious_high)
    return t.cells("v1").filter(light).select("cx", "cy")


@query
def aoi_cells(t):
    return raster.clip_to_points(t.cells("v1"), t.points("Multi"), SETTINGS.aoi_radius, IMPERVIOUS).select("cx", "cy")


def _light_near(t) -> DataFrame:
    near = raster.clip_to_points(t.cells("v1"), t.points("Multi"), SETTINGS.aoi_radius, IMPERVIOUS)
    return near.filter(F.col("value").between(SETTINGS.impervious_low, SETTINGS.impervious_high)).select("cx", "cy")


@query
def raster_erode(t):
    return raster.eroded(_light_near(t))


@query
def raster_open(t):
    return raster.opened(_light_near(t))


@query
def raster_regions(t):
    return raster.regions(raster.opened(_light_near(t)))


@query
def region_polygons(t):
    drawn = raster.region_polygons(raster.regions(raster.opened(_light_near(t))), IMPERVIOUS)
    return drawn.select("region", *box_columns(), G.area("geom").alias("area"), G.perimeter("geom").alias("border"))


@query
def region_polygons_small_blocks(t):
    """The same polygons from blocks of 4 cells, so that most regions lie in many blocks."""
    drawn = raster.region_polygons(raster.regions(raster.opened(_light_near(t), 4), 4), IMPERVIOUS, 4)
    return drawn.select("region", *box_columns(), G.area("geom").alias("area"), G.perimeter("geom").alias("border"))


@query
def chain_components(t):
    """Buildings in chains by key, as long as the keys go on, dealt out so that no task sees a stretch of a chain."""
    keys = saved(t.table("f_footprint").select("bid").distinct())
    links = keys.select(F.col("bid").alias("u"), (F.col("bid") + 1).alias("v"))
    links = links.join(keys.select(F.col("bid").alias("v")), "v", "left_semi").repartition(64, F.xxhash64("u"))
    return graph.component_labels(keys, links, "bid")


# -- files: fixtures are written with the sinks and read back with the sources ------------------------

UNTRIMMED = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _folder(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/files-{uuid.uuid4().hex}/{name}"


@query
def manifest_file(t):
    """The manifest as a CSV file with untidy headers."""
    path = _folder(t, "manifest")
    t.table("f_manifest").toDF(" Location ", "QuadKey ", " URL").write.options(**UNTRIMMED).csv(path)
    return readers.manifest(t.spark, path).select("location", "quadkey", "url")


def _tiles(t) -> tuple[str, DataFrame]:
    """Compressed tiles of features by the last digit of the part, named as downloads are."""
    path = _folder(t, "tiles")
    lines = t.table("f_geojson").select("line", F.concat(F.lit("quadkey_"), F.col("p_partkey") % 10, F.lit("_tile")).alias("tile"))
    lines.repartition("tile").write.partitionBy("tile").option("compression", "gzip").text(path)
    return path, readers.features(t.spark, path)


@query
def tile_files(t):
    """Footprints per tile of gzip lines, with the lineage from the file's path."""
    shapes = readers.footprints(_tiles(t)[1])
    return shapes.groupBy("quadkey").agg(F.count("*").alias("shapes"), F.sum(G.area("geom")).alias("area"))


@query
def tile_faults(t):
    """Lines without a polygon per tile and reason; no file is damaged."""
    path, read = _tiles(t)
    damaged = readers.damaged_tiles(t.spark, f"{path}/*").select("quadkey", "reason")
    return readers.quarantined(read).select("quadkey", "reason").unionByName(damaged).groupBy("quadkey", "reason").count()


@query
def landed_tiles(t):
    """How many files of each tile have landed; contents are not read."""
    path, _ = _tiles(t)
    return readers.landed_files(t.spark, f"{path}/*", ".txt.gz").groupBy("quadkey").agg(F.count("*").alias("files"))


@query
def housing_file(t):
    path = _folder(t, "housing")
    t.housing().write.options(**UNTRIMMED).csv(path)
    return readers.housing(t.spark, path)


@query
def layer_files(t):
    """Layers with unlike columns, one of them absent, as one; boxes travel with the shapes."""
    every, paths = t.exclusions(), {}
    for name in ("schools", "cpad", "cced"):
        part = every.filter(F.col("layer") == name).drop("layer")
        paths[name] = _folder(t, name)
        writers.write_layer(part.withColumnRenamed("eid", "school") if name == "schools" else part, paths[name], SETTINGS.ground_square)
    both, skipped = readers.layers(t.spark, {**paths, "none": _folder(t, "none")})
    return both.select("school", "eid", "layer", "bbox.*", F.lit(",".join(skipped)).alias("skipped"))


@query
def layer_window(t):
    """Polygons of a layer that meet a window; the file statistics of their boxes leave other files unread."""
    path = _folder(t, "layer")
    writers.write_layer(t.exclusions(), path, SETTINGS.ground_square)
    return readers.layer_window(t.spark, path, WINDOW).select("eid", "layer", "bbox.*")


@query
def cell_files(t):
    """A raster written as a cell table and read through a window."""
    path = _folder(t, "cells")
    writers.write_cells(t.cells("v1"), path)
    return raster.crop(readers.layer(t.spark, path), 20, 30, 60, 80)


@query
def summary_file(t):
    path = _folder(t, "summary")
    writers.write_summary(tract_summary(t), path)
    return readers.summary(t.spark, path)


@query
def feature_file(t):
    """Exclusions as GeoJSON features in longitude and latitude and back."""
    path = _folder(t, "features")
    degrees = t.exclusions().withColumn("geom", G.map_vertices("geom", lambda x, y: (x / 100000 - 120, y / 100000 + 36)))
    writers.write_features(degrees, path)
    back = readers.parsed(t.spark.read.text(path).withColumnRenamed("value", "line"))
    shapes = back.withColumn("eid", F.col("feature.properties")["eid"].cast("long"))
    return readers.footprints(shapes).select("eid", *(F.round(c, 5).alias(n) for c, n in zip(
        [G.bbox("geom")[k] for k in ("xmin", "ymin", "xmax", "ymax")], ("xmin", "ymin", "xmax", "ymax"))))


# -- summary and maps ------------------------------------------------------------------------------

@query
def tract_join_ground(t):
    return housing_layers.tract_join(t.ground(), t.tracts(), "gid", SETTINGS.tract_square, True)


@query
def tract_join_rooftop(t):
    return housing_layers.tract_join(t.buildings(), t.tracts(), "fid", SETTINGS.tract_square, False)


@query
def tract_summary(t):
    return housing_layers.tract_summary(t.ground(), t.buildings(), t.tracts(), SETTINGS.tract_square)


@query
def map_feed(t):
    feed = housing_layers.map_feed(t.tracts(), tract_summary(t))
    return feed.select("GEOID", "metric", "title", "value", *(rounded(G.bbox("geom")[c], 6).alias(c) for c in BOX))


@query
def map_extent(t):
    extent = housing_layers.map_extent(housing_layers.mapped_tracts(t.tracts(), tract_summary(t)))
    return extent.select(*(rounded(c, 6).alias(c) for c in extent.columns))


@query
def aoi_cells_conus(t):
    """Cells near points in a raster of another system than the points."""
    x, y = reproject("lon", "lat", WGS84, CALIFORNIA_ALBERS)
    points = t.table("f_lonlat").select("id", x.alias("x"), y.alias("y"))
    conus = RasterGrid(30.0, 250, 15.0, -7.0, CONUS_ALBERS)
    return raster.cells_near(tables.points_in(points, conus.srid, CALIFORNIA_ALBERS), 60.0, conus)


@query
def cluster_centers(t):
    centers = clusters.cluster_centers(_clustered(t))
    return centers.select("cluster", rounded("x").alias("x"), rounded("y").alias("y"))


@query
def cluster_ground_join(t):
    near = ground_near_clusters.ground_near_clusters(t.ground(), saved(_clustered(t)))
    return near.select("cluster", *box_columns())


# -- whole flows -----------------------------------------------------------------------------------

@query
def rooftop_area_by_tract(t):
    """Area and number of multifamily rooftops by tract."""
    roofs = saved(housing_layers.rooftops(t.buildings(), t.points("Multi"), t.points("Single"), SETTINGS))
    joined = housing_layers.tract_join(roofs, t.tracts(), "fid", SETTINGS.tract_square, False)
    return joined.groupBy("GEOID").agg(F.sum("area_sqm").alias("rooftop_total_area_sqm"),
                                       F.count("area_sqm").alias("rooftop_polygon_count"))


@query
def housing_summary(t):
    """Both layers from raw rasters, points, lands and buildings down to the tract summary."""
    multi, single, buildings = t.points("Multi"), t.points("Single"), t.buildings()
    land = housing_layers.patches(t.cells("v1"), multi, IMPERVIOUS, SETTINGS)
    ground = saved(housing_layers.ground_layer(saved(land), [t.exclusions()], buildings, t.cells("v2"), SECOND, SETTINGS))
    roofs = saved(housing_layers.rooftop_layer(housing_layers.rooftops(buildings, multi, single, SETTINGS), SETTINGS))
    summary = housing_layers.tract_summary(ground, roofs, t.tracts(), SETTINGS.tract_square)
    return summary.withColumns({c: rounded(c) for c in ("ground_total_area_sqm", "rooftop_total_area_sqm")})
