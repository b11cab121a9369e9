"""Clusters of polygons that lie close to each other, their centres, and what lies around them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrid.functions import geom as G
from landgrid.functions.predicates import polygon_distance
from landgrid.operators import grid
from landgrid.operators.graph import dense_numbers
from landgrid.operators.squares import least_of_component, square_code
from landgrid.shared import saved


def proximity_pairs(polygons: DataFrame, key: str, gap: float, size: float) -> DataFrame:
    """All pairs ``u < v`` of polygons at most ``gap`` apart: the join's own result.

    Clustering does not use it; see :func:`proximity_links`.
    """
    return grid.close_pairs(polygons, key, gap, size)


def _touching(polygons: DataFrame, key: str, gap: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Polygons as ``key, box, home, label``, joined by chains of vertices in the same small square, whose diagonal is
    ``gap``; the squares ``home, least`` that they stand for, and the edges ``u, v`` between squares.

    A polygon's squares are linked by a star, so the graph is one of squares: copies and crowds in a square add
    nothing to it. ``label`` is the smallest key of a component, ``least`` that of a square.
    """
    side = gap / math.sqrt(2.0) * (1 - 1e-9)
    places = F.array_distinct(F.transform(F.flatten(F.flatten("geom")), lambda v: F.struct(
        F.floor(v.x / side).alias("cx"), F.floor(v.y / side).alias("cy"))))
    shapes = saved(grid.with_box(polygons.select(F.col(key).cast("long").alias("key"), "geom"))
                   .select("key", "box", places.alias("places")))
    home = F.get("places", F.lit(0))
    homes = shapes.select("key", "box", square_code(home.cx, home.cy).alias("home"))
    edges = saved(shapes.filter(F.size("places") > 1)
                  .select(square_code(home.cx, home.cy).alias("u"), F.explode("places").alias("p"))
                  .select("u", square_code(F.col("p.cx"), F.col("p.cy")).alias("v")).filter("u <> v").distinct())
    squares = saved(homes.filter("home is not null").groupBy("home").agg(F.min("key").alias("least")))
    labels = least_of_component(squares, edges, "home", "least", "label").select("home", "label")
    groups = homes.join(labels, "home", "left").select("key", "box", "home", F.coalesce("label", "key").alias("label"))
    return saved(groups), squares, edges


def _close_groups(shapes: DataFrame, groups: DataFrame, gap: float, size: float) -> DataFrame:
    """``u, v, home_u, home_v``: groups with polygons at most ``gap`` apart, and where two such polygons are.

    Per square, groups whose extents are close are paired, and only their polygons near the other's extent are
    tested."""
    listed = saved(grid.cover(groups, size, gap))
    square = ["cx", "cy"]
    extents = listed.groupBy(*square, "label").agg(F.struct(
        *(f(f"box.{c}").alias(c) for f, c in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax")))).alias("extent"))
    one = extents.select(*square, F.col("label").alias("u"), F.col("extent").alias("extent_u"))
    two = extents.select(*square, F.col("label").alias("v"), F.col("extent").alias("extent_v"))
    pairs = saved(one.join(two, square).filter("u < v")
                  .filter(G.box_gap(F.col("extent_u"), F.col("extent_v")) <= gap))

    def near(mine, other):
        """Polygons of component ``mine`` near the extent of component ``other``."""
        rows = listed.withColumnRenamed("label", mine).join(pairs, [*square, mine])
        rows = rows.filter(G.box_gap(F.col("box"), F.col(f"extent_{other}")) <= gap)
        return rows.select(*square, "u", "v", *(F.col(c).alias(f"{c}_{mine}") for c in ("key", "home", "box")))

    close = (near("u", "v").join(near("v", "u"), [*square, "u", "v"])
             .filter(G.box_gap(F.col("box_u"), F.col("box_v")) <= gap)
             .select("u", "v", "key_u", "key_v", "home_u", "home_v").distinct())
    return (close.join(shapes.select(F.col("key").alias("key_u"), F.col("geom").alias("geom_u")), "key_u")
            .join(shapes.select(F.col("key").alias("key_v"), F.col("geom").alias("geom_v")), "key_v")
            .filter(polygon_distance("geom_u", "geom_v") <= gap)
            .groupBy("u", "v").agg(F.min(F.struct("home_u", "home_v")).alias("at")).select("u", "v", "at.*"))


def _shapes(polygons: DataFrame, key: str) -> DataFrame:
    return polygons.select(F.col(key).cast("long").alias("key"), "geom")


def proximity_links(polygons: DataFrame, key: str, gap: float, size: float) -> DataFrame:
    """Edges ``u, v`` with the components of :func:`proximity_pairs`, but far fewer of them: a star a group of
    touching polygons, and one edge for two groups that are close."""
    groups, _, _ = _touching(polygons, key, gap)
    close = _close_groups(_shapes(polygons, key), groups, gap, size).select("u", "v")
    return groups.filter("key <> label").select(F.col("label").alias("u"), F.col("key").alias("v")).unionByName(close)


def proximity_components(polygons: DataFrame, key: str, gap: float, size: float, label: str = "component") -> DataFrame:
    """``key, label``: the smallest key of the component of :func:`proximity_pairs` that a polygon belongs to.

    ``key`` is unique. Close groups are two squares with an edge, so all links are short and the components are those
    of squares."""
    groups, squares, edges = _touching(polygons, key, gap)
    close = _close_groups(_shapes(polygons, key), groups, gap, size)
    edges = edges.unionByName(close.select(F.col("home_u").alias("u"), F.col("home_v").alias("v")))
    found = least_of_component(squares, edges, "home", "least", "found").select("home", "found")
    return groups.join(found, "home", "left").select(F.col("key").alias(key), F.coalesce("found", "label").alias(label))


def clusters(polygons: DataFrame, key: str, gap: float, size: float, number: str = "cluster") -> DataFrame:
    """``polygons`` (``key`` is unique) with the smallest key of their cluster and a dense cluster number."""
    found = dense_numbers(proximity_components(polygons, key, gap, size), "component", number)
    return polygons.join(found, key)


def cluster_centers(rooftops: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Mean of the distinct rooftop centroids of each cluster, as ``cluster, x, y``."""
    spots = rooftops.select(cluster, G.centroid("geom").alias("c")).select(cluster, "c.x", "c.y").distinct()
    return spots.groupBy(cluster).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def around_clusters(ground: DataFrame, centers: DataFrame, key: str, cluster: str, radius: float,
                    size: float) -> DataFrame:
    """Ground polygons at most ``radius`` from a cluster centre, each with its smallest cluster."""
    found = grid.first_within(ground, centers, key, cluster, radius, size)
    return ground.join(found, key)
