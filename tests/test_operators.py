"""Operators against brute force, on data with hot spots and copies."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgrid.functions import geom as G
from landgrid.functions.predicates import point_distances, polygon_distances
from landgrid.operators import clusters, graph, grid, overlay, raster, tables
from landgrid.schemas import RasterGrid, SridMismatch, srid_of, with_srid
from tests.shapes import crowd, flat_of, layer, points, rect, star


@pytest.fixture(scope="module")
def scene(spark):
    rng = np.random.default_rng(7)
    shapes = [star(rng, *rng.uniform(0, 2000, 2), rng.integers(3, 9), 25) for _ in range(250)]
    shapes += [star(rng, *(1000 + rng.normal(0, 15, 2)), 5, 8) for _ in range(120)]       # hot square
    shapes += [shapes[250]] * 30                                                          # copies
    shapes += [star(rng, *rng.uniform(0, 2000, 2), 90, 400) for _ in range(4)]            # large
    xy = crowd(rng, 900)
    g = flat_of(shapes)
    rows, cols = np.repeat(np.arange(len(shapes)), len(xy)), np.tile(np.arange(len(xy)), len(shapes))
    distance = point_distances(g.take(rows), xy[cols, 0], xy[cols, 1]).reshape(len(shapes), len(xy))
    return layer(spark, shapes).cache(), points(spark, xy).cache(), distance, shapes


@pytest.fixture(params=[10_000, 8], ids=["plain", "narrowed"])
def crowded(request, monkeypatch):
    monkeypatch.setattr(grid, "CROWDED", request.param)


@pytest.mark.parametrize("reach, size", [(0.0, 64.0), (30.0, 50.0), (30.0, 300.0)])
def test_within(scene, crowded, reach, size):
    shapes, spots, distance, _ = scene
    got = {r.fid for r in grid.within(shapes, spots, "fid", reach, size).collect()}
    assert got == set(np.flatnonzero((distance <= reach).any(axis=1)).tolist())


@pytest.mark.parametrize("size", [60.0, 500.0])
def test_nearest_keeps_ties(scene, crowded, size):
    shapes, spots, distance, _ = scene
    got = {(r.fid, r.ID) for r in grid.nearest(shapes, spots, "fid", "ID", 100.0, size).collect()}
    best = distance.min(axis=1, keepdims=True)
    want = np.argwhere((np.abs(distance - best) <= 1e-12) & (distance <= 100.0))
    assert got == set(map(tuple, want.tolist()))


def test_first_within(scene, crowded):
    shapes, spots, distance, _ = scene
    got = {r.fid: r.ID for r in grid.first_within(shapes, spots, "fid", "ID", 150.0, 256.0).collect()}
    want = {k: int(np.flatnonzero(d <= 150.0)[0]) for k, d in enumerate(distance) if (d <= 150.0).any()}
    assert got == want


@pytest.mark.parametrize("cut", [True, False])
@pytest.mark.parametrize("size", [40.0, 333.0])
def test_intersecting(spark, scene, cut, size):
    shapes, _, _, left = scene
    rng = np.random.default_rng(9)
    right = [star(rng, *rng.uniform(0, 2000, 2), 150, 900) for _ in range(6)]
    right += [rect(0, 0, 1000, 1000), rect(1000, 0, 2000, 1000), rect(400, 400, 410, 410)]
    pairs = grid.intersecting(shapes, layer(spark, right, "tract"), "fid", "tract", size, cut_left=cut)
    a, b = flat_of(left), flat_of(right)
    i, j = np.repeat(np.arange(len(left)), len(right)), np.tile(np.arange(len(right)), len(left))
    want = set(zip(*[v[polygon_distances(a.take(i), b.take(j)) == 0].tolist() for v in (i, j)]))
    assert {(r.fid, r.tract) for r in pairs.collect()} == want


@pytest.mark.parametrize("cut", [True, False])
def test_touching_at_square_borders_counts(spark, cut):
    left = [rect(64, 0, 80, 10), rect(0, 64, 10, 70), rect(128, 128, 140, 140), rect(200, 200, 210, 210)]
    big = [[[[[x, y] for x, y in [(0, 0), (64, 0), (64, 64), (0, 64), (0, 0)]]]], rect(64, 64, 128, 128)]
    big[0][0][0][1:1] = [[float(x), 0.0] for x in np.linspace(1, 63, 80)]                 # large enough to be cut
    big[1][0][0][1:1] = [[float(x), 64.0] for x in np.linspace(65, 127, 80)]
    pairs = grid.intersecting(layer(spark, left), layer(spark, big, "tract"), "fid", "tract", 64.0, cut_left=cut)
    assert {(r.fid, r.tract) for r in pairs.collect()} == {(0, 0), (1, 0), (2, 1)} | {(0, 1)} - {(0, 1)}


def test_layers_must_share_their_reference_system(spark, scene):
    shapes = scene[0]
    with pytest.raises(SridMismatch):
        grid.intersecting(with_srid(shapes, 3310), with_srid(shapes, 26910), "fid", "fid", 64.0)
    with pytest.raises(SridMismatch):
        grid.intersecting(with_srid(shapes, 3310), shapes, "fid", "fid", 64.0)          # a lost tag
    assert srid_of(overlay.simplified(with_srid(shapes, 3310), 1.0)) == 3310
    assert srid_of(overlay.difference(with_srid(shapes, 3310), with_srid(shapes, 3310), "fid", 64.0)) == 3310


@pytest.mark.parametrize("name", ["BroadcastNestedLoopJoin", "CartesianProduct"])
def test_spatial_joins_are_equi_joins(spark, scene, name):
    shapes, spots, _, _ = scene
    frames = [grid.within(shapes, spots, "fid", 30.0, 64.0), grid.nearest(shapes, spots, "fid", "ID", 100.0, 64.0),
              grid.intersecting(shapes, shapes.withColumnRenamed("fid", "other"), "fid", "other", 64.0),
              clusters.proximity_pairs(shapes, "fid", 24.0, 64.0),
              overlay.difference(shapes, shapes, "fid", 64.0)]
    for frame in frames:
        assert name not in frame._jdf.queryExecution().toString()


def test_difference_in_groups_equals_difference_at_once(spark):
    rng = np.random.default_rng(11)
    left = [rect(0, 0, 300, 300), rect(500, 500, 600, 600), rect(290, 0, 400, 100)]
    cuts = [star(rng, *rng.uniform(0, 350, 2), 6, 25) for _ in range(150)] + [star(rng, 100, 100, 5, 9)] * 40
    a, b = layer(spark, left, "gid"), layer(spark, cuts).drop("fid")
    for reach in (0.0, 5.0):
        whole, parts = ({r.gid: r.area for r in overlay.difference(a, b, "gid", 128.0, reach, at_once)
                         .select("gid", G.area("geom").alias("area"), F.expr("size(geom)")).collect()}
                        for at_once in (1000, 4))
        assert whole.keys() == parts.keys() and whole[1] == 10_000
        assert all(whole[k] == pytest.approx(parts[k], abs=1e-4) for k in whole)


@pytest.mark.parametrize("crowd_at", [10_000, 5])
def test_near_polygons_in_divided_squares(spark, scene, monkeypatch, crowd_at):
    monkeypatch.setattr(grid, "CROWDED", crowd_at)
    shapes, _, _, left = scene
    a = grid.with_box(shapes).drop("geom")
    for reach in (0.0, 7.0):
        got = grid.near_polygons(a, a, reach, 400.0).select("a_fid", "b_fid").collect()
        x0, y0, x1, y1 = flat_of(left).bounds()
        dx = np.maximum(np.maximum(x0[:, None] - x1, x0 - x1[:, None]), 0)
        dy = np.maximum(np.maximum(y0[:, None] - y1, y0 - y1[:, None]), 0)
        want = set(map(tuple, np.argwhere(np.hypot(dx, dy) <= reach).tolist()))
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_polygons_that_vanish_are_dropped(spark):
    a = layer(spark, [rect(0, 0, 10, 10), rect(20, 0, 30, 10)], "gid")
    rest = overlay.difference(a, layer(spark, [rect(-1, -1, 11, 11)]), "gid", 64.0)
    assert [r.gid for r in rest.collect()] == [1]


def union_find(n, edges):
    parent = list(range(n))

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for u, v in edges:
        a, b = sorted((top(u), top(v)))
        parent[b] = a
    return {k: top(k) for k in range(n)}


@pytest.mark.parametrize("at_once", [4, 50, 1 << 20])
def test_components(spark, at_once, monkeypatch):
    monkeypatch.setattr(graph, "EDGES_AT_ONCE", at_once)
    rng = np.random.default_rng(3)
    n = 900
    edges = [(k, k + 1) for k in range(0, 120)]                                    # a long chain
    edges += [(130, int(k)) for k in rng.integers(131, 500, 300)]                  # a hub with a third of all edges
    edges += [tuple(map(int, e)) for e in rng.integers(520, n, (300, 2))]
    edges += edges[:50]
    nodes = spark.range(n).withColumnRenamed("id", "key")
    frame = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = graph.component_labels(nodes, frame, "key")
    assert {r.key: r.component for r in got.collect()} == union_find(n, edges)


def test_dense_numbers(spark):
    labelled = spark.createDataFrame([(0, 7), (1, 3), (2, 7), (3, 90)], "key long, component long")
    got = {r.key: r.cluster for r in graph.dense_numbers(labelled, "component").collect()}
    assert got == {0: 1, 1: 0, 2: 1, 3: 2}


def test_clusters_follow_all_close_pairs(spark, scene):
    shapes, _, _, left = scene
    a = flat_of(left)
    i, j = np.triu_indices(len(left), 1)
    near = polygon_distances(a.take(i), a.take(j)) <= 24.0
    want = union_find(len(left), list(zip(i[near].tolist(), j[near].tolist())))
    links = clusters.proximity_links(shapes, "fid", 24.0, 100.0)
    got = graph.component_labels(shapes.select("fid"), links, "fid")
    assert {r.fid: r.component for r in got.collect()} == want
    pairs = clusters.proximity_pairs(shapes, "fid", 24.0, 100.0)
    assert {(r.u, r.v) for r in pairs.collect()} == set(zip(i[near].tolist(), j[near].tolist()))
    # a hot square costs a star, not all of its pairs
    assert links.count() < near.sum() / 5


@pytest.mark.parametrize("eps, min_samples", [(40.0, 5), (15.0, 3), (60.0, 1)])
def test_density_clusters(spark, eps, min_samples):
    xy = crowd(np.random.default_rng(5), 500, 900.0)
    near = np.hypot(*(xy[:, None, :] - xy[None, :, :]).transpose(2, 0, 1)) <= eps
    core = near.sum(axis=1) >= min_samples
    u, v = np.nonzero(near & core[:, None] & core[None, :])
    label = union_find(len(xy), list(zip(u.tolist(), v.tolist())))
    want = {}
    for k in range(len(xy)):
        reached = [label[m] for m in np.flatnonzero(near[k] & core)]
        want[k] = label[k] if core[k] else min(reached, default=-1)
    got = graph.density_clusters(points(spark, xy, "fid"), "fid", eps, min_samples)
    assert {r.fid: r.cluster for r in got.collect()} == want


@pytest.mark.parametrize("eps, min_samples", [(40.0, 5), (60.0, 1)])
def test_density_clusters_by_divided_squares(spark, eps, min_samples, monkeypatch):
    """The walk goes down to single points if nodes may make no pairs."""
    xy = crowd(np.random.default_rng(6), 400, 700.0)
    whole = graph.density_clusters(points(spark, xy, "fid"), "fid", eps, min_samples)
    whole = {r.fid: r.cluster for r in whole.collect()}
    monkeypatch.setattr(graph, "POINT_PAIRS", 2)
    got = graph.density_clusters(points(spark, xy, "fid"), "fid", eps, min_samples)
    assert {r.fid: r.cluster for r in got.collect()} == whole


def test_two_crowds_make_few_pairs(spark, monkeypatch):
    """10 ** 5 points each in two squares whose extents are near; only ``witness`` brings the crowds together."""
    rng = np.random.default_rng(7)
    n = 100_000
    left = np.concatenate([rng.uniform(0, 0.5, (n, 2)), [[0.2, 7.0]]])
    right = np.concatenate([rng.uniform(0, 0.2, (n, 2)) + [10.3, 3.4], [[13.0, 0.1]]])
    made, real = [], graph._apart
    monkeypatch.setattr(graph, "_apart", lambda pairs, eps: made.append(real(pairs, eps)) or made[-1])
    for witness, clusters in (([11.0, 6.9], 2), ([10.4, 0.3], 1)):
        xy = np.concatenate([left, right, [witness]])
        got = graph.density_clusters(points(spark, xy, "fid"), "fid", 10.0, 4)
        assert got.select("cluster").distinct().count() == clusters
    assert len(made) > 2 and max(m.count() for m in made) < 10_000


def image_cells(spark, image):
    y, x = np.nonzero(image)
    return spark.createDataFrame([(int(a) - 20, int(b) - 20) for a, b in zip(x, y)], "cx int, cy int")


def cells_of(df):
    return {(r.cx + 20, r.cy + 20) for r in df.collect()}


@pytest.fixture(scope="module")
def image():
    rng = np.random.default_rng(1)
    return rng.uniform(size=(50, 60)) < np.where(np.arange(60) % 20 < 16, 0.93, 0.2)


def shifted(image, keep):
    padded = np.pad(image, 1)
    stack = [padded[1 + a:1 + a + image.shape[0], 1 + b:1 + b + image.shape[1]] for a in (-1, 0, 1) for b in (-1, 0, 1)]
    return keep(stack, axis=0)


@pytest.mark.parametrize("block", [7, 256])
def test_opening(spark, image, block):
    cells = image_cells(spark, image)
    worn = shifted(image, np.all)
    grown = shifted(worn, np.any)
    assert cells_of(raster.eroded(cells, block)) == {(x, y) for y, x in np.argwhere(worn)}
    opened = raster.opened(cells, block)
    assert cells_of(opened) == {(x, y) for y, x in np.argwhere(grown)}
    # opening twice changes nothing
    assert cells_of(raster.opened(opened, block)) == cells_of(opened)


def flood(cells):
    left, out = set(cells), []
    while left:
        stack, region = [left.pop()], set()
        while stack:
            x, y = stack.pop()
            region.add((x, y))
            for other in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if other in left:
                    left.remove(other)
                    stack.append(other)
        out.append(frozenset(region))
    return set(out)


@pytest.mark.parametrize("block", [7, 256])
def test_regions_and_their_polygons(spark, image, block):
    labelled = raster.regions(image_cells(spark, image), block).cache()
    groups = {}
    for r in labelled.collect():
        groups.setdefault(r.region, set()).add((r.cx + 20, r.cy + 20))
    assert {frozenset(g) for g in groups.values()} == flood({(x, y) for y, x in np.argwhere(image)})
    raster_grid = RasterGrid(30.0, 250, 100.0, -50.0)
    drawn = raster.region_polygons(labelled, raster_grid, block)
    rows = drawn.select("region", G.area("geom").alias("area"), overlay.is_valid("geom").alias("ok")).collect()
    assert all(r.ok for r in rows) and len(rows) == len(groups)
    assert {r.region: r.area for r in rows} == {k: 900.0 * len(g) for k, g in groups.items()}


@pytest.mark.parametrize("reach", [10.0, 95.0, 250.0])
def test_cells_near_points(spark, reach):
    raster_grid = RasterGrid(30.0, 250, 5.0, 7.0)
    xy = crowd(np.random.default_rng(2), 200, 1500.0)
    cx, cy = np.meshgrid(np.arange(-12, 65), np.arange(-12, 65))
    gap = np.hypot((cx[..., None] + 0.5) * 30 + 5 - xy[:, 0], (cy[..., None] + 0.5) * 30 + 7 - xy[:, 1]).min(axis=-1)
    want = set(zip(cx[gap <= reach].tolist(), cy[gap <= reach].tolist()))
    assert {(r.cx, r.cy) for r in raster.cells_near(points(spark, xy), reach, raster_grid).collect()} == want


def test_polygons_with_any_value(spark, scene):
    shapes, _, _, left = scene
    raster_grid = RasterGrid(20.0, -1)
    cx, cy = (v.ravel() for v in np.meshgrid(np.arange(100), np.arange(100)))
    value = np.where((cx // 5 + cy // 7) % 4 == 0, 3, -1)
    value = np.where((cx + cy) % 11 == 0, None, value)
    cells = spark.createDataFrame([(int(a), int(b), None if v is None else int(v)) for a, b, v in zip(cx, cy, value)],
                                  "cx int, cy int, value int")
    spots = np.column_stack([cx * 20.0 + 10, cy * 20.0 + 10])[value == 3]
    g = flat_of(left)
    want = {k for k in range(len(left))
            if (point_distances(g.take(np.full(len(spots), k)), spots[:, 0], spots[:, 1]) == 0).any()}
    got = {r.fid for r in raster.with_any_value(shapes, cells, "fid", raster_grid).collect()}
    assert got == want
    # a polygon between the centres has no cell, and one outside the raster has none either
    small = layer(spark, [rect(1, 1, 8, 8), rect(5000, 5000, 6000, 6000)])
    assert raster.with_any_value(small, cells, "fid", raster_grid).count() == 0


def test_row_ids_are_dense_and_ordered(spark):
    rng = np.random.default_rng(0)
    values = rng.permutation(1000).tolist()
    got = tables.row_ids(spark.createDataFrame([(int(v),) for v in values], "v long").repartition(7), ["v"]).collect()
    assert all(r.v == r.row_id for r in got) and len(got) == 1000


def test_first_per_geometry(spark):
    shapes = layer(spark, [rect(0, 0, 1, 1), rect(0, 0, 2, 2), rect(0, 0, 1, 1)]).withColumn("ID", 10 - F.col("fid"))
    got = tables.first_per_geometry(shapes, "ID").collect()
    assert {(r.fid, r.ID) for r in got} == {(2, 8), (1, 9)}
    turned = [[[[0, 0], [0, 1], [1, 1], [1, 0], [0, 0]]]]
    assert tables.distinct_geometry(layer(spark, [rect(0, 0, 1, 1), turned])).count() == 2


def test_exploded_and_min_area(spark):
    two = layer(spark, [rect(0, 0, 20, 20) + rect(50, 0, 53, 3), rect(0, 0, 10, 10)])
    parts = tables.exploded(tables.min_area(two, 100.0))
    assert sorted((r.fid, r.part) for r in parts.collect()) == [(0, 0), (0, 1), (1, 0)]
    assert sorted(r.fid for r in tables.min_area(parts, 100.0).collect()) == [0, 1]


def test_numbers_from_dirty_text(spark):
    texts = [" 1.5 ", "n/a", None, "NaN", "inf", "-Infinity", "", "2e3", "-7"]
    got = [r.v for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tables.numeric("t").alias("v")).collect()]
    assert got == [1.5, None, None, None, None, None, None, 2000.0, -7.0]


def test_observation_and_guard(spark):
    frame, seen = tables.observed(spark.range(10).filter("id > 3"), "kept")
    frame.count()
    assert seen.get["rows"] == 6
    with pytest.raises(tables.EmptyResult):
        tables.require_rows(spark.range(0), "nothing here")


def test_cluster_centers_count_equal_centroids_once(spark):
    roofs = layer(spark, [rect(0, 0, 2, 2), rect(0, 0, 2, 2), rect(10, 0, 12, 2)]).withColumn("cluster", F.lit(4))
    (row,) = clusters.cluster_centers(roofs).collect()
    assert (row.cluster, row.x, row.y) == (4, 6.0, 1.0)


def test_centroid_and_perimeter(spark):
    hole = [[*rect(0, 0, 4, 4)[0], rect(0.5, 0.5, 1.5, 1.5)[0][0]]]
    df = layer(spark, [hole, rect(1e6, 1e6, 1e6 + 2, 1e6 + 4)])
    a, b = df.orderBy("fid").select(G.centroid("geom").alias("c"), G.perimeter("geom").alias("p"), G.area("geom").alias("a")).collect()
    assert a.c.x == pytest.approx((16 * 2 - 1) / 15) and a.p == 20 and a.a == 15
    assert (b.c.x, b.c.y, b.p) == (1e6 + 1, 1e6 + 2, 12) and math.isclose(b.a, 8)
