"""What has to stay bounded when the tables grow, on tables small enough for a test."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landgrid.functions import geom as G
from landgrid.functions import slabs
from landgrid.functions.arrow_geom import GEOM_TYPE, flat
from landgrid.functions.predicates import is_valid, polygon_distances
from landgrid.operators import clusters, graph, grid, overlay, squares
from landgrid.schemas import GEOM
from tests.plans import plan_of, plans_written
from tests.shapes import crowd, flat_of, layer, points, rect, star


def test_batches_for_python_are_bounded_in_bytes(spark):
    """Rows of 100 KB: 10,000 of them would be one batch of 20 MB here."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    rows = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    found = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 20_000_000 and max(found) <= 5_000_000


def test_pairs_do_not_grow_with_the_density_of_points(spark, monkeypatch):
    """A polygon with a point nearby is not paired with all points in reach; results are those of all pairs."""
    rng = np.random.default_rng(8)
    corners = rng.uniform(0, 400, (50, 2))
    shapes = layer(spark, [rect(x, y, x + 10, y + 8) for x, y in corners.tolist()] + [rect(700, 700, 712, 705), rect(5000, 0, 5010, 9)])
    xy = np.concatenate([rng.uniform(0, 400, (1000, 2)), [[760.0, 700.0], [640.0, 705.0]]]).round(3)
    xy = np.concatenate([xy, xy[:30]])                    # ties
    boxes = [(x, y, x + 10, y + 8) for x, y in corners.tolist()] + [(700, 700, 712, 705), (5000, 0, 5010, 9)]
    gap = np.array([np.hypot(np.maximum(0, np.maximum(a - xy[:, 0], xy[:, 0] - c)), np.maximum(0, np.maximum(b - xy[:, 1], xy[:, 1] - d)))
                    for a, b, c, d in boxes])
    listed, pairs = [], grid._point_pairs
    monkeypatch.setattr(grid, "_point_pairs", lambda *a, **k: listed.append(pairs(*a, **k)) or listed[-1])
    spots = points(spark, xy)
    label = {r.fid: r.ID for r in grid.nearest_label(shapes, spots, "fid", "ID", 100.0, 128.0).collect()}
    assert sum(p.count() for p in listed) <= 50 * 40
    near = np.isclose(gap, gap.min(axis=1, keepdims=True), atol=1e-9) & (gap <= 100)
    assert label == {k: int(np.flatnonzero(row)[0]) for k, row in enumerate(near) if row.any()}
    ties = {(r.fid, r.ID) for r in grid.nearest(shapes, spots, "fid", "ID", 100.0, 128.0).collect()}
    assert ties == {(int(k), int(i)) for k, i in zip(*np.nonzero(near))}
    for reach in (0.0, 2.0, 30.0, 60.0):
        found = [r.fid for r in grid.within(shapes, spots, "fid", reach, 128.0).collect()]
        assert sorted(found) == np.flatnonzero((gap <= reach).any(axis=1)).tolist()


def test_density_clusters_send_no_table_through_the_driver(spark, monkeypatch):
    """Files of spots are small beside the hash table made of them, so their size must not decide on a broadcast."""
    plans = plans_written(monkeypatch, graph, squares)
    spots = points(spark, crowd(np.random.default_rng(5), 600))
    found = graph.density_clusters(spots, "ID", 30.0, 4)
    assert found.count() == 600
    assert len(plans) > 4
    assert not [p for p in [*plans, plan_of(found)] if "BroadcastHashJoin" in p]


@pytest.mark.parametrize("reach", [0.0, 5.0])
def test_crowded_cuts_are_united_before_they_meet_polygons(spark, monkeypatch, reach):
    """Where many cuts lie on many polygons, their pairs are never listed; the rest is that of single cuts."""
    rng = np.random.default_rng(3)
    left = [rect(x, y, x + 90, y + 70) for x, y in rng.uniform(0, 500, (40, 2)).tolist()]
    left += [rect(-2000, -2000, 2500, 2500), [rect(0, 0, 200, 200)[0] + [r[::-1] for r in rect(50, 50, 90, 90)[0]]]]
    cuts = [star(rng, *rng.uniform(0, 600, 2), 6, 40) for _ in range(250)] + [star(rng, 150, 150, 90, 200)]
    a, b = layer(spark, left, "gid"), layer(spark, cuts).drop("fid")
    whole = overlay.difference(a, b, "gid", 256.0, reach, 10_000).select("gid", G.area("geom").alias("area"), *bounds()).collect()
    monkeypatch.setattr(overlay, "_minus", lambda *_: F.raise_error(F.lit("a crowded polygon was cut pair by pair")).cast(GEOM))
    listed = []
    near = grid.near_polygons
    monkeypatch.setattr(grid, "near_polygons", lambda *a: listed.append(near(*a)) or listed[-1])
    rest = overlay.difference(a, b, "gid", 256.0, reach, 8)
    parts = {r.gid: r for r in rest.select("gid", G.area("geom").alias("area"), *bounds()).collect()}
    assert listed[0].count() == 0
    assert set(parts) == {r.gid for r in whole}
    for r in whole:
        assert list(parts[r.gid]) == pytest.approx(list(r), abs=1e-4)
    assert rest.filter(~is_valid("geom")).count() == 0


def bounds():
    return [G.bbox("geom")[c].alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]


def test_no_task_gets_all_edges_of_a_hub(spark, monkeypatch):
    """A node with very many edges is joined where its edges lie; components are the same."""
    monkeypatch.setattr(graph, "HUB", 20)
    star = [(7, 1000 + k) for k in range(300)] + [(1000 + k, 2000 + k) for k in range(5)] + [(3, 2000), (500, 501)]
    edges = spark.createDataFrame(star, "u long, v long").repartition(3)
    rows = graph._with_low(edges, graph.saved(edges.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n"))))
    assert {tuple(r) for r in rows.select("u", "v", "low").collect()} == {(u, v, min(w for a, w in star if a == u)) for u, v in star}
    dealt = spark.createDataFrame([(7, k) for k in range(300)], "u long, v long").repartition(6)
    lows = graph.saved(dealt.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n")))
    held = graph._with_low(dealt, lows).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 300 and max(r["count"] for r in held) <= 100
    roots = {r.member: r.root for r in graph.component_roots(edges).collect()}
    assert roots == {n: 3 for e in star if e[0] != 500 for n in e if n != 3} | {501: 500}


def test_a_chain_shrinks_with_each_round(spark, monkeypatch):
    """Rows written for a chain dealt at random number a small multiple of its nodes, not of its nodes times the rounds."""
    monkeypatch.setattr(graph, "contracted", lambda edges: edges.select("u", "v").filter("u <> v"))    # as where tasks are many
    rows, write = [], graph.saved
    monkeypatch.setattr(graph, "saved", lambda df: rows.append(write(df)) or rows[-1])
    edges = spark.range(0, 1000).selectExpr("id * 5 as u", "id * 5 + 5 as v").repartition(8, F.xxhash64("u"))
    edges = edges.unionByName(spark.createDataFrame([(-9, 0), (0, -9), (70_000, 70_001), (70_001, 70_001)], "u long, v long"))
    found = {r.member: r.root for r in graph.component_roots(edges).collect()}
    assert found == {5 * k: -9 for k in range(1001)} | {70_001: 70_000}
    assert sum(df.count() for df in rows) <= 16 * 1000


@pytest.mark.parametrize("reach", [0.0, 5.0])
def test_cells_that_cuts_cover(spark, reach):
    """A covered cell lies in the grown cut, and a cell with a part of it is touched; convex and other shapes."""
    rng = np.random.default_rng(11)
    rings = [rect(x, y, x + w, y + h) for x, y, w, h in rng.uniform([-20, -20, 5, 5], [60, 60, 70, 70], (30, 4)).tolist()]
    rings += [star(rng, *rng.uniform(0, 64, 2), 8, 60) for _ in range(10)] + [rect(-50, -50, 200, 200)]
    rings += [[rect(-40, -40, 150, 150)[0] + [r[::-1] for r in rect(20, 20, 44, 40)[0]]]]
    frame = layer(spark, rings).withColumns({"reach": F.lit(reach), "cx": F.lit(0).cast("long"), "cy": F.lit(0).cast("long")})
    rows = frame.select("geom", overlay._covers(64.0)("geom", "reach", "cx", "cy").alias("c")).select("geom", "c.*").toArrow().to_pydict()
    grown = slabs.buffered(flat(pa.array(rows["geom"], GEOM_TYPE)), np.full(len(rings), reach)) if reach else flat(pa.array(rows["geom"], GEOM_TYPE))
    corner = np.stack(np.meshgrid(np.arange(8), np.arange(8)), axis=-1).reshape(-1, 2) * 8.0
    cells = np.hstack([corner, corner + 8])
    for k, (covered, touched) in enumerate(zip(rows["covered"], rows["touched"])):
        one = slabs.Edges.of(grown.take(np.full(64, k)), None, 1)
        common = slabs.intersection(slabs.Edges.boxes(cells, np.arange(64), 0) + one, np.full(64, 2)).areas(64)
        bits = lambda value: (np.array(value).astype(np.int64).astype(np.uint64) >> np.arange(64, dtype=np.uint64)) & np.uint64(1) == 1
        assert (common[bits(covered)] >= 64 - 1e-6).all() and (common[~bits(touched)] < 1e-9).all()
    assert sum(bin(c & (2 ** 64 - 1)).count("1") for c in rows["covered"]) > 300
    assert rows["covered"][-2] == -1


def test_crowded_cuts_need_no_sweep(spark, monkeypatch):
    """Squares that single cuts cover cell by cell are full, and cuts in covered cells only are not united."""
    rng = np.random.default_rng(12)
    cuts = [rect(x, y, x + 25, y + 22) for x, y in rng.uniform(-30, 90, (500, 2)).tolist()] + [star(rng, 160, 160, 5, 60)]
    a = layer(spark, [rect(-60, -60, 250, 230), rect(80, 10, 130, 200)], "gid")
    b = layer(spark, cuts).drop("fid")
    whole = overlay.difference(a, b, "gid", 256.0, 5.0, 10_000).select("gid", G.area("geom").alias("area"), *bounds()).collect()
    united, write = [], overlay.saved
    monkeypatch.setattr(overlay, "saved", lambda df: united.append(write(df)) or united[-1])
    parts = {r.gid: r for r in overlay.difference(a, b, "gid", 256.0, 5.0).select("gid", G.area("geom").alias("area"), *bounds()).collect()}
    assert set(parts) == {r.gid for r in whole}
    for r in whole:
        assert list(parts[r.gid]) == pytest.approx(list(r), abs=1e-4)
    listed = [df.count() for df in united if df.columns == ["cx", "cy", "reach", "geom"]]
    assert listed and sum(listed) < 500


@pytest.mark.parametrize("paired, rows", [(4096, 1 << 15), (7, 20)])
def test_close_pairs_are_all_pairs(spark, monkeypatch, paired, rows):
    """Pairs at the very limit count, whatever rounding does to grown boxes, in whole squares and in parts of crowded ones;
    keys that are missing or come twice are those of pairs of rows."""
    monkeypatch.setattr(grid, "PAIRED", paired)
    monkeypatch.setattr(grid, "ROWS", rows)
    monkeypatch.setattr(grid, "TESTED", rows)
    rng = np.random.default_rng(21)
    rings = [rect(x, y, x + 8, y + 6) for x, y in rng.integers(0, 150, (120, 2)).tolist()]
    rings += [star(rng, *rng.uniform(0, 150, 2), 7, 12) for _ in range(40)]
    a = flat_of(rings)
    i, j = np.triu_indices(len(rings), 1)
    near = polygon_distances(a.take(i), a.take(j)) <= 24.0
    want = list(zip(i[near].tolist(), j[near].tolist()))
    edge = [rect(x, 40 * k, x + w, 40 * k + 9) for k, (x, w) in enumerate(zip(rng.integers(-20_000, 20_000, 400).tolist(), rng.integers(5, 25, 400).tolist()), 10)]
    edge += [rect(r[0][0][1][0] + 24, r[0][0][0][1] + 2, r[0][0][1][0] + 30, r[0][0][0][1] + 5) for r in edge]
    want += [(k, 400 + k) for k in range(160, 560)]
    frame = layer(spark, rings + edge)
    found = clusters.proximity_pairs(frame, "fid", 24.0, 128.0).collect()
    assert sorted((r.u, r.v) for r in found) == sorted(want)
    again = frame.filter("fid in (160, 560)").unionByName(frame.filter("fid = 160")).unionByName(frame.filter("fid = 560").withColumn("fid", F.lit(None).cast("long")))
    assert [(r.u, r.v) for r in clusters.proximity_pairs(again, "fid", 24.0, 128.0).collect()] == [(160, 560)] * 2
