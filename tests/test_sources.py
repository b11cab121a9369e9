"""Readers and writers on files, and the flows from end to end."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from landgrid import catalog
from landgrid.functions import geom as G
from landgrid.functions.crs import reproject
from landgrid.plans import footprints, ground_near_clusters, housing_layers
from landgrid.schemas import CALIFORNIA_ALBERS, CONUS_ALBERS, UTM_10N, WGS84, RasterGrid, srid_of, with_srid
from landgrid.shared import discard_saved, saved
from landgrid.sources import readers, writers
from tests.shapes import layer, rect


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with (gzip.open(path, "wt") if path.endswith(".gz") else open(path, "w")) as out:
        out.write(text)
    return str(path)


def feature(coordinates, kind="Polygon"):
    return json.dumps({"type": "Feature", "properties": {"height": -1.0},
                       "geometry": {"type": kind, "coordinates": coordinates}})


SQUARE = [[[-120.0, 37.0], [-119.9, 37.0], [-119.9, 37.1], [-120.0, 37.0]]]


def test_manifest(spark, tmp_path):
    path = write(f"{tmp_path}/links/links.csv", " Location ,QuadKey,Url ,Size\n"
                 " UnitedStates ,001230,https://h.example/a/b/part-1.csv.gz?x=1,3\n"
                 "unitedstates,2,ftp://h.example/p.csv.gz,3\nunitedstates,3,,1\nCanada,4,http://h.example/q.csv.gz,1\n")
    tiles = readers.manifest_tiles(readers.manifest(spark, path))
    (row,) = tiles.select("QuadKey", readers.landed_name("Url", "QuadKey").alias("f")).collect()
    assert (row.QuadKey, row.f) == ("001230", "quadkey_001230_part-1.csv.gz")
    with pytest.raises(readers.MissingColumns):
        readers.manifest(spark, write(f"{tmp_path}/bad/links.csv", "Location,Url\nx,y\n"))


def test_tiles_landed_missing_and_quarantined(spark, tmp_path):
    folder = f"{tmp_path}/tiles"
    good = feature(SQUARE)
    multi = feature([SQUARE, SQUARE], "MultiPolygon")
    write(f"{folder}/quadkey_0231_a.csv.gz", f"{good}\n{multi}\n" + '{"type":"Feature","geom\n' + feature([1, 2], "Point") + "\n")
    write(f"{folder}/readme.txt", "no tile")
    landed = readers.landed_files(spark, folder)
    assert [r.file_name for r in landed.collect()] == ["quadkey_0231_a.csv.gz"]
    tiles = spark.createDataFrame([("http://h/a.csv.gz", "0231"), ("http://h/b.csv.gz", "0232")], "Url string, QuadKey string")
    assert [r.QuadKey for r in readers.missing_tiles(tiles, landed).collect()] == ["0232"]
    parsed = readers.features(spark, f"{folder}/*.csv.gz")
    shapes = readers.footprints(parsed)
    assert srid_of(shapes) == WGS84
    rows = shapes.select("quadkey", F.size("geom").alias("parts")).collect()
    assert sorted((r.quadkey, r.parts) for r in rows) == [("0231", 1), ("0231", 2)]
    bad = {r.reason: r for r in readers.quarantined(parsed).collect()}
    assert set(bad) == {"no JSON", "not a polygon"} and {r.quadkey for r in bad.values()} == {"0231"}
    assert bad["no JSON"].line.startswith('{"type":"Feature","geom')


def test_housing_with_and_without_id(spark, tmp_path):
    text = "lon,lat,extra,single_or_multi\n-120.0,37.0,x, Multi \nn/a,37,y,Multi\n-121,36,z,Single\n"
    frame = readers.housing(spark, write(f"{tmp_path}/a/h.csv", text))
    points = housing_layers.points_of_kind(frame, "Multi").collect()
    assert len(points) == 1 and points[0].ID == 0
    assert points[0].x == pytest.approx(0, abs=1e-6) and points[0].y == pytest.approx(-112982.40908, abs=1e-4)
    named = "ID,lon,lat,single_or_multi\n77,-120.0,37.0,Multi\n"
    frame = readers.housing(spark, write(f"{tmp_path}/b/h.csv", named))
    assert [r.ID for r in housing_layers.points_of_kind(frame, "Multi").collect()] == [77]


def test_housing_with_text_ids_and_odd_numbers(spark, tmp_path):
    text = "ID,lon,lat,single_or_multi\nA12,-120.0,37.0,Multi\n7,12d,37,Multi\n8,0x1p3,37,Multi\n9,-1.2e2,+37.,Multi\n10,nan,37,Multi\n"
    frame = readers.housing(spark, write(f"{tmp_path}/h.csv", text))
    assert [r.ID for r in frame.collect()] == ["A12", "7", "8", "9", "10"]
    assert sorted(r.ID for r in housing_layers.points_of_kind(frame, "Multi").collect()) == ["9", "A12"]


def test_every_line_is_a_footprint_or_quarantined(spark, tmp_path):
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    def line(kind, coordinates):
        return json.dumps({"type": "Feature", "properties": {}, "geometry": {"type": kind, "coordinates": coordinates}})
    lines = {line("Polygon", [ring]): None, line("MultiPolygon", [[ring], [ring]]): None, '{"type":"Feature","geom': "no JSON",
             '{"foo":1}': "no geometry", '{"type":"Feature","geometry":null}': "no geometry", line("Point", [1.0, 2.0]): "not a polygon",
             line("Polygon", "abc"): "incomplete coordinates", line("Polygon", []): "incomplete coordinates",
             line("Polygon", [[[1.0], *ring]]): "incomplete coordinates", line("Polygon", [[None, *ring]]): "incomplete coordinates",
             line("Polygon", [ring[:2]]): "incomplete coordinates", line("MultiPolygon", [[ring], None]): "incomplete coordinates"}
    write(f"{tmp_path}/t/quadkey_12_a.csv.gz", "\n".join(lines) + "\n")
    read = readers.features(spark, f"{tmp_path}/t")
    assert readers.footprints(read).count() == 2
    assert {r.line: r.reason for r in readers.quarantined(read).collect()} == {k: v for k, v in lines.items() if v}


def test_damaged_tiles_are_named(spark, tmp_path):
    ring = "\n".join(feature([[[float(k), 0.0], [1.0, 0.0], [1.0, 1.0], [float(k), 0.0]]]) for k in range(5000)) + "\n"
    write(f"{tmp_path}/t/quadkey_1_a.csv.gz", ring)
    whole = open(f"{tmp_path}/t/quadkey_1_a.csv.gz", "rb").read()
    for name, content in {"quadkey_2_a.csv.gz": whole[:len(whole) // 2], "quadkey_3_a.csv.gz": b"no gzip at all", "quadkey_4_a.csv.gz": whole + whole}.items():
        with open(f"{tmp_path}/t/{name}", "wb") as out:
            out.write(content)
    found = {r.quadkey: r.reason for r in readers.damaged_tiles(spark, f"{tmp_path}/t").collect()}
    assert set(found) == {"2", "3"} and found["2"] == "ends too early" and found["3"].startswith("corrupt")


def test_known_projections(spark):
    at = spark.createDataFrame([(-122.4194, 37.7749)], "lon double, lat double")
    x, y = reproject("lon", "lat", WGS84, CALIFORNIA_ALBERS)
    e, n = reproject("lon", "lat", WGS84, UTM_10N)
    row = at.select(x.alias("x"), y.alias("y"), e.alias("e"), n.alias("n")).first()
    assert (row.x, row.y) == pytest.approx((-212792.00810, -24127.70728), abs=1e-4)
    assert (row.e, row.n) == pytest.approx((551130.76848, 4180998.88135), abs=1e-4)
    with pytest.raises(ValueError):
        reproject("lon", "lat", WGS84, 9999)


def test_layer_round_trip_and_missing_layers(spark, tmp_path):
    shapes = layer(spark, [rect(0, 0, 10, 10), rect(500, 500, 510, 510)])
    writers.write_layer(shapes, f"{tmp_path}/layer", square=100.0)
    back = readers.layer(spark, f"{tmp_path}/layer")
    assert {(r.fid, r.bbox.xmax, r.cell.cx) for r in back.collect()} == {(0, 10.0, 0), (1, 510.0, 5)}
    both, skipped = readers.layers(spark, {"a": f"{tmp_path}/layer", "b": f"{tmp_path}/none"})
    assert list(skipped) == ["b"] and both.filter("layer = 'a'").count() == 2
    write(f"{tmp_path}/broken/part-0.parquet", "PAR1 this is no footer PAR1")
    both, skipped = readers.layers(spark, {"a": f"{tmp_path}/layer", "c": f"{tmp_path}/broken", "b": f"{tmp_path}/none"})
    assert sorted(skipped) == ["b", "c"] and all(skipped.values()) and both.count() == 2
    plan = back.filter("bbox.xmin > 400").select("fid")._jdf.queryExecution().toString()
    assert "GreaterThan(bbox.xmin,400.0)" in plan


def test_cells_are_pruned_by_the_window(spark, tmp_path):
    writers.write_cells(spark.range(100).selectExpr("cast(id % 10 as int) cx", "cast(id div 10 as int) cy", "1 value"), f"{tmp_path}/cells")
    from landgrid.operators.raster import crop
    window = crop(readers.layer(spark, f"{tmp_path}/cells"), 2, 3, 4, 5)
    assert window.count() == 9
    assert "GreaterThanOrEqual(cx,2)" in window._jdf.queryExecution().toString()


def test_summary_round_trip(spark, tmp_path):
    rows = [("06000000002", 1.5, 2, 0.0, 0), ("06000000001", 0.0, 0, 2.25, 3)]
    frame = spark.createDataFrame(rows, "census_tract_id string, ground_total_area_sqm double, ground_polygon_count long,"
                                        "rooftop_total_area_sqm double, rooftop_polygon_count long")
    writers.write_summary(frame, f"{tmp_path}/summary")
    files = [f for f in os.listdir(f"{tmp_path}/summary") if f.endswith(".csv")]
    assert len(files) == 1
    assert [tuple(r) for r in readers.summary(spark, f"{tmp_path}/summary").collect()] == sorted(rows)


def test_features_round_trip(spark, tmp_path):
    writers.write_features(layer(spark, [rect(0, 0, 1, 2)]).withColumn("name", F.lit("a")), f"{tmp_path}/out")
    back = readers.footprints(readers.features(spark, f"{tmp_path}/out"))
    assert back.select(G.area("geom")).first()[0] == 2.0


def test_saved_tables_go_to_the_shared_folder(spark):
    frame = saved(spark.range(10).withColumn("geom", G.rectangle(F.lit(0), F.lit(0), F.lit(1), F.lit(1))))
    assert frame.count() == 10 and os.path.basename(spark.sparkContext.getCheckpointDir()) in frame.inputFiles()[0]


def test_saved_tables_can_be_discarded(spark):
    path = saved(spark.range(3)).inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert os.path.exists(path) and discard_saved(spark) >= 1
    assert not os.path.exists(path) and discard_saved(spark) == 0


def test_state_footprints_from_tiles(spark, tmp_path):
    inside, twice = [[[-120.5, 36.5], [-120.4999, 36.5], [-120.4999, 36.5001], [-120.5, 36.5001], [-120.5, 36.5]]], 2
    outside = [[[-110.5, 36.5], [-110.4, 36.5], [-110.4, 36.6], [-110.5, 36.5]]]
    write(f"{tmp_path}/t/quadkey_1_a.csv.gz", "\n".join([feature(inside)] * twice + [feature(outside)]) + "\n")
    states = with_srid(layer(spark, [rect(-121, 36, -120, 37), rect(-111, 36, -110, 37)])
                       .withColumn("name", F.when(F.col("fid") == 0, "West").otherwise("East")), WGS84)
    tiles = readers.footprints(readers.features(spark, f"{tmp_path}/t"))
    found = footprints.state_footprints(tiles, states, "West")
    assert found.count() == 1 and found.select(G.area("geom")).first()[0] == pytest.approx(99.4, abs=1.0)
    with pytest.raises(Exception, match="no area named"):
        footprints.boundary(states, "North")


def test_patches_from_a_raster_in_another_system(spark):
    lon, lat = -121.5, 38.5
    at = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    (x, y), (u, v) = reproject("lon", "lat", WGS84, CALIFORNIA_ALBERS), reproject("lon", "lat", WGS84, CONUS_ALBERS)
    here = at.select(x.alias("x"), y.alias("y"), u.alias("u"), v.alias("v")).first()
    cx, cy = int(here.u // 30), int(here.v // 30)
    cells = spark.range(81).selectExpr(f"cast({cx - 4} + id % 9 as int) cx", f"cast({cy - 4} + id div 9 as int) cy", "10 value")
    multi = spark.createDataFrame([(1, here.x, here.y)], "ID long, x double, y double")
    land = housing_layers.patches(cells, multi, RasterGrid(30.0, 250, srid=CONUS_ALBERS), housing_layers.Settings())
    (row,) = land.select(G.area("geom").alias("area"), G.centroid("geom").alias("c")).collect()
    assert row.area == pytest.approx(81 * 900, rel=1e-3) and abs(row.c.x - here.x) < 40 and abs(row.c.y - here.y) < 40
    assert srid_of(land) == CALIFORNIA_ALBERS


def test_ground_near_clusters(spark):
    ground = layer(spark, [rect(0, 0, 10, 10), rect(155, 0, 160, 10), rect(400, 0, 410, 10)], "gid")
    roofs = layer(spark, [rect(-2, 0, 0, 2), rect(298, 0, 300, 2)]).withColumn("cluster", F.col("fid").cast("int"))
    got = ground_near_clusters.ground_near_clusters(ground, roofs)
    assert sorted((r.geom[0][0][0].x, r.cluster) for r in got.collect()) == [(0.0, 0), (155.0, 1), (400.0, 1)]


def test_a_polygon_on_a_border_counts_in_both_tracts(spark):
    tracts = layer(spark, [rect(0, 0, 100, 100), rect(100, 0, 200, 100)]).selectExpr("cast(fid as string) GEOID", "geom")
    ground = layer(spark, [rect(90, 0, 110, 10), rect(150, 50, 160, 60)], "gid")
    roofs = layer(spark, [rect(10, 10, 20, 20)])
    rows = housing_layers.tract_summary(ground, roofs, tracts, 64.0).orderBy("census_tract_id").collect()
    assert [tuple(r) for r in rows] == [("0", 200.0, 1, 100.0, 1), ("1", 300.0, 2, 0.0, 0)]


def test_map_data(spark):
    tracts = layer(spark, [rect(0, 0, 1, 1), rect(1, 0, 2, 1)]).selectExpr("cast(fid as string) GEOID", "geom")
    summary = spark.createDataFrame([("0", 1.0, 2, 0.0, 0)], "census_tract_id string, ground_total_area_sqm double,"
                                    "ground_polygon_count long, rooftop_total_area_sqm double, rooftop_polygon_count long")
    feed = housing_layers.map_feed(tracts, summary).collect()
    assert {(r.GEOID, r.metric, r.value) for r in feed} == {
        ("0", "rooftop_polygon_count", 0.0), ("0", "ground_polygon_count", 2.0),
        ("0", "rooftop_total_area_sqm", 0.0), ("0", "ground_total_area_sqm", 1.0)}
    assert {r.title for r in feed} == set(housing_layers.TITLES.values())


@pytest.mark.parametrize("name", ["manifest_missing", "near_single", "rooftop_unique", "overlay_difference_area",
                                  "raster_regions", "tract_summary"])
def test_catalog_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry
    folder = entry.SMOKE_DATA
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    duck = duckdb.connect()
    for file in os.listdir(folder):
        duck.execute(f"create view {file.split('.')[0]} as select * from '{folder}/{file}'")
    theirs = duck.sql(entry.oracle_sql()[name]).df()
    mine = catalog.QUERIES[name](spark, folder).toPandas()[list(theirs.columns)]
    assert sorted(map(repr, mine.itertuples(index=False, name=None))) == sorted(map(repr, theirs.itertuples(index=False, name=None)))


def test_window_reads_few_files(spark, tmp_path):
    boxes = [(k, 40.0 * (k % 60), 40.0 * (k // 60)) for k in range(3600)]
    rows = spark.createDataFrame(boxes, "fid long, x double, y double")
    shapes = rows.select("fid", G.rectangle("x", "y", F.col("x") + 30, F.col("y") + 30).alias("geom"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # small files, but several
    writers.write_layer(shapes.repartition(16), str(tmp_path / "layer"), 200.0)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    window = (415.0, 830.0, 600.0, 1000.0)
    found = readers.layer_window(spark, str(tmp_path / "layer"), window)
    want = {k for k, x, y in boxes if x <= window[2] and x + 30 >= window[0] and y <= window[3] and y + 30 >= window[1]}
    assert {r.fid for r in found.collect()} == want
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = readers.layer_window(spark, str(tmp_path / "layer"), window)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(bbox.xmin" in plan and "GreaterThanOrEqual(bbox.ymax" in plan
    every = readers.layer(spark, str(tmp_path / "layer")).select(F.input_file_name()).distinct().count()
    assert found.select(F.input_file_name()).distinct().count() < every
