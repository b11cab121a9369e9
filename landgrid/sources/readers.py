"""Scans with declared schemas."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrid.functions import geom as G
from landgrid.functions.predicates import polygon_distance
from landgrid.schemas import FEATURE, HOUSING, MANIFEST_COLUMNS, SUMMARY, WGS84, with_srid


class MissingColumns(ValueError):
    """An input lacks columns that the job needs."""


# -- tile manifest -----------------------------------------------------------------------------

def normalized_header(df: DataFrame) -> DataFrame:
    """Column names trimmed and in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def require_columns(df: DataFrame, needed: Iterable[str]) -> DataFrame:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise MissingColumns(f"missing {missing}; available are {df.columns}")
    return df


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The tile list; every column is text, so quadkeys keep their leading zeros."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return require_columns(normalized_header(raw), MANIFEST_COLUMNS)


def manifest_tiles(tiles: DataFrame, location: str = "unitedstates") -> DataFrame:
    """Tiles of one location that can be fetched over HTTP."""
    return (tiles.filter(F.lower(F.trim("location")) == location)
            .dropna(subset=["url"]).filter(F.col("url").startswith("http"))
            .withColumnsRenamed({"url": "Url", "quadkey": "QuadKey"}))


def landed_name(url, quadkey) -> Column:
    """File name of a tile: its quadkey and the last part of the URL's path."""
    path = F.coalesce(F.parse_url(G._col(url), F.lit("PATH")), F.lit(""))
    return F.concat(F.lit("quadkey_"), G._col(quadkey), F.lit("_"), F.element_at(F.split(path, "/"), -1))


def landed_files(spark: SparkSession, folder: str, suffix: str = ".csv.gz") -> DataFrame:
    """Names and quadkeys of the tiles present in a folder; file contents are not read."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder))
    return listing.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), quadkey_of("path").alias("quadkey"))


def missing_tiles(tiles: DataFrame, landed: DataFrame) -> DataFrame:
    """The work list: tiles whose file has not landed."""
    named = tiles.withColumn("file_name", landed_name("Url", "QuadKey"))
    return named.join(landed.select("file_name"), "file_name", "left_anti")


def quadkey_of(path) -> Column:
    return F.regexp_extract(G._col(path), "quadkey_([0-9]+)_", 1)


# -- footprint tiles: newline-delimited GeoJSON --------------------------------------------------

def features(spark: SparkSession, path: str) -> DataFrame:
    """Tiles as ``feature, line, quadkey``; broken lines stay as rows, the codec follows the extension.

    Text is read whole-line first, so that a broken line can be quarantined with its text. Of a
    damaged file the lines before the damage are read; ``damaged_tiles`` names such files.
    """
    lines = (spark.read.option("ignoreCorruptFiles", True).text(path)
             .withColumn("quadkey", quadkey_of(F.input_file_name())).withColumnRenamed("value", "line"))
    return parsed(lines)


def damaged_tiles(spark: SparkSession, path: str, suffix: str = ".gz") -> DataFrame:
    """Compressed tiles that don't decompress to their end: ``file_name, quadkey, reason``."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reasons = [_gzip_damage(content) for content in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(reasons, pa.string())], names=["path", "reason"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path)
    found = files.select("path", "content").mapInArrow(check, "path string, reason string").filter("reason is not null")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), quadkey_of("path").alias("quadkey"), "reason")


def _gzip_damage(content: bytes) -> str | None:
    reader, at = zlib.decompressobj(31), 0
    try:
        while at < len(content):
            reader.decompress(content[at:at + (1 << 20)])
            at += 1 << 20
            if reader.eof and (reader.unused_data or at < len(content)):       # another member follows
                at = min(at, len(content)) - len(reader.unused_data)
                reader = zlib.decompressobj(31)
    except zlib.error as error:
        return f"corrupt: {error}"
    return None if reader.eof else "ends too early"


def parsed(lines: DataFrame, line: str = "line") -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return lines.withColumn("feature", F.from_json(line, FEATURE, options))


def footprints(parsed_lines: DataFrame) -> DataFrame:
    """Polygons of well-formed features, in longitude and latitude."""
    good = parsed_lines.filter(fault().isNull()).withColumn("geom", _shape()).drop("feature", "line")
    return with_srid(good, WGS84)


def _shape() -> Column:
    shape = F.col("feature.geometry")
    return G.from_geojson(shape.type, shape.coordinates)


def fault() -> Column:
    """Why a line gives no polygon; NULL if it does. Every line is either a footprint or quarantined."""
    kind = F.col("feature.geometry.type")
    return (F.when(F.col("feature").isNull() | F.col("feature._corrupt_record").isNotNull(), "no JSON")
            .when(F.col("feature.geometry").isNull(), "no geometry")
            .when(kind.isNull() | ~kind.isin("Polygon", "MultiPolygon"), "not a polygon")
            .when(~G.complete(_shape()), "incomplete coordinates"))


def quarantined(parsed_lines: DataFrame) -> DataFrame:
    """Lines that give no polygon, with the reason."""
    return parsed_lines.withColumn("reason", fault()).filter("reason is not null").drop("feature")


# -- housing -------------------------------------------------------------------------------------

def housing(spark: SparkSession, path: str) -> DataFrame:
    """Address points with their coordinates as text; ``ID`` may be absent from the file.

    Ids are numbers if all of them are, else they stay the text they are.
    """
    header = spark.read.option("header", True).csv(path).columns
    raw = spark.read.option("header", True).csv(path, schema=", ".join(f"`{c}` string" for c in header))
    raw = require_columns(raw, ["lon", "lat", "single_or_multi"])
    known = [f for f in HOUSING if f.name in raw.columns]
    rows = raw.select(*(F.col(f.name).cast(f.dataType) for f in known))
    if "ID" in rows.columns and rows.filter(F.col("ID").isNotNull() & F.col("ID").try_cast("long").isNull()).isEmpty():
        rows = rows.withColumn("ID", F.col("ID").try_cast("long"))
    return rows


def of_kind(df: DataFrame, kind: str, column: str = "single_or_multi") -> DataFrame:
    return df.filter(F.trim(column) == kind)


# -- layers, cells, summary ------------------------------------------------------------------------

def layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def layer_window(spark: SparkSession, path: str, window: tuple[float, float, float, float]) -> DataFrame:
    """Rows of a written layer whose polygon meets a window ``(xmin, ymin, xmax, ymax)``, touching included.

    The conditions on ``bbox`` go down to the scan, where files and row groups with boxes elsewhere are skipped: few are
    left if ``write_layer`` laid the layer out by squares. Only rows whose box reaches over the window's border are
    tested exactly.
    """
    low_x, low_y, high_x, high_y = (float(c) for c in window)
    b = F.col("bbox")
    near = layer(spark, path).filter((b.xmin <= high_x) & (b.xmax >= low_x) & (b.ymin <= high_y) & (b.ymax >= low_y))
    within = (b.xmin >= low_x) & (b.xmax <= high_x) & (b.ymin >= low_y) & (b.ymax <= high_y)
    frame = G.rectangle(F.lit(low_x), F.lit(low_y), F.lit(high_x), F.lit(high_y))
    crossing = near.filter(~within).filter(polygon_distance("geom", frame) <= 0)
    return near.filter(within).unionByName(crossing)


def layers(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """The union of the layers that can be read, and of those that cannot the names with the reasons."""
    found, skipped = [], {}
    for name, path in paths.items():
        try:
            found.append(layer(spark, path).withColumn("layer", F.lit(name)))
        except (PySparkException, Py4JError) as error:       # absent, or with a footer that can't be read
            skipped[name] = str(error).splitlines()[0]
    if not found:
        raise MissingColumns(f"none of the layers {sorted(paths)} can be read")
    return union_of(found), skipped


def union_of(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; columns that a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def summary(spark: SparkSession, path: str) -> DataFrame:
    """The tract summary, with ids as text."""
    return spark.read.option("header", True).schema(SUMMARY).csv(path)
