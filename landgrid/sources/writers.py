"""Sinks: layers, the tract summary and map data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrid.functions import geom as G


def write_layer(df: DataFrame, path: str, square: float | None = None) -> None:
    """A layer as Parquet with its box. With ``square`` the files follow grid squares of that side,
    so that the box statistics of a file cover one neighbourhood."""
    boxed = df.withColumn("bbox", G.bbox("geom"))
    if square:
        b = F.col("bbox")
        cell = F.struct(F.floor((b.xmin + b.xmax) / (2 * square)).alias("cx"),
                        F.floor((b.ymin + b.ymax) / (2 * square)).alias("cy"))
        boxed = boxed.withColumn("cell", cell).repartitionByRange("cell.cx", "cell.cy") \
                     .sortWithinPartitions("cell.cx", "cell.cy")
    boxed.write.mode("overwrite").parquet(path)


def write_cells(df: DataFrame, path: str) -> None:
    """A raster as a cell table whose file statistics allow window reads."""
    df.repartitionByRange("cy", "cx").sortWithinPartitions("cy", "cx").write.mode("overwrite").parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """The tract summary as one CSV file in id order; it has at most one row per tract."""
    df.orderBy("census_tract_id").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_features(df: DataFrame, path: str, geom: str = "geom") -> None:
    """Rows as GeoJSON features, one per line; the other columns become properties."""
    rest = [c for c in df.columns if c != geom]
    shape = F.struct(F.lit("MultiPolygon").alias("type"), F.transform(
        geom, lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.array(v.x, v.y)))).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*rest).alias("properties"), shape.alias("geometry"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)
