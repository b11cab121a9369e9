"""Declared schemas, spatial reference tags and raster grid constants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
# parts -> rings (the first is the shell) -> closed vertex lists
GEOM = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))
GEOM_DDL = "array<array<array<struct<x:double,y:double>>>>"

MANIFEST_COLUMNS = ("location", "quadkey", "url")

HOUSING = T.StructType([
    T.StructField("ID", T.StringType()),      # as in the file, whatever it looks like
    T.StructField("lon", T.StringType()),
    T.StructField("lat", T.StringType()),
    T.StructField("single_or_multi", T.StringType()),
])

# ``coordinates`` stays text here: its nesting depth depends on ``type``
FEATURE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("_corrupt_record", T.StringType()),
])

SUMMARY = T.StructType([
    T.StructField("census_tract_id", T.StringType()),
    T.StructField("ground_total_area_sqm", T.DoubleType()),
    T.StructField("ground_polygon_count", T.LongType()),
    T.StructField("rooftop_total_area_sqm", T.DoubleType()),
    T.StructField("rooftop_polygon_count", T.LongType()),
])

WGS84 = 4326
CALIFORNIA_ALBERS = 3310
CONUS_ALBERS = 5070
UTM_10N = 26910


class SridMismatch(ValueError):
    """Two layers in different reference systems met in one operator."""


def with_srid(df: DataFrame, srid: int, column: str = "geom") -> DataFrame:
    """Tag a geometry column; an earlier tag is overridden, no coordinate changes."""
    return df.withColumn(column, F.col(column).alias(column, metadata={"srid": srid}))


def srid_of(df: DataFrame, column: str = "geom") -> int | None:
    return df.schema[column].metadata.get("srid")


def require_same_srid(left: DataFrame, right: DataFrame, left_column: str = "geom",
                      right_column: str = "geom") -> None:
    """Both layers are tagged alike, or neither is; a tag that one side has lost is an error too."""
    a, b = srid_of(left, left_column), srid_of(right, right_column)
    if a != b:
        raise SridMismatch(f"left layer has SRID {a}, right layer has SRID {b}")


def tagged_like(df: DataFrame, source: DataFrame, column: str = "geom") -> DataFrame:
    """Kernels return untagged geometry; give it the tag of the layer it was made of."""
    srid = srid_of(source, column) if column in source.columns else None
    return df if srid is None else with_srid(df, srid, column)


@dataclass(frozen=True)
class RasterGrid:
    """Square cells: cell (cx, cy) has its centre at ``origin + (c + 1/2) * size`` in the system ``srid``."""

    size: float
    nodata: int
    origin_x: float = 0.0
    origin_y: float = 0.0
    srid: int = CALIFORNIA_ALBERS

    def center_x(self, cx):
        return (cx + F.lit(0.5)) * F.lit(self.size) + F.lit(self.origin_x)

    def center_y(self, cy):
        return (cy + F.lit(0.5)) * F.lit(self.size) + F.lit(self.origin_y)

    def column_of(self, x):
        return F.floor((x - F.lit(self.origin_x)) / F.lit(self.size))

    def row_of(self, y):
        return F.floor((y - F.lit(self.origin_y)) / F.lit(self.size))
