"""Relational steps the spatial operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from landgrid.functions import geom as G
from landgrid.functions.crs import reproject
from landgrid.schemas import SridMismatch, srid_of, with_srid
from landgrid.shared import saved


class EmptyResult(ValueError):
    """A flow has no rows to go on with."""


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyResult(message)
    return df


def row_ids(df: DataFrame, order: list[str], name: str = "row_id") -> DataFrame:
    """Number the rows 0..n-1 in the order of ``order``, without a single-task sort.

    Rows are range-partitioned and written with their place inside the partition; the only thing
    summed up in one place is one row count per partition. The running number of a task is safe to
    use here because it is written once and read back.
    """
    low_bits = (1 << 33) - 1
    placed = saved(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_mono", F.monotonically_increasing_id())
        .withColumns({"_part": F.shiftright("_mono", 33).cast("int"),
                      "_place": F.col("_mono").bitwiseAND(F.lit(low_bits))}).drop("_mono"))
    sizes = placed.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return (placed.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_place"))
            .drop("_part", "_place", "_before"))


def with_id(df: DataFrame, order: list[str], name: str = "ID") -> DataFrame:
    """Keep the id column, or create a placeholder where the input has none. Rows are numbered by
    ``order`` and then by every other column, so that ids don't depend on how the input was read."""
    return df if name in df.columns else row_ids(df, [*order, *(c for c in df.columns if c not in order)], name)


def distinct_geometry(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One row per geometry; equality is exact and counts the vertex order."""
    return df.select(geom).distinct()


def first_per_geometry(df: DataFrame, order: str, geom: str = "geom") -> DataFrame:
    """The row with the smallest ``order`` per geometry.

    ``min_by`` aggregates before the shuffle, so many copies of one geometry meet as one row per task.
    """
    rest = [c for c in df.columns if c != geom]
    if rest == [order]:
        return df.groupBy(geom).agg(F.min(order).alias(order)).select(df.columns)
    kept = F.min_by(F.struct(*rest), F.col(order))
    return df.groupBy(geom).agg(kept.alias("_row")).select(*(
        F.col(geom) if c == geom else F.col(f"_row.{c}") for c in df.columns))


def min_area(df: DataFrame, least: float, geom: str = "geom") -> DataFrame:
    return df.filter(G.area(geom) >= least)


def reprojected(layer: DataFrame, target: int, source: int | None = None) -> DataFrame:
    """A polygon layer in another system, vertex by vertex. The source is its tag, unless it is given."""
    source = source or srid_of(layer)
    if source is None:
        raise SridMismatch("the layer has no SRID and none is given")
    moved = layer if source == target else layer.withColumn(
        "geom", G.map_vertices("geom", lambda x, y: reproject(x, y, source, target)))
    return with_srid(moved, target)


def points_in(points: DataFrame, target: int, source: int) -> DataFrame:
    """Points ``x, y`` in another system."""
    if source == target:
        return points
    x, y = reproject("x", "y", source, target)
    return points.withColumns({"x": x, "y": y})


def exploded(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One row per polygon part, with its position in ``part``."""
    rest = [F.col(c) for c in df.columns if c != geom]
    return (df.select(*rest, F.posexplode(geom).alias("part", "_polygon"))
            .withColumn(geom, F.array("_polygon")).drop("_polygon"))


def extent(df: DataFrame, geom: str = "geom") -> DataFrame:
    boxed = df.select(G.bbox(geom).alias("b"))
    return boxed.agg(F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"),
                     F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax"))


def numeric(text) -> Column:
    """Text as a finite decimal number; NULL for anything else, type suffixes and hexadecimals among it."""
    plain = F.trim(G._col(text).cast("string"))
    value = F.when(plain.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), plain.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def clean_coordinates(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.withColumns({x: numeric(x), y: numeric(y)}).dropna(subset=[x, y])


def stage_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """Rows that are left after each of a chain of filters, from one pass: ``stage, rows``."""
    passed, counts = F.lit(True), []
    for name, condition in stages.items():
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(name))
    return df.agg(*counts).unpivot([], list(stages), "stage", "rows")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass, without a pass of its own; read the observation after an action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
