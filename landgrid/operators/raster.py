"""Raster operators on cell tables ``(cx, cy, value)``.

Neighbourhood work runs per block of cells. Each block gets the cells of a thin rim around it, so
one shuffle of hardly more than the input replaces one shuffle per direction, and no task ever holds
more than one block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrid.functions import geom as G
from landgrid.functions.forest import roots
from landgrid.functions.predicates import point_distance
from landgrid.functions.slabs import stitch
from landgrid.operators import grid
from landgrid.operators.graph import component_roots
from landgrid.schemas import GEOM_DDL, RasterGrid
from landgrid.shared import saved

BLOCK = 256             # cells along one side of a block
BORDERS = 1 << 17       # border lines that are joined to polygons at a time


def valid(value: Column, nodata) -> Column:
    """A cell has a value: not NULL and not the nodata mark."""
    return value.isNotNull() & (value != F.lit(nodata))


def crop(cells: DataFrame, low_x: int, low_y: int, high_x: int, high_y: int) -> DataFrame:
    """The window of cells; a range on plain columns, so it reaches the scan."""
    return cells.filter(F.col("cx").between(low_x, high_x) & F.col("cy").between(low_y, high_y))


def crop_to_points(cells: DataFrame, points: DataFrame, reach: float, raster: RasterGrid) -> DataFrame:
    """Crop to the extent of the points, grown by ``reach``: four numbers on the driver."""
    box = points.agg(*(f(c) for f in (F.min, F.max) for c in ("x", "y"))).first()
    if box[0] is None:
        return cells.limit(0)
    at = [math.floor((v - o + d) / raster.size) for v, o, d in
          zip(box, (raster.origin_x, raster.origin_y) * 2, (-reach, -reach, reach, reach))]
    return crop(cells, *at)


def cells_near(points: DataFrame, reach: float, raster: RasterGrid) -> DataFrame:
    """Distinct ``(cx, cy)`` of the cells whose centre is at most ``reach`` from a point.

    Points and cells are not joined. A cell that holds a point reaches a fixed set of offsets, most
    of them wherever in the cell the point lies; only offsets on the rim are tested per point. Both
    sets collapse before the shuffle.
    """
    span = math.ceil(reach / raster.size) + 1
    sure, rim = [], []
    for dx in range(-span, span + 1):
        for dy in range(-span, span + 1):
            # the centre of the target as seen from a point in the cell
            far = math.hypot(abs(dx) + 0.5, abs(dy) + 0.5) * raster.size
            near = math.hypot(max(abs(dx) - 0.5, 0), max(abs(dy) - 0.5, 0)) * raster.size
            if far <= reach * (1 - 1e-12):
                sure.append((dx, dy))
            elif near <= reach * (1 + 1e-12):
                rim.append((dx, dy))

    def offsets(pairs):
        return F.expr("explode(array(" + ",".join(f"struct({x} as dx, {y} as dy)" for x, y in pairs) + "))")

    held = points.select("x", "y", raster.column_of(F.col("x")).alias("hx"), raster.row_of(F.col("y")).alias("hy"))
    target = [(F.col("hx") + F.col("o.dx")).alias("cx"), (F.col("hy") + F.col("o.dy")).alias("cy")]
    reached = []
    if sure:
        reached.append(held.select("hx", "hy").distinct().withColumn("o", offsets(sure)).select(*target))
    tested = held.distinct().withColumn("o", offsets(rim)).select("x", "y", *target)
    gap = F.hypot(raster.center_x(F.col("cx")) - F.col("x"), raster.center_y(F.col("cy")) - F.col("y"))
    reached.append(tested.filter(gap <= reach).select("cx", "cy"))
    out = reached[0]
    for more in reached[1:]:
        out = out.unionByName(more)
    return out.distinct()


def clip_to_points(cells: DataFrame, points: DataFrame, reach: float, raster: RasterGrid) -> DataFrame:
    """Cells whose centre is at most ``reach`` from a point."""
    near = cells_near(points, reach, raster).select(
        F.col("cx").cast(cells.schema["cx"].dataType), F.col("cy").cast(cells.schema["cy"].dataType))
    return crop_to_points(cells, points, reach, raster).join(near, ["cx", "cy"], "left_semi")


def _blocks(cells: DataFrame, block: int, rim: int) -> DataFrame:
    """Cells listed under their block and under the blocks whose rim they lie in."""
    def span(c):
        return F.sequence(F.floor((F.col(c) - rim) / block), F.floor((F.col(c) + rim) / block))

    return (cells.select(F.col("cx").cast("long"), F.col("cy").cast("long"))
            .withColumn("bx", F.explode(span("cx"))).withColumn("by", F.explode(span("cy"))))


def _mask(table: pa.Table, block: int, rim: int) -> tuple[np.ndarray, int, int]:
    """The block with its rim as a boolean image, and the cell at its lower left corner."""
    x0 = table["bx"][0].as_py() * block - rim
    y0 = table["by"][0].as_py() * block - rim
    image = np.zeros((block + 2 * rim, block + 2 * rim), dtype=bool)
    image[table["cy"].to_numpy() - y0, table["cx"].to_numpy() - x0] = True
    return image, x0, y0


def _shifted(image: np.ndarray, combine) -> np.ndarray:
    """Combine the 3 x 3 neighbourhood; outside the image counts as false."""
    out = image
    for axis in (0, 1):
        wide = np.pad(out, [(1, 1) if a == axis else (0, 0) for a in (0, 1)])
        n = out.shape[axis]
        out = combine.reduce([np.take(wide, range(k, k + n), axis=axis) for k in range(3)])
    return out


def _core(image: np.ndarray, rim: int) -> np.ndarray:
    return image[rim:-rim, rim:-rim] if rim else image


def _neighbourhood(cells: DataFrame, block: int, rim: int, change) -> DataFrame:
    def per_block(table: pa.Table) -> pa.Table:
        image, x0, y0 = _mask(table, block, rim)
        y, x = np.nonzero(_core(change(image), rim))
        return pa.table({"cx": x.astype(np.int64) + x0 + rim, "cy": y.astype(np.int64) + y0 + rim})

    return _blocks(cells, block, rim).groupBy("bx", "by").applyInArrow(per_block, "cx long, cy long")


def eroded(cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """Cells whose whole 3 x 3 neighbourhood is set."""
    return _neighbourhood(cells, block, 1, lambda image: _shifted(image, np.logical_and))


def opened(cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """Erosion, then dilation, both 3 x 3."""
    return _neighbourhood(
        cells, block, 2, lambda image: _shifted(_shifted(image, np.logical_and), np.logical_or))


def _cell_id(cx, cy):
    """One long for a cell; its order is by row, then by column."""
    return F.shiftleft(cy.cast("long"), 32) + cx.cast("long")


def regions(cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """4-connected regions of the given cells: ``cx, cy, region``, labelled by the smallest cell id.

    Cells are joined inside their block; only labels that meet at a block border go on to the
    distributed components.
    """
    def per_block(table: pa.Table) -> pa.Table:
        image, x0, y0 = _mask(table, block, 0)
        y, x = np.nonzero(image)
        place = np.full(image.shape, -1, dtype=np.int64)
        place[y, x] = np.arange(len(y))
        across, up = image[:, :-1] & image[:, 1:], image[:-1] & image[1:]
        u = np.concatenate([place[:, :-1][across], place[:-1][up]])
        v = np.concatenate([place[:, 1:][across], place[1:][up]])
        first = roots(u, v, len(y))
        cx, cy = x.astype(np.int64) + x0, y.astype(np.int64) + y0
        return pa.table({"cx": cx, "cy": cy, "local": ((cy << 32) + cx)[first]})

    labelled = saved(_blocks(cells, block, 0).groupBy("bx", "by").applyInArrow(per_block, "cx long, cy long, local long"))
    last = block - 1
    east = labelled.filter(F.pmod("cx", F.lit(block)) == last).select((F.col("cx") + 1).alias("cx"), "cy", F.col("local").alias("u"))
    north = labelled.filter(F.pmod("cy", F.lit(block)) == last).select("cx", (F.col("cy") + 1).alias("cy"), F.col("local").alias("u"))
    first = labelled.filter((F.pmod("cx", F.lit(block)) == 0) | (F.pmod("cy", F.lit(block)) == 0))
    across = (east.unionByName(north).join(first.withColumnRenamed("local", "v"), ["cx", "cy"])
              .select("u", "v").distinct())
    found = component_roots(across).select(F.col("member").alias("local"), F.col("root").alias("region"))
    return (labelled.join(found, "local", "left")
            .select("cx", "cy", F.coalesce("region", "local").alias("region")))


def _border_lines(labels: np.ndarray, x0: int, y0: int) -> list[np.ndarray]:
    """Border lines of the regions in a block whose label image has a rim of one cell: region and ends.

    Lines run with the region on their left. Neighbouring cell sides of one direction are one line.
    """
    core = labels[1:-1, 1:-1]
    out = []
    # the other side, whether lines lie along x, and which way they run
    for other, along_x, forward in ((labels[:-2, 1:-1], True, True), (labels[2:, 1:-1], True, False),
                                    (labels[1:-1, 2:], False, True), (labels[1:-1, :-2], False, False)):
        side = np.where((core >= 0) & (core != other), core, -1)
        side = side if along_x else side.T
        joined = side[:, 1:] == side[:, :-1]
        first = (side >= 0) & ~np.pad(joined, ((0, 0), (1, 0)))
        last = (side >= 0) & ~np.pad(joined, ((0, 0), (0, 1)))
        line, low = np.nonzero(first)
        high = np.nonzero(last)[1] + 1
        region = side[line, low]
        line = line + (0 if along_x == forward else 1)
        begin, end = (low, high) if forward else (high, low)
        ends = (begin + x0, line + y0, end + x0, line + y0) if along_x else (line + x0, begin + y0, line + x0, end + y0)
        out.append(np.stack([region, *ends]))
    return out


def region_polygons(labelled: DataFrame, raster: RasterGrid, block: int = BLOCK) -> DataFrame:
    """Regions as polygons with holes, one row per region whatever its size: ``region, geom``.

    Each block gives the border lines of its regions; a rim of one cell settles its sides. Only border
    lines travel on, so what meets in one place for a region is no more than its polygon itself.
    Many regions are joined up in one call.
    """
    def span(c):
        return F.sequence(F.floor((F.col(c) - 1) / block), F.floor((F.col(c) + 1) / block))

    listed = (labelled.select(F.col("cx").cast("long"), F.col("cy").cast("long"), "region")
              .withColumn("bx", F.explode(span("cx"))).withColumn("by", F.explode(span("cy"))))
    ends = ["ax", "ay", "ex", "ey"]

    def per_block(table: pa.Table) -> pa.Table:
        x0, y0 = table["bx"][0].as_py() * block, table["by"][0].as_py() * block
        found, place = np.unique(table["region"].to_numpy(), return_inverse=True)
        labels = np.full((block + 2, block + 2), -1, np.int64)
        labels[table["cy"].to_numpy() - y0 + 1, table["cx"].to_numpy() - x0 + 1] = place
        region, *lines = np.concatenate(_border_lines(labels, x0, y0), axis=1)
        return pa.table({"region": found[region], **dict(zip(ends, lines))})

    lines = listed.groupBy("bx", "by").applyInArrow(per_block, "region long, " + ", ".join(f"{c} long" for c in ends))

    def joined(held: list[np.ndarray]) -> pa.RecordBatch:
        region, ax, ay, ex, ey = np.concatenate(held, axis=1)
        keys, row = np.unique(region, return_inverse=True)
        corners, at = np.unique(np.concatenate([np.stack([row, ax, ay]), np.stack([row, ex, ey])], axis=1), axis=1, return_inverse=True)
        at = at.ravel()
        vx, vy = (c.astype(float) * raster.size + o for c, o in zip(corners[1:], (raster.origin_x, raster.origin_y)))
        shape = stitch(at[:len(row)], at[len(row):], vx, vy, corners[0], len(keys))
        return pa.RecordBatch.from_arrays([pa.array(keys), shape.array()], names=["region", "geom"])

    def polygons(batches):
        held, size = [], 0
        for batch in batches:
            held.append(np.stack([c.to_numpy() for c in batch.columns]))
            size += batch.num_rows
            if size >= BORDERS:
                every = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(every[0], every[0][-1]))       # the last region may go on
                if cut:
                    yield joined([every[:, :cut]])
                held, size = [every[:, cut:]], every.shape[1] - cut
        if size:
            yield joined(held)

    return (lines.repartition("region").sortWithinPartitions("region").select("region", *ends)
            .mapInArrow(polygons, f"region long, geom {GEOM_DDL}"))


def with_any_value(polygons: DataFrame, cells: DataFrame, key: str, raster: RasterGrid,
                   block: int = 8) -> DataFrame:
    """Keys of the polygons that hold the centre of at least one valid cell (``cx, cy, value``).

    Polygons are cut to blocks of cells. Where a block lies inside the polygon, one valid cell in
    it decides; only at the border are centres tested.
    """
    size = raster.size * block
    box = polygons.select(G.bbox("geom").alias("b")).agg(
        *(f(f"b.{c}") for f, c in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax")))).first()
    if box[0] is None:
        return polygons.select(key).limit(0)
    origin = (raster.origin_x, raster.origin_y) * 2
    near = crop(cells, *(math.floor((v - o) / raster.size) for v, o in zip(box, origin)))
    held = near.filter(valid(F.col("value"), raster.nodata)).select(
        raster.center_x(F.col("cx")).alias("px"), raster.center_y(F.col("cy")).alias("py"))
    held = held.withColumns({"cx": grid.square_of("px", size), "cy": grid.square_of("py", size)})
    cut = saved(grid.chips(polygons.select(key, "geom"), size, touched=True))
    inside = (cut.filter("full").select(key, "cx", "cy")
              .join(held.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi").select(key))
    box = F.col("box")
    edge = (grid.with_box(cut.filter("not full"), "chip").join(held, ["cx", "cy"])
            .filter(F.col("px").between(box.xmin, box.xmax) & F.col("py").between(box.ymin, box.ymax))
            .filter(point_distance("chip", "px", "py") == 0).select(key))
    return inside.unionByName(edge).distinct()
