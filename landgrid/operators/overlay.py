"""Polygon difference and buffering of layers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DataType

from landgrid.functions import geom as G
from landgrid.functions import slabs
from landgrid.functions.arrow_geom import Flat, counts_to_offsets, flat, ragged
from landgrid.functions.predicates import convex, is_valid, signed_distances, simplify
from landgrid.operators import grid
from landgrid.schemas import GEOM, GEOM_DDL, require_same_srid, tagged_like
from landgrid.shared import saved, shuffled

CUTS_AT_ONCE = 64               # cuts taken from one polygon in one step
VERTICES_AT_ONCE = 50_000       # vertices one sweep holds
GROWN = 16                      # vertices that growing makes of one
FINER = 4                       # small squares in a side of a square where cuts crowd
CELLS = 8                       # cells in a side of a small square; the bits of a long tell which of them are covered


def _lists(column: pa.Array) -> tuple[Flat, np.ndarray, np.ndarray]:
    """The members of lists of polygons, the row of each and its place in the list."""
    lists = column.offsets.to_numpy().astype(np.int64)
    members = flat(column.values.slice(lists[0], lists[-1] - lists[0]))
    row, place = ragged(np.diff(lists))
    return members, row, place


@arrow_udf(GEOM)
def _minus(geom: pa.Array, cuts: pa.Array, reach: pa.Array) -> pa.Array:
    """The polygon less the union of ``cuts``, each grown by ``reach``. Without cuts the result is
    empty; the caller keeps the untouched polygon then."""
    subject = flat(geom)
    members, row, place = _lists(cuts)
    grow = reach.to_numpy()
    members = slabs.buffered(members, grow[row]) if (grow > 0).any() else members
    cut = np.zeros(subject.rows, dtype=bool)
    cut[row] = True
    pieces = []
    for lo, hi in _runs(np.where(cut, np.diff(subject.row_vertex), 0) + np.bincount(row, np.diff(members.row_vertex), subject.rows)):
        rows = np.arange(lo, hi)[cut[lo:hi]]
        mine = (row >= lo) & (row < hi)
        rest = slabs.difference(slabs.Edges.of(subject.take(rows), rows - lo, 0),
                                slabs.Edges.of(members.take(np.flatnonzero(mine)), row[mine] - lo, place[mine] + 1))
        pieces.append(slabs.polygons(rest, hi - lo))
    return Flat.concat(pieces).array() if pieces else Flat.empty(0).array()


def _runs(weight: np.ndarray) -> list[tuple[int, int]]:
    """Consecutive rows in runs of about VERTICES_AT_ONCE, so that one sweep stays within memory."""
    run = (np.cumsum(weight) // VERTICES_AT_ONCE).astype(np.int64)
    start = np.flatnonzero(np.diff(run, prepend=-1))
    return list(zip(start.tolist(), [*start[1:].tolist(), len(weight)]))


def _frames(cx: pa.Array, cy: pa.Array, size: float, shape: int, lo: int, hi: int) -> slabs.Edges:
    """The squares of rows ``[lo, hi)`` as a shape."""
    low = np.column_stack([cx.to_numpy()[lo:hi], cy.to_numpy()[lo:hi]]).astype(np.float64)
    return slabs.Edges.boxes(np.hstack([low, low + 1]) * float(size), np.arange(len(low)), shape)


def _by_runs(weight: np.ndarray, overlay: Callable[[int, int], slabs.Trapezoids]) -> tuple[Flat, np.ndarray]:
    """Polygons and areas of ``overlay`` over rows ``[lo, hi)``, whose vertices number ``weight``, run by run."""
    shapes, areas = [Flat.empty(0)], [np.zeros(0)]
    for lo, hi in _runs(weight):
        shape = overlay(lo, hi)
        shapes.append(slabs.polygons(shape, hi - lo))
        areas.append(shape.areas(hi - lo))
    return Flat.concat(shapes), np.concatenate(areas)


def _listed_edges(members: Flat, row: np.ndarray, place: np.ndarray, lo: int, hi: int, grow: np.ndarray | None = None) -> slabs.Edges:
    """Edges of the list members of rows ``[lo, hi)``, each grown; their shapes count from 1."""
    mine = np.arange(*np.searchsorted(row, [lo, hi]))
    some = members.take(mine)
    if grow is not None and (grow[mine] > 0).any():
        some = slabs.buffered(some, grow[mine])
    return slabs.Edges.of(some, row[mine] - lo, place[mine] + 1)


def _united_in(size: float) -> Callable:
    """Lists of ``geom, reach``, polygons to be grown, as their union inside a square: ``full`` if that is all of it, else ``geom``."""
    @arrow_udf(DataType.fromDDL(f"struct<full:boolean,geom:{GEOM_DDL}>"))
    def united(cuts: pa.Array, cx: pa.Array, cy: pa.Array) -> pa.Array:
        lists, rows = cuts.offsets.to_numpy().astype(np.int64), len(cx)
        geom, reach = cuts.values.slice(lists[0], lists[-1] - lists[0]).flatten()
        members, grow = flat(geom), reach.to_numpy()
        row, place = ragged(np.diff(lists))
        corners = np.diff(members.row_vertex) * np.where(grow > 0, GROWN, 1)

        def inside(_, shape, step, __, running):
            return (running(step * (shape == 0)) == 1) & (running(step * (shape > 0)) > 0)

        shapes, area = _by_runs(np.bincount(row, corners, rows), lambda lo, hi: slabs.sweep(
            _frames(cx, cy, size, 0, lo, hi) + _listed_edges(members, row, place, lo, hi, grow), inside))
        full = area >= size * size * (1 - 1e-12)
        kept = Flat.choose([shapes, Flat.empty(rows)], full.astype(np.int64))
        return pa.StructArray.from_arrays([pa.array(full), kept.array()], names=["full", "geom"])

    return united


def _covers(size: float) -> Callable:
    """The cells of a square that a polygon grown by ``reach`` covers whole, and those that it may touch, as bits."""
    cell = size / CELLS

    def whole(g: Flat, reach: np.ndarray, row: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether cells with the lower left corners ``x, y`` lie in polygons. A convex one covers a cell if it has all of its
        corners; in others a cell's centre must be far enough from the border."""
        out = np.zeros(len(row), dtype=bool)
        round_ = convex(g)
        mine = np.flatnonzero(round_[row])
        # a grown corner has 16 steps a quarter turn, rounded: it reaches this far at least
        far = reach[row] * np.cos(np.pi / 32)
        for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1)):
            mine = mine[signed_distances(g.take(row[mine]), x[mine] + dx * cell, y[mine] + dy * cell) <= far[mine]]
        out[mine] = True
        other = np.flatnonzero(~round_)
        if len(other):
            grown = g.take(other)
            grown = slabs.buffered(grown, reach[other]) if (reach[other] > 0).any() else grown
            place = np.cumsum(~round_) - 1
            mine = np.flatnonzero(~round_[row])
            gap = signed_distances(grown.take(place[row[mine]]), x[mine] + cell / 2, y[mine] + cell / 2)
            out[mine] = gap <= -cell / np.sqrt(2)
        return out

    @arrow_udf(DataType.fromDDL("struct<covered:bigint,touched:bigint>"))
    def covers(geom: pa.Array, reach: pa.Array, cx: pa.Array, cy: pa.Array) -> pa.Array:
        g = flat(geom)
        covered, touched = np.zeros(g.rows, np.uint64), np.zeros(g.rows, np.uint64)
        some = np.flatnonzero(np.diff(g.row_vertex) > 0)
        g, grow = g.take(some), reach.to_numpy()[some]
        low = [c.to_numpy()[some] * size for c in (cx, cy)]
        box, wide = g.bounds(), grow + grid.MARGIN
        first = [np.clip(np.floor((box[k] - wide - low[k]) / cell), 0, CELLS - 1).astype(np.int64) for k in (0, 1)]
        last = [np.clip(np.floor((box[k + 2] + wide - low[k]) / cell), 0, CELLS - 1).astype(np.int64) for k in (0, 1)]
        across = last[0] - first[0] + 1
        count = across * (last[1] - first[1] + 1)
        for lo, hi in _runs(count * np.diff(g.row_vertex)):
            row, k = ragged(count[lo:hi])
            i, j = first[0][lo:hi][row] + k % across[lo:hi][row], first[1][lo:hi][row] + k // across[lo:hi][row]
            bit = np.uint64(1) << (j * CELLS + i).astype(np.uint64)
            inside = whole(g.take(np.arange(lo, hi)), grow[lo:hi], row, low[0][lo:hi][row] + i * cell, low[1][lo:hi][row] + j * cell)
            np.bitwise_or.at(touched, some[lo + row], bit)
            np.bitwise_or.at(covered, some[lo + row[inside]], bit[inside])
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in (covered, touched)], names=["covered", "touched"])

    return covers


def _cells(size: float) -> Callable:
    """The cells of a square that ``bits`` tell, as one polygon."""
    @arrow_udf(GEOM)
    def drawn(bits: pa.Array, cx: pa.Array, cy: pa.Array) -> pa.Array:
        places = np.arange(CELLS * CELLS, dtype=np.uint64)
        set_ = (bits.to_numpy().astype(np.uint64)[:, None] >> places & np.uint64(1)).astype(np.int8).reshape(-1, CELLS, CELLS)
        change = np.diff(set_, axis=2, prepend=np.int8(0), append=np.int8(0))        # runs of cells beside each other
        row, j, i0 = np.nonzero(change == 1)
        i1 = np.nonzero(change == -1)[2]
        x, y = cx.to_numpy()[row] * CELLS, cy.to_numpy()[row] * CELLS
        boxes = Flat.boxes(np.column_stack([x + i0, y + j, x + i1, y + j + 1]) * (size / CELLS))
        return Flat(boxes.x, boxes.y, boxes.ring, boxes.part, counts_to_offsets(np.bincount(row, minlength=len(bits)))).array()

    return drawn


def _left_in(size: float) -> Callable:
    """What a polygon has inside a square and outside ``hole``, a polygon or null."""
    @arrow_udf(GEOM)
    def left(geom: pa.Array, hole: pa.Array, cx: pa.Array, cy: pa.Array) -> pa.Array:
        mine, holes = flat(geom), flat(hole)

        def rest(lo, hi):
            rows = np.arange(lo, hi)
            keep = slabs.Edges.of(mine.take(rows), rows - lo, 0) + _frames(cx, cy, size, 1, lo, hi)
            return slabs.difference(keep, slabs.Edges.of(holes.take(rows), rows - lo, 2), kept_shapes=2)

        return _by_runs(np.diff(mine.row_vertex) + np.diff(holes.row_vertex), rest)[0].array()

    return left


def _joined_from(size: float) -> Callable:
    """Lists of chips, each from another square of a grid, as one polygon."""
    @arrow_udf(GEOM)
    def joined(chips: pa.Array) -> pa.Array:
        members, row, _ = _lists(chips)
        weight, pieces = np.bincount(row, np.diff(members.row_vertex), len(chips)), [Flat.empty(0)]
        for lo, hi in _runs(weight):
            mine = np.arange(*np.searchsorted(row, [lo, hi]))
            pieces.append(_sewn(members.take(mine), row[mine] - lo, hi - lo, size))
        return Flat.concat(pieces).array()

    return joined


def _sewn(chips: Flat, row: np.ndarray, rows: int, size: float) -> Flat:
    """Chips without the borders on grid lines that they have in common. Only edges on a line are compared."""
    seg, owner, _ = chips.segments()
    row = np.tile(row[owner], 2)
    xy = [np.concatenate([c[seg], c[seg + 1]]) for c in (chips.x, chips.y)]
    line, on = [np.rint(c / size) * size for c in xy], []
    for k in (0, 1):
        on.append(np.abs(xy[k] - line[k]) <= 2 * slabs.SNAP)
        xy[k] = np.where(on[k], line[k], xy[k])
    for k in (0, 1):                                     # points on a line that are the same but for rounding
        at = np.flatnonzero(on[k])
        at = at[np.lexsort((xy[1 - k][at], xy[k][at], row[at]))]
        if len(at):
            new = np.ones(len(at), dtype=bool)
            new[1:] = (np.diff(xy[1 - k][at]) > 2 * slabs.SNAP) | (np.diff(xy[k][at]) != 0) | (np.diff(row[at]) != 0)
            xy[1 - k][at] = xy[1 - k][at[np.flatnonzero(new)]][np.cumsum(new) - 1]
    x, y = xy
    order = np.lexsort((x, y, row))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0) | (np.diff(row[order]) != 0)
    vertex = np.empty(len(order), dtype=np.int64)
    vertex[order] = np.cumsum(new) - 1
    vx, vy, vrow = x[order][new], y[order][new], row[order][new]
    tail, head = vertex.reshape(2, -1)
    for k, (along, across) in enumerate(((vy, vx), (vx, vy))):       # edges on a line are cut at all points on it
        on_line = np.abs(across - np.rint(across / size) * size) == 0
        seam = on_line[tail] & on_line[head] & (across[tail] == across[head]) & (tail != head)
        place = np.lexsort((along, across, vrow))
        rank = np.empty(len(place), dtype=np.int64)
        rank[place] = np.arange(len(place))
        first, last = rank[tail[seam]], rank[head[seam]]
        edge, step = ragged(np.abs(last - first))
        way = np.sign(last - first)[edge]
        here = first[edge] + way * step
        tail = np.concatenate([tail[~seam], place[here]])
        head = np.concatenate([head[~seam], place[here + way]])
    kept = tail != head
    return _from_lowest(slabs.stitch(tail[kept], head[kept], vx, vy, vrow, rows))


def _from_lowest(g: Flat) -> Flat:
    """Rings that begin at their lowest vertex, or the one before it if level with it, as in a sweep: simplification depends on it."""
    size = np.diff(g.ring) - 1
    ring, place = ragged(size)
    at = g.ring[:-1][ring] + place
    order = np.lexsort((g.x[at], g.y[at], ring))
    lowest = place[order[np.cumsum(size) - size]]
    before = (lowest - 1) % np.maximum(size, 1)
    level = np.abs(g.y[g.ring[:-1] + before] - g.y[g.ring[:-1] + lowest]) <= slabs.SNAP
    lowest = np.where(level, before, lowest)            # a hole's bottom runs down to its lowest vertex
    ring, place = ragged(size + 1)
    turned = g.ring[:-1][ring] + (place + lowest[ring]) % size[ring]
    return Flat(g.x[turned], g.y[turned], g.ring, g.part, g.row)


def difference(left: DataFrame, right: DataFrame, key: str, size: float, reach: float = 0.0,
               cuts_at_once: int = CUTS_AT_ONCE) -> DataFrame:
    """``left`` less the union of the ``right`` polygons grown by ``reach``; what becomes empty is
    dropped.

    A polygon with more than ``cuts_at_once`` candidates, or one that meets a square with more cuts than that, is cut
    by small squares: see :func:`_by_squares`. No list of pairs is made for it.
    """
    require_same_srid(left, right)
    a = grid.with_box(left.select(F.col(key).alias("key"), "geom")).drop("geom")
    places = saved(grid.cover(a.filter("key is not null"), size).select("key", "cx", "cy"))
    # cuts in the squares of polygons, written once; copies cut the same hole once
    b = saved(grid.cover(grid.with_box(right.select("geom")), size, reach)
              .join(shuffled(places.select("cx", "cy").distinct()), ["cx", "cy"], "left_semi").select("geom", "box").distinct())
    crowded = saved(grid.cover(b.select("box"), size, reach).groupBy("cx", "cy").count()
                    .filter(F.col("count") > cuts_at_once).select("cx", "cy"))
    hot = saved(places.join(shuffled(crowded), ["cx", "cy"], "left_semi").select("key").distinct())
    pairs = saved(grid.near_polygons(a.join(shuffled(hot), "key", "left_anti"), b, reach, size)
                  .select(F.col("a_key").alias("key"), F.col("b_geom").alias("cut")))
    many = pairs.groupBy("key").count().filter(F.col("count") > cuts_at_once).select("key")
    dense = saved(hot.unionByName(many))
    cuts = (pairs.join(shuffled(dense), "key", "left_anti")
            .groupBy("key").agg(F.collect_list("cut").alias("cuts")).withColumnRenamed("key", key))
    cut = _minus("geom", "cuts", F.lit(float(reach)))
    some = not dense.isEmpty()
    keys = dense.select(F.col("key").alias(key))
    whole = left if not some else left.join(shuffled(keys), key, "left_anti")
    done = (whole.join(shuffled(cuts), key, "left")
            .withColumn("_rest", cut)
            .withColumn("geom", F.when(F.col("cuts").isNull(), F.col("geom")).otherwise(F.col("_rest")))
            .select(left.columns))
    if some:
        done = done.unionByName(_by_squares(left.join(shuffled(keys), key, "left_semi"), b, size / FINER, reach, cuts_at_once))
    return tagged_like(done.filter(F.size("geom") > 0), left)


def _by_squares(left: DataFrame, right: DataFrame, side: float, reach: float, at_once: int) -> DataFrame:
    """``left`` less the union of ``right``, square by square: the cuts of a square are united once, whatever the
    number of polygons there, and what is left of a polygon in its squares is joined again.

    Cuts are united in a tree of bounded lists; a square that they cover in full settles its rows without geometry.
    """
    square = ["cx", "cy"]
    mine = saved(left.withColumn("_row", F.monotonically_increasing_id()))       # written once, so the numbers stay
    shapes = grid.with_box(mine.select("_row", "geom"))
    small, large = shapes.filter(grid.is_simple(side)), shapes.filter(~grid.is_simple(side))
    listed = grid.cover(small.select("_row", "box"), side).select("_row", *square)
    cut = saved(grid.chips(large.select("_row", "geom"), side))
    asked = saved(listed.select(square).unionByName(cut.select(square)).distinct())
    holes = saved(_cuts_by_square(right, asked, side, reach, at_once))
    whole = holes.filter("full").select(square)
    holes = holes.filter("not full").select(*square, F.col("geom").alias("hole"))
    x, y = F.col("cx") * F.lit(side), F.col("cy") * F.lit(side)
    listed = (listed.join(shuffled(whole), square, "left_anti")
              .join(shuffled(mine.select("_row", "geom")), "_row").select("_row", *square, "geom"))
    cut = (cut.join(shuffled(whole), square, "left_anti")
           .select("_row", *square, F.when(F.col("full"), G.rectangle(x, y, x + side, y + side)).otherwise(F.col("chip")).alias("geom")))
    rest = (listed.unionByName(cut).join(shuffled(holes), square, "left")
            .select("_row", _left_in(side)("geom", "hole", *square).alias("geom")).filter(F.size("geom") > 0))
    found = rest.groupBy("_row").agg(F.collect_list("geom").alias("chips")).select("_row", _joined_from(side)("chips").alias("geom"))
    return mine.drop("geom").join(shuffled(found), "_row").select(left.columns)


def _cuts_by_square(right: DataFrame, asked: DataFrame, side: float, reach: float, at_once: int) -> DataFrame:
    """``cx, cy, full, geom``: the union of all cuts, grown by ``reach``, inside each of the squares ``asked``.

    Where cuts crowd, a square is found full from the cells that single cuts cover, without a sweep."""
    square, united = ["cx", "cy"], _united_in(side)
    simple = grid.is_simple(side)
    small = grid.cover(right.filter(simple), side, reach).select(
        *square, F.lit(float(reach)).alias("reach"), F.lit(False).alias("full"), "geom")
    large = right.filter(~simple).select("geom")
    large = grid.chips(buffered(large, reach) if reach else large, side).select(
        *square, F.lit(0.0).alias("reach"), "full", F.col("chip").alias("geom"))
    parts = small.unionByName(large).join(shuffled(asked), square, "left_semi").withColumn("cells", _covers(side)("geom", "reach", *square))
    parts = saved(parts.select(*square, "reach", "geom", "cells.touched", F.when(F.col("full"), F.lit(-1).cast("long"))
                               .otherwise(F.col("cells.covered")).alias("covered")))
    # many cuts cover a square cell by cell; those that touch covered cells only add nothing to it
    bits = saved(parts.groupBy(square).agg(F.bit_or("covered").alias("bits")))
    done = [bits.filter("bits = -1").select(square)]
    some = bits.filter("bits <> -1")
    held = parts.join(shuffled(some), square).filter("touched & ~bits <> 0").select(*square, "reach", "geom")
    cells = some.filter("bits <> 0").select(*square, F.lit(0.0).alias("reach"), _cells(side)("bits", *square).alias("geom"))
    held, raw = saved(held.unionByName(cells)), True
    while True:
        counts = saved(held.groupBy(square).agg(F.count("*").alias("n")))
        if not raw and counts.filter("n > 1").isEmpty():
            break
        lists = F.ceil(F.col("n") / at_once).cast("int")
        # few bytes may be much work, so small partitions are not put together here
        grouped = (held.join(shuffled(counts), square).withColumn("part", F.pmod(F.xxhash64("geom"), lists))
                   .repartition(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")), *square, "part")
                   .groupBy(*square, "part").agg(F.collect_list(F.struct("geom", "reach")).alias("cuts")))
        parts = saved(grouped.withColumn("u", united("cuts", *square))
                      .select(*square, F.lit(0.0).alias("reach"), "u.full", "u.geom").filter(F.col("full") | (F.size("geom") > 0)))
        full = saved(parts.filter("full").select(square).distinct())
        done.append(full)
        held = parts.filter("not full").join(shuffled(full), square, "left_anti").select(*square, "reach", "geom")
        raw = False
    none = F.lit(None).cast(held.schema["geom"].dataType)
    out = held.select(*square, F.lit(False).alias("full"), "geom")
    for full in done:
        out = out.unionByName(full.select(*square, F.lit(True).alias("full"), none.alias("geom")))
    return out


def buffered(df: DataFrame, reach: float, geom: str = "geom") -> DataFrame:
    """Polygons grown by ``reach`` with round corners (16 steps a quarter turn)."""
    @arrow_udf(GEOM)
    def grow(column: pa.Array) -> pa.Array:
        g = flat(column)
        return slabs.buffered(g, np.full(g.rows, float(reach))).array()

    return tagged_like(df.withColumn(geom, grow(geom)), df, geom)


def simplified(df: DataFrame, tolerance: float, geom: str = "geom") -> DataFrame:
    """Fewer vertices, none moved farther than ``tolerance``; polygons stay valid."""
    @arrow_udf(GEOM)
    def shorten(column: pa.Array) -> pa.Array:
        return simplify(flat(column), tolerance).array()

    return tagged_like(df.withColumn(geom, shorten(geom)), df, geom)


def only_valid(df: DataFrame, geom: str = "geom") -> DataFrame:
    return df.filter(is_valid(geom))
