"""Spatial joins as equi-joins on the squares of a grid.

No join here has a range predicate as its only condition, so Spark always plans a hash or
sort-merge join on the grid square. Copies collapse before they are paired, squares that hold very
many points are narrowed by distance bounds first, and large polygons are cut to the squares, with
squares they cover in full marked so that most rows need no exact test.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DataType

from landgrid.functions import geom as G
from landgrid.functions.arrow_geom import flat
from landgrid.functions.predicates import are_boxes, meeting_boxes, point_distance, polygon_distance, polygon_distances
from landgrid.functions.tiles import TILE_DDL, tile_batch
from landgrid.schemas import require_same_srid
from landgrid.shared import saved, shuffled

CROWDED = 256           # points a square may hold before it is narrowed
FEW = 8                 # points that share a square on average, up to which the whole reach is searched at once
NEARER = 3              # searches within a quarter of the reach, a quarter of that, ..., that may come before
WORTH_DIVIDING = 3.0    # parts of a divided square that a box may meet on average
FINEST = 1e-3           # side in metres below which a square is not divided any more
PAIRED = 4096           # polygons of a square that a task compares with as many others at a time
ROWS = 1 << 15          # polygons a task holds before it compares them
TESTED = 1 << 15        # pairs whose borders are compared at once
SIMPLE_VERTICES = 64    # polygons up to this size are joined whole, if they span few squares
SIMPLE_SQUARES = 16
MARGIN = 1e-6           # widens the choice of squares only; the exact test decides


def square_of(x, size: float) -> Column:
    return F.floor(G._col(x) / F.lit(float(size)))


def _span(low: Column, high: Column, size: float, reach: float) -> Column:
    return F.sequence(square_of(low - (reach + MARGIN), size), square_of(high + (reach + MARGIN), size))


def cover(df: DataFrame, size: float, reach: float = 0.0, box: str = "box") -> DataFrame:
    """One row per square that the box of a row, grown by ``reach``, touches."""
    b = F.col(box)
    return (df.withColumn("cx", F.explode(_span(b.xmin, b.xmax, size, reach)))
              .withColumn("cy", F.explode(_span(b.ymin, b.ymax, size, reach))))


def with_box(df: DataFrame, geom: str = "geom", box: str = "box") -> DataFrame:
    return df.withColumn(box, G.bbox(geom))


# -- polygons with polygons --------------------------------------------------------------------

def is_simple(size: float) -> Column:
    """Whether a polygon with its ``box`` is small enough to be listed whole under each square."""
    b = F.col("box")
    squares = ((square_of(b.xmax, size) - square_of(b.xmin, size) + 1)
               * (square_of(b.ymax, size) - square_of(b.ymin, size) + 1))
    return (G.vertex_count("geom") <= SIMPLE_VERTICES) & (squares <= SIMPLE_SQUARES)


def _by_size(df: DataFrame, size: float, touched: bool = False) -> tuple[DataFrame, DataFrame]:
    """Small polygons with their ``box``, and large ones cut to squares (``cx, cy, full, chip``)."""
    simple = is_simple(size)

    @arrow_udf(DataType.fromDDL(TILE_DDL))
    def cut(geom: pa.Array) -> pa.Array:
        return tile_batch(geom, size, touched)

    large = (with_box(df).filter(~simple).withColumn("tile", F.explode(cut("geom")))
             .select("*", "tile.*").drop("tile", "geom", "box"))
    return with_box(df).filter(simple), large


def _square(size: float) -> Column:
    x, y = F.col("cx") * F.lit(float(size)), F.col("cy") * F.lit(float(size))
    return G.rectangle(x, y, x + size, y + size)


def chips(df: DataFrame, size: float, touched: bool = False) -> DataFrame:
    """Polygons by square: ``cx, cy, full, chip`` beside the columns of ``df`` (less ``geom``).

    Small polygons are listed whole under each square; large ones are cut to the squares.
    """
    small, large = _by_size(df, size, touched)
    whole = (cover(small, size).withColumn("full", F.lit(False))
             .withColumnRenamed("geom", "chip").drop("box"))
    return whole.unionByName(large)


def pieces(df: DataFrame, key: str, size: float) -> DataFrame:
    """``piece, geom``: small polygons as they are, large ones as one row per square. ``piece`` is a
    struct whose ``key`` is that of the polygon."""
    small, large = _by_size(df.select(F.col(key).alias("key"), "geom"), size)
    zero = F.lit(0).cast("long")
    small = small.select(F.struct("key", zero.alias("cx"), zero.alias("cy")).alias("piece"), "geom")
    cut = F.when(F.col("full"), _square(size)).otherwise(F.col("chip"))
    return small.unionByName(large.select(F.struct("key", "cx", "cy").alias("piece"), cut.alias("geom")))


def _meeting(left: DataFrame, right: DataFrame, right_key: str, size: float) -> DataFrame:
    """Rows of ``left`` (with ``cx, cy, full, chip``) once per square in which they meet a right
    polygon. The cut right side is written out first: its true size then decides whether Spark
    broadcasts it."""
    b = saved(chips(right.select(right_key, "geom"), size).select(
        right_key, "cx", "cy", F.col("full").alias("right_full"), F.col("chip").alias("right_chip")))
    pairs = left.join(b, ["cx", "cy"])
    x, y = F.col("cx") * F.lit(float(size)), F.col("cy") * F.lit(float(size))
    square = _square(size)

    def starts_here(chip):
        """A polygon is listed by its box and need not reach the square; its first vertex tells."""
        v = F.get(F.get(F.get(chip, F.lit(0)), F.lit(0)), F.lit(0))
        return v.x.between(x, x + size) & v.y.between(y, y + size)

    sure = F.coalesce((F.col("right_full") & (F.col("full") | starts_here("chip")))
                      | (F.col("full") & starts_here("right_chip")), F.lit(False))
    one = F.when(F.col("full"), square).otherwise(F.col("chip"))
    two = F.when(F.col("right_full"), square).otherwise(F.col("right_chip"))
    # shapes of settled pairs are not sent to the kernel
    doubtful = ~sure & G.boxes_meet(G.bbox(one), G.bbox(two))
    gap = polygon_distance(F.when(doubtful, one), F.when(doubtful, two))
    return pairs.withColumn("gap", gap).filter(sure | (F.col("gap") == 0)).drop("right_full", "right_chip", "gap")


def _whole(left: DataFrame, size: float) -> DataFrame:
    return (cover(with_box(left), size).drop("box").withColumn("full", F.lit(False))
            .withColumnRenamed("geom", "chip"))


def intersecting(left: DataFrame, right: DataFrame, left_key: str, right_key: str, size: float,
                 cut_left: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Distinct ``(left_key, *carry, right_key)`` of polygons that meet; touching counts.

    ``right`` holds large polygons. ``carry`` names columns of the left rows to bring along, which
    saves joining them back. With ``cut_left=False`` the left polygons stay whole and off
    the Python side until a square is only partly covered.
    """
    require_same_srid(left, right)
    a = left.select(left_key, *carry, "geom")
    a = chips(a, size, touched=True) if cut_left else _whole(a, size)
    return _meeting(a, right, right_key, size).select(left_key, *carry, right_key).distinct()


def distinct_inside(polygons: DataFrame, area: DataFrame, size: float) -> DataFrame:
    """Distinct geometries of ``polygons`` that meet the one polygon in ``area``.

    One shuffle removes both the repeats from several squares and the copies in the input.
    """
    require_same_srid(polygons, area)
    hits = _meeting(_whole(polygons.select("geom"), size), area.select(F.lit(1).alias("area"), "geom"), "area", size)
    return hits.select(F.col("chip").alias("geom")).distinct()


def near_polygons(left: DataFrame, right: DataFrame, reach: float, size: float) -> DataFrame:
    """Pairs of rows whose boxes are at most ``reach`` apart, from frames with a ``box``; columns are
    told apart by the prefixes ``a_`` and ``b_``.

    Squares in which very many right boxes lie are divided, as long as the boxes are small enough
    that dividing lowers the number of pairs to compare (it does so while a box meets fewer than four
    of the sixteen parts on average). Each pair comes from one square only: the one with the lower left corner of the overlap of the
    two boxes, the left one grown.
    """
    wide = reach + MARGIN
    grown = left.withColumn("_own", F.col("box")).withColumn("box", G.grow(F.col("box"), wide))
    crowded, side = [], float(size)
    boxes = right.select("box")
    listed = _listed(boxes, size, crowded)
    while side / 4 > max(FINEST, reach):
        b, x, y = F.col("box"), F.col("cx") * F.lit(side), F.col("cy") * F.lit(side)
        wide_x = F.least(b.xmax, x + side) - F.greatest(b.xmin, x)
        wide_y = F.least(b.ymax, y + side) - F.greatest(b.ymin, y)
        parts = (wide_x * 4 / side + 1) * (wide_y * 4 / side + 1)
        full = (listed.filter(F.col("side") == side).groupBy("side", "cx", "cy")
                .agg(F.count("*").alias("held"), F.avg(parts).alias("parts"))
                .filter((F.col("held") > CROWDED) & (F.col("parts") < WORTH_DIVIDING)))
        full = saved(full.select("side", "cx", "cy"))
        if full.isEmpty():
            break
        crowded.append(full)
        side /= 4
        listed = _listed(boxes, size, crowded)
    a = _listed(grown, size, crowded).withColumnsRenamed({c: f"a_{c}" for c in left.columns})
    b = _listed(right, size, crowded).withColumnsRenamed({c: f"b_{c}" for c in right.columns})
    ab, bb = F.col("a_box"), F.col("b_box")
    home = ((F.floor(F.greatest(ab.xmin, bb.xmin) / F.col("side")) == F.col("cx"))
            & (F.floor(F.greatest(ab.ymin, bb.ymin) / F.col("side")) == F.col("cy")))
    close = G.boxes_meet(ab, bb) & (G.box_gap(F.col("_own"), bb) <= reach)
    return (a.join(shuffled(b), ["side", "cx", "cy"]).filter(home & close).withColumn("a_box", F.col("_own"))
            .drop("side", "cx", "cy", "_own"))


def close_pairs(polygons: DataFrame, key: str, reach: float, size: float) -> DataFrame:
    """``u < v``: keys of all pairs of polygons at most ``reach`` apart.

    A polygon goes to the squares that its box, grown by half of ``reach``, lies in, and is compared there with the
    others of the square in one task, so only keys leave it. A pair counts in the square with the lower left corner of the overlap
    of both boxes. Squares with more than ``PAIRED`` polygons are dealt to parts, any two of which are a task's.
    """
    wide = reach / 2 + MARGIN
    shapes = with_box(polygons.select(F.col(key).alias("key"), "geom"))
    shapes = shapes.withColumn("box", G.grow(F.col("box"), wide))
    at, b = ["cx", "cy"], F.col("box")

    def listed(df):
        return (df.withColumn("cx", F.explode(F.sequence(square_of(b.xmin, size), square_of(b.xmax, size))))
                .withColumn("cy", F.explode(F.sequence(square_of(b.ymin, size), square_of(b.ymax, size)))).drop("box"))

    # of such squares there is one per PAIRED rows at most
    crowded = saved(listed(shapes.select("box")).groupBy(at).agg(F.count("*").alias("n")).filter(F.col("n") > PAIRED)
                    .select(*at, F.ceil(F.col("n") / PAIRED).cast("int").alias("parts")))
    rows = listed(shapes).join(F.broadcast(crowded), at, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = (rows.withColumn("mine", F.pmod(F.xxhash64("key", "geom"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    group = [*at, "low", "high"]
    rows = rows.select(*at, F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "key", "geom")
    dealt = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *group).sortWithinPartitions(*group)

    def close(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        g = flat(table.column("geom"))
        box = g.bounds()
        grown = box[0] - wide, box[1] - wide, box[2] + wide, box[3] + wide
        cx, cy, low, high, mine = (table.column(c).to_numpy() for c in (*group, "mine"))
        square, keys = are_boxes(g), table.column("key").combine_chunks()
        for i, j in meeting_boxes(grown, np.cumsum(starts)):
            good = (low[i] == high[i]) | (mine[i] != mine[j])
            good &= np.floor(np.maximum(grown[0][i], grown[0][j]) / size) == cx[i]
            good &= np.floor(np.maximum(grown[1][i], grown[1][j]) / size) == cy[i]
            i, j = i[good], j[good]
            dx = np.maximum(np.maximum(box[0][i] - box[2][j], box[0][j] - box[2][i]), 0.0)
            dy = np.maximum(np.maximum(box[1][i] - box[3][j], box[1][j] - box[3][i]), 0.0)
            near = np.sqrt(dx * dx + dy * dy) <= reach
            i, j = i[near], j[near]
            open_ = np.flatnonzero(~(square[i] & square[j]))         # of boxes the distance is known
            apart = [open_[k:k + TESTED][polygon_distances(g.take(i[open_[k:k + TESTED]]), g.take(j[open_[k:k + TESTED]])) > reach]
                     for k in range(0, len(open_), TESTED)]
            if apart:
                i, j = (np.delete(c, np.concatenate(apart)) for c in (i, j))
            for k in range(0, len(i), TESTED):
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(c[k:k + TESTED])) for c in (i, j)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held.append(batch)
            if sum(h.num_rows for h in held) >= ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                starts = begun(table)
                last = int(np.flatnonzero(starts)[-1])              # the last group may go on
                if last:
                    yield from close(table.slice(0, last), starts[:last])
                held = table.slice(last).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            if table.num_rows:
                yield from close(table, begun(table))

    def begun(table: pa.Table) -> np.ndarray:
        """Rows that begin a group."""
        out = np.zeros(table.num_rows, dtype=bool)
        out[:1] = True
        for c in group:
            out[1:] |= np.diff(table.column(c).to_numpy()) != 0
        return out

    kind = polygons.schema[key].dataType.simpleString()
    found = dealt.mapInArrow(run, f"u {kind}, v {kind}").filter("u <> v")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def _listed(df: DataFrame, size: float, crowded: list[DataFrame]) -> DataFrame:
    """Rows by the squares their box lies in: ``side, cx, cy``. ``crowded[k]`` lists the squares of
    step ``k`` that are replaced by sixteen smaller ones each."""
    b = F.col("box")

    def steps(low, high, side):
        return F.sequence(square_of(low, side), square_of(high, side))

    out = (df.withColumn("cx", F.explode(steps(b.xmin, b.xmax, size)))
           .withColumn("cy", F.explode(steps(b.ymin, b.ymax, size))).withColumn("side", F.lit(float(size))))
    for k, full in enumerate(crowded):
        side = size / 4 ** (k + 1)
        at = ["side", "cx", "cy"]
        inner = out.join(full, at, "left_semi").drop("side")
        x, y = F.col("cx") * F.lit(4), F.col("cy") * F.lit(4)
        inner = (inner.withColumn("_y", F.explode(F.sequence(F.greatest(y, square_of(b.ymin, side)),
                                                             F.least(y + 3, square_of(b.ymax, side)))))
                 .withColumn("cx", F.explode(F.sequence(F.greatest(x, square_of(b.xmin, side)),
                                                        F.least(x + 3, square_of(b.xmax, side)))))
                 .drop("cy").withColumnRenamed("_y", "cy").withColumn("side", F.lit(float(side))))
        out = out.join(full, at, "left_anti").unionByName(inner)
    return out


# -- polygons with points ----------------------------------------------------------------------

def _summary(points: DataFrame, size: float, parent: float | None) -> DataFrame:
    """Squares that hold points: extent and smallest label."""
    keys = [square_of("px", size).alias("sx"), square_of("py", size).alias("sy")]
    out = points.groupBy(*keys).agg(
        F.struct(F.min("px").alias("xmin"), F.min("py").alias("ymin"),
                 F.max("px").alias("xmax"), F.max("py").alias("ymax")).alias("square"),
        F.min("label").alias("label"))
    if parent:
        ratio = parent / size
        out = out.withColumns({"cx": F.floor(F.col("sx") / ratio), "cy": F.floor(F.col("sy") / ratio)})
    return out


def _levels(points: DataFrame, size: float) -> list[tuple[float, int, float]]:
    """Ever finer squares, from ``size`` on by quarters: the side, the most locations that a square holds, and how many
    a location finds in its square on average. One pass: all levels follow from the finest counts."""
    sides = [float(size)]
    while sides[-1] / 4 > FINEST:
        sides.append(sides[-1] / 4)
    finest = points.groupBy(square_of("px", sides[-1]).alias("sx"), square_of("py", sides[-1]).alias("sy")).count()
    up = F.pow(F.lit(4), F.lit(len(sides) - 1) - F.col("level"))
    held = F.col("held").cast("double")
    counts = (finest.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(len(sides) - 1))))
              .groupBy("level", F.floor(F.col("sx") / up).alias("sx"), F.floor(F.col("sy") / up).alias("sy"))
              .agg(F.sum("count").alias("held")).groupBy("level")
              .agg(F.max("held").alias("most"), (F.sum(held * held) / F.sum(held)).alias("shared")).collect())
    found = {r["level"]: (r["most"], r["shared"]) for r in counts}
    return [(side, *found.get(level, (0, 0.0))) for level, side in enumerate(sides)]


def _sides(levels: list[tuple[float, int, float]], first: int = 0) -> list[float]:
    """Sides of the squares to search through, from level ``first`` on: the next one while a square of the last holds
    more than ``CROWDED`` locations."""
    last = first
    while last + 1 < len(levels) and levels[last][1] > CROWDED:
        last += 1
    return [side for side, _, _ in levels[first:last + 1]]


def _searches(left: DataFrame, levels: list[tuple[float, int, float]], reach: float) -> list[tuple[float, list[float]]]:
    """``(reach, sides)`` of searches from near to far, the last one over the whole reach.

    Where points lie close, most polygons have one within a small part of the reach, so that the pairs of a
    polygon don't grow with the density. Squares are not made smaller than a polygon is on average.
    """
    nearer = 0
    while nearer < NEARER and nearer + 1 < len(levels) and levels[nearer][2] > FEW:
        nearer += 1
    finest = 0
    if nearer:
        b = G.bbox("geom")
        wide = left.agg(F.avg(F.greatest(b.xmax - b.xmin, b.ymax - b.ymin))).first()[0] or 0.0
        while finest < nearer and levels[finest + 1][0] >= wide:
            finest += 1
    if not reach:
        return [(reach, _sides(levels, finest))]
    return [(reach / 4 ** k, _sides(levels, min(k, finest))) for k in range(nearer, -1, -1)]


def _by_reach(left: DataFrame, points: DataFrame, key: str, reach: float, size: float, nearest: bool, settle) -> DataFrame:
    """``settle`` of the pairs of each polygon, searched from near to far: a polygon that has pairs is searched no farther."""
    points, left, found = saved(points), left.select(key, "geom"), None
    levels = _levels(points, size)
    for within_reach, sides in _searches(left, levels, reach):
        hits = settle(_point_pairs(left, points, key, within_reach, sides, nearest))
        if levels[0][2] > FEW:
            hits = saved(hits)                 # one to several searches build on it
        if within_reach < reach:
            done = hits.select(F.col(key).alias("_done")).distinct()
            left = left.join(shuffled(done), F.col(key).eqNullSafe(F.col("_done")), "left_anti")
        found = hits if found is None else found.unionByName(hits)
    return found


def _narrowed(left: DataFrame, points: DataFrame, key: str, reach: float, sides: list[float],
              nearest: bool) -> DataFrame:
    """Branch and bound over ever finer squares.

    Returns ``(key, cx, cy)`` of the squares, of the last side, that can still hold a decisive point of
    each left row. Bounds come from the boxes of the left rows and the
    extents of the points in a square, so that the pairs at each step number the squares near the
    border of what is known, not the points in them.
    """
    front = cover(left.select(key, "box"), sides[0], reach)
    for step, side in enumerate(sides):
        parent = sides[step - 1] if step else None
        squares = _summary(points, side, parent)
        if step == 0:
            squares = squares.withColumns({"cx": F.col("sx"), "cy": F.col("sy")})
        low, high = G.box_gap(F.col("box"), F.col("square")), G.box_span(F.col("box"), F.col("square"))
        mine = Window.partitionBy(key)
        front = (front.join(squares, ["cx", "cy"])
                 .withColumns({"low": low, "high": high}).filter(F.col("low") <= reach))
        if nearest:
            front = front.withColumn("bound", F.min("high").over(mine)).filter(F.col("low") <= F.col("bound"))
        else:
            # of the squares that lie within reach as a whole, one with the smallest label is enough
            sure = F.when((F.col("high") <= reach) & F.col("label").isNotNull(), F.struct("label", "sx", "sy"))
            front = (front.withColumn("bound", F.min(sure).over(mine))
                     .filter(F.col("bound").isNull() | (F.col("label") < F.col("bound.label"))
                             | ((F.col("sx") == F.col("bound.sx")) & (F.col("sy") == F.col("bound.sy")))))
        front = front.select(key, "box", F.col("sx").alias("cx"), F.col("sy").alias("cy"))
    return front


def _point_pairs(left: DataFrame, points: DataFrame, key: str, reach: float, sides: list[float],
                 nearest: bool) -> DataFrame:
    """``(key, px, py, label, distance)`` for all pairs that can matter, distance at most ``reach``.

    ``points`` has distinct locations ``px, py`` with a ``label`` and is written.
    """
    shapes = left.select(key, "geom").withColumn("box", G.bbox("geom"))
    side = sides[-1]
    if len(sides) > 1:
        front = _narrowed(shapes, points, key, reach, sides, nearest).join(shapes.drop("box"), key)
    else:
        front = cover(shapes, side, reach)
    at = points.withColumns({"cx": square_of("px", side), "cy": square_of("py", side)})
    spot = F.struct(F.col("px").alias("xmin"), F.col("py").alias("ymin"),
                    F.col("px").alias("xmax"), F.col("py").alias("ymax"))
    # where only membership counts, pairs that the boxes settle are not sent to the kernel
    open_pair = F.lit(True) if nearest else G.box_span(F.col("box"), spot) > reach
    gap = point_distance(F.when(open_pair, F.col("geom")), "px", "py")
    return (front.join(at, ["cx", "cy"]).filter(G.box_gap(F.col("box"), spot) <= reach)
            .withColumn("distance", gap)
            .filter(~open_pair | (F.col("distance") <= reach))
            .select(key, "px", "py", "label", "distance"))


def located(points: DataFrame, label: str | None = None) -> DataFrame:
    """Distinct locations with their smallest label; copies collapse before any shuffle."""
    value = F.lit(0) if label is None else F.min(label)
    return points.groupBy(F.col("x").alias("px"), F.col("y").alias("py")).agg(value.alias("label"))


def within(left: DataFrame, points: DataFrame, key: str, reach: float, size: float) -> DataFrame:
    """Keys of the polygons that have a point at most ``reach`` away."""
    return _by_reach(left, located(points), key, reach, size, False, lambda pairs: pairs.select(key).distinct())


def first_within(left: DataFrame, points: DataFrame, key: str, label: str, reach: float,
                 size: float) -> DataFrame:
    """The smallest label among the points at most ``reach`` away from each polygon. Large polygons
    are searched piece by piece, so that their outline is not repeated for every square."""
    spots = saved(located(points, label))
    pairs = _point_pairs(pieces(left, key, size), spots, "piece", reach, _sides(_levels(spots, size)), nearest=False)
    return pairs.groupBy(F.col("piece.key").alias(key)).agg(F.min("label").alias(label))


def nearest_locations(left: DataFrame, points: DataFrame, key: str, label: str, reach: float,
                      size: float) -> DataFrame:
    """The nearest locations of each polygon within ``reach``, ties kept, with their smallest label."""
    order = Window.partitionBy(key).orderBy("distance")
    return _by_reach(left, located(points, label), key, reach, size, True,
                     lambda pairs: pairs.withColumn("place", F.rank().over(order)).filter("place = 1").drop("place"))


def nearest_label(left: DataFrame, points: DataFrame, key: str, label: str, reach: float,
                  size: float) -> DataFrame:
    """``(key, label)``: the smallest label among the nearest points of each polygon within ``reach``.

    One minimum over distance and label, aggregated before the shuffle.
    """
    return _by_reach(left, located(points, label), key, reach, size, True,
                     lambda pairs: pairs.groupBy(key).agg(F.min(F.struct("distance", "label")).alias("best"))
                     .select(key, F.col("best.label").alias(label)))


def nearest(left: DataFrame, points: DataFrame, key: str, label: str, reach: float,
            size: float) -> DataFrame:
    """``(key, label, distance)`` of the nearest points within ``reach``; one row per tie."""
    best = nearest_locations(left, points, key, label, reach, size).drop("label")
    return (best.join(points.select(F.col("x").alias("px"), F.col("y").alias("py"), label), ["px", "py"])
            .select(key, label, "distance"))
