"""Connected components, dense cluster numbers and density clustering."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrid.functions.forest import star_forest
from landgrid.operators.squares import least_of_component, square_code, square_components
from landgrid.operators.tables import row_ids
from landgrid.shared import saved, shuffled

EDGES_AT_ONCE = 1 << 20     # edges one task holds while it contracts
MAX_ROUNDS = 60
HUB = 1 << 16              # edges of a node that one task may get
POINT_PAIRS = 1 << 14       # pairs of points that two nodes may make without being divided
STEP = 2                    # halvings of a node's side from one level to the next


class NotConverged(RuntimeError):
    pass


def contracted(edges: DataFrame) -> DataFrame:
    """Edges ``(u, v)`` as fewer edges with the same components.

    Each task replaces the edges it reads, a bounded number at a time, by stars around the smallest
    node. Run before a shuffle, this turns a dense group of edges into at most one edge per node.
    """
    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars(held):
            u = np.concatenate([b.column("u").to_numpy() for b in held])
            v = np.concatenate([b.column("v").to_numpy() for b in held])
            root, member = star_forest(u, v)
            return pa.RecordBatch.from_arrays([pa.array(root), pa.array(member)], names=["u", "v"])

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= EDGES_AT_ONCE:
                yield stars(held)
                held, rows = [], 0
        if held:
            yield stars(held)

    plain = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v")
    return plain.mapInArrow(shrink, "u long, v long")


def _with_low(rows: DataFrame, lows: DataFrame) -> DataFrame:
    """``rows`` (``u, v``) with the ``low`` of their ``u``. ``lows`` (``u, low, n``) is written.

    Rows of a node with more than ``HUB`` of them stay where they are: there is one such node per ``HUB`` rows at most,
    so these nodes are broadcast, and no task gets all the rows of one. The others go through a shuffle."""
    hubs = F.broadcast(lows.filter(F.col("n") > HUB).select("u", "low"))
    light = rows.join(hubs.select("u"), "u", "left_anti").join(shuffled(lows.select("u", "low")), "u")
    return light.unionByName(rows.join(hubs, "u"))


def _mixed(node: Column, turn: int) -> Column:
    """Another long for each long, one to one, in an order that looks random and differs from turn to turn."""
    low = F.lit(0xFFFFFFFF)
    for half in range(2):
        upper, lower = F.shiftrightunsigned(node, 32), node.bitwiseAND(low)
        node = F.shiftleft(lower, 32).bitwiseOR(upper.bitwiseXOR(F.xxhash64(lower, F.lit(2 * turn + half)).bitwiseAND(low)))
    return node


def _labels(edges: DataFrame, nodes: DataFrame | None, turn: int) -> DataFrame:
    """``u, low, n, least, size`` of every node: its label, edges, smallest key and how many nodes it was made of.

    The label is the smallest of its own and its neighbours' mixed names, so nodes of one label hang together; where only
    stars are left, it is the centre. Nodes without edges have none. ``nodes`` (``u, least, size``) is None where the nodes
    are keys themselves. All values are aggregated before the shuffle, so a node with very many edges is never collected.
    """
    def rows(u, v, member):
        out = edges.select(F.col(u).alias("u"), F.col(v).alias("v"), F.lit(member).alias("member"))
        return out if nodes is not None else out.withColumns({"least": F.col("u"), "size": F.lit(1).cast("long")})

    around = rows("u", "v", 0).unionByName(rows("v", "u", 1))
    if nodes is not None:
        around = around.unionByName(nodes, allowMissingColumns=True)
    found = saved(around.groupBy("u").agg(
        F.min("v").alias("v"), F.min(_mixed(F.col("v"), turn)).alias("low"), F.count("v").alias("n"), F.sum("member").alias("times"),
        F.min("member").alias("side"), F.min("least").alias("least"), F.max("size").alias("size")))
    # stars: no node is both a centre and a member, and a member has one edge
    if found.filter("times > 1 or times = 1 and side = 0").isEmpty():
        label = F.when(F.col("times") == 1, F.col("v")).otherwise(F.col("u"))
    else:
        label = F.least("low", _mixed(F.col("u"), turn))
    return found.select("u", F.when(F.col("n") > 0, label).alias("low"), "n", "least", "size")


def _relabelled(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between the labels of their ends, each once."""
    once = _with_low(edges, labels).select(F.col("v").alias("u"), F.col("low").alias("v"))
    both = _with_low(once, labels).select(F.least("v", "low").alias("u"), F.greatest("v", "low").alias("v"))
    return both.filter("u <> v").distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """``(member, root)`` of every node that is not the smallest of its component.

    ``edges`` has long columns ``u, v``; direction and repetition do not matter. Every size takes the
    same way: forests per task, then rounds in which every node takes a label from its neighbours and the nodes of a label become
    one (Lacki et al., "Connected Components at Scale via Local Contractions", 2018). The graph shrinks with each round, so all
    of them together cost about twice the first. On the way back nodes get the root that their label has got.
    """
    rest, nodes, levels = saved(contracted(edges)), None, []
    while not rest.isEmpty():
        if len(levels) == MAX_ROUNDS:
            raise NotConverged(f"components did not settle in {MAX_ROUNDS} rounds")
        levels.append(_labels(rest, nodes, len(levels)))
        named = levels[-1].filter("low is not null")
        nodes = saved(named.groupBy(F.col("low").alias("u")).agg(F.min("least").alias("least"), F.count("*").alias("size")))
        rest = saved(contracted(_relabelled(rest, named.select("u", "low", "n"))))
    if not levels:
        return rest.select(F.col("v").alias("member"), F.col("u").alias("root"))
    found = nodes.select("u", F.col("least").alias("root"), "size")
    while levels:
        labels = levels.pop()
        tops = found.select("u", F.col("root").alias("low"), F.col("size").alias("n"))
        below = _with_low(labels.filter("low is not null").select(F.col("low").alias("u"), F.col("u").alias("v"), "size"), tops)
        alone = labels.filter("low is null").select("u", F.col("least").alias("root"), "size")
        found = below.select(F.col("v").alias("u"), F.col("low").alias("root"), "size").unionByName(alone)
        found = saved(found.filter("u <> root") if not levels else found)
    return found.select(F.col("u").alias("member"), "root")


def component_labels(nodes: DataFrame, edges: DataFrame, key: str, label: str = "component") -> DataFrame:
    """``nodes`` with the smallest key of their component; a node without edges is its own."""
    found = component_roots(edges).select(F.col("member").alias(key), F.col("root").alias(label))
    return nodes.join(shuffled(found), key, "left").withColumn(label, F.coalesce(label, F.col(key).cast("long")))


def dense_numbers(labelled: DataFrame, label: str, number: str = "cluster") -> DataFrame:
    """Replace labels by 0..n-1 in the order of the labels."""
    numbers = row_ids(labelled.select(label).distinct(), [label], number)
    return labelled.join(shuffled(numbers.withColumn(number, F.col(number).cast("int"))), label)


def density_clusters(points: DataFrame, key: str, eps: float, min_samples: int) -> DataFrame:
    """Density clustering of points ``key, x, y``: ``(key, cluster)``, -1 for noise.

    A point is a core point when at least ``min_samples`` points, itself included, lie within
    ``eps``. Clusters are the components of core points; a border point joins the cluster with the
    smallest key in reach. Cluster labels are the smallest key of a core point.

    The squares have a diagonal of ``eps``, so the points of a square are neighbours without a
    test. A square with ``min_samples`` points holds core points only; counting runs only for points
    of thinner squares, of which each holds fewer than ``min_samples`` points.
    """
    side = eps / math.sqrt(2.0) * (1 - 1e-9)
    limit = F.lit(eps)
    spots = (points.groupBy("x", "y").agg(F.count("*").alias("weight"), F.min(key).alias("id"))
             .withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)}))
    squares = spots.groupBy("cx", "cy").agg(F.sum("weight").alias("held"))
    spots = saved(spots.join(shuffled(squares), ["cx", "cy"]))
    thin = spots.filter(F.col("held") < min_samples)

    def around(df, names):
        """Rows of ``df`` listed under the squares within reach, columns renamed."""
        steps = F.sequence(F.lit(-2), F.lit(2))
        out = df.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
        return out.select((F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy"),
                          *(F.col(c).alias(n) for c, n in names.items()))

    def close():
        return F.hypot(F.col("x") - F.col("x1"), F.col("y") - F.col("y1")) <= limit

    asked = around(thin, {"x": "x1", "y": "y1", "id": "id1"})
    counted = (asked.join(shuffled(spots), ["cx", "cy"]).filter(close())
               .groupBy("id1").agg(F.sum("weight").alias("n")).filter(F.col("n") >= min_samples))
    core = saved(spots.filter(F.col("held") >= min_samples).unionByName(
        thin.join(shuffled(counted.select(F.col("id1").alias("id"))), "id", "left_semi").select(spots.columns)))

    # core points of one square are neighbours: clusters are components of squares
    hubs = saved(core.groupBy("cx", "cy").agg(F.min("id").alias("least"), F.count("*").alias("n"), *_extent())
                 .withColumn("hub", square_code(F.col("cx"), F.col("cy"))))
    links = saved(_square_links(core, hubs, eps, side))
    labels = least_of_component(hubs.select("hub", "cx", "cy", "least"), links, "hub", "least", "cluster")
    core = saved(core.join(shuffled(labels.select("cx", "cy", "cluster")), ["cx", "cy"]))
    edge = thin.join(shuffled(core.select("id")), "id", "left_anti")
    reached = (around(edge, {"x": "x1", "y": "y1", "id": "id1"})
               .join(shuffled(core.select("cx", "cy", "x", "y", "cluster")), ["cx", "cy"]).filter(close())
               .groupBy(F.col("id1").alias("id")).agg(F.min("cluster").alias("cluster")))
    found = core.select("id", "cluster").unionByName(reached)
    labelled = spots.select("x", "y", "id").join(shuffled(found), "id", "left") \
                    .select("x", "y", F.coalesce("cluster", F.lit(-1)).cast("long").alias("cluster"))
    return points.select(key, "x", "y").join(shuffled(labelled), ["x", "y"]).select(key, "cluster")


def _extent():
    return [f(c).alias(f"{c}{k}") for c in "xy" for k, f in enumerate((F.min, F.max))]


def _apart(pairs: DataFrame, eps: float) -> DataFrame:
    """Pairs of boxes with their smallest (``gap``) and largest (``far``) distance, without those out of reach."""
    far_x = F.greatest(F.col("o_x1") - F.col("x0"), F.col("x1") - F.col("o_x0"))
    far_y = F.greatest(F.col("o_y1") - F.col("y0"), F.col("y1") - F.col("o_y0"))
    gap_x = F.greatest(F.col("o_x0") - F.col("x1"), F.col("x0") - F.col("o_x1"), F.lit(0.0))
    gap_y = F.greatest(F.col("o_y0") - F.col("y1"), F.col("y0") - F.col("o_y1"), F.lit(0.0))
    return pairs.withColumns({"far": F.hypot(far_x, far_y), "gap": F.hypot(gap_x, gap_y)}).filter(F.col("gap") <= eps)


def _square_links(core: DataFrame, hubs: DataFrame, eps: float, side: float) -> DataFrame:
    """Edges ``u, v`` of squares (``hub``) that join the same ones as all pairs with core points within ``eps`` do.

    Whether the closest two points are near enough is first read off the extents of the squares; what these
    leave open is walked.
    """
    near = hubs.withColumn("dx", F.explode(F.sequence(F.lit(0), F.lit(2)))) \
               .withColumn("dy", F.explode(F.sequence(F.lit(-2), F.lit(2)))) \
               .filter("dx > 0 or dy > 0")
    near = near.drop("least")
    other = hubs.drop("least")
    other = other.select(*(F.col(c).alias(f"o_{c}") for c in other.columns))
    pairs = near.join(shuffled(other), (F.col("cx") + F.col("dx") == F.col("o_cx")) & (F.col("cy") + F.col("dy") == F.col("o_cy")))
    pairs = saved(_apart(pairs, eps))
    sure = pairs.filter(F.col("far") <= eps).select(F.col("hub").alias("u"), F.col("o_hub").alias("v"))
    # squares that a chain of sure links already joins need no further test
    roots = square_components(sure)
    side_a = roots.select(F.col("member").alias("hub"), F.col("root").alias("root_a"))
    side_b = roots.select(F.col("member").alias("o_hub"), F.col("root").alias("root_b"))
    open_pairs = (pairs.filter(F.col("far") > eps).join(shuffled(side_a), "hub", "left").join(shuffled(side_b), "o_hub", "left")
                  .filter(F.coalesce("root_a", "hub") != F.coalesce("root_b", "o_hub"))
                  .withColumns({"sx": F.col("cx"), "sy": F.col("cy"), "o_sx": F.col("o_cx"), "o_sy": F.col("o_cy")})
                  .drop("root_a", "root_b", "dx", "dy", "far", "gap"))
    return sure.unionByName(_walked(saved(open_pairs), core.select("cx", "cy", "x", "y"), eps, side))


def _walked(pairs: DataFrame, core: DataFrame, eps: float, side: float) -> DataFrame:
    """``u, v`` of the pairs of squares that hold points within ``eps``, by a walk down two quadtrees at once.

    Nodes that make few pairs of points are compared point by point. Crowded ones are divided: their children's
    extents rule a pair out, prove it (any two points of it are witnesses, and all other pairs of these squares are
    dropped), or leave it to the next level. ``core`` has every location once, so nodes thin out.
    """
    level, found = 0, []
    while True:
        crowded = pairs.filter(F.col("n") * F.col("o_n") > POINT_PAIRS)
        found.append(_tested(pairs.filter(F.col("n") * F.col("o_n") <= POINT_PAIRS), _placed(core, side, level), eps))
        if crowded.isEmpty():
            break
        level += STEP
        squares = crowded.select("cx", "cy").unionByName(crowded.select(F.col("o_cx").alias("cx"), F.col("o_cy").alias("cy")))
        core = core.join(shuffled(squares.distinct()), ["cx", "cy"], "left_semi")
        nodes = (_placed(core, side, level).groupBy("cx", "cy", "sx", "sy").agg(F.count("*").alias("n"), *_extent())
                 .withColumns({"px": F.shiftright("sx", STEP), "py": F.shiftright("sy", STEP)}))
        theirs = nodes.select(*(F.col(c).alias(f"o_{c}") for c in nodes.columns))
        ends = ["cx", "cy", "px", "py"]
        parents = crowded.select("hub", "o_hub", "cx", "cy", "o_cx", "o_cy", *(
            F.col(f"{o}s{c}").alias(f"{o}p{c}") for o in ("", "o_") for c in "xy"))
        below = parents.join(shuffled(nodes), ends).join(shuffled(theirs), [f"o_{c}" for c in ends]).drop("px", "py", "o_px", "o_py")
        below = saved(_apart(below, eps))
        sure = below.filter(F.col("far") <= eps).select("hub", "o_hub").distinct()
        found.append(sure.select(F.col("hub").alias("u"), F.col("o_hub").alias("v")))
        pairs = below.drop("far", "gap").join(shuffled(sure), ["hub", "o_hub"], "left_anti")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links.distinct() if len(found) > 1 else links


def _placed(core: DataFrame, side: float, level: int) -> DataFrame:
    """Points with the part ``sx, sy`` of their square that they lie in, after ``level`` halvings of its side."""
    part = side / 2 ** level
    return core.withColumns({"sx": F.floor(F.col("x") / part), "sy": F.floor(F.col("y") / part)})


def _tested(pairs: DataFrame, placed: DataFrame, eps: float) -> DataFrame:
    """``u, v`` of the node pairs that hold points within ``eps``; only points near the other node's extent are paired."""
    dx = F.greatest(F.col("o_x0") - F.col("x"), F.col("x") - F.col("o_x1"), F.lit(0.0))
    dy = F.greatest(F.col("o_y0") - F.col("y"), F.col("y") - F.col("o_y1"), F.lit(0.0))
    here, there = ["cx", "cy", "sx", "sy"], ["o_cx", "o_cy", "o_sx", "o_sy"]
    mine = (placed.join(shuffled(pairs.select(*here, *there, "hub", "o_hub", "o_x0", "o_x1", "o_y0", "o_y1")), here)
            .filter(F.hypot(dx, dy) <= eps).select("hub", "o_hub", *there, "x", "y"))
    theirs = placed.select(*(F.col(c).alias(f"o_{c}") for c in here), F.col("x").alias("xb"), F.col("y").alias("yb"))
    return (mine.join(shuffled(theirs), there)
            .filter(F.hypot(F.col("x") - F.col("xb"), F.col("y") - F.col("yb")) <= eps)
            .select(F.col("hub").alias("u"), F.col("o_hub").alias("v")).distinct())
