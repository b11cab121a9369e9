"""Exact geometry tests on Arrow batches.

All work on even-odd polygons with closed boundaries: touching counts as meeting, and the distance
to a polygon is 0 inside it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType, DoubleType

from landgrid.functions.arrow_geom import Flat, counts_to_offsets, flat, ragged

BLOCK = 1 << 20     # segment pairs held in memory at once


def point_segment_sq(px, py, ax, ay, bx, by):
    """Squared distance from points to segments."""
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = np.clip(((px - ax) * dx + (py - ay) * dy) / np.where(length > 0, length, 1.0), 0.0, 1.0)
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return ex * ex + ey * ey


def crosses_ray(px, py, ax, ay, bx, by):
    """Whether the segment meets the ray from the point towards smaller x."""
    up = (ay > py) != (by > py)
    run = np.where(up, by - ay, 1.0)
    return up & (ax + (py - ay) * (bx - ax) / run < px)


def _turn(ax, ay, bx, by, cx, cy):
    return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def segments_cross(a, b):
    """Proper crossings; touching ends are left to the distances between ends and segments."""
    t1, t2 = _turn(*a, b[0], b[1]), _turn(*a, b[2], b[3])
    t3, t4 = _turn(*b, a[0], a[1]), _turn(*b, a[2], a[3])
    return (t1 * t2 < 0) & (t3 * t4 < 0)


def _reduce(ufunc, values, offsets, empty):
    out = np.full(len(offsets) - 1, empty, dtype=values.dtype)
    filled = np.diff(offsets) > 0
    if filled.any():
        out[filled] = ufunc.reduceat(values, offsets[:-1][filled])
    return out


def point_distances(geom: Flat, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    return np.maximum(signed_distances(geom, px, py), 0.0)


def signed_distances(geom: Flat, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    """Distances to the borders of polygons, below 0 inside."""
    seg, row, offsets = geom.segments()
    ax, ay, bx, by = geom.x[seg], geom.y[seg], geom.x[seg + 1], geom.y[seg + 1]
    qx, qy = px[row], py[row]
    nearest = _reduce(np.minimum, point_segment_sq(qx, qy, ax, ay, bx, by), offsets, np.inf)
    hits = _reduce(np.add, crosses_ray(qx, qy, ax, ay, bx, by).astype(np.int64), offsets, 0)
    return np.where(hits % 2 == 1, -1.0, 1.0) * np.sqrt(nearest)


def convex(geom: Flat) -> np.ndarray:
    """Rows of one ring that turns one way only, once around."""
    seg, row, _ = geom.segments()
    dx, dy = geom.x[seg + 1] - geom.x[seg], geom.y[seg + 1] - geom.y[seg]
    real = (dx != 0) | (dy != 0)
    row, angle = row[real], np.arctan2(dy[real], dx[real])
    if not len(row):
        return np.zeros(geom.rows, dtype=bool)
    begin = np.flatnonzero(np.diff(row, prepend=-1))
    following = np.arange(len(row)) + 1
    following[np.append(begin[1:], len(row)) - 1] = begin
    turn = (angle[following] - angle + np.pi) % (2 * np.pi) - np.pi
    once = np.abs(np.abs(np.bincount(row, turn, geom.rows)) - 2 * np.pi) < 1e-6
    one_way = (np.bincount(row, turn < -1e-9, geom.rows) == 0) | (np.bincount(row, turn > 1e-9, geom.rows) == 0)
    return once & one_way & (np.diff(geom.row_ring) == 1)


def are_boxes(geom: Flat) -> np.ndarray:
    """Rows of one closed ring of four corners, with sides that run up and across by turns."""
    out = (np.diff(geom.row_ring) == 1) & (np.diff(geom.row_vertex) == 5)
    at = geom.row_vertex[:-1][out]
    x, y = (np.stack([c[at + k] for k in range(5)]) for c in (geom.x, geom.y))
    level, upright = y[1:] == y[:-1], x[1:] == x[:-1]
    turns = (level[0] & upright[1] & level[2] & upright[3]) | (upright[0] & level[1] & upright[2] & level[3])
    out[out] = turns & (x[0] == x[4]) & (y[0] == y[4])
    return out


def _pair_blocks(na: np.ndarray, nb: np.ndarray):
    """(row, i, j) over the product of two segment lists per row, in blocks of bounded size."""
    cuts = np.concatenate([[0], np.cumsum(na)])       # one entry per (row, i)
    row = np.repeat(np.arange(len(na)), na)
    i = np.arange(cuts[-1]) - cuts[row]
    width = nb[row]
    ends = np.cumsum(width)
    start = 0
    while start < len(row):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
        w = width[start:stop]
        r, k = np.repeat(row[start:stop], w), np.repeat(i[start:stop], w)
        j = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        yield r, k, j
        start = stop


def polygon_distances(a: Flat, b: Flat) -> np.ndarray:
    sa, _, oa = a.segments()
    sb, _, ob = b.segments()
    best = np.full(a.rows, np.inf)
    # one vertex of each part tells whether it lies inside the other polygon
    for one, two in ((a, b), (b, a)):
        first = one.ring[one.part[:-1]]
        owner = np.repeat(np.arange(one.rows), np.diff(one.row))
        seg, _, off = two.segments()
        count = np.diff(off)
        for r, k, j in _pair_blocks(np.diff(one.row), count):
            p, s = first[one.row[r] + k], seg[off[r] + j]
            hit = crosses_ray(one.x[p], one.y[p], two.x[s], two.y[s], two.x[s + 1], two.y[s + 1])
            # a block never splits the segments of one (row, part)
            part = one.row[r] + k
            odd = np.bincount(part[hit] - part[0], minlength=part[-1] - part[0] + 1) % 2 == 1
            best[owner[part[0]:part[-1] + 1][odd]] = 0.0
    for r, k, j in _pair_blocks(np.where(best > 0, np.diff(oa), 0), np.diff(ob)):
        s, t = sa[oa[r] + k], sb[ob[r] + j]
        p = a.x[s], a.y[s], a.x[s + 1], a.y[s + 1]
        q = b.x[t], b.y[t], b.x[t + 1], b.y[t + 1]
        d = np.minimum.reduce([
            point_segment_sq(p[0], p[1], *q), point_segment_sq(p[2], p[3], *q),
            point_segment_sq(q[0], q[1], *p), point_segment_sq(q[2], q[3], *p)])
        d[segments_cross(p, q)] = 0.0
        edges = np.flatnonzero(np.diff(r, prepend=-1))
        rows = r[edges]
        best[rows] = np.minimum(best[rows], np.minimum.reduceat(d, edges))
    return np.sqrt(best)


def _reaches(low: np.ndarray, high: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges in the order of their lower ends, by row, and how many that follow each begin inside it."""
    n = len(low)
    # ranks keep the rows apart; equal values rank the lower ends first
    order = np.lexsort((np.repeat([0, 1], n), np.concatenate([low, high]), np.tile(row, 2)))
    rank = np.empty(2 * n, dtype=np.int64)
    rank[order] = np.arange(2 * n)
    by_low = np.argsort(rank[:n])
    starts, ends = rank[:n][by_low], rank[n:][by_low]
    return by_low, np.searchsorted(starts, ends) - np.arange(n) - 1


def overlapping_ranges(low: np.ndarray, high: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i, j of closed ranges of the same row that overlap, each once, by sorting."""
    by_low, reach = _reaches(low, high, row)
    i, k = ragged(reach)
    return by_low[i], by_low[i + 1 + k]


def meeting_boxes(boxes: tuple[np.ndarray, ...], row: np.ndarray):
    """Index pairs i, j of boxes (xmin, ymin, xmax, ymax) of one row that meet, each once, in blocks of bounded size.

    Boxes are swept along the axis on which fewer overlap."""
    sweeps = [(_reaches(boxes[k], boxes[k + 2], row), boxes[1 - k], boxes[3 - k]) for k in (0, 1)]
    (order, reach), low, high = min(sweeps, key=lambda w: w[0][1].sum())
    ends = np.cumsum(reach)
    start = 0
    while start < len(order):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
        i, k = ragged(reach[start:stop])
        a, b = order[start + i], order[start + i + 1 + k]
        near = (low[a] <= high[b]) & (low[b] <= high[a])
        yield a[near], b[near]
        start = stop


def ring_areas(x: np.ndarray, y: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Signed area of each closed ring, anticlockwise positive."""
    size = np.diff(ring)
    if not len(size):
        return np.zeros(0)
    base = np.repeat(ring[:-1], size)
    u, v = x - x[base], y - y[base]
    cross = np.zeros(len(x))
    cross[:-1] = u[:-1] * v[1:] - u[1:] * v[:-1]
    cross[ring[1:][size > 0] - 1] = 0.0
    return _reduce(np.add, cross, ring, 0.0) / 2


def ring_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return _reduce(np.add, values, offsets, 0.0)


def _inside(ring: np.ndarray, x: float, y: float) -> bool:
    return bool(np.count_nonzero(crosses_ray(x, y, ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1])) % 2)


def covered(outer: np.ndarray, inner: np.ndarray) -> bool:
    """Whether a ring lies inside another; the rings are known not to cross."""
    for x, y in (inner[:-1] + inner[1:]) / 2:
        edge = point_segment_sq(x, y, outer[:-1, 0], outer[:-1, 1], outer[1:, 0], outer[1:, 1]).min()
        if edge > 1e-18:
            return _inside(outer, x, y)
    return True


def valid_polygons(g: Flat) -> np.ndarray:
    """Per row: closed finite rings of at least 4 vertices that neither cross nor share edges, holes
    inside their shell and outside each other, parts outside each other."""
    ring_row = np.repeat(np.arange(g.rows), np.diff(g.row_ring))
    size = np.diff(g.ring)
    bad = np.zeros(len(size), dtype=bool)
    some = size > 0
    head, last = g.ring[:-1][some], g.ring[1:][some] - 1
    bad[some] = (g.x[head] != g.x[last]) | (g.y[head] != g.y[last])
    bad |= (size < 4) | (_reduce(np.add, (~np.isfinite(g.x) | ~np.isfinite(g.y)).astype(np.int64), g.ring, 0) > 0)
    ok = np.diff(g.row_ring) > 0
    ok[ring_row[bad]] = False
    ok[np.repeat(np.arange(g.rows), np.diff(g.row))[np.diff(g.part) == 0]] = False
    if not ok.any():
        return ok
    seg, row, _ = g.segments()
    ring = np.repeat(np.arange(len(size)), size)[seg]
    usable = ok[row] & ((g.x[seg] != g.x[seg + 1]) | (g.y[seg] != g.y[seg + 1]))
    seg, row, ring = seg[usable], row[usable], ring[usable]
    count = np.bincount(ring, minlength=len(size))
    ok[ring_row[(count < 3) & ok[ring_row]]] = False
    place = np.arange(len(ring)) - counts_to_offsets(count)[ring]
    ax, ay, bx, by = g.x[seg], g.y[seg], g.x[seg + 1], g.y[seg + 1]
    boxes = np.minimum(ax, bx), np.minimum(ay, by), np.maximum(ax, bx), np.maximum(ay, by)
    for i, j in meeting_boxes(boxes, row):
        p, q = (ax[i], ay[i], bx[i], by[i]), (ax[j], ay[j], bx[j], by[j])
        wrong = segments_cross(p, q)
        # contacts without a crossing: ends that lie on the other segment
        touch = np.array([_on(s, x, y) for s, x, y in ((p, q[0], q[1]), (p, q[2], q[3]), (q, p[0], p[1]), (q, p[2], p[3]))])
        step = np.abs(place[i] - place[j])
        same = ring[i] == ring[j]
        neighbours = same & ((step == 1) | (step == count[ring[i]] - 1))
        contacts = touch.sum(axis=0)
        wrong |= same & ~neighbours & (contacts > 0)
        # two common points on one line are a common stretch, unless both are the same shared end
        straight = (p[2] - p[0]) * (q[3] - q[1]) == (p[3] - p[1]) * (q[2] - q[0])
        shared = (((p[0] == q[0]) & (p[1] == q[1])) | ((p[0] == q[2]) & (p[1] == q[3]))
                  | ((p[2] == q[0]) & (p[3] == q[1])) | ((p[2] == q[2]) & (p[3] == q[3])))
        wrong |= straight & (contacts >= 2) & ~(shared & (contacts == 2))
        ok[row[i[wrong]]] = False
    several = ok & (np.diff(g.row_ring) > 1)
    if several.any():
        used = several[row]
        first = np.concatenate([[0], np.cumsum(np.bincount(row[used], minlength=g.rows))])
        seg, ring = seg[used], ring[used]
        anticlockwise = ring_areas(g.x, g.y, g.ring) > 0
        shell = np.repeat(g.part[:-1], np.diff(g.part))
        for k in np.flatnonzero(several).tolist():
            s, r = seg[first[k]:first[k + 1]], ring[first[k]:first[k + 1]]
            around = containers(g.x[s], g.y[s], g.x[s + 1], g.y[s + 1], r, anticlockwise)
            # a hole lies in its shell directly, a shell in a hole or in nothing
            ok[k] = all(o == shell[n] if n != shell[n] else o < 0 or o != shell[o] for n, o in around.items())
    return ok


def containers(ax, ay, bx, by, ring, anticlockwise) -> dict[int, int]:
    """The innermost ring around each ring, -1 for none, by one sweep along y.

    Rings neither cross nor share stretches, so the edges that a horizontal line meets stay in one order from where they begin
    to where they end. Where a ring begins, the edge to the left of it tells what it lies in: that edge's ring, if its inside is
    on this side, and otherwise what that ring lies in.
    """
    level = ay == by
    ax, ay, bx, by, ring = (c[~level] for c in (ax, ay, bx, by, ring))
    up = by > ay
    x0, y0, x1, y1 = (np.where(up, u, v).tolist() for u, v in ((ax, bx), (ay, by), (bx, ax), (by, ay)))
    inside_right = (anticlockwise[ring] != up).tolist()
    of = ring.tolist()

    def place(e: int) -> int:
        """Where an edge belongs in the order: by comparing it with others in the middle of their common height."""
        low, high = 0, len(active)
        ex, ey, ey1 = x0[e], y0[e], y1[e]
        slope = (x1[e] - ex) / (ey1 - ey)
        while low < high:
            middle = (low + high) // 2
            f = active[middle]
            if f == e:
                return middle
            y = ((ey if ey > y0[f] else y0[f]) + (ey1 if ey1 < y1[f] else y1[f])) / 2
            if x0[f] + (y - y0[f]) * (x1[f] - x0[f]) / (y1[f] - y0[f]) < ex + (y - ey) * slope:
                low = middle + 1
            else:
                high = middle
        return low

    active: list[int] = []
    around: dict[int, int] = {}
    starts = sorted(range(len(of)), key=y0.__getitem__)
    ends = sorted(range(len(of)), key=y1.__getitem__)
    at = 0
    begin = 0
    while begin < len(starts):
        y = y0[starts[begin]]
        while at < len(ends) and y1[ends[at]] <= y:
            k = place(ends[at])
            if k == len(active) or active[k] != ends[at]:      # rounding has put two touching edges out of order
                k = active.index(ends[at])
            del active[k]
            at += 1
        fresh = []
        while begin < len(starts) and y0[starts[begin]] == y:
            e = starts[begin]
            active.insert(place(e), e)
            if of[e] not in around:
                fresh.append(e)
            begin += 1
        for k, e in sorted((place(e), e) for e in fresh):
            if of[e] not in around:
                left = active[k - 1] if k else -1
                around[of[e]] = -1 if left < 0 else of[left] if inside_right[left] else around[of[left]]
    return around


def _on(s, x, y):
    return ((_turn(*s, x, y) == 0) & (np.minimum(s[0], s[2]) <= x) & (x <= np.maximum(s[0], s[2]))
            & (np.minimum(s[1], s[3]) <= y) & (y <= np.maximum(s[1], s[3])))


def kept_vertices(g: Flat, tolerance: float) -> np.ndarray:
    """Douglas-Peucker on every ring at once: which vertices stay. The start of a ring stays."""
    keep = np.zeros(len(g.x), dtype=bool)
    filled = np.diff(g.ring) > 0
    a, b = g.ring[:-1][filled], g.ring[1:][filled] - 1
    keep[a] = keep[b] = True
    while len(a):
        wide = b - a > 1
        a, b = a[wide], b[wide]
        section, k = ragged(b - a - 1)
        if not len(section):
            break
        v = a[section] + 1 + k
        d = point_segment_sq(g.x[v], g.y[v], g.x[a][section], g.y[a][section], g.x[b][section], g.y[b][section])
        farthest = np.maximum.reduceat(d, counts_to_offsets(b - a - 1)[:-1])
        at = np.flatnonzero(d == farthest[section])
        _, first = np.unique(section[at], return_index=True)
        split = v[at[first]]
        go = farthest > tolerance * tolerance
        a, b, split = a[go], b[go], split[go]
        keep[split] = True
        a, b = np.concatenate([a, split]), np.concatenate([split, b])
    return keep


def simplify(g: Flat, tolerance: float) -> Flat:
    """Simplify ring by ring. Rings that would collapse, and polygons that would become invalid,
    keep their vertices."""
    keep = kept_vertices(g, tolerance)
    ring = np.repeat(np.arange(len(g.ring) - 1), np.diff(g.ring))
    left = np.bincount(ring[keep], minlength=len(g.ring) - 1)
    keep |= (left < 4)[ring]
    left = np.bincount(ring[keep], minlength=len(g.ring) - 1)
    short = Flat(g.x[keep], g.y[keep], counts_to_offsets(left), g.part, g.row)
    changed = np.diff(short.row_vertex) < np.diff(g.row_vertex)
    rows = np.flatnonzero(changed)
    choice = np.ones(g.rows, dtype=np.int64)
    choice[rows[valid_polygons(short.take(rows))]] = 0
    return Flat.choose([short, g], choice)


@arrow_udf(DoubleType())
def point_distance(geom: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    """Distance from a polygon to a point."""
    return pa.array(point_distances(flat(geom), x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False)))


@arrow_udf(DoubleType())
def polygon_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """Distance between two polygons, 0 where they meet."""
    return pa.array(polygon_distances(flat(a), flat(b)))


@arrow_udf(BooleanType())
def is_valid(geom: pa.Array) -> pa.Array:
    return pa.array(valid_polygons(flat(geom)))
