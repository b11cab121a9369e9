"""Numpy kernels on hand-made and random shapes."""

import math
import time

import numpy as np
import pytest

from landgrid.functions import slabs
from landgrid.functions.arrow_geom import Flat, flat, from_rings
from landgrid.functions.forest import star_forest
from landgrid.functions.predicates import (covered, point_distances, point_segment_sq, polygon_distances, ring_areas,
                                           simplify, valid_polygons)
from landgrid.functions.slabs import Edges
from landgrid.functions.tiles import cut_to_squares


def rect(x0, y0, x1, y1):
    return np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]], float)


def star(rng, cx, cy, n, radius):
    """A simple polygon around its centre."""
    turn = 2 * np.pi * (np.arange(n) + rng.uniform(0.1, 0.9, n)) / n
    r = radius * rng.uniform(0.3, 1, n)
    ring = np.column_stack([cx + r * np.cos(turn), cy + r * np.sin(turn)])
    return np.vstack([ring, ring[:1]])


def areas(g):
    per_ring = ring_areas(g.x, g.y, g.ring)
    return np.array([per_ring[g.row_ring[k]:g.row_ring[k + 1]].sum() for k in range(g.rows)])


def minus(subject, cuts):
    """Subject polygons less lists of polygons, one per row."""
    row = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
    place = np.concatenate([np.arange(len(c)) for c in cuts]) + 1
    return slabs.difference(Edges.of(from_rings(subject)), Edges.of(from_rings([s for c in cuts for s in c]), row, place))


CUTS = [
    ([rect(3, 3, 6, 6)], 91, [2]),                                  # a hole
    ([rect(3, 3, 6, 6), rect(6, 6, 8, 8)], 87, [3]),                # holes that touch in a point
    ([rect(-1, 4, 11, 6)], 80, [1, 1]),                             # cut through
    ([rect(0, 0, 10, 10)], 0, []),                                  # nothing left
    ([rect(5, 5, 20, 20), rect(4, -1, 5, 11)], 65, [1, 1]),         # shared edge
    ([rect(0, 3, 3, 6)], 91, [1]),                                  # collinear overlap
    ([rect(0, 0, 5, 5), rect(5, 5, 10, 10)], 50, [1, 1]),           # pieces that touch in a point
    ([rect(10, 0, 12, 10)], 100, [1]),                              # touches from outside
    ([rect(3, 3, 6, 6), rect(3, 3, 6, 6), rect(4, 4, 5, 5)], 91, [2]),
]


def test_difference_by_hand():
    t = \
        minus([[[rect(0, 0, 10, 10)]]] * len(CUTS), [[[[r]] for r in c] for c, _, _ in CUTS])
    out = slabs.polygons(t, len(CUTS))
    for k, (_, area, rings) in enumerate(CUTS):
        assert t.areas(len(CUTS))[k] == pytest.approx(area)
        assert [len(p) for p in out.rings_of(k)] == rings
    assert areas(out) == pytest.approx([a for _, a, _ in CUTS])
    assert (valid_polygons(out) == [a > 0 for _, a, _ in CUTS]).all()


def test_difference_and_union_agree_on_random_shapes():
    rng = np.random.default_rng(0)
    n = 300
    subject = [[[star(rng, 0, 0, rng.integers(3, 25), 100)]] for _ in range(n)]
    cuts = [[[[star(rng, *rng.uniform(-100, 100, 2), rng.integers(3, 25), 60)]] for _ in range(rng.integers(1, 6))]
            for _ in range(n)]
    row = np.repeat(np.arange(n), [len(c) for c in cuts])
    place = np.concatenate([np.arange(len(c)) for c in cuts]) + 1
    a, b = Edges.of(from_rings(subject)), Edges.of(from_rings([s for c in cuts for s in c]), row, place)
    rest = slabs.difference(a, b)
    assert rest.areas(n) == pytest.approx(slabs.union(a + b).areas(n) - slabs.union(b).areas(n), abs=1e-6)
    out = slabs.polygons(rest, n)
    assert areas(out) == pytest.approx(rest.areas(n), abs=1e-4)
    assert valid_polygons(out)[rest.areas(n) > 1e-3].all()
    # inclusion-exclusion with the first cut alone
    first = place == 1
    one = Edges(b.xy[np.isin(b.row * 100 + b.shape, row[first] * 100 + 1)], *[
        v[np.isin(b.row * 100 + b.shape, row[first] * 100 + 1)] for v in (b.row, b.shape)])
    both = slabs.intersection(a + one, np.full(n, 2)).areas(n)
    assert both == pytest.approx(a_area(a, n) - slabs.difference(a, one).areas(n), abs=1e-6)


def a_area(a, n):
    return slabs.union(a).areas(n)


def test_buffer_of_a_rectangle():
    g = from_rings([[[rect(0, 0, 10, 8)]], [[rect(0, 0, 40, 40), rect(10, 10, 30, 30)]], [[rect(0, 0, 3, 3)]]])
    out = slabs.buffered(g, np.array([5.0, 5.0, 0.0]))
    corner = 32 * 25 * math.sin(math.pi / 32)
    assert areas(out) == pytest.approx([80 + 2 * 5 * 18 + corner, 50 * 50 - 100 + corner - 100, 9])
    assert [len(p) for p in out.rings_of(1)] == [2]


def test_buffer_of_random_shapes_by_distance():
    rng = np.random.default_rng(1)
    g = from_rings([[[star(rng, 0, 0, rng.integers(4, 20), 100)]] for _ in range(60)])
    out = slabs.buffered(g, np.full(60, 5.0))
    assert valid_polygons(out).all()
    for k in range(60):
        spots = rng.uniform(-110, 110, (100, 2))
        rows = np.full(100, k)
        to_shape = point_distances(g.take(rows), spots[:, 0], spots[:, 1])
        to_grown = point_distances(out.take(rows), spots[:, 0], spots[:, 1])
        assert (to_grown[to_shape < 4.98] == 0).all()
        assert (to_grown[to_shape > 5.001] > 0).all()


def test_distances_by_hand():
    g = from_rings([[[rect(0, 0, 10, 10)]], [[rect(0, 0, 10, 10), rect(3, 3, 6, 6)]], [[rect(0, 0, 1, 1)], [rect(5, 5, 6, 6)]]])
    assert point_distances(g, np.array([13.0, 4.5, 3.0]), np.array([14.0, 4.5, 5.0])) == pytest.approx([5, 1.5, 2])
    other = from_rings([[[rect(12, 12, 13, 13)]], [[rect(4, 4, 5, 5)]], [[rect(6, 6, 7, 7)]]])
    assert polygon_distances(g, other) == pytest.approx([math.sqrt(8), 1, 0])
    inside = from_rings([[[rect(4, 4, 5, 5)]]])
    assert polygon_distances(from_rings([[[rect(0, 0, 10, 10)]]]), inside)[0] == 0
    assert polygon_distances(inside, from_rings([[[rect(0, 0, 10, 10)]]]))[0] == 0


def test_distances_against_sampling():
    rng = np.random.default_rng(2)
    a = from_rings([[[star(rng, 0, 0, 8, 50)]] for _ in range(40)])
    b = from_rings([[[star(rng, *rng.uniform(-120, 120, 2), 7, 50)]] for _ in range(40)])
    got = polygon_distances(a, b)
    for k in range(40):
        (ring,), (other,) = a.rings_of(k)[0], b.rings_of(k)[0]
        t = np.linspace(0, 1, 400)[:, None, None]
        spots = (ring[:-1] + t * (ring[1:] - ring[:-1])).reshape(-1, 2)
        d = point_distances(b.take(np.full(len(spots), k)), spots[:, 0], spots[:, 1]).min()
        if covered(ring, other):
            d = 0
        assert got[k] == pytest.approx(d, abs=0.5)


@pytest.mark.parametrize("parts, good", [
    ([[rect(0, 0, 10, 10)]], True),
    ([[np.array([[0, 0], [10, 10], [10, 0], [0, 10], [0, 0]], float)]], False),          # crosses itself
    ([[rect(0, 0, 10, 10)[:-1]]], False),                                                # open
    ([[np.array([[0, 0], [1, 1], [0, 0]], float)]], False),                              # too short
    ([[np.array([[0, 0], [5, np.nan], [3, 3], [0, 0]], float)]], False),
    ([[rect(0, 0, 10, 10), rect(3, 3, 6, 6)]], True),
    ([[rect(0, 0, 10, 10), rect(0, 3, 6, 6)]], False),                                   # hole along the shell
    ([[rect(0, 0, 9, 9), np.array([[0, 4], [3, 3], [3, 6], [0, 4]], float)]], True),     # hole touches in a point
    ([[rect(0, 0, 10, 10), rect(12, 3, 16, 6)]], False),                                 # hole outside
    ([[rect(0, 0, 1, 1)], [rect(1, 1, 2, 2)]], True),
    ([[rect(0, 0, 1, 1)], [rect(1, 0, 2, 1)]], False),                                   # shared edge
    ([[rect(0, 0, 9, 9)], [rect(1, 1, 2, 2)]], False),                                   # part in part
    ([[np.array([[0, 0], [5, 0], [10, 0], [10, 10], [0, 10], [0, 0]], float)]], True),   # straight vertex
    ([[np.array([[0, 0], [8, 0], [5, 0], [5, 5], [0, 0]], float)]], False),              # folds back
    ([], False),
])
def test_validity(parts, good):
    g = from_rings([[[rect(0, 0, 1, 1)]], parts, [[rect(5, 5, 6, 6)]]])
    assert valid_polygons(g).tolist() == [True, good, True]


def nested_by_pairs(parts):
    """Every ring held against every other one: holes in their shell and outside each other, parts outside each other."""
    for shell, *holes in parts:
        for k, hole in enumerate(holes):
            if not covered(shell, hole) or any(covered(o, hole) for m, o in enumerate(holes) if m != k):
                return False
    return not any(m != k and covered(other[0], part[0]) and not any(covered(h, part[0]) for h in other[1:])
                   for k, part in enumerate(parts) for m, other in enumerate(parts))


def test_nesting_by_sweep_against_pairs():
    rng = np.random.default_rng(11)
    seen = set()
    for _ in range(400):
        # squares with corners on few lines that never share a stretch, in random roles
        n = int(rng.integers(2, 9))
        xs, ys = (rng.permutation(40)[:2 * n].reshape(n, 2) for _ in range(2))
        rings = []
        for (a, b), (c, d) in zip(np.sort(xs, axis=1), np.sort(ys, axis=1)):
            box = (a, c, b, d)
            if all(box[2] < o[0] or o[2] < box[0] or box[3] < o[1] or o[3] < box[1]
                   or (o[0] < box[0] and box[2] < o[2] and o[1] < box[1] and box[3] < o[3])
                   or (box[0] < o[0] and o[2] < box[2] and box[1] < o[1] and o[3] < box[3]) for o, _ in rings):
                r = rect(*box).astype(float)
                rings.append((box, r[::-1] if rng.random() < 0.5 else r))
        rings = [r for _, r in rings]
        turn = rng.uniform(0, 6)
        rings = [np.column_stack([r[:, 0] * math.cos(turn) - r[:, 1] * math.sin(turn), r[:, 0] * math.sin(turn) + r[:, 1] * math.cos(turn)]) for r in rings]
        for r in rings:
            r[-1] = r[0]
        parts = []
        for r in rings:
            if parts and rng.random() < 0.6:
                parts[int(rng.integers(len(parts)))].append(r)
            else:
                parts.append([r])
        want = nested_by_pairs(parts)
        seen.add((want, len(rings) > 2))
        assert valid_polygons(from_rings([parts]))[0] == want
    assert len(seen) == 4


@pytest.mark.parametrize("across, down", [(100, 100), (10_000, 1), (1, 10_000)])
def test_many_holes(across, down):
    shell = rect(0, 0, 4 * across + 2, 4 * down + 2)
    holes = [rect(4 * i + 2, 4 * j + 2, 4 * i + 4, 4 * j + 4) for i in range(across) for j in range(down)]
    g = from_rings([[[shell, *holes]], [[shell, *holes, rect(2.5, 2.5, 3, 3)]], [[shell, *holes, rect(3, 3, 5, 5)]]])
    start = time.time()
    assert valid_polygons(g).tolist() == [True, False, False]
    assert time.time() - start < 12


def test_simplify_keeps_within_tolerance_and_valid():
    rng = np.random.default_rng(3)
    g = from_rings([[[star(rng, 0, 0, 60, 40)]] for _ in range(50)])
    out = simplify(g, 2.0)
    assert valid_polygons(out).all()
    assert len(out.x) < len(g.x)
    for k in range(50):
        (new,) = out.rings_of(k)[0]
        for x, y in g.rings_of(k)[0][0]:
            assert point_segment_sq(x, y, new[:-1, 0], new[:-1, 1], new[1:, 0], new[1:, 1]).min() <= 4 + 1e-9


def test_simplify_keeps_small_rings():
    g = from_rings([[[rect(0, 0, 1, 1)]]])
    assert len(simplify(g, 2.0).x) == 5


def test_squares_cover_the_polygon_exactly():
    rng = np.random.default_rng(4)
    rings = [star(rng, *rng.uniform(-50, 50, 2), rng.integers(3, 200), 300) for _ in range(20)]
    g = from_rings([[[r]] for r in rings] + [[[rect(-128, 0, 128, 256), rect(-20, 30, 20, 200)[::-1]]]])
    owner, square, full, chip = cut_to_squares(g, 64.0)
    total = np.bincount(owner, areas(chip) + full * 64.0 * 64.0, minlength=g.rows)
    assert total == pytest.approx(areas(g), rel=1e-9)
    assert valid_polygons(chip.take(np.flatnonzero(~full))).all()
    assert len(set(zip(owner.tolist(), map(tuple, square.tolist())))) == len(owner)
    x0, y0, x1, y1 = chip.take(np.flatnonzero(~full)).bounds()
    at = square[~full] * 64.0
    assert (x0 >= at[:, 0] - 1e-6).all() and (x1 <= at[:, 0] + 64 + 1e-6).all()
    assert (y0 >= at[:, 1] - 1e-6).all() and (y1 <= at[:, 1] + 64 + 1e-6).all()


def test_arrow_round_trip_with_slices():
    g = from_rings([[[rect(0, 0, 1, 1)]], [], [[rect(0, 0, 9, 9), rect(3, 3, 6, 6)], [rect(20, 0, 30, 9)]]])
    back = flat(g.array().slice(1))
    assert [[len(r) for r in p] for p in back.rings_of(1)] == [[5, 5], [5]] and back.rows == 2
    assert isinstance(back.take(np.array([1, 0, 1])), Flat)


def test_star_forest():
    root, member = star_forest(np.array([5, 3, 9, 8]), np.array([3, 7, 8, 9]))
    assert dict(zip(member.tolist(), root.tolist())) == {5: 3, 7: 3, 9: 8}


@pytest.mark.parametrize("rows", [0, 3])
def test_kernels_take_empty_batches(rows):
    g = Flat.empty(rows)
    assert valid_polygons(g).tolist() == [False] * rows
    assert simplify(g, 2.0).rows == rows
    assert slabs.buffered(g, np.full(rows, 5.0)).rows == rows
    assert slabs.polygons(slabs.union(Edges.of(g)), rows).rows == rows
    assert len(polygon_distances(g, g)) == rows
    assert len(point_distances(g, np.zeros(rows), np.zeros(rows))) == rows
    assert flat(g.array()).rows == rows
    assert len(cut_to_squares(g, 10.0)[0]) == 0
