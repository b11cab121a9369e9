"""Components of grid squares against union-find on the driver."""

import numpy as np
import pytest

from landgrid.operators import squares
from tests.test_operators import union_find


def coded(spark, rows):
    """Edges (ax, ay, bx, by) between squares as codes."""
    frame = spark.createDataFrame([tuple(int(v) for v in r) for r in rows], "ax long, ay long, bx long, by long")
    f = squares.F.col
    return frame.repartition(5).select(squares.square_code(f("ax"), f("ay")).alias("u"), squares.square_code(f("bx"), f("by")).alias("v"))


def code(x, y):
    return (int(x) + squares.ORIGIN << 32) + int(y) + squares.ORIGIN


def assert_components(spark, rows):
    places = sorted({code(*r[:2]) for r in rows} | {code(*r[2:]) for r in rows})
    number = {c: i for i, c in enumerate(places)}
    want = union_find(len(places), [(number[code(*r[:2])], number[code(*r[2:])]) for r in rows])
    found = {r.member: r.root for r in squares.square_components(coded(spark, rows)).collect()}
    assert set(found) <= set(places) and not set(found.values()) & set(found)
    groups = {}
    for i, c in enumerate(places):
        groups.setdefault(want[i], set()).add(found.get(c, c))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


@pytest.mark.parametrize("first, step, rows_at_once", [(1, 3, 1 << 20), (2, 5, 40), (8, 4, 1 << 20)])
def test_random_squares(spark, monkeypatch, first, step, rows_at_once):
    """Short edges around the origin, some long ones, repeated and turned; also with blocks above a task's share."""
    monkeypatch.setattr(squares, "FIRST", first)
    monkeypatch.setattr(squares, "STEP", step)
    monkeypatch.setattr(squares, "ROWS_AT_ONCE", rows_at_once)
    rng = np.random.default_rng(3)
    a = rng.integers(-40, 40, (900, 2))
    near = np.concatenate([a, a + rng.integers(-2, 3, a.shape)], axis=1)
    far = rng.integers(-1 << 20, 1 << 20, (30, 4))
    assert_components(spark, np.concatenate([near, near[:50], near[50:90, [2, 3, 0, 1]], far]).tolist())


def test_chain_across_the_extent(spark):
    steps = np.arange(-3000, 3000)
    chain = np.stack([steps, steps // 7, steps + 1, (steps + 1) // 7], axis=1)
    found = squares.square_components(coded(spark, chain.tolist()))
    assert found.count() == 6000 and found.select("root").distinct().count() == 1


def test_farthest_squares_and_nothing(spark):
    end = squares.ORIGIN
    assert_components(spark, [(-end, -end, end - 1, end - 1), (0, 0, 0, 0), (5, 5, 5, 6)])
    assert squares.square_components(coded(spark, [])).collect() == []
    assert squares.square_components(coded(spark, [(4, 4, 4, 4)])).collect() == []
    with pytest.raises(Exception, match="too small for the extent"):
        coded(spark, [(end, 0, 0, 0)]).collect()


def test_rounds_shrink(spark, monkeypatch):
    """A filled field of 256 x 256 squares leaves little more than the rims of its blocks to the second round."""
    monkeypatch.setattr(squares, "FIRST", 5)
    sizes, real = [], squares._united
    monkeypatch.setattr(squares, "_united", lambda rest, level: sizes.append(rest.count()) or real(rest, level))
    x, y = np.divmod(np.arange(256 * 256), 256)
    right = np.stack([x, y, x + 1, y], axis=1)
    up = np.stack([x, y, x, y + 1], axis=1)
    found = squares.square_components(coded(spark, np.concatenate([right, up]).tolist()))
    assert found.select("root").distinct().count() == 1 and found.count() == 257 * 257 - 2
    assert sizes[1] < sizes[0] / 4
