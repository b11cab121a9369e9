"""Cutting large polygons into the squares of a grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from landgrid.functions.arrow_geom import GEOM_TYPE, Flat, flat
from landgrid.functions.slabs import Edges, difference, polygons

TILE_TYPE = pa.list_(pa.struct([("cx", pa.int64()), ("cy", pa.int64()), ("full", pa.bool_()), ("chip", GEOM_TYPE)]))
TILE_DDL = ("array<struct<cx:bigint,cy:bigint,full:boolean,"
            "chip:array<array<array<struct<x:double,y:double>>>>>>")


def _left_of(edges: np.ndarray, xmin: float, ymin: float, ymax: float) -> np.ndarray:
    """Edges left of the box as upright edges on its border; stretches passed twice cancel."""
    y = np.sort(np.clip(edges[:, [1, 3]], ymin, ymax), axis=1)
    y = y[y[:, 0] < y[:, 1]].ravel()
    values, count = np.unique(y, return_counts=True)
    values = values[count % 2 == 1].reshape(-1, 2)
    return np.column_stack([np.full(len(values), xmin), values[:, 0], np.full(len(values), xmin), values[:, 1]])


def _split(edges: np.ndarray, size: float):
    """Squares covered in full, and ``(square, edges)`` of those that the outline passes through."""
    i0, j0 = np.floor(edges[:, :2].min(axis=0) / size).astype(int)
    i1, j1 = np.floor(edges[:, :2].max(axis=0) / size).astype(int) + 1
    full, border = [], []
    work = [(int(i0), int(j0), int(i1), int(j1), edges, edges[:0])]
    while work:
        i0, j0, i1, j1, near, left = work.pop()
        box = (i0 * size, j0 * size, i1 * size, j1 * size)
        xlo, xhi = np.minimum(near[:, 0], near[:, 2]), np.maximum(near[:, 0], near[:, 2])
        ylo, yhi = np.minimum(near[:, 1], near[:, 3]), np.maximum(near[:, 1], near[:, 3])
        level = (yhi > box[1]) & (ylo < box[3])
        left = _left_of(np.concatenate([near[level & (xhi <= box[0])], left]), box[0], box[1], box[3])
        near = near[level & (xhi > box[0]) & (xlo < box[2])]
        if not len(near):
            if (left[:, 3] - left[:, 1]).sum() > (box[3] - box[1]) / 2:
                full += [(i, j) for i in range(i0, i1) for j in range(j0, j1)]
        elif i1 - i0 == 1 and j1 - j0 == 1:
            border.append(((i0, j0), np.concatenate([near, left])))
        else:
            im, jm = (i0 + i1 + 1) // 2, (j0 + j1 + 1) // 2
            for a, c in ((i0, im), (im, i1)):
                for b, d in ((j0, jm), (jm, j1)):
                    if a < c and b < d:
                        work.append((a, b, c, d, near, left))
    return full, border


def cut_to_squares(g: Flat, size: float):
    """``owner, square, full, chip`` of the squares of each polygon; the chip of a square covered in
    full is empty."""
    seg, _, offset = g.segments()
    xy = np.column_stack([g.x[seg], g.y[seg], g.x[seg + 1], g.y[seg + 1]])
    owner, square, edges, where = [], [], [], []
    inner_owner, inner = [], []
    for k in range(g.rows):
        mine = xy[offset[k]:offset[k + 1]]
        if not len(mine):
            continue
        full, border = _split(mine, size)
        inner += full
        inner_owner += [k] * len(full)
        for at, near in border:
            edges.append(near)
            where.append(np.full(len(near), len(owner)))
            owner.append(k)
            square.append(at)
    jobs = len(owner)
    square = np.array(square, dtype=np.int64).reshape(-1, 2)
    boxes = np.hstack([square, square + 1]) * float(size)
    row = np.concatenate(where) if jobs else np.zeros(0, dtype=np.int64)
    shapes = Edges(np.concatenate(edges) if jobs else np.zeros((0, 4)), row, np.zeros(len(row), dtype=np.int64))
    frames = Edges.boxes(boxes, np.arange(jobs), 1)
    none = Edges(np.zeros((0, 4)), row[:0], row[:0])
    clipped = difference(shapes + frames, none, kept_shapes=2)
    area = clipped.areas(jobs)
    chip = polygons(clipped, jobs)
    whole = area >= size * size * (1 - 1e-12)
    some = np.flatnonzero(area > 0)
    chip = Flat.choose([chip, Flat.empty(jobs)], whole.astype(np.int64)).take(some)
    inner = np.array(inner, dtype=np.int64).reshape(-1, 2)
    return (np.concatenate([np.array(owner, dtype=np.int64)[some], np.array(inner_owner, dtype=np.int64)]),
            np.concatenate([square[some], inner]), np.concatenate([whole[some], np.ones(len(inner), dtype=bool)]),
            Flat.concat([chip, Flat.empty(len(inner))]))


def _touched(owner, square, full, chip: Flat, size: float):
    """Also list the squares that a polygon only touches from outside, with what touches them."""
    boxes = np.hstack([square, square + 1]) * float(size)
    shape = Flat.choose([chip, Flat.boxes(boxes)], full.astype(np.int64))
    low_x, low_y, high_x, high_y = shape.bounds()
    covered = set(zip(owner[full].tolist(), map(tuple, square[full].tolist())))
    pick, at = [], []
    for dx in (-1, 0, 1):
        for dy in (-1, 0, 1):
            if not dx and not dy:
                continue
            meets = np.ones(len(owner), dtype=bool)
            if dx:
                meets &= (low_x <= boxes[:, 0]) if dx < 0 else (high_x >= boxes[:, 2])
            if dy:
                meets &= (low_y <= boxes[:, 1]) if dy < 0 else (high_y >= boxes[:, 3])
            for k in np.flatnonzero(meets).tolist():
                cell = (int(square[k, 0]) + dx, int(square[k, 1]) + dy)
                if (int(owner[k]), cell) not in covered:
                    pick.append(k)
                    at.append(cell)
    pick = np.array(pick, dtype=np.int64)
    return (np.concatenate([owner, owner[pick]]),
            np.concatenate([square, np.array(at, dtype=np.int64).reshape(-1, 2)]),
            np.concatenate([full, np.zeros(len(pick), dtype=bool)]), Flat.concat([chip, shape.take(pick)]))


def tile_batch(column: pa.Array, size: float, touched: bool) -> pa.Array:
    """Lists of ``cx, cy, full, chip``. With ``touched`` a square may be listed more than once."""
    g = flat(column)
    found = cut_to_squares(g, size)
    owner, square, full, chip = _touched(*found, size) if touched else found
    order = np.argsort(owner, kind="stable")
    values = pa.StructArray.from_arrays(
        [pa.array(square[order, 0]), pa.array(square[order, 1]), pa.array(full[order]), chip.take(order).array()],
        fields=list(TILE_TYPE.value_type))
    offsets = np.searchsorted(owner[order], np.arange(g.rows + 1))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
