"""Nested Arrow geometry arrays seen as flat numpy buffers, and back."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

POINT_TYPE = pa.struct([("x", pa.float64()), ("y", pa.float64())])
RING_TYPE = pa.list_(POINT_TYPE)
PART_TYPE = pa.list_(RING_TYPE)
GEOM_TYPE = pa.list_(PART_TYPE)


def counts_to_offsets(counts) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64))]).astype(np.int64)


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place of each item of lists with the given lengths."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass
class Flat:
    """Vertices of a geometry column with the offsets of rings, parts and rows."""

    x: np.ndarray
    y: np.ndarray
    ring: np.ndarray      # ring -> first vertex
    part: np.ndarray      # part -> first ring
    row: np.ndarray       # row -> first part

    @property
    def rows(self) -> int:
        return len(self.row) - 1

    @property
    def row_ring(self) -> np.ndarray:
        return self.part[self.row]

    @property
    def row_vertex(self) -> np.ndarray:
        return self.ring[self.row_ring]

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start vertex of each segment, its row, and row -> first segment."""
        starts = np.ones(len(self.x), dtype=bool)
        ends = self.ring[1:][np.diff(self.ring) > 0] - 1
        starts[ends] = False
        row_segment = np.concatenate([[0], np.cumsum(starts)])[self.row_vertex]
        return (np.flatnonzero(starts), np.repeat(np.arange(self.rows), np.diff(row_segment)),
                row_segment)

    def take(self, rows: np.ndarray) -> Flat:
        """The given rows, in the given order."""
        owner, k = ragged(np.diff(self.row)[rows])
        parts = self.row[rows][owner] + k
        owner, k = ragged(np.diff(self.part)[parts])
        rings = self.part[parts][owner] + k
        owner, k = ragged(np.diff(self.ring)[rings])
        vertices = self.ring[rings][owner] + k
        return Flat(self.x[vertices], self.y[vertices], counts_to_offsets(np.diff(self.ring)[rings]),
                    counts_to_offsets(np.diff(self.part)[parts]), counts_to_offsets(np.diff(self.row)[rows]))

    @staticmethod
    def concat(columns: list[Flat]) -> Flat:
        def joined(field):
            return counts_to_offsets(np.concatenate([np.diff(getattr(c, field)) for c in columns]))

        return Flat(np.concatenate([c.x for c in columns]), np.concatenate([c.y for c in columns]),
                    joined("ring"), joined("part"), joined("row"))

    @staticmethod
    def choose(columns: list[Flat], choice: np.ndarray) -> Flat:
        """Row by row from one of several columns of equal length."""
        return Flat.concat(columns).take(choice * len(choice) + np.arange(len(choice)))

    @staticmethod
    def empty(rows: int) -> Flat:
        nothing = np.zeros(0)
        return Flat(nothing, nothing, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64),
                    np.zeros(rows + 1, dtype=np.int64))

    @staticmethod
    def boxes(boxes: np.ndarray) -> Flat:
        """Rectangles (xmin, ymin, xmax, ymax) as one-ring polygons."""
        n = len(boxes)
        one = np.arange(n + 1)
        return Flat(boxes[:, [0, 2, 2, 0, 0]].ravel(), boxes[:, [1, 1, 3, 3, 1]].ravel(), one * 5, one, one)

    def bounds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """xmin, ymin, xmax, ymax of each row; rows must not be empty."""
        start = self.row_vertex[:-1]
        if not len(start):
            return (np.zeros(0),) * 4
        return tuple(f.reduceat(v, start) for f in (np.minimum, np.maximum) for v in (self.x, self.y))

    def array(self) -> pa.Array:
        vertices = pa.StructArray.from_arrays([pa.array(self.x), pa.array(self.y)], fields=list(POINT_TYPE))
        out = vertices
        for offsets in (self.ring, self.part, self.row):
            out = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), out)
        return out

    def rings_of(self, i: int) -> list[list[np.ndarray]]:
        """Row ``i`` as parts of rings of (n, 2) vertices."""
        return [[np.column_stack([self.x[self.ring[k]:self.ring[k + 1]],
                                  self.y[self.ring[k]:self.ring[k + 1]]])
                 for k in range(self.part[p], self.part[p + 1])]
                for p in range(self.row[i], self.row[i + 1])]


def flat(column: pa.Array) -> Flat:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()

    def level(a):
        # an empty array may come without any offset
        offsets = a.offsets.to_numpy().astype(np.int64) if len(a) else np.zeros(1, dtype=np.int64)
        return offsets - offsets[0], a.values.slice(offsets[0], offsets[-1] - offsets[0])

    row, parts = level(column)
    part, rings = level(parts)
    ring, vertices = level(rings)
    x, y = (f.to_numpy(zero_copy_only=False) for f in vertices.flatten())
    return Flat(x, y, ring, part, row)


def from_rings(rows: list[list[list[np.ndarray]]]) -> Flat:
    """Rows of parts of (n, 2) rings."""
    parts = [p for r in rows for p in r]
    rings = [k for p in parts for k in p]
    xy = np.concatenate(rings).astype(float) if rings else np.zeros((0, 2))
    return Flat(np.ascontiguousarray(xy[:, 0]), np.ascontiguousarray(xy[:, 1]),
                *(counts_to_offsets([len(v) for v in level]) for level in (rings, parts, rows)))
