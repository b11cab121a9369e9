"""Union-find on arrays."""

from __future__ import annotations

import numpy as np


def roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest node of each node's component, for nodes 0..n-1 and edges u-v."""
    parent = np.arange(n)
    while len(u):
        u, v = parent[u], parent[v]
        apart = u != v
        u, v = u[apart], v[apart]
        np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
    return parent


def star_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as ``(root, member)`` edges with the smallest id as the root."""
    ids, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = roots(flat[:len(u)], flat[len(u):], len(ids))
    member = np.flatnonzero(parent != np.arange(len(ids)))
    return ids[parent[member]], ids[member]
