"""Exact top-k against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgrid.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score double, query_id string"


def rows_of(vectors, ids=None):
    return [(i if ids is None else ids[i], v, None, 0.5, "q") for i, v in enumerate(vectors)]


def brute(rows, every, k=10):
    good = [(r[0], np.floor(1024 * np.array(r[1], np.float32).astype(float)).astype(np.int64)) for r in rows
            if r[0] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    want = set()
    for q, qv in good:
        if q % every == 0:
            scored = sorted((-int(qv @ v), c) for c, v in good if c != q and len(v) == len(qv))[:k]
            want |= {(q, rank + 1, c, -s) for rank, (s, c) in enumerate(scored)}
    return want


@pytest.mark.parametrize("block, seeds", [(3, 16), (4096, 2048)])
def test_against_all_pairs(spark, block, seeds, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(400, 12)) * rng.exponential(size=(400, 1))).astype(np.float32)
    vectors[50:120] = vectors[50]                                             # a common vector: ties
    rows = rows_of(vectors.tolist())
    rows += [(1000, None, 1, 0.0, ""), (None, vectors[0].tolist(), 1, 0.0, ""), (1100, [float("nan")] * 12, 1, 0.0, ""),
             (1200, [float("inf")] * 12, 1, 0.0, ""), (1300, [None] * 12, 1, 0.0, ""), (1400, [], 1, 0.0, ""), (1500, [1.0, 2.0], 1, 0.0, ""),
             (1501, [3.0, -2.0], 1, 0.0, ""), (1600, [0.0] * 12, 1, 0.0, "")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = topk.nearest(frame, F.col("vec_id") % 20 == 0, block=block, seeds=seeds)
    assert {tuple(r) for r in got.collect()} == brute(rows, 20)


def test_few_rows_and_none(spark):
    assert topk.searched(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = rows_of([[1.0, 0.0], [0.5, 0.5], [0.5, 0.5]], ids=[100, 7, 3])
    got = topk.searched(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {tuple(r) for r in got} == brute(rows, 100) and len(got) == 2
    assert got[0]["vec_id"] == 3 or got[0]["rank"] == 2


def test_bounds_prune_most_pairs():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 32)) * 1000
    vectors = (centres[rng.integers(0, 8, 4000)] + rng.normal(size=(4000, 32)) * 60).astype(np.int64)
    length = -(vectors.astype(float) ** 2).sum(axis=1)
    vectors = vectors[np.argsort(length)]
    block = topk.Block(np.arange(0, 4000, 100), vectors[::100], topk._rotation(vectors[:2000].astype(float), 32), 10)
    for low in range(0, 4000, 250):
        block.meet(np.arange(low, low + 250), vectors[low:low + 250])
    scores = vectors[::100] @ vectors.T
    scores[np.arange(40), np.arange(0, 4000, 100)] = np.iinfo(np.int64).min
    assert (block.best.score == np.sort(scores, axis=1)[:, ::-1][:, :10]).all()
    assert block.pairs < 0.5 * 40 * 4000
