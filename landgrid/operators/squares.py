"""Connected components of grid squares, united block by block up a quadtree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrid.functions.forest import roots, star_forest
from landgrid.shared import saved, shuffled

ORIGIN = 1 << 30            # added to square numbers, which so are 31 bits without a sign
FIRST = 8                   # halvings from the block of the first round to a square
STEP = 4                    # and from one round's block to the next one's
WHOLE = 31                  # one block holds all squares
ROWS_AT_ONCE = 1 << 20      # edges a task holds before it unites them


def square_code(cx: Column, cy: Column) -> Column:
    """A square as one long; its blocks are read off it by shifts."""
    x, y = cx.cast("long") + F.lit(ORIGIN), cy.cast("long") + F.lit(ORIGIN)
    known = (x >= 0) & (x < 2 * ORIGIN) & (y >= 0) & (y < 2 * ORIGIN)
    wide = F.raise_error(F.lit("squares are too small for the extent")).cast("long")
    return F.when(known | x.isNull() | y.isNull(), F.shiftleft(x, 32).bitwiseOR(y)).otherwise(wide)


def _block(code: str, level: int) -> Column:
    """The block of ``2 ** level`` squares a side that a square lies in."""
    y = F.shiftright(F.shiftleft(F.col(code), 32), 32 + level)
    return F.shiftleft(F.shiftright(F.col(code), 32 + level), 32).bitwiseOR(y)


def _solved(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Forest of whole blocks. ``v`` is -1 where ``u`` has an edge that leaves its block.

    A component hangs from its smallest square with such an edge; its others stay in the graph (``open``), and
    everything inside the block is settled."""
    inner = v >= 0
    ids, flat = np.unique(np.concatenate([u[inner], v[inner], u[~inner]]), return_inverse=True)
    k = int(inner.sum())
    parent = roots(flat[:k], flat[k:2 * k], len(ids))
    rim = np.zeros(len(ids), bool)
    rim[flat[2 * k:]] = True
    first = np.arange(len(ids))
    on_rim = np.flatnonzero(rim)[::-1]
    first[parent[on_rim]] = on_rim                      # the smallest is written last
    chosen = first[parent]
    other = np.flatnonzero(chosen != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[chosen[other]]), pa.array(ids[other]), pa.array(rim[other])],
                                      names=["u", "v", "open"])


def _united(edges: DataFrame, level: int) -> DataFrame:
    """``u, v, open``: what one round leaves of the edges inside blocks; members ``v`` under their root ``u``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, most = [], 0, ROWS_AT_ONCE
        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            rows += batch.num_rows
            if rows < most:
                continue
            block, u, v = (np.concatenate(c) for c in zip(*held))
            cut = int(np.searchsorted(block, block[-1]))            # the last block may go on
            if cut:
                yield _solved(u[:cut], v[:cut])
            last, u, v = block[-1], u[cut:], v[cut:]
            inner = v >= 0
            root, member = star_forest(u[inner], v[inner])
            marked = np.unique(u[~inner])
            u, v = np.concatenate([root, marked]), np.concatenate([member, np.full(len(marked), -1)])
            held, rows = [[np.full(len(u), last), u, v]], len(u)
            most = max(ROWS_AT_ONCE, 2 * rows)
        if rows:
            _, u, v = (np.concatenate(c) for c in zip(*held))
            yield _solved(u, v)

    def row(block, u, v):
        return F.struct(block.alias("block"), u.alias("u"), v.alias("v"))

    u, v, bu, bv, away = F.col("u"), F.col("v"), _block("u", level), _block("v", level), F.lit(-1).cast("long")
    rows = edges.select(F.explode(F.when(bu == bv, F.array(row(bu, u, v)))
                                  .otherwise(F.array(row(bu, u, away), row(bv, v, away)))).alias("row")).select("row.*")
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, "u long, v long, open boolean")


def square_components(edges: DataFrame) -> DataFrame:
    """``member, root`` of every square with edges but the roots; the root is one square of the component.

    ``edges``: ``u, v`` as :func:`square_code` gives them; order and repetition do not matter, and edges of any
    length are right, but short ones are settled early. Each round unites what lies inside a block and passes on only
    squares that have an edge across the block's rim, so the graph shrinks and the number of rounds follows the
    logarithm of the extent. A task holds the edges of a block, of which only rims are left above the first round.
    """
    plain = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u <> v").distinct()
    rest, level, settled = saved(plain), FIRST, []
    while not rest.isEmpty():
        level = min(level, WHOLE)
        across = rest.filter(_block("u", level) != _block("v", level)).withColumn("open", F.lit(True))
        done = saved(_united(rest, level).unionByName(across))
        settled.append(done.filter("not open").select(F.col("v").alias("member"), F.col("u").alias("root")))
        rest = done.filter("open").select("u", "v")
        level += STEP
    found = settled.pop() if settled else rest.select(F.col("v").alias("member"), F.col("u").alias("root"))
    while settled:
        above = found.select(F.col("member").alias("root"), F.col("root").alias("top"))
        below = settled.pop().join(shuffled(above), "root", "left").select("member", F.coalesce("top", "root").alias("root"))
        found = saved(found.unionByName(below))
    return found


def least_of_component(squares: DataFrame, edges: DataFrame, code: str, value: str, name: str) -> DataFrame:
    """``squares`` (one row per square ``code``) with the smallest ``value`` of their component as ``name``."""
    found = square_components(edges).select(F.col("member").alias(code), F.col("root").alias("_root"))
    rooted = squares.join(shuffled(found), code, "left").withColumn("_root", F.coalesce("_root", code))
    least = rooted.groupBy("_root").agg(F.min(value).alias(name))
    return rooted.join(shuffled(least), "_root").drop("_root")
