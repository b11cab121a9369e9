"""SimHash near-duplicates with a hierarchical index in Gray order.

Fingerprints that differ in at most two bits agree on at least one of three disjoint masks. The
patterns under these masks are the top nodes of the index and decide which task a fingerprint goes
to. A top node with more than ``CROWDED`` fingerprints is divided by the same argument over the bits
its mask leaves open, so a node never holds an unbounded group. Inside a task the fingerprints are
sorted by Gray rank, which puts those that share long bit patterns side by side. Sixteen neighbours
form a node with the mask and pattern of the bits they share, sixteen nodes the next node, and so on.
The search walks pairs of nodes from the top and adds up the differences of the bits that become
fixed on the way; a pair of groups is dropped as soon as the sum exceeds the distance. Links leave
the task as a forest, never as all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgrid.functions.forest import star_forest
from landgrid.llm import common
from landgrid.operators.graph import component_roots
from landgrid.shared import saved

SHINGLE = 3
DISTANCE = 2
SEED = 42
CROWDED = 2048           # fingerprints of a top node beyond which it is divided
DEPTH = 4                # divisions; thereafter a node has at most 13 open bits, or 8192 fingerprints
FAN = 16                 # children of a node
RUN = 1 << 16            # fingerprints indexed at a time
PAIRS = 2048             # node pairs opened at a time
SPLIT_BYTES = 1 << 20    # bytes of a text split into words at a time

_ALL = (1 << 64) - 1
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


# -- fingerprints ----------------------------------------------------------------------------------

def _word_runs(data: bytes) -> Iterator[list[bytes]]:
    low = 0
    while low < len(data):
        end = _BLANK.search(data, low + SPLIT_BYTES)
        end = end.start() if end else len(data)
        yield data[low:end].split()       # bytes.split() cuts at exactly 0x20 and 0x09-0x0D
        low = end


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits; a bit is set if more than half of the shingle hashes have it. No words: zero."""
    counts, n, held, some = np.zeros(64, np.int64), 0, [], False
    hashed = xxhash.xxh64_intdigest

    def add(values):
        nonlocal n
        h = np.array(values, np.uint64)
        for k in range(0, len(h), 4096):
            bits = np.unpackbits(h[k:k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts[:] += bits.sum(axis=0, dtype=np.uint32)
        n += len(h)

    for words in _word_runs((text or "").encode().lower()):     # bytes.lower() maps A-Z only
        words = held + words
        if len(words) >= shingle:
            add([hashed(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(shingle)))])
            some = True
        held = words[len(words) - shingle + 1:] if len(words) >= shingle else words
    if not some and held:
        add([hashed(b" ".join(held), SEED)])
    if not n:
        return 0
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprinted(docs: DataFrame, keep: list[str], name: str, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns and the fingerprint as a (signed) long."""
    source = common.fresh(docs, "source_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t, shingle) for t in batch.column(len(keep)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(marks.view(np.int64))],
                                             names=[*keep, name])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, F.col(text).alias(source)).mapInArrow(run, f"{kinds}`{name}` bigint")


# -- the index inside a task -----------------------------------------------------------------------

def gray_rank(marks: np.ndarray) -> np.ndarray:
    """The place of each bit pattern in Gray order."""
    rank = marks.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Index:
    """Levels of nodes over fingerprints sorted by group and Gray rank; level 0 are the fingerprints."""

    def __init__(self, groups: np.ndarray, marks: np.ndarray):
        order = np.lexsort((gray_rank(marks), groups))
        self.order = order
        fixed, pattern = np.full(len(marks), _ALL, np.uint64), marks[order]
        low = high = groups[order]
        self.levels = [(fixed, pattern, low, high)]
        while len(pattern) > 1:
            head = np.arange(0, len(pattern), FAN)
            same = ~(np.bitwise_or.reduceat(pattern, head) ^ np.bitwise_and.reduceat(pattern, head))
            fixed = np.bitwise_and.reduceat(fixed, head) & same
            pattern = pattern[head] & fixed
            low, high = low[head], high[np.minimum(head + FAN, len(high)) - 1]
            self.levels.append((fixed, pattern, low, high))

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of fingerprints of one group at most ``distance`` bits apart, in bounded portions."""
        none = np.zeros(1, np.int64)
        stack = [(len(self.levels) - 1, none, none, none.astype(np.uint8), none.astype(np.uint64))]
        step = np.arange(FAN)
        while stack:
            level, a, b, sums, shared = stack.pop()
            if len(a) > PAIRS:
                stack.append((level, a[PAIRS:], b[PAIRS:], sums[PAIRS:], shared[PAIRS:]))
                a, b, sums, shared = a[:PAIRS], b[:PAIRS], sums[:PAIRS], shared[:PAIRS]
            if level == 0:
                apart = a != b
                yield self.order[a[apart]], self.order[b[apart]]
                continue
            fixed, pattern, low, high = self.levels[level - 1]
            left = (a[:, None] * FAN + step)[:, :, None]
            right = (b[:, None] * FAN + step)[:, None, :]
            good = (left < len(fixed)) & (right < len(fixed)) & (left <= right)
            pair, i, j = np.nonzero(good)
            left, right = left[pair, i, 0], right[pair, 0, j]
            meet = (low[left] <= high[right]) & (low[right] <= high[left])
            pair, left, right = pair[meet], left[meet], right[meet]
            both = fixed[left] & fixed[right]
            total = sums[pair] + np.bitwise_count((pattern[left] ^ pattern[right]) & both & ~shared[pair])
            near = total <= distance
            if near.any():
                stack.append((level - 1, left[near], right[near], total[near].astype(np.uint8), both[near]))


def _forest(groups: np.ndarray, marks: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    u, v = [], []
    for a, b in Index(groups, marks.view(np.uint64)).links(distance):
        u.append(marks[a])
        v.append(marks[b])
        if sum(map(len, u)) > 1 << 18:
            r, m = star_forest(np.concatenate(u), np.concatenate(v))
            u, v = [r], [m]
    if not u:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return star_forest(np.concatenate(u), np.concatenate(v))


# -- the index across tasks ------------------------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _divided(mask: int, distance: int) -> list[int]:
    """Masks that fix, beside ``mask``, one of ``distance + 1`` parts of the bits it leaves open."""
    free = [b for b in range(64) if not mask >> b & 1]
    parts = np.array_split(np.array(free, int), distance + 1)
    return [mask | sum(1 << int(b) for b in part) for part in parts]


def links(marks: DataFrame, name: str, distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """A forest ``(u, v)`` over the distinct fingerprints in ``name`` with the components of all links."""
    nodes = marks.select(F.col(name).alias("mark"), F.lit(0).cast("long").alias("mask"))
    masks, settled = [0], None
    for level in range(DEPTH):
        below = {m: _divided(m, distance) for m in masks}
        children = F.create_map(*(x for m, parts in below.items() for x in (
            F.lit(_signed(m)), F.array(*(F.lit(_signed(p)).cast("long") for p in parts)))))
        nodes = nodes.select("mark", F.explode(children[F.col("mask")]).alias("mask")) \
                     .withColumn("pattern", F.col("mark").bitwiseAND(F.col("mask")))
        sizes = nodes.groupBy("mask", "pattern").agg(F.count("*").alias("held")).filter("held > 1")
        nodes = saved(nodes.join(sizes, ["mask", "pattern"]))
        masks = sorted({p for parts in below.values() for p in parts})
        last = level == DEPTH - 1
        done = nodes if last else nodes.filter(F.col("held") <= crowded)
        settled = done if settled is None else settled.unionByName(done)
        if last:
            break
        nodes = nodes.filter(F.col("held") > crowded)
        if nodes.isEmpty():
            break
        nodes = nodes.select("mark", "mask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(mask, pattern, mark):
            groups = np.cumsum(np.r_[0, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
            u, v = _forest(groups, mark, distance)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        held: list[tuple] = []
        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("mask", "pattern", "mark")))
            if sum(len(h[0]) for h in held) >= RUN:
                mask, pattern, mark = (np.concatenate(x) for x in zip(*held))
                change = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1]))
                cut = int(change[-1]) + 1 if len(change) else 0
                if cut:
                    yield out(mask[:cut], pattern[:cut], mark[:cut])
                held = [(mask[cut:], pattern[cut:], mark[cut:])]
        if held and sum(len(h[0]) for h in held):
            yield out(*(np.concatenate(x) for x in zip(*held)))

    return (settled.select("mask", "pattern", "mark").repartition("mask", "pattern")
            .sortWithinPartitions("mask", "pattern").mapInArrow(run, "u long, v long"))


def components(marks: DataFrame, name: str, distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """``(name, root)`` for every distinct fingerprint that is not the smallest of its component."""
    # written, so that a task runs one Python worker, that of the index or that of the components, not both at a time
    found = saved(links(marks, name, distance, crowded))
    return component_roots(found).select(F.col("member").alias(name), F.col("root"))


def classes(rows: DataFrame, mark: str, key: str, distance: int, crowded: int = CROWDED) -> DataFrame:
    """Per distinct fingerprint: ``smallest`` key with it, ``root`` fingerprint, ``component`` (smallest key reached)."""
    own = saved(rows.groupBy(mark).agg(F.min(key).alias("smallest")))
    roots = components(own, mark, distance, crowded)
    own = own.join(roots, mark, "left").withColumn("root", F.coalesce("root", F.col(mark)))
    lowest = own.groupBy("root").agg(F.min("smallest").alias("component"))
    return saved(own.join(lowest, "root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per document.

    Empty table: no rows. Repeated rows: one result each. Null or blank texts have fingerprint zero.
    A null id is never the smallest; a component of null ids alone has component null.
    """
    marks = saved(fingerprinted(docs, ["doc_id"], "mark", shingle=shingle))
    found = classes(marks, "mark", "doc_id", distance).select("mark", F.col("component").alias("component_id"))
    return marks.join(found, "mark").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each component: that with the smallest id (of repeated ids, one row).

    All columns stay. Of a component of null ids alone one row stays. Empty table: empty.
    """
    mark, place, same = (common.fresh(docs, c) for c in ("mark", "place", "same"))
    rows = saved(fingerprinted(docs, docs.columns, mark, shingle=shingle))
    found = classes(rows.select(F.col(mark).alias("mark"), "doc_id"), "mark", "doc_id", distance)
    # of a component's fingerprints, the first that has its smallest key
    chosen = (found.filter(F.col("smallest").eqNullSafe(F.col("component"))).groupBy("root")
              .agg(F.min("mark").alias(mark), F.first("component").alias("component")))
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    chosen = chosen.select(mark, F.coalesce(F.col("component").cast("string"), F.lit("null")).alias(same))
    once = Window.partitionBy(mark, same).orderBy(F.xxhash64("text"))
    return (rows.withColumn(same, text_id).join(chosen, [mark, same])
            .withColumn(place, F.row_number().over(once)).filter(F.col(place) == 1).select(docs.columns))
