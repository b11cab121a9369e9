"""N-gram Jaccard self-join by signature trees.

Each text is the set of its distinct word shingles (``WIDTH`` words, A-Z in lower case); texts are linked when the
Jaccard similarity of their sets is at least ``SIMILARITY`` (in hundredths, so that the test is exact). The work is
spread by parts: linked sets of sizes n and m differ in at most 15/185 (n + m) shingles, so if shingles are dealt to
more parts than that by their hash, a part is the same in both. Sets with an equal part make a *group*; the number of
parts follows the size, by classes, and a set near the upper end of its class takes part in the next one, too. Unlike
texts hardly ever have a part in common, whatever passages they share.

Before the search every set is compared with the hub (smallest) of one of its groups, which joins large groups of near
copies by a star. Groups of one class of linked sets need no search. Linked sets have many parts in common, so a set in too
few other groups has no further links, and the rest falls into components that are small, or as large as a crowd of near
copies. Any two parts of a component make a block, to which its sets are sent whole: pairs are made and tested there,
and only links leave it.

A block is searched with a signature tree. A leaf is a set's token bitmap of ``BITS`` bits, an inner node the OR of its
children's with the range of their sizes; two nodes are walked together, from the roots down, as long as the sizes fit
and the largest overlap that their bitmaps allow reaches the least one that a link needs. At the leaves a second bitmap, of
bits that an odd number of shingles falls on, bounds the differences. What is left is tested exactly.

A component of over ``SHARES`` parts is searched group by group instead: groups of over ``CHUNK`` sets are divided, the nodes on
top of the parts are held against each other by a join, so a task never has more than two parts, pairs that meet in too few
groups are left out, and the others are tested in blocks of sets that share a group.

Equal sets are one node throughout, so copies are never paired. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgrid.llm import common, shingles
from landgrid.operators.graph import component_roots
from landgrid.shared import discard, saved

WIDTH = 4
SIMILARITY = 85          # hundredths
BITS = 1024              # of a bitmap
WORDS = BITS // 64
CHUNK = 2048             # sets of a group that one task holds twice at most
FANOUT = 8
PAIRS = 1 << 15          # node pairs looked at in one step
GROWTH = 1.41            # of the size classes; above 100 / SIMILARITY
ROUNDS = 2               # of stars before the walk
THICKNESS = np.uint64(63)   # bits of a part's key for its number of shingles
SHARES = 32              # parts of a component that is tested without its groups
LOAD = 1 << 21           # shingles of such a part
THINNED = 2              # times that sets in too few open groups are left out
HELD = 1 << 25           # bytes of whole blocks that a task gathers
FILTER = 1 << 23         # bits of the filters sent to all tasks
ROWS = ["block", "side", "node", "size", "spare", "label", "bitmap"]     # of the walk


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The smallest size, the number of parts and the largest number of differences of each size class."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, math.ceil(low[-1] * GROWTH)))
    low = np.array(low)
    most = (100 - SIMILARITY) * 2 * (low[1:] - 1) // (100 + SIMILARITY)
    return low, most + 1 + np.where(most > 0, most * 3 // 20 + 2, 0), most    # some more parts, as some stay thin


LOW, PARTS, MOST = _classes()
MOST_SQL = f"{100 - SIMILARITY} * (size + 100 * size div {SIMILARITY}) div {100 + SIMILARITY}"     # see _most_differences


def _most_differences(size):
    """The largest number of shingles in which a linked set can differ from one of this size."""
    return (100 - SIMILARITY) * (size + 100 * size // SIMILARITY) // (100 + SIMILARITY)


def _digest(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 63-bit hash of each set; empty sets have none of their own (0)."""
    n = np.diff(offsets)
    spread = shingles.mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    sums = np.add.reduceat(np.concatenate([spread, np.zeros(1, np.uint64)]), offsets[:-1])
    return np.where(n > 0, shingles.mixed(sums ^ n.astype(np.uint64)) >> np.uint64(1), 0).astype(np.int64)


def _bitmaps(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    out = np.zeros((n, BITS), bool)
    bit = (hashes >> np.uint64(64 - int(math.log2(BITS)))).astype(np.int64)
    out[np.repeat(np.arange(n), np.diff(offsets)), bit] = True
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


def _odd(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bitmaps of the bits that an odd number of shingles falls on: two sets' differ in no more bits than the sets do in
    shingles."""
    bit = (shingles.mixed(hashes) >> np.uint64(64 - int(math.log2(BITS)))).astype(np.int64)
    out = np.zeros((len(offsets) - 1, WORDS), np.uint64)
    for k in range(0, len(out), 1 << 10):                  # some sets at a time, as their bits are counted
        ends = offsets[k:k + (1 << 10) + 1]
        n = len(ends) - 1
        counts = np.bincount(np.repeat(np.arange(n), np.diff(ends)) * BITS + bit[ends[0]:ends[-1]], minlength=n * BITS)
        out[k:k + n] = np.packbits((counts & 1).astype(bool).reshape(n, BITS), axis=1, bitorder="little").view(np.uint64)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of numbers as a binary column."""
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _described(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, mark, size, node, bitmap`` of every row; ``mark`` is a hash of the text, ``node`` one of the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, offsets in shingles.shingle_sets(batch.column(2), WIDTH):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(offsets), pa.int64()),
                     pa.array(_digest(hashes, offsets)), _binary(_bitmaps(hashes, offsets))],
                    names=["id", "mark", "size", "node", "bitmap"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("source")).mapInArrow(
        run, f"id {kind}, mark long, size long, node long, bitmap binary")


class _Filter:
    """A set of longs as a bitmap of fixed size; it may hold more than was put in."""

    def __init__(self, values: DataFrame, column: str):
        at = F.pmod(F.col(column), F.lit(FILTER))
        words = (values.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))").alias("bit"))
                 .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())       # at most FILTER / 64 rows
        self.bits = np.zeros(FILTER // 64, np.uint64)
        self.bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        at = values.view(np.uint64) & np.uint64(FILTER - 1)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _part_keys(hashes: np.ndarray, offsets: np.ndarray, rows: np.ndarray,
               classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the parts of the sets ``rows``, dealt as in the given classes, the place in ``rows`` of each, and how many
    parts each set has that count. The last bits of a key are the part's number of shingles.

    Thin parts, of one shingle or none, get no key, as unlike texts may well have them in common. Two linked sets whose only
    equal parts are thin have as many of them as there are parts beyond the most differences of a set of that size. So a set
    with that many thin parts has keys for them, but for the last ones in one order for all sets (empty parts at its end),
    one fewer than such sets have in common: the first one in common stays.

    Sets with d differences have all but d parts in common, and at least as many keys as the larger of their counts of
    thick parts less d."""
    n = np.diff(offsets)[rows]
    parts = PARTS[classes]
    base = np.concatenate([[0], np.cumsum(parts)])
    owner = np.repeat(np.arange(len(rows)), n)
    at = np.repeat(offsets[rows], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    spread = shingles.mixed(hashes[at] ^ np.uint64(0x2545F4914F6CDD1D))
    place = base[owner] + ((spread >> np.uint64(20)) % parts[owner].astype(np.uint64)).astype(np.int64)
    sums = np.zeros(base[-1], np.uint64)
    np.add.at(sums, place, spread)
    held = np.bincount(place, minlength=base[-1])
    thick = held > 1
    owner = np.repeat(np.arange(len(rows)), parts)
    thin = parts - np.bincount(owner[thick], minlength=len(rows))
    common = parts - np.minimum(MOST[classes], _most_differences(n))
    number = np.arange(base[-1]) - base[owner]
    kept = thick.copy()
    thins = np.flatnonzero(~thick & (thin >= common)[owner])
    thins = thins[np.lexsort((number[thins], -held[thins], owner[thins]))]
    rank = np.arange(len(thins)) - np.searchsorted(owner[thins], owner[thins])
    kept[thins[rank <= (thin - common)[owner[thins]]]] = True
    keys = shingles.mixed(shingles.mixed(sums + number.astype(np.uint64)) ^ (classes[owner].astype(np.uint64) << np.uint64(48)))
    keys = (keys & ~THICKNESS) | np.minimum(held, int(THICKNESS)).astype(np.uint64)
    return keys[kept].view(np.int64), owner[kept], parts - thin


def _parts(docs: DataFrame, text: str, chosen: _Filter) -> DataFrame:
    """``key, node, size, spare``: the parts of each set, once per set and task, and how many of them count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(chosen(batch.column(0).to_numpy())))
            for _, _, hashes, offsets in shingles.shingle_sets(batch.column(1), WIDTH, limit=1 << 21):
                nodes, n = _digest(hashes, offsets), np.diff(offsets)
                fresh = [k for k, node in enumerate(nodes.tolist()) if node and node not in seen and not seen.add(node)]
                rows = np.array(fresh, np.int64)
                own = np.searchsorted(LOW, n[rows], side="right") - 1
                near = 100 * n[rows] >= SIMILARITY * LOW[own + 1]          # may be linked with sets of the next class
                rows, classes = np.concatenate([rows, rows[near]]), np.concatenate([own, own[near] + 1])
                keys, owner, spare = _part_keys(hashes, offsets, rows, classes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(nodes[rows[owner]]), pa.array(n[rows[owner]], pa.int64()), pa.array(spare[owner], pa.int64())],
                    names=["key", "node", "size", "spare"])

    return docs.select(F.xxhash64(text).alias("mark"), F.col(text).alias("source")).mapInArrow(
        run, "key long, node long, size long, spare long")


def _members(parts: DataFrame) -> DataFrame:
    """``key, node, size, spare, hub, hub_size, hub_spare`` of the sets of every group but the smallest node, the hub.

    Rows stream by in order; no group is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None                                        # key, hub, its size and spare, and the last node of the open group
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, size, spare = (c.to_numpy() for c in batch.columns)
            opens = np.concatenate([[last is None or key[0] != last[0]], key[1:] != key[:-1]])
            again = np.concatenate([[last is not None and key[0] == last[0] and node[0] == last[4]],
                                    (key[1:] == key[:-1]) & (node[1:] == node[:-1])])
            first = np.maximum.accumulate(np.where(opens, np.arange(len(key)), -1))
            inside = first >= 0
            hub = np.where(inside, node[first], last[1] if last else 0)
            hub_size = np.where(inside, size[first], last[2] if last else 0)
            hub_spare = np.where(inside, spare[first], last[3] if last else 0)
            kept = ~again & (node != hub)
            last = (key[-1], hub[-1], hub_size[-1], hub_spare[-1], node[-1])
            yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (key, node, size, spare, hub, hub_size, hub_spare)],
                                             names=["key", "node", "size", "spare", "hub", "hub_size", "hub_spare"])

    return parts.repartition("key").sortWithinPartitions("key", "node").mapInArrow(
        run, "key long, node long, size long, spare long, hub long, hub_size long, hub_spare long")


def _fits(a, b):
    """Whether sets of these sizes can be linked at all."""
    return (100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b))


# -- the walk --------------------------------------------------------------------------------------

def _popcount(rows: np.ndarray) -> np.ndarray:
    return np.bitwise_count(rows).sum(axis=-1, dtype=np.int64)


class Forest:
    """Signature trees over consecutive rows, one per tree number."""

    def __init__(self, tree: np.ndarray, size: np.ndarray, label: np.ndarray, bitmaps: np.ndarray):
        excess = size - _popcount(bitmaps)                  # shingles that share a bit with another one
        self.levels = [(bitmaps, size, size, label, label, excess)]
        self.children = []                                  # first child of each node, with the end
        while True:
            bounds = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
            first = np.repeat(bounds, np.diff(np.concatenate([bounds, [len(tree)]])))
            if len(bounds) == len(tree):
                self.roots = tree
                break
            starts = np.flatnonzero((np.arange(len(tree)) - first) % FANOUT == 0)
            maps, low, high, least, most, excess = self.levels[-1]
            self.levels.append((np.bitwise_or.reduceat(maps, starts, axis=0), np.minimum.reduceat(low, starts),
                                np.maximum.reduceat(high, starts), np.minimum.reduceat(least, starts),
                                np.maximum.reduceat(most, starts), np.maximum.reduceat(excess, starts)))
            self.children.append(np.concatenate([starts, [len(tree)]]))
            tree = tree[starts]

    def _open(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which node pairs may hold a link between different classes."""
        maps, low, high, least, most, excess = self.levels[level]
        fits = (100 * high[a] >= SIMILARITY * low[b]) & (100 * high[b] >= SIMILARITY * low[a])
        fits &= ~((least[a] == most[a]) & (least[b] == most[b]) & (least[a] == least[b]))
        out = np.flatnonzero(fits)
        a, b = a[out], b[out]
        overlap = _popcount(maps[a] & maps[b]) + np.minimum(excess[a], excess[b])
        overlap = np.minimum(overlap, np.minimum(high[a], high[b]))
        return out[(100 + SIMILARITY) * overlap >= SIMILARITY * (low[a] + low[b])]

    def pairs(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows under the root pairs ``a, b`` that pass every test; of a root with itself each pair once."""
        stack = [(len(self.levels) - 1, a, b)]
        while stack:
            level, a, b = stack.pop()
            if len(a) > PAIRS:
                stack += [(level, a[k:k + PAIRS], b[k:k + PAIRS]) for k in range(0, len(a), PAIRS)]
                continue
            if level == 0:
                apart = a != b
                a, b = a[apart], b[apart]
            kept = self._open(level, a, b)
            a, b = a[kept], b[kept]
            if level == 0:
                yield a, b
            elif len(a):
                below = self.children[level - 1]
                na, nb = below[a + 1] - below[a], below[b + 1] - below[b]
                total = na * nb
                pair = np.repeat(np.arange(len(a)), total)
                step = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
                x, y = below[a[pair]] + step // nb[pair], below[b[pair]] + step % nb[pair]
                once = (a[pair] != b[pair]) | (x <= y)
                stack.append((level - 1, x[once], y[once]))


def _by_block(solve):
    """``solve`` over batches in the order of their first column, ``block``: it gets whole blocks, many small ones at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows_held, bytes_held = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows_held, bytes_held = rows_held + batch.num_rows, bytes_held + batch.get_total_buffer_size()
            if rows_held >= 8 * CHUNK or bytes_held >= HELD:       # whole blocks only: the last one may go on
                block = batch.column(0).to_numpy()
                last = np.searchsorted(block, block[-1])
                if last or any(b.column(0)[0].as_py() != block[-1] for b in held):
                    whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    cut = int(np.searchsorted(whole.column(0).to_numpy(), block[-1]))
                    yield solve([whole.slice(0, cut)])
                    rest = pa.Table.from_batches([whole.slice(cut)])
                    held, rows_held, bytes_held = rest.to_batches(), rest.num_rows, rest.nbytes
        if held:
            yield solve(held)

    return run


def _walked(rows: DataFrame) -> DataFrame:
    """``u, v, hits, need, block`` of the pairs that the walk leaves: in how many groups they meet here, in how many linked
    sets meet, and one of the blocks. ``rows``: ``block, side, node, size, spare, label, bitmap``; a block is one
    part of a group with itself (side 0 only) or with another part, and has at most two parts' rows."""
    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        block, side, node, size, spare, label = (table.column(c).to_numpy() for c in ROWS[:-1])
        maps = np.frombuffer(b"".join(table.column("bitmap").to_pylist()), np.uint64).reshape(-1, WORDS)
        number = np.cumsum(np.concatenate([[0], block[1:] != block[:-1]]))
        tree = number * 2 + side
        # alike bitmaps side by side: by size classes, then by the bitmap
        order = np.lexsort((maps[:, 1], maps[:, 0], np.log2(size.astype(float)).astype(int), tree))
        tree, node, size, label, maps = tree[order], node[order], size[order], label[order], maps[order]
        block, spare = block[order], spare[order]
        forest = Forest(tree, size, label, maps)
        roots = forest.roots
        paired = np.flatnonzero(roots % 2 == 1)
        alone = np.setdiff1d(np.arange(len(roots)), np.concatenate([paired, paired - 1]))
        found = list(forest.pairs(np.concatenate([paired - 1, alone]), np.concatenate([paired, alone])))
        a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        b = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        a, b = a[node[a] != node[b]], b[node[a] != node[b]]
        u, v = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
        need = np.maximum(spare[a], spare[b]) - (100 - SIMILARITY) * (size[a] + size[b]) // (100 + SIMILARITY)
        order = np.lexsort((block[a], v, u))
        u, v, need, block = u[order], v[order], need[order], block[a][order]
        starts = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])][:len(u)])
        hits = np.diff(np.r_[starts, len(u)])
        least = np.minimum.reduceat(need, starts) if len(starts) else need
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (u[starts], v[starts], hits, least, block[starts])],
                                          names=["u", "v", "hits", "need", "block"])

    return (rows.select(ROWS).repartition("block").sortWithinPartitions("block")
            .mapInArrow(_by_block(solve), "u long, v long, hits long, need long, block long"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Parts of groups in pairs. ``rows``: ``key, node, size, spare, label, bitmap``.

    A group of over ``CHUNK`` sets is divided by the hash of the set, apart from the sets of its most frequent class:
    those make nodes of one class, which need not be walked with each other. The top nodes' sizes and bitmaps decide
    which parts meet.
    """
    group = ["key"]
    classes = rows.groupBy(*group, "label").count()
    sizes = classes.groupBy(*group).agg(F.sum("count").alias("sets"), F.max_by("label", "count").alias("most"))
    small = rows.join(sizes.filter(F.col("sets") <= CHUNK).select(*group), group, "left_semi")
    alone = small.select(F.xxhash64(*group).alias("block"), F.lit(0).alias("side"), *ROWS[2:])

    parts = rows.join(sizes.filter(F.col("sets") > CHUNK), group).withColumn(
        "part", F.struct((F.col("label") == F.col("most")).alias("common"),
                         F.pmod(F.xxhash64("node", F.lit(5)), F.ceil(F.col("sets") / F.lit(CHUNK // 2))).alias("salt")))
    words = [F.bit_or(_word("bitmap", k)).alias(f"w{k}") for k in range(WORDS)]
    tops = parts.groupBy(*group, "part").agg(
        F.min("size").alias("low"), F.max("size").alias("high"), F.min("label").alias("least"), F.max("label").alias("last"),
        F.max(F.col("size") - _set_bits("bitmap")).alias("excess"), *words)
    tops = saved(tops)
    two = tops.select(*group, *(F.col(c).alias(f"o_{c}") for c in tops.columns if c not in group))
    shared = sum((F.bit_count(F.col(f"w{k}").bitwiseAND(F.col(f"o_w{k}"))) for k in range(WORDS)), F.lit(0))
    overlap = F.least(shared + F.least("excess", "o_excess"), F.col("high"), F.col("o_high"))
    pairs = (tops.join(two, group).filter(F.col("part") <= F.col("o_part"))
             .filter((100 * F.col("high") >= SIMILARITY * F.col("o_low")) & (100 * F.col("o_high") >= SIMILARITY * F.col("low")))
             .filter(~((F.col("least") == F.col("last")) & (F.col("o_least") == F.col("o_last")) & (F.col("least") == F.col("o_least"))))
             .filter((100 + SIMILARITY) * overlap >= SIMILARITY * (F.col("low") + F.col("o_low")))
             .select(*group, "part", "o_part", F.xxhash64(*group, "part", "o_part").alias("block")))
    left = pairs.select(*group, "part", "block", F.lit(0).alias("side"))
    right = pairs.filter(F.col("part") != F.col("o_part")).select(*group, F.col("o_part").alias("part"), "block", F.lit(1).alias("side"))
    divided = parts.join(left.unionByName(right), [*group, "part"]).select(alone.columns)
    return alone.unionByName(divided)


def _word(column: str, k: int):
    """Eight bytes of a bitmap as a long."""
    return F.conv(F.hex(F.substring(column, 8 * k + 1, 8)), 16, -10).cast("long")


def _set_bits(column: str):
    return sum((F.bit_count(_word(column, k)) for k in range(WORDS)), F.lit(0))


# -- exact tests -----------------------------------------------------------------------------------

def _sets(docs: DataFrame, text: str, first: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, body``: the sets of the given nodes as hashes, from one text each (``first``: ``node, mark``)."""
    wanted = saved(first.join(nodes, "node", "left_semi"))
    chosen = _Filter(wanted, "mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            marks = batch.column(0).to_numpy()
            fresh = chosen(marks)
            for k in np.flatnonzero(fresh).tolist():
                fresh[k] = marks[k] not in seen
                seen.add(int(marks[k]))
            batch = batch.filter(pa.array(fresh))
            for i, j, hashes, offsets in shingles.shingle_sets(batch.column(1), WIDTH):
                bodies = [hashes[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(_digest(hashes, offsets)), pa.array(bodies, pa.binary())],
                    names=["mark", "node", "body"])

    found = docs.select(F.xxhash64(text).alias("mark"), F.col(text).alias("source")).mapInArrow(
        run, "mark long, node long, body binary")
    out = saved(found.join(wanted, ["mark", "node"], "left_semi").dropDuplicates(["node"]).select("node", "body"))
    discard(wanted)
    return out


def _wide(hashes: np.ndarray) -> bytes:
    """A bitmap of 8 to 16 bits a shingle; a wider one folds to a narrower one by ORing its parts."""
    width = 1 << max(6, int(8 * len(hashes) - 1).bit_length())
    out = np.zeros(width, bool)
    out[(hashes & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def _possible(a: bytes, b: bytes, n: int, m: int) -> bool:
    """Whether two sets' wide bitmaps and sizes allow a link."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    if len(y) > len(x):
        n, m = (n, m) if len(a) < len(b) else (m, n)
        y = np.bitwise_or.reduce(y.reshape(-1, len(x)), axis=0)
    overlap = int(_popcount(x & y)) + min(n - int(_popcount(x)), m - int(_popcount(y)))
    return (100 + SIMILARITY) * min(overlap, n, m) >= SIMILARITY * (n + m)


def _similar(a: bytes, b: bytes, n: int, m: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.concatenate([x, y])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= SIMILARITY * (len(x) + len(y) - shared)


def _near(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The pairs ``u, v, hits, block`` whose sizes and bitmaps allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, WORDS) for c in ("map_u", "map_v"))
            n, m = (batch.column(c).to_numpy() for c in ("size_u", "size_v"))
            overlap = np.minimum(_popcount(a & b) + np.minimum(n - _popcount(a), m - _popcount(b)), np.minimum(n, m))
            yield batch.filter(pa.array((100 + SIMILARITY) * overlap >= SIMILARITY * (n + m))).select(["u", "v", "hits", "block"])

    u = bitmaps.select(F.col("node").alias("u"), F.col("size").alias("size_u"), F.col("bitmap").alias("map_u"))
    v = bitmaps.select(F.col("node").alias("v"), F.col("size").alias("size_v"), F.col("bitmap").alias("map_v"))
    return pairs.join(u, "u").join(v, "v").select("u", "v", "hits", "block", "size_u", "size_v", "map_u", "map_v").mapInArrow(
        run, "u long, v long, hits long, block long")


def _ends(pairs: DataFrame, *by: str) -> DataFrame:
    """The distinct sets, as ``node``, of pairs ``u, v``, by the columns ``by``."""
    return pairs.select(*by, F.col("u").alias("node")).unionByName(pairs.select(*by, F.col("v").alias("node"))).distinct()


def _linked(pairs: DataFrame, docs: DataFrame, text: str, first: DataFrame) -> DataFrame:
    """Links ``u, v`` among the pairs that join the same sets as all links among them do. ``pairs``
    (``u, v, hits, block``) is written; a block has at most two parts of a group, and each of its sets once, however many
    pairs it is in. Pairs with most groups in common come first, and sets that links of the block have joined are not
    tested any more."""
    sets = _sets(docs, text, first, _ends(pairs))
    nothing = F.lit(None).cast("long")
    bodies = _ends(pairs, "block").join(sets, "node").select(
        "block", F.col("node").alias("u"), nothing.alias("v"), nothing.alias("hits"), "body")
    rows = bodies.unionByName(pairs.select("block", "u", "v", "hits", F.lit(None).cast("binary").alias("body")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, above = None, {}, {}                  # sets of the open block, which come before its pairs

        def root(node: int) -> int:
            while above[node] != node:
                above[node] = node = above[above[node]]
            return node

        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for k, (at, u, v, body) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                if at != block:
                    block, held, above = at, {}, {}
                if v is None:
                    held[u], above[u] = (body, _wide(np.frombuffer(body, np.uint64)), len(body) // 8), u
                elif root(u) != root(v):
                    (a, wide_a, n), (b, wide_b, m) = held[u], held[v]
                    good[k] = _possible(wide_a, wide_b, n, m) and _similar(a, b, n, m)
                    if good[k]:
                        above[root(u)] = root(v)
            yield batch.select(["u", "v"]).filter(pa.array(good))

    out = saved(rows.repartition("block").sortWithinPartitions("block", F.col("v").isNotNull(), F.desc("hits"))
                .select("block", "u", "v", "body").mapInArrow(run, "u long, v long"))
    discard(sets)
    return out


# -- components ------------------------------------------------------------------------------------

def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, size, spare, label``: the groups with sets of several classes, without sets that are in fewer of them
    than linked sets of different classes have in common."""
    hubs = members.select("key", F.col("hub").alias("node"), F.col("hub_size").alias("size"), F.col("hub_spare").alias("spare"))
    rows = (members.select("key", "node", "size", "spare").unionByName(hubs.distinct())
            .join(roots, "node", "left").withColumn("label", F.coalesce("label", "node")))
    for _ in range(THINNED):
        rows = saved(_mixed(rows))
        enough = (rows.groupBy("node").agg(F.count("*").alias("hits"), F.min(F.col("spare") - F.expr(MOST_SQL)).alias("need"))
                  .filter("hits >= need").select("node"))
        rows = rows.join(enough, "node", "left_semi")
    return saved(rows)


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows ``key, label, ..`` of groups with sets of several classes."""
    keys = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return rows.join(keys.select("key"), "key", "left_semi")


def _components(rows: DataFrame) -> DataFrame:
    """``node, label, root, parts`` of the sets of open groups: the component that shared groups and classes make, and into
    how many parts it is divided.

    Of the groups of a set, in one order for all sets, the last ones are left out, one fewer than a linked set has in
    common with it: the first one in common stays. Parts of few shingles, which unlike sets may have in common, come last."""
    order = Window.partitionBy("node").orderBy(F.desc(F.col("key").bitwiseAND(F.lit(int(THICKNESS)))), "key")
    whole = Window.partitionBy("node")
    first = (rows.withColumns({"place": F.row_number().over(order), "held": F.count("*").over(whole),
                               "least": F.greatest(F.min(F.col("spare") - F.expr(MOST_SQL)).over(whole), F.lit(1))})
             .filter("place <= held - least + 1"))
    rows = saved(_mixed(first.select("key", "node", "size", "label")))
    low = rows.groupBy("key").agg(F.min("label").alias("u"))
    edges = rows.select("key", F.col("label").alias("v")).distinct().join(low, "key").select("u", "v")
    roots = component_roots(edges).select(F.col("member").alias("label"), "root")
    sets = saved(rows.groupBy("node").agg(F.min("label").alias("label"), F.min("size").alias("size"))
                 .join(roots, "label", "left").withColumn("root", F.coalesce("root", "label")))
    parts = F.ceil(F.greatest(F.count("*") / F.lit(CHUNK), F.sum("size") / F.lit(LOAD)))
    return saved(sets.join(sets.groupBy("root").agg(parts.alias("parts")), "root").select("node", "label", "root", "parts"))


def _links_inside(sets: DataFrame, docs: DataFrame, text: str, first: DataFrame) -> DataFrame:
    """Links ``u, v`` that join the same sets as all links between sets (``node, label, root, parts``) of a component do,
    if those of one label are joined.

    Any two parts of a component make a block, which has its sets whole: pairs are walked and tested there, and none
    but links leaves it, fewer than the block has sets."""
    bodies = _sets(docs, text, first, sets.select("node"))
    part = F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts"))
    placed = (sets.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
              .select(F.xxhash64("root", F.least("part", "other"), F.greatest("part", "other")).alias("block"),
                      (F.col("part") > F.col("other")).cast("int").alias("side"), "node", "label"))

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        block, side, node, label = (table.column(c).to_numpy() for c in ("block", "side", "node", "label"))
        body = table.column("body").to_pylist()
        size = np.array([len(b) // 8 for b in body], np.int64)
        hashes, offsets = np.frombuffer(b"".join(body), np.uint64), np.concatenate([[0], np.cumsum(size)])
        maps, odd = _bitmaps(hashes, offsets), _odd(hashes, offsets)
        number = np.cumsum(np.concatenate([[0], block[1:] != block[:-1]]))
        tree = number * 2 + side
        order = np.lexsort((maps[:, 1], maps[:, 0], np.log2(size.astype(float)).astype(int), tree))
        tree, node, size, label, maps, odd = (c[order] for c in (tree, node, size, label, maps, odd))
        forest = Forest(tree, size, label, maps)
        roots = forest.roots
        second = np.flatnonzero(roots % 2 == 1)
        paired = second[np.isin(roots[second] - 1, roots)]          # a part may be empty
        alone = np.setdiff1d(np.arange(len(roots)), np.concatenate([second, paired - 1]))
        above = {x: x for x in label.tolist()}                      # classes; links of other blocks do no harm
        wide: dict[int, bytes] = {}

        def root(x: int) -> int:
            while above[x] != x:
                above[x] = x = above[above[x]]
            return x

        def held_at(k: int) -> tuple[bytes, int]:
            if k not in wide:
                wide[k] = _wide(np.frombuffer(body[order[k]], np.uint64))
            return wide[k], int(size[k])

        u, v = [], []
        for a, b in forest.pairs(np.concatenate([paired - 1, alone]), np.concatenate([paired, alone])):
            differ = _popcount(odd[a] ^ odd[b])
            near = np.flatnonzero((100 + SIMILARITY) * differ <= (100 - SIMILARITY) * (size[a] + size[b]))
            near = near[np.argsort(differ[near], kind="stable")]
            for x, y in zip(a[near].tolist(), b[near].tolist()):
                one, two = root(int(label[x])), root(int(label[y]))
                if one == two:
                    continue
                (wide_x, n), (wide_y, m) = held_at(x), held_at(y)
                if _possible(wide_x, wide_y, n, m) and _similar(body[order[x]], body[order[y]], n, m):
                    above[one] = two
                    u.append(int(node[x]))
                    v.append(int(node[y]))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    out = saved(placed.join(bodies, "node").select("block", "side", "node", "label", "body")
                .repartition("block").sortWithinPartitions("block").mapInArrow(_by_block(solve), "u long, v long"))
    discard(bodies)
    return out


# -- the join --------------------------------------------------------------------------------------

def _apart(pairs: DataFrame, roots: DataFrame, u: str, v: str) -> DataFrame:
    """The pairs of sets of different classes."""
    for side in (u, v):
        label = roots.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
        pairs = pairs.join(label, side, "left").withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
    return pairs.filter(F.col(f"label_{u}") != F.col(f"label_{v}")).drop(f"label_{u}", f"label_{v}")


def _placed(pairs: DataFrame) -> DataFrame:
    """Pairs ``u, v, hits`` with their ``block``: that of the component they are in, so that a set is in one block, or in
    those of its part if the component has over ``CHUNK`` sets."""
    roots = saved(component_roots(pairs))
    many = (roots.groupBy("root").count().filter(F.col("count") >= CHUNK)
            .select("root", F.ceil(F.col("count") / F.lit(CHUNK // 2)).alias("parts")))
    at = pairs.join(roots.withColumnRenamed("member", "u"), "u", "left").withColumn("root", F.coalesce("root", "u"))
    parts = F.coalesce("parts", F.lit(1))
    salts = (F.pmod(F.xxhash64(c, F.lit(5)), parts) for c in ("u", "v"))
    return saved(at.join(many, "root", "left").select("u", "v", "hits", F.xxhash64("root", *salts).alias("block")))


def set_links(docs: DataFrame, text: str, described: DataFrame) -> DataFrame:
    """``u, v``: links between different sets that join the same sets as all links do."""
    rows = described.filter("node <> 0")
    sets = saved(rows.groupBy("node").agg(F.min("mark").alias("mark"), F.min("size").alias("size"), F.any_value("bitmap").alias("bitmap")))
    first, bitmaps = sets.select("node", "mark"), sets.select("node", "size", "bitmap")
    members = saved(_members(_parts(docs, text, _Filter(sets, "mark"))))
    differences = F.floor((100 - SIMILARITY) * (F.col("size") + F.col("hub_size")) / F.lit(100 + SIMILARITY))
    held = saved(members.filter(_fits(F.col("size"), F.col("hub_size")))
                 .withColumn("need", F.greatest("spare", "hub_spare") - differences)
                 .groupBy(F.col("hub").alias("u"), F.col("node").alias("v"))
                 .agg(F.count("*").alias("hits"), F.min("need").alias("need")))
    # a hub's sets in blocks of bounded size
    part = F.pmod(F.xxhash64("v", F.lit(5)), F.ceil(F.col("count") / F.lit(CHUNK)))
    spokes = saved(held.join(held.groupBy("u").count(), "u").select("u", "v", "hits", "need", F.xxhash64("u", part).alias("block")))
    discard(held)
    tested, links, roots = None, None, None
    for _ in range(ROUNDS):
        # of the hubs of other classes that a set has not been held against and that alone bring the groups that linked sets
        # meet in, the one it has most groups in common with; all others are left to the walk
        apart = spokes if roots is None else _apart(spokes, roots, "u", "v").join(tested, ["u", "v"], "left_anti")
        best = saved(apart.filter("hits >= need").groupBy("v").agg(F.max_by(F.struct("u", "hits", "block"), "hits").alias("hub"))
                     .select("v", "hub.*"))
        found = _linked(saved(_near(best, bitmaps)), docs, text, first)
        best = best.select("u", "v")
        tested = best if tested is None else tested.unionByName(best)
        links = found if links is None else links.unionByName(found)
        roots = saved(component_roots(links)).select(F.col("member").alias("node"), F.col("root").alias("label"))
        if found.isEmpty():
            break

    discard(spokes)
    open_ = _open(members, roots)
    discard(members)
    sets = _components(open_)
    links = links.unionByName(_links_inside(sets.filter(F.col("parts") <= SHARES), docs, text, first))
    # larger components are walked group by group; pairs that meet in fewer groups than linked sets do are left out
    large = sets.filter(F.col("parts") > SHARES).select("node")
    if large.isEmpty():
        return links
    rows = saved(open_.join(large, "node", "left_semi").join(bitmaps.select("node", "bitmap"), "node"))
    discard(open_)
    met = _walked(_blocks(rows))
    pairs = saved(met.groupBy("u", "v").agg(F.sum("hits").alias("hits"), F.min("need").alias("need"))
                  .filter("hits >= need").select("u", "v", "hits"))
    discard(rows)
    return links.unionByName(_linked(_placed(pairs), docs, text, first))


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id`` of every row: the size of its set and the smallest id reachable by links.

    Null and empty texts and those without a word have no set (0), are linked with nothing and are components of their
    own. Rows of one id with different texts are different nodes; a null id is never the smallest, and a component of
    null ids has none. Empty table: no rows. Other columns are not read.
    """
    described = saved(_described(docs, key, text))
    rows = described.filter("size is not null")
    roots = component_roots(set_links(docs, text, described)).select(F.col("member").alias("node"), "root")
    classes = saved(rows.filter("node <> 0").groupBy("node").agg(F.min("id").alias("least")).join(roots, "node", "left")
                    .withColumn("root", F.coalesce("root", "node")))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    found = classes.select("node", "root").join(names, "root").select("node", "component_id")
    linked = rows.filter("node <> 0").select("id", "size", "node").join(found, "node")
    alone = rows.filter("node = 0").select("id", "size", F.col("id").alias("component_id"))
    out = linked.select("id", "size", "component_id").unionByName(alone)
    return out.select(F.col("id").alias(key), F.col("size").alias("n_shingles"), "component_id")


SQL = """
with recursive texts as materialized (select row_number() over () rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\\x20\\x09-\\x0D]+') w from documents),
    words as (select rid, unnest(w) word, generate_subscripts(w, 1) pos from texts where len(w) >= 4),
    runs as (select rid, word || ' ' || lead(word, 1) over s || ' ' || lead(word, 2) over s || ' ' || lead(word, 3) over s token
        from words window s as (partition by rid order by pos)),
    found as (select distinct rid, token from runs where token is not null
        union all select rid, array_to_string(w, ' ') from texts where len(w) between 1 and 3),
    tokens as materialized (select rid, token, count(*) over (partition by rid) n from found),
    sizes as (select rid, any_value(n) n from tokens group by 1),
    pairs as (select a.rid u, b.rid v, any_value(a.n) n, any_value(b.n) m, count(*) shared
        from tokens a join tokens b on a.token = b.token and a.rid <> b.rid
             and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) group by 1, 2),
    links as (select u, v from pairs where 100 * shared >= 85 * (n + m - shared)),
    cc(id, comp) using key (id) as (select rid id, rid comp from texts union
        (select e.v, min(c.comp) from cc c join links e on e.u = c.id join recurring.cc o on o.id = e.v
         where c.comp < o.comp group by e.v)),
    least_id as (select cc.comp, min(texts.doc_id) component_id from cc join texts on texts.rid = cc.id group by 1)
select texts.doc_id, coalesce(sizes.n, 0) n_shingles, least_id.component_id
from texts join cc on cc.id = texts.rid join least_id on least_id.comp = cc.comp left join sizes on sizes.rid = texts.rid
"""
