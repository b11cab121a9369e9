"""Secret scan by grammar inference.

Base matches of three fixed kinds give labelled credentials. For each kind, and for ordinary long
words (candidates without a digit), the prefix tree of all distinct values is generalised: states whose outgoing and final
frequencies are statistically compatible (Hoeffding bound) are merged, which leaves an automaton of the kind's format.
Prefixes are counted by Spark and opened in rounds, the most frequent first, ``NODES`` at a time: the values run through the
automaton found so far, and where one leaves it, the rest of it hangs there as part of a prefix tree. Rounds go on until every
value ends inside the automaton, so no prefix is left out and no more than ``NODES`` are on the driver at once. The last run
gives the probabilities, and all ordinary words are run through both for the threshold. Then every candidate, a run of at
least ``SHORTEST`` credential characters that no base match covers whole, is scored by its likelihood under each format
against that of ordinary words. Candidates over the threshold are added as kind ``format``; ordinary words touch no base match.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrid.llm import common
from landgrid.shared import saved

# fixed values: kinds in their order, patterns and shortest lengths
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_SHORTEST, ACCESS_SHORTEST, HEX_SHORTEST = 12, 18, 16

ADDED = "format"
SHORTEST = 16            # characters of a candidate
NODES = 1 << 15          # prefixes that a round opens
ROWS = 1 << 18           # prefixes a task holds before it counts them
ALPHA = 0.05             # level of the compatibility test
USUAL = 0.99             # share of the ordinary words that stay below the threshold
MARGIN = 0.5             # bits per character by which the threshold lies above them

_BYTES = np.arange(256)
_HEX = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 102))
_CREDENTIAL = np.isin(_BYTES, [ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"])
_SYMBOL = np.cumsum(_CREDENTIAL | (_BYTES == ord("."))) - 1      # place of a character among the symbols
SYMBOLS = int(_SYMBOL[-1]) + 1


# -- grammar inference -----------------------------------------------------------------------------

@dataclass
class Automaton:
    """``step[state, symbol]`` and the log2 probabilities of each step and of ending."""
    step: np.ndarray
    cost: np.ndarray
    end: np.ndarray


def infer(values: list[str], alpha: float = ALPHA) -> Automaton:
    """The automaton of the prefix tree of ``values``."""
    passed, ended, next_state = [0], [0], [{}]
    for value in values:
        state = 0
        passed[0] += 1
        for symbol in _SYMBOL[np.frombuffer(value.encode("ascii", "ignore"), np.uint8)].tolist():
            if symbol not in next_state[state]:
                next_state[state][symbol] = len(passed)
                passed.append(0)
                ended.append(0)
                next_state.append({})
            state = next_state[state][symbol]
            passed[state] += 1
        ended[state] += 1
    flow = [{s: passed[t] for s, t in out.items()} for out in next_state]      # how often each step was taken
    return weighed(*merged(passed, ended, flow, next_state, alpha))


def merged(passed: list[int], ended: list[int], flow: list[dict], next_state: list[dict], alpha: float = ALPHA,
           known: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge compatible states, nearest to the root first: the first ``known`` are an automaton, from which prefix trees hang.

    Returns the steps (-1 where there is no next state), how often each was taken, and how often each state ended."""
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    settled = list(range(known))
    place = {r: r for r in settled}
    counts = np.zeros((max(64, 2 * known), SYMBOLS + 1))           # of the settled states, as one table
    blue = []                                                      # steps from settled states to others, by place and symbol

    def differ(x, n, y, m):
        return abs(x / n - y / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(a, b):
        open_ = [(a, b)]
        while open_:
            a, b = open_.pop()
            n, m = passed[a], passed[b]
            if not n or not m:
                continue
            if differ(ended[a], n, ended[b], m):
                return False
            for s in next_state[a].keys() | next_state[b].keys() | flow[a].keys() | flow[b].keys():
                if differ(flow[a].get(s, 0), n, flow[b].get(s, 0), m):
                    return False
            open_ += [(next_state[a][s], next_state[b][s]) for s in next_state[a].keys() & next_state[b].keys()]
        return True

    def fold(a, b):
        open_ = [(a, b)]
        while open_:
            a, b = open_.pop()
            passed[a] += passed[b]
            ended[a] += ended[b]
            for s, n in flow[b].items():
                flow[a][s] = flow[a].get(s, 0) + n
            for s, t in next_state[b].items():
                if s in next_state[a]:
                    open_.append((next_state[a][s], t))
                else:
                    next_state[a][s] = t
                    if a in place:
                        heapq.heappush(blue, (place[a], s))
            if a in place:
                count(a)

    def count(r):
        row = counts[place[r]]
        for s, n in flow[r].items():
            row[s] = n
        row[SYMBOLS] = ended[r]

    def likely(b):
        """Settled states whose own frequencies are compatible with those of ``b``, in their order."""
        k, n = len(settled), passed[b]
        mine = np.zeros(SYMBOLS + 1)
        mine[list(flow[b])] = list(flow[b].values())
        mine[SYMBOLS] = ended[b]
        m = np.maximum(1, [passed[r] for r in settled])
        gap = np.abs(counts[:k] / m[:, None] - mine / n).max(axis=1)
        return (settled[r] for r in np.flatnonzero(gap <= bound * (1 / np.sqrt(m) + 1 / math.sqrt(n)) * (1 + 1e-9)).tolist())

    def settle(r):
        nonlocal counts
        place[r] = len(settled)
        settled.append(r)
        if len(settled) > len(counts):
            counts = np.concatenate([counts, np.zeros_like(counts)])

    for r in settled:
        count(r)
    blue += [(r, s) for r in settled for s, t in next_state[r].items() if t not in place]
    heapq.heapify(blue)
    while blue:
        at, symbol = heapq.heappop(blue)
        parent = settled[at]
        state = next_state[parent][symbol]
        target = next((r for r in likely(state) if compatible(r, state)), None)
        if target is None:
            settle(state)
            count(state)
            for s in next_state[state]:
                heapq.heappush(blue, (place[state], s))
        else:
            next_state[parent][symbol] = target
            fold(target, state)
    step, taken = np.full((len(settled), SYMBOLS), -1, np.int64), np.zeros((len(settled), SYMBOLS), np.int64)
    for k, r in enumerate(settled):
        for s, n in flow[r].items():
            taken[k, s] = n
        for s, t in next_state[r].items():
            step[k, s] = place[t]
    return step, taken, np.array([ended[r] for r in settled], np.int64)


def weighed(step: np.ndarray, taken: np.ndarray, ended: np.ndarray) -> Automaton:
    """An automaton whose probabilities follow from how often each step was taken and each state ended; other steps lead to the root."""
    share = 1 / (SYMBOLS + 1)
    total = taken.sum(axis=1) + ended + 1
    return Automaton(np.maximum(step, 0), np.log2((taken + share) / total[:, None]), np.log2((ended + share) / total))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of longs."""
    h = (a.astype(np.uint64) ^ (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))).astype(np.int64)


def walk(step: np.ndarray, symbols: np.ndarray, edges: np.ndarray, seed: int,
         counts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Run strings that lie one behind another through ``step``, and count the steps and ends (last column) in ``counts``.

    A string that comes to a step without a next state leaves the automaton. What follows is told by its prefixes:
    ``node, parent, state, symbol, depth, ended`` for each, where ``node`` is a hash and ``state`` is where the string left."""
    sizes = np.diff(edges)
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order]
    state, left, node = np.zeros(len(sizes), np.int64), np.full(len(sizes), -1, np.int64), np.zeros(len(sizes), np.int64)
    counts[0, -1] += int((sizes == 0).sum())
    held, rows = [], 0
    for k in range(int(falling[0]) if len(falling) else 0):
        going = order[:np.searchsorted(-falling, -k, side="left")]        # strings of over k characters
        s, last = symbols[edges[going] + k], sizes[going] == k + 1
        inside = left[going] < 0
        here, by, over = going[inside], s[inside], last[inside]
        np.add.at(counts, (state[here], by), 1)
        to = step[state[here], by]
        np.add.at(counts, (to[over & (to >= 0)], SYMBOLS), 1)
        out = to < 0
        state[here[~out]] = to[~out]
        left[here[out]] = k
        outside = left[going] >= 0
        there, by, over = going[outside], s[outside], last[outside]
        above = np.where(left[there] == k, _mixed(np.full(len(there), seed), state[there]), node[there])
        node[there] = _mixed(above, by)
        held.append((node[there], above, state[there], by, k - left[there], over.astype(np.int64)))
        rows += len(there)
        if rows >= ROWS:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, rows = [], 0
    if rows:
        yield tuple(np.concatenate(c) for c in zip(*held))


def likelihood(automaton: Automaton, symbols: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """log2 probability of each string; strings lie one behind another and begin at ``edges``."""
    sizes = np.diff(edges)
    order = np.argsort(-sizes, kind="stable")
    state, total = np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
    falling = sizes[order]
    for k in range(int(falling[0]) if len(falling) else 0):
        going = order[:np.searchsorted(-falling, -k, side="left")]        # strings of over k characters
        s = symbols[edges[going] + k]
        total[going] += automaton.cost[state[going], s]
        state[going] = automaton.step[state[going], s]
    return total + automaton.end[state]


@dataclass
class Grammar:
    formats: dict[str, Automaton]
    ordinary: Automaton
    threshold: float

    def scores(self, values: list[str]) -> np.ndarray:
        """Bits per character by which the likeliest format beats ordinary words."""
        if not values or not self.formats:
            return np.full(len(values), -np.inf)
        data, edges = common.utf8(pa.array(values))
        symbols, sizes = _SYMBOL[data], np.maximum(1, np.diff(edges))
        best = np.max([likelihood(a, symbols, edges) for a in self.formats.values()], axis=0)
        return (best - likelihood(self.ordinary, symbols, edges)) / sizes


def learn(labelled: dict[str, list[str]], ordinary: list[str]) -> Grammar:
    """A format for each kind with values; ``USUAL`` of the ordinary words stay below the threshold."""
    formats = {k: infer(v) for k, v in labelled.items() if v}
    grammar = Grammar(formats, infer(ordinary), 0.0)
    usual = float(np.quantile(grammar.scores(ordinary), USUAL)) if ordinary and formats else 0.0
    grammar.threshold = MARGIN + max(0.0, usual)
    return grammar


# -- scanning --------------------------------------------------------------------------------------

def _runs(inside: np.ndarray, cuts: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of true of at least ``shortest`` bytes that don't go across ``cuts``."""
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[cuts[cuts < len(inside)]] |= inside[cuts[cuts < len(inside)]]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    at = cuts[(cuts > 0) & (cuts <= len(inside))] - 1
    stop[at] |= inside[at]
    start, stop = np.flatnonzero(start), np.flatnonzero(stop) + 1
    long = stop - start >= shortest
    return start[long], stop[long]


def scan(data: np.ndarray, offsets: np.ndarray) -> tuple[list[list[tuple]], list[list[tuple]]]:
    """Per text the base matches ``(kind, start, end, value)`` and candidates ``(start, end, value)``."""
    texts = len(offsets) - 1
    base: list[list[tuple]] = [[] for _ in range(texts)]
    candidates: list[list[tuple]] = [[] for _ in range(texts)]
    for first, last in common.blocks(offsets):
        low, end = int(offsets[first]), int(offsets[last])
        if end == low:
            continue
        block, edges = data[low:end], offsets[first:last + 1] - low
        raw = block.tobytes()
        folded = raw.lower()
        before = np.zeros(len(block) + 1, np.int32)                # code points before each byte
        np.cumsum((block & 0xC0) != 0x80, out=before[1:])
        row_of = lambda at: int(np.searchsorted(edges, at, side="right")) - 1

        def put(kind, a, b, value_from):
            row = row_of(a)
            value = raw[value_from:b].decode()
            shift = int(before[edges[row]])
            base[first + row].append((kind, int(before[a]) - shift, int(before[b]) - shift, value))

        rows = set()
        for word in WORDS:
            at = folded.find(word)
            while at >= 0:
                row = row_of(at)
                rows.add(row)
                at = folded.find(word, int(edges[row + 1]))        # one in a text is enough to look closer
        for row in sorted(rows):
            for m in ASSIGN.finditer(folded, int(edges[row]), int(edges[row + 1])):
                if m.end(2) - m.start(2) >= ASSIGN_SHORTEST:
                    put(0, m.start(), m.end(), m.start(2))
        at = raw.find(b"AKIA")
        while at >= 0:
            row = row_of(at)
            for m in ACCESS.finditer(raw, int(edges[row]), int(edges[row + 1])):
                if m.end() - m.start() >= ACCESS_SHORTEST:
                    put(1, m.start(), m.end(), m.start())
            at = raw.find(b"AKIA", int(edges[row + 1]))
        for a, b in zip(*_runs(_HEX[block], edges, HEX_SHORTEST)):
            put(2, int(a), int(b), int(a))
        for a, b in zip(*_runs(_CREDENTIAL[block], edges, SHORTEST)):
            row = row_of(a)
            shift = int(before[edges[row]])
            candidates[first + row].append((int(before[a]) - shift, int(before[b]) - shift, raw[a:b].decode()))
    return base, candidates


_BASE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
_CANDIDATE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("apart", pa.bool_())]))


def matched(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``id``, ``base`` and ``candidates`` of every text, without candidates that a base match covers whole; ``apart`` tells
    those that touch none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = scan(*common.utf8(batch.column(1)))
            for row, taken in enumerate(base):
                base[row] = sorted(taken, key=lambda m: (m[1], m[0]))
                starts = [m[1] for m in base[row]]
                reach = np.maximum.accumulate([0, *(m[2] for m in base[row])])
                upto, before = (np.searchsorted(starts, [c[k] for c in found[row]], side) for k, side in ((0, "right"), (1, "left")))
                found[row] = [(*c, bool(reach[b] <= c[0])) for c, a, b in zip(found[row], upto, before) if reach[a] < c[1]]
            fields = [("kind", "start", "end", "value"), ("start", "end", "value", "apart")]
            arrays = [pa.array([[dict(zip(names, m)) for m in row] for row in rows], kind)
                      for rows, names, kind in ((base, fields[0], _BASE), (found, fields[1], _CANDIDATE))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", "base", "candidates"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), F.col(text).alias("source")).mapInArrow(
        run, f"id {kind}, base array<struct<kind: int, start: bigint, end: bigint, value: string>>, "
             "candidates array<struct<start: bigint, end: bigint, value: string, apart: boolean>>")


_WALKED = {"kind": pa.int32(), "node": pa.int64(), "parent": pa.int64(), "state": pa.int64(), "symbol": pa.int64(), "depth": pa.int64(),
           "n": pa.int64(), "ended": pa.int64()}


def _walked(values: DataFrame, steps: dict[int, np.ndarray]) -> DataFrame:
    """What :func:`walk` gives for ``values`` (``kind, value``), counted by task: ``n`` values have a prefix ``node``, and rows
    without a node tell how often a ``state`` of the kind's automaton took ``symbol``, or ended (``SYMBOLS``)."""
    def rows(kind, **columns):
        columns["kind"] = np.full(len(columns["n"]), kind, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(len(columns["n"]), t)
                                           for c, t in _WALKED.items()], names=list(_WALKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {kind: np.zeros((len(step), SYMBOLS + 1), np.int64) for kind, step in steps.items()}
        for batch in batches:
            kinds = batch.column(0).to_numpy()
            for kind in np.unique(kinds).tolist():
                data, edges = common.utf8(batch.column(1).filter(pa.array(kinds == kind)))
                for found in walk(steps[kind], _SYMBOL[data], edges, kind, counts[kind]):
                    node, first, copy = np.unique(found[0], return_index=True, return_inverse=True)
                    yield rows(kind, node=node, n=np.bincount(copy), ended=np.bincount(copy, found[5]).astype(np.int64),
                               **{c: found[k][first] for c, k in (("parent", 1), ("state", 2), ("symbol", 3), ("depth", 4))})
        for kind, taken in counts.items():
            state, symbol = np.nonzero(taken)
            yield rows(kind, state=state, symbol=symbol, n=taken[state, symbol])

    kinds = {pa.int32(): "int", pa.int64(): "long"}
    return values.select("kind", "value").mapInArrow(run, ", ".join(f"{c} {kinds[t]}" for c, t in _WALKED.items()))


def _opened(found: DataFrame) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The ``NODES`` most frequent prefixes of ``_walked``, none before its parent, and the steps that lead on from them."""
    nodes = saved(found.filter("node is not null").groupBy("kind", "node").agg(
        *(F.min(c).alias(c) for c in ("parent", "state", "symbol", "depth")), *(F.sum(c).alias(c) for c in ("n", "ended"))))
    chosen = saved(nodes.orderBy(F.desc("n"), "depth", "kind", "node").limit(NODES))
    below = nodes.filter("depth > 0").join(F.broadcast(chosen.select("kind", F.col("node").alias("parent"))), ["kind", "parent"], "left_semi")
    return tuple({c: table[c].to_numpy() for c in table.column_names} for table in (
        chosen.orderBy(F.desc("n"), "depth", "kind", "node").toArrow(), below.select("kind", "node", "parent", "symbol", "n").toArrow()))


def _grown(step: np.ndarray, counts: np.ndarray, nodes: dict[str, np.ndarray], below: dict[str, np.ndarray]) -> np.ndarray:
    """The steps of an automaton once the opened prefixes that hang from it are merged."""
    known = len(step)
    place = {node: known + k for k, node in enumerate(nodes["node"].tolist())}
    flow = [{int(s): int(row[s]) for s in np.flatnonzero(row[:-1])} for row in counts] + [{} for _ in place]
    next_state = [{int(s): int(row[s]) for s in np.flatnonzero(row >= 0)} for row in step] + [{} for _ in place]
    passed, ended = counts.sum(axis=1).tolist() + nodes["n"].tolist(), counts[:, -1].tolist() + nodes["ended"].tolist()
    roots = nodes["depth"] == 0
    for node, state, symbol in zip(*(nodes[c][roots].tolist() for c in ("node", "state", "symbol"))):
        next_state[state][symbol] = place[node]
    for node, parent, symbol, n in zip(*(below[c].tolist() for c in ("node", "parent", "symbol", "n"))):
        flow[place[parent]][symbol] = n
        if node in place:
            next_state[place[parent]][symbol] = place[node]
    return merged(passed, ended, flow, next_state, known=known)[0]


def _trees(values: DataFrame) -> dict[int, Automaton]:
    """An automaton a kind from all prefixes of ``values`` (``kind, value``, distinct), opened in rounds; each value passes its
    kind's once for the probabilities. To the driver go ``NODES`` prefixes at a time, with their next characters."""
    steps = {r["kind"]: np.full((1, SYMBOLS), -1, np.int64) for r in values.select("kind").distinct().collect()}
    while True:
        found = saved(_walked(values, steps))
        counts = {kind: np.zeros((len(step), SYMBOLS + 1), np.int64) for kind, step in steps.items()}
        for r in found.filter("node is null").groupBy("kind", "state", "symbol").agg(F.sum("n").alias("n")).collect():
            counts[r["kind"]][r["state"], r["symbol"]] = r["n"]
        nodes, below = _opened(found)
        if not len(nodes["node"]):
            return {kind: weighed(step, counts[kind][:, :-1], counts[kind][:, -1]) for kind, step in steps.items()}
        for kind in np.unique(nodes["kind"]).tolist():
            of = [{c: v[part["kind"] == kind] for c, v in part.items()} for part in (nodes, below)]
            steps[kind] = _grown(steps[kind], counts[kind], *of)


def _usual(words: DataFrame, grammar: Grammar) -> float:
    """The score that ``USUAL`` of all ``words`` stay below, from a histogram in steps of a thousandth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.rint(grammar.scores(batch.column(0).to_pylist()) * 1000).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    rows = words.select("value").mapInArrow(run, "at long").groupBy("at").count().orderBy("at").collect()
    if not rows:
        return 0.0
    score, upto = np.array([r["at"] for r in rows]) / 1000, np.cumsum([r["count"] for r in rows])
    rank = (upto[-1] - 1) * USUAL
    low, high = (score[np.searchsorted(upto, k, side="right")] for k in (math.floor(rank), math.ceil(rank)))
    return float(low + (high - low) * (rank - math.floor(rank)))


def learned(found: DataFrame) -> Grammar:
    """Formats from the base matches of all rows of ``matched``, every distinct value once, whatever its length."""
    values = found.select(F.explode("base").alias("m")).select("m.kind", "m.value")
    words = found.select(F.explode(F.filter("candidates", lambda c: c["apart"])).alias("m"))
    words = words.select(F.lit(len(KINDS)).alias("kind"), "m.value").filter(~F.col("value").rlike("[0-9]"))
    values = saved(values.unionByName(words).distinct())
    automata = _trees(values)
    ordinary = automata.pop(len(KINDS), None)
    formats = {name: automata[k] for k, name in enumerate(KINDS) if k in automata}
    grammar = Grammar(formats, ordinary or infer([]), 0.0)
    usual = _usual(values.filter(F.col("kind") == len(KINDS)), grammar) if ordinary and formats else 0.0
    grammar.threshold = MARGIN + max(0.0, usual)
    return grammar


def scanned(found: DataFrame, grammar: Grammar, key: str) -> DataFrame:
    """``key`` and ``spans``: base and added spans with kind, start, end and, for added ones, the score."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, candidates = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            scores = grammar.scores([c["value"] for row in candidates for c in row])
            at, out = 0, []
            for matches, row in zip(base, candidates):
                spans = [(m["start"], m["kind"], m["end"], None) for m in matches]
                for c in row:
                    if scores[at] >= grammar.threshold:
                        spans.append((c["start"], len(KINDS), c["end"], float(scores[at])))
                    at += 1
                out.append([{"kind": (*KINDS, ADDED)[k], "start": a, "end": b, "score": s} for a, k, b, s in sorted(spans, key=lambda x: x[:2])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["id", "spans"])

    dtype = found.schema["id"].dataType.simpleString()
    return found.select("id", "base", "candidates").mapInArrow(
        run, f"id {dtype}, spans array<struct<kind: string, start: bigint, end: bigint, score: double>>").withColumnRenamed("id", key)


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base and added spans of every text, the formats learned from these texts."""
    found = saved(matched(docs, key, text))
    return scanned(found, learned(found), key)


def digested(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of every document.

    Empty table: no rows. Repeated rows: one result each. Null or empty text: no spans. Nothing to
    learn from: no added spans. Spans that begin at one place are in the order of the kinds.
    """
    rows = secrets(docs.select("doc_id", "text"))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != ADDED)
    return rows.select("doc_id", *(count(k) for k in KINDS),
                       F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
