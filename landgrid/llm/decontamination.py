"""Benchmark decontamination by template canonicalisation.

Texts are turned into templates: lower-case words, with numbers, names and units replaced by typed
placeholders whose values are kept aside as slots. A second template keeps names as words, so that a copy
in other letter case, where names can't be told, is found all the same. Windows of ``WINDOW`` template words are hashed and
joined with the benchmark's windows. Matches of one document and item are taken by stretches of the
document, whose length follows the item's (every second stretch shifted by half, so that all matches
within half a stretch are in one); a stretch leaks the item if it has a share of at least ``SIMILARITY``
of the item's windows in an alignment, wherever words are inserted or dropped:  an order in which places rise on both sides, whose slots are
consistent: each value of the item stands for one value in the document and the other way round. Equal values are a copy, others a re-parameterised question.

The benchmark is held against all documents through a bitmap of its windows, whose size is fixed, so
that only windows that may match leave a task; the joins are ordinary ones. A document is first held against
an item's rarest windows only, as many as no leak can do without (``_opening``); all windows are fetched for
the stretches that have one of them. So a phrase that many items share, or a table of numbers, opens no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgrid.llm import common, names
from landgrid.shared import saved

WINDOW = 5               # template words of a window
SIMILARITY = 0.8
SLACK = 64               # words inserted in a leak may be as many as the item has windows, and so many
COSTS = (4.0, 0.5)       # matches that a change of the lag must bring: as many as a change costs windows, then any
BITS = 22                # the bitmap has 2 ** BITS bits, half a megabyte

#: units, as they follow a number
UNITS = frozenset("""
mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec second seconds min minute minutes h hr hour hours
day days week weeks month months year years mph kmh kph hz khz mhz ghz kb mb gb tb w kw v a j kj cal kcal
meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters
litre litres mile miles foot feet inch inches pound pounds ounce ounces dollar dollars euro euros cent cents
percent degree degrees celsius fahrenheit
""".split())

NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
LONGEST = 64             # bytes; a longer run of letters or digits counts as several words

# Texts are cut on their bytes. Letters are ASCII letters and all longer characters but Latin-1 signs
# (lead byte C2), general punctuation (E2 80, E2 81) and currency signs (E2 82).
_BYTES = np.arange(256)
_LETTER = (_BYTES >= 128) | ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_JOINT = np.isin(_BYTES, [ord(c) for c in ".,:/"])
_STOP = np.isin(_BYTES, [ord(c) for c in ".!?\n"])
_POWERS = np.cumprod(np.r_[np.uint64(1), np.full(LONGEST - 1, 0x100000001B3, np.uint64)])
END, WORD, DIGITS, SIGN = 0, 1, 2, 3


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of texts, the same in lower case, and where each text begins; lengths never change."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    data, offsets = common.utf8(column)
    low, other = common.utf8(pc.utf8_lower(column))
    if not np.array_equal(offsets, other):           # characters whose lower case is longer or shorter stay
        def same(c):
            return c.lower() if len(c.lower().encode()) == len(c.encode()) else c
        low, _ = common.utf8(pa.array(["".join(map(same, t)) for t in column.to_pylist()], pa.large_string()))
    return data, low, offsets


def _cut(data: np.ndarray, low: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens of some texts: start, end, kind, whether capitalised, hash. None goes over an edge."""
    n = len(data)
    if not n:
        return (*(np.zeros(0, np.int64) for _ in range(2)), np.zeros(0, np.uint8), np.zeros(0, bool), np.zeros(0, np.uint64))
    fresh = np.zeros(n + 1, bool)
    fresh[edges] = True
    opens, closes = fresh[:-1], fresh[1:]

    def shifted(flags):
        return np.r_[False, flags[:-1]] & ~opens, np.r_[flags[1:], False] & ~closes

    after = np.r_[low[1:], np.uint8(0)]
    letter, digit = _LETTER[low], _DIGIT[low]
    long_sign = (low == 0xE2) & (after >= 0x80) & (after <= 0x82)
    strange = np.flatnonzero(long_sign)
    c2 = np.flatnonzero(low == 0xC2)
    for at, size in ((strange, 3), (c2, 2)):
        for k in range(size):
            letter[np.minimum(at + k, n - 1)] = False
    sign = np.isin(low, [ord("%"), ord("$")])
    sign[c2] = np.isin(after[c2], [0xA3, 0xA5, 0xB0])                      # pound, yen, degree
    sign[strange] = after[strange] == 0x82
    before, behind = shifted(letter)
    letter |= (low == 39) & before & behind                                # an apostrophe inside a word
    before, behind = shifted(digit)
    digit |= _JOINT[low] & before & behind                                 # a separator inside a number
    stop = _STOP[low] & ~digit
    kind = np.where(letter, WORD, np.where(digit, DIGITS, 255)).astype(np.uint8)
    run = kind != 255
    first = run & (opens | (kind != np.r_[np.uint8(254), kind[:-1]]))
    at = np.flatnonzero(run)
    begin = np.flatnonzero(first)
    place = at - np.repeat(begin, np.diff(np.r_[np.searchsorted(at, begin), len(at)]))
    within = place % LONGEST
    head = np.flatnonzero(within == 0)
    start = at[head]
    folded = low.copy()                                                    # what upper-case letters don't tell apart
    sharp = np.flatnonzero((low == 0xC3) & (after == 0x9F))                # sharp s, as ss
    folded[sharp] = folded[np.minimum(sharp + 1, n - 1)] = 115
    folded[np.minimum(np.flatnonzero((low == 0xCF) & (after == 0x82)) + 1, n - 1)] = 0x83      # final sigma
    mixed = np.add.reduceat((folded[at].astype(np.uint64) + np.uint64(1)) * _POWERS[within], head) if len(head) else np.zeros(0, np.uint64)
    end = start + np.diff(np.r_[head, len(at)])
    size = 1 + (low[start] >= 0xC0) + (low[start] >= 0xE0) + (low[start] >= 0xF0)      # bytes of the first character
    changed = np.r_[0, np.cumsum(data != low)]
    inner = np.minimum(start + size, end)
    capital = (changed[inner] > changed[start]) & (changed[end] == changed[inner]) & (end > inner)
    single = np.flatnonzero(sign | stop)
    starts = np.concatenate([start, single])
    order = np.argsort(starts, kind="stable")
    kinds = np.concatenate([kind[start], np.where(sign[single], SIGN, END).astype(np.uint8)])
    width = np.where(low[single] == 0xE2, 3, np.where(low[single] == 0xC2, 2, 1))
    return (starts[order], np.concatenate([end, single + width])[order], kinds[order],
            np.concatenate([capital, np.zeros(len(single), bool)])[order],
            np.concatenate([_stirred(mixed), np.zeros(len(single), np.uint64)])[order])


def _stirred(mixed: np.ndarray) -> np.ndarray:
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def _hash_of(word: str) -> int:
    low = np.frombuffer(word.encode(), np.uint8).astype(np.uint64)
    return int(_stirred(((low + np.uint64(1)) * _POWERS[:len(low)]).sum(keepdims=True))[0])


_UNIT_HASHES = np.sort(np.array([_hash_of(u) for u in UNITS], np.uint64))
_GIVEN_HASHES = np.sort(np.array([_hash_of(n.lower().replace("ς", "σ")) for group in names.GIVEN.values() for n in group], np.uint64))
_PLACE = {kind: np.uint64(_hash_of(kind)) for kind in (NUMBER, NAME, UNIT)}


@dataclass
class Template:
    """Template words of some texts: hash, place in the bytes, whether a placeholder, the text's row, and
    whether a line begins there."""
    marks: np.ndarray
    start: np.ndarray
    end: np.ndarray
    held: np.ndarray
    row: np.ndarray
    line: np.ndarray


def _openers(marks: np.ndarray, row: np.ndarray, asked: np.ndarray, inside: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Which of the capitalised words that open a sentence are names: known given names, and words that
    their text has capitalised inside sentences at least as often as in small letters."""
    keys = _stirred(marks ^ (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    out = np.zeros(len(marks), bool)
    at = np.flatnonzero(asked)
    out[at] = np.isin(marks[at], _GIVEN_HASHES)
    table = np.intersect1d(keys[at], keys[inside])
    if len(table):
        def counts(flags):
            found = np.searchsorted(table, keys[flags])
            found = found[table[np.minimum(found, len(table) - 1)] == keys[flags]]
            return np.bincount(found, minlength=len(table))

        table_kept = table[counts(inside) >= counts(word)]
        out[at] |= np.isin(keys[at], table_kept)
    return out


def templates(data: np.ndarray, low: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[Template, Template]]:
    """Templates of texts with names as placeholders and as words, some texts at a time; a text is never
    divided between two.

    A number is digits with separators; a unit is a sign, or a unit word behind a number; a name is a
    run of capitalised words (one capital, then small letters) inside a sentence, or of two and more, or
    one that opens a sentence and is known to be a name (``_openers``).
    """
    for first, last in common.blocks(offsets):
        begin, end = int(offsets[first]), int(offsets[last])
        parts = []
        while begin < end:
            stop = end
            if end - begin > common.BLOCK:                        # a long text is cut behind a blank
                blanks = np.flatnonzero(np.isin(low[begin:begin + common.BLOCK], [10, 32]))
                stop = begin + (int(blanks[-1]) + 1 if len(blanks) else common.BLOCK)
            edges = np.clip(offsets[first:last + 1] - begin, 0, stop - begin)
            found = _cut(data[begin:stop], low[begin:stop], edges)
            parts.append((found[0] + begin, found[1] + begin, *found[2:]))
            begin = stop
        if not parts:
            continue
        start, stop, kind, capital, marks = (np.concatenate(c) for c in zip(*parts))
        row = np.searchsorted(offsets, start, side="right") - 1
        opens = np.r_[True, (row[1:] != row[:-1]) | (kind[:-1] == END)] if len(kind) else np.zeros(0, bool)
        kept = np.flatnonzero(kind != END)
        start, stop, kind, capital, marks, row, opens = (c[kept] for c in (start, stop, kind, capital, marks, row, opens))
        if not len(kept):
            continue
        same = np.r_[False, row[1:] == row[:-1]]
        at = start - int(offsets[first])                                   # lines that end before a word
        breaks = np.cumsum(low[int(offsets[first]):int(offsets[last])] == 10)[at]
        line = ~same | np.r_[True, breaks[1:] > breaks[:-1]]
        number = kind == DIGITS
        behind = np.flatnonzero(np.r_[False, number[:-1]] & same & (kind == WORD))
        unit = kind == SIGN
        unit[behind] = np.isin(marks[behind], _UNIT_HASHES)
        capital = capital & (kind == WORD) & ~unit
        inside = capital & ~opens
        name = inside | capital & np.r_[inside[1:], False]                 # a sentence may begin with a full name
        name |= _openers(marks, row, capital & opens & ~name, inside, (kind == WORD) & ~capital)
        marks = np.where(number, _PLACE[NUMBER], np.where(unit, _PLACE[UNIT], marks))
        plain = Template(marks, start, stop, number | unit, row, line)
        marks = np.where(name, _PLACE[NAME], marks)
        head = np.flatnonzero(~(name & np.r_[False, name[:-1]] & ~opens))  # a run of capitalised words is one name
        tail = np.r_[head[1:], len(kept)] - 1
        yield Template(marks[head], start[head], stop[tail], (number | unit | name)[head], row[head], line[head]), plain


def _value(low: np.ndarray, t: Template, k: int) -> str | None:
    """What a placeholder stands for; None for a word."""
    return " ".join(low[t.start[k]:t.end[k]].tobytes().decode(errors="replace").replace(",", "").split()) if t.held[k] else None


def template(text: str) -> list[tuple[str, str | None]]:
    """Template words of a text and the values of their slots."""
    data, low, offsets = _lowered(pa.array([text]))
    kinds = {int(v): k for k, v in _PLACE.items()}
    return [(kinds.get(int(t.marks[k]), low[t.start[k]:t.end[k]].tobytes().decode(errors="replace")), _value(low, t, k))
            for t, _ in templates(data, low, offsets) for k in range(len(t.marks))]


def _hashes(t: Template, window: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the windows that lie in one text."""
    n = len(t.marks) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    mixed = np.full(n, salt, np.uint64)
    for k in range(window):
        mixed = (mixed ^ t.marks[k:n + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    inside = np.flatnonzero(t.row[:n] == t.row[window - 1:])
    return inside, mixed[inside]


def _short(t: Template, window: int, salt: int, lines: bool) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """First words, hashes and length of whole texts of fewer words than a window; or, if ``lines``, of
    runs of as many words that are one or more whole lines."""
    ends = np.r_[t.line[1:], True]
    opens = np.r_[True, t.row[1:] != t.row[:-1]]
    edges, closes = (t.line, ends) if lines else (opens, np.r_[opens[1:], True])
    for size in range(1, min(window, len(t.marks) + 1)):
        at, found = _hashes(t, size, salt + 2 * size)
        kept = edges[at] & closes[at + size - 1]
        yield at[kept], found[kept], size


_SLOT = pa.list_(pa.string())


def windows(rows: DataFrame, key: str, text: str, bitmap=None, window: int = WINDOW) -> DataFrame:
    """``id, plain, window, place, spot, windows, slots`` of every template window (those in the bitmap, if one is given).

    ``plain`` windows have names as words. ``windows`` is their number in the text; ``slots`` holds a value
    for placeholders, null for words; ``spot`` is the place in the template with names as placeholders.
    A text of fewer words than a window has one, over all of it; it is held against whole lines of others.
    Without a bitmap a text that has no names gives plain windows alone, since whatever matches the
    others matches these.
    """
    fields = ["id", "plain", "window", "place", "spot", "windows", "slots"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if bitmap is None else bitmap.value
        for batch in batches:
            data, low, offsets = _lowered(batch.column(1))
            for named, plain in templates(data, low, offsets):
                for t, (at, found, size) in ((t, w) for t in (named, plain) for w in (
                        (*_hashes(t, window, t is plain), window), *_short(t, window, t is plain, bitmap is not None))):
                    if wanted is None and t is named:
                        hit = np.flatnonzero(np.isin(t.row[at], t.row[t.marks == _PLACE[NAME]]))
                        at, found = at[hit], found[hit]
                    if wanted is not None:
                        bits = (found >> np.uint64(64 - BITS)).astype(np.int64)
                        hit = np.flatnonzero(wanted[bits >> 3] >> (bits & 7).astype(np.uint8) & 1)
                        at, found = at[hit], found[hit]
                    begin = np.searchsorted(t.row, t.row[at])                   # first template word of the text
                    totals = np.searchsorted(t.row, t.row[at], side="right") - begin - size + 1
                    spot = np.searchsorted(named.start, t.start[at], side="right") - 1 - np.searchsorted(named.row, t.row[at])
                    values = [[_value(low, t, k + j) for j in range(size)] for k in at.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(t.row[at])), pa.array(np.full(len(at), t is plain)), pa.array(found.view(np.int64)),
                         pa.array(at - begin), pa.array(spot), pa.array(totals.astype(np.int64)), pa.array(values, _SLOT)], names=fields)

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("id"), F.col(text).alias("source")).mapInArrow(
        run, f"id {kind}, plain boolean, window bigint, place bigint, spot bigint, windows bigint, slots array<string>")


def _bitmap(marks: DataFrame):
    """Which leading bits of window hashes occur: a bitmap of fixed size."""
    bits = marks.select(F.shiftrightunsigned("window", 64 - BITS).alias("b"))
    rows = bits.select(F.shiftright("b", 3).alias("byte"), F.expr("shiftleft(1, cast(b & 7 as int))").alias("bit"))
    table = np.zeros(1 << (BITS - 3), np.uint8)
    found = rows.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
    table[found["byte"].to_numpy()] = found["bits"].to_numpy().astype(np.uint8)
    return marks.sparkSession.sparkContext.broadcast(table)


def _needed(item_windows: int, similarity: float) -> int:
    return math.ceil(similarity * item_windows - 1e-9)


def _chain(places: list[int], items: list[int], cost: float) -> list[int]:
    """Hits in document order that make the best alignment: places rise on both sides, and each change
    of the lag costs ``cost`` matches. Hits come sorted by place and item place; of equal chains the first."""
    rank = {p: k + 1 for k, p in enumerate(sorted(set(items)))}
    tree = [(0.0, -1)] * (len(rank) + 1)                  # best chains that end before an item place
    on_lag: dict[int, tuple[float, int]] = {}
    score, back = [0.0] * len(places), [-1] * len(places)
    done = 0
    for k, (place, item) in enumerate(zip(places, items)):
        while places[done] < place:
            r = rank[items[done]]
            while r < len(tree):
                if score[done] > tree[r][0]:
                    tree[r] = (score[done], done)
                r += r & -r
            done += 1
        best, r = (cost, -1), rank[item] - 1
        while r:
            best = tree[r] if tree[r][0] > best[0] else best
            r -= r & -r
        best = (best[0] - cost, best[1])
        same = on_lag.get(place - item, (0.0, -1))
        best = same if same[1] >= 0 and same[0] >= best[0] else best
        score[k], back[k] = best[0] + 1, best[1]
        on_lag[place - item] = (score[k], k)
    at = max(range(len(score)), key=score.__getitem__, default=-1)
    out = []
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def _telling(order: list[int], places: list[int], slots: list, item_slots: list, reach: int) -> list[int]:
    """Of the hits in document order, those that can be part of an alignment: placeholders alone tell nothing if
    values differ, so such hits need a hit with a word in their reach."""
    words = np.array([places[k] for k in order if None in item_slots[k]], np.int64)
    at = np.array([places[k] for k in order], np.int64)
    near = np.searchsorted(words, at - reach) < np.searchsorted(words, at + reach, side="right")
    return [k for k, close in zip(order, near.tolist()) if close or slots[k] == item_slots[k]]


def _aligned(places: list[int], items: list[int], slots: list, item_slots: list, needed: int, total: int) -> list[tuple[int, int, bool]]:
    """``(matches, the first hit, whether values differ)`` of every alignment with consistent slots.

    An alignment takes each place once, so a window that occurs again in the item is not held against
    its other occurrence. Short detours are left out at first, and taken in if slots disagree or matches
    are too few without them. The hits of an alignment are gone before the next is looked for.
    """
    order = sorted(range(len(places)), key=lambda k: (places[k], items[k]))
    out = []
    while True:
        order = _telling(order, places, slots, item_slots, 2 * total + SLACK)
        if len({items[k] for k in order}) < needed:
            break
        for cost in COSTS:
            chain = [order[k] for k in _chain([places[k] for k in order], [items[k] for k in order], cost)]
            pairs = {(m, t) for k in chain for m, t in zip(slots[k], item_slots[k]) if m is not None and t is not None}
            changed = any(m != t for m, t in pairs)
            if changed and all(None not in item_slots[k] for k in chain):
                break                                     # placeholders alone tell nothing
            if len(chain) >= needed and (not changed or len(pairs) == len({m for m, _ in pairs}) == len({t for _, t in pairs})):
                out.append((len(chain), chain[0], changed))
                break
        if len(chain) < needed or not changed and len(chain) == total and len({places[k] - items[k] for k in chain}) == 1:
            break                                         # behind a whole copy, the first, nothing better comes
        gone = set(chain)
        order = [k for k in order if k not in gone]
    return out


def _judged(hits: DataFrame, line: list[str], similarity: float) -> DataFrame:
    """``id, item_id, item_windows, matched, base, changed`` of the alignments found in each line's hits."""
    fields = ["id", "item_id", "item_windows", "matched", "base", "changed"]
    kinds = {f.name: f.dataType.simpleString() for f in hits.schema.fields}

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        distinct = {}                                     # repeated rows of a document count once
        for k, spot in enumerate(zip(*(table[c].to_pylist() for c in ("lag", "item_place", "slots", "item_slots")))):
            distinct.setdefault((spot[0], spot[1], *map(tuple, spot[2:])), k)
        lags, items, slots, item_slots = zip(*distinct)
        total = table["item_windows"][0].as_py()
        found = _aligned([a + b for a, b in zip(lags, items)], list(items), slots, item_slots, _needed(total, similarity), total)
        matched, first, changed = zip(*found) if found else ((), (), ())
        rows = list(distinct.values())
        first = pa.array([rows[k] for k in first], pa.int64())
        return pa.table([table["id"].take(first), table["item_id"].take(first), table["item_windows"].take(first), pa.array(matched, pa.int64()),
                         table["base"].take(first), pa.array(changed, pa.bool_())], names=fields)

    return hits.groupBy(*line).applyInArrow(
        run, f"id {kinds['id']}, item_id {kinds['item_id']}, item_windows bigint, matched bigint, base bigint, changed boolean")


def _keyed(rows: DataFrame, slots: str) -> DataFrame:
    """``alone``: whether a window is placeholders alone, and ``key``, by which it opens a pair: with the values, if so."""
    alone = F.forall(slots, lambda value: value.isNotNull())
    return rows.withColumn("alone", alone).withColumn("key", F.when(alone, F.xxhash64("window", slots)).otherwise(F.col("window")))


def _opening(asked: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """The windows of ``asked`` one of which every leak has, the rarest that will do.

    Of an item's n windows, p are placeholders alone, and a leak has at least m. So it has at least m - p with words;
    without any of those it is a copy, with at least m of the p in equal values. Of w windows of which a leak has at
    least k, any w - k + 1 do; the rarest in the documents are taken. Placeholders alone open a pair by their values.
    """
    times = found.groupBy("plain", "key").agg(F.count("*").alias("times"))
    item = Window.partitionBy("item_id", "plain")
    rows = asked.join(times, ["plain", "key"], "left").withColumns({
        "p": F.count_if("alone").over(item), "n": F.count("*").over(item),
        "rank": F.row_number().over(Window.partitionBy("item_id", "plain", "alone").orderBy(F.coalesce("times", F.lit(0)), "item_place"))})
    least = F.ceil(F.lit(similarity) * F.col("n") - 1e-9)
    enough = F.when(F.col("alone"), F.col("p") - least + 1).otherwise(F.col("n") - F.col("p") - F.greatest(F.lit(1), least - F.col("p")) + 1)
    return rows.filter(F.col("rank") <= enough).select("plain", "key", "item_id", "item_place", "item_windows")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
          similarity: float = SIMILARITY) -> DataFrame:
    """``key, item_id, place, matched, item_windows, similarity, kind`` of every leaked item.

    ``place`` is the template word in the document where the item begins (the first, of several
    places). ``kind`` is ``copy`` or ``reparameterised``. An item with fewer words than a window leaks as
    whole lines, not inside one; of an item of placeholders alone only copies count. Items of equal id count once, as the first by text.
    """
    items = benchmark.select("item_id", F.col("text").alias("text")).filter("item_id is not null and text is not null")
    items = items.groupBy("item_id").agg(F.min("text").alias("text"))
    asked = windows(items, "item_id", "text", window=window).withColumnsRenamed(
        {"id": "item_id", "place": "item_place", "spot": "item_spot", "windows": "item_windows", "slots": "item_slots"})
    asked = saved(_keyed(asked, "item_slots"))
    found = saved(_keyed(windows(docs, key, text, _bitmap(asked), window), "slots").drop("windows"))
    half = F.col("item_windows") * 2 + SLACK
    stretches = F.array(F.floor(F.col("place") / (half * 2)) * 2, F.floor((F.col("place") + half) / (half * 2)) * 2 + 1)
    line = ["id", "item_id", "plain", "stretch"]
    opened = saved(found.select("id", "plain", "key", "place").join(_opening(asked, found, similarity), ["plain", "key"])
                   .withColumn("stretch", F.explode(stretches)).select(*line).distinct())
    worded = asked.groupBy("item_id", "plain").agg(F.bool_or(~F.col("alone")).alias("worded"))
    wanted = (opened.join(asked.drop("key", "alone"), ["item_id", "plain"]).join(worded, ["item_id", "plain"])
              .withColumnsRenamed({"id": "asked_id", "plain": "asked_plain", "window": "asked_window"}))
    pairs = wanted.join(found, wanted["asked_id"].eqNullSafe(found["id"]) & (F.col("asked_plain") == F.col("plain"))
                        & (F.col("asked_window") == F.col("window")) & F.array_contains(stretches, F.col("stretch"))
                        & (F.col("worded") | (F.col("slots") == F.col("item_slots"))))
    hits = saved(pairs.select("id", "item_id", "plain", "stretch", (F.col("place") - F.col("item_place")).alias("lag"),
                              (F.col("spot") - F.col("item_spot")).alias("base"), "item_place", "item_windows", "slots", "item_slots").distinct())
    lines = (hits.groupBy(*line).agg(F.countDistinct("item_place").alias("matched"), F.first("item_windows").alias("item_windows"))
             .filter(F.col("matched") >= F.ceil(F.lit(similarity) * F.col("item_windows") - 1e-9)))
    near = hits.join(lines.select(*line), [hits[c].eqNullSafe(lines[c]) for c in line], "left_semi")
    right = _judged(near, line, similarity)
    best = right.groupBy("id", "item_id").agg(F.max(F.struct(
        (F.col("matched") / F.col("item_windows")).alias("similarity"), (~F.col("changed")).alias("same"),
        (-F.col("base")).alias("back"), "matched", "item_windows")).alias("b"))
    return best.select(
        F.col("id").alias(key), "item_id", (-F.col("b.back")).alias("place"), F.col("b.matched").alias("matched"),
        F.col("b.item_windows").alias("item_windows"), F.col("b.similarity").alias("similarity"),
        F.when(F.col("b.same"), "copy").otherwise("reparameterised").alias("kind"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The leaks of the whole corpus, a row per document and item.

    Empty tables: no rows. Null texts have no windows. Repeated rows of one document count once. A
    null id is reported as null.
    """
    return leaks(docs.select("doc_id", "text"), benchmark)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a leak, all columns; rows of a leaking id go together, null ids among them."""
    bad = saved(contaminated(docs, benchmark).select("doc_id").distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti")
