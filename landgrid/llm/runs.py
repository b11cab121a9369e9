"""Periodic runs of words by a suffix automaton with link-cut access.

A run is a maximal stretch of words with smallest period ``q`` and at least ``max(6, 4 q)`` words. For every prefix of
a text, the path from its state to the root of the automaton's link tree is recoloured with the prefix's end, as the
last occurrence of all the words' suffixes there (the *access* of link-cut trees). The path falls into segments by
their former colour: if suffixes of up to ``high`` words ended last at ``j``, the stretch that ends now has the period
``d = i - j`` over ``high + d`` words, since a longer suffix would have the same former end otherwise. With ``high >=
d`` that is a square, and the stretch is left-maximal; its last end is that of the run.

The automaton of a stretch is complete before the paths are walked, so they are kept as stacks along heavy paths, where an
access recolours a front part: amortised as link-cut trees, without their rotations.

Only stretches that may hold a run go through the automaton: inside a run, past its first period, every word occurred at
most ``q`` words before, so there are three periods in a row of words with a near former occurrence. This is looked for
with distances of 1, 2, 4, ...; such a stretch with the words before it holds the run whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 6                # words of a run
PERIODS = 4              # periods of a run
SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


def automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The suffix automaton's links and longest lengths, and the state of each prefix."""
    link, length, steps, states = [-1], [0], [{}], []
    last = 0
    for c in word:
        now = len(link)
        link.append(0)
        length.append(length[last] + 1)
        steps.append({})
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = now
            p = link[p]
        if p >= 0:
            q = steps[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                clone = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                steps.append(dict(steps[q]))
                link[q] = link[now] = clone
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = clone
                    p = link[p]
        last = now
        states.append(now)
    return link, length, states


def _heavy_paths(link: list[int], length: list[int]) -> list[int]:
    """The top of each state's heavy path; along a path lengths rise."""
    n = len(link)
    order = sorted(range(n), key=length.__getitem__)
    size = [1] * n
    for v in reversed(order[1:]):
        size[link[v]] += size[v]
    heavy, most = [-1] * n, [0] * n
    for v in order[1:]:
        if size[v] > most[link[v]]:
            most[link[v]], heavy[link[v]] = size[v], v
    top = [0] * n
    for v in order[1:]:
        p = link[v]
        top[v] = top[p] if heavy[p] == v else v
    return top


def stretch_runs(word: list[int]) -> dict[tuple[int, int], int]:
    """``(start, period): length`` of the runs of a stretch of words."""
    link, length, states = automaton(word)
    top = _heavy_paths(link, length)
    # per heavy path: its colours as (longest length of the part, end), the part at the top last
    paths: dict[int, list[tuple[int, int]]] = {}
    found: dict[tuple[int, int], int] = {}
    for i, v in enumerate(states):
        below = -1                                 # colour at the top of the path underneath: its part may go on
        while v > 0:
            head, now = top[v], length[v]
            stack = paths.get(head)
            if not stack:
                paths[head] = [(now, i)]
                below = -1
            else:
                first = stack[-1][1]
                while stack:
                    deep, j = stack[-1]
                    high, d = (deep if deep < now else now), i - j
                    if high >= (PERIODS - 1) * d and high + d >= LEAST and j != below:
                        key = (i - d - high + 1, d)
                        if found.get(key, 0) < high + d:
                            found[key] = high + d
                    if deep > now:
                        break
                    stack.pop()
                    if deep == now:
                        break
                stack.append((now, i))
                below = first
            v = link[head] if head else 0
    return found


def _stretches(word: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that hold all runs, with the words before them; overlapping ones are joined."""
    n = len(word)
    order = np.argsort(word, kind="stable")
    before = np.full(n, n, np.int64)
    same = word[order[1:]] == word[order[:-1]]
    before[order[1:][same]] = (order[1:] - order[:-1])[same]
    found: list[tuple[int, int]] = []
    near = 1
    while near <= 2 * max(1, n // PERIODS):
        # periods above near / 2, up to near
        shortest = near // 2 + 1
        least = max((PERIODS - 1) * shortest, LEAST - near)
        close = np.concatenate([[False], before <= near, [False]])
        edge = np.flatnonzero(close[1:] != close[:-1])
        first, last = edge[::2], edge[1::2]
        good = last - first >= least
        found += zip(np.maximum(first[good] - near, 0).tolist(), last[good].tolist())
        near *= 2
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def runs(word: list) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a sequence, by start and period."""
    if len(word) < LEAST:
        return []
    ids: dict = {}
    numbers = [ids.setdefault(w, len(ids)) for w in word]
    if len(ids) == len(word):
        return []
    found = []
    for a, b in _stretches(np.array(numbers, np.int32)):
        found += [(a + start, length, period) for (start, period), length in stretch_runs(numbers[a:b]).items()]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(word: list, found: list[tuple[int, int, int]]) -> list:
    """The words outside of all runs and in the first period of every run that holds them."""
    if not found:
        return word
    change = np.zeros(len(word) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [word[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def described(word: list[bytes]) -> tuple:
    """The figures of :data:`SCHEMA` for a sequence of words in UTF-8."""
    found = runs(word)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapsed(word, found))).hexdigest())


def repeated_tail(word: list[bytes], h: int) -> list[bytes]:
    """Every tenth document's words (``h``: a hash of its id) with a periodic tail, so that there are runs to find."""
    n = len(word)
    if h % 10 or not n:
        return word
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return word[:a] + [word[a + k % p] for k in range(n - a)]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """``key`` and the figures of :data:`SCHEMA` for the words of every row's whole text.

    Words are runs of bytes other than blank and \\t..\\r. Null and empty texts have no words and no run: four nulls and
    the hashes of nothing. Rows of one id, or without an id, are each described by themselves; an empty table gives no
    rows; other columns are not read. ``planted`` gives every tenth document a periodic tail first; a null id counts
    as empty text there.
    """
    names = [key, *(f.split()[0] for f in SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body, h in zip(batch.column(1), batch.column(2).to_pylist()):
                word = (body.as_py() or "").encode().split()      # bytes split at exactly these white spaces
                rows.append(described(repeated_tail(word, h) if planted else word))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=names)

    kind = docs.schema[key].dataType.simpleString()
    h = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return docs.select(key, F.col(text).alias("source"), h.alias("h")).mapInArrow(run, f"`{key}` {kind}, {SCHEMA}")


#: crc32 by its bits; stretches with a period by comparing words at every distance up to a quarter of the text
SQL = """
with recursive texts as materialized (select row_number() over () rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w,
        xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
            lambda s, b: list_reduce(list_prepend(xor(s, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, z: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end))) h from documents),
    sized as (select rid, doc_id, w, h, len(w) n, h // 10 g from texts),
    tails as (select *, case when h % 10 = 0 and n > 0 then g % n end a from sized),
    shaped as (select *, 1 + (n - a) // (3 + g % 8) p from tails),
    words as materialized (select rid, n, i, case when a is null or i < a then w[i + 1] else w[a + (i - a) % p + 1] end word
        from (select rid, n, a, p, w, unnest(range(n)) i from shaped)),
    listed as materialized (select rid, n, list(word order by i) w from words group by rid, n),
    same as (select rid, q, unnest(list_filter(range(q + 1, n + 1), lambda k: w[k] = w[k - q])) - 1 i
        from (select rid, n, w, unnest(range(1, n // 4 + 1)) q from listed)),
    islands as (select rid, q, i, i - row_number() over (partition by rid, q order by i) island from same),
    stretches as (select rid, q, min(i) - q as start, count(*) + q as length from islands group by rid, q, island),
    long as (select * from stretches where length >= greatest(6, 4 * q)),
    runs as materialized (select rid, start, length, q from long a where not exists (
        select 1 from long b where b.rid = a.rid and b.q < a.q and a.q % b.q = 0 and b.start <= a.start
            and b.start + b.length >= a.start + a.length)),
    figures as (select rid, count(*) n_runs, arg_min({'s': start, 'l': length, 'q': q}, (-length, start, q)) best,
        string_agg(start || ',' || length || ',' || q || chr(10), '' order by start, q) lines from runs group by rid),
    dropped as (select distinct rid, unnest(range(start + q, start + length)) i from runs),
    kept as (select rid, string_agg(word, ' ' order by i) body from words anti join dropped using (rid, i) group by rid)
select doc_id, coalesce(n_runs, 0) n_runs, best.s as start, best.l as length, best.q as period, 1000 * best.l // best.q exponent_milli,
    sha256(coalesce(lines, '')) runs_sha256, sha256(coalesce(body, '')) collapsed_sha256
from texts left join figures using (rid) left join kept using (rid)
"""
