"""The Jaccard join against all pairs in plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from landgrid.llm import jaccard_join, shingles
from tests.llm import cases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text, width=4):
    words = [w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows):
    """``(id, size, component)`` of every row by comparing all pairs."""
    sets = [plain(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((key, len(sets[i]), least.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "w%d" % rng.randrange(10_000)
    return " ".join(words)


def near_copies(seed=3):
    """Groups of edited copies about the limit, passages shared by unlike texts, chains, and texts of few words."""
    rng = random.Random(seed)
    rows, passage = [], cases.words(rng, "en", 30)
    for g in range(12):
        base = cases.words(rng, ("en", "de")[g % 2], rng.choice([5, 20, 60, 200, 700])).split()
        for k in range(rng.randint(2, 12)):
            rows.append(edited(rng, base, rng.choice([0, 1, max(1, len(base) // 90), max(1, len(base) // 45)])))
    rows += [cases.words(rng, "en", 60) + " " + passage for _ in range(30)]
    chain = cases.words(rng, "fr", 80).split()
    for _ in range(15):
        chain = edited(rng, chain, 1).split()
        rows.append(" ".join(chain))
    rows += ["one", "One", "one two", "ONE\ttwo", "one two three", "a b c d", "a b c d a b c d"]
    rng.shuffle(rows)
    return [(2000 + k, t) for k, t in enumerate(rows)]


def collected(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_sets_are_the_plain_ones():
    rows = [t for _, t in near_copies()] + ["", None, " \n", "x" * 700 + " y", "Äh ÄH äh ß \x85 \xa0 z", "a\x0bb\x1cc d"]
    column = pa.array(rows)
    sizes = np.concatenate([np.diff(o) for _, _, _, o in shingles.shingle_sets(column, 4, limit=900)])
    assert sizes.tolist() == [len(plain(t)) for t in rows]
    starts, ends, first = shingles.words(np.frombuffer(b"ab cdxy", np.uint8), np.array([0, 5, 5, 7, 7]))
    assert (starts.tolist(), ends.tolist(), first.tolist()) == ([0, 3, 5], [2, 5, 7], [0, 2, 2, 3, 3])


@pytest.mark.parametrize("chunk", [2048, 8])
def test_join_against_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    docs = cases.awkward(spark, more=near_copies())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert collected(jaccard_join.joined(docs)) == brute(rows)


def test_empty_table(spark):
    out = jaccard_join.joined(cases.empty(spark))
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_forest_leaves_no_link():
    rng = random.Random(5)
    sets = [sorted(plain(t)) for _, t in near_copies(8)]
    ids = {s: k for k, s in enumerate({x for s in sets for x in s})}
    hashes = [np.sort(shingles.mixed(np.array([ids[x] for x in s], np.uint64))) for s in sets]
    offsets = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
    maps = jaccard_join._bitmaps(np.concatenate(hashes), offsets)
    tree = np.sort(np.array([rng.randrange(3) for _ in sets]))
    size = np.diff(offsets)
    forest = jaccard_join.Forest(tree, size, np.arange(len(sets)), maps)
    roots = np.arange(len(forest.roots))
    found = {(min(a, b), max(a, b)) for x, y in forest.pairs(roots, roots) for a, b in zip(x.tolist(), y.tolist())}
    want = {(i, j) for j in range(len(sets)) for i in range(j) if tree[i] == tree[j]
            and 100 * len(set(sets[i]) & set(sets[j])) >= 85 * len(set(sets[i]) | set(sets[j]))}
    assert want <= found and len(found) < len(sets) ** 2 / 8


def test_wide_bitmaps_leave_every_link():
    rng = random.Random(2)
    for n in (1, 7, 8, 9, 100, 128, 129, 1000):
        for _ in range(30):
            a = np.sort(np.array(rng.sample(range(1 << 62), n), np.uint64))
            kept = max(0, n - rng.randrange(max(1, n // 5) + 1))
            b = np.sort(np.concatenate([a[:kept], np.array(rng.sample(range(1 << 62), rng.randrange(n // 8 + 2)), np.uint64)]))
            if len(b) and jaccard_join._similar(a.tobytes(), b.tobytes(), len(a), len(b)):
                assert jaccard_join._possible(jaccard_join._wide(a), jaccard_join._wide(b), len(a), len(b))
    far = np.array(rng.sample(range(1 << 62), 1000), np.uint64)
    assert not jaccard_join._possible(jaccard_join._wide(a), jaccard_join._wide(far), 1000, 1000)


def test_linked_sets_have_a_part_in_common():
    rng = random.Random(9)
    for _ in range(400):
        n = rng.choice([1, 2, 5, 6, 7, 11, 12, 13, 14, 30, 100, 300])
        a = np.array(rng.sample(range(1 << 62), n), np.uint64)
        kept = rng.randrange(n * 84 // 100, n + 1)
        b = np.concatenate([a[:kept], np.array(rng.sample(range(1 << 62), rng.randrange(n // 6 + 2)), np.uint64)])
        if 100 * kept < 85 * (n + len(b) - kept):
            continue
        keys = []
        for s in (np.sort(a), np.sort(b)):
            own = np.searchsorted(jaccard_join.LOW, [len(s)], side="right") - 1
            classes = [own] + ([own + 1] if 100 * len(s) >= 85 * jaccard_join.LOW[own[0] + 1] else [])
            keys.append({k for c in classes for k in jaccard_join._part_keys(s, np.array([0, len(s)]), np.array([0]), c)[0].tolist()})
        assert keys[0] & keys[1]


def test_linked_sets_meet_in_as_many_groups_as_they_need():
    rng, close = random.Random(4), 0
    for _ in range(600):
        n = rng.choice([5, 12, 30, 100, 147, 300, 900])
        a = np.array(rng.sample(range(1 << 62), n), np.uint64)
        kept = rng.randrange(n * 84 // 100, n + 1)
        b = np.concatenate([a[:kept], np.array(rng.sample(range(1 << 62), rng.randrange(n // 6 + 2)), np.uint64)])
        if 100 * kept < 85 * (n + len(b) - kept):
            continue
        grade = np.searchsorted(jaccard_join.LOW, [max(n, len(b))], side="right") - 1
        (one, _, spare), (two, _, other) = (
            jaccard_join._part_keys(np.sort(s), np.array([0, len(s)]), np.array([0]), grade) for s in (a, b))
        need = max(spare[0], other[0]) - 15 * (n + len(b)) // 185
        assert len(set(one.tolist()) & set(two.tolist())) >= max(1, need)
        close += need > 3
    assert close > 50


def test_a_set_is_sent_to_a_block_and_not_to_each_pair(spark, monkeypatch):
    """All pairs of 40 near copies: their sets are sent once a block; the links that are found join the same sets as all."""
    rng = random.Random(6)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(900)) for _ in range(150)]
    texts = [edited(rng, base, rng.randrange(1, 6)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    described = jaccard_join._described(docs, "doc_id", "text").collect()
    first = spark.createDataFrame([(r.node, r.mark) for r in described], "node long, mark long")
    nodes = {r.node: plain(texts[r.id]) for r in described}
    pairs = [(u, v, 1, u % 2) for u in nodes for v in nodes if u < v]
    written, ends = [], jaccard_join._ends
    monkeypatch.setattr(jaccard_join, "_ends", lambda *a: written.append((a[1:], ends(*a))) or written[-1][1])
    rows = spark.createDataFrame(pairs, "u long, v long, hits long, block long")
    found = {(r.u, r.v) for r in jaccard_join._linked(rows, docs, "text", first).collect()}
    assert len(pairs) == 780 and [df.count() for by, df in written if by == ("block",)] == [len({(b, x) for u, v, _, b in pairs for x in (u, v)})]
    links = {(u, v) for u, v, _, _ in pairs if 100 * len(nodes[u] & nodes[v]) >= 85 * len(nodes[u] | nodes[v])}
    assert found < links and len(found) <= 2 * 39

    def classes(edges):
        of = {x: x for x in nodes}
        for u, v in edges:
            old, new = of[u], of[v]
            of = {x: new if c == old else c for x, c in of.items()}
        return {frozenset(x for x in of if of[x] == c) for c in of.values()}

    assert classes(found) == classes(links)


def test_odd_bitmaps_differ_in_no_more_bits_than_sets_in_shingles():
    rng = random.Random(11)
    for n in (1, 20, 300, 3000):
        a = rng.sample(range(1 << 62), n)
        b = a[rng.randrange(n):] + rng.sample(range(1 << 62), rng.randrange(1, 30))
        hashes, offsets = np.array(a + b, np.uint64), np.array([0, n, n + len(b)])
        x, y = jaccard_join._odd(hashes, offsets)
        differ = int(np.bitwise_count(x ^ y).sum())
        assert differ <= len(set(a) ^ set(b)) and differ % 2 == len(set(a) ^ set(b)) % 2


def test_unlike_sets_of_usual_sizes_have_no_part_in_common():
    rng = np.random.default_rng(12)
    grade = int(np.searchsorted(jaccard_join.LOW, 300, side="right")) - 1
    n = int(jaccard_join.LOW[grade])
    offsets = np.arange(401) * n
    hashes = np.sort(rng.integers(0, 1 << 62, (400, n)).astype(np.uint64), axis=1).ravel()
    keys, _, spare = jaccard_join._part_keys(hashes, offsets, np.arange(400), np.full(400, grade))
    assert len(set(keys.tolist())) == len(keys) and spare.min() > 0


def crowd(rng, n):
    """Copies of a text with one to seven words changed: few are linked with most others, many with none."""
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(900)) for _ in range(150)]
    return [edited(rng, base, 1 + k % 7) for k in range(n)]


def test_pairs_of_a_crowd_are_not_listed(spark, monkeypatch):
    rows = list(enumerate(crowd(random.Random(13), 150)))

    def never(*_):
        raise AssertionError("pairs are listed")

    for name in ("_walked", "_placed"):
        monkeypatch.setattr(jaccard_join, name, never)
    found, inside = [], jaccard_join._links_inside
    monkeypatch.setattr(jaccard_join, "_links_inside", lambda *a: found.append(inside(*a)) or found[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(jaccard_join.joined(docs)) == brute(rows)
    assert len(found) == 1 and found[0].count() < len(rows)


@pytest.mark.parametrize(("chunk", "shares"), [(8, 1), (40, 2), (16, 32)])
def test_components_of_any_size_against_all_pairs(spark, monkeypatch, chunk, shares):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "SHARES", shares)
    rng = random.Random(14)
    rows = [(5000 + k, t) for k, t in enumerate(crowd(rng, 120) + crowd(rng, 20))] + near_copies(21)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(jaccard_join.joined(docs)) == brute(rows)
