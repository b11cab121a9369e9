"""SimHash against plain fingerprints and all-pairs distances."""

import random
import re

import numpy as np
import xxhash

from landgrid.llm import simhash
from landgrid.operators import graph
from tests.llm import cases
from tests.plans import plans_written


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def test_fingerprints(monkeypatch):
    texts = ["", None, " \n", "One", "one TWO", "a b c", "É é a\x0bb\x0cc\x1fd\xa0e f", *(t for _, t, _ in cases.corpus(20))]
    want = [plain(t) for t in texts]
    assert [simhash.fingerprint(t) for t in texts] == want
    monkeypatch.setattr(simhash, "SPLIT_BYTES", 7)
    assert [simhash.fingerprint(t) for t in texts] == want


def test_gray_rank():
    codes = np.array([k ^ (k >> 1) for k in range(64)], np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(64))


def clouds(seed=2):
    """Fingerprints around a few centres, some at the edge of the distance, with a chain and copies."""
    rng = random.Random(seed)
    marks = [rng.getrandbits(64) for _ in range(300)]
    for centre in marks[:6]:
        for _ in range(150):
            marks.append(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    step = marks[7]
    for _ in range(40):
        step ^= sum(1 << b for b in rng.sample(range(64), 2))
        marks.append(step)
    return [m - (1 << 64) if m >> 63 else m for m in marks + marks[:30]]


def brute(marks, distance):
    u = np.unique(np.array(marks, np.int64))
    bits = u.view(np.uint64)
    parent = list(range(len(u)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in np.argwhere(np.bitwise_count(bits[:, None] ^ bits) <= distance):
        if a < b:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {int(m): int(u[top(k)]) for k, m in enumerate(u)}


def test_index_finds_every_link_of_a_group():
    marks = np.unique(np.array(clouds(), np.int64)).view(np.uint64)
    groups = np.sort(np.arange(len(marks)) % 3)
    got = {(min(a, b), max(a, b)) for x, y in simhash.Index(groups, marks).links(2) for a, b in zip(x.tolist(), y.tolist())}
    near = np.bitwise_count(marks[:, None] ^ marks) <= 2
    want = {(a, b) for a, b in np.argwhere(near).tolist() if a < b and groups[a] == groups[b]}
    assert got == want


def test_components_with_and_without_crowded_nodes(spark):
    marks = clouds()
    want = brute(marks, 2)
    frame = spark.createDataFrame([(m,) for m in set(marks)], "mark long").repartition(5)
    for crowded in (4, 2048):
        got = {r.mark: r.root for r in simhash.components(frame, "mark", crowded=crowded).collect()}
        assert {m: got.get(m, m) for m in want} == want


def test_near_duplicates_of_awkward_rows(spark):
    docs = cases.awkward(spark)
    got = simhash.near_duplicates(docs).collect()
    rows = docs.collect()
    marks = {r.text: plain(r.text) for r in rows}
    signed = {t: m - (1 << 64) if m >> 63 else m for t, m in marks.items()}
    roots = brute(list(signed.values()), 2)
    lowest = {}
    for r in rows:
        if r.doc_id is not None:
            root = roots[signed[r.text]]
            lowest[root] = min(lowest.get(root, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{marks[r.text]:016x}", str(lowest.get(roots[signed[r.text]]))) for r in rows)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(roots[m] for m in signed.values()))
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == set(lowest.values())
    assert simhash.near_duplicates(cases.empty(spark)).count() == simhash.deduplicated(cases.empty(spark)).count() == 0


def test_a_task_runs_one_python_worker(spark, monkeypatch):
    """The index is written before its links are joined to components, so that their workers don't run side by side."""
    plans = plans_written(monkeypatch, graph)
    marks = spark.createDataFrame([(k,) for k in (0, 1, 7, 0xFFFF00000000)], "mark long")
    assert {r.mark: r.root for r in simhash.components(marks, "mark").collect()} == {1: 0, 7: 0}
    assert plans and max(p.count("MapInArrow") for p in plans) == 1
