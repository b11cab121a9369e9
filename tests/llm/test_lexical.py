"""Ranked search against scoring every document in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np

from landgrid.llm import lexical
from tests.llm import cases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, best=20):
    counts = [(key, Counter(plain(t)), len(plain(t))) for key, t in docs if plain(t)]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    rows = []
    for item, text in items:
        found = []
        for key, c, n in counts:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in plain(text) if t in c)
            if score > 0:
                found.append((-score, key is None, key, item))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        rows += [(item, k + 1, f[2], -f[0]) for k, f in enumerate(found[:best])]
    return sorted(rows)


def items(rng):
    rows = [(k, cases.words(rng, ("en", "de", "fr")[k % 3], rng.randint(1, 25))) for k in range(25)]
    return rows + [(50, "word WORD xyz"), (51, ""), (52, None), (53, "!!"), (54, "no-such-term-anywhere"), (55, "Same same text here, for ÄH 中文")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, doc_id string, score int")


def result(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_search_against_all_scores(spark, monkeypatch):
    docs = cases.awkward(spark, more=[(3000 + k, t) for k, (_, t, _) in enumerate(cases.corpus(200, seed=6))])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    asked = items(random.Random(3))
    want = brute(rows, asked)
    found = lexical.ranked(docs, table(spark, asked))
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and result(found) == want
    monkeypatch.setattr(lexical, "ITEMS", 7)               # several blocks of items, and an index of all terms
    assert result(lexical.ranked(docs, table(spark, asked))) == want


def test_empty_tables(spark):
    docs = cases.awkward(spark)
    assert lexical.ranked(cases.empty(spark), table(spark, items(random.Random(3)))).count() == 0
    assert lexical.ranked(docs, table(spark, [])).count() == 0


def test_blocks_are_rejected_before_decompression(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 4)
    rng = random.Random(1)
    rows = [(k, cases.words(rng, "en", rng.randint(5, 60))) for k in range(600)]
    rows += [(900 + k, rows[k][1] + " rare needle " * 3) for k in range(30)]
    rng.shuffle(rows)
    counts = [Counter(lexical.terms(t)) for _, t in rows]
    df = Counter(t for c in counts for t in c)
    corpus = lexical.Corpus(len(rows), sum(sum(c.values()) for c in counts), df)
    postings = {t: [(k, c[t]) for k, c in enumerate(counts) if t in c] for t in df}
    names = ["ids", "documents", "terms", "lengths", "vocabulary", "df", "first", "blocks"]
    import pyarrow as pa
    block = pa.struct([("n", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("times", pa.list_(pa.int32())),
                       ("lengths", pa.list_(pa.int32())), ("body", pa.binary())])
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(block)]
    row = lexical._shard(pa.array([k for k, _ in rows]), [sum(c.values()) for c in counts], postings, names, kinds).to_pylist()[0]
    item = Counter(lexical.terms("rare needle " + rows[5][1]))
    whole = lexical.Shard(row, corpus, item)
    live, score = whole.search(item, 0)
    threshold = int(np.sort(score)[-20])
    part = lexical.Shard(row, corpus, item)
    some, few = part.search(item, threshold)
    full = {int(k): int(s) for k, s in zip(live, score) if s >= threshold}
    assert {int(k): int(s) for k, s in zip(some, few) if s >= threshold} == full
    assert part.skipped > 0 and part.read < whole.read


def test_postings_round_trip():
    rng = np.random.default_rng(2)
    for top, times in ((300, 3), (1 << 20, 1 << 17)):
        places = np.unique(rng.integers(0, top, 128))
        counts = rng.integers(1, times, len(places))
        a, b = lexical._unpacked(lexical._packed(places, counts), int(places[0]), len(places))
        assert (a == places).all() and (b == counts).all()
