"""Runs against all stretches and periods in plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from landgrid.llm import runs
from tests.llm import cases


def brute(word):
    """All runs by comparing words at every distance."""
    n, found = len(word), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if word[i] != word[i - q]:
                i += 1
                continue
            first = i
            while i < n and word[i] == word[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length >= max(6, 4 * q) and not any(
                    q % p == 0 and s <= start and s + m >= start + length for (s, p), m in found.items() if p < q):
                found[start, q] = length
    return sorted(((s, m, q) for (s, q), m in found.items()), key=lambda r: (r[0], r[2]))


def sequences():
    rng = random.Random(4)
    for k in range(1500):
        size = rng.choice([1, 2, 2, 3, 5, 30])
        word = [rng.randrange(size) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            at, unit = rng.randint(0, len(word)), [rng.randrange(size) for _ in range(rng.randint(1, 9))]
            word[at:at] = (unit * 9)[:rng.randint(2, 9) * len(unit) - rng.randint(0, 1)]
        yield word
    a, b = [0], [0, 1]
    for _ in range(9):                                     # a Fibonacci word has squares and cubes, but few runs
        a, b = b, b + a
    yield b
    yield [0] * 500 + [1] + [0] * 500


def test_runs_against_all_periods():
    found = 0
    for word in sequences():
        want = brute(word)
        assert runs.runs(word) == want, word
        found += len(want)
    assert found > 1000


def test_stretch_needs_no_filter():
    for word in list(sequences())[::7]:
        assert sorted((s, m, q) for (s, q), m in runs.stretch_runs(word).items()) == sorted(brute(word))


def plain(key, text, planted):
    word = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(word), zlib.crc32(("" if key is None else str(key)).encode())
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        word = [word[a + (i - a) % p] if i >= a else word[i] for i in range(n)]
    found = brute(word) if n < 3000 else [(0, n, 1)] * (len(set(word)) == 1)
    best = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = " ".join(w for i, w in enumerate(word) if i not in dropped)
    return (key, len(found), *(best[0] if best else (None,) * 3), best[0][1] * 1000 // best[0][2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("planted", [False, True])
def test_texts_against_plain_python(spark, planted):
    docs = cases.awkward(spark, more=[(3000 + k, t) for k, (_, t, _) in enumerate(cases.corpus(150, seed=9))] + [
        (4000, "buy now " * 50 + "end"), (4001, "a\x0bb\x1cc a\x0bb\x1cc a\tb\x1cc a b\x1cc \x85 \xa0"), (4002, "x " * 6)])
    got = runs.periodic_runs(docs, planted=planted)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = sorted((plain(r.doc_id, r.text, planted) for r in docs.collect()), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert sum(w[1] for w in want) > 1


def test_empty_table(spark):
    assert runs.periodic_runs(cases.empty(spark)).count() == 0


def test_long_periodic_text_is_quick():
    word = [str(k % 977).encode() for k in range(60_000)] + [b"a"] * 60_000
    assert [r[1:] for r in runs.runs(word)] == [(60_000, 977), (60_000, 1)]
