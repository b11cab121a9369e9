"""Base matches against plain regular expressions; inferred formats."""

import hashlib
import random
import re

from landgrid.llm import common, secrets
from tests.llm import cases

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
HEX, UPPER, MIXED = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def plain(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def some(rng, letters, n):
    return "".join(rng.choice(letters) for _ in range(n))


def secret_texts(rng):
    out = []
    for k in range(60):
        body = cases.words(rng, "de", 8)
        out += [f"{body} token = \"{some(rng, HEX, 40)}\" {body}", f"ö {body} AKIA{some(rng, UPPER, 16)}é{body}",
                f"{body} Password: {some(rng, MIXED, 24)}, secret=password:longvalue1234567", f"{body} api_key={some(rng, MIXED, 8)} {some(rng, HEX, 20)}"]
    return out + ["token=token=abcdefghijklmnop", "AKIAAKIA" + "A" * 12, "ſecret=abcdefghijklmnop", "toKen=abcdefghijklmnop", "apikey:\"'x", "deadbeef" * 4]


def test_base_matches(monkeypatch):
    import pyarrow as pa

    texts = [*secret_texts(random.Random(2)), "", "a" * 70_000, "f" * 70_000]
    for block in (100, 1 << 19):
        monkeypatch.setattr(common, "BLOCK", block)
        base, _ = secrets.scan(*common.utf8(pa.array(texts)))
        assert [sorted((a, k, b) for k, a, b, _ in row) for row in base] == [plain(t) for t in texts]


def test_formats_are_told_from_words():
    rng = random.Random(1)
    labelled = {"hex": [some(rng, HEX, 40) for _ in range(200)], "access": ["AKIA" + some(rng, UPPER, 16) for _ in range(200)],
                "assign": [some(rng, MIXED, 32) for _ in range(200)]}
    ordinary = ["".join(rng.choice(cases.SYLLABLES["en"]) for _ in range(10)) for _ in range(300)]
    grammar = secrets.learn(labelled, ordinary)
    keys = [some(rng, HEX, 40), "AKIA" + some(rng, UPPER, 16), some(rng, MIXED, 32)]
    words = ["".join(rng.choice(cases.SYLLABLES["en"]) for _ in range(9)) for _ in range(100)]
    assert (grammar.scores(keys) >= grammar.threshold).all() and (grammar.scores(words) < grammar.threshold).mean() > 0.95
    assert len(grammar.formats["hex"].end) < 20                    # thousands of prefix states were merged
    access = grammar.formats["access"]
    assert secrets.likelihood(access, *symbols("AKIA" + "B" * 16))[0] > secrets.likelihood(access, *symbols("BKIA" + "B" * 16))[0] + 3


def symbols(text):
    import numpy as np

    data = np.frombuffer(text.encode(), np.uint8)
    return secrets._SYMBOL[data], np.array([0, len(data)])


def test_likelihood_sums_to_one():
    automaton = secrets.infer(["ab", "ab", "a", "b", "abab"])
    assert abs((2 ** automaton.cost).sum(axis=1) + 2 ** automaton.end - 1).max() < 1e-9


def test_awkward_documents(spark):
    rng = random.Random(3)
    texts = dict(enumerate(secret_texts(rng), 3000))
    lone = {5000 + k: f"{cases.words(rng, 'de', 6)} {some(rng, MIXED, 24)} {cases.words(rng, 'de', 6)}" for k in range(20)}
    docs = cases.awkward(spark, more=[*texts.items(), *lone.items()])
    got = secrets.digested(docs).collect()
    want = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == docs.count()
    added = 0
    for r in got:
        if r.doc_id is None:
            continue
        spans = plain(want[r.doc_id])
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        parts = [s for s in r.spans.split(",") if s]
        assert [s for s in parts if not s.startswith("format")] == [s for s in joined.split(",") if s]
        added += r.doc_id in lone and any(s.startswith("format") for s in parts)
    assert added >= 10                       # credentials of a learned format without a keyword beside them
    assert secrets.digested(cases.empty(spark)).count() == 0


def test_counts_and_threshold_come_from_all_values(spark, monkeypatch):
    """Every distinct value passes its automaton, and every ordinary word counts for the threshold."""
    import numpy as np

    rng = random.Random(9)
    keys = {"hex": {some(rng, HEX, rng.randint(16, 40)) for _ in range(900)}, "access": {"AKIA" + some(rng, UPPER, 16) for _ in range(450)}}
    words = {"".join(rng.choice(cases.SYLLABLES["en"]) for _ in range(rng.randint(9, 14))) for _ in range(700)}
    words = {w for w in words if len(w) >= 16 and w.isascii() and w.isalpha()}
    docs = spark.createDataFrame(list(enumerate([*keys["hex"], *keys["access"], *words, *list(words)[:50]])), "doc_id long, text string")
    monkeypatch.setattr(secrets, "STATES", 100, raising=False)
    grammar = secrets.learned(secrets.matched(docs, "doc_id"))
    assert set(grammar.formats) == set(keys)
    for values, automaton in [(keys["hex"], grammar.formats["hex"]), (keys["access"], grammar.formats["access"]), (words, grammar.ordinary)]:
        counts = np.zeros((len(automaton.end), secrets.SYMBOLS + 1))
        for value in values:
            state = 0
            for byte in value.encode():
                counts[state, secrets._SYMBOL[byte]] += 1
                state = automaton.step[state, secrets._SYMBOL[byte]]
            counts[state, -1] += 1
        share = np.log2((counts + 1 / (secrets.SYMBOLS + 1)) / (counts.sum(axis=1) + 1)[:, None])
        assert np.allclose(share[:, :-1], automaton.cost) and np.allclose(share[:, -1], automaton.end)
    scores = grammar.scores(sorted(words))
    assert abs(grammar.threshold - secrets.MARGIN - max(0.0, np.quantile(scores, secrets.USUAL))) < 2e-3


def hex_documents(spark, rng):
    """Documents of a value each: hex of two lengths, some of them long, some of a rare format; and ordinary words."""
    values = {some(rng, HEX, rng.choice([20, 40])) for _ in range(1100)} | {some(rng, HEX, 300) for _ in range(40)}
    values |= {"beef" * 4 + some(rng, "01", 12) for _ in range(2)}
    words = {"".join(rng.choice(cases.SYLLABLES["en"]) for _ in range(10)) for _ in range(600)}
    words = {w for w in words if len(w) >= 16 and w.isascii() and w.isalpha()} | {"-" * 200, "=" * 150, "q" * 400}
    return values, words, spark.createDataFrame(list(enumerate([*values, *words])), "doc_id long, text string")


def test_every_prefix_of_values_of_any_length_counts(spark, monkeypatch):
    """The automata are those of the whole prefix trees, also of values over 128 characters and of prefixes of few values."""
    import numpy as np

    values, words, docs = hex_documents(spark, random.Random(12))
    monkeypatch.setattr(secrets, "NODES", 1 << 20, raising=False)
    grammar = secrets.learned(secrets.matched(docs, "doc_id"))
    for want, got in [(secrets.infer(sorted(values)), grammar.formats["hex"]), (secrets.infer(sorted(words)), grammar.ordinary)]:
        assert got.step.shape == want.step.shape and (got.step == want.step).all()
        assert np.allclose(got.cost, want.cost) and np.allclose(got.end, want.end)


def test_prefixes_are_opened_in_rounds(spark, monkeypatch):
    """Few prefixes at a time on the driver, and still every value ends in its automaton, along steps that values have taken."""
    import numpy as np

    values, words, docs = hex_documents(spark, random.Random(13))
    monkeypatch.setattr(secrets, "NODES", 4000)
    opened, grown = [], secrets._grown
    monkeypatch.setattr(secrets, "_grown", lambda step, counts, nodes, below: opened.append(len(nodes["node"])) or grown(step, counts, nodes, below))
    grammar = secrets.learned(secrets.matched(docs, "doc_id"))
    assert len(opened) > 2 and max(opened) <= 4000
    for strings, automaton in [(values, grammar.formats["hex"]), (words, grammar.ordinary)]:
        counts = np.zeros((len(automaton.end), secrets.SYMBOLS + 1))
        for value in strings:
            state = 0
            for byte in value.encode():
                counts[state, secrets._SYMBOL[byte]] += 1
                state = automaton.step[state, secrets._SYMBOL[byte]]
            counts[state, -1] += 1
        share = np.log2((counts + 1 / (secrets.SYMBOLS + 1)) / (counts.sum(axis=1) + 1)[:, None])
        assert np.allclose(share[:, :-1], automaton.cost) and np.allclose(share[:, -1], automaton.end)


def test_walk_counts_in_parts(monkeypatch):
    """Prefixes that leave a task in small parts are the same; a string that leaves at its last character has one."""
    import numpy as np

    step = np.full((2, secrets.SYMBOLS), -1)
    step[0, 0], step[1, 1] = 1, 0
    texts = [[0], [0, 1, 0], [0, 0, 3, 3], [2], [], [0, 1, 2, 5, 0]]
    edges = np.cumsum([0, *map(len, texts)])
    runs = []
    for rows in (1, 1 << 18):
        monkeypatch.setattr(secrets, "ROWS", rows)
        counts = np.zeros((2, secrets.SYMBOLS + 1), np.int64)
        parts = list(secrets.walk(step, np.concatenate(texts).astype(int), edges, 3, counts))
        runs.append((sorted(zip(*(np.concatenate(c).tolist() for c in zip(*parts)))), counts.tolist()))
    assert runs[0] == runs[1]
    assert sorted(r[2:] for r in runs[0][0]) == sorted([(0, 2, 0, 0), (0, 2, 0, 1), (0, 5, 1, 0), (0, 0, 2, 1), (1, 0, 0, 0), (1, 3, 1, 0),
                                                        (1, 3, 2, 1)])
    assert counts[0, -1] == 1 and counts[1, -1] == 2 and counts[0, 0] == 5


def test_credentials_that_reach_beyond_a_base_match_are_found_whole(spark):
    rng = random.Random(4)
    texts = secret_texts(rng)
    inside = f"{some(rng, MIXED, 14)}Z{some(rng, HEX, 18)}Q{some(rng, MIXED, 14)}"
    docs = spark.createDataFrame([*enumerate(texts), (900, f"ä {inside} end"), (901, f"token={some(rng, MIXED, 30)}")], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.digested(docs).collect()}
    assert f"format:2:{2 + len(inside)}" in spans[900] and "hex:" in spans[900]
    assert "format" not in spans[901]
