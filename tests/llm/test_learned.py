"""Language, quality and toxicity: held-out accuracy, hold-out rules, awkward rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from landgrid.llm import common, language_id, quality, toxicity
from tests.llm import cases

LABELS = "doc_id long, quality int, toxic int, text string, score double"


def remainder(doc_id, divisor):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor


def test_language_of_held_out_texts(spark):
    docs = spark.createDataFrame(cases.corpus(240), "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identified(docs).collect()}
    held = [(i, lang) for i, _, lang in cases.corpus(240) if remainder(i, 4) == 2]
    assert all(got[i].held_out == (remainder(i, 4) == 2) for i in got)
    assert np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_learns_from_other_rows_only(spark):
    rows = [(i, t, "held" if remainder(i, 4) == 2 else lang) for i, t, lang in cases.corpus(60)]
    got = language_id.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert "held" not in {r.lang_pred for r in got}


def test_language_rejects_what_it_does_not_know():
    samples = [(t, lang) for _, t, lang in cases.corpus(300) if lang != "fr"]
    model = language_id.fit(samples)
    known = language_id.score_texts(model, pa.array([t for t, _ in samples]))[1]
    assert 0 < model.threshold <= 1 and (known >= model.threshold).mean() > 0.9


def test_language_scores_do_not_depend_on_the_batch(monkeypatch):
    model = language_id.fit([(t, lang) for _, t, lang in cases.corpus(60)])
    texts = [t for _, t, _ in cases.corpus(30, seed=9)] + ["", "a", "ab " * 5000]
    whole = language_id.score_texts(model, pa.array(texts))[1]
    monkeypatch.setattr(common, "BLOCK", 64)
    assert np.allclose(whole, language_id.score_texts(model, pa.array(texts))[1], atol=1e-9)


@pytest.mark.parametrize("run", ["language", "quality", "toxicity"])
def test_awkward_rows(spark, run):
    docs = cases.awkward(spark)
    labels = spark.createDataFrame([(k, k % 2, int(k % 5 == 0), None, None) for k in range(40)] + [(None, 1, 1, "t", 0.5), (3, None, None, None, None),
                                   (4, 0, 1, None, None), (4, 7, -1, None, None)], LABELS)
    frame = {"language": lambda: language_id.identified(docs), "quality": lambda: quality.rated(docs, labels),
             "toxicity": lambda: toxicity.rated(docs, labels)}[run]()
    got = frame.collect()
    assert len(got) == docs.count()
    assert all(r.held_out is not None and 0 <= r.score <= 1 for r in got)
    if run == "language":
        by = {r.doc_id: r.lang_pred for r in got if r.doc_id}
        assert [by[k] for k in (1000, 1001, 1002, 1003)] == ["und"] * 4
        assert by[1005] != "und" and by[1006] != "und"
    else:
        assert all(r.predicted == (r.score >= 0.5) for r in got)
        same = {r.score for r in got if r.doc_id in (1007, 1008)}
        assert len(same) == 1
    none = {"language": lambda: language_id.identified(cases.empty(spark)),
            "quality": lambda: quality.rated(cases.empty(spark), cases.empty(spark, LABELS)),
            "toxicity": lambda: toxicity.rated(docs, cases.empty(spark, LABELS))}[run]()
    assert none.count() == (docs.count() if run == "toxicity" else 0)


def junk(rng):
    return " | ".join(cases.words(rng, "en", 1) + "!!" for _ in range(rng.randint(20, 60)))


def test_quality_of_held_out_texts(spark):
    rng = random.Random(3)
    rows = [(k, junk(rng) if k % 4 == 0 else t) for k, t, _ in cases.corpus(400)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0, None, None) for k in range(400)], LABELS)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r for r in quality.rated(docs, labels).collect() if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in got]) > 0.95


def test_quality_sees_the_end_of_a_text():
    sizes = np.array([0, 1, quality.WIDTH, quality.CHUNK, quality.CHUNK + 1, quality.CHUNK + quality.STEP, 5000])
    for size, count in zip(sizes, quality.chunk_counts(sizes)):
        last = (count - 1) * quality.STEP
        assert last + quality.CHUNK >= size and (count == 1 or last < size - quality.WIDTH + quality.STRIDE)


def test_quality_network_equals_a_plain_one():
    w = quality.fit([(t, k % 2, 1.0) for k, t, _ in cases.corpus(24)], epochs=1)
    texts = ["", "short", "abc " * 900]
    got = quality.probabilities(w, *common.utf8(pa.array(texts)))
    for text, p in zip(texts, got):
        data = list(text.encode())
        tops = []
        for k in range(int(quality.chunk_counts(np.array([len(data)]))[0])):
            chunk = (data[k * quality.STEP:k * quality.STEP + quality.CHUNK] + [quality.PAD] * quality.CHUNK)[:quality.CHUNK]
            spots = [w["bytes"][chunk[j:j + quality.WIDTH]].ravel() @ w["filters"] for j in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE)]
            tops.append(np.maximum(np.max(spots, axis=0) + w["filter_bias"], 0))
        features = np.concatenate([np.max(tops, axis=0), np.mean(tops, axis=0)])
        z = np.tanh(features @ w["hidden"] + w["hidden_bias"]) @ w["out"] + w["out_bias"]
        assert abs(1 / (1 + np.exp(-z[0])) - p) < 1e-4


def toxic_corpus(n=500):
    rng = random.Random(5)
    rows = []
    for k, text, _ in cases.corpus(n):
        bad = k % 5 == 0
        if bad:
            sentences = text.split(". ")
            at = rng.randrange(len(sentences))
            sentences[at] = f"You {rng.choice(['vile', 'rotten', 'wicked'])} thing"
            text = ". ".join(sentences)
        rows.append((k, text, int(bad)))
    return rows


def test_toxicity_finds_documents_and_sentences(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, y, None, None) for k, _, y in rows], LABELS)
    got = {r.doc_id: r for r in toxicity.rated(docs, labels).collect()}
    for k, text, y in rows:
        assert got[k].predicted == y, text
        places = [text[s.start:s.end] for s in got[k].offending]
        assert bool(places) == bool(y) and all(any(w in p for w in ("vile", "rotten", "wicked")) for p in places)
    kept = toxicity.without_toxic(docs, labels)
    assert {r.doc_id for r in kept.collect()} == {k for k, _, y in rows if not y} and kept.columns == docs.columns


def test_toxicity_is_the_noisy_or_of_its_sentences(monkeypatch):
    rows = toxic_corpus()
    model = toxicity.fit([(t, y, 1.0) for _, t, y in rows])
    texts = ["", "vile. rotten thing! wicked", "ö vile\nclean; here.", "vile " * 300 + ". rotten"]
    whole, found = toxicity.score_texts(model, *common.utf8(pa.array(texts)))
    alone = [toxicity.score_texts(model, *common.utf8(pa.array([s])))[0][0] for s in ("vile", "rotten thing", "wicked")]
    assert abs(whole[1] - (1 - np.prod(1 - np.array(alone)))) < 1e-9
    assert texts[2][found[2][0]["start"]:found[2][0]["end"]] == "ö vile\n"
    monkeypatch.setattr(common, "BLOCK", 40)
    assert np.allclose(toxicity.score_texts(model, *common.utf8(pa.array(texts[:3])))[0], whole[:3])
