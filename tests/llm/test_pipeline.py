"""The pipeline against its parts in plain Python, stage by stage."""

import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from landgrid.llm import pii
from tests.llm import cases
from tests.llm.test_simhash import brute, plain

pytest.importorskip("public_tokenizers")
ITEM = "many small rivers run down from the old hills and meet in a wide green valley where people grow corn and apples"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    rows, labels = [], []
    for k, text, lang in cases.corpus(300, seed=4):
        if k % 6 == 0:
            text += f" You {rng.choice(['vile', 'rotten', 'wicked'])} thing {cases.words(rng, 'en', 3)}."
        rows.append((k, text, lang))
        labels.append((k, 1, int(k % 6 == 0)))
    rows += [(900 + k, rows[7][1], "en") for k in range(5)]
    rows += [(910, f"Before. {ITEM}. After that nothing else was said here.", "en"), (911, "Write to jo.x1@mail.example.com or +1 (555) 010-1234 please.", "en"),
             (912, None, None), (913, "", "en"), (914, "Write to jo.x1@mail.example.com please, again and again.", "en")]
    path = tmp_path_factory.mktemp("pipeline")
    kept = [(i, t, lang, None, len(t) if t is not None else None, "extra") for i, t, lang in rows]
    tables = {"documents": (kept, "doc_id long, text string, lang string, source string, n_chars long, score string"),
              "labels": (labels, "doc_id long, quality int, toxic int"), "benchmark": ([(1, ITEM)], "item_id long, text string")}
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    frames = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], folder)
        out.write.parquet(f"{folder}/stage{k}.parquet")
        frames.append(spark.read.parquet(f"{folder}/stage{k}.parquet"))
        if k < 4:
            assert frames[-1].columns == docs.columns
    ids = [sorted(r.doc_id for r in f.select("doc_id").collect()) for f in frames[:5]]
    assert ids[1] == [i for i in ids[0] if not (i < 300 and i % 6 == 0)]
    marks = {i: plain(rows[i].text) for i in ids[1]}
    signed = {i: m - (1 << 64) if m >> 63 else m for i, m in marks.items()}
    roots = brute(list(signed.values()), 2)
    first = {}
    for i in ids[1]:
        first.setdefault(roots[signed[i]], i)
    assert ids[2] == sorted(first.values())
    assert ids[3] == [i for i in ids[2] if i != 910]
    assert ids[4] == ids[3]
    for r in frames[4].collect():
        before = rows[r.doc_id].text
        assert r.n_chars == (None if r.text is None else len(r.text))
        if r.doc_id in (911, 914):
            assert "jo.x1" not in r.text and [f[2] for f in pii.detect(r.text)] == [f[2] for f in pii.detect(before)]
        else:
            assert r.text == before
    texts = {r.doc_id: r.text for r in frames[4].collect()}
    same = [re.search(r"\S+@\S+", texts[i]).group().rstrip(".") for i in (911, 914)]
    assert same[0] == same[1]
    from tests.llm.test_packing import check
    from tokenizers import Tokenizer
    import public_tokenizers
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")] for i, t in texts.items()}
    pieces = [r.asDict() for r in frames[5].collect()]
    check(pieces, want, (2048, 256, 2048))
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in pieces)


def test_run_is_its_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert {(r.doc_id, r.doc_tokens) for r in got.collect()} == {(r.doc_id, r.doc_tokens) for r in spark.read.parquet(f"{folder}/stage4.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii_surrogates", "packing"]
