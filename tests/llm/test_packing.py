"""Packing: the library's ids, every id in one piece, limits, little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landgrid.llm import common, packing, tokens
from tests.llm import cases

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = ["a", "B", "é", "ß", "ö", "1", "22", " ", "  ", "\n", "\t", "\r\n", ".", "!!", "'", "'s", "'ll", "$", "×", "ſ", "中", "<|endoftext|>",
       "_", "²", "ǅ", "ɐ", "\x0b", "\x1f", "İ", "​", "😀"]


@pytest.mark.parametrize("block", [16, 1 << 19])
def test_ids_are_the_librarys(library, monkeypatch, block):
    monkeypatch.setattr(common, "BLOCK", block)
    rng = random.Random(4)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [t for _, t, _ in cases.corpus(20)]
    encoder = tokens.Encoder(*tokens.default_paths())
    got = [ids.tolist() for ids in encoder.encode(*common.utf8(pa.array(texts)))]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def check(rows, want, limits, exempt=True):
    """Pieces cover each document's ids once; sequences are gapless and within the limits."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["loss_tokens"]))
    for key, options in want.items():
        spans = sorted(pieces.pop(key))
        for ids in options:
            at = 0
            own = []
            while at < len(ids):
                match = next(p for p in spans if p[0] == at and p[2] == zlib.crc32(ids[at:at + p[1]].tobytes()) and p[3] == len(ids))
                spans.remove(match)
                own.append(match)
                at += match[1]
            assert at == len(ids)
        assert not spans
    assert not pieces
    padding = 0
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0, *(p[1] for p in parts[:-1])]))
        size = sum(p[1] for p in parts)
        assert size <= limits[0] and len(parts) <= limits[1] and sum(p[2] for p in parts) <= limits[2]
        padding += 0 if exempt and size & size - 1 == 0 else limits[0] - size
    return padding


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_awkward_documents(spark, library):
    docs = cases.awkward(spark)
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(ids_of(library, r.text))
    rows = [r.asDict() for r in packing.documents_packed(docs).collect()]
    padding = check(rows, want, (2048, 256, 2048))
    assert padding <= 0.02 * sum(r["length"] for r in rows)
    assert packing.documents_packed(cases.empty(spark)).count() == 0


def test_limits_on_instruction_data(spark, library):
    rng = random.Random(8)
    rows = [(k, cases.words(rng, "en", rng.randint(1, 120)), "assistant" if k % 3 else "user") for k in range(400)]
    turns = spark.createDataFrame(rows, "doc_id long, text string, role string").repartition(2)
    limits = (512, 6, 300)
    got = packing.packed(turns, "doc_id", bears_loss=F.col("role") == "assistant", tokens=512, segments=6, loss_tokens=300, with_ids=True)
    found = [r.asDict() for r in got.collect()]
    check(found, {k: [ids_of(library, t)] for k, t, _ in rows}, limits)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in found)
    whole = packing.packed(turns, "doc_id", bears_loss=F.col("role") == "assistant", tokens=2048, segments=6, loss_tokens=1500, cut=False)
    found = [r.asDict() for r in whole.collect()]
    assert len(found) == len(rows)                                       # nothing exceeds a sequence, so nothing is cut
    check(found, {k: [ids_of(library, t)] for k, t, _ in rows}, (2048, 6, 1500), exempt=False)


def test_dot_product_prefers_what_is_left():
    packer = packing.Packer((100, 10, 100), 0)
    placed = [p for k, (size, bears) in enumerate([(60, True), (50, False), (45, True), (40, True), (30, False)]) for p in packer.add(k, size, bears)]
    placed += packer.finish()
    assert {(p[0], p[2]) for p in placed if p[3] == placed[0][3]} >= {(0, 60), (3, 40)}
