"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

Subwords are windows of 2 to 4 bytes inside a word and across its ends (a blank marks an end). Each
is hashed to a row of an embedding table; a text is the mean of its rows, and a linear softmax over
that mean gives the languages. Both layers are trained together by stochastic gradient descent on a
bounded sample. A part of the sample is kept from training: on it the softmax gets its temperature,
and the rejection threshold is the lowest at which the accepted texts reach ``TARGET`` accuracy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrid.llm import common

ORDERS = (2, 3, 4)
BUCKETS = 1 << 15
WIDTH = 16
PER_LANGUAGE = 600       # rows of each language that the model may be fitted on
TARGET = 0.99
UNKNOWN = "und"

_BYTES = np.arange(256)
#: other than letters, every ASCII byte is a blank; bytes of longer characters stay
_FOLD = np.where((_BYTES >= 128) | ((_BYTES >= 97) & (_BYTES <= 122)), _BYTES, 32).astype(np.uint8)


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray        # BUCKETS x WIDTH
    softmax: np.ndarray      # WIDTH x labels
    bias: np.ndarray
    temperature: float
    threshold: float


def _windows(data: np.ndarray, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and buckets of the subwords that begin in the first ``count`` bytes."""
    blank = data == 32
    wide = data.astype(np.uint64)
    mixed = wide.copy()
    for order in range(2, max(ORDERS) + 1):
        usable = min(count, len(data) - order + 1)
        if usable <= 0:
            return
        mixed = mixed[:len(data) - order + 1] * np.uint64(0x100000001B3) + wide[order - 1:]
        if order == 2:
            good = ~(blank[:-1] & blank[1:])
            inside = np.zeros(len(data) - 1, bool)
        else:
            inside = inside[:len(data) - order + 1] | blank[order - 2:-1]     # a blank within the window
            good = ~inside
        if order in ORDERS:
            at = np.flatnonzero(good[:usable])
            mark = (mixed[at] ^ np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            yield at, (mark >> np.uint64(64 - 15)).astype(np.int64)


def _sums(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sum of its subwords' rows in ``table`` and their number, block by block."""
    texts = len(offsets) - 1
    sums, counts = np.zeros((texts, table.shape[1])), np.zeros(texts)
    for first, last in common.blocks(offsets):
        begin, end = int(offsets[first]), int(offsets[last])
        for low in range(begin, end, common.BLOCK):
            count = min(common.BLOCK, end - low)
            ahead = _FOLD[data[low:min(low + count + max(ORDERS) - 1, end)]]
            edges = np.clip(offsets[first:last + 1] - low, 0, count)
            for at, bucket in _windows(ahead, count):
                if not len(at):
                    continue
                cut = np.searchsorted(at, edges)
                rows = np.flatnonzero(cut[1:] > cut[:-1])
                sums[first + rows] += np.add.reduceat(table[bucket], cut[rows], axis=0)
                counts[first + rows] += (cut[1:] - cut[:-1])[rows]
    return sums, counts


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one text and their shares."""
    data = _FOLD[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    found = [bucket for _, bucket in _windows(data, len(data))]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    bucket, n = np.unique(np.concatenate(found), return_counts=True)
    return bucket, (n / max(1, n.sum())).astype(np.float32)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(samples: list[tuple[str, str]], epochs: int = 6, rate: float = 8.0, batch: int = 32) -> Model | None:
    """Train on ``(text, language)``; None if there is nothing to learn from."""
    samples = [(t, y) for t, y in samples if t]
    if not samples:
        return None
    labels = sorted({y for _, y in samples})
    place = {y: k for k, y in enumerate(labels)}
    rng = np.random.default_rng(7)
    order = rng.permutation(len(samples))
    bags = [_bag(samples[k][0]) for k in order]
    truth = np.array([place[samples[k][1]] for k in order])
    kept = len(bags) // 5 if len(bags) >= 20 else 0
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    softmax = rng.normal(0, 0.1, (WIDTH, len(labels))).astype(np.float32)
    bias = np.zeros(len(labels), np.float32)

    def dense(rows):
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for k, row in enumerate(rows):
            x[k, bags[row][0]] = bags[row][1]
        return x

    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for low in range(kept, len(bags), batch):
            rows = np.arange(low, min(low + batch, len(bags)))
            used = np.unique(np.concatenate([bags[r][0] for r in rows] or [np.zeros(0, np.int64)]))
            x = dense(rows)[:, used]
            hidden = x @ table[used]
            wrong = _softmax(hidden @ softmax + bias)
            wrong[np.arange(len(rows)), truth[rows]] -= 1
            wrong = (wrong / len(rows)).astype(np.float32)
            back = wrong @ softmax.T
            softmax -= step * 0.5 * (hidden.T @ wrong)
            bias -= step * 0.1 * wrong.sum(0)
            table[used] -= step * (x.T @ back)
    judged = np.arange(kept) if kept else np.arange(len(bags))
    z = np.concatenate([dense(judged[k:k + 64]) @ table @ softmax + bias for k in range(0, len(judged), 64)])
    temperature = min(np.geomspace(0.05, 20, 60), key=lambda t: -np.log(
        _softmax(z / t)[np.arange(len(judged)), truth[judged]] + 1e-12).sum())
    chance = _softmax(z / temperature)
    sure, right = chance.max(axis=1), chance.argmax(axis=1) == truth[judged]
    by = np.argsort(-sure, kind="stable")
    good = np.flatnonzero(np.cumsum(right[by]) / np.arange(1, len(by) + 1) >= TARGET)
    threshold = float(sure[by][good[-1]]) if len(good) else 1.0
    return Model(labels, table, softmax, bias, float(temperature), threshold)


def score_texts(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language of each text, and its probability."""
    data, offsets = common.utf8(common.spaced(column))
    folded = len(model.labels) <= WIDTH      # the two layers as one table, if that is the narrower one
    sums, n = _sums(data, offsets, (model.table @ model.softmax) if folded else model.table)
    mean = sums / np.maximum(n, 1)[:, None]
    chance = _softmax(((mean if folded else mean @ model.softmax) + model.bias) / model.temperature)
    best = chance.argmax(axis=1)
    return best, chance[np.arange(len(best)), best]


def predict(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score``, ``accepted``.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing was
    learned. ``accepted`` is false where the calibrated probability is below the rejection threshold.
    """
    rows = docs.select(*keep, F.col(text).alias("_text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letter"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter = batch.column("_letter").to_numpy(zero_copy_only=False)
            if model is None:
                name, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
                accepted = np.zeros(batch.num_rows, bool)
            else:
                best, score = score_texts(model, batch.column("_text"))
                score = np.where(letter, score, 0.0)
                name = [model.labels[b] if there else UNKNOWN for b, there in zip(best, letter)]
                accepted = letter & (score >= model.threshold)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(name, pa.string()), pa.array(score, pa.float64()),
                 pa.array(accepted)], names=[*keep, "lang_pred", "score", "accepted"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double, accepted boolean")


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from rows with text and language: at most ``per_language`` of each language.

    Repeated ids count once; texts of over ``common.SAMPLE_BYTES`` bytes are left out.
    """
    rows = docs.select(F.col(key), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    sample = common.bounded_sample(rows.select(key, "lang"), key, "lang", per_language)
    return fit([(t, y) for t, y, _ in common.sample_texts(rows, key, sample)])


def identified(docs: DataFrame) -> DataFrame:
    """Rows of ``documents`` with a held-out mark; learns from the rest only.

    Empty table: no rows. Repeated rows: one result each. Null id: as an empty id, not held out. Ties
    between languages go to the first by name. Other columns are not looked at.
    """
    held = (common.remainder("doc_id", 4) == 2).alias("held_out")
    model = learn(docs.filter(common.remainder("doc_id", 4) != 2))
    rows = docs.select("doc_id", held, "text")
    return predict(rows, model, ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score", "accepted")
