"""Quality classifier: a convolutional network over bytes, trained and run in numpy.

A document is cut into overlapping chunks that cover it to its last byte. Learned filters of
``WIDTH`` embedded bytes slide over each chunk; the largest response of each filter is the chunk's
vector. The document's vector holds, per filter, the largest and the mean over its chunks; a small
layer turns it into one probability. Padding is a byte value of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrid.llm import common

CHUNK = 512              # bytes in a chunk
WIDTH = 8                # bytes under a filter
STRIDE = 2
FILTERS = 32
DEPTH = 8                # size of a byte's embedding
HIDDEN = 16
STEP = CHUNK - WIDTH + STRIDE          # the next chunk begins where the next filter position would
TILE = 16                # chunks convolved at a time
PAD = 256
PER_LABEL = 1500         # labelled rows of each class that the network may be fitted on

Weights = dict[str, np.ndarray]


def chunk_counts(sizes: np.ndarray) -> np.ndarray:
    """Chunks that cover texts of so many bytes; an empty text is one chunk of padding."""
    return np.maximum(1, -(-(sizes - WIDTH + STRIDE) // STEP)).astype(np.int64)


def chunked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Byte values (padding: PAD) of the chunks that begin at ``starts`` in texts that end at ``ends``."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    return np.where(inside, data[np.where(inside, at, 0)].astype(np.int16), np.int16(PAD)) if len(data) else np.full(at.shape, PAD, np.int16)


def _responses(w: Weights, chunks: np.ndarray) -> np.ndarray:
    """Filter responses, ``chunks x positions x FILTERS``."""
    embedded = w["bytes"][chunks].reshape(len(chunks), CHUNK * DEPTH)
    windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * DEPTH, axis=1)[:, ::STRIDE * DEPTH]
    flat = windows.reshape(-1, WIDTH * DEPTH) @ w["filters"]
    return flat.reshape(len(chunks), -1, FILTERS)


def pooled(w: Weights, chunks: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """The largest response of each filter in each chunk, and where it is."""
    top, where = [], []
    for k in range(0, len(chunks), TILE):
        r = _responses(w, chunks[k:k + TILE])
        if places:
            at = r.argmax(axis=1)
            where.append(at)
            top.append(np.take_along_axis(r, at[:, None], 1)[:, 0])
        else:
            top.append(r.max(axis=1))
    top = np.maximum(np.concatenate(top) + w["filter_bias"], 0)
    return top, np.concatenate(where) if places else None


def _head(w: Weights, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(features @ w["hidden"] + w["hidden_bias"])
    z = hidden @ w["out"] + w["out_bias"]
    return hidden, 1 / (1 + np.exp(-np.clip(z[:, 0], -30, 30)))


def probabilities(w: Weights, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of every text, block by block; of a long text only sums and maxima are held."""
    texts = len(offsets) - 1
    best, total = np.zeros((texts, FILTERS), np.float32), np.zeros((texts, FILTERS))
    counts = chunk_counts(np.diff(offsets))
    before = np.concatenate([[0], np.cumsum(counts)])
    for low in range(0, int(before[-1]), 8 * TILE):
        chunk = np.arange(low, min(low + 8 * TILE, before[-1]))
        text = np.searchsorted(before, chunk, side="right") - 1
        begin = offsets[text] + (chunk - before[text]) * STEP
        top, _ = pooled(w, chunked(data, begin, offsets[text + 1]))
        head = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        rows = text[head]
        best[rows] = np.maximum(best[rows], np.maximum.reduceat(top, head, axis=0))
        total[rows] += np.add.reduceat(top, head, axis=0)
    return _head(w, np.concatenate([best, total / counts[:, None]], axis=1).astype(np.float32))[1]


def fit(samples: list[tuple[str, int, float]], epochs: int = 8, rate: float = 4e-3, batch: int = 32) -> Weights | None:
    """Train on ``(text, 0 or 1, weight)`` with Adam; None if there is nothing to learn from."""
    if not samples:
        return None
    rng = np.random.default_rng(11)
    w = {"bytes": rng.normal(0, 0.5, (257, DEPTH)), "filters": rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)),
         "filter_bias": np.zeros(FILTERS), "hidden": rng.normal(0, (2 * FILTERS) ** -0.5, (2 * FILTERS, HIDDEN)),
         "hidden_bias": np.zeros(HIDDEN), "out": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 1)), "out_bias": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    texts = [np.frombuffer((t or "").encode(), np.uint8) for t, _, _ in samples]
    truth = np.array([y for _, y, _ in samples], np.float32)
    weight = np.array([v for _, _, v in samples], np.float32)
    weight = weight / weight.mean()
    steps = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), batch):
            rows = order[low:low + batch]
            pieces, owner = [], []
            for k, row in enumerate(rows):
                n = int(chunk_counts(np.array([len(texts[row])]))[0])
                begin = np.arange(n) * STEP
                pieces.append(chunked(texts[row], begin, np.full(n, len(texts[row]))))
                owner += [k] * n
            chunks, owner = np.concatenate(pieces), np.array(owner)
            top, where = pooled(w, chunks, places=True)
            head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            count = np.bincount(owner)[:, None]
            best = np.maximum.reduceat(top, head, axis=0)
            features = np.concatenate([best, np.add.reduceat(top, head, axis=0) / count], axis=1).astype(np.float32)
            hidden, p = _head(w, features)
            dz = ((p - truth[rows]) * weight[rows] / len(rows))[:, None].astype(np.float32)
            g = {"out": hidden.T @ dz, "out_bias": dz.sum(0)}
            dh = (dz @ w["out"].T) * (1 - hidden ** 2)
            g |= {"hidden": features.T @ dh, "hidden_bias": dh.sum(0)}
            df = dh @ w["hidden"].T
            is_best = top == best[owner]
            dt = (df[owner, :FILTERS] * is_best + df[owner, FILTERS:] / count[owner]) * (top > 0)
            g["filter_bias"] = dt.sum(0)
            at = where[..., None] * STRIDE + np.arange(WIDTH)                          # chunk, filter, byte
            seen = chunks[np.arange(len(chunks))[:, None, None], at]
            windows = w["bytes"][seen].reshape(len(chunks), FILTERS, WIDTH * DEPTH)
            g["filters"] = np.einsum("cfw,cf->wf", windows, dt, optimize=True)
            back = (dt[:, :, None] * w["filters"].T[None]).reshape(-1, DEPTH)
            flat = seen.reshape(-1)
            g["bytes"] = np.stack([np.bincount(flat, back[:, d], 257) for d in range(DEPTH)], axis=1)
            steps += 1
            pace = rate * (1 - 0.9 * epoch / epochs)
            for k in w:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                w[k] -= (pace * (first[k] / (1 - 0.9 ** steps)) / (np.sqrt(second[k] / (1 - 0.999 ** steps)) + 1e-8)).astype(np.float32)
    return w


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL) -> Weights | None:
    """A network from at most ``per_label`` labelled rows of each class, weighted back to their shares.

    Of repeated labels the largest counts; labels other than 0 and 1 and null ids are left out, and so
    are texts of over ``common.SAMPLE_BYTES`` bytes.
    """
    known = (labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    sample = common.bounded_sample(known, "doc_id", "y", per_label)
    return fit(common.sample_texts(docs, "doc_id", sample))


def scored(docs: DataFrame, w: Weights | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``score``; a null text is empty, and 0.5 is the score if nothing was learned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.full(batch.num_rows, 0.5) if w is None else probabilities(w, *common.utf8(batch.column("_text")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(p.astype(np.float64))],
                                             names=[*keep, "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, f"{kinds}, score double")


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``documents`` with held-out mark, score and class; learns labels of the other rows only.

    Empty table: no rows. Repeated rows: one result each. Null id: as an empty id, never learned from.
    Null or empty text: the score of one chunk of padding. A score of exactly 0.5 is class 1.
    """
    w = learn(docs, labels.filter(common.remainder("doc_id", 3) != 1))
    rows = docs.select("doc_id", (common.remainder("doc_id", 3) == 1).alias("held_out"), "text")
    return scored(rows, w, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
