"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's probability is a logistic function of the sum of its words' weights; the document's is
the noisy-or of its sentences, ``1 - prod(1 - p)``. The weights are trained through the noisy-or from
document labels only (with a learned leak, the chance of the label without an offending sentence), so they end up on the words of the sentences that make a document toxic, and
sentences at or over ``OFFENDING`` can be pointed out. Sentences end at ``. ! ? ;`` or a line break; one
without a word that tells the classes apart has probability 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrid.llm import common

BITS = 18                # of a word's 64-bit hash, in a first look whether it may have a weight
PER_LABEL = 2500         # labelled rows of each class that the model may be fitted on
OFFENDING = 0.5
LONGEST = 64             # a longer run of word bytes counts as several words

_BYTES = np.arange(256)
_WORD = (_BYTES >= 128) | ((_BYTES >= 97) & (_BYTES <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90))
_END = np.isin(_BYTES, [ord(c) for c in ".!?;\n\r"])
_FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint64)
_POWERS = np.cumprod(np.r_[np.uint64(1), np.full(LONGEST - 1, 0x100000001B3, np.uint64)])


@dataclass
class Model:
    hashes: np.ndarray       # of the words with a weight, ascending
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.may = np.zeros(1 << BITS, bool)
        self.may[(self.hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words have a weight, and the weights' places."""
        hit = np.flatnonzero(self.may[(hashes >> np.uint64(64 - BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[hit]), max(0, len(self.hashes) - 1))
        same = self.hashes[place] == hashes[hit] if len(self.hashes) else np.zeros(len(hit), bool)
        return hit[same], place[same]


def words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words in some texts (ASCII case does not count); none goes over an edge."""
    word = _WORD[data]
    fresh = ~np.r_[False, word[:-1]] if len(data) else word
    fresh[edges[edges < len(data)]] = True
    begin = np.flatnonzero(word & fresh)
    if not len(begin):
        return begin, np.zeros(0, np.uint64)
    at = np.flatnonzero(word)
    place = at - np.repeat(begin, np.diff(np.r_[np.searchsorted(at, begin), len(at)]))
    within = place % LONGEST
    head = np.flatnonzero(within == 0)
    mixed = np.add.reduceat((_FOLD[data[at]] + np.uint64(1)) * _POWERS[within], head)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return at[head], mixed ^ (mixed >> np.uint64(29))


def sentences(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of sentences, ascending, and the text each belongs to; every text begins one."""
    after = np.flatnonzero(_END[data]) + 1
    starts = np.unique(np.concatenate([edges[:-1], after[after < edges[-1]]]))
    return starts, np.searchsorted(edges, starts, side="right") - 1


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Rows and bytes worked on at a time; a long text is cut behind a sentence, else a word, else hard."""
    for first, last in common.blocks(offsets):
        low, end = int(offsets[first]), int(offsets[last])
        while end - low > common.BLOCK:
            window = data[low:low + common.BLOCK]
            ends = np.flatnonzero(_END[window])
            ends = ends if len(ends) else np.flatnonzero(~_WORD[window])
            cut = low + (int(ends[-1]) + 1 if len(ends) else common.BLOCK)
            yield first, last, low, cut
            low = cut
        yield first, last, low, end


def _sentence_scores(model: Model, data: np.ndarray, edges: np.ndarray):
    starts, text = sentences(data, edges)
    at, hashes = words(data, edges)
    hit, place = model.found(hashes)
    of = np.searchsorted(starts, at[hit], side="right") - 1
    # a word counts once a sentence
    pair = np.unique(of * np.int64(max(1, len(model.hashes))) + place)
    of, place = pair // max(1, len(model.hashes)), pair % max(1, len(model.hashes))
    told, back = np.unique(of, return_inverse=True)
    z = np.bincount(back, model.weights[place], len(told)) + model.bias
    return starts, text, told, 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score_texts(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
    """Probability of each text and its offending sentences (code points, end exclusive)."""
    texts = len(offsets) - 1
    clean = np.zeros(texts)
    found: list[list[dict]] = [[] for _ in range(texts)]
    for first, last, low, end in _parts(data, offsets):
        piece = data[low:end]
        edges = np.clip(offsets[first:last + 1] - low, 0, end - low)
        full = np.flatnonzero(edges[1:] > edges[:-1])
        if not len(full):
            continue
        inner = np.r_[edges[full], edges[full[-1] + 1]]
        starts, text, told, p = _sentence_scores(model, piece, inner)
        np.add.at(clean, first + full[text[told]], np.log1p(-np.minimum(p, 1 - 1e-12)))
        stops = np.r_[starts[1:], inner[-1]]
        for k, chance in zip(told[p >= OFFENDING].tolist(), p[p >= OFFENDING].tolist()):
            row = first + int(full[text[k]])
            begin = int(offsets[row])
            found[row].append({"start": common.codepoint(data, begin, low + int(starts[k])),
                               "end": common.codepoint(data, begin, low + int(stops[k])), "score": chance})
    return -np.expm1(clean), found


def fit(samples: list[tuple[str, int, float]], epochs: int = 8, rate: float = 0.3, batch: int = 64,
        sure: float = 4.5) -> Model | None:
    """Train on ``(text, 0 or 1, weight)`` by AdaGrad through the noisy-or; None without both classes.

    A word has a weight if its share of the texts differs between the classes by at least ``sure``
    standard errors; the weight begins at the log-odds of the two shares.
    """
    if len({y for _, y, _ in samples}) < 2:
        return None
    data, offsets = common.utf8(pa.array([t or "" for t, _, _ in samples], pa.string()))
    starts, text = sentences(data, offsets)
    at, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for first, last in common.blocks(offsets):                # a few texts at a time, for the driver's memory
        low = int(offsets[first])
        begin, mark = words(data[low:offsets[last]], offsets[first:last + 1] - low)
        at.append(begin + low)
        hashes.append(mark)
    at, hashes = np.concatenate(at), np.concatenate(hashes)
    vocabulary, word = np.unique(hashes, return_inverse=True)
    size = max(1, len(vocabulary))
    # a word counts once a sentence
    of = np.searchsorted(starts, at, side="right") - 1
    mark = np.zeros(len(starts), np.uint64)
    np.add.at(mark, of, hashes)
    new = np.zeros(len(starts), bool)
    new[np.unique(mark, return_index=True)[1]] = True
    original = np.bincount(text, new, len(samples)) * 2 >= np.bincount(text, minlength=len(samples))
    pair = np.unique(of * np.int64(size) + word)
    of, word = pair // size, pair % size
    truth = np.array([y for _, y, _ in samples], float)
    weight = np.array([v for _, _, v in samples], float)
    weight = weight / weight.mean()
    # texts of which most sentences came before are copies; they don't make their words tell
    seen = np.unique((text[of] * np.int64(size) + word)[original[text[of]]])
    n1, n0 = max(1, truth[original].sum()), max(1, (1 - truth)[original].sum())
    with1 = np.bincount(seen % size, truth[seen // size], size)
    with0 = np.bincount(seen % size, 1 - truth[seen // size], size)
    share1, share0, share = (with1 + 0.5) / (n1 + 1), (with0 + 0.5) / (n0 + 1), (with1 + with0 + 1) / (n1 + n0 + 2)
    error = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    telling = np.flatnonzero((with1 + with0 >= 3) & (np.abs(share1 - share0) >= sure * error))
    place = np.full(size, -1)
    place[telling] = np.arange(len(telling))
    used = place[word] >= 0
    of, word = of[used], place[word[used]]
    told, of = np.unique(of, return_inverse=True)         # only sentences with such a word are scored
    text = text[told]
    values, squares = np.log(share1 / share0)[telling], np.full(len(telling), 1e-3)
    first_word = np.searchsorted(text[of], np.arange(len(samples) + 1))
    first_sentence = np.searchsorted(text, np.arange(len(samples) + 1))
    bias, bias_square = -4.0, 1e-3
    leak, leak_square = -3.0, 1e-3
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for low in range(0, len(order), batch):
            rows = np.sort(order[low:low + batch])
            words_at = np.concatenate([np.arange(first_word[r], first_word[r + 1]) for r in rows]).astype(np.int64)
            sent_at = np.concatenate([np.arange(first_sentence[r], first_sentence[r + 1]) for r in rows]).astype(np.int64)
            local = np.searchsorted(sent_at, of[words_at])
            doc = np.searchsorted(rows, text[sent_at])
            z = np.bincount(local, values[word[words_at]], len(sent_at)) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            leaked = 1 / (1 + np.exp(-leak))
            chance = -np.expm1(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(rows)) + np.log1p(-leaked))
            up = np.where(truth[rows] == 1, (1 - chance) / np.maximum(chance, 1e-9), -1.0) * weight[rows]
            slope = -up[doc] * p / len(rows)
            used, back = np.unique(word[words_at], return_inverse=True)
            g = np.bincount(back, slope[local], len(used))
            squares[used] += g ** 2
            values[used] -= rate * g / np.sqrt(squares[used])
            bias_square += slope.sum() ** 2
            bias -= 0.3 * rate * slope.sum() / np.sqrt(bias_square)
            drift = -(up * leaked).sum() / len(rows)
            leak_square += drift ** 2
            leak -= 0.2 * rate * drift / np.sqrt(leak_square)
    return Model(vocabulary[telling], values, float(bias))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL) -> Model | None:
    """A model from at most ``per_label`` labelled rows of each class, weighted back to their shares.

    Of repeated labels the largest counts; labels other than 0 and 1 and null ids are left out, and so
    are texts of over ``common.SAMPLE_BYTES`` bytes.
    """
    known = (labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    sample = common.bounded_sample(known, "doc_id", "y", per_label)
    return fit(common.sample_texts(docs, "doc_id", sample))


def scored(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text", score: str = "score",
           offending: str = "offending") -> DataFrame:
    """``keep`` columns, ``score`` and ``offending``: the sentences at fault with start, end and score.

    A null or empty text scores 0; so does every text if nothing was learned.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    source = common.fresh(docs, "source_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                p, found = np.zeros(batch.num_rows), [[]] * batch.num_rows
            else:
                p, found = score_texts(model, *common.utf8(pc.utf8_lower(pc.fill_null(batch.columns[-1], ""))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p), pa.array(found, kind)],
                                             names=[*keep, score, offending])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text).alias(source)).mapInArrow(
        run, f"{kinds}, `{score}` double, `{offending}` array<struct<start: bigint, end: bigint, score: double>>")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that score below 0.5, all columns; learns the labels of rows that are not held out."""
    model = learn(docs, labels.filter(common.remainder("doc_id", 5) != 0))
    score, offending = common.fresh(docs, "score"), common.fresh(docs, "offending")
    return scored(docs, model, docs.columns, score=score, offending=offending).filter(F.col(score) < 0.5).select(docs.columns)


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``documents`` with held-out mark, score, class and offending sentences.

    Labels are learned of rows that are not held out. Empty table: no rows. Repeated rows: one result
    each. Null id: as an empty id, never learned from. A score of exactly 0.5 is class 1.
    """
    model = learn(docs, labels.filter(common.remainder("doc_id", 5) != 0))
    rows = docs.select("doc_id", (common.remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return (scored(rows, model, ["doc_id", "held_out"])
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending"))
