"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

Documents are indexed in shards of bounded size. A shard holds, for each term, its postings in blocks of ``BLOCK``:
the place of the first and last document and the competitive pairs of the block (the highest frequency for each
shortest length), which give the block's highest score whatever the corpus' averages turn out to be; places and
frequencies themselves are packed and compressed.

A shard is searched item by item. Terms are sorted by the highest score they can add; the longest front of them whose
scores together stay below the item's threshold is non-essential: a document with these terms alone is not among the
best. The lists of the other, essential terms are read whole. Of the documents found there, those that can't reach the
threshold with all that the non-essential lists allow are dropped, list by list and block by block: a block is only
decompressed if a document in it passes with the block's highest score. The threshold is the item's lowest kept score
and rises from shard to shard of a task; the best of all tasks are merged at the end.

Statistics (documents, terms, and the documents of each asked term) are those of all shards.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from landgrid.llm import common
from landgrid.shared import saved

BLOCK = 128              # postings
SHARD = 8192             # documents of a shard at most
SHARD_TERMS = 1 << 22    # and terms in them, but for the last document
ITEMS = 1024             # items that a search handles at a time
BEST = 20

# fixed values: characters of a term are letters, digits and all beyond ASCII; A-Z become small
_CHARS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_CHARS).split() if text else []


# -- the index -------------------------------------------------------------------------------------

def _packed(places: np.ndarray, times: np.ndarray) -> bytes:
    """Postings of a block, compressed: steps between places, then frequencies."""
    steps = np.diff(places, prepend=places[:1])
    body = b"".join(a.astype("<u2" if a.max(initial=0) < 1 << 16 else "<u4").tobytes() for a in (steps, times))
    wide = (steps.max(initial=0) >= 1 << 16) + 2 * (times.max(initial=0) >= 1 << 16)
    return bytes([wide]) + zlib.compress(body, 1)


def _unpacked(body: bytes, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    wide, raw = body[0], zlib.decompress(body[1:])
    step, time = ("<u4" if wide & 1 else "<u2"), ("<u4" if wide & 2 else "<u2")
    steps = np.frombuffer(raw, step, n).astype(np.int64)
    return first + np.cumsum(steps), np.frombuffer(raw, time, n, n * (4 if wide & 1 else 2)).astype(np.int64)


def _competitive(times: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """The pairs (frequency, length) of a block that no other pair beats in both."""
    out: list[tuple[int, int]] = []
    for k in np.lexsort((lengths, -times)).tolist():
        if not out or lengths[k] < out[-1][1]:
            out.append((int(times[k]), int(lengths[k])))
    return out


SHARD_DDL = ("documents long, terms long, lengths binary, vocabulary array<binary>, df array<long>, first array<int>, "
             "blocks array<struct<n: int, first: int, last: int, times: array<int>, lengths: array<int>, body: binary>>")


def _shard(ids: pa.Array, lengths: list[int], postings: dict[bytes, list[tuple[int, int]]], names: list[str], kinds: list) -> pa.RecordBatch:
    norm = np.array(lengths, np.int64)
    vocabulary = sorted(postings)
    blocks, first = [], [0]
    for term in vocabulary:
        pairs = np.array(postings[term], np.int64)
        for k in range(0, len(pairs), BLOCK):
            places, times = pairs[k:k + BLOCK, 0], pairs[k:k + BLOCK, 1]
            best = _competitive(times, norm[places])
            blocks.append({"n": len(places), "first": int(places[0]), "last": int(places[-1]), "times": [b[0] for b in best],
                           "lengths": [b[1] for b in best], "body": _packed(places, times)})
        first.append(len(blocks))
    row = [int((norm > 0).sum()), int(norm.sum()), norm.astype("<i4").tobytes(), vocabulary, [len(postings[t]) for t in vocabulary], first, blocks]
    return pa.RecordBatch.from_arrays(
        [pa.array([ids.to_pylist()], pa.list_(ids.type)), *(pa.array([v], t) for v, t in zip(row, kinds))], names=names)


def indexed(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: list[bytes] | None = None) -> DataFrame:
    """One row per shard of the index of all rows; with ``vocabulary``, of these terms only.

    Lengths count all terms. Null texts and texts without a term have no postings and don't count as documents. Rows
    of one id are documents of their own.
    """
    id_kind = docs.schema[key].dataType
    pair = pa.struct([("n", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("times", pa.list_(pa.int32())),
                      ("lengths", pa.list_(pa.int32())), ("body", pa.binary())])
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pair)]
    names = ["ids", "documents", "terms", "lengths", "vocabulary", "df", "first", "blocks"]
    id_type = to_arrow_type(id_kind)
    asked = None if vocabulary is None else frozenset(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, total = [], [], 0
        postings: dict[bytes, list[tuple[int, int]]] = {}
        for batch in batches:
            for key_value, body in zip(batch.column(0), batch.column(1)):
                words = terms(body.as_py())
                if not words:
                    continue
                place = len(ids)
                ids.append(key_value)
                lengths.append(len(words))
                total += len(words)
                for term, times in Counter(words if asked is None else filter(asked.__contains__, words)).items():
                    postings.setdefault(term, []).append((place, times))
                if len(ids) == SHARD or total >= SHARD_TERMS:
                    yield _shard(pa.array([i.as_py() for i in ids], id_type), lengths, postings, names, kinds)
                    ids, lengths, total, postings = [], [], 0, {}
        if ids:
            yield _shard(pa.array([i.as_py() for i in ids], id_type), lengths, postings, names, kinds)

    return docs.select(F.col(key).alias("id"), F.col(text).alias("source")).mapInArrow(
        run, f"ids array<{id_kind.simpleString()}>, {SHARD_DDL}")


# -- the search ------------------------------------------------------------------------------------

class Corpus:
    """Statistics of all shards, and the scores they make of a frequency and a length."""

    def __init__(self, documents: int, total: int, df: dict[bytes, int]):
        self.documents, self.total = documents, max(total, 1)
        self.weight = {t: int(math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))) for t, n in df.items()}

    def damping(self, lengths: np.ndarray) -> np.ndarray:
        return 12 * (100 - 25 + (25 * lengths * self.documents) // self.total)

    def share(self, times: np.ndarray, damping: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * times) // (1000 * times + damping)


class Shard:
    """One row of the index, ready to be searched."""

    def __init__(self, row: dict, corpus: Corpus, asked: Iterable[bytes]):
        self.damping = corpus.damping(np.frombuffer(row["lengths"], "<i4").astype(np.int64))
        self.ids, self.corpus, self.read, self.skipped = row["ids"], corpus, 0, 0
        place = {t: k for k, t in enumerate(row["vocabulary"])}
        self.lists: dict[bytes, tuple] = {}
        for term in asked:
            if term in place and corpus.weight.get(term, 0) > 0:
                k = place[term]
                blocks = row["blocks"][row["first"][k]:row["first"][k + 1]]
                top = np.array([max(corpus.share(np.array(b["times"], np.int64), corpus.damping(np.array(b["lengths"], np.int64)))) for b in blocks])
                self.lists[term] = (blocks, np.array([b["last"] for b in blocks]), top, corpus.weight[term], int(top.max()))
        self.held: dict[tuple[bytes, int], tuple[np.ndarray, np.ndarray]] = {}

    def block(self, term: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and shares of a block; a term of several items is decompressed once a shard."""
        found = self.held.get((term, k))
        if found is None:
            b = self.lists[term][0][k]
            places, times = _unpacked(b["body"], b["first"], b["n"])
            found = self.held[term, k] = places, self.corpus.share(times, self.damping[places])
            self.read += 1
        return found

    def search(self, item: Counter, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents with at least ``threshold`` (and above 0), and maybe of others."""
        lists = sorted((self.lists[t][3] * n * self.lists[t][4], t, self.lists[t][3] * n) for t, n in item.items() if t in self.lists)
        bounds = np.cumsum([b for b, _, _ in lists])
        essential = int(np.searchsorted(bounds, max(threshold, 1), side="left"))        # the first that may reach it
        scores = np.zeros(len(self.ids), np.int64)
        for _, term, weight in lists[essential:]:
            for k in range(len(self.lists[term][0])):
                places, share = self.block(term, k)
                scores[places] += weight * share
        live = np.flatnonzero(scores > 0)
        score = scores[live]
        for at in range(essential - 1, -1, -1):
            rest = int(bounds[at])                          # what this list and all below can add
            kept = score + rest >= threshold
            live, score = live[kept], score[kept]
            if not len(live):
                break
            _, term, weight = lists[at]
            blocks, last, top, _, _ = self.lists[term]
            rest -= lists[at][0]
            where = np.searchsorted(last, live)             # the block that may hold each document
            inside = where < len(blocks)
            best = np.where(inside, top[np.minimum(where, len(blocks) - 1)], 0) * weight
            kept = score + best + rest >= threshold
            self.skipped += len(np.unique(where[inside])) - len(np.unique(where[inside & kept]))
            live, score, where, inside = live[kept], score[kept], where[kept], inside[kept]
            for k in np.unique(where[inside]).tolist():
                places, share = self.block(term, k)
                i, j = np.searchsorted(where, (k, k + 1))
                spot = np.minimum(np.searchsorted(places, live[i:j]), len(places) - 1)
                score[i:j] += np.where(places[spot] == live[i:j], weight * share[spot], 0)
        return live, score


def _best(score: np.ndarray, ids: list, best: int) -> list[tuple[int, object]]:
    order = sorted(range(len(ids)), key=lambda k: (-int(score[k]), ids[k] is None, ids[k]))[:best]
    return [(int(score[k]), ids[k]) for k in order]


def searched(index: DataFrame, items: DataFrame, key: str, text: str, best: int = BEST) -> DataFrame:
    """``key, rank, doc_id, score``: the ``best`` documents of each item over all shards.

    Equal scores go by ascending id, a null id comes last. An item without a term, or with none that a document holds,
    has no row; items that repeat under one id are searched as one row each. Items are taken in blocks of ``ITEMS``.
    """
    spark = index.sparkSession
    totals = index.agg(F.sum("documents").alias("n"), F.sum("terms").alias("l")).first()
    number = items.select(F.col(key).alias("item"), F.col(text).alias("source"))
    rows = saved(number.withColumn("_order", F.monotonically_increasing_id()))
    out, after = None, -1
    while True:
        block = rows.filter(F.col("_order") > after).orderBy("_order").limit(ITEMS).collect()
        if not block:
            break
        after = block[-1]["_order"]
        asked = [(k, Counter(terms(r["source"]))) for k, r in enumerate(block)]
        words = sorted({t for _, c in asked for t in c})
        wanted = spark.createDataFrame([(t,) for t in words], "term binary")
        # as many rows as the items of the block have terms
        counted = (index.select(F.explode(F.arrays_zip("vocabulary", "df")).alias("t")).select(F.col("t.vocabulary").alias("term"), "t.df")
                   .join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("df").alias("df")).collect())
        corpus = Corpus(totals["n"] or 0, totals["l"] or 0, {bytes(r["term"]): r["df"] for r in counted})
        found = saved(_block_search(index, asked, corpus, words, best))
        keys = spark.createDataFrame([(k, r["item"]) for k, r in enumerate(block)], f"place long, {key} {items.schema[key].dataType.simpleString()}")
        order = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
        top = top.join(F.broadcast(keys), "place").select(key, "rank", "doc_id", "score")
        out = top if out is None else out.unionByName(top)
    return out if out is not None else spark.createDataFrame(
        [], f"{key} {items.schema[key].dataType.simpleString()}, rank int, doc_id {index.schema['ids'].dataType.elementType.simpleString()}, score long")


def _block_search(index: DataFrame, asked: list[tuple[int, Counter]], corpus: Corpus, words: list[bytes], best: int) -> DataFrame:
    """``place, doc_id, score``: a heap's content for each item and task."""
    id_kind = index.schema["ids"].dataType.elementType
    id_type = to_arrow_type(id_kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[int, object]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, corpus, words)
                for place, item in asked:
                    heap = heaps.get(place, [])
                    threshold = heap[-1][0] if len(heap) == best else 0
                    live, score = shard.search(item, threshold)
                    if len(live) > 4 * best:               # the others are below the best of this shard
                        enough = score >= np.partition(score, -best)[-best]
                        live, score = live[enough], score[enough]
                    if len(live):
                        both = np.concatenate([np.array([h[0] for h in heap], np.int64), score])
                        heaps[place] = _best(both, [h[1] for h in heap] + [shard.ids[k] for k in live.tolist()], best)
        flat = [(place, i, s) for place, heap in heaps.items() for s, i in heap]
        places, ids, scores = zip(*flat) if flat else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(ids, id_type), pa.array(scores, pa.int64())],
                                         names=["place", "doc_id", "score"])

    return index.mapInArrow(run, f"place long, doc_id {id_kind.simpleString()}, score long")


def item_terms(items: DataFrame, text: str) -> list[bytes] | None:
    """All terms of the items, if there are at most ``ITEMS`` items; the index then need not hold others."""
    rows = items.select(text).limit(ITEMS + 1).collect()
    return sorted({t for r in rows for t in terms(r[0])}) if len(rows) <= ITEMS else None


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", best: int = BEST) -> DataFrame:
    """``item, rank, doc_id, score``: the best documents of every item, through an index of all documents.

    The index holds the items' terms, or all terms where there are more than ``ITEMS`` items. Empty tables on either
    side give no rows; columns besides ids and texts are not read.
    """
    index = saved(indexed(docs, key, text, item_terms(items, text)))
    return searched(index, items, item, text, best)


SQL = """
with texts as materialized (select row_number() over () rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') w from documents),
    asked as (select item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) term from benchmark),
    items as (select item_id, term, count(*) times from asked group by 1, 2),
    corpus as (select count(*) n, sum(len(w))::bigint l from texts where len(w) > 0),
    words as (select rid, len(w) n, unnest(w) term from texts),
    postings as materialized (select rid, n, term, count(*) tf from words semi join items using (term) group by 1, 2, 3),
    weights as (select term, floor(1000 * ln((2 * any_value(corpus.n) + 2) / (2 * count(*) + 1)))::bigint weight
        from postings, corpus group by term),
    scores as (select item_id, rid, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * postings.n * corpus.n) // corpus.l))))::bigint score
        from items join postings using (term) join weights using (term), corpus group by 1, 2),
    placed as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id)::int as rank
        from scores join texts using (rid) where score > 0)
select item_id, rank, doc_id, score from placed where rank <= 20
"""
