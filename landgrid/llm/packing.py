"""Packing of examples into training sequences as vector bin packing.

A sequence has three limits: tokens, segments (examples or pieces of one) and loss-bearing tokens.
An example longer than a sequence is first cut into full sequences and a rest. Rests wait in a
bounded pool. A sequence is filled by the dot-product heuristic: of the examples that fit, the one
whose demand has the largest dot product with what is left of the limits is placed next. If none
fits whole and enough room is left, the longest that may be cut gives a piece. What is left over at
the end of a task is cut at powers of two, which need no padding.

Every task packs the rows it reads, so nothing is shuffled and a task's result depends on its
input rows only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrid.llm import common
from landgrid.llm.tokens import Encoder, default_paths

TOKENS = 2048            # tokens of a sequence
SEGMENTS = 256           # pieces of a sequence
END = 1                  # id behind the last token of a document
POOL = 1024              # rests that wait for a place
WORTH_CUTTING = 32       # room for which an example is cut
ROWS = 4096              # pieces sent on at a time
ROWS_WITH_IDS = 256      # with up to 8 KB of ids each


class Packer:
    """Places ``(owner, start, length)`` pieces; ``bears`` tells whether their tokens bear loss."""

    def __init__(self, limits: tuple[int, int, int], first_sequence: int, cut: bool = True):
        self.limits = np.array(limits, float)
        self.next, self.cut = first_sequence, cut
        self.owner, self.start = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.need = np.zeros((0, 3))                       # tokens, segments, loss-bearing tokens

    def add(self, owner: int, size: int, bears: bool) -> Iterator[tuple]:
        """Cut full sequences off an example; its rest joins the pool."""
        most = int(min(self.limits[0], self.limits[2]) if bears else self.limits[0])
        for start in range(0, size - size % most, most):
            yield owner, start, most, self._new(), 0
        if size % most:
            rest = float(size % most)
            self._put(owner, size - size % most, rest, rest if bears else 0.0)

    def _put(self, owner, start, tokens, loss):
        self.owner, self.start = np.append(self.owner, owner), np.append(self.start, start)
        self.need = np.vstack([self.need, [tokens, 1.0, loss]])

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def drain(self, until: int) -> Iterator[tuple]:
        """Fill sequences as long as more than ``until`` examples wait."""
        while len(self.owner) > until:
            left, offset, sequence = self.limits.copy(), 0, self._new()
            gone = np.zeros(len(self.owner), bool)
            while True:
                fits = ~gone & (self.need <= left).all(axis=1)
                if fits.any():
                    gain = (self.need / self.limits) @ (left / self.limits)
                    k = int(np.argmax(np.where(fits, gain, -1.0)))
                    tokens = int(self.need[k, 0])
                    yield int(self.owner[k]), int(self.start[k]), tokens, sequence, offset
                    left -= self.need[k]
                    offset += tokens
                    gone[k] = True
                    continue
                if self.cut and left[1] >= 1 and left[0] >= WORTH_CUTTING:
                    bears = self.need[:, 2] > 0
                    room = np.where(bears, min(left[0], left[2]), left[0])
                    able = ~gone & (room >= WORTH_CUTTING) & (self.need[:, 0] > room)
                    if able.any():
                        k = int(np.argmax(np.where(able, self.need[:, 0], -1.0)))
                        tokens = int(room[k])
                        yield int(self.owner[k]), int(self.start[k]), tokens, sequence, offset
                        left -= [tokens, 1, tokens if bears[k] else 0]
                        offset += tokens
                        self.start[k] += tokens
                        self.need[k] -= [tokens, 0, tokens if bears[k] else 0]
                        continue
                break
            self.owner, self.start, self.need = self.owner[~gone], self.start[~gone], self.need[~gone]

    def finish(self) -> Iterator[tuple]:
        """Place the rest; a last sequence that isn't full is cut at powers of two."""
        placed = list(self.drain(0))
        if not placed:
            return
        last = placed[-1][3]
        tail = [p for p in placed if p[3] == last]
        yield from (p for p in placed if p[3] != last)
        size = sum(p[2] for p in tail)
        if not self.cut or size == self.limits[0]:
            yield from tail
            return
        sequence, room, offset = last, 1 << (size.bit_length() - 1), 0
        for owner, start, length, _, _ in tail:
            while length:
                take = min(length, room - offset)
                yield owner, start, take, sequence, offset
                start, length, offset, size = start + take, length - take, offset + take, size - take
                if offset == room and size:
                    sequence, room, offset = self._new(), 1 << (size.bit_length() - 1), 0


def packed(examples: DataFrame, key: str, text: str = "text", bears_loss: Column | None = None, tokens: int = TOKENS,
           segments: int = SEGMENTS, loss_tokens: int | None = None, cut: bool = True, with_ids: bool = False,
           vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """One row per piece: ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``, ``loss_tokens`` and, on request, ``ids``.

    ``bears_loss`` marks examples whose tokens count for the loss limit (default: all); ``cut=False``
    keeps examples whole unless they exceed a sequence. A null text is empty and has the end id only.
    """
    if vocabulary is None:
        vocabulary, ranks = default_paths()
    limits = (tokens, segments, loss_tokens or tokens)
    name, source, bears = "key", "text", "bears"
    rows = examples.select(F.col(key).alias(name), F.col(text).alias(source),
                           F.coalesce(F.lit(True) if bears_loss is None else bears_loss, F.lit(False)).alias(bears))
    kind = examples.schema[key].dataType
    numbers = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary, ranks)
        packer = Packer(limits, TaskContext.get().partitionId() << 40, cut)
        waiting: dict[int, tuple] = {}           # number of an example: key, ids, loss, tokens not yet placed
        count, out, end = 0, [], np.array([END], "<u4")

        def emit(pieces):
            for owner, start, length, sequence, offset in pieces:
                value, ids, loss, rest = waiting[owner]
                piece = ids[start:start + length]
                out.append((value, start, length, zlib.crc32(piece.tobytes()), len(ids), sequence, offset,
                            length if loss else 0, piece if with_ids else None))
                if rest == length:
                    del waiting[owner]
                else:
                    waiting[owner] = value, ids, loss, rest - length

        def batch_of():
            columns = list(zip(*out))
            arrays = [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:8])]
            names = [name, *numbers]
            if with_ids:
                arrays.append(pa.array([i.astype(np.int32) for i in columns[8]], pa.list_(pa.int32())))
                names.append("ids")
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            keys, bear = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for k, ids in enumerate(encoder.encode(*common.utf8(batch.column(1)))):
                ids = np.concatenate([ids, end])
                waiting[count] = keys[k], ids, bear[k], len(ids)
                emit(packer.add(count, len(ids), bear[k]))
                count += 1
                if len(packer.owner) >= POOL:
                    emit(packer.drain(POOL // 2))
                if len(out) >= (ROWS_WITH_IDS if with_ids else ROWS):
                    yield batch_of()
        emit(packer.finish())
        if out:
            yield batch_of()

    ids = ", ids array<int>" if with_ids else ""
    found = rows.mapInArrow(run, f"{name} {kind.simpleString()}, {', '.join(f'{n} bigint' for n in numbers)}{ids}")
    return found.withColumnRenamed(name, key)


def documents_packed(docs: DataFrame) -> DataFrame:
    """All documents in sequences of 2048 tokens; every token bears loss.

    Empty table: no rows. Repeated rows and null ids: packed like any other, under their id. Ties
    between examples go to the one read first.
    """
    return packed(docs.select("doc_id", "text"), "doc_id")
