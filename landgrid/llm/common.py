"""What the text operators share: bytes of Arrow batches, hold-out rules, bounded samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1 << 19          # bytes of text that a kernel works on at a time
SAMPLE_BYTES = 1 << 15   # longer texts are left out of training samples (never out of scoring)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def uniform(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def bounded_sample(rows: DataFrame, key: str, label: str, per_label: int, most_labels: int = 512) -> list[tuple]:
    """``(key, label, weight)`` of at most ``per_label`` rows of each label.

    Which rows are taken depends on their ids alone. ``weight`` is the number of rows each one stands
    for. A threshold on the id's hash, set from the labels' counts, leaves few rows to be ordered.
    """
    counts = (rows.groupBy(label).count().orderBy(F.col("count").desc(), label).limit(most_labels).collect())
    if not counts:
        return []
    sizes = {r[label]: r["count"] for r in counts}
    u = uniform(key, 17)
    kept = F.lit(False)
    for value, n in sizes.items():
        share = min(1.0, (1.5 * per_label + 50) / n)
        kept = kept | ((F.col(label) == F.lit(value)) & (u < F.lit(share)))
    picked = (rows.filter(kept).select(key, label).dropDuplicates([key, label])
              .orderBy(uniform(key, 23), key).limit(2 * per_label * len(sizes) + 100).collect())
    by_label: dict = {}
    for r in picked:
        by_label.setdefault(r[label], []).append(r[key])
    out = []
    for value, keys in sorted(by_label.items(), key=lambda x: str(x[0])):
        keys = keys[:per_label]
        out += [(k, value, sizes[value] / len(keys)) for k in keys]
    return out


def sample_texts(docs: DataFrame, key: str, sample: list[tuple], most_bytes: int = SAMPLE_BYTES) -> list[tuple]:
    """``(text, label, weight)`` of the sampled rows whose text has at most ``most_bytes`` bytes.

    The sample is bounded, so it may be broadcast; one text per id is taken, so the result is bounded.
    """
    if not sample:
        return []
    spark = docs.sparkSession
    chosen = {k: (label, weight) for k, label, weight in sample}
    ids = spark.createDataFrame([(k,) for k in chosen], f"id {docs.schema[key].dataType.simpleString()}")
    rows = (docs.select(F.col(key).alias("id"), F.col("text").alias("t"))
            .filter(F.octet_length("t") <= most_bytes)
            .join(F.broadcast(ids), "id").groupBy("id").agg(F.min("t").alias("t")).orderBy("id"))
    return [(r["t"], *chosen[r["id"]]) for r in rows.collect()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each text begins (with the end of the last); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def spaced(column: pa.Array) -> pa.Array:
    """Lower-case texts with a blank on either side, so that no window of bytes spans two texts."""
    low = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    blank = pa.scalar(" ", pa.large_string())
    return pc.binary_join_element_wise(blank, low, blank, pa.scalar("", pa.large_string()))


def blocks(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Rows ``[first, last)`` whose texts have at most ``limit`` bytes together; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def codepoint(data: np.ndarray, start: int, at: int) -> int:
    """Code points of a text, whose bytes begin at ``start``, before the byte ``at``."""
    return int(np.count_nonzero((data[start:at] & 0xC0) != 0x80))


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with underscores in front until no column has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
