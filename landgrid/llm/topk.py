"""Exact largest inner products: candidates by descending length, rotated partial sums, residual bounds.

Candidates are stored by descending length. Queries come in blocks of bounded size; a block meets
every candidate once, where the candidate lies. Both sides are rotated by the right singular vectors
of a sample (a change of basis, so no inner product changes), which moves most of the length into
the first coordinates. A candidate survives for a query only if

    |q| |c|  >=  threshold                                            (lengths)
    q_head . c_head + |q_tail| |c_tail|  >=  threshold                 (partial sum and residual)

where the threshold is the query's k-th best exact score so far. It starts at the best of a bounded
set of the longest candidates. Bounds have a margin for rounding; scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgrid.shared import saved

K = 10
EVERY = 100              # rows whose id is divisible by it are queries
SCALE = 1024
QUERIES = 4096           # queries of a block
SEEDS = 2048             # longest candidates that set the first thresholds, and the rows the rotation is taken of
HEAD = 0.25              # share of the coordinates in the first partial sum
ROWS = 1024              # candidates of one step in a task
PAIRS = 1 << 16          # pairs scored at a time
EXACT = 1 << 53          # below it sums of integers are exact in a double


def integers(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``key`` and ``v``: floor(scale * x) of every component; null, empty and non-finite vectors are dropped."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return (rows.filter((F.size(vector) > 0) & F.col(key).isNotNull()).filter(~bad)
            .select(F.col(key).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows of two integer matrices."""
    largest = max(1, int(np.abs(q).max(initial=0))) * max(1, int(np.abs(c).max(initial=0))) * max(1, q.shape[1])
    if largest < EXACT:
        return np.einsum("ij,ij->i", q.astype(float), c.astype(float)).astype(np.int64)
    return np.einsum("ij,ij->i", q, c)


class Best:
    """The k best ``(score, smaller id first)`` of each query."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), np.iinfo(np.int64).min)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        k = self.score.shape[1]
        touched = np.unique(query)
        query = np.concatenate([query, np.repeat(touched, k)])
        ids = np.concatenate([ids, self.id[touched].ravel()])
        score = np.concatenate([score, self.score[touched].ravel()])
        order = np.lexsort((ids, -score.astype(float) if np.abs(score).max() < EXACT else np.invert(score), query))
        query, ids, score = query[order], ids[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < k
        self.score[query[kept], place[kept]] = score[kept]
        self.id[query[kept], place[kept]] = ids[kept]

    @property
    def threshold(self) -> np.ndarray:
        """Each query's k-th best; minus infinity while it has fewer."""
        worst = self.score[:, -1]
        return np.where(worst == np.iinfo(np.int64).min, -np.inf, worst.astype(float))


class Block:
    """A block of queries, rotated, that candidates are held against."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rotation: np.ndarray, k: int):
        self.ids, self.vectors, self.rotation, self.k = ids, vectors, rotation, k
        self.head = max(1, int(np.ceil(HEAD * vectors.shape[1]))) if vectors.shape[1] else 0
        turned = vectors @ rotation
        self.front = turned[:, :self.head]
        self.rest = np.sqrt((turned[:, self.head:] ** 2).sum(axis=1))
        self.length = np.sqrt((turned ** 2).sum(axis=1))
        self.best = Best(len(ids), k)
        self.pairs = 0                       # pairs that were scored in full

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        turned = vectors @ self.rotation
        front, rest = turned[:, :self.head], np.sqrt((turned[:, self.head:] ** 2).sum(axis=1))
        length = np.sqrt((turned ** 2).sum(axis=1))
        margin = 1e-9 * self.length * length.max(initial=0) + 1e-6
        floor = self.best.threshold - margin
        open_ = np.flatnonzero(self.length * length.max(initial=0) >= floor)
        for low in range(0, len(open_), 256):
            rows = open_[low:low + 256]
            bound = self.front[rows] @ front.T + self.rest[rows, None] * rest
            q, c = np.nonzero(bound >= floor[rows, None])
            for part in range(0, len(q), PAIRS):
                a, b = rows[q[part:part + PAIRS]], c[part:part + PAIRS]
                other = self.ids[a] != ids[b]
                a, b = a[other], b[other]
                if len(a):
                    self.pairs += len(a)
                    score = _exact(self.vectors[a], vectors[b])
                    worst = self.best.score[a, -1]
                    keep = (score > worst) | (score == worst) & (ids[b] < self.best.id[a, -1])
                    if keep.any():
                        self.best.add(a[keep], ids[b[keep]], score[keep])


def _rotation(vectors: np.ndarray, width: int) -> np.ndarray:
    if not len(vectors):
        return np.eye(width)
    scaled = vectors / max(1.0, float(np.abs(vectors).max()))
    return np.linalg.eigh(scaled.T @ scaled)[1][:, ::-1]      # right singular vectors, the strongest first


def nearest(candidates: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = K,
            block: int = QUERIES, seeds: int = SEEDS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` largest inner products.

    ``is_query`` is a column over ``vec_id``. Vectors of different sizes never meet; rows with a
    query's own id are not its candidates. Repeated rows count as often as they occur; a query id with several
    vectors has the best of all of them.
    """
    spark = candidates.sparkSession
    schema = "query_id long, vec_id long, score long"
    rows = integers(candidates, key, vector).withColumn("width", F.size("v"))
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    # the id's hash parts vectors of one length, however many there are
    order = [F.col("length").desc(), F.xxhash64("vec_id")]
    index = saved(rows.withColumn("length", length).repartitionByRange(*order).sortWithinPartitions(*order))
    found = None
    widths = [r["width"] for r in index.filter(is_query).groupBy("width").count().orderBy("width").collect()]
    for width in widths:
        same = index.filter(F.col("width") == width)
        longest = same.orderBy(F.col("length").desc(), "vec_id").limit(seeds).collect()
        sample = np.array([r["v"] for r in longest], np.int64).reshape(-1, width)
        sample_ids = np.array([r["vec_id"] for r in longest], np.int64)
        rotation = _rotation(sample.astype(float), width)
        asked = same.filter(is_query).select("vec_id", "v").dropDuplicates()
        after = None
        while True:
            rest = asked if after is None else asked.filter(F.struct("vec_id", "v") > after)
            part = rest.orderBy("vec_id", "v").limit(block).collect()
            if not part:
                break
            last = part[-1]
            after = F.struct(F.lit(last["vec_id"]).alias("vec_id"), F.array(*(F.lit(x).cast("long") for x in last["v"])).alias("v"))
            ids = np.array([r["vec_id"] for r in part], np.int64)
            vectors = np.array([r["v"] for r in part], np.int64).reshape(-1, width)
            first = Block(ids, vectors, rotation, k)
            for low in range(0, len(sample), ROWS):
                first.meet(sample_ids[low:low + ROWS], sample[low:low + ROWS])
            shared = spark.sparkContext.broadcast((ids, vectors, rotation, first.best.threshold))
            top = saved(same.select("vec_id", "v").mapInArrow(_search(shared, width, k), schema))
            found = top if found is None else found.unionByName(top)
            if len(part) < block:
                break
    if found is None:
        found = spark.createDataFrame([], schema)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(shared, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, rotation, threshold = shared.value
        block = Block(ids, vectors, rotation, k)
        # the first thresholds are scores that k candidates reach; ties with them must stay
        block.best.score[:, -1] = np.where(np.isfinite(threshold), np.nan_to_num(threshold, neginf=0) - 1, np.iinfo(np.int64).min)
        for batch in batches:
            found, v = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            for low in range(0, len(found), ROWS):
                block.meet(found[low:low + ROWS], v[low:low + ROWS])
        real = block.best.id != np.iinfo(np.int64).max
        query = np.repeat(ids, k).reshape(-1, k)[real]
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(block.best.id[real]), pa.array(block.best.score[real])],
            names=["query_id", "vec_id", "score"])

    return run


def searched(embeddings: DataFrame) -> DataFrame:
    """The ten largest inner products of every hundredth vector with all others.

    Empty table or no query: no rows. Null ids take no part. Ties go to the smaller id.
    """
    return nearest(embeddings, F.col("vec_id") % EVERY == 0)


SQL = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as e from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id as vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % {EVERY} = 0
), r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s
)
select query_id, rank, vec_id, score from r where rank <= {K}
"""
