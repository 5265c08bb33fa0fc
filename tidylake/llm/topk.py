"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector.  Instead of collecting scores, each
task counts them in a histogram per query over the range in which the query's
k-th score can lie; the counts are summed, the bin that holds the k-th score
becomes the next range, and after a few rounds the range is a single score.  A
last pass keeps the scores above it and, of the ties at it, the smallest ids.

A task sends only bins from its own k-th score up, because lower bins cannot hold
the query's k-th: at most k bins per query, whatever the number of vectors.
Queries are handled in blocks of a bounded size; each block's vectors and ranges
are small enough to broadcast, so memory does not grow with the query set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidylake.llm.common import checkpointed, ref, scratch_path

BINS = 1024
BLOCK_QUERIES = 2048
SLICE = 512
SCHEMA = "query_id long, rank int, vec_id long, score long"
_EXACT = 2.0**53
_FAR = 2**63 - 1  # returned scores are held at +- this


def quantised(column: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors of a list column, and floor(scale * x) of
    their components.  Null vectors, and vectors with a null or non-finite
    component, are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy()
    flat = column.values
    values = np.floor(flat.cast(pa.float64()).to_numpy(zero_copy_only=False) * scale)
    good = np.isfinite(values)
    places, vectors = [], []
    present = column.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(present):
        a, b = ends[i], ends[i + 1]
        if good[a:b].all():
            places.append(i)
            vectors.append(values[a:b])
    return np.array(places, np.int64), vectors


def _usable(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``(id, dim, parts)`` of the rows that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = quantised(batch.column(1), scale)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(places)),
                pa.array([len(v) for v in found], pa.int32()),
                _lists(found)],
                names=["id", "dim", "parts"])

    return vectors.where(ref(id_col).isNotNull() & ref(vector_col).isNotNull()).select(
        ref(id_col).cast("long").alias("id"),
        ref(vector_col).cast("array<double>").alias("parts")).mapInArrow(
        run, "id long, dim int, parts array<double>")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``, exact: as doubles, as 64-bit
    integers or, where these do not suffice, as Python integers."""
    reach = float(np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1])
    if reach < _EXACT:
        return (a @ b.T).astype(np.int64)
    if reach < 2.0**61:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape)
             for m in (a, b)]
    return whole[0] @ whole[1].T


def _long(scores: np.ndarray) -> pa.Array:
    return pa.array([min(max(int(s), -_FAR), _FAR) for s in scores] if scores.dtype == object
                    else scores, pa.int64())


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.float64()))


class _Block:
    """Queries of one block: ids, vectors and the range of each k-th score."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, low: np.ndarray,
                 span: np.ndarray, need: np.ndarray):
        self.ids, self.vectors, self.k = ids, vectors, k
        # the k-th score is the need-th highest of those in [low, low + span)
        self.low, self.span, self.need = low, span, need
        self.width = np.maximum(1, -(-span // BINS))

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Candidate ids and their scores, one row per query; the query's own
        rows are marked."""
        dim = self.vectors.shape[1]
        for batch in batches:
            rows = _matrix(batch.column(2), dim)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(ids), SLICE):
                part = ids[at:at + SLICE]
                yield part, _scores(self.vectors, rows[at:at + SLICE]), part == self.ids[:, None]

    def counts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per query the bins from the task's own k-th score up.  Scores above
        the range are in no bin: they are already counted in ``need``."""
        n = len(self.ids)
        total = np.zeros(n * BINS, np.int64)
        rows = np.arange(n)[:, None] * BINS
        for _, scores, own in self.scored(batches):
            offset = scores - self.low[:, None]
            inside = (offset >= 0) & (offset < self.span[:, None]) & ~own
            bins = offset // self.width[:, None]
            total += np.bincount((rows + bins)[inside].astype(np.int64), minlength=n * BINS)
        total = total.reshape(n, BINS)
        above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1] - total
        q, b = np.nonzero((total > 0) & (above < self.need[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[q, b])],
            names=["q", "bin", "n"])

    def best(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores above the k-th, and the k smallest ids of the ties at it."""
        ties: dict[int, np.ndarray] = {}
        empty = np.zeros(0, np.int64)
        for ids, scores, own in self.scored(batches):
            over = (scores > self.low[:, None]) & ~own
            q, c = np.nonzero(over)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[q]), pa.array(ids[c]), _long(scores[q, c])],
                names=["query_id", "vec_id", "score"])
            at, c = np.nonzero((scores == self.low[:, None]) & ~own)
            for i in np.unique(at):
                ties[i] = np.sort(np.concatenate([ties.get(i, empty), ids[c[at == i]]]))[:self.k]
        for i, found in ties.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), self.ids[i])), pa.array(found),
                 _long(np.full(len(found), self.low[i], self.low.dtype))],
                names=["query_id", "vec_id", "score"])


def _select(block: _Block, rows: DataFrame) -> DataFrame:
    """Narrow the block's ranges until each is one score, then fetch the rows."""
    spark = rows.sparkSession
    while True:
        shared = spark.sparkContext.broadcast(block)
        counts = rows.mapInArrow(lambda it, b=shared: b.value.counts(it), "q int, bin int, n long")
        summed = counts.groupBy("q", "bin").agg(F.sum("n").alias("n"))
        higher = Window.partitionBy("q").orderBy(F.desc("bin"))
        need = spark.createDataFrame(
            pa.table({"q": pa.array(range(len(block.ids)), pa.int32()),
                      "need": pa.array(block.need)}))
        # one row per query of the bounded block reaches the driver
        found = (summed.withColumn("upto", F.sum("n").over(higher)).join(F.broadcast(need), "q")
                 .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n")
                                                           < F.col("need")))
                 .select("q", "bin", (F.col("need") - F.col("upto") + F.col("n")).alias("need"))
                 .toPandas())
        # a query with fewer than k candidates has no k-th score: all are taken
        low, span = block.low - 1, np.zeros_like(block.span)
        need_left = block.need.copy()
        for q, b, n in zip(found["q"], found["bin"], found["need"]):
            width = block.width[q]
            low[q] = block.low[q] + b * width
            span[q] = min(width, block.low[q] + block.span[q] - low[q])
            need_left[q] = n
        shared.unpersist()
        block = _Block(block.ids, block.vectors, block.k, low, span, need_left)
        if (span <= 1).all():
            break
    shared = spark.sparkContext.broadcast(block)
    return rows.mapInArrow(lambda it, b=shared: b.value.best(it),
                           "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``vectors`` with the
    highest inner product with each row of ``queries``, ties to the smaller id.

    Components are ``floor(scale * x)``, so scores are exact integers; the rows are
    chosen by these, and a score that 64 bits cannot hold is returned as +-(2**63 - 1).  Rows of the query's own id are no candidates.
    Rows with a null id or vector, or a null or non-finite component, take no
    part; vectors of another length are no candidates for a query.  Repeated
    candidates count each; of queries that share an id the smallest vector is
    used.  An empty table gives no rows; other columns play no part.
    """
    spark = vectors.sparkSession
    rows = checkpointed(_usable(vectors, id_col, vector_col, scale))
    asked = checkpointed(_usable(queries, id_col, vector_col, scale).groupBy("id").agg(
        F.min(F.struct("dim", "parts")).alias("v")).select("id", "v.dim", "v.parts"))
    path = scratch_path(spark, "topk")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    sizes = asked.groupBy("dim").count().orderBy("dim").collect()  # one row per vector length
    for dim, n in ((r["dim"], r["count"]) for r in sizes):
        same = rows.where(F.col("dim") == dim)
        largest = same.agg(F.max(F.expr(
            "aggregate(parts, 0D, (s, x) -> greatest(s, abs(x)))"))).first()[0]
        if largest is None:
            continue
        n_blocks = math.ceil(n / (BLOCK_QUERIES // 2))
        of_dim = asked.where(F.col("dim") == dim).withColumn(
            "part", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
        for part in range(n_blocks):
            held = of_dim.where(F.col("part") == part).select("id", "parts").toArrow()
            for at in range(0, len(held), BLOCK_QUERIES):
                piece = held.slice(at, BLOCK_QUERIES).combine_chunks()
                ids = piece["id"].to_numpy()
                matrix = _matrix(piece["parts"].combine_chunks(), dim)
                reach = [sum(abs(int(x)) for x in q) * int(largest) for q in matrix.tolist()]
                bound = np.array(reach, np.int64 if max(reach) < 2**61 else object)
                block = _Block(ids, matrix, k, -bound, 2 * bound + 1,
                               np.full(len(ids), k, np.int64))
                (_select(block, same).withColumn("rank", F.row_number().over(order))
                 .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
                 .write.mode("append").parquet(path))
    return spark.read.schema(SCHEMA).parquet(path)
