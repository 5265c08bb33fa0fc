"""Hard-negative mining with an STR-packed R-tree.

For each anchor: its best rows of the same label (positives), and for each positive the
best rows of other labels whose score lies in a window around the positive's score.
A score is the integer inner product of quantised vectors.

The index: rows are dealt into shards by range of (label, first component, id), so that a
shard is the outer slab of a sort-tile-recursive packing and a frequent label or vector
fills several shards.  Inside a shard each label's rows are tiled on, coordinate by
coordinate in order of variance, into leaves of ``LEAF`` rows; ``FANOUT`` neighbouring
boxes make a box of the next level.  A box stores the minimum and maximum of every
coordinate.  Shards are stored as a table, one packed row each.

The search: an anchor's inner product with any row of a box lies between the sums of the
smaller and of the larger of ``a * low`` and ``a * high`` over the coordinates.  A
best-first queue opens the box with the highest upper end; a box is dropped if its
interval misses every score window, or its upper end is strictly below the k-th score
found so far (equal scores can still win by id).  Anchors are packed into blocks, and
each (shard, block) pair is one row of a join, so neither anchors nor candidates pass
through the driver, the number of jobs does not depend on their number, and a task
holds one shard and one block.

Scores are exact: products that could leave a double's 53 bits are summed as Python
integers.  A score outside 64 bits is held at the ends of that range.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidylake.llm.common import checkpointed, ref
from tidylake.llm.topk import quantised

LEAF, FANOUT = 128, 16
#: Rows of a shard and anchors of a block: what a task holds, and the unit of recovery.
SHARD_ROWS, BLOCK_ROWS = 16_384, 2_048
#: Components of a shard or a block together, for long vectors.
PACKED_COMPONENTS = 4_194_304
_EXACT = 2.0**53
_LOW, _HIGH = -2**63, 2**63 - 1
WINDOW = ["place", "positive_id", "positive_score", "low", "high"]


# -- the tree -------------------------------------------------------------------

def str_order(rows: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Order of the rows in which every ``leaf`` neighbours make a tile: sorted by a
    coordinate, cut into slabs, each slab sorted by the next one and so on.  Equal
    values keep the order given."""
    axes = np.argsort(-rows.var(axis=0), kind="stable") if len(rows) else []

    def tiled(places: np.ndarray, depth: int) -> np.ndarray:
        leaves = math.ceil(len(places) / leaf)
        if leaves <= 1 or depth == len(axes):
            return places
        places = places[np.argsort(rows[places, axes[depth]], kind="stable")]
        slabs = math.ceil(leaves ** (1 / (len(axes) - depth)))
        if slabs <= 1:
            return tiled(places, depth + 1)
        size = math.ceil(leaves / slabs) * leaf
        return np.concatenate([tiled(places[at:at + size], depth + 1)
                               for at in range(0, len(places), size)])

    return tiled(np.arange(len(rows)), 0)


class Tree:
    """Rows of one label in tiles, and their boxes level by level (leaves first)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        order = str_order(rows, leaf)
        self.ids, self.rows, self.leaf, self.fanout = ids[order], rows[order], leaf, fanout
        starts = np.arange(0, len(rows), leaf)
        self.levels = [(np.minimum.reduceat(self.rows, starts), np.maximum.reduceat(self.rows, starts))]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), fanout)
            self.levels.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))
        self.largest = float(np.abs(rows).max()) if rows.size else 0.0

    def bounds(self, level: int, first: int, last: int, up: np.ndarray, down: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that a row of each box can have."""
        low, high = (x[first:last] for x in self.levels[level])
        return low @ up + high @ down, high @ up + low @ down

    def search(self, anchor: np.ndarray, found: list["Best"], opened: list[int] | None = None) -> None:
        """Offer rows to all of ``found``, boxes with the highest upper end first."""
        reach = self.largest * float(np.abs(anchor).sum())
        exact = reach < _EXACT
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        # beyond that, widen the intervals by more than the rounding of their sums
        slack = 0.0 if exact else reach * len(anchor) * 2.0**-50
        top = len(self.levels) - 1
        queue: list[tuple[float, int, int]] = []

        def enter(level: int, first: int, last: int) -> None:
            least, most = self.bounds(level, first, last, up, down)
            for i, (a, b) in enumerate(zip((least - slack).tolist(), (most + slack).tolist())):
                if any(f.can_hold(a, b) for f in found):
                    heapq.heappush(queue, (-b, level, first + i, a))

        enter(top, 0, len(self.levels[top][0]))
        while queue:
            most, level, box, least = heapq.heappop(queue)
            if not any(f.can_hold(least, -most) for f in found):
                continue
            if level:
                first = box * self.fanout
                enter(level - 1, first, min(first + self.fanout, len(self.levels[level - 1][0])))
                continue
            part = slice(box * self.leaf, (box + 1) * self.leaf)
            if opened is not None:
                opened.append(box)
            if exact:
                scores = (self.rows[part] @ anchor).astype(np.int64)
            else:
                whole = [int(x) for x in anchor.tolist()]
                scores = np.array([min(max(sum(a * int(x) for a, x in zip(whole, r)), _LOW), _HIGH)
                                   for r in self.rows[part].tolist()], np.int64)
            for f in found:
                f.offer(scores, self.ids[part])


class Best:
    """The ``k`` highest scores within [low, high] seen so far, ties to the smaller id;
    rows with the id ``own`` do not count."""

    def __init__(self, k: int, low: float = -math.inf, high: float = math.inf,
                 own: int | None = None):
        self.k, self.low, self.high, self.own = k, low, high, own
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def can_hold(self, least: float, most: float) -> bool:
        """Whether a box with scores in [least, most] can hold a row that counts."""
        if most < self.low or least > self.high:
            return False
        return len(self.scores) < self.k or most >= self.scores[-1]

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        floor = self.scores[-1] if len(self.scores) >= self.k else self.low
        good = (scores >= max(floor, self.low)) & (scores <= self.high)
        if self.own is not None:
            good &= ids != self.own
        if good.any():
            scores = np.concatenate([self.scores, scores[good]])
            ids = np.concatenate([self.ids, ids[good]])
            first = np.lexsort((ids, ~scores))
            self.scores, self.ids = scores[first[:self.k]], ids[first[:self.k]]


# -- packed shards and blocks ---------------------------------------------------

def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """``id, label, dim, parts`` of the rows that take part, components as
    ``floor(scale * x)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = quantised(batch.column(2), scale)
            places = pa.array(places)
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(places), batch.column(1).take(places),
                 pa.array([len(v) for v in found], pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.float64()))],
                names=["id", "label", "dim", "parts"])

    rows = df.select(ref(id_col).cast("long").alias("id"), ref(label_col).cast("long").alias("label"),
                     ref(vector_col).cast("array<double>").alias("parts"))
    rows = rows.where("id is not null and label is not null and parts is not null")
    return rows.mapInArrow(run, "id long, label long, dim int, parts array<double>")


def _packed(rows: DataFrame, most: int) -> DataFrame:
    """``dim, ids, labels, parts`` (and ``windows``, where ``rows`` have it): the rows of
    each partition in their order, in lists of at most ``most`` rows and of one vector
    length."""
    more = [c for c in rows.columns if c == "windows"]
    kind = pa.list_(pa.list_(pa.struct([(c, pa.int64()) for c in WINDOW])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, labels, parts, *windows = zip(*held.pop(dim))
            return pa.RecordBatch.from_arrays([
                pa.array([dim], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([labels], pa.list_(pa.int64())),
                pa.array([np.concatenate(parts).tobytes()], pa.binary()),
                *[pa.array([w], kind) for w in windows]],
                names=["dim", "ids", "labels", "parts", *more])

        for batch in batches:
            ids, labels, dims = (batch.column(i).to_pylist() for i in range(3))
            flat, ends = batch.column(3).values.to_numpy(), batch.column(3).offsets.to_numpy()
            vectors = [flat[a:b].copy() for a, b in zip(ends[:-1], ends[1:])]
            for dim, row in zip(dims, zip(ids, labels, vectors, *[
                    batch.column(4).to_pylist() for _ in more])):
                one = held.setdefault(dim, [])
                one.append(row)
                if len(one) >= max(1, min(most, PACKED_COMPONENTS // max(dim, 1))):
                    yield out(dim)
        for dim in list(held):
            yield out(dim)

    window = f"array<array<struct<{', '.join(f'{c}: long' for c in WINDOW)}>>>"
    return rows.mapInArrow(run, ", ".join(["dim int, ids array<long>, labels array<long>, parts binary",
                                           *[f"windows {window}" for _ in more]]))


def _matrix(parts: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(parts, np.float64).reshape(n, dim)


def _trees(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> dict[int, Tree]:
    return {int(k): Tree(ids[labels == k], rows[labels == k]) for k in np.unique(labels)}


def _met(shards: DataFrame, blocks: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run(trees, block)`` for every shard and block of one vector length, as rows.

    Both are numbered and repeated for each other's numbers (a list of numbers per vector
    length), and meet by an equi-join: a task reads one packed shard and one packed
    block at a time."""
    left = shards.withColumn("shard", F.monotonically_increasing_id())
    right = blocks.withColumn("block", F.monotonically_increasing_id())
    lefts = left.groupBy("dim").agg(F.collect_list("shard").alias("of"))
    rights = right.groupBy("dim").agg(F.collect_list("block").alias("of"))
    left = left.join(rights, "dim").select(
        "shard", F.explode("of").alias("block"), F.col("ids").alias("shard_ids"),
        F.col("labels").alias("shard_labels"), F.col("parts").alias("shard_parts"))
    pairs = left.join(right.join(lefts, "dim").withColumn("shard", F.explode("of")).drop("of"),
                      ["shard", "block"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(len(batch))):
                ids = np.array(row["shard_ids"], np.int64)
                trees = _trees(ids, np.array(row["shard_labels"], np.int64),
                               _matrix(row["shard_parts"], len(ids), row["dim"]))
                vectors = _matrix(row["parts"], len(row["ids"]), row["dim"])
                yield from run(trees, row["ids"], row["labels"], vectors, row.get("windows"))

    return pairs.mapInArrow(each, schema)


def _record(names: list[str], columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in columns],
        names=names)


def _own_label(k: int) -> Callable:
    def run(trees: dict[int, Tree], ids: list, labels: list, vectors: np.ndarray, _) -> Iterator:
        out: list[list[np.ndarray]] = [[], [], []]
        for anchor, label, vector in zip(ids, labels, vectors):
            if label in trees:
                best = Best(k, own=anchor)
                trees[label].search(vector, [best])
                for column, part in zip(out, (np.full(len(best.ids), anchor), best.ids, best.scores)):
                    column.append(part)
        yield _record(["anchor_id", "vec_id", "score"], out)
    return run


def _other_labels(k: int) -> Callable:
    def run(trees: dict[int, Tree], ids: list, labels: list, vectors: np.ndarray,
            windows: list) -> Iterator:
        out: list[list[np.ndarray]] = [[] for _ in range(6)]
        for anchor, label, vector, asked in zip(ids, labels, vectors, windows):
            found = [(w, Best(k, w["low"], w["high"], own=anchor)) for w in asked]
            for other, tree in trees.items():
                if other != label:
                    tree.search(vector, [b for _, b in found])
            for w, best in found:
                same = [np.full(len(best.ids), x) for x in (
                    anchor, w["place"], w["positive_id"], w["positive_score"])]
                for column, part in zip(out, [*same, best.ids, best.scores]):
                    column.append(part)
        yield _record(["anchor_id", "place", "positive_id", "positive_score", "negative_id",
                       "negative_score"], out)
    return run


def mine(df: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 10,
         window: tuple[int, int] = (30, 90), id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", scale: float = 256.0) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for
    each row of ``anchors`` (with the columns of ``df``) its ``n_positives`` best other rows
    of ``df`` of the same label, and for each of them the ``n_negatives`` best rows of other
    labels with ``window[0] * positive <= 100 * negative <= window[1] * positive``.

    Higher scores come first, ties to the smaller id.  Rows with a null id, label or
    vector, or a null or non-finite component, take no part; vectors of another length
    never meet.  Rows that share an id are not negatives or positives of each other; a
    repeated candidate counts each time (a repeated positive has its rows repeated), a
    repeated anchor once (its smallest label and vector).  An anchor without positives, or a window without rows, gives no rows, as
    does an empty table; other columns play no part.
    """
    rows = checkpointed(usable(df, id_col, vector_col, label_col, scale))
    spread = max(1, math.ceil(rows.count() / SHARD_ROWS))
    first = F.coalesce(F.get("parts", F.lit(0)), F.lit(0.0))
    shards = checkpointed(_packed(
        rows.withColumn("first", first).repartitionByRange(spread, "dim", "label", "first", "id")
        .sortWithinPartitions("dim", "label", "first", "id").select("id", "label", "dim", "parts"),
        SHARD_ROWS))
    asked = checkpointed(usable(anchors, id_col, vector_col, label_col, scale).groupBy("id").agg(
        F.min(F.struct("label", "dim", "parts")).alias("v")).select("id", "v.label", "v.dim", "v.parts"))
    blocks = checkpointed(_packed(asked, BLOCK_ROWS))
    near = _met(shards, blocks, _own_label(n_positives), "anchor_id long, vec_id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    low, high = (F.lit(x).cast("decimal(20,0)") * F.col("score") / 100 for x in window)
    positives = near.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= n_positives).select(
        "anchor_id", F.col("place").cast("long").alias("place"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"), F.ceil(low).cast("long").alias("low"),
        F.floor(high).cast("long").alias("high")).where("low <= high")
    windows = positives.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct(*WINDOW))).alias("windows"))
    asking = checkpointed(_packed(asked.join(windows, F.col("id") == F.col("anchor_id")).select(
        "id", "label", "dim", "parts", "windows"), BLOCK_ROWS))
    far = _met(shards, asking, _other_labels(n_negatives),
               "anchor_id long, place long, positive_id long, positive_score long, "
               "negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    return far.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
