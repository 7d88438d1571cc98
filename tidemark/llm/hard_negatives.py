"""Hard-negative mining by a secondary-sort shuffle.

For an anchor, the other rows of its label with the highest scores are its positives; a row of
another label is a hard negative of a positive when its score lies in a window below the
positive's. Scored pairs get the key (anchor, descending score, kind, id): they are dealt out by
anchor and sorted within the partitions by the whole key. A streaming pass then meets a positive
before every negative of its window, opens the window there and hands out negatives until it has
enough; it holds one anchor's few windows and no list of rows.

Only pairs that can matter are shuffled. Anchors are taken a bounded block at a time, and every
row is scored against the block twice: first a task keeps each anchor's best rows of the same
label, as no other row of the task can be among the first positives; then, with the positives
known, a task keeps each window's best rows of other labels. What is kept of a block is written
to the shared folder before the next block, so the driver and the executors hold one block only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import staged

#: Anchors scored in one go, and scores held at a time by a task.
BLOCK_ANCHORS, SCORES_AT_A_TIME = 4096, 1 << 19
#: Whole numbers below it are exact as doubles.
EXACT = 2**53
#: A negative's score, in hundredths of its positive's: a fixed window unless the caller names another.
LOW, HIGH = 30, 90
POSITIVE, NEGATIVE = 0, 1
PAIRS = "anchor_id long, score long, kind int, other_id long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def labelled_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``(id, label, v)``: components floor(scale * x). Rows with a null id, label or vector, or a null or non-finite component, are left out."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
    return whole.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


@dataclass
class Block:
    """Anchors of one length. ``low``, ``high``: the windows of each one's positives (columns), empty where low > high."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    at_a_time: int  # scores held by a task
    low: np.ndarray = field(default_factory=lambda: np.empty((0, 0), dtype=np.int64))
    high: np.ndarray = field(default_factory=lambda: np.empty((0, 0), dtype=np.int64))


def _scored(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, scores by anchor and row) of the rows of the block's length, a bounded number of scores at a time."""
    dim, step = block.vectors.shape[1], max(1, block.at_a_time // len(block.ids))
    top, anchors = int(np.abs(block.vectors).max(initial=0)), block.vectors.astype(float)
    for b in batches:
        lists = b.column(2)
        fits = np.diff(lists.offsets.to_numpy()) == dim
        ids, labels = (b.column(c).to_numpy(zero_copy_only=False)[fits] for c in (0, 1))
        vectors = (lists if fits.all() else lists.filter(pa.array(fits))).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
        for k in range(0, len(ids), step):
            own = vectors[k:k + step]
            if top * int(np.abs(own).max(initial=0)) * dim < EXACT:
                scores = (anchors @ own.T.astype(float)).astype(np.int64)
            else:  # whole numbers of any size, brought into the range of a long
                scores = np.clip(block.vectors.astype(object) @ own.T.astype(object), -(2**63) + 1, 2**63 - 1).astype(np.int64)
            yield ids[k:k + step], labels[k:k + step], scores


class _Best:
    """The k best (score, id) of each of many lists; ``least`` is the score from which a row can still enter a list."""

    def __init__(self, lists: int, k: int):
        self.k, self.least = k, np.full(lists, np.iinfo(np.int64).min)
        self.list, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        where, score, id_ = (np.concatenate(x) for x in ((self.list, lists), (self.score, scores), (self.id, ids)))
        order = np.lexsort((id_, -score, where))
        where, score, id_ = where[order], score[order], id_[order]
        place = np.arange(len(where)) - np.searchsorted(where, where)
        kth = place == self.k - 1
        self.least[where[kth]] = score[kth]
        kept = place < self.k
        self.list, self.score, self.id = where[kept], score[kept], id_[kept]


def _pairs(anchors: np.ndarray, scores: np.ndarray, kind: int, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(scores), pa.array(np.full(len(ids), kind, dtype=np.int32)), pa.array(ids)],
                                      names=["anchor_id", "score", "kind", "other_id"])


def _own_positives(batches: Iterator[pa.RecordBatch], block: Block, k: int) -> Iterator[pa.RecordBatch]:
    """A task's k best rows of each anchor's label."""
    best = _Best(len(block.ids), k)
    for ids, labels, scores in _scored(batches, block):
        a, r = np.nonzero((scores >= best.least[:, None]) & (labels[None, :] == block.labels[:, None]) & (ids[None, :] != block.ids[:, None]))
        best.add(a, scores[a, r], ids[r])
    yield _pairs(block.ids[best.list], best.score, POSITIVE, best.id)


def _own_negatives(batches: Iterator[pa.RecordBatch], block: Block, k: int) -> Iterator[pa.RecordBatch]:
    """A task's k best rows of other labels in each window; a row in several windows of an anchor comes once."""
    n, windows = block.low.shape
    best = [_Best(n, k) for _ in range(windows)]
    for ids, labels, scores in _scored(batches, block):
        other = (labels[None, :] != block.labels[:, None]) & (ids[None, :] != block.ids[:, None])
        for w in range(windows):
            a, r = np.nonzero(other & (scores >= np.maximum(block.low[:, w], best[w].least)[:, None]) & (scores <= block.high[:, w][:, None]))
            best[w].add(a, scores[a, r], ids[r])
    # Repeated rows of one id stand side by side in each window's list; their places there tell them apart.
    found = [np.stack([b.list, b.score, b.id, np.zeros_like(b.id)]) for b in best if len(b.id)]
    for held in found:
        held[3] = _nth_of_equals(held[:3])
    a, score, ids, _ = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((4, 0), dtype=np.int64)
    yield _pairs(block.ids[a], score, NEGATIVE, ids)


def _nth_of_equals(columns: np.ndarray) -> np.ndarray:
    """How many equal columns stand just before each column."""
    n = columns.shape[1]
    starts = np.ones(n, dtype=bool)
    starts[1:] = (columns[:, 1:] != columns[:, :-1]).any(axis=0)
    return np.arange(n) - np.maximum.accumulate(np.where(starts, np.arange(n), 0))


def _mined(batches: Iterator[pa.RecordBatch], per_positive: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Sorted pairs → mined rows. Held: one anchor's open windows, and a batch's output."""
    anchor, windows = None, []  # a window: positive's id, its score, negatives handed out
    for b in batches:
        out: list[tuple] = []
        for own, score, kind, other in zip(*(b.column(c).to_pylist() for c in range(4))):
            if own != anchor:
                anchor, windows = own, []
            if kind == POSITIVE:
                windows.append([other, score, 0])
                continue
            for w in windows:
                if w[2] < per_positive and low * w[1] <= 100 * score <= high * w[1]:
                    w[2] += 1
                    out.append((own, w[0], w[2], other, w[1], score))
        columns = list(zip(*out)) if out else [[]] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)],
                                         names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


def _block_pairs(vectors: DataFrame, block: Block, positives: int, per_positive: int, low: int, high: int) -> DataFrame:
    """The scored pairs that can matter for one block of anchors, written under the shared folder."""
    sc = vectors.sparkSession.sparkContext
    shared = sc.broadcast(block)  # at most BLOCK_ANCHORS vectors
    near = vectors.mapInArrow(lambda b: _own_positives(b, shared.value, positives), PAIRS)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    near = staged(near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= positives).drop("_n"), "positives")
    known: dict[int, list[int]] = {}
    for r in near.select("anchor_id", "score").collect():  # at most ``positives`` rows an anchor of the block
        known.setdefault(r.anchor_id, []).append(r.score)
    shared.destroy()
    block.low, block.high = np.ones((len(block.ids), positives), dtype=np.int64), np.zeros((len(block.ids), positives), dtype=np.int64)
    for i, own in enumerate(block.ids):
        for w, score in enumerate(sorted(known.get(int(own), ()), reverse=True)):
            block.low[i, w], block.high[i, w] = -(-low * score // 100), high * score // 100
    shared = sc.broadcast(block)
    far = staged(vectors.mapInArrow(lambda b: _own_negatives(b, shared.value, per_positive), PAIRS), "negatives")
    shared.destroy()
    return near.unionByName(far)


def mine_hard_negatives(rows: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5, per_positive: int = 10,
                        id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
                        low: int = LOW, high: int = HIGH) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``, ranks from 1.

    Anchors are the ids with ``is_anchor(id)``. An anchor's positives are its first ``positives`` rows of another id and the
    same label, by descending integer inner product, then id. A positive's negatives are the first ``per_positive`` rows, in
    the same order, of another label with low * positive_score <= 100 * score <= high * positive_score; a positive with a
    score below zero has an empty window. Rows of another vector length are no partners. Rows that lack an id, a label or a
    finite vector take no part. Repeated rows each count as partners; of several rows with one anchor id the first by
    (vector, label) asks. Ties go to the smaller id. An empty table gives no rows; extra columns are not looked at.
    Windows at least one wide below their positive are asked for: 0 <= low <= high < 100.
    """
    if not 0 <= low <= high < 100:
        raise ValueError("a window must lie below its positive: 0 <= low <= high < 100")
    spark = rows.sparkSession
    vectors = staged(labelled_vectors(rows, id_col, vector_col, label_col, scale), "vectors")
    first = F.min(F.struct("v", "label")).alias("first")
    asked = vectors.where(is_anchor(F.col("id"))).groupBy("id").agg(first).select("id", "first.*")
    asked = staged(asked.withColumn("dim", F.size("v")), "anchors")
    pairs = None
    for dim, n in sorted((r.dim, r["count"]) for r in asked.groupBy("dim").count().collect()):
        blocks = -(-n // BLOCK_ANCHORS)
        for number in range(blocks):
            picked = asked.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == number)).orderBy("id").collect()
            if not picked:
                continue
            block = Block(np.array([r.id for r in picked], dtype=np.int64), np.array([r.label for r in picked], dtype=np.int64),
                          np.array([r.v for r in picked], dtype=np.int64).reshape(len(picked), dim), SCORES_AT_A_TIME)
            own = _block_pairs(vectors, block, positives, per_positive, low, high)
            pairs = own if pairs is None else pairs.unionByName(own)
    if pairs is None:
        return spark.createDataFrame([], MINED)
    # The secondary sort: dealt by anchor, sorted by the whole key; positives come before negatives of their own score.
    keyed = pairs.repartition("anchor_id").sortWithinPartitions("anchor_id", F.desc("score"), "kind", "other_id")
    return keyed.mapInArrow(lambda b: _mined(b, per_positive, low, high), MINED)
