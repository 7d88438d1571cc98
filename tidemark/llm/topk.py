"""Exact top-k inner-product search by distributed histogram selection.

Queries are taken a bounded block at a time and every candidate is scored against the block.
Each task counts its scores in bins and reports the bins that can hold a query's kth score:
those from its own kth score upwards, as no global kth score is below a task's. The counts
add up to a global histogram, whose bin with the kth score is cut into bins again, until the
candidates at or above the bin are few or the bin is one score wide. A last pass returns the
candidates there, each task its k best by (score, id), and the k best of them are the answer.
A block's candidates are written before the next block begins, and nothing of it stays on the
driver or the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import staged

#: Queries scored in one go, bins of a histogram, and how many candidates a query may keep for the last pass.
BLOCK_QUERIES, BINS, KEPT = 4096, 512, 4
#: Scores held at a time by a task.
SCORES_AT_A_TIME = 1 << 21
EXACT = 2**53


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """``(id, v)``: components floor(scale * x) as whole numbers.

    Rows with a null id, a null vector, or a null or non-finite component are left out.
    """
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


@dataclass
class Block:
    """Queries of one length, with the range [low, high) that holds each one's kth score."""

    ids: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    above: np.ndarray  # candidates at or above high
    bins: int


def _scored(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(candidate ids, scores by query and candidate), a bounded number of scores at a time."""
    dim = block.vectors.shape[1]
    step = max(1, SCORES_AT_A_TIME // len(block.ids))
    top = int(np.abs(block.vectors).max(initial=0))
    for b in batches:
        lists = b.column(1)
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ids = b.column(0).to_numpy(zero_copy_only=False)
        if (lengths == dim).all():
            vectors = flat.reshape(len(ids), dim)
        else:
            ids = ids[lengths == dim]
            vectors = flat[np.repeat(lengths == dim, lengths)].reshape(len(ids), dim)
        for k in range(0, len(ids), step):
            own = vectors[k:k + step]
            if top * int(np.abs(own).max(initial=0)) * dim < EXACT:
                scores = (block.vectors.astype(float) @ own.T.astype(float)).astype(np.int64)
            else:  # whole numbers of any size, brought into the range of a long
                exact = block.vectors.astype(object) @ own.T.astype(object)
                scores = np.clip(exact, -(2**63) + 1, 2**63 - 1).astype(np.int64)
            yield ids[k:k + step], scores


def _counted(batches: Iterator[pa.RecordBatch], block: Block, k: int) -> Iterator[pa.RecordBatch]:
    """This task's counts (query, bin, n) for the bins that can hold a kth score."""
    n = len(block.ids)
    width = np.maximum(1, -(-(block.high - block.low) // block.bins))
    counts = np.zeros(n * block.bins, dtype=np.int64)
    for ids, scores in _scored(batches, block):
        inside = (scores >= block.low[:, None]) & (scores < block.high[:, None]) & (ids[None, :] != block.ids[:, None])
        q, c = np.nonzero(inside)
        counts += np.bincount(q * block.bins + (scores[q, c] - block.low[q]) // width[q], minlength=n * block.bins)
    counts = counts.reshape(n, block.bins)
    from_top = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
    needed = np.maximum(1, k - block.above)
    report = (counts > 0) & (from_top - counts < needed[:, None])
    q, b = np.nonzero(report)
    yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[q, b])],
                                     names=["q", "bin", "n"])


def _best(batches: Iterator[pa.RecordBatch], block: Block, k: int) -> Iterator[pa.RecordBatch]:
    """This task's k best candidates of each query from its range upwards."""
    empty = np.empty(0, np.int64)
    held = (empty, empty, empty)  # query, score, id

    def kept(q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        first = np.searchsorted(q, q)
        best = np.arange(len(q)) - first < k
        return q[best], score[best], ids[best]

    for ids, scores in _scored(batches, block):
        q, c = np.nonzero((scores >= block.low[:, None]) & (ids[None, :] != block.ids[:, None]))
        if len(q):
            held = kept(*(np.concatenate(x) for x in zip(held, (q, scores[q, c], ids[c]))))
    yield pa.RecordBatch.from_arrays([pa.array(block.ids[held[0]]), pa.array(held[2]), pa.array(held[1])],
                                     names=["query_id", "vec_id", "score"])


def _narrow(block: Block, at: np.ndarray, counts: pa.Table, k: int) -> None:
    """Cut the ranges of the queries ``at`` to the bin with the kth score, by the global counts (q, bin, n)."""
    q, b, n = (counts[c].to_numpy().astype(np.int64) for c in ("q", "bin", "n"))
    order = np.lexsort((-b, q))
    q, b, n = q[order], b[order], n[order]
    first, last = (np.searchsorted(q, np.arange(len(at)), side) for side in ("left", "right"))
    sums = np.concatenate([[0], np.cumsum(n)])
    so_far = block.above[at[q]] + sums[1:] - sums[first[q]]  # candidates in the bin or above it
    place = first + np.bincount(q[so_far < k], minlength=len(at))
    hit = place < last
    # Fewer than k candidates in all: every one in the range counts.
    block.high[at[~hit]] = block.low[at[~hit]]
    block.above[at[~hit]] += (sums[last] - sums[first])[~hit]
    own, place = at[hit], place[hit]
    width = np.maximum(1, -(-(block.high[own] - block.low[own]) // block.bins))
    low = block.low[own] + b[place] * width
    few = so_far[place] <= KEPT * k  # no need to look closer
    block.high[own] = np.where(few, low, np.minimum(block.high[own], low + width))
    block.low[own] = low
    block.above[own] = so_far[place] - n[place]


def _select(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """The last pass's candidates for one block of queries, written."""
    sc = rows.sparkSession.sparkContext
    while True:
        at = np.flatnonzero((block.high - block.low > 1) & (block.above < k))
        if not len(at):
            break
        shared = sc.broadcast(Block(block.ids[at], block.vectors[at], block.low[at], block.high[at], block.above[at], block.bins))  # at most BLOCK_QUERIES vectors
        counts = rows.mapInArrow(lambda b, shared=shared: _counted(b, shared.value, k), "q int, bin int, n long")
        _narrow(block, at, counts.groupBy("q", "bin").agg(F.sum("n").alias("n")).toArrow(), k)  # at most BLOCK_QUERIES * BINS counts
        shared.destroy()
    shared = sc.broadcast(block)  # at most BLOCK_QUERIES vectors
    best = rows.mapInArrow(lambda b, shared=shared: _best(b, shared.value, k), "query_id long, vec_id long, score long")
    best = staged(best, "nearest")
    shared.destroy()
    return best


def top_k(rows: DataFrame, is_query: Callable[[Column], Column], k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 1024) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row with ``is_query(id)``, the k candidates of highest inner product, ties to the smaller id, ranks from 1; fewer if there are fewer.

    Candidates of a query are the rows with another id and a vector of the same length. Vectors
    that are null or hold a null or non-finite component take no part, nor do null ids. Repeated
    candidate rows each count; of query rows with one id the first by vector asks. An empty table
    gives no rows. Scores beyond 64 bits are brought to the nearest long.
    """
    spark = rows.sparkSession
    vectors = staged(whole_vectors(rows, id_col, vector_col, scale), "vectors")
    asked = vectors.where(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))
    asked = staged(asked.withColumn("dim", F.size("v")), "queries")
    found = None
    for dim, n in sorted((r.dim, r["count"]) for r in asked.groupBy("dim").count().collect()):
        own = asked.where(F.col("dim") == dim)
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        longest = vectors.where(F.size("v") == dim).agg(F.max(norm)).first()[0] or 0.0
        blocks = -(-n // BLOCK_QUERIES)
        for number in range(blocks):
            picked = own.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).orderBy("id").collect()
            if not picked:
                continue
            ids = np.array([r.id for r in picked], dtype=np.int64)
            q = np.array([r.v for r in picked], dtype=np.int64).reshape(len(picked), dim)
            # No score is larger than the product of the norms.
            reach = np.minimum(np.sqrt((q.astype(float) ** 2).sum(axis=1)) * longest * (1 + 1e-9) + 2, 2.0**62).astype(np.int64)
            block = Block(ids, q, -reach, reach, np.zeros(len(ids), dtype=np.int64), BINS)
            own_best = _select(vectors, block, k)
            found = own_best if found is None else found.unionByName(own_best)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
