"""Benchmark decontamination: BM25 retrieval of test items with block-max WAND, then overlap checks.

The test items are the indexed collection; every training text is cut into overlapping
passages and every passage is a query. An item's BM25 term weights are divided by the mass
that a passage holding the item would reach, so one threshold (a share of the item) fits
items of any length. Items are numbered by their length, so neighbours' weights are alike, and
every term's postings lie in item order, in blocks of items, with the largest weight in the
whole list and in each block. A passage whose terms' largest weights can't reach the threshold
has no pivot and is skipped. For the others the blocks whose maxima can't reach it are skipped;
in a block left, a cursor stands in each term's postings, the pivot is the first item at which the
block maxima of the terms met so far reach the threshold, the cursors before it jump to it, and
it is scored exactly. So all items above the threshold are found. Many passages take their
steps at the same time, with numpy.

The index is cut into shards that tasks build and write under the shared folder; one at a time is
loaded and sent out.

A retrieved item is a leak only if five-word shingles of both its question and its answer
occur in the text (share ``MIN_OVERLAP`` or more of each).
"""

from __future__ import annotations

import hashlib
import pickle
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.storage import day_folder, staged
from tidemark.operators.ranking import with_global_position

K1, B = 1.2, 0.75
#: Words of a passage, and words from one passage's start to the next.
PASSAGE, STRIDE = 64, 32
#: Share of an item's BM25 mass that a passage must reach.
THRESHOLD = 0.5
SHINGLE_WORDS, MIN_OVERLAP = 5, 0.8
#: Items whose bounds share a block; items of one index (more items: more indexes, one after the other).
BLOCK, SHARD_ITEMS = 8, 32_768
#: A term in one of so many blocks or more has its block maxima in a dense row, the others in lists.
DENSE_ONE_IN = 16
#: Block bounds of passages, and pairs of a passage and a block, that are worked on at a time.
BOUNDS, PAIRS = 1 << 22, 1 << 12
#: Characters that are split into words, and words that are scored, at a time.
SLICE, SCORED_WORDS = 1 << 20, 1 << 18

WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()),
                       T.StructField("bm25", T.DoubleType()), T.StructField("question_overlap", T.DoubleType()),
                       T.StructField("answer_overlap", T.DoubleType())])


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of an item's question and answer: its last sentence is the answer, or the last
    third of its words where it has one sentence."""
    parts = [w for w in (WORD.findall(p.lower()) for p in SENTENCE_END.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 3)
    return words[:cut], words[cut:]


def shingles(ids: list[int]) -> set[tuple[int, ...]]:
    """Five-word shingles; the whole sequence where it is shorter; none of no words."""
    n = min(SHINGLE_WORDS, len(ids))
    return {tuple(ids[i:i + n]) for i in range(len(ids) - n + 1)} if n else set()


@dataclass
class ItemIndex:
    """Inverted index of one shard of items, numbered by length."""

    block: int                               # items of a block
    vocabulary: dict[str, int]
    items: list[int | None]                  # item ids, not always distinct
    most: np.ndarray                         # by term: largest weight
    dense_row: np.ndarray                    # by term: row of ``dense``, the last (empty) one for rare terms
    dense: np.ndarray                        # by frequent term and block: largest weight
    rare_start: np.ndarray                   # by term: where its block maxima start in the next two; none for frequent terms
    rare_block: np.ndarray
    rare_most: np.ndarray
    runs: np.ndarray                         # sorted (block, term) numbers, each a run of postings in item order
    run_start: np.ndarray
    run_most: np.ndarray                     # largest weight of the run
    posting_item: np.ndarray                 # place in the block
    posting_weight: np.ndarray
    sequence: np.ndarray                     # words of all items, questions before answers
    sequence_start: np.ndarray               # by item
    answer_start: np.ndarray                 # by item
    work: Counter = field(default_factory=Counter)  # passages, block bounds, live blocks, pivots scored, postings skipped

    def ids(self, text: str | None) -> np.ndarray:
        """Term numbers of a text's words, -1 for words outside the index; a slice at a time."""
        text, out, at = text or "", [], 0
        get = self.vocabulary.get
        while at < len(text):
            end = at + SLICE
            while end < len(text) and not text[end].isspace():
                end += 1
            words = WORD.findall(text[at:end].lower())
            out.append(np.fromiter((get(w, -1) for w in words), np.int32, len(words)))
            at = end
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def retrieve(self, texts: list[np.ndarray]) -> dict[tuple[int, int], float]:
        """(text, item) → best passage score, for every item that some passage scores at THRESHOLD or above."""
        sizes = np.array([len(t) for t in texts])
        counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - PASSAGE) // STRIDE)), 0)
        if not counts.sum():
            return {}
        all_ids = np.concatenate([*texts, np.full(PASSAGE, -1, np.int32)])
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        owner = np.repeat(np.arange(len(texts)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = first[owner] + nth * STRIDE
        stop = (first + sizes)[owner]
        found: dict[tuple[int, int], float] = {}
        rows = min(SCORED_WORDS // PASSAGE, max(16, BOUNDS // max(self.dense.shape)))
        for k in range(0, len(owner), rows):
            s = slice(k, k + rows)
            at = start[s, None] + np.arange(PASSAGE)
            ids = np.where(at < stop[s, None], all_ids[np.minimum(at, len(all_ids) - 1)], -1)
            ids.sort(axis=1)
            distinct = ids >= 0
            distinct[:, 1:] &= ids[:, 1:] != ids[:, :-1]
            could = np.where(distinct, self.most[ids], 0).sum(axis=1) >= THRESHOLD
            self.work["passages"] += len(could)
            ids, distinct, own = ids[could], distinct[could], owner[s][could]
            if not len(own):
                continue
            live = self._block_bounds(ids[distinct], distinct.sum(axis=1)) >= THRESHOLD
            passage, block = np.nonzero(live)
            self.work["block bounds"] += live.size
            self.work["live blocks"] += len(block)
            ids = np.where(distinct, ids, -1)
            for p in range(0, len(block), PAIRS):
                where = passage[p:p + PAIRS]
                for pair, item, score in self._pivots(ids[where], block[p:p + PAIRS]):
                    for key, value in zip(zip(own[where[pair]].tolist(), item.tolist()), score.tolist()):
                        found[key] = max(found.get(key, 0.0), value)
        return found

    def _block_bounds(self, terms: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Sum of the terms' block maxima by passage and block; ``n`` terms belong to each passage."""
        blocks = self.dense.shape[1]
        passage = np.repeat(np.arange(len(n)), n)
        chosen = np.zeros((len(n), len(self.dense)), np.float32)
        chosen[passage, self.dense_row[terms]] = 1
        bounds = chosen @ self.dense
        first = self.rare_start[terms]
        size = self.rare_start[terms + 1] - first
        if size.sum():
            at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
            cell = np.repeat(passage * blocks, size) + self.rare_block[at]
            bounds = bounds + np.bincount(cell, self.rare_most[at], bounds.size).reshape(bounds.shape)
        return bounds

    def _pivots(self, terms: np.ndarray, block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of a passage's terms (-1: none) and a block: (pair, item, score) of the items at THRESHOLD or above.

        Each step moves every pair to its next pivot, scores it and goes past it; pairs without a pivot are done.
        """
        key = block[:, None].astype(np.int64) * len(self.most) + terms
        run = np.minimum(np.searchsorted(self.runs, key), len(self.runs) - 1)
        known = (terms >= 0) & (self.runs[run] == key)
        held = known.sum(axis=1)
        column = np.arange(held.max(initial=0))
        run = run[known][np.minimum((np.cumsum(held) - held)[:, None] + column, held.sum() - 1)]  # each pair's runs first
        known = column < held[:, None]
        cursor, end = np.where(known, self.run_start[run], 0), np.where(known, self.run_start[run + 1], 0)
        most = np.where(known, self.run_most[run], 0)
        pair, last = np.arange(len(block)), len(self.posting_item) - 1
        while len(pair):
            item = np.where(cursor < end, self.posting_item[np.minimum(cursor, last)], self.block)
            pivot = np.full(len(pair), self.block)
            for place in reversed(range(self.block)):  # the first place whose terms so far can reach the threshold
                pivot[(most * (item <= place)).sum(axis=1, dtype=np.float64) >= THRESHOLD] = place
            on = pivot < self.block
            pair, cursor, end, most, item, pivot = pair[on], cursor[on], end[on], most[on], item[on], pivot[on, None]
            while (behind := item < pivot).any():
                self.work["postings skipped"] += int(behind.sum())
                cursor = cursor + behind
                item = np.where(cursor < end, self.posting_item[np.minimum(cursor, last)], self.block)
            here = item == pivot
            score = np.where(here, self.posting_weight[np.minimum(cursor, last)], 0).sum(axis=1, dtype=np.float64)
            self.work["pivots"] += len(pair)
            hit = score >= THRESHOLD
            yield pair[hit], block[pair[hit]] * self.block + pivot[hit, 0], score[hit]
            cursor = cursor + here

    def wanted(self, item: int) -> tuple[set[tuple[int, ...]], set[tuple[int, ...]]]:
        """Shingles of an item's question and answer."""
        start, cut, end = self.sequence_start[item], self.answer_start[item], self.sequence_start[item + 1]
        return shingles(self.sequence[start:cut].tolist()), shingles(self.sequence[cut:end].tolist())

    def leaks(self, texts: pd.Series) -> Iterator[tuple[int, int | None, float, float, float]]:
        """(row, item id, score, question overlap, answer overlap) for every leak in ``texts``, also of items of one id."""
        held: list[tuple[int, np.ndarray]] = []

        def solve() -> Iterator[tuple[int, int, float, float, float]]:
            by_text = defaultdict(list)
            for (text, item), score in self.retrieve([ids for _, ids in held]).items():
                by_text[text].append((item, score))
            for text, hits in by_text.items():
                ids = held[text][1].tolist()
                here: dict[int, set[tuple[int, ...]]] = {}
                for item, score in sorted(hits):
                    shares = []
                    for wanted in self.wanted(item):
                        size = len(next(iter(wanted), ()))
                        if size not in here:
                            here[size] = set(zip(*(ids[i:] for i in range(size))))
                        shares.append(len(wanted & here[size]) / len(wanted) if wanted else 1.0)
                    if min(shares) >= MIN_OVERLAP:
                        yield held[text][0], self.items[item], score, *shares

        words = 0
        for row, text in enumerate(texts):
            ids = self.ids(text)
            held.append((row, ids))
            words += len(ids)
            if words >= SCORED_WORDS:
                yield from solve()
                held, words = [], 0
        yield from solve()


class Shards(Sequence):
    """Indexes written under the shared folder, at most SHARD_ITEMS items in each; one is loaded when asked for."""

    def __init__(self, written: DataFrame, count: int):
        self.written, self.count = written, count

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, k: int) -> ItemIndex:
        if not 0 <= k < self.count:
            raise IndexError(k)
        return pickle.loads(self.written.where(F.col("shard") == k).first().payload)


def build_indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Shards:
    """Indexes of all items, ``SHARD_ITEMS`` in each (the last: fewer), with BM25 statistics over all items.

    Items are numbered by length, id and text; a shard is built by one task and written. Each
    distinct pair of id and text is an item by itself, null ids included; items without words
    are left out.
    """
    @F.pandas_udf("words array<string>, question array<string>, answer array<string>")
    def parts(texts: pd.Series) -> pd.DataFrame:
        split = [question_and_answer(t) for t in texts]
        return pd.DataFrame({"words": [q + a for q, a in split], "question": [q for q, _ in split],
                             "answer": [a for _, a in split]})

    # The key stands for the pair: ids may be null or shared by several texts.
    key = F.unhex(F.sha2(F.concat(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.lit(":"), "text"), 256))
    own = (items.where(F.col(text_col).isNotNull())
           .select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).distinct()
           .select("item_id", key.alias("key"), parts("text").alias("p")).select("item_id", "key", "p.*").where(F.size("words") > 0))
    spark = items.sparkSession
    own = with_global_position(own, [F.size("words"), F.asc_nulls_first("item_id"), F.col("key")],
                               path=f"{day_folder(spark)}/items-{uuid.uuid4().hex}")
    size = own.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("words")).first()
    shards = -(-size.n // SHARD_ITEMS)
    tf = (own.select("key", F.size("words").alias("length"), F.explode("words").alias("word"))
          .groupBy("key", "length", "word").agg(F.count(F.lit(1)).alias("tf")))
    df = tf.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(float(size.n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(size.words))
    weight = tf.join(df, "word").select("key", "word", (idf * F.col("tf") * (K1 + 1) / norm).alias("weight"))
    weighted = weight.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("word", "weight"))).alias("w"))
    block = BLOCK

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        index = _index(rows.sort_values("position"), block)
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "payload": [pickle.dumps(index)]})

    rows = (own.withColumn("shard", F.floor((F.col("position") - 1) / SHARD_ITEMS)).join(weighted, "key")
            .select("shard", "position", "item_id", "question", "answer", F.col("w.word").alias("terms"), F.col("w.weight").alias("weights")))
    return Shards(staged(rows.groupBy("shard").applyInPandas(build, "shard long, payload binary"), "item-index"), shards)


def _index(rows: pd.DataFrame, block: int) -> ItemIndex:
    n_terms = rows["terms"].map(len).to_numpy()
    codes, names = pd.factorize(np.concatenate(rows["terms"].to_numpy()), sort=True)
    vocabulary = {w: t for t, w in enumerate(names.tolist())}
    question, length = rows["question"].map(len).to_numpy(), (rows["question"].map(len) + rows["answer"].map(len)).to_numpy()
    # A passage can hold no more than (PASSAGE + STRIDE) / 2 words of a long item for sure.
    mass = rows["weights"].map(np.sum).to_numpy() * np.minimum(1.0, (PASSAGE + STRIDE) / 2 / length)
    weight = (np.concatenate(rows["weights"].to_numpy()) / np.repeat(mass, n_terms)).astype(np.float32)
    item = np.repeat(np.arange(len(rows)), n_terms)
    blocks, terms = -(-len(rows) // block), len(vocabulary)
    run_of = item // block * terms + codes
    order = np.lexsort((item, run_of))
    runs, first = np.unique(run_of[order], return_index=True)
    slack = np.float32(1 + 1e-5)  # sums of bounds round otherwise than sums of weights
    run_most = np.maximum.reduceat(weight[order], first) * slack
    term, in_block = runs % terms, runs // terms
    most = np.zeros(terms, np.float32)
    np.maximum.at(most, term, run_most)
    frequent = np.bincount(term, minlength=terms) * DENSE_ONE_IN >= blocks
    dense_row = np.where(frequent, np.cumsum(frequent) - 1, frequent.sum())
    dense = np.zeros((frequent.sum() + 1, blocks), np.float32)
    own = frequent[term]
    dense[dense_row[term[own]], in_block[own]] = run_most[own]
    rare = np.flatnonzero(~own)
    rare = rare[np.argsort(term[rare], kind="stable")]
    rare_start = np.concatenate(([0], np.cumsum(np.bincount(term[rare], minlength=terms))))
    words = [vocabulary[w] for q, a in zip(rows["question"], rows["answer"]) for part in (q, a) for w in part]
    start = np.concatenate(([0], np.cumsum(length)))
    return ItemIndex(block, vocabulary, [None if pd.isna(i) else int(i) for i in rows["item_id"]], most, dense_row, dense,
                     rare_start, in_block[rare], run_most[rare], runs, np.append(first, len(order)), run_most,
                     (item % block)[order].astype(np.int8), weight[order], np.array(words, np.int32), start, start[:-1] + question)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, bm25, question_overlap, answer_overlap)``: a row for every leak of an item into a row of ``docs``.

    Null and empty texts hold no leak. Rows are looked at one by one, so repeated rows and null
    ids give a row each. An item id gives one row for a row of ``docs``, however many of the id's
    texts it holds: that of the best score (items without an id count as of one id). Empty tables
    of items or documents give no rows. Whole texts are read, in slices. Other columns are not
    looked at. ``docs`` is read once for each shard of the index.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([*RESULT.fields, T.StructField("text_key", T.BinaryType())])
    found = None
    for k, index in enumerate(build_indexes(items)):
        shared = spark.sparkContext.broadcast(index)  # at most SHARD_ITEMS items
        part = staged(own.mapInPandas(_scan(shared), schema), "leaks").withColumn("shard", F.lit(k))
        shared.unpersist()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], RESULT)
    # Equal rows hold the same leaks, as many in each shard as there are such rows.
    best = F.max(F.struct(*RESULT.names[2:])).alias("best")
    each = found.groupBy("shard", "doc_id", "text_key", "item_id").agg(best, F.count(F.lit(1)).alias("copies"))
    whole = each.groupBy("doc_id", "text_key", "item_id").agg(F.max("best").alias("best"), F.max("copies").alias("copies"))
    return (whole.select("doc_id", "item_id", "best.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy"))


def _scan(shared):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            best: dict[tuple[int, int | None], tuple[float, float, float]] = {}
            for row, item, *shares in shared.value.leaks(pdf["text"]):
                best[row, item] = max(best.get((row, item), (0.0, 0.0, 0.0)), tuple(shares))
            rows = [(pdf["doc_id"].iloc[row], item, *shares, hashlib.sha256(pdf["text"].iloc[row].encode()).digest())
                    for (row, item), shares in best.items()]
            yield pd.DataFrame(rows, columns=[*RESULT.names, "text_key"]).astype({"doc_id": "Int64", "item_id": "Int64"})
    return scan


def _leaking(shared):
    """A function of a text column that looks for the items of one index."""
    @F.pandas_udf("boolean")
    def leaking(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), dtype=bool)
        for row, *_ in shared.value.leaks(texts):
            out[row] = True
        return pd.Series(out)
    return leaking


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no leak, with their columns; null and empty texts hold none.

    ``docs`` is read once for each shard of the index; what one shard keeps is written before the next.
    """
    shards = build_indexes(items)
    for k, index in enumerate(shards):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # at most SHARD_ITEMS items
        docs = docs.where(~_leaking(shared)(F.col(text_col)))
        if k + 1 < len(shards):
            docs = staged(docs, "without-leaks")
            shared.unpersist()
    return docs
