"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's fingerprint has 64 bits; two fingerprints are linked when at most
``max_bits`` of them differ, and a class is a connected component of links.

The 64 bits are dealt into parts, each with a threshold t of its own. If the values
(t + 1) of all parts sum to ``max_bits + 1``, two fingerprints at most ``max_bits``
apart are within t bits of each other in at least one part. Bits that vary together
share a part, and a dynamic program picks the thresholds with the least estimated
work. Within a part, a fingerprint is filed under its own bits with up to t set bits
cleared: two values at most t bits apart have such a key in common. All fingerprints
under one key are compared exactly.

Groups of one key: a key with many fingerprints is cut into blocks by hash and every
pair of blocks is a group of its own, so a group is bounded and none is dropped. A group
returns a spanning forest of its links, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.storage import numbered, staged

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
#: Fingerprints looked at for choosing parts and thresholds; results don't depend on them.
PLAN_SAMPLE = 2048
#: Fingerprints of one key that are compared in one group; larger keys are cut into blocks.
BLOCK = 1024
#: Bytes of a text that are split into words at a time.
SLICE = 1 << 20
#: Microseconds for filing a fingerprint under a key, and for comparing two.
FILE_COST, COMPARE_COST = 2.0, 0.02


# --- fingerprints -------------------------------------------------------------------

def _slices(data: bytes) -> Iterator[list[bytes]]:
    """The words of ``data``, a bounded number of bytes at a time (a longer word stays whole)."""
    at, rest = 0, b""
    while at < len(data):
        piece = rest + data[at:at + SLICE]
        at += SLICE
        words = piece.split()
        rest = b""
        if at < len(data) and words and not piece[-1:].isspace():
            rest = words.pop()
        yield words
    if rest:
        yield [rest]


def text_fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of one text as an unsigned number; 0 for a text without words."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    tail: list[bytes] = []
    total, ones = 0, np.zeros(64, dtype=np.int64)
    for words in _slices(data):
        words = tail + words
        if len(words) < shingle_words:
            tail = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - shingle_words + 1]
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle_words - 1:].tolist())],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
        tail = words[len(words) - shingle_words + 1:] if shingle_words > 1 else []
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(tail), seed) if tail else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column, as a signed 64-bit number with the same bits."""
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        out = np.fromiter((text_fingerprint(t, shingle_words) for t in texts), "<u8", len(texts))
        return pd.Series(out.view("<i8"))
    return fingerprint(text)


# --- parts and thresholds ---------------------------------------------------------------

@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int  # -1: not used


def _grouped_bits(sample: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Deal 64 bits into ``parts`` of nearly equal width, correlated bits together."""
    x = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    x -= x.mean(axis=0)
    dev = np.maximum(np.sqrt((x * x).sum(axis=0)), 1e-9)
    close = np.abs(x.T @ x) / np.outer(dev, dev)
    np.fill_diagonal(close, 0)
    left, out = list(range(64)), []
    for k in range(parts):
        width = 64 // parts + (k < 64 % parts)
        first = max(left, key=lambda b: (close[b, left].sum(), -b))
        own = [first]
        left.remove(first)
        while len(own) < width:
            nxt = max(left, key=lambda b: (close[b, own].sum(), -b))
            own.append(nxt)
            left.remove(nxt)
        out.append(tuple(sorted(own)))
    return out


def _mask(bits: tuple[int, ...]) -> np.uint64:
    return np.uint64(sum(1 << b for b in bits))


def plan_parts(sample: np.ndarray, rows: int, max_bits: int = MAX_BITS) -> list[Part]:
    """Parts and thresholds with the least estimated work for ``rows`` fingerprints.

    For each number of parts, the sample's pairs give the share of pairs within t bits of
    each other in a part, which tells the pairs to compare at that threshold; the sample's
    bits tell the keys to file. A dynamic program over the parts then spends
    ``max_bits + 1`` units, a threshold t costing t + 1.
    """
    sample = np.unique(sample.astype("<u8"))
    if len(sample) < 2:
        sample = np.array([0, 2**64 - 1], dtype="<u8")
    best: tuple[float, list[Part]] | None = None
    pairs = max(1, len(sample) * (len(sample) - 1) // 2)
    for count in range(2, max_bits + 5):
        groups = _grouped_bits(sample, count)
        cost = np.full((count, max_bits + 2), np.inf)  # by part and units
        for i, bits in enumerate(groups):
            own = sample & _mask(bits)
            near = np.zeros(65, dtype=np.int64)
            for k in range(0, len(own), 256):
                near += np.bincount(np.bitwise_count(own[k:k + 256, None] ^ own[None, :]).ravel(), minlength=65)
            near[0] -= len(own)
            within = np.cumsum(near) / 2 / pairs
            set_bits = np.bitwise_count(own).astype(np.int64)
            cost[i, 0] = 0
            keys = np.zeros(len(own))
            for t in range(max_bits + 1):
                term = np.ones(len(own))
                for j in range(t):
                    term = term * np.maximum(set_bits - j, 0) / (j + 1)
                keys = keys + term
                if t <= 3:
                    share = max(within[t], 2.0 ** -len(bits))
                    cost[i, t + 1] = rows * keys.mean() * FILE_COST + rows * rows / 2 * share * COMPARE_COST
        reach: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for i in range(count):
            nxt: dict[int, tuple[float, list[int]]] = {}
            for spent, (c, chosen) in reach.items():
                for units in range(max_bits + 2 - spent):
                    total = c + cost[i, units]
                    if np.isfinite(total) and total < nxt.get(spent + units, (np.inf, []))[0]:
                        nxt[spent + units] = (total, [*chosen, units - 1])
            reach = nxt
        if max_bits + 1 in reach and (best is None or reach[max_bits + 1][0] < best[0]):
            best = (reach[max_bits + 1][0], [Part(b, t) for b, t in zip(groups, reach[max_bits + 1][1])])
    return [p for p in best[1] if p.threshold >= 0]


def _keys(fps: np.ndarray, parts: list[Part]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(part, key, row) for every key of every fingerprint: its bits with up to t set bits cleared."""
    rows = np.arange(len(fps))
    for number, part in enumerate(parts):
        own = fps & _mask(part.bits)
        for j in range(part.threshold + 1):
            for cleared in combinations(part.bits, j):
                m = _mask(cleared)
                has = (own & m) == m
                yield number, own[has] & ~m, rows[has]


# --- links --------------------------------------------------------------------------

def spanning_links(fps: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that connect what the links among ``fps`` (distinct) connect; fewer than ``len(fps)``."""
    out, left = [], fps
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(left ^ at) <= max_bits
            if near.any():
                found = left[near]
                out += [(int(at), int(x)) for x in found]
                front += list(found)
                left = left[~near]
    return out


def _links_of_sorted(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Groups of equal (g, p, q), which arrive sorted; a group may span batches."""
    held: list[np.ndarray] = []

    def solve(g: np.ndarray) -> np.ndarray:
        """g: columns g, p, q and fp of whole groups."""
        change = np.flatnonzero((g[1:, :3] != g[:-1, :3]).any(axis=1)) + 1
        starts = np.concatenate(([0], change))
        sizes = np.diff(np.concatenate((starts, [len(g)])))
        fps, found = g[:, 3].copy().view(np.uint64), []
        for size in np.unique(sizes[(sizes > 1) & (sizes <= 24)]):
            at = starts[sizes == size]
            for a, b in combinations(range(size), 2):
                x, y = fps[at + a], fps[at + b]
                near = (np.bitwise_count(x ^ y) <= max_bits) & (x != y)
                if near.any():
                    found.append(np.stack([x[near], y[near]], axis=1))
        for s, n in zip(starts[sizes > 24], sizes[sizes > 24]):
            if links := spanning_links(np.unique(fps[s:s + n]), max_bits):
                found.append(np.array(links, dtype=np.uint64))
        if not found:
            return np.empty((0, 2), dtype=np.int64)
        return np.unique(np.concatenate(found), axis=0).view(np.int64)

    def batch(links: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    for b in batches:
        if not b.num_rows:
            continue
        cols = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        if held and (held[-1][-1, :3] == cols[-1, :3]).all():
            held.append(cols)  # the same group goes on, and groups are bounded
            continue
        whole = np.concatenate([*held, cols])
        last = np.flatnonzero((whole[:, :3] != whole[-1, :3]).any(axis=1))
        cut = last[-1] + 1 if len(last) else 0
        held = [whole[cut:]]
        if cut:
            yield batch(solve(whole[:cut]))
    if held:
        yield batch(solve(np.concatenate(held)))


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``distinct(fp)``, distinct fingerprints of a written table → ``(a, b)``, links that connect all classes."""
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(PLAN_SAMPLE).collect()
    parts = plan_parts(np.array([r.fp for r in sample], dtype=np.int64).view("<u8"), max(total, 2), max_bits)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_fps = b.column(0).to_numpy(zero_copy_only=False).view("<u8")
            for k in range(0, len(all_fps), 4096):
                fps = all_fps[k:k + 4096]
                for number, keys, rows in _keys(fps, parts):
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), number, np.int32)), pa.array(keys.view("<i8")),
                             pa.array(fps[rows].view("<i8"))], names=["part", "key", "fp"])

    filed = distinct.select("fp").mapInArrow(file, "part int, key long, fp long")
    filed = staged(filed.select(F.xxhash64("part", "key").alias("g"), "fp"), "filed")
    hot = (filed.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
           .select("g", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    dealt = filed.join(hot, "g", "left").withColumn("own", F.pmod(F.xxhash64("fp", F.lit(1)), F.coalesce("blocks", F.lit(1))).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    dealt = dealt.select("g", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp")
    grouped = dealt.repartition("g", "p", "q").sortWithinPartitions("g", "p", "q")
    return grouped.mapInArrow(lambda batches: _links_of_sorted(batches, max_bits), "a long, b long")


# --- operator -------------------------------------------------------------------------

def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` → ``(doc_id, fingerprint, component_id, fp, seq)``, one row per row of ``docs``.

    ``component_id`` is the least id reachable over links, the row's own included. ``fp`` is the
    fingerprint as a signed number and ``seq`` a row number that tells repeated rows apart.

    Null and empty texts have fingerprint zero, which links like any other. Repeated rows and
    equal texts share a fingerprint and so a class. Null ids never are a class's least id
    unless it has no other (then ``component_id`` is null). Texts of any length are read in
    slices. An empty table gives no rows. Other columns of ``docs`` are not looked at.
    """
    own = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "seq")
    own = staged(own.select("doc_id", "seq", fingerprints(F.col("text"), shingle_words).alias("fp")), "fingerprints")
    least = staged(own.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    labels = connected_components(fingerprint_links(least, max_bits))
    labels = staged(labels.select(F.col("node").alias("fp"), "label"), "labels")
    linked = labels.join(least, "fp")
    classes = linked.groupBy("label").agg(F.min("least_id").alias("class_id"))
    linked = labels.join(classes, "label").select("fp", "class_id", F.lit(True).alias("is_linked"))
    found = least.join(linked, "fp", "left").select(
        "fp", F.when(F.col("is_linked"), F.col("class_id")).otherwise(F.col("least_id")).alias("component_id"))
    # A fingerprint may have a third of all rows: written first, so that the join is one whose hot keys Spark splits.
    found = staged(found, "classes")
    return own.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "fp", "seq")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each class: that with the least id, and among repeated ids any one.

    Keeps the columns of ``docs``. Cases as for :func:`simhash_classes`.
    """
    mark = "__row"
    while mark in docs.columns:
        mark += "_"
    rows = staged(numbered(docs, mark), "rows")
    marked = rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), mark)
    own = staged(marked.select("doc_id", mark, fingerprints(F.col("text"), shingle_words).alias("fp")), "fingerprints")
    least = staged(own.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", mark)).alias("first")), "distinct-fingerprints")
    labels = staged(connected_components(fingerprint_links(least, max_bits)), "labels")
    classes = least.join(labels, least["fp"] == labels["node"], "left").select(
        F.coalesce("label", "fp").alias("label"), "first")
    keep = classes.groupBy("label").agg(F.min("first").alias("first")).select(F.col(f"first.{mark}").alias(mark))
    return rows.join(keep, mark, "left_semi").drop(mark)
