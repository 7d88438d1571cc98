"""Sharding by histogram sort, in DataFrame expressions only.

Rows get a 63-bit sort key. The key ranges of the shards are found by counting: each round
cuts the ranges that still hold a splitter into bins, counts the exact bytes in every bin
across all partitions, and goes on with the one bin that holds the splitter, until the bytes
below a splitter are within the tolerance of its share. Rows are exchanged once, after that: by
ranges of the key, each sorted by one task, so a row's slot is its place in the key's order.

The key is the hash of the row's group (equal texts), ended by a hash of the row itself:
equal texts lie side by side, and a group that holds a third of all bytes can still be cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import numbered, staged
from tidemark.operators.ranking import with_global_position

#: Bins per splitter and round, and how far from its share a splitter may be (a part of a shard).
BINS, TOLERANCE = 256, 1e-4
#: Low bits of the key that tell the rows of one group apart.
ROW_BITS = 24
KEY_BITS = 63


def sort_key(group: Column, row: Column) -> Column:
    """A key from 0 to 2⁶³ − 1: rows of equal ``group`` share all but the low bits."""
    low = (1 << ROW_BITS) - 1
    mixed = F.xxhash64(group).bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(row, F.lit("row")).bitwiseAND(F.lit(low)))
    return F.shiftrightunsigned(mixed, 1)


@dataclass
class _Search:
    """One splitter: the key range that holds it and the bytes below the range's ends."""

    target: float
    low: int
    high: int
    below_low: int
    below_high: int
    at: int | None = None


def find_splitters(rows: DataFrame, shards: int, key: str = "key", size: str = "size",
                   tolerance: float = TOLERANCE) -> list[int]:
    """``shards - 1`` keys; rows with a key below a splitter come before it.

    ``rows`` must be a written table, as every round reads it. A round brings at most
    ``shards * BINS`` counts to the driver.
    """
    total = rows.agg(F.sum(F.col(size).cast("long"))).first()[0] or 0
    slack = tolerance * total / shards
    searches = [_Search(total * k / shards, 0, 1 << KEY_BITS, 0, total) for k in range(1, shards)]
    while any(s.at is None for s in searches):
        ranges = sorted({(s.low, s.high) for s in searches if s.at is None})
        steps = [-(-(high - low) // BINS) for low, high in ranges]
        which = F.lit(None).cast("int")
        bin_ = F.lit(None).cast("long")
        for k, ((low, high), step) in enumerate(zip(ranges, steps)):
            inside = (F.col(key) >= low) & (F.col(key) <= high - 1)
            which = F.when(inside, k).otherwise(which)
            bin_ = F.when(inside, F.expr(f"(`{key}` - {low}) div {step}")).otherwise(bin_)
        counted = (rows.select(which.alias("which"), bin_.alias("bin"), F.col(size).cast("long").alias("size"))
                   .where("which is not null").groupBy("which", "bin")
                   .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect())
        bins: dict[int, list] = {k: [] for k in range(len(ranges))}
        for r in counted:
            bins[r.which].append((r.bin, r.bytes, r.rows))
        for s in searches:
            if s.at is not None:
                continue
            k = ranges.index((s.low, s.high))
            low, step, below, top = s.low, steps[k], s.below_low, s.high
            for b, size_, n in sorted(bins[k]):
                if below + size_ >= s.target:
                    s.low, s.high = low + b * step, min(low + (b + 1) * step, top)
                    s.below_low, s.below_high = below, below + size_
                    left, right = s.target - s.below_low, s.below_high - s.target
                    if min(left, right) <= slack or n <= 1 or s.high - s.low <= 1:
                        s.at = s.low if left <= right else s.high
                    break
                below += size_
            else:
                s.at = s.high
    return [s.at for s in searches]


def shard_rows(docs: DataFrame, shards: int, group: Column, size: Column, columns: list[str]) -> DataFrame:
    """``columns`` of every row with ``size`` (long), ``shard`` (int) and ``slot`` (long).

    Law ``bytes``: shard sizes differ by little more than ``TOLERANCE`` of a shard, or by a row
    where rows are larger than that. Rows of equal ``group`` lie in one shard, side by side, unless a
    splitter cuts the group. Slots count from 0 without gaps within a shard, in key order.

    Null groups are one group; repeated rows are told apart by a row number and all kept; an
    empty table gives no rows. Of ``columns``, those named size, shard or slot are replaced.
    """
    kept = [c for c in columns if c not in ("size", "shard", "slot")]
    rows = numbered(docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), size.cast("long").alias("size"), group.alias("group")), "seq")
    rows = staged(rows.withColumn("key", sort_key(F.col("group"), F.col("seq"))).drop("group"), "shard-keys")
    splitters = find_splitters(rows, shards)
    shard = sum((F.when(F.col("key") >= s, 1).otherwise(0) for s in splitters if s < 1 << KEY_BITS), F.lit(0))
    # The one exchange of rows, by ranges of the same key: shards are ranges of it, too.
    sorted_ = with_global_position(rows.withColumn("shard", shard.cast("int")), [F.asc("key"), F.asc("seq")], "place")
    firsts = sorted_.groupBy("shard").agg(F.min("place").alias("first"))  # one row for each shard
    return sorted_.join(F.broadcast(firsts), "shard").select("row.*", "size", "shard", (F.col("place") - F.col("first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int, columns: list[str], text_col: str = "text") -> DataFrame:
    """:func:`shard_rows` with equal texts as groups and a row's UTF-8 bytes plus 1 as its size (null text: 1)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return shard_rows(docs, shards, text, F.octet_length(text) + 1, columns)


def write_shards(docs: DataFrame, shards: int, path: str, text_col: str = "text") -> None:
    """Write ``docs``, all columns, one folder for each shard; columns named size, shard or slot are left out."""
    placed = shard_documents(docs, shards, docs.columns, text_col)
    placed.drop("size", "slot").write.partitionBy("shard").parquet(path)
