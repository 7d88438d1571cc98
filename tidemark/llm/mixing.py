"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words, and its documents a common share of it: so many
copies for sure and one more with a probability. Rounding these probabilities one by one would
miss the target by chance. Here they are rounded against each other: in a step, two partners
move words between them, in one of two directions drawn so that no probability changes on
average, until one of them is settled. A partner is a document, largest first, and the other one
the pool of the smaller documents not settled yet, each of which takes part by its own room to
move; so large documents are settled while there is room for them. A step keeps the sum of words
expected, so at the end at most one document of a group is left, mostly a small one.

The documents of a source are dealt by hash into groups of bounded size; what is left of the
groups meets in groups of the next level, up to one group a source. So the words taken from a
source miss its target by less than the one document that is left there, which is drawn by itself.
Where that document is large beside its source (a source of a dozen documents), the last group is
drawn again, a bounded number of times, and the nearest draw stands.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import staged
from tidemark.operators.ranking import with_global_position

#: The contract's weights by a source's place, the share of all words that the mix holds, and the most copies of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Documents rounded against each other in one group, about.
GROUP_DOCUMENTS = 1024
#: How often a source's last group is drawn at most, and the miss, as a share of its expected words, that needs no other draw.
LAST_DRAWS, NEAR = 64, 0.0005
#: Copies of a repeated row that one task writes, at most.
ROWS_AT_A_TIME = 1 << 16
#: A word: what white space of ASCII parts.
WORD = r"[^\x20\x09-\x0D]+"
#: A probability this near to 0 or 1 is settled.
SETTLED = 1e-9


# --- targets --------------------------------------------------------------------------

def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size)`` → also ``number``, its place by code point (a null source last), and ``target``.

    The targets share ``share`` of all sizes by the weights, which repeat over the places; no target is above ``most``
    times its source's size, and what is left over is shared again among the others. Only sums reach the driver, one row
    a step, and each step puts at least one more source at its bound; there are as many steps as bounds to find.
    """
    if most < share:
        raise ValueError("the sources can't give that share")
    placed = with_global_position(sizes, [F.asc_nulls_last("source")], "number")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = staged(placed.withColumn("weight", weight), "sources")
    level, bounded = -1.0, -1
    while True:
        full = F.col("source_size") * most <= F.col("weight") * level
        r = rows.agg(F.sum("source_size").alias("words"), F.sum(F.when(full, F.col("source_size") * most)).alias("given"),
                     F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.sum(full.cast("long")).alias("bounded")).first()
        if r.bounded == bounded or not r.weight or not r.words:
            break
        level, bounded = (share * r.words - (r.given or 0)) / r.weight, r.bounded
    if not r.weight or not r.words:
        target = F.col("source_size") * float(most)
    else:
        target = F.least(F.col("source_size") * float(most), F.col("weight") * level)
    return rows.withColumn("target", target.cast("double"))


# --- rounding -------------------------------------------------------------------------

def settle(sizes: np.ndarray, chances: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities rounded against each other; the sizes come in descending order. At most one stays between 0 and 1.

    The sum of size times probability is kept, apart from rows without words, which are drawn by themselves.
    """
    p = chances.astype(float).copy()
    nothing = sizes <= 0
    p[nothing] = rng.random(int(nothing.sum())) < p[nothing]

    def snapped(x: np.ndarray) -> np.ndarray:
        return np.where(x < SETTLED, 0.0, np.where(x > 1 - SETTLED, 1.0, x))

    p, s = snapped(p), sizes.astype(float)
    for i in range(len(p)):
        while 0 < p[i] < 1:
            room = s[i + 1:] * np.minimum(p[i + 1:], 1 - p[i + 1:])  # words that each can give and take
            pool = room.sum()
            if pool <= 0:
                break
            take, give = min((1 - p[i]) * s[i], pool), min(p[i] * s[i], pool)
            moved = take if rng.random() * (take + give) < give else -give  # on average nothing
            p[i] += moved / s[i]
            p[i + 1:] -= np.divide(room, s[i + 1:], out=np.zeros_like(room), where=room > 0) * (moved / pool)
            p[i:] = snapped(p[i:])
    return p


def settle_last(sizes: np.ndarray, chances: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A source's last group: all probabilities to 0 or 1, the nearest of some draws to the expected words."""
    expected, best, least = float((sizes * chances).sum()), None, np.inf
    for _ in range(LAST_DRAWS):
        p = settle(sizes, chances, rng)
        p = (rng.random(len(p)) < p).astype(float)  # the one that is left
        miss = abs(float((sizes * p).sum()) - expected)
        if miss < least:
            best, least = p, miss
        if least <= NEAR * expected:
            break
    return best


def _settled(units: DataFrame, level: int, seed: int) -> DataFrame:
    """One level of the tree: every group's probabilities rounded against each other."""
    def group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "key", "doc_key"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng([seed, level, *(int(k) for k in key)])
        rounding = settle_last if rows["buckets"][0] == 1 else settle
        rows["p"] = rounding(rows["size"].to_numpy(), rows["p"].to_numpy(), rng)
        return rows

    groups = units.withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP_DOCUMENTS)).cast("long")) \
        .withColumn("bucket", F.pmod(F.xxhash64("key", "doc_key", F.lit(level)), F.col("buckets"))).drop("n")
    return staged(groups.groupBy("number", "bucket").applyInPandas(group, groups.schema).drop("bucket", "buckets"), "settled")


def rounded(units: DataFrame, seed: int = 0) -> DataFrame:
    """``units`` of ``(number, key, doc_key, size, p, ...)`` with every p rounded to 0 or 1, source by source.

    Each level reads what the last one wrote; a level's groups leave one undecided document each at most, so the undecided
    ones fall by a factor of about ``GROUP_DOCUMENTS`` a level, until a source has one group.
    """
    done, level, waiting = [], 0, units
    while True:
        per_source = staged(waiting.groupBy("number").agg(F.count(F.lit(1)).alias("n")), "undecided")
        if not per_source.head(1):
            break
        now = _settled(waiting.join(per_source, "number"), level, seed)
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(now.where(~undecided))
        waiting, level = now.where(undecided), level + 1
    out = waiting
    for part in done:
        out = out.unionByName(part)
    return out


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 0,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, text_key, size, source_size, target, copies, taken)``: a row for every row of ``docs``, with how
    often the mix holds it.

    A document's size is its number of words, a null text's 0. ``copies`` is the target's share of its source, rounded
    down or up, and never above ``most``; ``taken`` is size times copies. A source's taken words differ from its target by
    less than one document. (A source's last group is drawn up to ``LAST_DRAWS`` times for the nearest result, which
    shifts the probabilities of a very small source's documents a little.) A null source is a source of its own, last in the order. Rows equal in id, source and text
    share the copies of all of them evenly, which row gets one more is no matter; null ids count as an id. All draws come
    from the rows and the seed, so a rerun gives the same copies however the rows are dealt out. Sources without words
    have the target 0. An empty table gives no rows; other columns are not looked at.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.select("doc_id", "source", F.xxhash64("text", F.length("text")).alias("text_key"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"))
    units = staged(own.groupBy("doc_id", "source", "text_key", "size").agg(F.count(F.lit(1)).alias("rows")), "units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).cast("long").alias("source_size"))
    sources = staged(source_targets(sizes, weights, share, most).select("source", "number", "source_size", "target"), "targets")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    # The rows of one unit are alike: the whole copies of all of them are sure, and one more has the rest as its probability.
    expected = F.col("rows") * F.col("ratio")
    sure = F.floor(expected + SETTLED)
    known = (units.withColumnRenamed("source", "_source").join(sources.withColumn("ratio", ratio), F.col("_source").eqNullSafe(F.col("source")))
             .withColumns({"sure": sure, "p": F.greatest(F.lit(0.0), expected - sure), "key": F.col("text_key"),
                           "doc_key": F.xxhash64("doc_id", "source", F.col("doc_id").isNull())}))
    chosen = rounded(staged(known.select("number", "key", "doc_key", "doc_id", "size", "rows", "sure", "p"), "chances"), seed)
    total = chosen.withColumn("total", F.col("sure") + F.col("p").cast("long")).join(sources, "number").withColumnRenamed("key", "text_key")
    return _row_by_row(staged(total, "mixed"))


def _row_by_row(units: DataFrame) -> DataFrame:
    """Units of equal rows → rows. A unit of very many rows is cut, and the pieces are dealt out."""
    def spread(df: DataFrame, first: str) -> DataFrame:
        last = F.least(F.col("rows"), F.expr(first) + ROWS_AT_A_TIME) - 1
        return df.withColumn("_row", F.explode(F.sequence(F.expr(first), last)))

    few = spread(units.where(F.col("rows") <= ROWS_AT_A_TIME), "0L")
    pieces = units.where(F.col("rows") > ROWS_AT_A_TIME).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows - 1) div {ROWS_AT_A_TIME}"))))
    many = spread(pieces.repartition(F.col("doc_id"), F.col("_piece")), f"_piece * {ROWS_AT_A_TIME}L").drop("_piece")
    copies = F.expr("total div rows") + F.when(F.col("_row") < F.col("total") % F.col("rows"), 1).otherwise(0)
    return few.unionByName(many).withColumn("copies", copies.cast("long")).select(
        "doc_id", "source", "text_key", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mix`` (from ``mix_sources``) says, with all their columns.

    Of rows equal in id, source and text one stands for all of them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({"_id": F.col(id_col), "_source": F.col(source_col), "_text": F.xxhash64(text, F.length(text))})
    total = mix.groupBy("doc_id", "source", "text_key").agg(F.sum("copies").alias("_copies")).where("_copies > 0")
    same = (F.col("_id").eqNullSafe(F.col("m.doc_id")) & F.col("_source").eqNullSafe(F.col("m.source")) & (F.col("_text") == F.col("m.text_key")))
    joined = keyed.dropDuplicates(["_id", "_source", "_text"]).alias("d").join(total.alias("m"), same)
    return joined.select("d.*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")).drop("_id", "_source", "_text", "_copy")
