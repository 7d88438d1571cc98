"""Snapshot join: an equi-join in which a row without a key has no partner.

Keys are texts that identify a record in every run (``id_text`` for protocols, whose ids
may be no numbers), so records whose numeric id is NULL still meet their own earlier row
and nobody else's. The join is linear in its input but for ids that a run repeats, which
multiply as a join's rows do; the quality suite reports them. It is a plain equi-join:
Spark broadcasts a side only by its own size check, and adaptive execution splits hot keys.

``nulls_meet`` is the rule of dataframe merges, under which rows without a key meet each other,
all of them: wanted only to compare with reports made that way. Its output grows with the square
of such rows, so they are counted first and a warning tells how many rows come of them. They make
one key, which a join by key would give to one task; here both sides are dealt into blocks, and
every two blocks meet in a group of bounded size, so that only the number of tasks grows.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block, and pairs of blocks that a task has on average. Beyond ``MOST_TASKS`` a task has more of them.
BLOCK_ROWS, PAIRS_A_TASK, MOST_TASKS = 1_000, 4, 10_000


def keyed_join(left: DataFrame, right: DataFrame, key: str, nulls_meet: bool = False) -> DataFrame:
    """Inner join on ``key`` with one output ``key`` column; duplicates multiply. NULL keys match nothing, or each other."""
    left_cols = [c for c in left.columns if c != key]
    right_cols = [c for c in right.columns if c != key]
    matched = left.join(right, on=key, how="inner").select(key, *left_cols, *right_cols)
    if not nulls_meet:
        return matched
    alone = [left.where(F.col(key).isNull()).select(*left_cols), right.where(F.col(key).isNull()).select(*right_cols)]
    without = [df.count() for df in alone]
    if not all(without):
        return matched
    warnings.warn(f"{without[0]} and {without[1]} rows without {key} meet each other: {without[0] * without[1]} rows of the join", stacklevel=2)
    no_key = F.lit(None).cast(left.schema[key].dataType).alias(key)
    columns = [F.col(side).getField(c).alias(c) for side, cols in (("_l", left_cols), ("_r", right_cols)) for c in cols]
    return matched.union(_all_pairs(*alone, *without).select(no_key, *columns))


def _all_pairs(left: DataFrame, right: DataFrame, left_rows: int, right_rows: int) -> DataFrame:
    """Every row of one frame with every row of the other, as structs ``_l`` and ``_r``: a group for each two blocks."""
    blocks = [-(-n // BLOCK_ROWS) for n in (left_rows, right_rows)]
    tasks = min(-(-blocks[0] * blocks[1] // PAIRS_A_TASK), MOST_TASKS)

    def dealt(df: DataFrame, name: str, own: int, others: int, pair) -> DataFrame:
        # A row's block follows from what it holds and its number among equal rows, so a repeated task deals as the first did.
        rows = df.select(F.struct(F.lit(0).alias("_"), *df.columns).alias("_row")).withColumn("_text", F.to_json("_row"))
        rows = rows.withColumn("_number", F.row_number().over(Window.partitionBy(F.xxhash64("_text")).orderBy("_text")))
        rows = rows.select(F.col("_row").alias(name),
                           F.pmod(F.xxhash64("_text", "_number"), F.lit(own)).alias("_own"))
        rows = rows.select(name, "_own", F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("_other"))
        return rows.select(name, pair(F.col("_own"), F.col("_other")).alias("_pair")).repartition(tasks, "_pair")

    l = dealt(left, "_l", blocks[0], blocks[1], lambda own, other: own * blocks[1] + other)
    r = dealt(right, "_r", blocks[1], blocks[0], lambda own, other: other * blocks[1] + own)
    return l.join(r, "_pair")
