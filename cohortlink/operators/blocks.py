"""Candidate joins on shared keys.

A block is the set of rows on two sides that share a key. ``block_pairs`` lists
every pair of every block, n * m rows for a default birth date or a test patient's
name: that is its answer, whatever the size. ``block_members`` lists the same blocks member
by member, n + m rows, for callers that do not need the pairs. The caller chooses;
no size does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join whose skewed partitions AQE can split.

    AQE does so only if both inputs come straight from a shuffle. An aggregate
    or a join on the same keys would pass its own partitioning on and leave a
    hot key to one task. Joining on the keys and their hash asks for a new
    shuffle, which is cheap where it is used: one side is an aggregate.
    """
    keys = list(keys)
    hashed = F.xxhash64(*keys)
    joined = left.withColumn("_hash", hashed).join(right.withColumn("_hash", hashed), [*keys, "_hash"], how)
    return joined.drop("_hash")


def block_sizes(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on either side, counted in one aggregation over both."""
    keys = list(keys)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    lefts = left.dropna(subset=keys).select(*keys, one.alias("n_left"), none.alias("n_right"))
    rights = right.dropna(subset=keys).select(*keys, none.alias("n_left"), one.alias("n_right"))
    return (
        lefts.unionByName(rights)
        .groupBy(*keys)
        .agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    )


def block_pairs(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", broadcast_left: bool = False
) -> DataFrame:
    """All pairs that share the keys; ``how`` is ``inner`` or ``left``.

    A left join keeps left rows without any partner. Rows with an empty key meet
    nobody, and a left join does not send them to one task: they are spread apart
    from the join. ``broadcast_left`` is for an inner join with a left side that
    has been measured small.
    """
    keys = list(keys)
    right = right.dropna(subset=keys)
    if how == "inner":
        left = left.dropna(subset=keys)
        if broadcast_left:
            return F.broadcast(left).join(right, keys, "inner")
        return skew_join(left, right, keys, "inner")
    usable = F.lit(True)
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    joined = skew_join(left.where(usable), right, keys, "left")
    return joined.unionByName(left.where(~usable), allowMissingColumns=True)


def block_members(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, right_id: str
) -> DataFrame:
    """Members of all blocks with rows on both sides, one row each, with the id of their side."""
    keys = list(keys)
    left, right = left.dropna(subset=keys), right.dropna(subset=keys)
    lefts = skew_join(left, right.select(*keys).distinct(), keys, "left_semi").select(*keys, F.col(left_id))
    rights = skew_join(right, left.select(*keys).distinct(), keys, "left_semi").select(*keys, F.col(right_id))
    return lefts.unionByName(rights, allowMissingColumns=True).distinct()
