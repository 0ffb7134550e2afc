"""Snapshot merge: the next version of a table and the log of what changed.

File tables have no in-place merge, and readers of the old version must not be
disturbed, so a merge returns the whole next version to be written elsewhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import match_key
from .blocks import skew_join


@dataclass(frozen=True)
class Merge:
    """Result of ``snapshot_merge``.

    ``rows`` holds each row with its ``action``: INSERT, UPDATE, DELETE or KEEP.
    """

    rows: DataFrame
    snapshot: DataFrame
    changes: DataFrame


def snapshot_merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str],
    stamp: Mapping[str, Column] | None = None,
    update_when: Column | None = None,
    delete_missing: bool = False,
    audit: Sequence[str] = (),
    mark_missing: Mapping[str, Column] | None = None,
) -> Merge:
    """Merge ``source`` into ``target`` on ``key``.

    Matched rows take the ``update`` columns from the source where
    ``update_when`` (a condition on the target) holds. Source rows without a
    target are inserted; target rows without a source are kept, or deleted with
    ``delete_missing``; with ``mark_missing`` they stay, with those columns set, and
    count as updated. ``stamp`` columns are set on updates and inserts. Rows
    with a null key never match. A target row that two source rows would update
    raises an error. ``audit`` names the columns whose old and new values go to
    the change log.

    The target side is one left join to a source aggregated by key, the insert
    side one anti join; in both AQE can split a skewed key, which it cannot do
    for a full outer join.
    """
    stamp, marks = dict(stamp or {}), dict(mark_missing or {})
    columns = target.columns
    audit = list(audit)

    keyed_source = source.withColumn("_key", match_key(F.col(key)))
    by_key = (
        keyed_source.where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(
            F.count(F.lit(1)).alias("_sources"),
            F.first(F.struct(*update)).alias("_new"),
        )
    )
    keyed_target = target.withColumn("_key", match_key(F.col(key)))

    matched = F.col("_sources").isNotNull()
    applies = matched if update_when is None else matched & F.coalesce(update_when, F.lit(False))
    clash = F.raise_error(
        F.concat(F.lit("merge: more than one source row for key "), F.col("_key"))
    )
    joined = skew_join(keyed_target, by_key, ["_key"], "left").withColumn(
        "action",
        F.when(applies & (F.col("_sources") > 1), clash.cast("string"))
        .when(applies | (F.lit(bool(marks)) & ~matched), F.lit("UPDATE"))
        .when(matched | F.lit(not delete_missing), F.lit("KEEP"))
        .otherwise(F.lit("DELETE")),
    )
    updated = matched & (F.col("action") == "UPDATE")
    new_values = {
        **{c: F.when(updated, F.col("_new")[c]).otherwise(F.col(c)) for c in update},
        **{c: F.when(updated, v).otherwise(F.col(c)) for c, v in stamp.items()},
        **{c: F.when(~matched, v).otherwise(F.col(c)) for c, v in marks.items()},
    }
    old_side = joined.select(
        *[new_values.get(c, F.col(c)).alias(c) for c in columns],
        "action",
        *[F.col(c).alias(f"_old_{c}") for c in audit],
    )
    inserts = keyed_source.join(keyed_target.select("_key"), "_key", "left_anti").select(
        *[c for c in source.columns if c in columns and c not in stamp],
        *[v.alias(c) for c, v in stamp.items()],
        F.lit("INSERT").alias("action"),
    )
    rows = old_side.unionByName(inserts, allowMissingColumns=True)
    gone = F.col("action") == "DELETE"
    changes = rows.where(F.col("action") != "KEEP").select(
        "action",
        *[F.col(f"_old_{c}").alias(f"deleted_{c}") for c in audit],
        *[F.when(~gone, F.col(c)).alias(f"inserted_{c}") for c in audit],
    )
    return Merge(
        rows=rows.select(*columns, "action"),
        snapshot=rows.where(~gone).select(*columns),
        changes=changes,
    )
