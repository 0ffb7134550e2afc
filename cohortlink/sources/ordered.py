"""Tables whose files, read one after the other, are in a stated order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def write_ordered(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write the rows in order: ranges of ``order`` go to tasks, each sorts its own, files are numbered by range."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)


def _located(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    rows = spark.read.schema(schema).parquet(path)
    return rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def read_with_positions(spark: SparkSession, path: str, schema: T.StructType, name: str = "position") -> DataFrame:
    """The rows with their place, from 1, in the whole table.

    A place is the row's place in its file and the rows of the files before; only
    the row counts of the files meet on the driver.
    """
    rows = _located(spark, path, schema)
    offset, before = [], 0
    for r in sorted(rows.groupBy("_file").count().collect()):
        offset.append((r["_file"], before))
        before += r["count"]
    starts = spark.createDataFrame(offset, "_file string, _before bigint")
    placed = rows.join(F.broadcast(starts), "_file")
    return placed.select(*[f.name for f in schema], (F.col("_before") + F.col("_row") + 1).alias(name))


def order_breaks(spark: SparkSession, path: str, schema: T.StructType, order: Sequence[str]) -> int:
    """Number of rows that come before their predecessor's place in the order, within files and from file to file."""
    rows = _located(spark, path, schema).select("_file", "_row", F.struct(*order).alias("_place"))
    last = F.lag("_place").over(Window.partitionBy("_file").orderBy("_row"))
    inner = rows.withColumn("_last", last)
    ends = inner.groupBy("_file").agg(
        F.count_if(_less(F.col("_place"), F.col("_last"), order)).alias("breaks"),
        F.min_by("_place", "_row").alias("first"),
        F.max_by("_place", "_row").alias("last"),
    )
    files_ = sorted(ends.collect())
    pairs = [(a["last"], b["first"]) for a, b in zip(files_, files_[1:], strict=False)]
    key = lambda r: [(x is not None, x) for x in r]  # noqa: E731  as Spark sorts: nulls first
    return sum(r["breaks"] for r in files_) + sum(key(b) < key(a) for a, b in pairs)


def _less(a: Column, b: Column, order: Sequence[str]) -> Column:
    """Whether ``a`` comes before ``b``, nulls first; false where there is no ``b``."""
    out, same = F.lit(False), F.lit(True)
    for name in order:
        x, y = a[name], b[name]
        out = out | (same & F.coalesce(x < y, x.isNull() & y.isNotNull()))
        same = same & x.eqNullSafe(y)
    return b.isNotNull() & out
