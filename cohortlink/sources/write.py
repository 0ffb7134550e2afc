"""Writers. No writer replaces a path that a running job may be reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Add rows to a parquet table, creating it if needed."""
    writer = df.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to a catalog table by column name, creating it if needed."""
    if df.sparkSession.catalog.tableExists(table):
        df.select(*df.sparkSession.table(table).columns).write.insertInto(table)
    else:
        df.write.saveAsTable(table)


def write_version(df: DataFrame, base: str, version: str, partition_by: str | None = None) -> str:
    """Write a table version to its own new directory and return the path.

    Fails if the version exists. Spark commits the files only when all tasks
    are done, so a lost executor or a failed job leaves no half version.
    """
    path = f"{base.rstrip('/')}/version={version}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def read_version(spark: SparkSession, base: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/version={version}")


def write_registry(identifier: DataFrame, base: str, version: str) -> str:
    """Write the identifier registry with one partition directory per identifier type.

    Filters on the type then prune directories. The rebalance hint lets AQE
    split a type that holds most of the rows over several files.
    """
    balanced = identifier.hint("rebalance", F.col("id_type_concept_id"))
    return write_version(balanced, base, version, partition_by="id_type_concept_id")


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save as a catalog table bucketed and sorted by ``key``.

    Tables with equal key and bucket number join on it without a shuffle.
    """
    # one task per bucket, so one file per bucket; a scan can then keep the bucket's order
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("errorifexists")
    (writer.option("path", path) if path else writer).saveAsTable(table)
