"""Appending in batches: a retried append adds nothing twice, and readers see whole batches only.

A table is a folder with ``data``, one folder per attempt to write a batch, and
``commits``, one small file per batch that names the attempt that counts. An
attempt becomes part of the table when its commit file is created; of several
writers one creates it. Files of attempts that died are never read and can be
removed with ``vacuum``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import files


def _commit_path(base: str, batch: str) -> str:
    if not batch or any(c in batch for c in "/\\:\n") or batch[0] in "._":
        raise ValueError(f"a batch needs a name that a file can have, not {batch!r}")
    return f"{base.rstrip('/')}/commits/{batch}"


def append_batch(df: DataFrame, base: str, batch: str) -> bool:
    """Add the rows under a batch id; False, and nothing is added, if that batch is in the table already."""
    spark = df.sparkSession
    commit = _commit_path(base, batch)
    if files.text_of(spark, commit) is not None:
        return False
    attempt = uuid.uuid4().hex
    path = f"{base.rstrip('/')}/data/{attempt}"
    df.write.mode("errorifexists").parquet(path)
    if files.exists(spark, commit) and files.text_of(spark, commit) is None:
        files.delete(spark, commit)  # its writer died before it was done
    if files.create(spark, commit, attempt):
        return True
    files.delete(spark, path)  # another writer was faster
    return False


def committed(spark: SparkSession, base: str) -> dict[str, str]:
    """Batch id and attempt of all whole batches."""
    base = base.rstrip("/")
    found = {b: files.text_of(spark, f"{base}/commits/{b}") for b in files.names(spark, f"{base}/commits")}
    return {b: attempt for b, attempt in found.items() if attempt is not None}


def read_batches(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The rows of all whole batches; a batch that is committed later is not in it."""
    paths = [f"{base.rstrip('/')}/data/{attempt}" for attempt in committed(spark, base).values()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, base: str) -> int:
    """Remove attempts that no commit names; to be run while nobody appends. Returns their number."""
    base = base.rstrip("/")
    dead = set(files.names(spark, f"{base}/data")) - set(committed(spark, base).values())
    for attempt in dead:
        files.delete(spark, f"{base}/data/{attempt}")
    return len(dead)
