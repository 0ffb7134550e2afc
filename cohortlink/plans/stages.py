"""Steps of a job that run an action: writing an intermediate table, measuring a size."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files

# Broadcast limit. Far above Spark's own, which guesses sizes: what is
# broadcast here has been measured, and spares shuffling a table that may be
# many thousand times larger.
MAX_BROADCAST_BYTES = 128 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str | None:
    """The cluster's checkpoint folder, or None where none is configured."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )


class Run:
    """Owner of a job's intermediate tables: one folder, removed with all it holds at the end.

    The folder is made under ``folder`` or else under ``spark.checkpoint.dir``.
    With neither, a cluster's run is refused; a local master, of which all tasks
    are one process, gets a temporary folder. On a cluster, ``with`` first
    checks that all executors and the driver see the same folder.

        with Run(spark) as run:
            result = map_participants(run, ...)
            result.review.write.parquet(path)

    Results of a job read the run's tables, so they are to be written before it
    ends. It ends with the ``with`` block, also after an error, or by ``close``.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self._local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
        self._temporary = None
        folder = folder or shared_folder(spark)
        if not folder:
            if not self._local:
                raise ValueError("name a folder that all executors share, or set spark.checkpoint.dir")
            self._temporary = tempfile.mkdtemp(prefix="cohortlink-")
            folder = f"file://{self._temporary}"
        self.folder = f"{folder.rstrip('/')}/cohortlink/run-{uuid.uuid4().hex}"
        self._catalog: list[str] = []

    def __enter__(self) -> Run:
        if not self._local:
            self.check_shared()
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def path(self, name: str) -> str:
        """A new path within the run's folder."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """The same rows, read back from a parquet table.

        The table outlives lost executors and cuts the lineage; its size is known
        to the joins that follow.
        """
        path = self.path(name)
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def catalog_name(self, name: str) -> str:
        """A new name for a catalog table that is dropped with the run."""
        self._catalog.append(f"{name}_{uuid.uuid4().hex}")
        return self._catalog[-1]

    def check_shared(self) -> None:
        """Raise unless what executors write in the folder can be read by others."""
        n = max(2, self.spark.sparkContext.defaultParallelism)
        path = self.path("probe")
        self.spark.range(0, n, 1, n).write.parquet(path)
        found = self.spark.read.schema("id bigint").parquet(path).count()
        files.delete(self.spark, path)
        if found != n:
            raise ValueError(f"executors do not share {self.folder}: {found} of {n} rows can be read")

    def close(self) -> None:
        """Drop the run's catalog tables and remove its folder."""
        for name in self._catalog:
            self.spark.sql(f"drop table if exists {name}")
        self._catalog.clear()
        files.delete(self.spark, self.folder)
        if self._temporary:
            shutil.rmtree(self._temporary, ignore_errors=True)


_session_runs: dict[str, Run] = {}


def session_run(spark: SparkSession) -> Run:
    """The run of a whole application, for results that are returned unwritten; it ends with the program."""
    application = spark.sparkContext.applicationId
    if application not in _session_runs:
        _session_runs[application] = Run(spark).__enter__()
        atexit.register(_end, _session_runs[application])
    return _session_runs[application]


def _end(run: Run) -> None:
    # the session may be gone by now, and its catalog with it
    with contextlib.suppress(Exception):
        files.delete(run.spark, run.folder)
    if run._temporary:
        shutil.rmtree(run._temporary, ignore_errors=True)


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the rows, counted and measured now, are within the broadcast limit."""
    size = F.lit(16 * len(df.columns))
    for f in df.schema:
        if isinstance(f.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
    total = df.agg(F.sum(size.cast("bigint"))).first()[0]
    return (total or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The rows marked for broadcast if measured small, else unmarked.

    Unmarked rows are joined by shuffle, where AQE splits skewed partitions.
    """
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df
