"""Readers. Every reader takes an explicit schema or a typed table; none infers types."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from . import files

_CORRUPT = "_corrupt_record"

# Column titles of the exported work queue.
WORKQUEUE_TITLES = {
    "PMI ID": "pmi_id",
    "First Name": "first_name",
    "Last Name": "last_name",
    "Date of Birth": "birth_date",
    "Email": "email",
    "Phone": "phone",
    "Street Address": "street_address",
    "City": "city",
    "State": "state",
    "Zip": "zip",
    "Physical Measurements Location": "physical_measurements_location",
    "Biospecimens Location": "biospecimens_location",
}


def strip_quotes(df: DataFrame) -> DataFrame:
    """Remove double quotes from all text columns."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[F.translate(F.col(n), '"', "").alias(n) if n in texts else F.col(n) for n in df.columns]
    )


_CSV_OPTIONS = {"quote": '"', "escape": '"', "lineSep": "\n"}


@dataclass(frozen=True)
class CsvLoad:
    """Rows of a CSV file, and the lines of it that are none (column ``line``)."""

    rows: DataFrame
    rejects: DataFrame


def read_roster_csv(
    spark: SparkSession,
    path: str,
    keep: Callable[[DataFrame, str], DataFrame],
    schema: T.StructType = schemas.ROSTER_STAGING,
) -> CsvLoad:
    """Roster export: one header line a file, commas, one record per line, quotes removed.

    The file is scanned once. A line with a value that does not fit its column,
    or with too few or too many values, is a reject; the others are rows. Both
    come from the same table, which ``keep`` writes (``plans.stages.Run.table``).
    A file whose titles are not the schema's, in its order and without regard to
    case, raises an error.
    """
    with_line = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    lines = spark.read.schema(with_line).options(
        **_CSV_OPTIONS, header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT
    ).csv(path)
    parsed = keep(lines, "roster-csv")
    bad = F.col(_CORRUPT).isNotNull()
    return CsvLoad(
        rows=strip_quotes(parsed.where(~bad).select(*schema.names)),
        rejects=parsed.where(bad).select(F.col(_CORRUPT).alias("line")),
    )


def snapshots(spark: SparkSession, directory: str) -> list[str]:
    """Dates of the snapshots under a directory, earliest first."""
    names = files.names(spark, directory)
    return sorted(n.partition("=")[2] for n in names if n.startswith("snapshot="))


def read_workqueue(
    spark: SparkSession, directory: str, snapshot: str | None = None, as_of: str | None = None
) -> DataFrame:
    """One dated snapshot of the work queue, with plain column names.

    It is the one named by ``snapshot``, or the latest that is not after
    ``as_of``, or the latest. The others are not read. An absent site or contact is empty text there; a null site
    reads the same.
    """
    if snapshot is None:
        known = [s for s in snapshots(spark, directory) if as_of is None or s <= as_of]
        if not known:
            raise ValueError(f"{directory} has no snapshot" + (f" up to {as_of}" if as_of else ""))
        snapshot = known[-1]
    # the one folder, by its own titles, which may differ from those of other dates
    df = spark.read.parquet(f"{directory.rstrip('/')}/snapshot={snapshot}")
    titles = {t.lower(): name for t, name in WORKQUEUE_TITLES.items()}
    df = df.select(*[F.col(f"`{c}`").alias(titles.get(c.lower(), c)) for c in df.columns])
    sites = ("physical_measurements_location", "biospecimens_location")
    return df.withColumns({s: F.coalesce(F.col(s), F.lit("")) for s in sites})


def load_tables(spark: SparkSession, names: Iterable[str], directory: str | None = None,
                namespace: str | None = None) -> dict[str, DataFrame]:
    """Tables by name, from parquet under a directory or from a catalog namespace."""
    if directory is not None:
        return {n: spark.read.parquet(f"{directory.rstrip('/')}/{n}") for n in names}
    prefix = f"{namespace}." if namespace else ""
    return {n: spark.table(prefix + n) for n in names}
