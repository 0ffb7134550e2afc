"""Output tables with declared types: catalog tables with ``varchar(n)`` columns, and rejects split off before."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trimmed_length
from .. import schemas


@dataclass(frozen=True)
class Declared:
    """Columns of an output table: (name, type as in a ``create table``), in order."""

    columns: tuple[tuple[str, str], ...]

    def create(self, spark: SparkSession, table: str, path: str | None = None) -> None:
        """Create the table, empty; fails if it exists."""
        text = ", ".join(f"`{name}` {kind}" for name, kind in self.columns)
        spark.sql(f"create table {table} ({text}) using parquet" + (f" location '{path}'" if path else ""))

    def of(self, spark: SparkSession, table: str) -> tuple[tuple[str, str], ...]:
        """The declared columns of a table of the catalog."""
        rows = spark.sql(f"describe table {table}").collect()
        names = {name for name, _ in self.columns}
        return tuple((r["col_name"], r["data_type"]) for r in rows if r["col_name"] in names)

    def limits(self) -> dict[str, int]:
        return {n: int(kind[8:-1]) for n, kind in self.columns if kind.startswith("varchar(")}


def declared(schema: T.StructType, lengths: Mapping[str, int] | None = None) -> Declared:
    """The columns of a schema, texts with their declared length."""
    lengths = lengths or {}
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    return Declared(tuple((n, f"varchar({lengths[n]})" if n in lengths else kind) for n, kind in kinds.items()))


# The five published tables of personal data.
PUBLISHED = {
    name: declared(getattr(schemas, name.upper()), schemas.PII_LENGTHS.get(name))
    for name in ("pii_name", "pii_email", "pii_phone_number", "pii_address", "pii_mrn")
}


def reasons(limits: Mapping[str, int]) -> Column:
    """The columns of a row whose text is longer than declared, trailing blanks aside; empty for a sound row."""
    over = F.array(*[F.when(trimmed_length(F.col(n)) > k, F.lit(n)) for n, k in limits.items()])
    return F.filter(over, lambda x: x.isNotNull()) if limits else F.array().cast("array<string>")


def publish(df: DataFrame, table: str, columns: Declared, rejects: str, path: str | None = None) -> None:
    """Create ``table`` with its declared types and write the rows that fit; the others go to parquet at ``rejects``.

    A reject has the row's columns and ``too_long``, the names of those that do
    not fit. Trailing blanks beyond the declared length are cut, as they are in
    a comparison. The rows are computed once, and written to ``rejects`` with
    their verdict; the table is filled from there.
    """
    spark = df.sparkSession
    names = [n for n, _ in columns.columns]
    missing = set(names) - set(df.columns)
    if missing:
        raise ValueError(f"rows lack {', '.join(sorted(missing))}")
    limits = columns.limits()
    judged = df.select(*names).withColumn("too_long", reasons(limits)).withColumn("fits", F.size("too_long") == 0)
    judged.write.mode("errorifexists").partitionBy("fits").parquet(rejects)
    sound = spark.read.schema(judged.schema).parquet(rejects).where("fits")
    cut = {n: F.when(F.length(n) > k, F.substring(n, 1, k)).otherwise(F.col(n)) for n, k in limits.items()}
    columns.create(spark, table, path)
    # an insert checks lengths and types once more
    sound.select(*[cut.get(n, F.col(n)).alias(n) for n in names]).write.insertInto(table)


def rejected(spark: SparkSession, rejects: str) -> DataFrame:
    """Rows that ``publish`` did not write, and why."""
    return spark.read.parquet(rejects).where("not fits").drop("fits")
