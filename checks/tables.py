"""Queries that write the given rows as a table of some kind and return what a reader gets back."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlink import schemas
from cohortlink.config import Concepts
from cohortlink.operators import exports, registry, roster
from cohortlink.sources import batches, ordered, read, typed, write
from cohortlink.sources.versions import BucketedVersions

if TYPE_CHECKING:
    from .queries import Steps

C = Concepts()
SYNC_TS = datetime(2018, 5, 14)
BUCKETS = 16


def known_domains(concept: DataFrame) -> DataFrame:
    names = F.col("domain_id")
    return concept.groupBy("domain_id").agg(F.min("concept_id").alias("domain_concept_id")).select(
        "domain_id", names.alias("domain_name"), "domain_concept_id"
    )


def known_vocabularies(concept: DataFrame) -> DataFrame:
    # without the study's own, which the seed adds
    other = concept.where("vocabulary_id = 'Local'").groupBy("vocabulary_id").agg(F.min("concept_id").alias("id"))
    none = F.lit(None).cast("string")
    return other.select(
        "vocabulary_id", F.col("vocabulary_id").alias("vocabulary_name"), none.alias("vocabulary_reference"),
        none.alias("vocabulary_version"), F.col("id").alias("vocabulary_concept_id"),
    )


def known_classes(concept: DataFrame) -> DataFrame:
    ids = concept.groupBy("concept_class_id").agg(F.min("concept_id").alias("concept_class_concept_id"))
    return ids.select("concept_class_id", F.col("concept_class_id").alias("concept_class_name"), "concept_class_concept_id")


def roster_csv(s: Steps) -> DataFrame:
    """The staging roster as CSV, with quotes in some names and no date in some rows; rows and rejects read back."""
    number = F.col("study_id").cast("bigint")
    texts = s.v.roster_staging.select(*[F.col(n).cast("string").alias(n) for n in schemas.ROSTER_STAGING.names])
    given = texts.withColumns({
        "first_name": F.when(number % 5 == 0, F.concat(F.lit('"'), "first_name", F.lit('"'))).otherwise(F.col("first_name")),
        "city": F.when(number % 3 == 0, F.concat("city", F.lit(", CA"))).otherwise(F.col("city")),
        "dob": F.when(number % 7 == 0, "unknown").otherwise(F.col("dob")),
    })
    path = s.run.path("roster.csv")
    given.write.options(header=True, quote='"', escape='"').csv(path)
    found = read.read_roster_csv(s.spark, path, s.run.table)
    lines = found.rejects.select(F.split("line", ",")[0].alias("study_id"), F.lit("rejected").alias("outcome"))
    sound = found.rows.withColumn("outcome", F.lit("read"))
    return sound.unionByName(lines, allowMissingColumns=True)


def workqueue_as_of(s: Steps) -> DataFrame:
    """The work queue of the latest snapshot up to a date, of three; the earlier ones have titles with blanks."""
    base = s.run.path("workqueue")
    titles = {name: title for title, name in read.WORKQUEUE_TITLES.items()}
    titled = s.v.workqueue.withColumnsRenamed(titles)
    titled.limit(0).write.parquet(f"{base}/snapshot=20180212")
    titled.write.parquet(f"{base}/snapshot=20180319")
    s.v.workqueue.limit(0).write.parquet(f"{base}/snapshot=20180402")
    return read.read_workqueue(s.spark, base, as_of="20180401")


def appended_contacts(s: Steps) -> DataFrame:
    """Contact points appended in one batch per use, each twice; a reader gets one copy."""
    base = s.run.path("contacts")
    telecom = s.v.phi_telecom
    for use in (C.telecom_home, C.telecom_work, C.telecom_email):
        rows = telecom.where(F.col("use_concept_id") == use)
        for _ in range(2):
            batches.append_batch(rows, base, f"use-{use}")
    return batches.read_batches(s.spark, base, telecom.schema)


def merge_study_ids_versioned(s: Steps) -> DataFrame:
    """The registry after the study-id merge, made as a version that shares untouched buckets with the one before."""
    rows = s.v.phi_identifier
    table = BucketedVersions(s.spark, s.run.path("registry"), "identifier", BUCKETS, part="id_type_concept_id")
    table.create(rows, "1")
    source = registry.study_id_rows(s.links, C)
    table.merge(
        source, "1", "2", lambda target, source: registry.study_id_merge(target, source).rows, s.run.table,
        parts=[C.id_type_study],
    )
    return table.read("2")


def roster_sync_versioned(s: Steps) -> DataFrame:
    """The roster after a sync, made as a version."""
    table = BucketedVersions(s.spark, s.run.path("roster"), "study_id", BUCKETS)
    table.create(s.v.roster_master, "1")
    table.merge(
        s.v.roster_staging, "1", "2", lambda target, source: roster.sync(target, source, SYNC_TS).rows, s.run.table,
        every=True,
    )
    return table.read("2")


def _published(s: Steps, name: str, rows: DataFrame, columns: typed.Declared) -> tuple[str, str]:
    table, rejects = s.run.catalog_name(name), s.run.path(f"{name}-rejects")
    typed.publish(rows, table, columns, rejects, s.run.path(name))
    return table, rejects


def published_types(s: Steps) -> DataFrame:
    """The five personal-data tables, published: their columns as the catalog has them, and the rows of each."""
    ids, person = s.participant_rows, s.v.phi_person
    tables = {
        "pii_name": exports.pii_name(person, ids),
        "pii_email": exports.pii_email(s.v.phi_telecom, ids),
        "pii_phone_number": exports.pii_phone(s.v.phi_telecom, ids),
        "pii_address": exports.pii_address(s.v.person, s.v.phi_identifier, local=s.local),
        "pii_mrn": exports.pii_mrn(person, ids),
    }
    out = None
    for name, rows in tables.items():
        table, rejects = _published(s, name, rows, typed.PUBLISHED[name])
        kinds = s.spark.createDataFrame(
            [(name, n, kind) for n, kind in typed.PUBLISHED[name].of(s.spark, table)],
            "table_name string, column_name string, data_type string",
        )
        counts = s.spark.table(table).agg(F.count(F.lit(1)).alias("n_rows"))
        bad = typed.rejected(s.spark, rejects).agg(F.count(F.lit(1)).alias("n_rejects"))
        # two one-row tables beside the table's few columns
        part = kinds.withColumns({"n_rows": counts.scalar(), "n_rejects": bad.scalar()})
        out = part if out is None else out.unionByName(part)
    return out


def published_emails(s: Steps) -> DataFrame:
    """E-mails published under a limit of 11 characters: rows of the table, and rejects with the reason."""
    columns = typed.Declared((("person_id", "bigint"), ("email", "varchar(11)")))
    table, rejects = _published(s, "short_email", exports.pii_email(s.v.phi_telecom, s.participant_rows), columns)
    sound = s.spark.table(table).withColumn("too_long", F.lit(""))
    bad = typed.rejected(s.spark, rejects).withColumn("too_long", F.array_join("too_long", ","))
    return sound.unionByName(bad)


def review_order(s: Steps, review: DataFrame, order: Sequence[str]) -> DataFrame:
    """The review list's columns of order with each row's place in the written files."""
    path = s.run.path("review")
    ordered.write_ordered(review.select(*order), path, order)
    return ordered.read_with_positions(s.spark, path, review.select(*order).schema)


def _bucketed(s: Steps, name: str, rows: DataFrame) -> DataFrame:
    table = s.run.catalog_name(name)
    write.save_bucketed(rows, table, "master_id", BUCKETS, s.run.path(name))
    return s.spark.table(table)


def crosswalk_bucketed(s: Steps) -> DataFrame:
    """The crosswalk from a registry bucketed by person: it joins itself in place."""
    stored = _bucketed(s, "registry", s.v.phi_identifier)
    return registry.crosswalk(stored, C.id_type_local_person, C.id_type_participant)


def contacts_bucketed(s: Steps) -> DataFrame:
    """Participant ids beside contact points and postal addresses, all bucketed by person."""
    own = registry.of_type(_bucketed(s, "registry", s.v.phi_identifier), C.id_type_participant)
    telecom = _bucketed(s, "telecom", s.v.phi_telecom)
    location = _bucketed(s, "location", s.v.phi_location).select("master_id", F.col("value").alias("address"))
    joined = own.select("master_id", "identifier").join(telecom, "master_id")
    return joined.join(location, "master_id", "left")
