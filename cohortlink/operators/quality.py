"""Counts and lists that show whether a run can be trusted."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CONCEPT_CODES, Concepts
from ..functions.text import match_key, number_after_first_char, trimmed_length
from .registry import of_type


def _checks(table: DataFrame, **counts: Column) -> DataFrame:
    """Several counts of one table in one pass, one (check, value) row each."""
    row = table.agg(*[F.count_if(c).alias(name) for name, c in counts.items()])
    return row.unpivot([], list(counts), "check", "value")


# Sources that hold a study id, as bits of a mask.
IN_STAGING, IN_MASTER, IN_REGISTRY = 1, 2, 4


def key_presence(
    master: DataFrame, staging: DataFrame, identifier: DataFrame, c: Concepts = Concepts()
) -> DataFrame:
    """Per study id which sources hold it (``held``, a bit mask), and the rows of each.

    One aggregation of all three tables by key. Rows without an id meet nobody:
    they have one row here, with a null key and no bits.
    """

    def side(rows: DataFrame, column: str, bit: int, mrn: Column | None = None) -> DataFrame:
        return rows.select(
            match_key(F.col(column)).alias("study_key"),
            F.lit(bit).alias("bit"),
            (F.lit(0) if mrn is None else F.when(mrn.isNotNull(), 1).otherwise(0)).alias("mrn"),
        )

    sides = side(staging, "study_id", IN_STAGING).unionByName(side(master, "study_id", IN_MASTER, F.col("mrn")))
    sides = sides.unionByName(side(of_type(identifier, c.id_type_study), "identifier", IN_REGISTRY))
    counts = {"n_staging": IN_STAGING, "n_master": IN_MASTER, "n_registry": IN_REGISTRY}
    return sides.groupBy("study_key").agg(
        F.when(F.col("study_key").isNull(), 0).otherwise(F.bit_or("bit")).alias("held"),
        *[F.count_if(F.col("bit") == bit).alias(name) for name, bit in counts.items()],
        F.sum("mrn").alias("n_master_with_mrn"),
    )


def link_presence(links: DataFrame) -> DataFrame:
    """Per linked person and per record number (``kind`` person, mrn) the number of links, without a person and in all."""
    keys = F.array(
        F.struct(F.lit("person").alias("kind"), F.col("master_id").cast("string").alias("link_key")),
        F.struct(F.lit("mrn").alias("kind"), match_key(F.col("mrn")).alias("link_key")),
    )
    each = links.select(F.explode(keys).alias("_key"), F.col("master_id").isNull().alias("_alone"))
    return each.groupBy("_key.kind", "_key.link_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("_alone").alias("n_without_person")
    )


def repeated_links(links: DataFrame) -> DataFrame:
    """Persons and record numbers that several links name, with the number of links."""
    return link_presence(links).where(F.col("link_key").isNotNull() & (F.col("n_rows") > 1)).drop("n_without_person")


def reconcile(
    master: DataFrame,
    staging: DataFrame,
    identifier: DataFrame,
    links: DataFrame,
    c: Concepts = Concepts(),
) -> DataFrame:
    """Row counts, matched counts, missing keys and repeated keys as (check, value) rows.

    ``links`` is ``roster.study_links`` of the master roster. Each table is read
    once: all counts come from ``key_presence`` and ``link_presence``.
    """

    def total(n: Column | str, condition: Column) -> Column:
        n = F.col(n) if isinstance(n, str) else n
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("bigint")

    every, known = F.lit(True), F.col("study_key").isNotNull()
    lacks = lambda bit: F.col("held").bitwiseAND(F.lit(bit)) == 0
    roster_counts = {
        "staging_rows": total("n_staging", every),
        "master_rows": total("n_master", every),
        "master_rows_with_mrn": total("n_master_with_mrn", every),
        "staging_ids_missing_from_master": total("n_staging", known & lacks(IN_MASTER)),
        "master_ids_missing_from_registry": total("n_master", lacks(IN_REGISTRY)),
    }
    person, mrn, given = F.col("kind") == "person", F.col("kind") == "mrn", F.col("link_key").isNotNull()
    repeated = given & (F.col("n_rows") > 1)
    link_counts = {
        "link_rows": total("n_rows", mrn),
        "link_rows_with_mrn": total("n_rows", mrn & given),
        "link_rows_with_person": total("n_rows", person & given),
        "link_rows_unmatched": total("n_without_person", mrn & given),
        "persons_linked_repeatedly": total(F.lit(1), person & repeated),
        "mrns_linked_repeatedly": total(F.lit(1), mrn & repeated),
    }

    def listed(table: DataFrame, counts: dict[str, Column]) -> DataFrame:
        row = table.agg(*[c.alias(name) for name, c in counts.items()])
        return row.unpivot([], list(counts), "check", "value")

    presence = key_presence(master, staging, identifier, c)
    return listed(presence, roster_counts).unionByName(listed(link_presence(links), link_counts))


def missing_from_master(staging: DataFrame, master: DataFrame) -> DataFrame:
    """Staging rows whose study id the master roster lacks."""
    known = master.where(F.col("study_id").isNotNull()).select(match_key(F.col("study_id")).alias("_key"))
    keyed = staging.where(F.col("study_id").isNotNull()).withColumn("_key", match_key(F.col("study_id")))
    return keyed.join(known, "_key", "left_anti").select(*staging.columns)


def unregistered(master: DataFrame, identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """Roster rows whose study id is not in the registry."""
    known = of_type(identifier, c.id_type_study).select(match_key(F.col("identifier")).alias("_key"))
    keyed = master.withColumn("_key", match_key(F.col("study_id")))
    return keyed.join(known, "_key", "left_anti").select(*master.columns)


def unmatched_links(links: DataFrame) -> DataFrame:
    """Links with a record number that leads to no person."""
    return links.where(F.col("mrn").isNotNull() & F.col("master_id").isNull())


def links_without_mrn(links: DataFrame) -> DataFrame:
    return links.where(F.col("mrn").isNull())


def crosswalk_fanout(identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """Persons whose clinical rows are published several times, from counts alone."""
    kind = F.col("id_type_concept_id")
    return (
        identifier.where(kind.isin(c.id_type_local_person, c.id_type_participant) & F.col("master_id").isNotNull())
        .groupBy("master_id")
        .agg(
            F.count_if(kind == c.id_type_local_person).alias("n_local_ids"),
            F.count_if(kind == c.id_type_participant).alias("n_participant_ids"),
        )
        .where((F.col("n_local_ids") >= 1) & (F.col("n_participant_ids") > 1))
    )


def shared_numbers(identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """Published person ids that stand for more than one participant identifier."""
    number = number_after_first_char(F.col("identifier"))
    return (
        of_type(identifier, c.id_type_participant)
        .select(number.alias("person_id"), "identifier")
        .where(F.col("person_id").isNotNull())
        .groupBy("person_id")
        .agg(F.min("identifier").alias("lowest_identifier"), F.max("identifier").alias("highest_identifier"))
        .where(F.col("lowest_identifier") != F.col("highest_identifier"))
    )


def several_ehr_rows(identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """Persons with several record number rows: each registers the participant id once."""
    return (
        identifier.where(
            (F.col("id_use_concept_id") == c.id_use_ehr_mrn) & F.col("master_id").isNotNull()
        )
        .groupBy("master_id")
        .agg(F.count(F.lit(1)).alias("n_ehr_rows"))
        .where(F.col("n_ehr_rows") > 1)
    )


def too_long(table: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Number of values above the declared length, per column."""
    return _checks(table, **{name: trimmed_length(F.col(name)) > n for name, n in lengths.items()})


def concept_mismatches(concept: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """Configured concepts that the vocabulary lacks or lists under another id."""
    rows = [(name, concept_id, *CONCEPT_CODES[name]) for name, concept_id in c.named().items()]
    expected = concept.sparkSession.createDataFrame(
        rows, "name string, expected_id bigint, concept_class_id string, concept_code string"
    )
    found = concept.where(F.col("invalid_reason").isNull()).select(
        "concept_class_id", "concept_code", "concept_id"
    )
    return expected.join(found, ["concept_class_id", "concept_code"], "left").where(
        ~F.col("concept_id").eqNullSafe(F.col("expected_id"))
    )
