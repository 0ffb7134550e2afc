"""The identity registry: persons, their contact points and their identifiers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    EHR_MRN_USE_CODE,
    PARTICIPANT_LABELS,
    STUDY_LABELS,
    Concepts,
    RegistrationLabels,
)
from ..functions.text import contact_key, match_key, phone_key
from ..schemas import PHI_IDENTIFIER
from . import vocabulary
from .blocks import skew_join
from .merge import Merge, snapshot_merge

SLOTS = ("home_phone", "work_phone", "email", "address")


def of_type(identifier: DataFrame, type_id: int) -> DataFrame:
    """Registry rows of one identifier type; prunes partitions of a typed layout."""
    return identifier.where(F.col("id_type_concept_id") == type_id)


def _slotted(telecom: DataFrame, location: DataFrame | None, c: Concepts) -> DataFrame:
    use = F.col("use_concept_id")
    lines = telecom.where(use.isin(c.telecom_home, c.telecom_work, c.telecom_email)).select(
        "master_id",
        F.when(use == c.telecom_home, "home_phone")
        .when(use == c.telecom_work, "work_phone")
        .otherwise("email")
        .alias("slot"),
        "value",
    )
    if location is not None:
        postal = location.where(use == c.postal_address)
        lines = lines.unionByName(postal.select("master_id", F.lit("address").alias("slot"), "value"))
    return lines.where(F.col("master_id").isNotNull() & F.col("value").isNotNull())


def _slot_keys(telecom: DataFrame, location: DataFrame | None, c: Concepts) -> DataFrame:
    """(master_id, slot, value, value_key) of the contact points that are not blank."""
    is_phone = F.col("slot").isin("home_phone", "work_phone")
    key = F.when(is_phone, phone_key(F.col("value"))).otherwise(contact_key(F.col("value")))
    return _slotted(telecom, location, c).withColumn("value_key", key).where(F.col("value_key").isNotNull())


def contact_keys(
    telecom: DataFrame,
    location: DataFrame | None = None,
    c: Concepts = Concepts(),
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Distinct (master_id, kind, value_key) of the non-blank contact points.

    Home and work phones are both of kind ``phone``. One row per fact keeps a
    person with very many contact points spread over tasks. ``wanted`` keeps
    only the given (kind, value_key); broadcast, it filters before any shuffle.
    """
    is_phone = F.col("slot").isin("home_phone", "work_phone")
    keys = _slot_keys(telecom, location, c).select(
        "master_id", F.when(is_phone, "phone").otherwise(F.col("slot")).alias("kind"), "value_key"
    )
    if wanted is not None:
        keys = keys.join(wanted, ["kind", "value_key"], "left_semi").select("master_id", "kind", "value_key")
    return keys.distinct()


def contact_values(
    telecom: DataFrame, location: DataFrame | None = None, c: Concepts = Concepts()
) -> DataFrame:
    """(master_id, kind, value_key, value): the non-blank contact points by slot, the least spelling of each key."""
    keys = _slot_keys(telecom, location, c)
    return keys.groupBy("master_id", F.col("slot").alias("kind"), "value_key").agg(F.min("value").alias("value"))


def contact_rows(
    telecom: DataFrame, location: DataFrame | None = None, c: Concepts = Concepts()
) -> DataFrame:
    """Distinct (master_id, slot, value) of all contact points, one row each, whatever a person has.

    ``slot`` is home_phone, work_phone, email or address.
    """
    return _slotted(telecom, location, c).distinct()


def person_wide(
    person: DataFrame, telecom: DataFrame, location: DataFrame, c: Concepts = Concepts()
) -> DataFrame:
    """Names and birth date of each person, beside each of the person's contact points.

    A person without contact points has one row, with empty slot and value.
    """
    persons = person.select(
        "master_id",
        "mrn",
        "first_name",
        "middle_name",
        F.col("surname").alias("last_name"),
        "birth_date",
    ).distinct()
    return skew_join(persons, contact_rows(telecom, location, c), ["master_id"], "left")


def unmapped(persons: DataFrame, identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """Persons who hold no participant id yet."""
    mapped = of_type(identifier, c.id_type_participant).select("master_id")
    return persons.join(mapped, "master_id", "left_anti")


def crosswalk(identifier: DataFrame, from_type: int, to_type: int) -> DataFrame:
    """Identifier pairs of two types that belong to the same person."""
    source = of_type(identifier, from_type).select(
        "master_id", F.col("identifier").alias("from_identifier")
    )
    target = of_type(identifier, to_type).select(
        "master_id", F.col("identifier").alias("to_identifier")
    )
    return source.join(target, "master_id").select("from_identifier", "master_id", "to_identifier")


def _registry_rows(rows: DataFrame, labels: RegistrationLabels, use_id: Column, type_id: Column) -> DataFrame:
    """Full registry rows for (master_id, source_id, identifier)."""
    values = {
        "preferred_record": F.lit(0),
        "id_use_concept_id": use_id,
        "id_use_source_value": F.lit(labels.id_use_source_value),
        "id_use_source_concept_id": use_id,
        "id_type_concept_id": type_id,
        "id_type_source_value": F.lit(labels.id_type_source_value),
        "id_type_source_concept_id": type_id,
        "system": F.lit(labels.system),
        "period_start_date": F.lit(labels.period_start),
        "period_end_date": F.lit(labels.period_end),
        "assigner": F.lit(labels.assigner),
    }
    return rows.select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in PHI_IDENTIFIER]
    )


def register_identifiers(
    accepted: DataFrame,
    identifier: DataFrame,
    concept: DataFrame,
    c: Concepts = Concepts(),
    labels: RegistrationLabels = PARTICIPANT_LABELS,
    id_column: str = "pmi_id",
) -> DataFrame:
    """New registry rows for accepted matches.

    A person without an EHR record number row is not registered; a person with
    several gets one row for each. Identifiers already in the registry under
    the type that ``labels`` names are skipped.
    """
    ehr_use = vocabulary.concept_id(concept, EHR_MRN_USE_CODE)
    use_id, type_id = _label_concepts(concept, labels)
    known = identifier.where(F.col("id_type_concept_id") == type_id).select(
        match_key(F.col("identifier")).alias("id_key")
    )
    ehr = identifier.where(F.col("id_use_concept_id") == ehr_use).select("master_id", "source_id")
    rows = (
        accepted.select("master_id", F.col(id_column).alias("identifier"))
        .withColumn("id_key", match_key(F.col("identifier")))
        .join(known, "id_key", "left_anti")
        .join(ehr, "master_id")
        .select("master_id", "source_id", "identifier")
        .distinct()
    )
    return _registry_rows(rows, labels, use_id, type_id)


def register_study_ids(
    links: DataFrame, concept: DataFrame, labels: RegistrationLabels = STUDY_LABELS
) -> DataFrame:
    """One-time bulk insert: registry rows for every linked study id."""
    rows = links.select("master_id", "source_id", F.col("study_id").alias("identifier")).distinct()
    return _registry_rows(rows, labels, *_label_concepts(concept, labels))


def _label_concepts(concept: DataFrame, labels: RegistrationLabels) -> tuple[Column, Column]:
    return tuple(
        vocabulary.concept_id(concept, code, concept_class, labels.vocabulary_id)
        for concept_class, code in (
            ("Identifier Use", labels.id_use_code),
            ("Identifier Type", labels.id_type_code),
        )
    )


def merge_study_ids(
    identifier: DataFrame,
    links: DataFrame,
    c: Concepts = Concepts(),
    labels: RegistrationLabels = STUDY_LABELS,
    with_action: bool = False,
) -> DataFrame:
    """The whole registry after bringing in the roster's study ids.

    A study id without a person takes the linked person; one that has a person
    stays as it is; a missing one is inserted. Two different links for one
    study id that is to be updated raise an error, as in SQL ``MERGE``.
    """
    is_study = F.coalesce(F.col("id_type_concept_id") == c.id_type_study, F.lit(False))
    merged = study_id_merge(identifier.where(is_study), study_id_rows(links, c, labels))
    others = identifier.where(~is_study)
    if with_action:
        return merged.rows.unionByName(others.withColumn("action", F.lit("KEEP")))
    return merged.snapshot.unionByName(others)


def study_id_rows(
    links: DataFrame, c: Concepts = Concepts(), labels: RegistrationLabels = STUDY_LABELS
) -> DataFrame:
    """Registry rows of the linked study ids, the source of ``study_id_merge``."""
    rows = links.select("master_id", "source_id", F.col("study_id").alias("identifier")).distinct()
    return _registry_rows(rows, labels, F.lit(c.id_use_study), F.lit(c.id_type_study))


def study_id_merge(target: DataFrame, source: DataFrame) -> Merge:
    """Merge ``study_id_rows`` into the registry's study ids, or into some buckets of them."""
    return snapshot_merge(
        target,
        source.select(*[name for name in source.columns if name in target.columns]),
        key="identifier",
        update=("master_id", "source_id"),
        update_when=F.col("master_id").isNull(),
    )


def find(
    identifier: DataFrame,
    type_id: int,
    ids: Iterable[str] | DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """Registry rows of one type with the given ids, first in id order if limited.

    ``ids`` is a short list or a one-column DataFrame of any size.
    """
    rows = of_type(identifier, type_id)
    key = match_key(F.col("identifier"))
    if isinstance(ids, DataFrame):
        wanted = ids.select(match_key(F.col(ids.columns[0])).alias("id_key"))
        rows = rows.withColumn("id_key", key).join(wanted, "id_key", "left_semi").drop("id_key")
    else:
        rows = rows.where(key.isin([i.rstrip(" ").lower() for i in ids]))
    if limit is not None:
        rows = rows.orderBy("identifier", "master_id").limit(limit)
    return rows
