"""Research submission: personal-data tables and clinical tables keyed by participant id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..config import Concepts
from ..functions.text import (
    date_of,
    no_such_date,
    number_after_first_char,
    number_without_p,
)
from .registry import crosswalk, of_type


def _zero() -> Column:
    return F.lit(0).cast("bigint")


# --- personal-data tables ---------------------------------------------------


def _participant_ids(identifier: DataFrame, c: Concepts) -> DataFrame:
    """Distinct participant identifiers per person, whose number can be read."""
    ids = of_type(identifier, c.id_type_participant).select("master_id", "identifier").distinct()
    return ids.where(number_after_first_char(F.col("identifier")).isNotNull())


def _publish(rows: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Distinct on the raw identifier, then shown by its number."""
    return rows.distinct().select(
        number_after_first_char(F.col("identifier")).alias("person_id"),
        *[value.alias(name) for name, value in columns.items()],
    )


def pii_name(person: DataFrame, identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    rows = person.select(
        "master_id", "first_name", "middle_name", "surname", "qualifications", "honorifics", "title"
    ).join(_participant_ids(identifier, c), "master_id")
    return _publish(
        rows.drop("master_id"),
        {
            "first_name": F.col("first_name"),
            "middle_name": F.col("middle_name"),
            "last_name": F.col("surname"),
            "suffix": F.coalesce("qualifications", "honorifics"),
            "prefix": F.col("title"),
        },
    )


def _pii_telecom(
    telecom: DataFrame, identifier: DataFrame, uses: Sequence[int], name: str, c: Concepts
) -> DataFrame:
    rows = (
        telecom.where(F.col("use_concept_id").isin(list(uses)))
        .select("master_id", "value")
        .join(_participant_ids(identifier, c), "master_id")
    )
    return _publish(rows.drop("master_id"), {name: F.col("value")})


def pii_email(telecom: DataFrame, identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    return _pii_telecom(telecom, identifier, [c.telecom_email], "email", c)


def pii_phone(telecom: DataFrame, identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """Home and work phones, as written in the registry."""
    return _pii_telecom(telecom, identifier, [c.telecom_home, c.telecom_work], "phone_number", c)


def address_crosswalk(identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """Distinct (person_id, identifier): the clinical person beside the participant identifier as written."""
    local = crosswalk(identifier, c.id_type_local_person, c.id_type_participant).select(
        F.col("from_identifier").try_cast("bigint").alias("person_id"),
        F.col("to_identifier").alias("identifier"),
    )
    return local.where(
        F.col("person_id").isNotNull() & number_after_first_char(F.col("identifier")).isNotNull()
    ).distinct()


def pii_address(
    person: DataFrame, identifier: DataFrame, c: Concepts = Concepts(), local: DataFrame | None = None
) -> DataFrame:
    """Location of the clinical person record, reached over the crosswalk.

    ``local`` is ``address_crosswalk``; one that was measured small and marked
    for broadcast spares shuffling the persons.
    """
    local = address_crosswalk(identifier, c) if local is None else local
    rows = person.select("person_id", "location_id").join(local, "person_id")
    return _publish(rows.drop("person_id"), {"location_id": F.col("location_id")})


def pii_mrn(person: DataFrame, identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    rows = person.select("master_id", "source_system", "mrn").join(
        _participant_ids(identifier, c), "master_id"
    )
    return _publish(
        rows.drop("master_id"),
        {"health_system": F.col("source_system"), "mrn": F.col("mrn")},
    )


# --- clinical tables --------------------------------------------------------


def participant_crosswalk(identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """(local_person_id, participant_id) as numbers, for re-keying clinical rows.

    Not distinct: each pair of registry rows counts, so a person with two
    participant ids has every clinical row published under both.
    ``quality.crosswalk_fanout`` lists such persons; identifiers that are no
    number are in ``unreadable_ids``.
    """
    pairs = crosswalk(identifier, c.id_type_local_person, c.id_type_participant)
    return pairs.select(
        F.col("from_identifier").try_cast("bigint").alias("local_person_id"),
        number_without_p(F.col("to_identifier")).alias("participant_id"),
    ).where(F.col("local_person_id").isNotNull() & F.col("participant_id").isNotNull())


def rekey(
    fact: DataFrame,
    crosswalk_ids: DataFrame,
    columns: Sequence[str],
    values: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Clinical rows of participants, with ``person_id`` replaced by the participant id.

    ``values`` gives the columns that are not copied from the fact table.
    """
    values = dict(values or {})
    joined = fact.join(crosswalk_ids, F.col("person_id") == F.col("local_person_id"))
    values["person_id"] = F.col("participant_id")
    return joined.select(*[values.get(name, F.col(name)).alias(name) for name in columns])


def _with(schema, **after: str) -> list[str]:
    """Column names of a schema with extra names placed after existing ones."""
    out = []
    for name in schema.names:
        out.append(name)
        out.extend(after.get(name, "").split())
    return out


PERSON_COLUMNS = _with(schemas.PERSON, day_of_birth="birth_datetime")
VISIT_COLUMNS = _with(
    schemas.VISIT_OCCURRENCE,
    visit_start_date="visit_start_datetime",
    visit_end_date="visit_end_datetime",
)
CONDITION_COLUMNS = _with(schemas.CONDITION_OCCURRENCE, stop_reason="provider_id")
PROCEDURE_COLUMNS = _with(
    schemas.PROCEDURE_OCCURRENCE,
    procedure_type_concept_id="modifier_concept_id",
    quantity="provider_id",
)
MEASUREMENT_COLUMNS = _with(
    schemas.MEASUREMENT,
    measurement_type_concept_id="operator_concept_id",
    value_as_number="value_as_concept_id",
    range_high="provider_id",
)
DRUG_COLUMNS = _with(schemas.DRUG_EXPOSURE, lot_number="provider_id")

_BIRTH_PARTS = ("year_of_birth", "month_of_birth", "day_of_birth")


def _birth() -> list[Column]:
    return [F.col(name) for name in _BIRTH_PARTS]


def cdm_person(person: DataFrame, crosswalk_ids: DataFrame) -> DataFrame:
    """Persons with their birth date put together; an impossible date is left empty and in ``impossible_births``."""
    return rekey(
        person,
        crosswalk_ids,
        PERSON_COLUMNS,
        {"birth_datetime": date_of(*_birth())},
    )


def impossible_births(person: DataFrame) -> DataFrame:
    """Persons that ``cdm_person`` gives no birth date: rows whose birth date parts form no date."""
    return person.where(no_such_date(*_birth())).select("person_id", *_BIRTH_PARTS)


def cdm_visit(visit: DataFrame, crosswalk_ids: DataFrame, as_timestamp: bool = False) -> DataFrame:
    """Visits; the datetime columns repeat the dates unless ``as_timestamp`` is set."""
    start, end = F.col("visit_start_date"), F.col("visit_end_date")
    if as_timestamp:
        start, end = start.cast("timestamp"), end.cast("timestamp")
    return rekey(
        visit,
        crosswalk_ids,
        VISIT_COLUMNS,
        {"visit_start_datetime": start, "visit_end_datetime": end},
    )


def cdm_condition(condition: DataFrame, crosswalk_ids: DataFrame) -> DataFrame:
    return rekey(condition, crosswalk_ids, CONDITION_COLUMNS, {"provider_id": _zero()})


def cdm_procedure(procedure: DataFrame, crosswalk_ids: DataFrame) -> DataFrame:
    return rekey(
        procedure,
        crosswalk_ids,
        PROCEDURE_COLUMNS,
        {"modifier_concept_id": _zero(), "provider_id": _zero()},
    )


def cdm_measurement(measurement: DataFrame, crosswalk_ids: DataFrame) -> DataFrame:
    return rekey(
        measurement,
        crosswalk_ids,
        MEASUREMENT_COLUMNS,
        {"operator_concept_id": _zero(), "value_as_concept_id": _zero(), "provider_id": _zero()},
    )


def cdm_drug(drug: DataFrame, crosswalk_ids: DataFrame) -> DataFrame:
    return rekey(drug, crosswalk_ids, DRUG_COLUMNS, {"provider_id": _zero()})


def unreadable_ids(identifier: DataFrame, c: Concepts = Concepts()) -> DataFrame:
    """Reject list of the exports: identifiers whose number cannot be read, and by which rule."""
    is_participant = F.col("id_type_concept_id") == c.id_type_participant
    value = F.col("identifier")
    rules = F.array(
        F.when(is_participant & number_after_first_char(value).isNull(), "after_first_char"),
        F.when(is_participant & number_without_p(value).isNull(), "without_p"),
        F.when(~is_participant & value.try_cast("bigint").isNull(), "local_person_id"),
    )
    return (
        identifier.where(F.col("id_type_concept_id").isin(c.id_type_participant, c.id_type_local_person))
        .select("master_id", "id_type_concept_id", "identifier", F.explode(F.array_compact(rules)).alias("rule"))
    )
