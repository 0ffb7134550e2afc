"""Publish the personal-data and clinical tables of all participants."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..config import Concepts
from ..operators import exports, registry
from ..sources.write import write_version
from .stages import Run, broadcast_if_small


def build_submission(run: Run, tables: Mapping[str, DataFrame], c: Concepts = Concepts()) -> dict[str, DataFrame]:
    """All published tables by name, plus the two reject lists.

    ``tables`` holds phi_person, phi_telecom, phi_identifier, person and the
    five clinical fact tables. The crosswalk is made once for all of them. It
    and the participants' ids are broadcast if measured small, so that neither
    fact tables nor contact points are shuffled.
    """
    ids = tables["phi_identifier"]
    walk = broadcast_if_small(run.table(exports.participant_crosswalk(ids, c), "crosswalk"))
    local = broadcast_if_small(run.table(exports.address_crosswalk(ids, c), "address-crosswalk"))
    own = broadcast_if_small(
        registry.of_type(ids, c.id_type_participant).select("master_id", "identifier", "id_type_concept_id")
    )
    return {
        "pii_name": exports.pii_name(tables["phi_person"], own, c),
        "pii_email": exports.pii_email(tables["phi_telecom"], own, c),
        "pii_phone_number": exports.pii_phone(tables["phi_telecom"], own, c),
        "pii_address": exports.pii_address(tables["person"], ids, c, local),
        "pii_mrn": exports.pii_mrn(tables["phi_person"], own, c),
        "person": exports.cdm_person(tables["person"], walk),
        "visit_occurrence": exports.cdm_visit(tables["visit_occurrence"], walk),
        "condition_occurrence": exports.cdm_condition(tables["condition_occurrence"], walk),
        "procedure_occurrence": exports.cdm_procedure(tables["procedure_occurrence"], walk),
        "measurement": exports.cdm_measurement(tables["measurement"], walk),
        "drug_exposure": exports.cdm_drug(tables["drug_exposure"], walk),
        "rejected_identifiers": exports.unreadable_ids(ids, c),
        "rejected_births": exports.impossible_births(tables["person"]),
    }


def write_submission(
    run: Run, tables: Mapping[str, DataFrame], base: str, version: str, c: Concepts = Concepts()
) -> dict[str, str]:
    """Write every published table to a new version directory; returns the paths."""
    return {
        name: write_version(df, f"{base.rstrip('/')}/{name}", version)
        for name, df in build_submission(run, tables, c).items()
    }
