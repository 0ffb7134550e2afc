"""Named settings: concept ids, registration labels and the study's site lists."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from datetime import date


@dataclass(frozen=True)
class Concepts:
    """Concept ids the jobs refer to by name.

    The defaults are fixed values: they equal the ids seeded by
    ``vocabulary.seed``. ``quality.concept_mismatches`` checks them against a
    live concept table.
    """

    telecom_home: int = 2000000400
    telecom_work: int = 2000000401
    telecom_email: int = 2000000405
    postal_address: int = 2000000511
    id_type_mrn: int = 2000000803
    id_type_local_person: int = 2000000812
    id_type_participant: int = 2000000813
    id_type_study: int = 2000000814
    id_use_participant: int = 2000000704
    id_use_ehr_mrn: int = 2000000713
    id_use_study: int = 2000000720

    def named(self) -> dict[str, int]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


# Fixed values: (concept class, concept code) behind each name of Concepts.
CONCEPT_CODES = {
    "telecom_home": ("Telecom use", "Home"),
    "telecom_work": ("Telecom use", "Work"),
    "telecom_email": ("Telecom use", "Email"),
    "postal_address": ("Address Use", "PostalAddressUse"),
    "id_type_mrn": ("Identifier Type", "MR"),
    "id_type_local_person": ("Identifier Type", "OMOP_PERSON_ID"),
    "id_type_participant": ("Identifier Type", "PMI_ID"),
    "id_type_study": ("Identifier Type", "STUDY_ID"),
    "id_use_participant": ("Identifier Use", "AoU"),
    "id_use_ehr_mrn": ("Identifier Use", "EHR_MRN_UCSD"),
    "id_use_study": ("Identifier Use", "REDCAP_STUDYID_UCSD"),
}


@dataclass(frozen=True)
class RegistrationLabels:
    """Texts and concept codes written with a newly registered identifier."""

    id_use_source_value: str
    id_type_source_value: str
    system: str
    assigner: str
    id_use_code: str
    id_type_code: str
    # a neutral name; a study gives its own, with its seed rows
    vocabulary_id: str = "IDENTITY"
    period_start: date = field(default=date(1970, 1, 1))
    period_end: date = field(default=date(2099, 12, 31))


# Fixed values written to the registry.
PARTICIPANT_LABELS = RegistrationLabels(
    id_use_source_value="All of Us",
    id_type_source_value="PMI_ID",
    system="HealthPro",
    assigner="HealthPro",
    id_use_code="AoU",
    id_type_code="PMI_ID",
)
STUDY_LABELS = RegistrationLabels(
    id_use_source_value="Redcap Study ID",
    id_type_source_value="Redcap Study ID",
    system="UCSD Redcap",
    assigner="UCSD Redcap",
    id_use_code="REDCAP_STUDYID_UCSD",
    id_type_code="STUDY_ID",
)
EHR_MRN_USE_CODE = "EHR_MRN_UCSD"
SYNC_SOURCE = "Sync CTRI Redcap"

# Neutral defaults: sites whose enrolments belong to the cohort, and sites of other
# centres that exclude a record with one blank site. A study gives its own lists to
# ``cohort.site_cohort``.
INCLUDE_SITES = ("home_gateway", "home_biobank", "home_clinic")
EXCLUDE_SITES = ("partner_clinic", "partner_biobank")

# A match needs this many identifiers in common to be accepted without review.
MIN_SCORE = 4
